"""Item affinity: baskets, co-occurrence, lift and recommendations
(U4, A2, A12-A14, J4-J8, M14, M15, O8).

Pair counts hold the pairs that occur and no others.  The distinct (patient,
item) pairs are written once and read by every branch.  A patient's items are
gathered in lists of about ``BASKET`` items, so a patient with very many items
has several lists; every (patient, item) row meets its patient's lists, and the
pairs are counted where they arise (partial aggregation), so what crosses the
network are pair counts, not pairs.  There is no limit on items or baskets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosewise.session import stored

BASKET = 256   # items of one patient in one list, about
PAIRS = 1 << 17   # pairs that a task joins with their links


def patient_items(df: DataFrame, key: str = "patient_id", item: str = "drug_id") -> DataFrame:
    """U4: distinct (patient, item) pairs."""
    return df.select(key, item).dropDuplicates()


def baskets(pairs: DataFrame, key: str = "patient_id", item: str = "drug_id") -> DataFrame:
    """The sorted set of items per patient (bounded by the item count)."""
    return pairs.groupBy(key).agg(F.sort_array(F.collect_set(item)).alias("items"))


def on_item(pairs: DataFrame, item: str = "drug_id") -> DataFrame:
    """A2: patients per item."""
    return pairs.groupBy(item).agg(F.count(F.lit(1)).alias("on_item"))


def pair_counts(pairs: DataFrame, key: str = "patient_id", item: str = "drug_id") -> DataFrame:
    """Patients holding both a and b, for every ordered pair a != b
    of items that some patient holds together.  ``pairs``: distinct (patient,
    item) rows.  Columns: a, b, together."""
    size = pairs.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / BASKET).alias("_lists"))
    lists = (pairs.join(size, key)
             .groupBy(key, F.pmod(F.xxhash64(item), F.col("_lists")).alias("_list"))
             .agg(F.collect_list(item).alias("_items")))
    return (pairs.select(key, F.col(item).alias("a")).join(lists.select(key, "_items"), key)
            .select("a", F.explode("_items").alias("b")).filter(F.col("a") != F.col("b"))
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("together")))


def lift_table(pairs: DataFrame, key: str = "patient_id", item: str = "drug_id") -> DataFrame:
    """For every ordered pair held together: patients on both, share
    of a-patients also on b, b's baseline share of all patients, and lift =
    share / baseline (unrounded; round at presentation)."""
    patients = pairs.agg(F.countDistinct(key).cast("double")).scalar()
    on = on_item(pairs, item)
    t = (pair_counts(pairs, key, item)
         .join(on.select(F.col(item).alias("a"), F.col("on_item").alias("on_a")), "a")
         .join(on.select(F.col(item).alias("b"), F.col("on_item").alias("on_b")), "b"))
    share = F.col("together") / F.col("on_a")
    baseline = F.col("on_b") / patients
    return t.select("a", "b", "together", share.alias("share"), baseline.alias("baseline"),
                    (share / baseline).alias("lift"))


def recommend(pairs: DataFrame, lift: DataFrame, min_lift: float = 1.5, min_share: float = 0.20,
              key: str = "patient_id", item: str = "drug_id") -> DataFrame:
    """For every patient and every item they do not hold, the
    strongest link (highest lift, ties to the lowest source item) from an
    item they hold; kept when lift >= min_lift and share >= min_share.

    An item's links are numbered, strongest first, so that the strongest of a
    patient's is the least number (``least_link``).  Items with no link have lift 0 and are never suggested, so this equals
    scanning every non-held item.
    """
    # A link under min_lift can never be the chosen (strongest) link of a
    # suggestion, so it is dropped before the join; share is tested only on
    # the chosen link, as in the reference.
    strong = lift.filter((F.col("lift") >= min_lift) & (F.col("lift") > 0)).select("a", "b", "share", "lift")
    order = Window.partitionBy("b").orderBy(F.desc("lift"), "a")
    strong = stored(strong.withColumn("_link", F.row_number().over(order)), "links")
    pick = least_link(pairs, strong.select("a", "b", "_link"), key, item)
    chosen = strong.filter(F.col("share") >= min_share)
    return pick.join(chosen, ["b", "_link"]).select(
        key, F.col("b").alias("suggest"), F.col("a").alias("because_of"), "share", "lift")


def least_link(pairs: DataFrame, links: DataFrame, key: str = "patient_id", item: str = "drug_id") -> DataFrame:
    """(key, b, _link): for every patient and item b not held that a held item
    links to, the least number ``_link`` (from 1) of those links.

    The pairs are dealt by patient once.  A link 0 of every item to itself stands
    for "held", so no pair crosses the network again after it met its links (a
    table of items, broadcast if it is small).  A missing patient holds nothing."""
    own = pairs.select(F.col(item).alias("a"), F.col(item).alias("b"), F.lit(0).alias("_link")).distinct()
    links = stored(links.unionByName(own), "links")
    n = pairs.agg(F.count(F.lit(1))).first()[0]
    dealt = pairs.select(key, F.col(item).alias("a")).repartition(max(1, -(-n // PAIRS)), key)
    met = dealt.join(links, "a").filter((F.col("_link") > 0) | F.col(key).isNotNull())
    return met.groupBy(key, "b").agg(F.min("_link").alias("_link")).filter(F.col("_link") > 0)


def care_gap(pairs: DataFrame, has: str, lacks: str, key: str = "patient_id",
             item: str = "drug_id") -> DataFrame:
    """The lowest patient id holding ``has`` and not ``lacks`` (semi + anti
    join, then a min)."""
    with_has = pairs.filter(F.col(item) == has).select(key)
    with_lacks = pairs.filter(F.col(item) == lacks).select(key)
    return with_has.join(with_lacks, key, "left_anti").agg(F.min(key).alias(key))
