"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

# A text is cut into pieces of about this many bytes at white space, so a very
# long text never becomes one huge list of Python words.
PIECE_BYTES = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a missing id falls into fold 0, which
    every caller holds out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % n, F.lit(0))


def id_type(df: DataFrame, name: str = "doc_id") -> T.DataType:
    return df.schema[name].dataType


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)


def as_bytes(column: pa.Array) -> list:
    """The texts of an Arrow string column as UTF-8 bytes; null is empty."""
    if pa.types.is_null(column.type):
        return [b""] * len(column)
    wide = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(wide)
    return [b"" if x is None else x for x in column.to_pylist()]


def each_bytes(column: pa.Array, rows: int = 256):
    """The same one after another, a few rows in Python at a time."""
    for at in range(0, len(column), rows):
        yield from as_bytes(column.slice(at, rows))


def pieces(text: bytes, size: int = PIECE_BYTES):
    """Cut a text at white space into pieces of about ``size`` bytes."""
    if len(text) <= size:
        yield text
        return
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            m = _SPACE.search(text, end)
            end = m.start() if m else len(text)
        yield text[at:end]
        at = end


def words(text: bytes):
    """Lists of the words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased:
    ``bytes.lower`` and ``bytes.split`` touch ASCII letters and ASCII white
    space only."""
    for p in pieces(text):
        w = p.lower().split()
        if w:
            yield w


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)
