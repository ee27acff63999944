"""The facts are read once: small results are written, and what reads its input
several times reads those."""

import os

from conftest import SF0001, make_fills


def _files(df):
    return [f for f in df.inputFiles()]


def test_calendar_is_made_of_written_daily_sums(spark):
    from dosewise.operators import demand as D
    fills = make_fills(spark, [(1, "a", "2000-01-01", 30, 2.0), (2, "a", "2000-01-01", 30, 3.0), (1, "b", "2000-01-03", 30, 1.0)])
    cal = D.daily_calendar(fills)
    assert _files(cal) and all("/daily-" in f for f in _files(cal))
    got = sorted((r.drug_id, str(r.date), r.units) for r in cal.collect())
    assert got == [("a", "2000-01-01", 5.0), ("a", "2000-01-02", 0.0), ("a", "2000-01-03", 0.0),
                   ("b", "2000-01-01", 0.0), ("b", "2000-01-02", 0.0), ("b", "2000-01-03", 1.0)]


def test_course_controlled_and_training_rows_are_written(spark):
    from dosewise.plans import q_courses, q_models, q_streaming
    for df, name in [(q_courses.one_course(spark, SF0001), "/course-"), (q_models._controlled(spark, SF0001), "/controlled-"),
                     (q_streaming._train_test_files(spark, SF0001)[0], "/training-")]:
        assert any(name in f for f in _files(df)) and not any("lineitem" in f for f in _files(df))


def test_few_rows_are_few_tasks(spark):
    from dosewise.session import few_tasks
    t = few_tasks(spark.range(1000).repartition(8))
    assert t.rdd.getNumPartitions() == 1 and t.count() == 1000
    assert few_tasks(spark.range(1000).repartition(8), 300).rdd.getNumPartitions() == 4


def test_candidates_without_a_second_shuffle(spark):
    from dosewise.operators import affinity as AF
    rows = [(1, "a"), (1, "b"), (2, "a"), (2, "c"), (3, "b"), (None, "a"), (None, "b"), (4, "d")]
    pairs = spark.createDataFrame(rows, "patient_id long, drug_id string")
    counts = [("a", "b", 1), ("b", "a", 1), ("a", "c", 2), ("c", "a", 2)]
    links = spark.createDataFrame(counts, "a string, b string, _link int")
    out = AF.least_link(pairs, links)
    assert "LeftAnti" not in out._jdf.queryExecution().toString()
    got = {(r.patient_id, r.b, r._link) for r in out.collect()}
    # a missing patient holds nothing: all that its items link to are candidates
    assert got == {(1, "c", 2), (2, "b", 1), (3, "a", 1), (None, "a", 1), (None, "b", 1), (None, "c", 2)}


def test_day_parts_are_several_files(spark, monkeypatch):
    from dosewise.plans import q_streaming as Q
    monkeypatch.setattr(Q, "FILE_ROWS", 500)
    path, files = Q._in_day_order(spark, SF0001)
    folder = f"{path.removeprefix('file:')}/lineitem.parquet"
    names = sorted((os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet")), key=os.path.getmtime)
    assert files >= 3 and len(names) == 4 * files
    days = [spark.read.parquet(*names[i:i + files]).selectExpr("min(l_shipdate) lo", "max(l_shipdate) hi").first()
            for i in range(0, len(names), files)]
    assert all(a.hi < b.lo for a, b in zip(days, days[1:]))
    assert spark.read.parquet(folder).count() == spark.read.parquet(f"{SF0001}/lineitem.parquet").count()


def test_word_classes_come_from_all_training_rows(spark, monkeypatch):
    from dosewise.llm import lm
    seen, clusters = [], lm._clusters
    monkeypatch.setattr(lm, "_clusters", lambda m: seen.append(m.sum()) or clusters(m))
    docs = spark.createDataFrame([(i, "one two three two") for i in range(40)], "doc_id long, text string")
    model, _ = lm.train(docs, held_out=10)
    assert seen == [model.total]
