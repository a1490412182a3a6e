import re

import corpus_pipeline as P
from clickflow.llm.common import written

from .conftest import EDGE, SF
from .test_neardup import brute


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9000, "12 34 !!", "en", "s", 8), (9001, None, "en", "s", None), (9002, "", None, None, 0)], docs.schema)
    docs = written(docs.union(extra), "in")
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    seen = []
    for name, stage in P.STAGES:
        out = written(stage(spark, docs, SF), name)
        if name != "packing":
            assert out.columns == P.COLUMNS
        seen.append((docs.collect(), out.collect()))
        docs = out
    a, b = seen[0]
    assert {r.doc_id for r in b} == {r.doc_id for r in a if re.search(r"[^\W\d_]", r.text or "")}
    a, b = seen[1]
    assert sorted(r.doc_id for r in a) == sorted(r.doc_id for r in b)
    a, b = seen[2]
    groups = brute([(r.doc_id, r.text) for r in a], 5, 80)
    assert {r.doc_id for r in b} == {d for d, (_, c) in groups.items() if d == c} and len(b) < len(a)
    a, b = seen[3]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in a} - {r.doc_id for r in b}
    assert gone >= {r.doc_id for r in a if any(i in r.text for i in items)}
    a, b = seen[4]
    assert {r.doc_id for r in b} == {r.doc_id for r in a}
    assert all(sum(r.length for r in b if r.doc_id == d.doc_id) == next(r.doc_tokens for r in b if r.doc_id == d.doc_id) for d in a[:20])


def test_run_on_edges(spark, tmp_path):
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    spark.createDataFrame(EDGE, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "nothing that would be found in any text here")], "item_id BIGINT, text STRING").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    out = P.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == {1, 5, 6, 7, 8, 10, None}
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/e/documents.parquet")
    spark.createDataFrame([], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/e/benchmark.parquet")
    assert P.run(spark, f"{tmp_path}/e").count() == 0


def test_language_stage_without_labels(spark):
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    plain = [(d, t, None, s, n) for d, t, _, s, n in EDGE]
    want = sorted((d or -1, t) for d, t, *_ in EDGE if re.search(r"[^\W\d_]", t or ""))
    held = [(d, t, "en" if d == 2 else None, s, n) for d, t, _, s, n in plain]  # the one labelled row has no text
    for rows in (plain, held, [(d, t, "und", s, n) for d, t, _, s, n in plain]):
        out = P.language_id(spark, spark.createDataFrame(rows, schema), SF).collect()
        assert sorted((r.doc_id or -1, r.text) for r in out) == want


def test_rows_not_ids_decide(spark, tmp_path):
    """Rows that repeat a doc_id or have none: no unique text leaves, one row of each group stays,
    and contaminated rows go."""
    from pyspark.sql import functions as F
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in ("ab", "cd", "ef"))
    item = "the passage of a benchmark that must not stand in any text of the corpus"
    rows = [(2, a), (5, a), (5, b), (None, b), (7, c), (7, c), (7, c), (None, f"{c} {item}"), (8, f"x {item} y"), (8, "clean text")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows],
                                 "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").withColumn("__row", F.lit("x"))
    spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    near = P.near_dedup(spark, docs, str(tmp_path))
    assert near.columns == P.COLUMNS
    assert sorted((r.doc_id or 0, r.text) for r in near.collect()) == sorted(
        [(2, a), (5, b), (7, c), (0, f"{c} {item}"), (8, f"x {item} y"), (8, "clean text")])
    clean = P.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in clean) == sorted((d or 0, t) for d, t in rows if item not in t)


def test_scratch_writes_leave_no_shuffle_files(spark):
    """The disk of a stage is that of its tables and of one write's shuffle, not of all shuffles so far."""
    import time

    from clickflow.llm.common import SHUFFLE_CLEANUP

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {x for x in found.mkString(" ").split() if "/shuffle_" in x}

    before, setting = files(), spark.conf.get(SHUFFLE_CLEANUP, None)
    frames = [spark.range(50_000).selectExpr("id % 7000 AS k").groupBy("k").count() for _ in range(3)]  # still in use
    tables = [written(df, "t") for df in frames]
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert all(t.count() == 7000 == df.count() for t, df in zip(tables, frames))


def test_rows_go_to_python_in_small_batches(spark):
    """A batch is held outside the heap, in the executor and in its worker: some megabytes, not 10,000 rows."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["n"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    docs = spark.range(0, 8000, 1, 1).select(F.expr("repeat(concat('word ', id), 300)").alias("text"))
    sizes_ = [r.n for r in written(docs.mapInArrow(sizes, "n BIGINT"), "sizes").collect()]
    assert sum(sizes_) > 16_000_000 and max(sizes_) < 8_000_000
    assert spark.conf.get(key, None) == before
