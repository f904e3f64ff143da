"""Bucketed tables and the versioned bucket store."""

import pytest
from pyspark.sql import functions as F

from skein.operators import tables, threads
from skein.sources import buckets

SCHEMA = "k long, a string, b long"


def _rows(spark, ids, a="old"):
    return spark.createDataFrame([(i, f"{a}{i}" if i is not None and i % 3 else None, i) for i in ids], SCHEMA)


def _files(tmp_path):
    return {p.relative_to(tmp_path): p.stat().st_mtime_ns for p in (tmp_path / "data").rglob("*.parquet")}


def _collect(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merge_reads_and_writes_the_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path)
    base = _rows(spark, range(200))
    buckets.create_store(base, root, ["k"], 16)
    assert _collect(buckets.read_store(spark, root, SCHEMA)) == _collect(base)
    before, was = _files(tmp_path), buckets.current_version(spark, root)
    changes = spark.createDataFrame([(4, "new", None), (7, None, 70), (1000, "more", 1)], SCHEMA)
    touched = buckets.merge_store(changes, root, SCHEMA, ["k"], 16)
    after, now = _files(tmp_path), buckets.current_version(spark, root)
    assert 1 <= len(touched) <= 3 and {b for b in now if now[b] != was.get(b)} == set(touched)
    assert before.items() <= after.items()  # no file is changed
    assert {str(p).split("bucket=")[1].split("/")[0] for p in after.keys() - before.keys()} == set(map(str, touched))
    assert _collect(buckets.read_store(spark, root, SCHEMA)) == _collect(tables.upsert_coalesce(base, changes, ["k"]))
    read = buckets.read_store(spark, root, SCHEMA, touched)
    assert len({p.split("bucket=")[1].split("/")[0] for p in read.inputFiles()}) == len(touched)
    # nothing to do, a null key, and a second merge on top
    assert buckets.merge_store(changes.limit(0), root, SCHEMA, ["k"], 16) == []
    again = spark.createDataFrame([(None, "null key", 5), (4, "newer", 9)], SCHEMA)
    want = tables.upsert_coalesce(buckets.read_store(spark, root, SCHEMA), again, ["k"])
    want = _collect(want)
    buckets.merge_store(again, root, SCHEMA, ["k"], 16)
    assert _collect(buckets.read_store(spark, root, SCHEMA)) == want


def test_a_failed_merge_changes_nothing_that_is_read(spark, tmp_path):
    root = str(tmp_path)
    buckets.create_store(_rows(spark, range(50)), root, ["k"], 4)
    want = _collect(buckets.read_store(spark, root, SCHEMA))

    def broken(stored, new):
        return tables.upsert_coalesce(stored, new, ["k"]).withColumn("a", F.when(F.col("k") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("a")))

    with pytest.raises(Exception, match="lost"):
        buckets.merge_store(_rows(spark, range(60), "new"), root, SCHEMA, ["k"], 4, broken)
    assert _collect(buckets.read_store(spark, root, SCHEMA)) == want
    buckets.merge_store(_rows(spark, range(60), "new"), root, SCHEMA, ["k"], 4)
    assert buckets.read_store(spark, root, SCHEMA).count() == 60


def test_empty_store(spark, tmp_path):
    assert buckets.read_store(spark, str(tmp_path / "none"), SCHEMA).collect() == []
    buckets.create_store(_rows(spark, []), str(tmp_path / "empty"), ["k"], 4)
    assert buckets.read_store(spark, str(tmp_path / "empty"), SCHEMA).collect() == []
    buckets.merge_store(_rows(spark, [1]), str(tmp_path / "empty"), SCHEMA, ["k"], 4)
    assert _collect(buckets.read_store(spark, str(tmp_path / "empty"), SCHEMA)) == [(1, "old1", 1)]


def test_replies_meet_their_parents_without_a_shuffle_of_the_stored_side(spark, tmp_path):
    m = spark.createDataFrame([(c, i, i - 1 if i else None, 5, None) for c in range(3) for i in range(40)],
                              "chat_id long, message_id long, reply_to_message_id long, sender_id long, date timestamp_ntz")
    stored = buckets.write_bucketed(m, "bucketed_messages_test", ["chat_id", "message_id"], 8, str(tmp_path / "t"))
    plain = _collect(threads.reply_pairs(m))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        pairs = threads.reply_pairs(stored)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1  # only the replies move
        parent = plan[plan.index("reply_to_message_id", plan.rindex("FileScan") - 600):]
        assert "Bucketed: true" in parent and "Exchange" not in plan[plan.rindex("+- "):]
        upsert = tables.upsert_coalesce(stored, m.limit(5).withColumn("sender_id", F.lit(9)), ["chat_id", "message_id"])
        assert _collect(pairs) == plain
        by_key = stored.groupBy("chat_id", "message_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in by_key
        joined = stored.alias("a").join(stored.alias("b"), ["chat_id", "message_id"])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in joined
        assert upsert.count() == 120
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
        spark.sql("drop table bucketed_messages_test")
