import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from goldthread import session
from goldthread.operators import erasure as er, runlog, sharing as sh
from goldthread.sources import files as fs, jdbc, snapshots as sn, topics as tp
from goldthread.streaming import ingest


@pytest.mark.parametrize("plan,values", [
    (jdbc.text_plan("k", 4), ["a", "b", "", None, "zz"]),
    (jdbc.uuid_plan("k", 16), ["00ab", "0f", "10", "a9", "ff", None]),
    (jdbc.uuid_plan("k", 256), ["00ab", "01", "7f", "fe99", "ff", None]),
])
def test_every_row_is_in_exactly_one_slice(spark, plan, values):
    df = spark.createDataFrame([(v,) for v in values], "k string")
    hits = sum((F.when(F.expr(p), 1).otherwise(0) for p in plan.predicates), F.lit(0))
    assert [r[0] for r in df.select(hits).collect()] == [1] * len(values)


def test_integer_and_time_slices(spark):
    plan = jdbc.integer_plan("k", 3, 1003, per_slice=100)
    assert (plan.lower, plan.upper, plan.partitions) == (3, 1004, 11)
    assert jdbc.integer_plan("k", 0, 10**9).partitions == 5001 and len(jdbc.text_plan("k", rows=10**8).predicates) == 500
    assert len(jdbc.time_plan("t", date(2024, 1, 1), date(2024, 2, 1), 10).predicates) == 4
    assert jdbc.integer_plan("k", 5, 5).partitions == 1 and jdbc.output_partitions(500_001) == 2


def test_plan_follows_the_key_type():
    assert jdbc.plan_for("k", "BIGINT", {"min": 0, "max": 10}).column == "k"
    assert len(jdbc.plan_for("k", "varchar(36)", {}).predicates) == 256
    assert len(jdbc.plan_for("k", "varchar(50)", {}).predicates) == 16
    assert len(jdbc.plan_for("k", "datetime", {"start": date(2024, 1, 1), "end": date(2024, 3, 1)}).predicates) == 2


def test_versions_and_restore(spark, rows):
    path = session.new_path(spark, "t")
    at = lambda d: F.expr(f"TIMESTAMP '2024-01-{d:02d} 00:00:00'")
    for v in range(3):
        sn.commit(spark.range(v + 1), path, v, at(v + 1))
    assert sn.version_before(spark, path, at(3)) == 1  # strictly before
    assert sn.restore(spark, path, at(3)) == 3 and sn.read_version(spark, path).count() == 2
    assert rows(sn.changes_of(spark, path, 2, ["id"]), "id", "CDC_CODE") == [(2, "I")]
    with pytest.raises(ValueError):
        sn.version_before(spark, path, at(1))


def test_untouched_partitions_are_not_rewritten(spark, rows):
    path = session.new_path(spark, "parts")
    schema = "k long, v string, p string"
    spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], schema).write.partitionBy("p").parquet(path)
    before = sorted(os.listdir(f"{path}/p=y"))
    fresh = spark.createDataFrame([(2, "B", "x"), (4, "d", "z")], schema)
    for _ in range(2):  # the same merge twice
        sn.merge_partitions(spark, path, fresh, ["k", "p"], ["p"])
    assert sorted(os.listdir(f"{path}/p=y")) == before
    assert rows(spark.read.schema(schema).parquet(path), "k", "v", "p") == [(1, "a", "x"), (2, "B", "x"), (3, "c", "y"), (4, "d", "z")]
    with pytest.raises(ValueError):
        sn.merge_partitions(spark, path, fresh, ["k"], ["p"])


def test_a_batch_that_fails_half_way_is_not_published(spark):
    parent, child = session.new_path(spark, "parent"), session.new_path(spark, "child")
    sn.commit_together({parent: spark.range(1), child: spark.range(2)}, 0)
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(Exception):
        sn.commit_together({parent: spark.range(5), child: broken}, 1)
    assert sn.latest_version(spark, parent) == 0 and sn.read_version(spark, parent).count() == 1
    sn.commit_together({parent: spark.range(5), child: spark.range(6)}, 1)  # the retry
    assert sn.read_version(spark, child).count() == 6
    with pytest.raises(ValueError):
        sn.commit(spark.range(1), parent, 1)


def test_first_run_has_no_previous_snapshot(spark, rows):
    path = session.new_path(spark, "t")
    sn.commit(spark.range(2), path, 0)
    assert rows(sn.changes_of(spark, path, 0, ["id"]), "id", "CDC_CODE") == [(0, "I"), (1, "I")]


def test_empty_reload_keeps_the_table(spark):
    assert sn.reload_guarded(spark.range(3), spark.range(0)).count() == 3


def test_document_id_is_the_first_path_that_is_set(spark, rows):
    path = session.new_path(spark, "d")
    spark.createDataFrame([('{"a":{"id":"x"},"b":"y"}',), ('{"b":"z"}',)], "value string").write.option("maxRecordsPerFile", 1).text(path)
    landed = fs.land(fs.read_documents(spark, path), "D", 7, ["$.a.id", "$.b"])
    assert rows(landed, "document_uuid", "batch_id") == [("x", 7), ("z", 7)]


def test_newest_file_by_date_in_its_name(spark):
    files = spark.createDataFrame([("a/x_2024-01-02.csv",), ("a/x_2024-03-01.csv",), ("a/other.csv",)], "path string")
    assert fs.newest_file(files, fs.date_in_name(F.col("path"))).first()["path"] == "a/x_2024-03-01.csv"


def test_topic_folder_round_trip(spark, rows):
    path = session.new_path(spark, "topics")
    df = spark.createDataFrame([("t1", "1", "a"), ("t2", "2", "b")], "topic string, key string, value string")
    tp.send_to_folder(df, path)
    assert rows(tp.read_folder(spark, path), "topic", "key", "value") == rows(df)
    assert tp.batch_options("h:1", ["a", "b"], 1, 2)["subscribe"] == "a,b"


def test_processed_stream_files_are_archived(spark):
    source, archive, target = (session.new_path(spark, n) for n in ("in", "archive", "out"))
    spark.range(30).repartition(3).write.parquet(source)
    stream = ingest.file_stream(spark, source, spark.range(1).schema, 1, archive)
    ingest.run_once(stream, session.new_path(spark, "cp"), ingest.insert_batch(target, ["id"]))
    moved = [f for _, _, names in os.walk(archive) for f in names if f.endswith(".parquet")]
    left = [f for f in os.listdir(source) if f.endswith(".parquet")]
    assert len(moved) >= 1 and len(moved) + len(left) == 3
    assert ingest.read_target(spark, target, spark.range(1).schema).count() == 30


def test_late_rows_lose_in_the_stream(spark, rows):
    source, target, feed = (session.new_path(spark, n) for n in ("in", "state", "feed"))
    schema = "k long, ts long, v string"
    steps = [[(1, 5, "a"), (2, 5, "b")], [(1, 4, "late"), (2, 6, "B")], [(3, 1, "c")]]
    checkpoint = session.new_path(spark, "cp")
    for data in steps:
        df = spark.createDataFrame(data, schema)
        df.coalesce(1).write.mode("append").parquet(source)
        ingest.run_once(ingest.file_stream(spark, source, df.schema), checkpoint, ingest.merge_batch(target, ["k"], "ts", changes=feed))
    assert rows(spark.read.parquet(f"{target}/version=2")) == [(1, 5, "a"), (2, 6, "B"), (3, 1, "c")]
    assert rows(spark.read.parquet(feed), "k", "CDC_CODE", ingest.VERSION) == [(1, "I", 0), (2, "I", 0), (2, "U", 1), (3, "I", 2)]


def test_a_new_checkpoint_loses_and_doubles_nothing(spark, rows):
    target, state, schema = session.new_path(spark, "out"), session.new_path(spark, "state"), "k long, ts timestamp, v string"
    day = lambda k, d, v: (k, datetime(2024, 1, d), v)
    steps = [[day(1, 1, "a"), day(2, 1, "b"), day(2, 1, "a")], [day(2, 1, "b"), day(3, 2, "c"), day(1, 1, "z")]]
    for data in steps:
        source = session.new_path(spark, "in")
        df = spark.createDataFrame(data, schema)
        df.coalesce(1).write.parquet(source)
        for write in (ingest.insert_batch(target, ["k"], ["ts"], "ts"), ingest.merge_batch(state, ["k"], "ts")):
            ingest.run_once(ingest.file_stream(spark, source, df.schema), session.new_path(spark, "cp"), write)
    assert rows(ingest.read_target(spark, target, df.schema), "k", "v") == [(1, "a"), (2, "a"), (3, "c")]
    assert rows(spark.read.parquet(f"{state}/version=1"), "k") == [(1,), (2,), (3,)]


def test_a_removed_key_is_a_delete_in_the_feed(spark, rows):
    source, target, feed, checkpoint = (session.new_path(spark, n) for n in ("in", "state", "feed", "cp"))
    for data in ([(1, 1, "a"), (2, 1, "b")], [(1, 2, "gone"), (2, 2, "c")]):
        df = spark.createDataFrame(data, "k long, ts long, v string")
        df.coalesce(1).write.mode("append").parquet(source)
        write = ingest.merge_batch(target, ["k"], "ts", changes=feed, gone=F.col("v") == "gone")
        ingest.run_once(ingest.file_stream(spark, source, df.schema), checkpoint, write)
    assert rows(spark.read.parquet(feed), "k", "CDC_CODE", ingest.VERSION) == [(1, "D", 1), (1, "I", 0), (2, "I", 0), (2, "U", 1)]


def test_delete_that_empties_a_partition(spark, rows):
    path = session.new_path(spark, "parts")
    spark.createDataFrame([(1, "a b", 1), (2, "a b", 2), (3, "c", 3)], "k long, p string, v long").write.partitionBy("p").parquet(path)
    source = spark.createDataFrame([(1, "a b", 0), (2, "a b", 0), (3, "c", 9)], "k long, p string, v long")
    sn.merge_partitions(spark, path, source, ["k", "p"], ["p"], delete_when=lambda t, s: s["v"] == 0)
    assert rows(spark.read.schema(source.schema).parquet(path), "k", "p", "v") == [(3, "c", 9)]


def test_step_log(spark, rows):
    path = session.new_path(spark, "log")
    with pytest.raises(RuntimeError):
        with runlog.StepLog(spark, path, "T", "a"):
            raise RuntimeError("broken")
    with runlog.StepLog(spark, path, "T", "b") as log:
        log.warn("odd")
    assert rows(spark.read.parquet(path), "step", "status", "message") == [("a", "FAILED", "RuntimeError: broken"), ("b", "WARNING", "odd")]


def test_quota_prefix_does_not_skip_a_batch_that_does_not_fit(spark, rows):
    log = spark.createDataFrame([("a", 1, 1, 60, False), ("a", 2, 2, 60, False), ("a", 3, 3, 10, False), ("b", 4, 1, 30, False), ("b", 5, 2, 30, True)],
                                "topic string, batch_number long, creation_time long, read_record_count long, is_handle boolean")
    priority = spark.createDataFrame([("a", 2, 100, True), ("b", 1, 1000, True)], "topic string, priority long, topic_quota long, is_active boolean")
    out = sh.allocate_batches(log, priority, 1000)
    assert rows(out, "topic", "batch_number", "task_rows") == [("a", 1, 60), ("b", 4, 90)]


def test_rate_limit_keeps_all_rows_of_an_allowed_unit(spark, rows):
    df = spark.createDataFrame([("m", 1, 5), ("m", 1, 9), ("m", 2, 6), ("n", 3, 1)], "g string, u long, at long")  # n has no quota
    quota = spark.createDataFrame([("m", 1)], "g string, quota long")
    assert rows(er.rate_limit(df, quota, "g", ["u"], ["at"])) == [("m", 1, 5), ("m", 1, 9)]
    big = spark.createDataFrame([("m", 5000)], "g string, quota long")
    assert rows(er.rate_limit(df, big, "g", ["u"], ["at"]), "u") == [(1,), (1,), (2,)]


def test_set_comparison(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "x")], "g long, m string")
    b = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "z")], "g long, m string")
    assert rows(er.same_members(a, b, ["g"], ["m"])) == [(1, True, True, True), (2, False, False, True), (3, False, True, False)]


def test_work_dir_is_the_cluster_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert session.work_dir(spark) == configured
