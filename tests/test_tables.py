"""Sources, sinks, upsert and clustered layout."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalyst.contracts import struct
from medalyst.session import shared_dir, workspace
from medalyst.sources import readers, writers
from medalyst.sources.layout import clustered, with_cluster_value
from medalyst.sources.upsert import UpsertTable
from medalyst.streaming import jobs


def test_scratch_folder_follows_the_session(spark):
    assert workspace(spark, "a").startswith(shared_dir(spark)) and workspace(spark, "a") != workspace(spark, "a")


def test_malformed_csv_fields_become_null(spark, rows):
    path = workspace(spark, "csv")
    spark.createDataFrame([("id,n",), ("a,1",), ("b,oops",)], "value string").coalesce(1).write.text(path)
    got = readers.read_csv(spark, path, struct("id string, n int"), keep_corrupt=True)
    assert rows(got, "id", "n", readers.CORRUPT) == [("a", 1, None), ("b", None, "b,oops")]


def test_required_tables_are_all_named(spark):
    with pytest.raises(LookupError, match="nope_a, nope_b"):
        readers.require_tables(spark, ["nope_a", "nope_b"])


def test_jdbc_reads_can_be_split():
    plain = readers.jdbc_options("jdbc:x", "s.t")
    split = readers.jdbc_options("jdbc:x", "s.t", {"column": "id", "lower": 0, "upper": 9, "partitions": 4}, user="u")
    assert "numPartitions" not in plain
    assert (split["partitionColumn"], split["numPartitions"], split["user"]) == ("id", "4", "u")


def test_literal_rows_keep_types(spark):
    assert readers.literal_rows(spark, [("t", None, "SUCCESS", None)]).schema["ingestion_ts"].dataType == T.TimestampType()


def test_upsert_sequence(spark, rows):
    t = UpsertTable(spark, workspace(spark, "up"), "k", buckets=4)
    frame = lambda *r: spark.createDataFrame(list(r), "k string, ts int, v string")
    assert not t.exists()
    t.merge(frame(("a", 1, "a1"), ("b", 1, "b1")))
    t.merge(frame(("a", 2, "a2"), ("c", 1, "c1")))
    want = [("a", 2, "a2"), ("b", 1, "b1"), ("c", 1, "c1")]
    assert rows(t.read(), "k", "ts", "v") == want
    t.merge(frame(("a", 2, "a2"), ("c", 1, "c1")))                       # same batch again
    assert rows(t.read(), "k", "ts", "v") == want
    t.merge(frame(("a", 0, "late"), ("b", 9, "b9")), newest_by="ts")     # late older row loses
    assert rows(t.read(), "k", "ts", "v") == [("a", 2, "a2"), ("b", 9, "b9"), ("c", 1, "c1")]


def test_upsert_null_keys(spark, rows):
    frame = spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int")
    strict, lax = (UpsertTable(spark, workspace(spark, "up"), "k", buckets=2) for _ in range(2))
    for _ in range(2):
        strict.merge(frame)
        lax.merge(frame, keep_null_keys=True)
    assert rows(strict.read(), "k") == [("a",)]
    assert rows(lax.read(), "k") == [("a",), (None,), (None,)]           # a NULL key matches nothing


def test_upsert_writes_only_touched_buckets_and_ignores_failed_versions(spark):
    t = UpsertTable(spark, workspace(spark, "up"), "k", buckets=16)
    t.merge(spark.range(200).select(F.col("id").alias("k"), F.lit(0).alias("v")))
    assert len(t.merge(spark.createDataFrame([(5, 1)], "k long, v int"))) == 1
    spark.createDataFrame([(7, 99, 0)], "k long, v int, upsert_bucket int").write.partitionBy("upsert_bucket").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{t.root}/upsert_version=3")
    assert t.read().count() == 200 and t.read().agg(F.sum("v")).first()[0] == 1
    assert t.merge(spark.createDataFrame([(5, 2)], "k long, v int")) and t.read().agg(F.sum("v")).first()[0] == 2


def test_upsert_checks_columns_and_buckets(spark, rows):
    root = workspace(spark, "up")
    t = UpsertTable(spark, root, "k", buckets=8)
    t.merge(spark.range(20).select(F.col("id").alias("k"), F.lit("x").alias("a")))
    new = spark.createDataFrame([(3, "y", 1), (400, "z", 2)], "k long, a string, b int")
    with pytest.raises(ValueError, match="new"):
        t.merge(new)
    with pytest.raises(ValueError, match="missing"):
        t.merge(spark.createDataFrame([(3,)], "k long"))
    with pytest.raises(ValueError, match="types"):
        t.merge(spark.createDataFrame([(3, 1)], "k long, a int"))
    with pytest.raises(ValueError, match="8 buckets"):
        UpsertTable(spark, root, "k", buckets=64).merge(new)
    t.merge(new, widen=True)
    assert t.read().columns == ["k", "a", "b"] and t.read().count() == 21
    assert rows(t.read().where("k IN (3, 4, 400)")) == [(3, "y", 1), (4, "x", None), (400, "z", 2)]
    t.merge(spark.createDataFrame([(4, 9)], "k long, b int"), widen=True)
    assert rows(t.read().where("k = 4")) == [(4, None, 9)]


def test_many_merges_keep_few_manifests_and_vacuum(spark):
    t = UpsertTable(spark, workspace(spark, "up"), "k", buckets=2)
    for i in range(25):
        t.merge(spark.createDataFrame([(i % 3, i)], "k long, v int"))
    assert len(t._numbers(f"{t.root}/manifest")) == 20
    assert t.read().agg(F.sum("v")).first()[0] == 22 + 23 + 24
    assert len(t.vacuum()) >= 23 and t.vacuum() == [] and t.read().count() == 3


def test_text_clusters_do_not_stop_at_a_prefix(spark):
    df = spark.range(5000).select(F.concat(F.lit("ORD-000000000"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("a"), F.lit(1).alias("b"))
    cells = with_cluster_value(df, ["a", "b"]).groupBy("_z").count()
    assert cells.count() > 30 and cells.agg(F.max("count")).first()[0] < 500


def test_clustered_files_are_narrow_in_both_columns(spark):
    path = workspace(spark, "z")
    df = spark.range(20_000).select((F.col("id") * 7919 % 1000).alias("a"), F.concat(F.lit("n"), F.lpad((F.col("id") * 104729 % 1000).cast("string"), 3, "0")).alias("b"))
    writers.replace(clustered(df, ["a", "b"], files=16), path)
    spans = spark.read.parquet(path).groupBy("_metadata.file_path").agg((F.max("a") - F.min("a")).alias("sa"), F.min("b").alias("lo"), F.max("b").alias("hi"))
    got = spans.agg(F.avg("sa").alias("sa"), F.avg(F.substring("hi", 2, 3).cast("int") - F.substring("lo", 2, 3).cast("int")).alias("sb"), F.count("*").alias("n")).first()
    assert got["n"] > 8 and got["sa"] < 500 and got["sb"] < 500
    assert spark.read.parquet(path).count() == 20_000


def test_a_larger_table_gets_more_clustered_files(spark, monkeypatch):
    from medalyst.sources import layout

    monkeypatch.setattr(layout, "FILE_BYTES", 100_000, raising=False)
    # half of the rows agree in both columns
    df = spark.range(20_000).select("id", *[F.when(F.col("id") % 2 == 0, F.col("id") * k % 1000).alias(c) for c, k in (("a", 7919), ("b", 104729))],
                                    F.lpad(F.lit("x"), 100, "x").alias("text"), F.array("id").alias("held"))
    for n in (5_000, 20_000):
        path = workspace(spark, "z")
        writers.replace(clustered(df.where(F.col("id") < n), ["a", "b"], files=2), path)
        stored = spark.read.parquet(path)
        assert stored.groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0] < 2_000
        assert stored.select("id").distinct().count() == stored.count() == n


def test_cluster_value_keeps_nulls(spark):
    df = spark.createDataFrame([(None, "x"), (1.0, None)], "a double, b string")
    assert with_cluster_value(df, ["a", "b"]).where("_z IS NULL").count() == 0


def test_date_overwrite_leaves_other_dates(spark, rows):
    path = workspace(spark, "dates")
    df = spark.sql("SELECT DATE(d) AS d, v FROM VALUES ('2024-01-01', 1), ('2024-01-02', 2) AS t(d, v)")
    writers.replace_dates(df, path, "d")
    writers.replace_dates(df.where("v = 2").withColumn("v", F.lit(5)), path, "d")
    assert [r[0] for r in rows(spark.read.parquet(path), "v")] == [1, 5]


def test_stream_drops_late_and_repeated_rows(spark, rows):
    folder, out = workspace(spark, "in"), workspace(spark, "out")
    schema = "id long, ts timestamp, city string"
    first = spark.sql("SELECT * FROM VALUES (1L, TIMESTAMP '2024-01-01 10:05', 'x'), (1L, TIMESTAMP '2024-01-01 10:05', 'x'), (2L, TIMESTAMP '2024-01-01 15:00', 'x') AS t(id, ts, city)")
    late = spark.sql("SELECT 3L AS id, TIMESTAMP '2024-01-01 10:30' AS ts, 'x' AS city UNION ALL SELECT 4L, TIMESTAMP '2024-01-01 20:00', 'x'")
    run = lambda: jobs.run_available(jobs.deduplicated(jobs.file_stream(spark, folder, T._parse_datatype_string(schema), "parquet"), ["id"], "ts", "1 hour"),
                                     f"{out}/c", path=f"{out}/d")
    first.write.mode("append").parquet(folder)
    run()
    late.write.mode("append").parquet(folder)
    run()
    assert rows(spark.read.parquet(f"{out}/d"), "id") == [(1,), (2,), (4,)]


def test_window_counts_close_after_the_watermark(spark, rows):
    folder, out = workspace(spark, "in"), workspace(spark, "out")
    schema = T._parse_datatype_string("ts timestamp, city string")
    for hour in (1, 2, 9):
        spark.sql(f"SELECT TIMESTAMP '2024-01-01 0{hour}:15' AS ts, 'x' AS city").write.mode("append").parquet(folder)
        stream = jobs.windowed_demand(jobs.file_stream(spark, folder, schema, "parquet"), "ts", ["city"])
        jobs.run_available(stream, f"{out}/c", path=f"{out}/d")
    assert [r[0].hour for r in rows(spark.read.parquet(f"{out}/d"), "window_start")] == [1, 2]


def test_a_batch_of_one_day_touches_that_day_only(spark, rows):
    t = UpsertTable(spark, workspace(spark, "up"), "k", buckets=2, date="at")
    frame = lambda *r: spark.createDataFrame(list(r), "k long, at string, v int").withColumn("at", F.col("at").cast("timestamp"))
    days = [(i, f"2024-01-{1 + i % 5:02d} 10:00:00", 0) for i in range(50)]
    first = t.merge(frame(*days, (90, None, 0)))
    assert {cell.split("/")[0] for cell in first} == {*[f"upsert_date=2024-01-{d:02d}" for d in range(1, 6)], "upsert_date=none"}
    held = t.manifest().current
    touched = t.merge(frame((0, "2024-01-01 23:00:00", 7), (100, "2024-01-01 00:00:00", 7)))
    assert {cell.split("/")[0] for cell in touched} == {"upsert_date=2024-01-01"}
    now = t.manifest().current
    assert {c for c in held if now[c] != held[c]} <= set(touched) and t._cells(t._data(2)) == touched
    assert rows(t.read().where("v = 7 OR k IN (5, 90)"), "k", "v") == [(0, 7), (100, 7), (5, 0), (90, 0)]
    assert t.read().count() == 52 and t.read("2024-01-01", "2024-01-01").count() == 11 and t.read("2030-01-01").where("v = 7").count() == 0
    assert t.merge(frame((90, None, 3))) and rows(t.read().where("k = 90"), "v") == [(3,)]
