"""Landing files: each once, committed with their tracker rows, bad lines kept, dates pruned."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalyst.operators.quality import batch_slice
from medalyst.sources.ingest import Bronze

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DoubleType()), T.StructField("at", T.TimestampType())])


@pytest.fixture()
def bronze(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return Bronze(spark, "orders", str(folder), SCHEMA, str(tmp_path / "bronze"))


def land(bronze, *lines, header="id,amount,at"):
    path = os.path.join(bronze.folder, f"{uuid.uuid4().hex}.csv")
    with open(path, "w") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return path


def test_each_file_once(bronze):
    land(bronze, "1,2.5,2024-01-01 10:00:00", "2,,2024-01-02 10:00:00")
    assert bronze.waiting().count() == 1 and bronze.run() == "SUCCESS" and bronze.run() == "NOTHING_NEW"
    land(bronze, "3,1,2024-01-03 00:00:00")
    assert bronze.waiting().count() == 1 and bronze.run() == "SUCCESS" and bronze.waiting().count() == 0
    assert sorted((r["id"], r["amount"]) for r in bronze.read().collect()) == [(1, 2.5), (2, None), (3, 1.0)]
    log = bronze.tracker().collect()
    assert sorted((r["status"], r["n_rows"], r["n_rejected"], r["cause"]) for r in log) == [("SUCCESS", 1, 0, None), ("SUCCESS", 2, 0, None)]
    assert {r["file_path"] for r in log} == {r["source_file"] for r in bronze.read().select("source_file").collect()}


def test_lines_that_do_not_fit_are_kept_as_they_stood(bronze):
    land(bronze, "1,2.5,2024-01-01 10:00:00", "x,1,2024-01-01 10:00:00", "2,abc,2024-01-01 10:00:00", "3,1", "4,1,2024-01-01 10:00:00,more", "5,,")
    assert bronze.run() == "SUCCESS"
    assert sorted(r["id"] for r in bronze.read().collect()) == [1, 5]
    assert sorted(r["line"] for r in bronze.rejected().collect()) == ["2,abc,2024-01-01 10:00:00", "3,1", "4,1,2024-01-01 10:00:00,more", "x,1,2024-01-01 10:00:00"]
    assert bronze.tracker().first()["n_rejected"] == 4


def test_a_crash_between_data_and_tracker(bronze, monkeypatch):
    land(bronze, "1,1,2024-01-01 10:00:00")
    bronze.run()
    land(bronze, "2,2,2024-01-02 10:00:00")

    def crash(self, rows, number):
        assert rows.count() == 1                        # the data is written, the tracker is not
        raise OSError("the executor went away")

    with monkeypatch.context() as broken:
        broken.setattr(Bronze, "write_tracker", crash)
        assert bronze.run() == "FAILED"
    assert [r["id"] for r in bronze.read().collect()] == [1] and bronze.waiting().count() == 1
    failed = bronze.tracker().where("status = 'FAILED'").collect()
    assert len(failed) == 1 and "the executor went away" in failed[0]["cause"] and failed[0]["file_path"] == "BATCH_FAILURE"
    assert bronze.run() == "SUCCESS"
    assert sorted(r["id"] for r in bronze.read().collect()) == [1, 2] and bronze.tracker().where("status = 'SUCCESS'").count() == 2


def test_slices_read_only_their_dates(bronze, capsys):
    land(bronze, *[f"{i},1,2024-01-{i:02d} 12:00:00" for i in range(1, 29)])
    bronze.run(loaded_at=F.col("at"))
    part = batch_slice(bronze.read(), "20240110000000", "20240112120000")
    assert sorted(r["id"] for r in part.collect()) == [10, 11]
    capsys.readouterr()
    part.explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if line.startswith("PartitionFilters")]
    assert any("bronze_date" in line and "2024-01-10" in line and "2024-01-12" in line for line in filters), filters
    whole = bronze.read().drop("bronze_date")
    assert sorted(map(tuple, batch_slice(whole, "20240110000000", "20240112120000").collect())) == sorted(map(tuple, part.drop("bronze_date").collect()))


def test_nothing_landed(spark, tmp_path):
    bronze = Bronze(spark, "orders", str(tmp_path / "missing"), SCHEMA, str(tmp_path / "bronze"))
    assert bronze.run() == "NOTHING_NEW" and bronze.waiting().count() == 0 and bronze.read().count() == 0 and bronze.tracker().count() == 0


def test_small_batches_of_files(spark, bronze):
    for i in range(5):
        land(bronze, f"{i},1,2024-01-01 10:00:00")
    few = Bronze(spark, "orders", bronze.folder, SCHEMA, bronze.root, files_per_batch=2)
    assert few.run() == "SUCCESS"
    assert few.read().count() == 5 and few.loaded().select("ingest_batch").distinct().count() == 3
