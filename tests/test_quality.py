"""Gate, quarantine and silver on frames with NULL, duplicate and late rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from medalyst.contracts import CONTRACTS, ORDERS, SUPPORT
from medalyst.operators import quality
from medalyst.operators.dedupe import duplicate_keys, latest_per_key
from medalyst.plans.entities import standardised, to_silver

AS_OF = datetime(2024, 1, 10)
T0 = "TIMESTAMP '2024-01-09 08:00:00'"


@pytest.fixture(scope="module")
def orders(spark):
    return spark.sql(f"""SELECT id AS order_id, v AS order_value, {T0} AS created_ts, {T0} + make_interval(0, 0, 0, 0, p) AS promised_ts,
        s AS payment_status, ' london ' AS city, {T0} + make_interval(0, 0, 0, 0, g) AS ingestion_ts, {T0} AS bronze_ingestion_ts, f AS source_file
        FROM VALUES ('a', 10.0D, 1, 'Paid', 1, 'x1'), ('a', 12.0D, 1, 'Paid', 2, 'x2'), ('b', -1.0D, 1, 'Paid', 1, 'x1'), ('b', 5.0D, 1, 'Paid', 2, 'x2'),
        ('c', NULL, 1, 'Odd', 1, 'x1'), (NULL, 7.0D, 1, NULL, 1, 'x1'), ('d', 3.0D, -1, 'Failed', 1, 'x1') AS t(id, v, p, s, g, f)""")


def _results(df, **kw):
    return {r["check_name"]: r for r in quality.check_results(df, ORDERS, AS_OF, **kw).collect()}


def test_rules_count_only_certain_failures(orders):
    got = {k: r["failed_rows"] for k, r in _results(orders).items()}
    assert got["order_id_not_null"] == 1
    assert got["order_value_positive"] == 1                # NULL value is not a failure
    assert got["promised_after_created"] == 1
    assert got["payment_status_domain_valid"] == 1         # NULL status is not a failure
    assert got["order_id_unique"] == 2                     # keys a and b
    assert got["schema_exact_match"] == 1                  # columns are missing
    assert got["data_freshness_within_2_days"] == 0 and got["volume_reasonable_min_threshold"] == 1
    assert "accepted_after_created" not in got             # its column is absent


def test_status_and_table_name(orders):
    r = _results(orders, table="  Orders_RAW ")["order_value_positive"]
    assert (r["table_name"], r["status"], r["severity"], r["total_rows"]) == ("orders_raw", "FAIL", "ERROR", 7)
    assert quality.clean_table_name(None) == "unknown_table"


def test_empty_table_is_stale_and_empty(spark):
    got = _results(spark.createDataFrame([], ORDERS.bronze))
    assert got["table_not_empty"]["failed_rows"] == 1 and got["data_freshness_within_2_days"]["failed_rows"] == 1
    assert got["order_id_not_null"]["failed_rows"] == 0 and got["schema_exact_match"]["failed_rows"] == 0


def test_freshness_counts_whole_days(spark, orders):
    exact = orders.withColumn("bronze_ingestion_ts", F.lit("2024-01-07").cast("timestamp"))
    assert _results(exact)["data_freshness_within_2_days"]["failed_rows"] == 1     # 3 days
    assert _results(exact.withColumn("bronze_ingestion_ts", F.lit("2024-01-07 00:00:01").cast("timestamp"))
                    )["data_freshness_within_2_days"]["failed_rows"] == 0          # 2 days and a bit


def test_undecided_rows_by_mode(orders, rows):
    flagged = quality.with_validity(orders, ORDERS, AS_OF)
    assert rows(quality.quarantined(flagged, undecided_is_bad=False), "order_id") == [("b",), ("d",), (None,)]
    assert rows(quality.quarantined(flagged), "order_id") == [("b",), ("c",), ("d",), (None,)]


def test_bad_version_removes_the_key_or_only_the_row(orders, rows):
    flagged = quality.with_validity(orders, ORDERS, AS_OF)
    assert rows(quality.accepted(flagged, "order_id"), "order_id") == [("a",), ("a",)]
    assert rows(quality.accepted(flagged, "order_id", by_key=False), "order_id") == [("a",), ("a",), ("b",)]
    # an undecided row and a row without a key pass when asked to
    assert rows(quality.accepted(flagged, "order_id", undecided_is_bad=False), "order_id") == [("a",), ("a",), ("c",), (None,)]


def test_split_covers_the_input(orders):
    flagged = quality.with_validity(orders, ORDERS, AS_OF)
    good = quality.accepted(flagged, "order_id", by_key=False).count()
    assert good + quality.quarantined(flagged).count() == orders.count()


def test_silver_keeps_newest_version_and_casing(orders, rows):
    bad = quality.quarantined(quality.with_validity(orders, ORDERS, AS_OF))
    silver = to_silver(orders, ORDERS, bad)
    assert rows(silver, "order_id", "order_value", "city", "record_source") == [("a", 12.0, "LONDON", "x2"), (None, 7.0, "LONDON", "x1")]


def test_latest_row_tiebreak_is_stable(spark, rows):
    df = spark.createDataFrame([("k", 1, 5), ("k", 1, 9), (None, 3, 1), (None, 4, 2)], "k string, ts int, t int")
    assert rows(latest_per_key(df, ["k"], "ts", ["t"])) == [("k", 1, 9), (None, 4, 2)]
    assert rows(duplicate_keys(df, ["k"])) == [("k", 2), (None, 2)]


def test_standardised_casts_text_and_drops_garbage(spark):
    raw = spark.createDataFrame([("t1", " app ", "high ", "4", "oops")], "ticket_id string, issue_category string, priority_level string, csat_score string, compensation_amount string")
    r = standardised(raw, SUPPORT).first()
    assert (r["issue_category"], r["priority_level"], r["csat_score"], r["compensation_amount"]) == ("App", "HIGH", 4, None)


def test_support_without_resolution_is_valid(spark):
    df = spark.sql("SELECT 't' AS ticket_id, TIMESTAMP '2024-01-01' AS created_ts, CAST(NULL AS TIMESTAMP) AS resolution_ts")
    assert quality.with_validity(df, SUPPORT, AS_OF).first()["is_valid"] is True


def test_batch_slice_is_half_open(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2024-01-01'), (TIMESTAMP '2024-01-02') AS t(bronze_ingestion_ts)")
    assert quality.batch_slice(df, "20240101000000", "20240102000000").count() == 1
    assert quality.batch_slice(df, "", "").count() == 2


def test_drift_report(spark, orders):
    names = {(r["column_name"], r["drift"]) for r in quality.drift_report(orders.withColumn("extra", F.lit(1)), ORDERS.bronze.names).collect()}
    assert ("extra", "unexpected") in names and ("device_type", "missing") in names
    assert quality.type_drift(orders.withColumn("order_value", F.lit(1)), ORDERS)["order_value"] == ("double", "int")


def test_health_score_of_nothing(spark):
    empty = spark.createDataFrame([], "a string, s string")
    assert quality.health_score(empty, ["a"], "s", ["ok"]).first()["overall_health_pct"] is None


@pytest.mark.parametrize("entity", list(CONTRACTS))
def test_every_rule_runs_on_its_contract(spark, entity):
    contract = CONTRACTS[entity]
    empty = spark.createDataFrame([], contract.bronze)
    assert quality.check_results(empty, contract, AS_OF).count() == len(contract.rules) + 5
    assert quality.with_validity(empty, contract, AS_OF).count() == 0
    assert set(to_silver(empty, contract).columns) == set(contract.silver_columns)
