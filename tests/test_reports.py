"""Facts, reports and statistics on small frames and known answers."""

import math

import pytest
from pyspark.sql import functions as F

from medalyst.functions import distributions as dist
from medalyst.operators import forest, ml, series, stats
from medalyst.plans import delivery, subscribers


def test_margin_of_a_free_order_is_null(spark):
    o = spark.sql("SELECT 'o' AS order_id, 'c' AS city, TIMESTAMP '2024-01-01' AS created_ts, 0.0D AS order_value")
    p = spark.sql("SELECT 'o' AS order_id, 1.0D AS base_fare, 1.0D AS surge_multiplier, 2.0D AS service_fee, 0.5D AS discount_amount")
    s = spark.sql("SELECT * FROM VALUES ('o', 1.0D), ('o', 2.0D) AS t(order_id, compensation_amount)")
    r = delivery.financials(o, p, s).first()
    assert (r["total_refunded_amount"], r["net_revenue"], r["order_margin_percentage"]) == (3.0, -1.5, None)


def test_rider_without_time_online(spark):
    mart = spark.sql("SELECT 'd' AS delivery_id, 'r' AS rider_id, DATE '2024-01-01' AS delivery_date, 1 AS is_on_time_flag, 2.0D AS distance_km_actual")
    shifts = spark.sql("SELECT 'r' AS rider_id, TIMESTAMP '2024-01-01 09:00' AS shift_start_ts, 8.0D AS scheduled_hours, TIMESTAMP '2024-01-01 09:00' AS actual_login_ts, TIMESTAMP '2024-01-01 09:00' AS actual_logout_ts")
    r = delivery.rider_daily_summary(shifts, mart).first()
    assert r["deliveries_per_hour"] is None and r["on_time_rate"] == 1.0


def test_shift_rows_repeat_only_when_asked(spark):
    riders = spark.sql("SELECT 'r' AS rider_id, 'c' AS city, 'bike' AS vehicle_type")
    shifts = spark.sql("SELECT 's' AS shift_id, 'r' AS rider_id, TIMESTAMP '2024-01-01' AS shift_start_ts, TIMESTAMP '2024-01-01' AS actual_login_ts, TIMESTAMP '2024-01-01 02:00' AS actual_logout_ts, 2.0D AS scheduled_hours, true AS late_start_flag, false AS overtime_flag")
    pings = spark.sql("SELECT * FROM VALUES ('p1', 'r', 'd1', 10), ('p2', 'r', 'd2', 30) AS t(ping_id, rider_id, delivery_id, speed_kmh)")
    assert delivery.rider_productivity(riders, shifts, pings).count() == 1
    assert delivery.rider_productivity(riders, shifts, pings, per_delivery=True).count() == 2


def test_friction_with_unknown_rating(spark):
    o = spark.sql("SELECT * FROM VALUES ('a', 'success'), ('b', 'cancel'), ('c', NULL) AS t(order_id, order_status)").selectExpr("*", "'u' AS customer_id", "'x' AS city", "TIMESTAMP '2024-01-01' AS created_ts")
    d = spark.sql("SELECT 'a' AS order_id, CAST(NULL AS INT) AS customer_rating, 'success' AS delivery_status")
    s = spark.sql("SELECT 'z' AS order_id, 't' AS ticket_id, 'late' AS issue_category, 1.0D AS compensation_amount, 3 AS csat_score")
    assert {r["order_id"]: r["is_friction_event_flag"] for r in delivery.customer_experience(o, d, s).collect()} == {"a": 0, "b": 1, "c": 0}


def test_freshness_of_empty_stage(spark):
    full = spark.sql("SELECT TIMESTAMP '2024-01-01' AS ts")
    r = delivery.freshness([("src", full, "ts"), ("out", full.limit(0), "ts")]).first()
    assert r["out"] is None and r["e2e_latency_min"] == 0.0


def _users(spark, values):
    return spark.createDataFrame(values, "plan_price double, watch_mins double, last string").selectExpr("plan_price", "watch_mins", "DATE(last) AS last_active_date")


def test_funnel_without_payers_or_active_users(spark):
    got = {r["stage"]: r for r in subscribers.funnel(_users(spark, [(0.0, 5.0, None), (0.0, 0.0, None)]), "2024-09-01").collect()}
    assert [got[s]["users"] for s in subscribers.FUNNEL] == [2, 0, 0, 0]
    assert got["active"]["step_rate_pct"] is None and got["high_engagement"]["step_change_pct"] == 100.0


def test_growth_over_a_single_month_and_gap(spark, rows):
    df = spark.sql("SELECT k, DATE(m) AS month, n FROM VALUES ('a', '2024-01-01', 4), ('a', '2024-03-01', 6), ('b', '2024-01-01', 9) AS t(k, m, n)")
    assert rows(df.withColumn("c", subscribers.pct_change("n", ["month"], ["k"])), "k", "n", "c") == [("a", 4, 0.0), ("a", 6, 50.0), ("b", 9, 0.0)]


@pytest.mark.parametrize("fn,args,want", [
    (dist.normal_two_sided, (1.959963984540054,), 0.05), (dist.chi2_tail, (3.841458820694124, 1), 0.05), (dist.chi2_tail, (18.307038053275146, 10), 0.05),
    (dist.t_two_sided, (2.2281388519649385, 10), 0.05), (dist.f_tail, (4.102821015303716, 2, 10), 0.05), (dist.ks_tail, (0.0, 10, 10), 1.0),
    (dist.t_two_sided, (0.0, 5), 1.0), (dist.chi2_tail, (0.0, 3), 1.0)])
def test_tail_probabilities(fn, args, want):
    assert fn(*args) == pytest.approx(want, rel=1e-8)


@pytest.mark.parametrize("cells,want", [((10, 20, 30, 40), 0.44642857142857), ((25, 25, 25, 25), 0.0)])
def test_continuity_corrected_chi_square(spark, cells, want):
    pairs = [(a, b) for (a, b), n in zip([(True, True), (True, False), (False, True), (False, False)], cells) for _ in range(n)]
    df = spark.createDataFrame(pairs, "a boolean, b boolean")
    assert stats.chi_square_2x2(df, F.col("a"), F.col("b")).first()["chi2"] == pytest.approx(want)


def test_chi_square_with_an_empty_row_is_undefined(spark):
    df = spark.createDataFrame([(True, True), (True, False)], "a boolean, b boolean")
    r = stats.chi_square_2x2(df, F.col("a"), F.col("b")).first()
    assert r["chi2"] is None and r["p_value"] is None


def test_two_proportions_known_value_and_small_arms(spark):
    rows = [(arm, i < hits) for arm, hits in ((True, 60), (False, 40)) for i in range(100)]
    df = spark.createDataFrame(rows, "arm boolean, won boolean")
    r = stats.two_proportions(df, F.col("arm"), F.col("won")).first()
    assert r["z_stat"] == pytest.approx(2.8284271247) and r["p_value"] == pytest.approx(0.004677734981, rel=1e-6) and r["lift_pct"] == pytest.approx(50)
    assert (r["low_treatment"], r["high_treatment"]) == (pytest.approx(0.502002587), pytest.approx(0.690598714))
    small = stats.two_proportions(df, F.col("arm"), F.col("won"), min_arm=101).first()
    assert r["enough"] and not small["enough"] and small["z_stat"] == r["z_stat"]


def test_paired_t_known_value(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 3.0), (4.0, 7.0)], "a double, b double")
    r = stats.paired_t(df, "a", "b").first()
    assert (r["mean_diff"], r["t_stat"]) == (1.5, pytest.approx(2.3237900077)) and r["p_value"] == pytest.approx(0.10275, abs=1e-4)


def test_anova_matches_direct_least_squares(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [(f"a{i % 3}", f"b{(i // 3) % 2}", float(i % 3 + 2 * ((i // 3) % 2) + rng.normal())) for i in range(97)]
    got = {r["term"]: r for r in stats.two_way_anova(spark.createDataFrame(rows, "a string, b string, y double"), "a", "b", "y").collect()}
    y = np.array([r[2] for r in rows])
    da = np.array([[r[0] == v for v in ("a1", "a2")] for r in rows], float)
    db = np.array([[r[1] == "b1"] for r in rows], float)
    one = np.ones((len(rows), 1))

    def rss(*parts):
        x = np.hstack(parts)
        return float(np.sum((y - x @ np.linalg.lstsq(x, y, rcond=None)[0]) ** 2))

    inter = np.hstack([da[:, [0]] * db, da[:, [1]] * db])
    main, full = rss(one, da, db), rss(one, da, db, inter)
    assert got["a"]["sum_sq"] == pytest.approx(rss(one, db) - main)
    assert got["b"]["sum_sq"] == pytest.approx(rss(one, da) - main)
    assert got["a:b"]["sum_sq"] == pytest.approx(main - full)
    assert got["residual"]["sum_sq"] == pytest.approx(full) and got["residual"]["dof"] == 91
    assert got["a"]["f_stat"] == pytest.approx((rss(one, db) - main) / 2 / (full / 91))


def test_least_squares_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 2)) + [100, -3]
    y = 2 + x @ [0.5, -1.5] + rng.normal(size=60)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    got = {r["term"]: r for r in stats.ols(df, F.col("y"), {"a": F.col("a"), "b": F.col("b")}).collect()}
    design = np.column_stack([np.ones(60), x])
    beta = np.linalg.lstsq(design, y, rcond=None)[0]
    cov = np.linalg.inv(design.T @ design) * np.sum((y - design @ beta) ** 2) / 57
    for i, term in enumerate(("const", "a", "b")):
        assert got[term]["coef"] == pytest.approx(beta[i], rel=1e-8) and got[term]["std_err"] == pytest.approx(math.sqrt(cov[i, i]), rel=1e-8)


def test_ks_against_brute_force(spark):
    import random

    rng = random.Random(1)
    a, b = [rng.randint(0, 12) for _ in range(80)], [rng.randint(3, 15) for _ in range(50)]
    df = spark.createDataFrame([(float(v), True) for v in a] + [(float(v), False) for v in b], "v double, first boolean")
    want = max(abs(sum(x <= t for x in a) / 80 - sum(x <= t for x in b) / 50) for t in range(16))
    assert stats.ks_two_sample(df, "v", F.col("first")).first()["d_stat"] == pytest.approx(want)


def test_forest_flags_the_outliers_of_each_group(spark):
    normal = [(i, g, float(i % 17)) for i, g in ((j, "a" if j % 2 else "b") for j in range(400))]
    df = spark.createDataFrame([*normal, (900, "a", 500.0), (901, "b", -400.0), *[(950 + i, "tiny", float(i)) for i in range(4)]], "id int, g string, v double")
    out = forest.flagged_anomalies(forest.anomaly_scores(df, "g", "id", ["v"], trees=30, sample_rows=64), "g", contamination=0.02)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == df.count()
    assert got[900]["anomaly_flag"] == 1 and got[901]["anomaly_flag"] == 1 and got[900]["anomaly_probability"] == 1.0
    assert all(got[950 + i]["anomaly_flag"] == 0 and not got[950 + i]["enough"] for i in range(4))


def test_forest_keeps_rows_with_missing_values(spark):
    rows = [(i, "ab"[i % 2], float(i % 7), float(i % 5)) for i in range(60)]
    rows += [(100, "a", None, 1.0), (101, "b", float("nan"), None), (102, None, 3.0, None), (103, None, None, 2.0), (None, "a", 1.0, 1.0), (104, "c", None, None)]
    df = spark.createDataFrame(rows, "id bigint, g string, v double, w double")
    scores = forest.anomaly_scores(df, "g", "id", ["v", "w"], trees=10, sample_rows=32)
    out = forest.flagged_anomalies(scores, "g").collect()
    assert sorted((str(r["id"]), str(r["g"])) for r in out) == sorted((str(i), str(g)) for i, g, *_ in rows)
    score = {r["id"]: r["score"] for r in scores.collect()}
    filled = spark.createDataFrame([(i, g, *((3.0, 1.0) if i == 100 else (v, w))) for i, g, v, w in rows], df.schema)
    again = {r["id"]: r["score"] for r in forest.anomaly_scores(filled, "g", "id", ["v", "w"], trees=10, sample_rows=32).collect()}
    assert score[100] == again[100] and all(s is not None and s == s for s in score.values())


def test_forest_scores_rows_in_place_or_in_chunks_alike(spark, monkeypatch, capsys):
    df = spark.createDataFrame([(i, None if i % 50 == 0 else "ab"[i % 2], float((i * 37) % 100)) for i in range(400)], "id int, g string, v double")
    placed = forest.anomaly_scores(df, "g", "id", ["v"], trees=10, sample_rows=32)
    monkeypatch.setattr(forest, "BROADCAST_BYTES", 0)
    dealt = forest.anomaly_scores(df, "g", "id", ["v"], trees=10, sample_rows=32, chunk_rows=30)
    scores = lambda df: {r["id"]: (r["g"], round(r["score"], 12)) for r in df.collect()}
    assert scores(placed) == scores(dealt) and len(scores(placed)) == 400


def test_forest_scores_do_not_depend_on_chunks(spark, monkeypatch):
    monkeypatch.setattr(forest, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame([(i, "a", float(i % 23)) for i in range(200)], "id int, g string, v double")
    one, many = ({r["id"]: r["score"] for r in forest.anomaly_scores(df, "g", "id", ["v"], trees=10, sample_rows=32, chunk_rows=n).collect()} for n in (1000, 30))
    assert one == pytest.approx(many)


def test_matching_against_brute_force(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.randint(0, 40) / 8, rng.random() < 0.4, rng.randint(0, 5)) for _ in range(60)]
    got = ml.matched_effect(spark.createDataFrame([(s, int(t), y) for s, t, y in rows], "s double, t int, y int"), "s", "t", "y").first()

    def other_mean(score, arm):
        pool = sorted({s for s, t, _ in rows if t != arm}, key=lambda s: (abs(s - score), s))
        return sum(y for s, t, y in rows if t != arm and s == pool[0]) / sum(1 for s, t, _ in rows if t != arm and s == pool[0])

    gains = [(y - other_mean(s, t)) * (1 if t else -1) for s, t, y in rows]
    treated = [g for g, (_, t, _y) in zip(gains, rows) if t]
    assert got["ate"] == pytest.approx(sum(gains) / len(gains)) and got["att"] == pytest.approx(sum(treated) / len(treated))
    assert got["n_treated"] + got["n_control"] == 60


def test_components_and_clusters_invariants(spark):
    df = spark.createDataFrame([(float(i), float(2 * i + i % 3), float((i * 7) % 10), i) for i in range(60)], "a double, b double, c double, id int")
    vectors = ml.scaled_features(df, ["a", "b", "c"])
    model, kept = ml.principal_components(vectors, 3, variance=0.95)
    table = ml.component_table(model, ["a", "b", "c"], 60, spark, kept)
    assert 1 <= kept <= 3 and sum(model.explainedVariance.toArray()) == pytest.approx(1.0)
    assert all(r[0] == pytest.approx(1.0) for r in table.groupBy("component").agg(F.sum("importance")).select("sum(importance)").collect())
    fitted, scores = ml.best_kmeans(vectors, range(2, 5))
    assert ml.assigned(fitted, vectors).count() == 60 and all(-1 <= v <= 1 for v in scores.values())


def test_short_and_flat_series_forecast_their_mean(spark):
    df = spark.sql("SELECT k, DATE(m) AS month, v AS total FROM VALUES ('short', '2024-01-01', 4.0D), ('short', '2024-02-01', 6.0D) AS t(k, m, v)")
    assert [r["forecast"] for r in series.forecast(df, ["k"]).orderBy("step").collect()] == [5.0, 5.0, 5.0]


def test_exact_line_is_continued_and_backtests_clean(spark):
    df = spark.range(12).selectExpr("'k' AS k", "add_months(DATE '2023-01-01', int(id)) AS month", "double(10 + 3 * id) AS total")
    got = series.forecast(df, ["k"]).orderBy("step").collect()
    assert [r["forecast"] for r in got] == pytest.approx([46, 49, 52]) and str(got[0]["month"]) == "2024-01-01"
    assert got[0]["high"] == pytest.approx(46, abs=1e-5)
    assert series.backtest(df, ["k"]).first()["mae"] == pytest.approx(0, abs=1e-9)


def test_decomposition_adds_up(spark):
    df = spark.range(12).selectExpr("'k' AS k", "add_months(DATE '2023-01-01', int(id)) AS month", "double(id + 5 * (id % 3)) AS total")
    out = series.decomposed(df, ["k"]).where("trend IS NOT NULL").collect()
    assert all(r["trend"] + r["seasonal"] + r["residual"] == pytest.approx(r["total"]) for r in out) and len(out) == 10


def test_decay_half_life(spark):
    df = spark.range(10).selectExpr("'k' AS k", "int(id) AS m", "100 * exp(-0.2 * id) AS v").union(spark.sql("SELECT 'k', 10, 0.0D"))
    r = series.decay_fit(df, ["k"], "m", "v").first()
    assert (r["a"], r["b"], r["half_life"], r["r2"]) == (pytest.approx(100), pytest.approx(0.2), pytest.approx(math.log(2) / 0.2), pytest.approx(1))


def test_state_shares_sum_to_one_after_any_step(spark):
    rows = [(k, p, "abc"[(k * p + p) % 3]) for k in range(12) for p in range(6)]
    moves = series.state_moves(spark.createDataFrame(rows, "k int, p int, s string"), "k", "p", "s")
    for steps in (1, 2, 4):
        sums = series.moves_after(moves, steps).groupBy("from_state").agg(F.sum("share").alias("x")).collect()
        assert all(r["x"] == pytest.approx(1.0) for r in sums)
