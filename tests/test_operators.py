import random
from datetime import date, datetime, timedelta, timezone
from statistics import median

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmart.operators.align import common_periods
from gridmart.operators.change import month_over_month
from gridmart.operators.checks import UNIQUE, UNIQUE_COMBINATION, QualityError, Rule, freshness, gate, reconcile, run_checks
from gridmart.operators.dedup import best_version
from gridmart.operators.groupmean import gap_to_group_mean
from gridmart.operators.parse import Field, json_texts, parse_records
from gridmart.operators.spread import exact_median
from gridmart.functions.casts import as_int
from gridmart.sources.tables import stager

SPARK_SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def records(spark, *payloads):
    return spark.createDataFrame([(p,) for p in payloads], "payload string")


def test_json_texts(spark):
    rows = json_texts(records(spark, '{"a": "ND", "b": 12.5}', '{"a": null}', "{broken", None), ["a", "b"]).collect()
    assert [tuple(r) for r in rows] == [("ND", "12.5"), (None, None), (None, None), (None, None)]


def test_a_key_may_feed_two_columns_and_carry_any_name(spark):
    df = records(spark, '{"payload": "x", "n": "3"}').select("payload", F.lit(1).alias("keep"))
    row = parse_records(df, [Field("n", "text"), Field("n", "number", as_int), Field("payload", "payload")], ["keep"]).first()
    assert row.asDict() == {"text": "3", "number": 3, "payload": "x", "keep": 1}


def test_filters_do_not_repeat_the_parse(spark, plan):
    spark.range(3).select(F.lit('{"a": "1"}').alias("payload")).write.mode("overwrite").parquet(path := stage_path(spark))
    parsed = parse_records(spark.read.parquet(path), [Field("a", "a", as_int), Field("b", "b", as_int)], [])
    assert plan(parsed.where("a IS NOT NULL AND b IS NOT NULL")).count("from_json(") == 1


def stage_path(spark):
    from gridmart.session import scratch_path

    return scratch_path(spark, "test")


VERSIONS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=40)


@SPARK_SETTINGS
@given(VERSIONS, st.randoms())
def test_best_version_does_not_depend_on_row_order(spark, rows, rnd):
    def pick(values):
        df = spark.createDataFrame(values, "k string, load int, v int")
        return {tuple(r) for r in best_version(df, ["k"], [F.desc("load"), F.desc("v")]).collect()}

    shuffled = rows[:]
    rnd.shuffle(shuffled)
    expected = {max((r for r in rows if r[0] == k), key=lambda r: r[1:]) for k in {r[0] for r in rows}}
    assert pick(rows) == pick(shuffled) == expected


def test_best_version_is_limited_before_the_shuffle(spark, plan):
    text = plan(best_version(spark.range(10).withColumn("k", F.col("id") % 3), ["k"], [F.desc("id")]))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_gap_to_group_mean_counts_rows_equally_and_keeps_null_groups(spark):
    rows = [("x", 10.0), ("x", 30.0), ("x", None), (None, 5.0), (None, 15.0), ("z", 0.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    for stage in (None, stager(spark, "means")):
        gaps = gap_to_group_mean(df, "v", {"g": F.col("k")}, "gap", stage)
        assert gaps.columns == ["k", "v", "gap"]
        assert {tuple(r) for r in gaps.collect()} == {
            ("x", 10.0, -50.0), ("x", 30.0, 50.0), ("x", None, None), (None, 5.0, -50.0), (None, 15.0, 50.0), ("z", 0.0, None),
        }


def test_staged_means_are_broadcast(spark, plan):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("v"))
    df.write.parquet(path := stage_path(spark))
    text = plan(gap_to_group_mean(spark.read.parquet(path), "v", {"g": F.col("k")}, "gap", stager(spark, "means")))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert "Window" not in text


def test_month_over_month_needs_the_previous_calendar_month(spark):
    rows = [(date(2024, 1, 1), 100.0), (date(2024, 2, 1), 110.0), (date(2024, 4, 1), 50.0), (date(2024, 5, 1), 0.0),
            (date(2024, 6, 1), 3.0), (date(2024, 12, 1), None), (date(2025, 1, 1), 8.0)]
    df = spark.createDataFrame(rows, "m date, v double")
    changes = {r.m.strftime("%Y-%m"): r.c for r in month_over_month(df, "m", {"c": "v"}).collect()}
    assert changes == {"2024-01": None, "2024-02": 10.0, "2024-04": None, "2024-05": -100.0, "2024-06": None,
                       "2024-12": None, "2025-01": None}


def test_month_over_month_by_key(spark):
    rows = [("a", date(2024, 1, 1), 1.0), ("b", date(2024, 2, 1), 9.0), ("a", date(2024, 2, 1), 2.0)]
    df = spark.createDataFrame(rows, "k string, m date, v double")
    assert {(r.k, r.c) for r in month_over_month(df, "m", {"c": "v"}, ["k"]).collect()} == {("a", None), ("a", 100.0), ("b", None)}


def test_common_periods(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "p int, a string")
    b = spark.createDataFrame([(2, "z"), (3, "w")], "p int, b string")
    assert [tuple(r) for r in common_periods([a, b], ["p"]).collect()] == [(2, "y", "z")]


@SPARK_SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(-500, 500)), min_size=1, max_size=30))
def test_exact_median(spark, rows):
    df = spark.createDataFrame([(k, v / 4) for k, v in rows], "k string, v double")
    expected = {k: median(v / 4 for key, v in rows if key == k) for k in {k for k, _ in rows}}
    assert {r.k: r["median"] for r in exact_median(df, "v", ["k"]).collect()} == pytest.approx(expected)
    assert exact_median(df, "v").first()["median"] == pytest.approx(median(v / 4 for _, v in rows))


def test_exact_median_of_skewed_values(spark):
    rnd = random.Random(7)
    values = [round(rnd.gauss(0, 60), 2) for _ in range(999)] + [1.25] * 500 + [None] * 10
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_median(df, "v", stage=stager(spark, "counts")).first()["median"] == median(v for v in values if v is not None)


def test_exact_median_of_a_million_values_of_one_group(spark, plan):
    """All different and far from each other, so no rounding makes bins of them; nothing is sorted by a window."""
    ids = spark.range(0, 1_000_001, 1, 8)
    df = ids.select(((F.col("id") - 500_000) * 1e9 + F.col("id") % 7).alias("v"), F.when(F.col("id") == 7, "x").alias("k"))
    got = exact_median(df, "v")
    assert got.first()["median"] == sorted((i - 500_000) * 1e9 + i % 7 for i in range(1_000_001))[500_000]
    assert "Window" not in plan(got)
    assert {r.k: r["median"] for r in exact_median(df.where("id < 10"), "v", ["k"]).collect()}["x"] == (7 - 500_000) * 1e9


def test_exact_median_of_extreme_values(spark):
    values = [1.7e308, -1.7e308, 5e-324, -5e-324, 0.0, 1e300, 1e-300, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_median(df, "v").first()["median"] == 5e-324
    assert exact_median(df.where("v is null"), "v").count() == 0


def test_key_rules_of_a_table_share_one_shuffle(spark, plan):
    df = spark.createDataFrame([(1, "x", None), (1, "x", None), (2, None, 1), (2, None, 2), (None, "y", 1)], "a int, b string, c int")
    rules = [Rule("t", UNIQUE, ("a",)), Rule("t", UNIQUE, ("c",)), Rule("t", UNIQUE_COMBINATION, ("a", "b")), Rule("t", UNIQUE_COMBINATION, ("b", "a")), Rule("t", UNIQUE_COMBINATION, ("c",)), Rule("t", UNIQUE_COMBINATION, ("a", "b", "c"))]
    checked = run_checks({"t": df}, rules)
    assert [(r.target, r.failures) for r in checked.collect()] == [("a", 2), ("c", 1), ("a, b", 2), ("b, a", 2), ("c", 2), ("a, b, c", 1)]
    assert len([x for x in plan(run_checks({"t": df}, rules)).splitlines() if x.startswith("Arguments: hashpartitioning")]) == 1


RULES = [
    Rule("t", "not_null", ("a",)),
    Rule("t", "unique", ("a",)),
    Rule("t", "unique_combination", ("a", "b")),
    Rule("t", "accepted_values", ("b",), ("x",), severity="warn"),
    Rule("t", "expression_is_true", expression="a > 0"),
]


def results(spark, rows):
    table = spark.createDataFrame(rows, "a int, b string")
    return run_checks({"t": table}, RULES)


def test_checks_count_failures(spark):
    rows = [(1, "x"), (1, "x"), (None, "y"), (None, "y"), (-1, None)]
    found = {r.check_name: (r.failures, r.status) for r in results(spark, rows).collect()}
    assert found == {
        "not_null": (2, "error"), "unique": (1, "error"), "unique_combination": (2, "error"),
        "accepted_values": (2, "warn"), "expression_is_true": (1, "error"),
    }


def test_gate_stops_on_errors_only(spark):
    gate(results(spark, [(1, "x"), (2, "unknown")]))
    with pytest.raises(QualityError, match=r"t: not_null\(a\) failed for 1"):
        gate(results(spark, [(None, "x")]))


def test_freshness_levels(spark):
    now = datetime(2026, 10, 5, 12, 0, tzinfo=timezone.utc)
    loads = [("ok", 120), ("old", 121), ("older", 24 * 60), ("dead", 24 * 60 + 1)]
    df = spark.createDataFrame([(k, now - timedelta(minutes=m)) for k, m in loads], "k string, t timestamp")
    ages = freshness(df, "t", now, timedelta(hours=2), timedelta(hours=24), ["k"])
    assert {r.k: (r.age_minutes, r.status) for r in ages.collect()} == {
        "ok": (120, "pass"), "old": (121, "warn"), "older": (1440, "warn"), "dead": (1441, "error"),
    }
    empty = freshness(df.where("false"), "t", now, timedelta(hours=2), timedelta(hours=24)).first()
    assert empty.status == "error"


def test_reconcile_shows_what_a_short_key_loses(spark):
    lines = spark.createDataFrame([("c", "10", 5.0), ("c", "20", 7.0)], "commune string, naf string, mwh double")
    full = best_version(lines, ["commune", "naf"], [F.desc("mwh")])
    short = best_version(lines, ["commune"], [F.desc("mwh")])
    assert reconcile(lines, full, "mwh").first().lost == 0.0
    assert tuple(reconcile(lines, short, "mwh").first()) == (2, 1, 12.0, 7.0, 5.0)


def hot(spark):
    """A third of the rows share one key."""
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    return spark.range(0, 300_000, 1, 8).select(key.alias("k"), F.col("id").cast("double").alias("v"), F.col("id").alias("t"))


def test_a_hot_key_sends_one_row_per_task(spark):
    best = best_version(hot(spark), ["k"], [F.desc("t")])
    assert best.count() == 200_001
    assert best.where("k = -1").first().t == 299_997


def test_a_hot_group_is_split_when_the_means_are_too_many_to_broadcast(spark, plan):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "300KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        gaps = gap_to_group_mean(hot(spark), "v", {"g": F.col("k")}, "gap", stager(spark, "means"))
        total = gaps.agg(F.count("*"), F.count_if(F.col("gap") == 0))
        assert tuple(total.collect()[0]) == (300_000, 200_004)  # four hot rows are within 0.005 % of their mean
        assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_month_over_month_with_a_null_key_and_a_repeated_month(spark):
    rows = [(None, 1, 4.0), (None, 2, 5.0), ("a", 1, 2.0), ("a", 2, 3.0)]
    df = spark.createDataFrame([(k, date(2024, m, 1), v) for k, m, v in rows], "k string, m date, v double")
    got = {(r.k, r.m.month): r.c for r in month_over_month(df, "m", {"c": "v"}, ["k"]).collect()}
    assert got == {(None, 1): None, (None, 2): 25.0, ("a", 1): None, ("a", 2): 50.0}
    twice = month_over_month(df.union(df.where("k = 'a' AND month(m) = 1")), "m", {"c": "v"}, ["k"]).collect()
    assert len(twice) == 5 and {r.c for r in twice if r.k == "a"} == {None}
