"""Version choice, calendar changes, aligned series and distances to group means."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.catalogue.common import half_up, money, plain, query, table
from gridmart.functions.energy import percent_of, version_rank
from gridmart.functions.periods import period_text
from gridmart.operators.align import common_periods
from gridmart.operators.change import month_over_month
from gridmart.operators.dedup import best_version, complete_rows
from gridmart.operators.groupmean import gap_to_group_mean
from gridmart.sources.tables import stager

LINE = ["l_orderkey", "l_linenumber"]
# Total order of the versions of a line: rows equal in all of these columns are the same version
TIE_BREAK = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag",
             "l_linestatus"]
VERSION_SQL = ("l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC, "
               "l_returnflag DESC, l_linestatus DESC")


def _newest(*first):
    return [*first, F.desc("l_shipdate"), *[F.desc(column) for column in TIE_BREAK]]


@query(
    "q19_latest_wins",
    f"""
    SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
           CAST(l_partkey AS DOUBLE) AS l_partkey, l_extendedprice,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate
    FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {VERSION_SQL}) = 1
    """,
)
def latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = complete_rows(table(spark, sf_dir, "lineitem"), LINE)
    return plain(best_version(lines, LINE, _newest()).select(*LINE, "l_partkey", "l_extendedprice", "l_shipdate"))


@query(
    "q20_priority_dedup",
    f"""
    SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, l_returnflag,
           CASE WHEN l_discount > 0 THEN l_extendedprice END AS measure,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate
    FROM lineitem WHERE l_discount > 0
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY CASE l_returnflag WHEN 'N' THEN 1 WHEN 'A' THEN 2 ELSE 3 END,
                                        l_shipdate DESC, {VERSION_SQL}) = 1
    """,
)
def priority_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without discount have no measure: they are dropped before they could hide another version."""
    measure = F.when(F.col("l_discount") > 0, F.col("l_extendedprice"))
    lines = complete_rows(table(spark, sf_dir, "lineitem").withColumn("measure", measure), [*LINE, "measure"])
    rank = version_rank(F.col("l_returnflag"), ("N", "A"))
    best = best_version(lines, LINE, _newest(rank))
    return plain(best.select(*LINE, "l_returnflag", "measure", "l_shipdate"))


@query(
    "q21_null_key_dedup",
    f"""
    WITH lines AS (SELECT *, CASE l_linestatus WHEN 'F' THEN l_linenumber END AS division FROM lineitem)
    SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(division AS DOUBLE) AS division,
           CAST(l_partkey AS DOUBLE) AS l_partkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate
    FROM lines
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, division
                               ORDER BY l_shipdate DESC, {VERSION_SQL}) = 1
    """,
)
def null_key_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NULL key member is a value of its own: these lines stay, one per order."""
    division = F.when(F.col("l_linestatus") == "F", F.col("l_linenumber"))
    lines = table(spark, sf_dir, "lineitem").withColumn("division", division)
    best = best_version(lines, ["l_orderkey", "division"], _newest())
    return plain(best.select("l_orderkey", "division", "l_partkey", "l_shipdate"))


@query(
    "q22_calendar_change",
    f"""
    WITH months AS (
        SELECT o_custkey AS customer, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM orders GROUP BY 1, 2),
    previous AS (
        SELECT *, lag(m) OVER w AS m_before, lag(amount) OVER w AS before FROM months
        WINDOW w AS (PARTITION BY customer ORDER BY m))
    SELECT CAST(customer AS DOUBLE) AS customer, strftime(m, '%Y-%m-%d') AS month, amount,
           CASE WHEN m_before = m - INTERVAL 1 MONTH
                THEN {half_up("(amount - before) / nullif(before, 0) * 100")} END AS change_pct
    FROM previous
    """,
)
def calendar_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers order in some months only, so many months have no predecessor."""
    months = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("customer"), F.trunc("o_orderdate", "month").alias("month"))
        .agg(F.sum(money("o_totalprice")).cast("double").alias("amount"))
    )
    return plain(month_over_month(months, "month", {"change_pct": "amount"}, ["customer"]))


@query(
    "q23_series_alignment",
    """
    WITH a AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
                      AS ordered FROM orders GROUP BY 1),
    b AS (SELECT strftime(l_shipdate, '%Y-%m') AS period, sum(l_quantity) AS shipped FROM lineitem GROUP BY 1),
    c AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
                 AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
    SELECT period, ordered, shipped, urgent FROM a JOIN b USING (period) JOIN c USING (period)
    """,
)
def series_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    ordered = orders.groupBy(period_text(F.col("o_orderdate")).alias("period"))
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").groupBy(
        period_text(F.col("o_orderdate")).alias("period")
    )
    shipped = lines.groupBy(period_text(F.col("l_shipdate")).alias("period"))
    series = [
        ordered.agg(F.sum(money("o_totalprice")).alias("ordered")),
        shipped.agg(F.sum("l_quantity").alias("shipped")),
        urgent.agg(F.sum(money("o_totalprice")).alias("urgent")),
    ]
    return plain(common_periods(series, ["period"]))


@query(
    "q24_month_deviation",
    f"""
    WITH rates AS (
        SELECT event_id, user_id, date_trunc('month', ts) AS m,
               value / nullif(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) * 100 AS coverage
        FROM events)
    SELECT CAST(event_id AS DOUBLE) AS event_id, coverage,
           {half_up("(coverage / nullif(avg(coverage) OVER (PARTITION BY user_id, m), 0) - 1) * 100")} AS gap_pct
    FROM rates
    """,
)
def month_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.trunc("ts", "month").alias("month"),
        percent_of(F.col("value"), F.get_json_object("props", "$.k").cast("int")).alias("coverage"),
    )
    groups = {"group_user": F.col("user_id"), "group_month": F.col("month")}
    compared = gap_to_group_mean(rates, "coverage", groups, "gap_pct", stager(spark, "means"))
    return plain(compared.select("event_id", "coverage", "gap_pct"))
