"""Data-quality checks over rows, keys, totals and load times."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.catalogue.common import money, plain, query, table
from gridmart.operators.checks import (
    ACCEPTED_VALUES,
    EXPRESSION,
    NOT_NULL,
    UNIQUE,
    UNIQUE_COMBINATION,
    Rule,
    duplicated,
    freshness,
    reconcile,
    run_checks,
)
from gridmart.operators.dedup import best_version


def _status(kind: str, rows: str) -> str:
    """SQL of the check results, from rows ``(table_name, target, severity, failures)``."""
    return f"""
    SELECT table_name, '{kind}' AS check_name, target, severity, CAST(failures AS DOUBLE) AS failures,
           CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status
    FROM ({rows}) AS r(table_name, target, severity, failures)
    """


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with holes: returned ones have no status, open ones no line number."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_linestatus") == "F", F.col("l_linenumber")).alias("line"),
        F.when(F.col("l_returnflag") != "R", F.col("l_linestatus")).alias("status"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
    )


LINES_SQL = """(SELECT l_orderkey, CASE l_linestatus WHEN 'F' THEN l_linenumber END AS line,
                       CASE WHEN l_returnflag <> 'R' THEN l_linestatus END AS status,
                       l_quantity, l_extendedprice, l_discount FROM lineitem)"""


@query(
    "q25_not_null",
    _status(
        NOT_NULL,
        f"""SELECT 'lineitem', 'line', 'error', count(*) FROM {LINES_SQL} WHERE line IS NULL
            UNION ALL SELECT 'lineitem', 'status', 'warn', count(*) FROM {LINES_SQL} WHERE status IS NULL
            UNION ALL SELECT 'lineitem', 'l_orderkey', 'error', count(*) FROM {LINES_SQL} WHERE l_orderkey IS NULL
            UNION ALL SELECT 'orders', 'o_orderdate', 'error', count(*) FROM orders WHERE o_orderdate IS NULL""",
    ),
)
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"lineitem": _lines(spark, sf_dir), "orders": table(spark, sf_dir, "orders")}
    rules = [
        Rule("lineitem", NOT_NULL, ("line",)),
        Rule("lineitem", NOT_NULL, ("status",), severity="warn"),
        Rule("lineitem", NOT_NULL, ("l_orderkey",)),
        Rule("orders", NOT_NULL, ("o_orderdate",)),
    ]
    return plain(run_checks(tables, rules))


@query(
    "q26_unique",
    _status(
        UNIQUE,
        f"""SELECT 'orders', 'o_orderkey', 'error', count(*)
            FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
            UNION ALL SELECT 'lineitem', 'line', 'error', count(*)
            FROM (SELECT line FROM {LINES_SQL} WHERE line IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""",
    ),
)
def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"lineitem": _lines(spark, sf_dir), "orders": table(spark, sf_dir, "orders")}
    return plain(
        run_checks(tables, [Rule("orders", UNIQUE, ("o_orderkey",)), Rule("lineitem", UNIQUE, ("line",))])
    )


@query(
    "q27_accepted_values",
    _status(
        ACCEPTED_VALUES,
        f"""SELECT 'lineitem', 'status', 'error', count(*) FROM {LINES_SQL} WHERE status NOT IN ('F')
            UNION ALL SELECT 'lineitem', 'line', 'warn', count(*) FROM {LINES_SQL} WHERE line NOT IN (1, 2, 3, 4)
            UNION ALL SELECT 'orders', 'o_orderstatus', 'error', count(*) FROM orders
            WHERE o_orderstatus NOT IN ('F', 'O', 'P')""",
    ),
)
def accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"lineitem": _lines(spark, sf_dir), "orders": table(spark, sf_dir, "orders")}
    rules = [
        Rule("lineitem", ACCEPTED_VALUES, ("status",), ("F",)),
        Rule("lineitem", ACCEPTED_VALUES, ("line",), (1, 2, 3, 4), severity="warn"),
        Rule("orders", ACCEPTED_VALUES, ("o_orderstatus",), ("F", "O", "P")),
    ]
    return plain(run_checks(tables, rules))


@query(
    "q28_unique_combination",
    _status(
        UNIQUE_COMBINATION,
        f"""SELECT 'lineitem', 'l_orderkey, line', 'error', count(*)
            FROM (SELECT 1 FROM {LINES_SQL} GROUP BY l_orderkey, line HAVING count(*) > 1)
            UNION ALL SELECT 'orders', 'o_custkey, o_orderdate', 'error', count(*)
            FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)""",
    ),
)
def unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"lineitem": _lines(spark, sf_dir), "orders": table(spark, sf_dir, "orders")}
    rules = [
        Rule("lineitem", UNIQUE_COMBINATION, ("l_orderkey", "line")),
        Rule("orders", UNIQUE_COMBINATION, ("o_custkey", "o_orderdate")),
    ]
    return plain(run_checks(tables, rules))


@query(
    "q28_duplicated_rows",
    f"""SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(line AS DOUBLE) AS line,
               CAST(count(*) AS DOUBLE) AS n_rows
        FROM {LINES_SQL} GROUP BY l_orderkey, line HAVING count(*) > 1""",
)
def duplicated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failing keys themselves, for whoever has to repair them."""
    return plain(duplicated(_lines(spark, sf_dir), ["l_orderkey", "line"], ignore_null=False))


@query(
    "q29_expression",
    _status(
        EXPRESSION,
        f"""SELECT 'lineitem', 'abs(l_extendedprice * l_discount) < 5000.0', 'error', count(*) FROM {LINES_SQL}
            WHERE NOT abs(l_extendedprice * l_discount) < 5000.0
            UNION ALL SELECT 'lineitem', 'l_quantity >= line', 'warn', count(*) FROM {LINES_SQL}
            WHERE NOT l_quantity >= line""",
    ),
)
def expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An expression that is unknown (NULL) does not fail."""
    rules = [
        Rule("lineitem", EXPRESSION, expression="abs(l_extendedprice * l_discount) < 5000.0"),
        Rule("lineitem", EXPRESSION, expression="l_quantity >= line", severity="warn"),
    ]
    return plain(run_checks({"lineitem": _lines(spark, sf_dir)}, rules))


@query(
    "q30_reconcile",
    """
    WITH lines AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem),
    long_key AS (SELECT amount FROM lines QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey,
                 l_suppkey, l_shipdate, l_quantity, l_extendedprice ORDER BY 1) = 1),
    short_key AS (SELECT amount FROM lines
                  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY amount DESC) = 1)
    SELECT k AS key_used, CAST(rows_before AS DOUBLE) AS rows_before, CAST(rows_after AS DOUBLE) AS rows_after,
           CAST(total_before AS DOUBLE) AS total_before, CAST(total_after AS DOUBLE) AS total_after,
           CAST(total_before - total_after AS DOUBLE) AS lost
    FROM (SELECT count(*) AS rows_before, sum(amount) AS total_before FROM lines) b,
         (SELECT 'line' AS k, count(*) AS rows_after, sum(amount) AS total_after FROM long_key
          UNION ALL SELECT 'order', count(*), sum(amount) FROM short_key) a
    """,
)
def reconcile_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals around a version choice by the true key and by one that is too short."""
    lines = table(spark, sf_dir, "lineitem").withColumn("amount", money("l_extendedprice"))
    full_key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
    kept = {
        "line": best_version(lines, full_key, [F.desc("amount")]),
        "order": best_version(lines, ["l_orderkey"], [F.desc("amount")]),
    }
    results = [
        reconcile(lines, after, "amount").select(F.lit(name).alias("key_used"), "*") for name, after in kept.items()
    ]
    return plain(results[0].unionByName(results[1]))


@query(
    "q31_freshness",
    """
    SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_loaded,
           floor(date_diff('microsecond', max(ts), TIMESTAMP '2024-01-31 01:00:00') / 60000000) AS age_minutes,
           CASE WHEN max(ts) < TIMESTAMP '2024-01-31 01:00:00' - INTERVAL 24 HOUR - INTERVAL 1 SECOND THEN 'error'
                WHEN date_diff('microsecond', max(ts), TIMESTAMP '2024-01-31 01:00:00') // 1000000 > 7200 THEN 'warn'
                ELSE 'pass' END AS status
    FROM events GROUP BY event_type
    """,
)
def freshness_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = datetime(2024, 1, 31, 1, 0, tzinfo=timezone.utc)
    events = table(spark, sf_dir, "events")
    return plain(freshness(events, "ts", now, timedelta(hours=2), timedelta(hours=24), ["event_type"]))
