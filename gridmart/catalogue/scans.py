"""Sources, envelopes, request slices and load windows."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.catalogue.common import money, plain, query, table
from gridmart.functions.casts import as_double, as_int
from gridmart.functions.periods import load_label, month_windows, period_text
from gridmart.functions.slices import in_last_minutes, in_series, in_window
from gridmart.operators.parse import Field, parse_records
from gridmart.sources import bronze, landed

LOADED_AT = datetime(2026, 10, 6, 4, 0, tzinfo=timezone.utc)


@query(
    "q01_bronze_envelope",
    """
    SELECT 'events' AS source_dataset, 'full' AS extracted_for,
           CAST(to_json({'event_id': event_id, 'ts': strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 'user_id': user_id,
                         'event_type': event_type, 'amount': CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR),
                         'props': props, 'absent': NULL}) AS VARCHAR) AS payload,
           '2026-10-06 04:00:00.000000' AS ingested_at
    FROM events
    """,
)
def bronze_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        "user_id",
        "event_type",
        money("value").cast("string").alias("amount"),
        "props",
        F.lit(None).cast("string").alias("absent"),
    )
    return plain(bronze.envelope(records, "events", load_label(None, None), LOADED_AT))


@query(
    "q02_day_scan",
    """
    SELECT event_id, user_id, value FROM events
    WHERE event_type = 'click' AND strftime(ts, '%Y-%m-%d') = '2024-01-15'
    """,
)
def day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of a typed time is a half-open window, which the scan takes; the feed's own day is text (see the loads)."""
    records = table(spark, sf_dir, "events")
    wanted = (F.col("event_type") == "click") & in_window(F.col("ts"), date(2024, 1, 15), date(2024, 1, 16), "timestamp_ntz")
    return records.where(wanted).select("event_id", "user_id", "value")


@query(
    "q03_recent_window",
    """
    SELECT event_id, event_type FROM events
    WHERE event_type <> 'error'
      AND ts >= TIMESTAMP '2024-01-15 10:07:00' AND ts < TIMESTAMP '2024-01-15 12:07:00'
    """,
)
def recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of the last 120 minutes. Timestamps are text: with an offset, without one, or unusable."""
    naive = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ahead = F.date_format(F.col("ts") + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(F.col("event_type") == "error", "not a time")
        .when(F.col("event_type") == "click", F.concat(ahead, F.lit("+02:00")))
        .otherwise(naive)
    )
    records = table(spark, sf_dir, "events").withColumn("slot", text)
    now = datetime(2024, 1, 15, 12, 7, tzinfo=timezone.utc)
    return records.where(in_last_minutes(F.col("slot"), now, 120)).select("event_id", "event_type")


@query(
    "q03_range_scan",
    """
    SELECT event_id, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'
    """,
)
def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = in_window(F.col("ts"), date(2024, 1, 10), date(2024, 1, 12), "timestamp_ntz")
    return table(spark, sf_dir, "events").where(window).select("event_id", "event_type", "value")


@query(
    "q04_pages_union",
    """
    SELECT CAST(o_orderkey AS DOUBLE) AS order_key, o_orderstatus AS status,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount
    FROM orders
    """,
)
def pages_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of at most 1 000 records each (order keys are unique), read back as one set of records."""
    record = F.to_json(
        F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
                 money("o_totalprice").cast("string").alias("amount"))
    )
    pages = (
        table(spark, sf_dir, "orders")
        .select((F.col("o_orderkey") / 1000).cast("long").alias("page"), record.alias("record"))
        .groupBy("page")
        .agg(F.concat_ws(",", F.collect_list("record")).alias("records"))
        .select(F.concat(F.lit('{"results":['), "records", F.lit('],"next":null}')).alias("document"))
    )
    fields = [Field("id", "order_key", as_double), Field("status", "status"), Field("amount", "amount", as_double)]
    return parse_records(landed.page_records(pages), fields, carry=())


@query(
    "q05_series_select",
    """
    SELECT o_orderpriority AS series_key, o_orderstatus AS title_fr, strftime(o_orderdate, '%Y-%m') AS time_period,
           o_totalprice AS obs_value, CAST(o_orderkey AS DOUBLE) AS obs_status
    FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
      AND date_trunc('month', o_orderdate) >= DATE '1996-02-01'
      AND date_trunc('month', o_orderdate) <= DATE '2000-11-01'
    """,
)
def series_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    month = F.trunc("o_orderdate", "month")
    wanted = in_series(F.col("o_orderpriority"), month, ("1-URGENT", "2-HIGH"), "1996-02", "2000-11")
    return plain(
        orders.where(wanted).select(
            F.col("o_orderpriority").alias("series_key"),
            F.col("o_orderstatus").alias("title_fr"),
            period_text(month).alias("time_period"),
            F.col("o_totalprice").alias("obs_value"),
            F.col("o_orderkey").alias("obs_status"),
        )
    )


@query(
    "q06_month_windows",
    """
    WITH months AS (
        SELECT CAST(unnest(generate_series(TIMESTAMP '1994-11-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS DATE)
               AS first_day),
    loads AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1)
    SELECT strftime(first_day, '%Y-%m') AS label, strftime(first_day, '%Y-%m-%d') AS window_start,
           strftime(first_day + INTERVAL 1 MONTH, '%Y-%m-%d') AS window_end,
           CAST(coalesce(n, 0) AS DOUBLE) AS n_records
    FROM months LEFT JOIN loads ON m = first_day
    """,
)
def backfill_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All month windows of a backfill in one job: records carry the label of their window."""
    labelled = table(spark, sf_dir, "orders").select(period_text(F.col("o_orderdate")).alias("label"))
    loads = labelled.groupBy("label").agg(F.count("*").alias("n"))
    windows = month_windows(spark, "1994-11", "2001-12")
    return plain(
        windows.join(loads, "label", "left").select(
            "label", "window_start", "window_end", F.coalesce("n", F.lit(0)).alias("n_records")
        )
    )


@query(
    "q07_union_feeds",
    """
    WITH feeds AS (
        SELECT 'orders' AS source_dataset, o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
               NULL::DOUBLE AS quantity, o_orderdate AS day FROM orders
        UNION ALL
        SELECT 'lineitem', l_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)), l_quantity, l_shipdate FROM lineitem)
    SELECT source_dataset, strftime(day, '%Y-%m') AS period, CAST(count(*) AS DOUBLE) AS n,
           CAST(count(quantity) AS DOUBLE) AS n_quantity, CAST(sum(amount) AS DOUBLE) AS amount
    FROM feeds GROUP BY 1, 2
    """,
)
def union_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source_dataset"), money("o_totalprice").alias("amount"), F.col("o_orderdate").alias("day")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.lit("lineitem").alias("source_dataset"),
        money("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").alias("day"),
    )
    both = orders.unionByName(lines, allowMissingColumns=True)
    return plain(
        both.groupBy("source_dataset", period_text(F.col("day")).alias("period")).agg(
            F.count("*").alias("n"), F.count("quantity").alias("n_quantity"), F.sum("amount").alias("amount")
        )
    )


@query(
    "q08_json_extract",
    """
    SELECT CAST(event_id AS DOUBLE) AS event_id, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS absent,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_number
    FROM events
    """,
)
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("payload"))
    fields = [Field("k", "k"), Field("absent", "absent"), Field("k", "k_number", as_int)]
    return plain(parse_records(records, fields, ("event_id",)))
