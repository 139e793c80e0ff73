"""Casts, codes, energy, periods and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.catalogue.common import half_up, money, plain, query, table
from gridmart.functions.casts import (
    as_date,
    as_double,
    as_instant,
    as_int,
    clean_code,
    month_of_period,
    padded_code,
)
from gridmart.functions.energy import energy_of_slot, energy_of_sum, percent_of, zero_filled_sum
from gridmart.functions.keys import surrogate_key
from gridmart.functions.periods import month_start, period_text, slots_expected

# Orders stand for production: the priority is the source, the last one is not renewable
SOURCES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "4-NOT SPECIFIED")


@query(
    "q09_tolerant_numbers",
    r"""
    WITH dirty AS (
        SELECT event_id,
               CASE event_type WHEN 'error' THEN 'ND' WHEN 'view' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
                    WHEN 'click' THEN ' ' || user_id || ' ' WHEN 'purchase' THEN user_id || 'e3'
                    ELSE json_extract_string(props, '$.k') END AS txt
        FROM events)
    SELECT CAST(event_id AS DOUBLE) AS event_id,
           CASE WHEN regexp_full_match(trim(txt), '[+-]?[0-9]+') THEN CAST(TRY_CAST(txt AS INTEGER) AS DOUBLE) END
               AS whole,
           TRY_CAST(trim(txt) AS DOUBLE) AS number
    FROM dirty
    """,
)
def tolerant_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted numbers, padded numbers, exponents, decimals and words, as feeds publish them."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", "ND")
        .when(kind == "view", money("value").cast("string"))
        .when(kind == "click", F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")))
        .when(kind == "purchase", F.concat(F.col("user_id").cast("string"), F.lit("e3")))
        .otherwise(F.get_json_object("props", "$.k"))
    )
    dirty = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return plain(dirty.select("event_id", as_int(F.col("text")).alias("whole"), as_double(F.col("text")).alias("number")))


@query(
    "q10_period_dates",
    """
    SELECT CAST(o_orderkey AS DOUBLE) AS order_key,
           CASE o_orderstatus WHEN 'O' THEN strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') END AS month,
           CASE o_orderstatus WHEN 'O' THEN NULL WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
           strftime(o_orderdate + INTERVAL 30 MINUTE - CASE o_orderstatus WHEN 'F' THEN INTERVAL 2 HOUR
                    ELSE INTERVAL 0 HOUR END, '%Y-%m-%d %H:%M:%S.%f') AS instant
    FROM orders
    """,
)
def period_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, day = F.col("o_orderstatus"), F.col("o_orderdate")
    texts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.when(status == "O", period_text(day))
        .when(status == "F", F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")))
        .otherwise("ND")
        .alias("period"),
        F.when(status == "F", F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "dd/MM/yyyy")).alias("d"),
        F.concat(
            F.date_format(day, "yyyy-MM-dd'T00:30:00'"), F.when(status == "F", "+02:00").otherwise("")
        ).alias("t"),
    )
    return plain(
        texts.select(
            "order_key",
            month_of_period(F.col("period")).alias("month"),
            as_date(F.col("d")).alias("day"),
            as_instant(F.col("t")).alias("instant"),
        )
    )


@query(
    "q11_code_normalise",
    """
    SELECT CAST(c_custkey AS DOUBLE) AS customer, lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS code,
           lpad(c_name, 5, '0') AS cut_code, c_mktsegment AS sector, n_name AS place
    FROM customer JOIN nation ON n_nationkey = c_nationkey
    """,
)
def code_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that lost their zeros, and sectors in mixed case; places are found by their repaired code."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer"),
        padded_code(F.col("c_custkey").cast("string")).alias("code"),
        padded_code(F.col("c_name")).alias("cut_code"),
        clean_code(F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))).alias("sector"),
        padded_code(F.col("c_nationkey").cast("string")).alias("place_code"),
    )
    places = table(spark, sf_dir, "nation").select(
        padded_code(F.col("n_nationkey").cast("string")).alias("place_code"), F.col("n_name").alias("place")
    )
    return plain(customers.join(places, "place_code").drop("place_code"))


@query(
    "q12_sector_slice",
    """
    SELECT CAST(c_custkey AS DOUBLE) AS site, c_name AS label, c_mktsegment AS sector, c_acctbal AS energy_mwh
    FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
)
def sector_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") == "BUILDING")
        .select(
            F.col("c_custkey").alias("site"),
            F.col("c_name").alias("label"),
            F.col("c_mktsegment").alias("sector"),
            F.col("c_acctbal").alias("energy_mwh"),
        )
    )


@query(
    "q13_slot_energy",
    """
    WITH slots AS (
        SELECT event_id, CASE event_type WHEN 'click' THEN 15 ELSE 30 END AS minutes,
               CAST(floor(value) AS BIGINT) AS produced, CAST(json_extract_string(props, '$.k') AS BIGINT) AS consumed
        FROM events)
    SELECT CAST(event_id AS DOUBLE) AS event_id, CAST(minutes AS DOUBLE) AS minutes,
           produced * minutes / 60.0::DOUBLE AS prod_mwh, consumed * minutes / 60.0::DOUBLE AS conso_mwh,
           (produced - consumed) * minutes / 60.0::DOUBLE AS balance_mwh
    FROM slots
    """,
)
def slot_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "click", 15).otherwise(30).alias("minutes"),
        F.floor("value").cast("int").alias("produced"),
        as_int(F.get_json_object("props", "$.k")).alias("consumed"),
    )
    prod, conso = (energy_of_slot(F.col(c), F.col("minutes")) for c in ("produced", "consumed"))
    return plain(
        slots.select(
            "event_id",
            "minutes",
            prod.alias("prod_mwh"),
            conso.alias("conso_mwh"),
            (prod - conso).alias("balance_mwh"),
        )
    )


@query(
    "q14_mix_coverage",
    f"""
    WITH sums AS (
        SELECT strftime(o_orderdate, '%Y-%m') AS period, o_custkey AS customer,
               sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS a,
               sum(CASE WHEN o_orderpriority = '2-HIGH' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS b,
               sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS c,
               sum(CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS d,
               sum(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS e
        FROM orders GROUP BY 1, 2)
    SELECT period, CAST(customer AS DOUBLE) AS customer,
           CAST(coalesce(a,0) + coalesce(b,0) + coalesce(c,0) + coalesce(d,0) AS DOUBLE) AS renewable,
           CAST(e AS DOUBLE) AS other,
           {half_up('''CAST(coalesce(a,0) + coalesce(b,0) + coalesce(c,0) + coalesce(d,0) AS DOUBLE)
                       / nullif(CAST(e AS DOUBLE), 0) * 100''')} AS coverage_pct
    FROM sums
    """,
)
def mix_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per source, a missing source counts as zero; the ratio is one of sums, NULL without the other part."""
    amount = money("o_totalprice")
    sums = (
        table(spark, sf_dir, "orders")
        .groupBy(period_text(F.col("o_orderdate")).alias("period"), F.col("o_custkey").alias("customer"))
        .agg(*[F.sum(F.when(F.col("o_orderpriority") == s, amount)).alias(f"s{i}") for i, s in enumerate(SOURCES)])
    )
    renewable = zero_filled_sum(*[F.col(f"s{i}") for i in range(4)])
    return plain(
        sums.select(
            "period",
            "customer",
            renewable.alias("renewable"),
            F.col("s4").alias("other"),
            F.round(percent_of(renewable.cast("double"), F.col("s4").cast("double")), 2).alias("coverage_pct"),
        )
    )


@query(
    "q15_period_keys",
    """
    SELECT CAST(year(o_orderdate) AS DOUBLE) AS year, CAST(month(o_orderdate) AS DOUBLE) AS month,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
           strftime(o_orderdate, '%Y-%m') AS period, CAST(count(*) AS DOUBLE) AS n
    FROM orders GROUP BY ALL
    """,
)
def period_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
        .agg(F.count("*").alias("n"))
    )
    first_day = month_start(F.col("year"), F.col("month"))
    return plain(
        months.select("year", "month", first_day.alias("month_start"), period_text(first_day).alias("period"), "n")
    )


@query(
    "q16_monthly_energy",
    """
    SELECT CAST(year(o_orderdate) AS DOUBLE) AS year, CAST(month(o_orderdate) AS DOUBLE) AS month,
           CAST(c_nationkey AS DOUBLE) AS place, max(c_mktsegment) AS label, CAST(count(*) AS DOUBLE) AS n_slots,
           CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS DOUBLE) * 0.5 AS energy_mwh,
           CAST(sum(CASE o_orderpriority WHEN '1-URGENT' THEN CAST(floor(o_totalprice) AS BIGINT) END) AS DOUBLE) * 0.5
               AS urgent_mwh
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3
    """,
)
def monthly_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are summed per customer and month before the join: a customer with many orders shuffles few rows."""
    power, urgent = F.floor("o_totalprice").cast("int"), F.col("o_orderpriority") == "1-URGENT"
    year, month = F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    by_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", year, month)
        .agg(
            F.count("*").alias("n"), F.sum(power).alias("power"), F.sum(F.when(urgent, power)).alias("urgent_power")
        )
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    joined = by_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return plain(
        joined.groupBy("year", "month", F.col("c_nationkey").alias("place")).agg(
            F.max("c_mktsegment").alias("label"),
            F.sum("n").alias("n_slots"),
            energy_of_sum(F.col("power")).alias("energy_mwh"),
            energy_of_sum(F.col("urgent_power")).alias("urgent_mwh"),
        )
    )


@query(
    "q17_complete_month",
    """
    WITH slots AS (
        SELECT DISTINCT l_linestatus AS region,
               l_shipdate + CAST(l_quantity AS INTEGER) * INTERVAL 30 MINUTE AS slot FROM lineitem
        UNION ALL
        SELECT 'orders', TIMESTAMP '1996-01-01' + CAST(o_orderkey AS INTEGER) * INTERVAL 30 MINUTE FROM orders
        WHERE o_orderkey NOT IN (4324, 4325)),
    months AS (
        SELECT region, CAST(date_trunc('month', slot) AS DATE) AS first_day, count(*) AS n FROM slots GROUP BY 1, 2)
    SELECT region, strftime(first_day, '%Y-%m') AS period, CAST(n AS DOUBLE) AS n_slots,
           CAST(day(last_day(first_day)) * 48 - CASE month(first_day) WHEN 3 THEN 2 ELSE 0 END AS DOUBLE) AS expected,
           n = day(last_day(first_day)) * 48 - CASE month(first_day) WHEN 3 THEN 2 ELSE 0 END AS is_complete
    FROM months
    """,
)
def complete_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines leave gaps in every month; order numbers, as half hours without the two that spring skips, fill whole ones."""
    slot = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_quantity").cast("int") * 30)
    slots = table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("region"), slot.alias("slot")).distinct()
    orders = table(spark, sf_dir, "orders").where(~F.col("o_orderkey").isin(4324, 4325))
    run = F.lit("1996-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("o_orderkey").cast("int") * 30)
    slots = slots.unionByName(orders.select(F.lit("orders").alias("region"), run.alias("slot")))
    months = slots.groupBy("region", F.trunc("slot", "month").alias("first_day")).agg(F.count("*").alias("n_slots"))
    expected = slots_expected(F.col("first_day"))
    return plain(
        months.select(
            "region",
            period_text(F.col("first_day")).alias("period"),
            "n_slots",
            expected.alias("expected"),
            (F.col("n_slots") == expected).alias("is_complete"),
        )
    )


@query(
    "q17_complete_only",
    """
    WITH months AS (
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day, count(DISTINCT CAST(o_orderdate AS DATE)) AS n,
               sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
        FROM orders GROUP BY 1)
    SELECT strftime(first_day, '%Y-%m') AS period, CAST(n AS DOUBLE) AS n_days, CAST(amount AS DOUBLE) AS amount
    FROM months WHERE n = day(last_day(first_day)) - CASE month(first_day) WHEN 2 THEN 1 ELSE 0 END
    """,
)
def complete_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trends over complete months only: one slot per day, one day missing every February."""
    days = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day"))
    months = (
        days.agg(F.sum(money("o_totalprice")).alias("amount"))
        .groupBy(F.trunc("day", "month").alias("first_day"))
        .agg(F.count("*").alias("n_days"), F.sum("amount").alias("amount"))
    )
    complete = F.col("n_days") == slots_expected(F.col("first_day"), slots_per_day=1, missing={2: 1})
    return plain(
        months.where(complete).select(period_text(F.col("first_day")).alias("period"), "n_days", "amount")
    )


@query(
    "q18_surrogate_key",
    """
    SELECT CAST(l_orderkey AS DOUBLE) AS order_key, CAST(l_linenumber AS DOUBLE) AS line,
           md5(concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                         CASE l_returnflag WHEN 'R' THEN '_dbt_utils_surrogate_key_null_' ELSE l_linestatus END,
                         CAST(CAST(l_shipdate AS DATE) AS VARCHAR))) AS line_id
    FROM lineitem
    """,
)
def line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("l_returnflag") != "R", F.col("l_linestatus"))
    return plain(
        table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").alias("line"),
            surrogate_key("l_orderkey", "l_linenumber", status, F.to_date("l_shipdate")).alias("line_id"),
        )
    )
