"""The four feeds, derived row by row from the driver's tables, as Bronze records and as SQL.

The Bronze side goes through JSON text with quoted numbers, words, missing keys and offsets; the SQL
side states the typed values directly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import feeds
from gridmart.catalogue.common import as_read, money, spread, table
from gridmart.plans.silver import SLOT_FIELDS
from gridmart.sources import bronze

# 2026-01-01 00:00 UTC in microseconds
EPOCH_2026 = 1767225600000000
# Orders fill a run of half hours from here on, local time, so that months are complete; the hours that the
# spring clock change skips have no consumption
DENSE_FROM = "1996-01-01 00:00:00"
SPRING_HOURS = ("1996-03-31 02:00:00", "1996-03-31 02:30:00")


def _load_time(key: str, amount: str) -> Column:
    """A time of its own for each version of a key: a second per order, microseconds by price."""
    return F.timestamp_micros(F.lit(EPOCH_2026) + F.col(key) * 1000000 + F.round(F.col(amount) * 100).cast("long"))


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


#: Rows of a feed, and the columns of its Bronze records that are worked out from them.
Load = tuple[DataFrame, dict[str, Column]]
#: How a table is dealt over tasks before its rows become records.
Deal = Callable[[DataFrame], DataFrame]


def power_log(
    spark: SparkSession, sf_dir: str, one_region: bool = False, parts: int | None = None, deal: Deal | None = None
) -> DataFrame:
    """Lines as power slots: quantity is the half hour, price the consumption, return flag the nature; and orders as
    consecutive slots of one region, which make up whole months.

    Some consumptions are missing (slot published ahead), a word, or zero. ``one_region`` gives the slots
    the constraints ask for: region 52 alone, no zero. ``parts`` is how many parts the lines come in, and the orders.
    """
    return bronze.records(*power_load(spark, sf_dir, one_region, deal or (lambda df: spread(df, parts))))


def power_load(spark: SparkSession, sf_dir: str, one_region: bool = False, deal: Deal = as_read) -> Load:
    """``power_log`` as rows, a fraction of their JSON, and what they become."""
    rows = _line_rows(spark, sf_dir, one_region, deal).unionByName(_dense_rows(spark, sf_dir, deal))
    local, iso = F.col("local"), "yyyy-MM-dd'T'HH:mm:ss"
    day = F.date_format(local, "yyyy-MM-dd")
    zoned = F.concat(F.date_format(local + F.expr("interval 1 hour"), iso), F.lit("+02:00"))
    record = {
        "code_insee_region": F.col("region"),
        "libelle_region": F.concat(F.lit("Région "), F.col("region")),
        "nature": F.col("nature"),
        "date": day,
        "heure": F.date_format(local, "HH:mm"),
        "date_heure": F.when(F.col("zoned"), zoned).otherwise(F.date_format(local - F.expr("interval 1 hour"), iso)),
        "consommation": F.col("consommation"),
        "thermique": _text("thermique"),
        "eolien": F.col("eolien"),  # a JSON number, not text
        "solaire": _text("solaire"),
        "hydraulique": F.col("hydraulique"),
        "bioenergies": _text("bioenergies"),
        "tco_eolien": _text("tco_eolien"),
        "tch_solaire": _text("tch_solaire"),
    }
    return rows, {"payload": _json(record), "extracted_for": day}


def _json(record: dict[str, Column]) -> Column:
    """JSON object of a record without times; NULLs are kept."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in record.items()]), {"ignoreNullFields": "false"})


def _dense_rows(spark: SparkSession, sf_dir: str, deal: Deal) -> DataFrame:
    """Order number n as the n-th half hour from ``DENSE_FROM``."""
    orders = deal(table(spark, sf_dir, "orders"))
    number = F.col("o_orderkey").cast("int")
    local = F.lit(DENSE_FROM).cast("timestamp_ntz") + F.make_dt_interval(mins=number * 30)
    price = _text(F.floor(F.col("o_totalprice") / 10))
    return orders.select(
        F.lit("52").alias("region"),
        F.lit(feeds.NATURE_FINAL).alias("nature"),
        local.alias("local"),
        F.lit(False).alias("zoned"),
        F.when(~F.date_format(local, "yyyy-MM-dd HH:mm:ss").isin(*SPRING_HOURS), price).alias("consommation"),
        F.col("o_custkey").alias("thermique"),
        (F.col("o_orderkey") % 50).cast("int").alias("eolien"),
        (F.col("o_custkey") % 100).alias("solaire"),
        _text(F.length("o_orderstatus")).alias("hydraulique"),
        F.length("o_orderpriority").cast("long").alias("bioenergies"),
        F.lit(0.5).alias("tco_eolien"),
        F.lit(0.25).alias("tch_solaire"),
        F.lit(feeds.DATASET_CONSOLIDATED).alias("source_dataset"),
        _load_time("o_orderkey", "o_totalprice").alias("ingested_at"),
    )


def _line_rows(spark: SparkSession, sf_dir: str, one_region: bool, deal: Deal) -> DataFrame:
    line, flag = deal(table(spark, sf_dir, "lineitem")), F.col("l_returnflag")
    half_hours = F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_quantity").cast("int") * 30)
    slot = F.col("l_shipdate").cast("timestamp_ntz") + half_hours
    region = F.lit("52") if one_region else F.when(F.col("l_linestatus") == "F", "52").otherwise("53")
    consumption = F.when(F.col("l_discount") == 0.1, None).when(F.col("l_tax") == 0.08, "ND")
    if not one_region:
        consumption = consumption.when((F.col("l_tax") == 0.0) & (F.col("l_discount") == 0.0), "0")
    return line.select(
        region.alias("region"),
        F.when(flag == "A", feeds.NATURE_FINAL)
        .when(flag == "N", feeds.NATURE_CONSOLIDATED)
        .otherwise(feeds.NATURE_REALTIME)
        .alias("nature"),
        (slot + F.expr("interval 1 hour")).alias("local"),
        F.coalesce(flag == "N", F.lit(False)).alias("zoned"),
        consumption.otherwise(_text(F.floor(F.col("l_extendedprice") / 10))).alias("consommation"),
        F.col("l_suppkey").alias("thermique"),
        (F.col("l_quantity") * 20).cast("int").alias("eolien"),
        (F.col("l_linenumber") * 50).cast("long").alias("solaire"),
        F.when(flag == "A", "ND").otherwise(_text("l_suppkey")).alias("hydraulique"),
        F.col("l_partkey").alias("bioenergies"),
        F.col("l_tax").alias("tco_eolien"),
        F.col("l_discount").alias("tch_solaire"),
        F.when(flag == "R", feeds.DATASET_REALTIME).otherwise(feeds.DATASET_CONSOLIDATED).alias("source_dataset"),
        _load_time("l_orderkey", "l_extendedprice").alias("ingested_at"),
    )


def power_sql(one_region: bool = False) -> str:
    """Common table ``slots``: the Silver power slots, ``slot`` being the UTC instant."""
    region = "'52'" if one_region else "CASE l_linestatus WHEN 'F' THEN '52' ELSE '53' END"
    zero = "" if one_region else "WHEN l_tax = 0.0 AND l_discount = 0.0 THEN 0"
    return f"""
    raw AS (
        SELECT {region} AS region, l_returnflag AS flag,
               l_shipdate + CAST(l_quantity AS INTEGER) * INTERVAL 30 MINUTE AS slot,
               CASE WHEN l_discount = 0.1 OR l_tax = 0.08 THEN NULL {zero}
                    ELSE CAST(floor(l_extendedprice / 10) AS BIGINT) END AS conso,
               l_suppkey AS thermique, CAST(l_quantity * 20 AS BIGINT) AS eolien, l_linenumber * 50 AS solaire,
               CASE WHEN l_returnflag <> 'A' THEN l_suppkey END AS hydraulique, l_partkey AS bioenergies,
               l_tax AS tco_eolien, l_discount AS tch_solaire,
               make_timestamp({EPOCH_2026} + l_orderkey * 1000000 + CAST(round(l_extendedprice * 100) AS BIGINT))
                   AS loaded
        FROM lineitem
        UNION ALL
        SELECT '52', 'A', local_time - INTERVAL 1 HOUR,
               CASE WHEN strftime(local_time, '%Y-%m-%d %H:%M:%S') NOT IN {SPRING_HOURS}
                    THEN CAST(floor(o_totalprice / 10) AS BIGINT) END,
               o_custkey, o_orderkey % 50, o_custkey % 100, length(o_orderstatus), length(o_orderpriority),
               0.5, 0.25,
               make_timestamp({EPOCH_2026} + o_orderkey * 1000000 + CAST(round(o_totalprice * 100) AS BIGINT))
        FROM (SELECT *, TIMESTAMP '{DENSE_FROM}' + CAST(o_orderkey AS INTEGER) * INTERVAL 30 MINUTE AS local_time FROM orders)),
    slots AS (
        SELECT *, 'Région ' || region AS label, slot + INTERVAL 1 HOUR AS local_time,
               CASE flag WHEN 'R' THEN '{feeds.DATASET_REALTIME}' ELSE '{feeds.DATASET_CONSOLIDATED}' END AS dataset,
               CASE flag WHEN 'A' THEN '{feeds.NATURE_FINAL}' WHEN 'N' THEN '{feeds.NATURE_CONSOLIDATED}'
                         ELSE '{feeds.NATURE_REALTIME}' END AS nature,
               md5(region || '-' || CAST(slot AS VARCHAR)) AS id
        FROM raw WHERE conso IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY region, slot
            ORDER BY CASE flag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END, loaded DESC, bioenergies, thermique) = 1),
    months AS (
        SELECT year(local_time) AS annee, month(local_time) AS mois,
               CAST(date_trunc('month', local_time) AS DATE) AS mois_debut, region, max(label) AS label,
               count(*) AS n, sum(conso) * 0.5 AS conso, sum(thermique) * 0.5 AS thermique,
               sum(eolien) * 0.5 AS eolien, sum(solaire) * 0.5 AS solaire, sum(hydraulique) * 0.5 AS hydraulique,
               sum(bioenergies) * 0.5 AS bioenergies
        FROM slots WHERE dataset = '{feeds.DATASET_CONSOLIDATED}' GROUP BY ALL),
    full_months AS (
        SELECT *, n = day(last_day(mois_debut)) * 48 - CASE mois WHEN 3 THEN 2 ELSE 0 END AS complet FROM months)
    """


SLOT_COLUMNS = [field.column for field in SLOT_FIELDS]


def annual_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as yearly consumption: supplier is the commune, return flag the sector, price the energy."""
    return bronze.records(*annual_load(spark, sf_dir, spread))


def annual_load(spark: SparkSession, sf_dir: str, deal: Deal = as_read) -> Load:
    flag, closed = F.col("l_returnflag"), F.col("l_linestatus") == "F"
    rows = deal(table(spark, sf_dir, "lineitem")).select(
        "l_shipdate", "l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_tax", "l_extendedprice",
        F.lit(feeds.DATASET_ANNUAL).alias("source_dataset"),
        _load_time("l_orderkey", "l_extendedprice").alias("ingested_at"),
    )
    year = _text(F.year("l_shipdate"))
    record = {
        "annee": year,
        "code_commune": _text("l_suppkey"),
        "nom_commune": F.concat(F.lit("Commune "), _text("l_suppkey")),
        "code_region": F.lit("52"),
        "code_grand_secteur": F.when(flag == "A", " industrie ").when(flag == "N", "Tertiaire").otherwise("RESIDENTIEL"),
        "code_secteur_naf2": F.when(closed, _text("l_linenumber")),
        "code_categorie_consommation": F.when(closed, "ent").otherwise(" Pro"),
        "nb_sites": F.col("l_quantity").cast("int"),
        "conso_totale_mwh": F.when(F.col("l_tax") == 0.08, "").otherwise(_text(money("l_extendedprice"))),
    }
    return rows, {"payload": _json(record), "extracted_for": year}


ANNUAL_SQL = f"""
    raw_annual AS (
        SELECT year(l_shipdate) AS annee, lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS commune,
               'Commune ' || l_suppkey AS nom,
               CASE l_returnflag WHEN 'A' THEN 'INDUSTRIE' WHEN 'N' THEN 'TERTIAIRE' ELSE 'RESIDENTIEL' END AS secteur,
               CASE l_linestatus WHEN 'F' THEN CAST(l_linenumber AS VARCHAR) END AS naf2,
               CASE l_linestatus WHEN 'F' THEN 'ENT' ELSE 'PRO' END AS categorie,
               CAST(l_quantity AS INTEGER) AS sites,
               CASE WHEN l_tax <> 0.08 THEN l_extendedprice END AS mwh,
               make_timestamp({EPOCH_2026} + l_orderkey * 1000000 + CAST(round(l_extendedprice * 100) AS BIGINT))
                   AS loaded
        FROM lineitem),
    annual AS (
        SELECT * FROM raw_annual
        QUALIFY row_number() OVER (PARTITION BY annee, commune, secteur, naf2, categorie ORDER BY loaded DESC) = 1)
    """


def index_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as revised observations of one series per priority; pending orders carry quarters."""
    return bronze.records(*index_load(spark, sf_dir, spread))


def index_load(spark: SparkSession, sf_dir: str, deal: Deal = as_read) -> Load:
    day, status, priority = F.col("o_orderdate"), F.col("o_orderstatus"), F.col("o_orderpriority")
    record = {
        "idbank": F.when(priority == "1-URGENT", feeds.MART_INDEX_SERIES).otherwise(priority),
        "libelle_serie": F.concat(F.lit("Série "), priority),
        "time_period": F.when(status == "P", F.concat(_text(F.year(day)), F.lit("-Q"), _text(F.quarter(day))))
        .otherwise(F.date_format(day, "yyyy-MM")),
        "obs_value": _text(money("o_totalprice")),
        "obs_status": status,
    }
    return _order_rows(spark, sf_dir, feeds.DATASET_INDEX, deal), {"payload": _json(record), "extracted_for": F.lit("full")}


def _order_rows(spark: SparkSession, sf_dir: str, dataset: str, deal: Deal) -> DataFrame:
    return deal(table(spark, sf_dir, "orders")).select(
        "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.lit(dataset).alias("source_dataset"),
        _load_time("o_orderkey", "o_totalprice").alias("ingested_at"),
    )


INDEX_SQL = f"""
    raw_index AS (
        SELECT CASE o_orderpriority WHEN '1-URGENT' THEN '{feeds.MART_INDEX_SERIES}' ELSE o_orderpriority END AS idbank,
               'Série ' || o_orderpriority AS libelle, CAST(date_trunc('month', o_orderdate) AS DATE) AS mois,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS valeur, o_orderstatus AS statut,
               make_timestamp({EPOCH_2026} + o_orderkey * 1000000 + CAST(round(o_totalprice * 100) AS BIGINT))
                   AS loaded
        FROM orders WHERE o_orderstatus <> 'P'),
    idx AS (
        SELECT * FROM raw_index QUALIFY row_number() OVER (PARTITION BY idbank, mois ORDER BY loaded DESC) = 1)
    """


def survey_log(spark: SparkSession, sf_dir: str, complete: bool = False) -> DataFrame:
    """Orders as survey observations of one series per status; low-priority ones lack a value unless ``complete``."""
    return bronze.records(*survey_load(spark, sf_dir, complete, spread))


def survey_load(spark: SparkSession, sf_dir: str, complete: bool = False, deal: Deal = as_read) -> Load:
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    record = {
        "series_key": F.when(status == "F", feeds.MART_SURVEY_SERIES).otherwise(status),
        "title_fr": F.concat(F.lit("Série "), status),
        "time_period": F.date_format("o_orderdate", "yyyy-MM"),
        "obs_value": price if complete else F.when(F.col("o_orderpriority") != "5-LOW", price),
        "obs_status": F.lit("A"),
    }
    return _order_rows(spark, sf_dir, feeds.DATASET_SURVEY, deal), {"payload": _json(record), "extracted_for": F.lit("full")}


SURVEY_SQL = f"""
    raw_survey AS (
        SELECT CASE o_orderstatus WHEN 'F' THEN '{feeds.MART_SURVEY_SERIES}' ELSE o_orderstatus END AS cle,
               'Série ' || o_orderstatus AS libelle, CAST(date_trunc('month', o_orderdate) AS DATE) AS mois,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS valeur,
               make_timestamp({EPOCH_2026} + o_orderkey * 1000000 + CAST(round(o_totalprice * 100) AS BIGINT))
                   AS loaded
        FROM orders),
    survey AS (
        SELECT * FROM raw_survey QUALIFY row_number() OVER (PARTITION BY cle, mois ORDER BY loaded DESC) = 1)
    """
