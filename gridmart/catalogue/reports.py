"""Report queries over the marts of the derived feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.catalogue import derived
from gridmart.catalogue.common import plain, query, rounded, table
from gridmart.catalogue.models import (
    BALANCE_SQL,
    INDICATORS_SQL,
    INDUSTRIAL_SQL,
    MIX_SQL,
    balance_mart,
    indicator_mart,
    industrial_mart,
    mix_mart,
)
from gridmart.functions.casts import padded_code
from gridmart.plans import reports, silver
from gridmart.sources.tables import stager

INDUSTRY = f"WITH {derived.ANNUAL_SQL}, {INDUSTRIAL_SQL}"
MWH = "sum(CAST(mwh AS DECIMAL(18,2)))"


@query(
    "r01_top_communes",
    f"""{INDUSTRY}
    SELECT commune AS code_commune, max(nom) AS libelle_commune, CAST({MWH} AS DOUBLE) AS conso_mwh
    FROM industrial GROUP BY 1 ORDER BY {MWH} DESC NULLS LAST, 1 LIMIT 10
    """,
)
def top_communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.top_communes(industrial_mart(spark, sf_dir)), 2, "conso_mwh")


@query(
    "r01_commune_map",
    f"""{INDUSTRY}
    SELECT commune AS code_commune, max(nom) AS libelle_commune, CAST({MWH} AS DOUBLE) AS conso_mwh, s_name,
           CAST(s_nationkey AS DOUBLE) AS s_nationkey
    FROM industrial JOIN supplier ON lpad(CAST(s_suppkey AS VARCHAR), 5, '0') = commune GROUP BY 1, 4, 5
    """,
)
def commune_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "supplier").withColumn("code", padded_code(F.col("s_suppkey").cast("string")))
    shapes = reports.on_map(industrial_mart(spark, sf_dir), places, "code", "s_name", "s_nationkey")
    return rounded(plain(shapes), 2, "conso_mwh")


@query(
    "r02_sector_shares",
    f"""{INDUSTRY}
    SELECT naf2 AS code_secteur_naf2, categorie AS categorie_consommation, CAST({MWH} AS DOUBLE) AS conso_mwh,
           round(CAST({MWH} AS DOUBLE) / CAST(sum({MWH}) OVER () AS DOUBLE) * 100, 6) AS part_pct
    FROM industrial GROUP BY 1, 2
    """,
)
def sector_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = reports.sector_shares(industrial_mart(spark, sf_dir))
    return rounded(rounded(shares, 2, "conso_mwh"), 6, "part_pct")


@query(
    "r03_indicator_correlation",
    f"""
    WITH {derived.power_sql()}, {derived.INDEX_SQL}, {derived.SURVEY_SQL}, {INDICATORS_SQL}
    SELECT CAST(count(*) AS DOUBLE) AS nb_mois, round(corr(conso, ipi), 9) AS correlation_ipi,
           round(corr(conso, bdf), 9) AS correlation_bdf
    FROM joined WHERE complet
    """,
)
def indicator_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    indicators = indicator_mart(spark, sf_dir)
    return rounded(plain(reports.indicator_correlation(indicators)), 9, "correlation_ipi", "correlation_bdf")


@query(
    "r04_renewable_mix",
    f"""
    WITH {derived.power_sql()}, {MIX_SQL},
    sums AS (
        SELECT unnest(['eolien', 'solaire', 'hydraulique', 'bioenergies']) AS filiere,
               unnest([sum(eolien), sum(solaire), sum(hydraulique), sum(bioenergies)]) AS prod, sum(enr) AS total
        FROM mix)
    SELECT filiere, CAST(prod AS DOUBLE) AS prod_mwh, CAST(prod AS DOUBLE) / CAST(total AS DOUBLE) * 100 AS part_pct
    FROM sums
    """,
)
def renewable_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.renewable_mix(mix_mart(spark, sf_dir))


@query(
    "r04_coverage_range",
    f"""
    WITH {derived.power_sql()}, {MIX_SQL}
    SELECT CAST(count(*) AS DOUBLE) AS nb_mois, min(taux) AS taux_min, round(avg(taux), 6) AS taux_moyen,
           max(taux) AS taux_max
    FROM mix WHERE complet
    """,
)
def coverage_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_mart(spark, sf_dir)
    return rounded(plain(reports.monthly_coverage_range(mix)), 6, "taux_moyen")


@query(
    "r05_hourly_profile",
    f"""
    WITH {derived.power_sql()}, {BALANCE_SQL}
    SELECT strftime(local_time, '%H') AS heure_locale, round(avg(taux), 6) AS taux_moyen,
           round(-sum(ecart_mwh) / nullif(sum(conso_mwh), 0) * 100, 6) AS dependance_pct
    FROM balance GROUP BY 1
    """,
)
def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.hourly_profile(balance_mart(spark, sf_dir)), 6, "taux_moyen", "dependance_pct")


@query(
    "r05_hourly_renewable_profile",
    f"""
    WITH {derived.power_sql()}
    SELECT strftime(local_time, '%H') AS heure_locale,
           round(avg((eolien + solaire + coalesce(hydraulique, 0) + bioenergies)::DOUBLE
                     / nullif(conso, 0)::DOUBLE * 100), 6) AS taux_moyen
    FROM slots GROUP BY 1
    """,
)
def hourly_renewable_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.hourly_renewable_profile(silver.power_slots(derived.power_log(spark, sf_dir))), 6, "taux_moyen")


@query(
    "r06_yearly_coverage",
    f"""
    WITH {derived.power_sql()}, {BALANCE_SQL}
    SELECT CAST(year(slot) AS DOUBLE) AS annee, round(avg(taux), 6) AS taux_moyen, max(taux) AS taux_max
    FROM balance GROUP BY 1
    """,
)
def yearly_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(plain(reports.yearly_coverage(balance_mart(spark, sf_dir))), 6, "taux_moyen")


@query(
    "r07_deviation_spread",
    f"""
    WITH {derived.power_sql()}, {BALANCE_SQL}
    SELECT region AS code_insee_region, min(variation) AS ecart_min, max(variation) AS ecart_max,
           round(median(variation), 6) AS ecart_median
    FROM balance GROUP BY 1
    """,
)
def deviation_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = stager(spark, "balance")(balance_mart(spark, sf_dir))
    spread = reports.deviation_spread(balance, stager(spark, "counts"))
    return rounded(spread, 6, "ecart_median")


@query(
    "r08_industrial_total",
    f"""{INDUSTRY}
    SELECT CAST(annee AS DOUBLE) AS annee, round(CAST({MWH} AS DOUBLE) / 1000000, 8) AS conso_twh
    FROM industrial GROUP BY 1
    """,
)
def industrial_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(plain(reports.yearly_industrial_total(industrial_mart(spark, sf_dir))), 8, "conso_twh")
