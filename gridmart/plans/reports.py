"""Report queries over Gold tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart import feeds
from gridmart.functions.energy import percent_of, zero_filled_sum
from gridmart.operators.spread import exact_median


def commune_totals(industrial: DataFrame) -> DataFrame:
    """Industrial consumption per commune, as the map colours it."""
    return industrial.groupBy("code_commune").agg(
        F.max("libelle_commune").alias("libelle_commune"), F.sum("conso_mwh").alias("conso_mwh")
    )


def top_communes(industrial: DataFrame, n: int = 10) -> DataFrame:
    """Communes with the highest industrial consumption; equal totals in order of their code."""
    return commune_totals(industrial).orderBy(F.desc_nulls_last("conso_mwh"), "code_commune").limit(n)


def on_map(industrial: DataFrame, places: DataFrame, code: str, *attributes: str) -> DataFrame:
    """Totals with the attributes of the place each commune code stands for.

    Totals are aggregated before the join, so a place with many rows is one row of the shuffle.
    """
    place = places.select(F.col(code).alias("code_commune"), *attributes)
    return commune_totals(industrial).join(place, "code_commune", "inner")


def sector_shares(industrial: DataFrame) -> DataFrame:
    """Consumption by NAF2 division and category, and its share of all, in percent."""
    sectors = industrial.groupBy("code_secteur_naf2", "categorie_consommation").agg(
        F.sum("conso_mwh").alias("conso_mwh")
    )
    # The whole is the sum of its sectors, of which there are a few hundred at most.
    everything = F.sum("conso_mwh").over(Window.partitionBy(F.lit(0)))
    return sectors.withColumn("part_pct", percent_of(F.col("conso_mwh"), everything))


def indicator_correlation(indicators: DataFrame) -> DataFrame:
    """Pearson correlation of consumption with both indicators over complete months."""
    consumption = F.col("conso_regionale_mwh").cast("double")
    return indicators.where("est_mois_complet").agg(
        F.count("*").alias("nb_mois"),
        F.corr(consumption, F.col("ipi_valeur")).alias("correlation_ipi"),
        F.corr(consumption, F.col("bdf_valeur")).alias("correlation_bdf"),
    )


def renewable_mix(mix: DataFrame) -> DataFrame:
    """Share of each source in the renewable production of the whole period, in percent."""
    totals = [F.sum(f"prod_{source}_mwh").alias(source) for source in feeds.RENEWABLES]
    sums = mix.agg(*totals, F.sum("prod_enr_mwh").alias("total"))
    rows = [
        F.struct(F.lit(source).alias("filiere"), F.col(source).cast("double").alias("prod_mwh"))
        for source in feeds.RENEWABLES
    ]
    listed = sums.select(F.col("total").cast("double").alias("total"), F.inline(F.array(*rows)))
    return listed.select("filiere", "prod_mwh", percent_of(F.col("prod_mwh"), F.col("total")).alias("part_pct"))


def monthly_coverage_range(mix: DataFrame) -> DataFrame:
    """Lowest, mean and highest renewable coverage of the complete months."""
    rate = F.col("taux_couverture_enr").cast("double")
    return mix.where("est_mois_complet").agg(
        F.count("*").alias("nb_mois"),
        F.min(rate).alias("taux_min"),
        F.avg(rate).alias("taux_moyen"),
        F.max(rate).alias("taux_max"),
    )


def hourly_profile(balance: DataFrame) -> DataFrame:
    """Mean local coverage, and share of consumption that had to be imported, by local hour."""
    return balance.groupBy(F.substring("heure", 1, 2).alias("heure_locale")).agg(
        F.avg("taux_couverture_locale").alias("taux_moyen"),
        percent_of(-F.sum("ecart_mwh").cast("double"), F.sum("conso_mwh").cast("double")).alias("dependance_pct"),
    )


def hourly_renewable_profile(slots: DataFrame) -> DataFrame:
    """Mean renewable coverage of consumption by local hour."""
    renewable = zero_filled_sum(*[F.col(f"production_{source}_mw").cast("bigint") for source in feeds.RENEWABLES])
    rate = percent_of(renewable, F.col("consommation_mw"))
    return slots.groupBy(F.substring("heure_locale", 1, 2).alias("heure_locale")).agg(F.avg(rate).alias("taux_moyen"))


def yearly_coverage(balance: DataFrame) -> DataFrame:
    """Mean and highest local coverage of the slots of each year."""
    return balance.groupBy("annee").agg(
        F.avg("taux_couverture_locale").alias("taux_moyen"), F.max("taux_couverture_locale").alias("taux_max")
    )


def deviation_spread(
    balance: DataFrame, stage: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Lowest, median and highest distance to the month's mean coverage, per region."""
    region, value = "code_insee_region", "variation_couverture_pct"
    ends = balance.groupBy(region).agg(F.min(value).alias("ecart_min"), F.max(value).alias("ecart_max"))
    median = exact_median(balance, value, [region], stage).withColumnRenamed("median", "ecart_median")
    return ends.join(median, region, "left")


def yearly_industrial_total(industrial: DataFrame) -> DataFrame:
    """Industrial consumption of each year, in TWh."""
    return industrial.groupBy("annee").agg((F.sum("conso_mwh") / 1_000_000).alias("conso_twh"))
