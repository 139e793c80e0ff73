"""Gold: the four marts, every column named."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart import feeds
from gridmart.functions.energy import energy_of_slot, percent_of, slot_minutes, zero_filled_sum
from gridmart.functions.keys import surrogate_key
from gridmart.functions.periods import period_text
from gridmart.operators.align import common_periods
from gridmart.operators.change import month_over_month
from gridmart.operators.groupmean import gap_to_group_mean


def industrial_consumption(annual: DataFrame) -> DataFrame:
    """Annual consumption of industry; values the source leaves empty stay empty."""
    key = ("annee", "code_commune", "code_secteur_naf2", "code_categorie_consommation")
    return annual.where(F.col("code_grand_secteur") == feeds.INDUSTRY).select(
        surrogate_key(*key).alias("conso_industrielle_id"),
        "annee",
        "code_commune",
        F.col("nom_commune").alias("libelle_commune"),
        "code_secteur_naf2",
        F.col("code_categorie_consommation").alias("categorie_consommation"),
        F.col("conso_totale_mwh").alias("conso_mwh"),
        F.col("nb_sites").alias("nb_points_de_soutirage"),
    )


def regional_mix(months: DataFrame) -> DataFrame:
    """Production by source, renewable total and its share of consumption, per region and month."""
    filled = months.select(
        "annee",
        "mois",
        "mois_debut",
        "code_insee_region",
        "libelle_region",
        "est_mois_complet",
        "consommation_mwh",
        *[F.coalesce(f"production_{s}_mwh", F.lit(0)).alias(f"prod_{s}_mwh") for s in feeds.SOURCES],
    )
    renewable = zero_filled_sum(*[F.col(f"prod_{source}_mwh") for source in feeds.RENEWABLES])
    everything = zero_filled_sum(*[F.col(f"prod_{source}_mwh") for source in feeds.SOURCES])
    return filled.select(
        surrogate_key("annee", "mois", "code_insee_region").alias("production_regionale_id"),
        "annee",
        "mois",
        period_text(F.col("mois_debut")).alias("periode"),
        "code_insee_region",
        F.col("libelle_region").alias("region"),
        everything.alias("prod_totale_mwh"),
        renewable.alias("prod_enr_mwh"),
        *[f"prod_{source}_mwh" for source in feeds.RENEWABLES],
        F.col("consommation_mwh").alias("conso_totale_mwh"),
        F.round(percent_of(renewable, F.col("consommation_mwh")), 2).alias("taux_couverture_enr"),
        "est_mois_complet",
    )


def aligned_indicators(
    months: DataFrame,
    index: DataFrame,
    survey: DataFrame,
    index_series: str = feeds.MART_INDEX_SERIES,
    survey_series: str = feeds.MART_SURVEY_SERIES,
    by: Sequence[str] = (),
) -> DataFrame:
    """Consumption, production index and business climate for the months all three have.

    ``by`` adds key columns of ``months`` (the region, once there are several) to the grain.
    """
    consumption = months.select(
        *by,
        "annee",
        "mois",
        "mois_debut",
        "est_mois_complet",
        F.col("consommation_mwh").alias("conso_regionale_mwh"),
    )
    index_values = index.where(F.col("idbank") == index_series).select(
        F.col("mois").alias("mois_debut"), F.col("idbank").alias("ipi_serie"), F.col("valeur").alias("ipi_valeur")
    )
    survey_values = survey.where(F.col("cle_serie") == survey_series).select(
        F.col("mois").alias("mois_debut"), F.col("cle_serie").alias("bdf_serie"), F.col("valeur").alias("bdf_valeur")
    )
    joined = common_periods([consumption, index_values, survey_values], ["mois_debut"])
    changes = {
        "variation_conso_pct": "conso_regionale_mwh",
        "variation_ipi_pct": "ipi_valeur",
        "variation_bdf_pct": "bdf_valeur",
    }
    return month_over_month(joined, "mois_debut", changes, by).select(
        surrogate_key("annee", "mois", *by).alias("correlation_id"),
        *by,
        "annee",
        "mois",
        period_text(F.col("mois_debut")).alias("periode"),
        "est_mois_complet",
        "conso_regionale_mwh",
        "ipi_serie",
        "ipi_valeur",
        "bdf_serie",
        "bdf_valeur",
        *changes,
    )


def slot_balance(slots: DataFrame, stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Energy balance and local coverage of every slot, and its distance to the month's mean coverage.

    ``slots`` is read twice (once for the monthly means), so pass a written table, not a plan over Bronze.
    """
    produced = zero_filled_sum(*[F.col(f"production_{source}_mw").cast("bigint") for source in feeds.SOURCES])
    power = slots.select(
        F.col("rte_ecomix_id").alias("tension_id"),
        F.col("horodatage_utc").alias("date_heure"),
        F.year("horodatage_utc").alias("annee"),
        "code_insee_region",
        F.col("libelle_region").alias("region"),
        F.col("date_locale").alias("date"),
        F.col("heure_locale").alias("heure"),
        slot_minutes(F.col("source_dataset")).alias("pas_minutes"),
        produced.alias("production_mw"),
        "consommation_mw",
        percent_of(produced, F.col("consommation_mw")).alias("couverture"),
    )
    local_month = {
        "groupe_region": F.col("code_insee_region"),
        "groupe_annee": F.year("date"),
        "groupe_mois": F.month("date"),
    }
    compared = gap_to_group_mean(power, "couverture", local_month, "variation_couverture_pct", stage)
    prod = energy_of_slot(F.col("production_mw"), F.col("pas_minutes"))
    conso = energy_of_slot(F.col("consommation_mw"), F.col("pas_minutes"))
    return compared.select(
        "tension_id",
        "date_heure",
        "annee",
        "code_insee_region",
        "region",
        "date",
        "heure",
        "pas_minutes",
        prod.alias("prod_mwh"),
        conso.alias("conso_mwh"),
        (prod - conso).alias("ecart_mwh"),
        F.round("couverture", 2).alias("taux_couverture_locale"),
        "variation_couverture_pct",
    )
