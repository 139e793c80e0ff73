"""The nine tables, built by the package from the derived feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmart import feeds
from gridmart.catalogue import derived
from gridmart.catalogue.common import half_up, plain, query
from gridmart.plans import gold, silver
from gridmart.sources.tables import stager

TIME = "'%Y-%m-%d %H:%M:%S.%f'"


def _double(**columns: str) -> str:
    """SQL select list of doubles."""
    return ", ".join(f"CAST({sql} AS DOUBLE) AS {name}" for name, sql in columns.items())


def written_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver slots, written once: the marts read them, they do not parse Bronze again."""
    return stager(spark, "slots")(silver.power_slots(derived.power_log(spark, sf_dir)))


def written_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stager(spark, "months")(silver.power_months(silver.power_slots(derived.power_log(spark, sf_dir))))


_SLOT_VALUES = {
    "consommation_mw": "conso",
    "production_thermique_mw": "thermique",
    "production_eolien_mw": "eolien",
    "production_solaire_mw": "solaire",
    "production_hydraulique_mw": "hydraulique",
    "production_bioenergies_mw": "bioenergies",
    "taux_couverture_eolien_pct": "tco_eolien",
    "taux_charge_solaire_pct": "tch_solaire",
}
_SLOT_TEXTS = ("code_insee_region", "libelle_region", "nature_donnees", "date_locale", "heure_locale", "horodatage_utc")
_SLOT_DOUBLES = {c: _SLOT_VALUES.get(c, "NULL") for c in derived.SLOT_COLUMNS if c not in _SLOT_TEXTS}


@query(
    "silver_power_slots",
    f"""
    WITH {derived.power_sql()}
    SELECT id AS rte_ecomix_id, region AS code_insee_region, label AS libelle_region, nature AS nature_donnees,
           strftime(local_time, '%Y-%m-%d') AS date_locale, strftime(local_time, '%H:%M') AS heure_locale,
           strftime(slot, {TIME}) AS horodatage_utc, {_double(**_SLOT_DOUBLES)},
           dataset AS source_dataset, strftime(loaded, {TIME}) AS ingested_at
    FROM slots
    """,
)
def power_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(silver.power_slots(derived.power_log(spark, sf_dir)))


@query(
    "silver_power_months",
    f"""
    WITH {derived.power_sql()}
    SELECT md5(annee || '-' || mois || '-' || region) AS rte_mensuel_id, {_double(annee="annee", mois="mois")},
           strftime(mois_debut, '%Y-%m-%d') AS mois_debut, region AS code_insee_region, label AS libelle_region,
           CAST(n AS DOUBLE) AS nb_creneaux, complet AS est_mois_complet,
           {_double(consommation_mwh="conso", production_thermique_mwh="thermique", production_nucleaire_mwh="NULL",
                    production_eolien_mwh="eolien", production_solaire_mwh="solaire",
                    production_hydraulique_mwh="hydraulique", production_bioenergies_mwh="bioenergies")}
    FROM full_months
    """,
)
def power_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(silver.power_months(silver.power_slots(derived.power_log(spark, sf_dir))))


@query(
    "silver_annual_consumption",
    f"""
    WITH {derived.ANNUAL_SQL}
    SELECT md5(concat_ws('-', annee, commune, secteur, coalesce(naf2, '_dbt_utils_surrogate_key_null_'), categorie))
               AS enedis_conso_id,
           {_double(annee="annee", nb_sites="sites", conso_totale_mwh="mwh")}, commune AS code_commune,
           nom AS nom_commune, '52' AS code_region, secteur AS code_grand_secteur, naf2 AS code_secteur_naf2,
           categorie AS code_categorie_consommation, '{feeds.DATASET_ANNUAL}' AS source_dataset,
           strftime(loaded, {TIME}) AS ingested_at
    FROM annual
    """,
)
def annual_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(silver.annual_consumption(derived.annual_log(spark, sf_dir)))


@query(
    "silver_production_index",
    f"""
    WITH {derived.INDEX_SQL}
    SELECT md5(idbank || '-' || CAST(mois AS VARCHAR)) AS insee_ipi_id, idbank, libelle AS libelle_serie,
           strftime(mois, '%Y-%m') AS periode, strftime(mois, '%Y-%m-%d') AS mois, valeur,
           statut AS statut_observation, '{feeds.DATASET_INDEX}' AS source_dataset,
           strftime(loaded, {TIME}) AS ingested_at
    FROM idx
    """,
)
def production_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(silver.production_index(derived.index_log(spark, sf_dir)))


@query(
    "silver_business_survey",
    f"""
    WITH {derived.SURVEY_SQL}
    SELECT md5(cle || '-' || CAST(mois AS VARCHAR)) AS bdf_pmi_id, cle AS cle_serie, libelle AS libelle_serie,
           strftime(mois, '%Y-%m') AS periode, strftime(mois, '%Y-%m-%d') AS mois, valeur,
           '{feeds.DATASET_SURVEY}' AS source_dataset, strftime(loaded, {TIME}) AS ingested_at
    FROM survey
    """,
)
def business_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(silver.business_survey(derived.survey_log(spark, sf_dir)))


INDUSTRIAL_SQL = """
    industrial AS (SELECT * FROM annual WHERE secteur = 'INDUSTRIE')
    """


@query(
    "gold_industrial_consumption",
    f"""
    WITH {derived.ANNUAL_SQL}, {INDUSTRIAL_SQL}
    SELECT md5(concat_ws('-', annee, commune, coalesce(naf2, '_dbt_utils_surrogate_key_null_'), categorie))
               AS conso_industrielle_id,
           {_double(annee="annee", conso_mwh="mwh", nb_points_de_soutirage="sites")}, commune AS code_commune,
           nom AS libelle_commune, naf2 AS code_secteur_naf2, categorie AS categorie_consommation
    FROM industrial
    """,
)
def industrial_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(industrial_mart(spark, sf_dir))


def industrial_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.industrial_consumption(silver.annual_consumption(derived.annual_log(spark, sf_dir)))


MIX_SQL = f"""
    filled AS (
        SELECT *, coalesce(eolien, 0) + coalesce(solaire, 0) + coalesce(hydraulique, 0) + coalesce(bioenergies, 0)
                  AS enr FROM full_months),
    mix AS (
        SELECT *, enr + coalesce(thermique, 0) AS total,
               {half_up("CAST(enr AS DOUBLE) / nullif(CAST(conso AS DOUBLE), 0) * 100")} AS taux FROM filled)
    """


@query(
    "gold_regional_mix",
    f"""
    WITH {derived.power_sql()}, {MIX_SQL}
    SELECT md5(annee || '-' || mois || '-' || region) AS production_regionale_id,
           strftime(mois_debut, '%Y-%m') AS periode, region AS code_insee_region, label AS region,
           {_double(annee="annee", mois="mois", prod_totale_mwh="total", prod_enr_mwh="enr",
                    prod_eolien_mwh="coalesce(eolien, 0)", prod_solaire_mwh="coalesce(solaire, 0)",
                    prod_hydraulique_mwh="coalesce(hydraulique, 0)", prod_bioenergies_mwh="coalesce(bioenergies, 0)",
                    conso_totale_mwh="conso", taux_couverture_enr="taux")}, complet AS est_mois_complet
    FROM mix
    """,
)
def regional_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(mix_mart(spark, sf_dir))


def mix_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.regional_mix(silver.power_months(silver.power_slots(derived.power_log(spark, sf_dir))))


def _change(value: str, before: str) -> str:
    """SQL of a change in percent against the previous row, if that is the previous calendar month."""
    rate = half_up(f"({value} - {before}) / nullif({before}, 0) * 100")
    return f"CASE WHEN m_before = mois_debut - INTERVAL 1 MONTH THEN {rate} END"


INDICATORS_SQL = f"""
    joined AS (
        SELECT m.region, m.annee, m.mois, m.mois_debut, m.complet, CAST(m.conso AS DOUBLE) AS conso,
               idx.idbank, idx.valeur AS ipi, survey.cle, survey.valeur AS bdf
        FROM full_months m
        JOIN idx ON idx.mois = m.mois_debut AND idx.idbank = '{feeds.MART_INDEX_SERIES}'
        JOIN survey ON survey.mois = m.mois_debut AND survey.cle = '{feeds.MART_SURVEY_SERIES}'),
    previous AS (
        SELECT *, lag(mois_debut) OVER w AS m_before, lag(conso) OVER w AS conso_before, lag(ipi) OVER w AS ipi_before,
               lag(bdf) OVER w AS bdf_before
        FROM joined WINDOW w AS (PARTITION BY region ORDER BY mois_debut))
    """


@query(
    "gold_aligned_indicators",
    f"""
    WITH {derived.power_sql()}, {derived.INDEX_SQL}, {derived.SURVEY_SQL}, {INDICATORS_SQL}
    SELECT md5(annee || '-' || mois || '-' || region) AS correlation_id, region AS code_insee_region,
           {_double(annee="annee", mois="mois")}, strftime(mois_debut, '%Y-%m') AS periode,
           complet AS est_mois_complet, conso AS conso_regionale_mwh, idbank AS ipi_serie, ipi AS ipi_valeur,
           cle AS bdf_serie, bdf AS bdf_valeur, {_change("conso", "conso_before")} AS variation_conso_pct,
           {_change("ipi", "ipi_before")} AS variation_ipi_pct, {_change("bdf", "bdf_before")} AS variation_bdf_pct
    FROM previous
    """,
)
def aligned_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(indicator_mart(spark, sf_dir))


def indicator_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.aligned_indicators(
        written_months(spark, sf_dir),
        stager(spark, "index")(silver.production_index(derived.index_log(spark, sf_dir))),
        stager(spark, "survey")(silver.business_survey(derived.survey_log(spark, sf_dir))),
        by=["code_insee_region"],
    )


BALANCE_SQL = f"""
    rates AS (
        SELECT *, thermique + eolien + solaire + coalesce(hydraulique, 0) + bioenergies AS prod,
               CASE flag WHEN 'R' THEN 15 ELSE 30 END AS pas,
               (thermique + eolien + solaire + coalesce(hydraulique, 0) + bioenergies)::DOUBLE
                   / nullif(conso, 0)::DOUBLE * 100 AS couverture
        FROM slots),
    compared AS (
        SELECT *, (couverture / nullif(avg(couverture) OVER (
                       PARTITION BY region, year(local_time), month(local_time)), 0) - 1) * 100 AS ecart
        FROM rates),
    balance AS (
        SELECT *, prod * pas / 60.0::DOUBLE AS prod_mwh, conso * pas / 60.0::DOUBLE AS conso_mwh,
               (prod - conso) * pas / 60.0::DOUBLE AS ecart_mwh, {half_up("couverture")} AS taux,
               {half_up("ecart")} AS variation
        FROM compared)
    """


@query(
    "gold_slot_balance",
    f"""
    WITH {derived.power_sql()}, {BALANCE_SQL}
    SELECT id AS tension_id, strftime(slot, {TIME}) AS date_heure, CAST(year(slot) AS DOUBLE) AS annee,
           region AS code_insee_region, label AS region, strftime(local_time, '%Y-%m-%d') AS date,
           strftime(local_time, '%H:%M') AS heure, CAST(pas AS DOUBLE) AS pas_minutes, prod_mwh, conso_mwh,
           ecart_mwh, taux AS taux_couverture_locale, variation AS variation_couverture_pct
    FROM balance
    """,
)
def slot_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(balance_mart(spark, sf_dir))


def balance_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.slot_balance(written_slots(spark, sf_dir), stager(spark, "means"))
