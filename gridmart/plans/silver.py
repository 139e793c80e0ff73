"""Silver: typed, one best version per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart import feeds
from gridmart.functions.casts import (
    as_date,
    as_double,
    as_instant,
    as_int,
    clean_code,
    month_of_period,
    padded_code,
)
from gridmart.functions.energy import energy_of_sum, version_rank
from gridmart.functions.keys import surrogate_key
from gridmart.functions.periods import month_start, slots_expected
from gridmart.operators.dedup import best_version, complete_rows
from gridmart.operators.parse import Field, parse_records

# Published key -> column of the table
SLOT_FIELDS = [
    Field("code_insee_region", "code_insee_region"),
    Field("libelle_region", "libelle_region"),
    Field("nature", "nature_donnees"),
    Field("date", "date_locale", as_date),
    Field("heure", "heure_locale"),
    Field("date_heure", "horodatage_utc", as_instant),
    Field("consommation", "consommation_mw", as_int),
    Field("thermique", "production_thermique_mw", as_int),
    Field("nucleaire", "production_nucleaire_mw", as_int),
    Field("eolien", "production_eolien_mw", as_int),
    *[Field(part, f"production_{part}_mw", as_int) for part in feeds.WIND_SPLIT],
    Field("solaire", "production_solaire_mw", as_int),
    Field("hydraulique", "production_hydraulique_mw", as_int),
    Field("bioenergies", "production_bioenergies_mw", as_int),
    Field("pompage", "pompage_mw", as_int),
    Field("stockage_batterie", "stockage_batterie_mw", as_int),
    Field("destockage_batterie", "destockage_batterie_mw", as_int),
    Field("ech_physiques", "echanges_physiques_mw", as_int),
    *[Field(f"tco_{source}", f"taux_couverture_{source}_pct", as_double) for source in feeds.SOURCES],
    *[Field(f"tch_{source}", f"taux_charge_{source}_pct", as_double) for source in feeds.SOURCES],
]
ANNUAL_FIELDS = [
    Field("annee", "annee", as_int),
    Field("code_commune", "code_commune", padded_code),
    Field("nom_commune", "nom_commune"),
    Field("code_region", "code_region"),
    Field("code_grand_secteur", "code_grand_secteur", clean_code),
    Field("code_secteur_naf2", "code_secteur_naf2"),
    Field("code_categorie_consommation", "code_categorie_consommation", clean_code),
    Field("nb_sites", "nb_sites", as_int),
    Field("conso_totale_mwh", "conso_totale_mwh", as_double),
]
INDEX_FIELDS = [
    Field("idbank", "idbank"),
    Field("libelle_serie", "libelle_serie"),
    Field("time_period", "periode"),
    Field("time_period", "mois", month_of_period),
    Field("obs_value", "valeur", as_double),
    Field("obs_status", "statut_observation"),
]
SURVEY_FIELDS = [
    Field("series_key", "cle_serie"),
    Field("title_fr", "libelle_serie"),
    Field("time_period", "periode"),
    Field("time_period", "mois", month_of_period),
    Field("obs_value", "valeur", as_double),
]

SLOT_KEY = ("code_insee_region", "horodatage_utc")
ANNUAL_KEY = (
    "annee",
    "code_commune",
    "code_grand_secteur",
    "code_secteur_naf2",
    "code_categorie_consommation",
)
INDEX_KEY = ("idbank", "mois")
SURVEY_KEY = ("cle_serie", "mois")

VERSION = "version_hash"
_CARRY = ("source_dataset", "ingested_at")


#: What is done with the versions of a table before one of each key is chosen.
Watch = Callable[[DataFrame], DataFrame]


def typed(bronze: DataFrame, fields: Sequence[Field], required: Sequence[str], watch: Watch | None = None) -> DataFrame:
    """Typed versions with the columns they compete on; rows without a required value are out.

    The hash of the record settles ties between versions of one load, so every run picks the same one.
    """
    versions = parse_records(bronze, fields, (*_CARRY, F.xxhash64("payload").alias(VERSION)))
    complete = complete_rows(versions, required)
    return watch(complete) if watch else complete


def newest(versions: DataFrame, key: Sequence[str]) -> DataFrame:
    return best_version(versions, key, [F.desc("ingested_at"), F.desc(VERSION)])


def with_key(rows: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    return rows.drop(VERSION).select(surrogate_key(*key).alias(name), "*")


def slot_versions(bronze: DataFrame, watch: Watch | None = None) -> DataFrame:
    """Versions of power slots. Slots published ahead without consumption must not compete."""
    return typed(bronze, SLOT_FIELDS, (*SLOT_KEY, "consommation_mw"), watch)


def best_slots(versions: DataFrame) -> DataFrame:
    """Best consolidated, then newest version of each slot.

    The instant leads the sort: it tells most versions apart at once, the region next to none.
    """
    rank = version_rank(F.col("nature_donnees"), (feeds.NATURE_FINAL, feeds.NATURE_CONSOLIDATED))
    return best_version(versions, SLOT_KEY[::-1], [rank, F.desc("ingested_at"), F.desc(VERSION)])


def power_slots(bronze: DataFrame, watch: Watch | None = None) -> DataFrame:
    """One row per region and slot."""
    return with_key(best_slots(slot_versions(bronze, watch)), "rte_ecomix_id", SLOT_KEY)


def power_months(slots: DataFrame, dataset: str = feeds.DATASET_CONSOLIDATED) -> DataFrame:
    """Energy per region and local month, from the 30-minute dataset alone.

    The dataset is chosen after versions competed: a consolidated slot replaced by another dataset is out.
    """
    sums = [energy_of_sum(F.col("consommation_mw")).alias("consommation_mwh")] + [
        energy_of_sum(F.col(f"production_{source}_mw")).alias(f"production_{source}_mwh") for source in feeds.SOURCES
    ]
    months = (
        slots.where((F.col("source_dataset") == dataset) & F.col("date_locale").isNotNull())
        .groupBy(
            F.year("date_locale").alias("annee"),
            F.month("date_locale").alias("mois"),
            "code_insee_region",
        )
        .agg(F.max("libelle_region").alias("libelle_region"), F.count("*").alias("nb_creneaux"), *sums)
    )
    first_day = month_start(F.col("annee"), F.col("mois"))
    return months.select(
        surrogate_key("annee", "mois", "code_insee_region").alias("rte_mensuel_id"),
        "annee",
        "mois",
        first_day.alias("mois_debut"),
        "code_insee_region",
        "libelle_region",
        "nb_creneaux",
        (F.col("nb_creneaux") == slots_expected(first_day)).alias("est_mois_complet"),
        "consommation_mwh",
        *[f"production_{source}_mwh" for source in feeds.SOURCES],
    )


def annual_consumption(bronze: DataFrame, watch: Watch | None = None, key: Sequence[str] = ANNUAL_KEY) -> DataFrame:
    """One row per year, commune, sector, NAF2 division (may be NULL) and category."""
    required = ("annee", "code_commune", "code_grand_secteur")
    return with_key(newest(typed(bronze, ANNUAL_FIELDS, required, watch), key), "enedis_conso_id", key)


def production_index(bronze: DataFrame, watch: Watch | None = None, key: Sequence[str] = INDEX_KEY) -> DataFrame:
    """One row per series and month, newest published value."""
    return with_key(newest(typed(bronze, INDEX_FIELDS, INDEX_KEY, watch), key), "insee_ipi_id", key)


def business_survey(bronze: DataFrame, watch: Watch | None = None, key: Sequence[str] = SURVEY_KEY) -> DataFrame:
    """One row per series and month, newest published value."""
    return with_key(newest(typed(bronze, SURVEY_FIELDS, SURVEY_KEY, watch), key), "bdf_pmi_id", key)
