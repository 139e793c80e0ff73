"""Names and codes of the four feeds and of the tables built from them.

Fixed values: they must equal what the sources publish and what existing consumers of the
tables query, so they are stated as they are.
"""

# Bronze, Silver and Gold table names
RAW_POWER = "raw_rte_ecomix"
RAW_ANNUAL = "raw_enedis_conso"
RAW_INDEX = "raw_insee_ipi"
RAW_SURVEY = "raw_bdf_pmi"

SLOTS = "stg_rte_ecomix"
MONTHS = "stg_rte_mensuel"
ANNUAL = "stg_enedis_conso"
INDEX = "stg_insee_ipi"
SURVEY = "stg_bdf_pmi"

INDUSTRIAL = "mart_conso_industrielle"
MIX = "mart_production_regionale"
INDICATORS = "mart_correlation_conjoncture"
BALANCE = "mart_tension_reseau"

BRONZE_TABLES = (RAW_POWER, RAW_ANNUAL, RAW_INDEX, RAW_SURVEY)

# Identifiers of the published datasets
DATASET_REALTIME = "eco2mix-regional-tr"
DATASET_CONSOLIDATED = "eco2mix-regional-cons-def"
DATASET_ANNUAL = "j75xc8cglfk5cp800y9uwqx9"
DATASET_INDEX = "SERIES_BDM"
DATASET_SURVEY = "CONJ2"

# Region covered
REGION_CODE = "52"

# Levels of consolidation of a power slot, best first
NATURE_FINAL = "Données définitives"
NATURE_CONSOLIDATED = "Données consolidées"
NATURE_REALTIME = "Données temps réel"

# Series loaded, and the one of each source the indicator mart uses
INDEX_SERIES = ("010768265", "010768135", "010768273")
SURVEY_SERIES = (
    "CONJ2.M.R52.S.IN.000CZ.ICAIN000.10",
    "CONJ2.M.R52.S.IN.000CZ.PRTEM100.10",
    "CONJ2.M.R52.S.IN.000CZ.CRTEM100.10",
    "CONJ2.M.R52.T.IN.000CZ.TUTSM000.10",
)
MART_INDEX_SERIES = "010768265"
MART_SURVEY_SERIES = "CONJ2.M.R52.S.IN.000CZ.ICAIN000.10"
SURVEY_FIELDS = ("series_key", "title_fr", "time_period", "obs_value", "obs_status")

# Production sources of a slot; wind is also published split by location in one of the two datasets
SOURCES = ("thermique", "nucleaire", "eolien", "solaire", "hydraulique", "bioenergies")
RENEWABLES = ("eolien", "solaire", "hydraulique", "bioenergies")
WIND_SPLIT = ("eolien_terrestre", "eolien_offshore")

# Slot length in minutes by dataset, slots in a day, slots missing from a month by calendar month
# (the spring clock change removes one hour in March; the hour repeated in October is not published)
REALTIME_MINUTES = 15
CONSOLIDATED_MINUTES = 30
SLOTS_PER_DAY = 48
MISSING_SLOTS = {3: 2}

# Sector of the industrial mart, consumption categories
INDUSTRY = "INDUSTRIE"
CATEGORIES = ("ENT", "PRO", "RES")
INDUSTRIAL_CATEGORIES = ("ENT", "PRO")
