"""Golden rows of the nine tables."""

import re
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from conftest import load_time
from pyspark.sql import functions as F

from gridmart import feeds
from gridmart.plans import gold, reports, silver
from gridmart.sources.tables import stager

TR, CD = feeds.DATASET_REALTIME, feeds.DATASET_CONSOLIDATED
FINAL, CONSOLIDATED, REALTIME = feeds.NATURE_FINAL, feeds.NATURE_CONSOLIDATED, feeds.NATURE_REALTIME


def slot(when, mw, nature=FINAL, **more):
    instant = datetime.fromisoformat(when)
    local = instant.astimezone(timezone(timedelta(hours=1)))
    record = {
        "code_insee_region": "52", "libelle_region": "Pays de la Loire", "nature": nature,
        "date": f"{local:%Y-%m-%d}", "heure": f"{local:%H:%M}", "date_heure": when, "consommation": mw,
    }
    return {**record, **more}


def test_slot_columns_and_types(log):
    row = slot("2024-01-01T10:00:00+00:00", "3000", thermique=10, eolien="ND", tco_eolien="12.5", tch_solaire="x")
    df = silver.power_slots(log((CD, row, load_time(1))))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert len(types) == 34
    assert df.columns[0] == "rte_ecomix_id" and df.columns[-2:] == ["source_dataset", "ingested_at"]
    assert types["horodatage_utc"] == "timestamp" and types["date_locale"] == "date"
    assert types["production_eolien_offshore_mw"] == "int" and types["taux_charge_solaire_pct"] == "double"
    got = df.first()
    assert (got.consommation_mw, got.production_thermique_mw, got.production_eolien_mw) == (3000, 10, None)
    assert (got.taux_couverture_eolien_pct, got.taux_charge_solaire_pct) == (12.5, None)
    assert got.libelle_region == "Pays de la Loire"


def test_best_level_wins_whatever_the_load_order(log):
    when = "2024-01-01T10:00:00+00:00"
    df = log(
        (CD, slot(when, 1, FINAL), load_time(1)),
        (CD, slot(when, 2, CONSOLIDATED), load_time(2)),
        (TR, slot(when, 3, REALTIME), load_time(3)),
    )
    assert [r.consommation_mw for r in silver.power_slots(df).collect()] == [1]


def test_newest_load_wins_within_a_level(log):
    when = "2024-01-01T10:00:00+00:00"
    df = log((TR, slot(when, 1, None), load_time(1)), (TR, slot(when, 2, REALTIME), load_time(2)))
    assert [r.consommation_mw for r in silver.power_slots(df).collect()] == [2]


@pytest.mark.parametrize("empty", [None, "ND", ""])
def test_empty_slot_never_hides_a_filled_one(log, empty):
    when = "2024-01-01T10:00:00+00:00"
    df = log((TR, slot(when, 7, REALTIME), load_time(1)), (CD, slot(when, empty, FINAL), load_time(2)))
    assert [r.consommation_mw for r in silver.power_slots(df).collect()] == [7]


def test_versions_of_one_load_have_a_fixed_winner(log, spark):
    when = "2024-01-01T10:00:00+00:00"
    df = log(*[(TR, slot(when, mw, REALTIME), load_time(1)) for mw in range(20)])
    winners = {silver.power_slots(df.repartition(n)).first().consommation_mw for n in (1, 3, 7)}
    assert len(winners) == 1


def test_same_instant_in_two_offsets_is_one_slot(log):
    df = log((CD, slot("2024-01-01T11:00:00+01:00", 1), load_time(1)), (CD, slot("2024-01-01T10:00:00", 2), load_time(2)))
    row = silver.power_slots(df).collect()
    assert len(row) == 1 and row[0].consommation_mw == 2


def test_unusable_records_are_dropped(log):
    df = log(
        (CD, slot("2024-01-01T10:00:00", 1, code_insee_region=None), load_time(1)),
        (CD, {**slot("2024-01-01T10:00:00", 1), "date_heure": "ND"}, load_time(1)),
        (CD, "{broken", load_time(1)),
    )
    assert silver.power_slots(df).count() == 0


def month_of_slots(year, month, hours_missing=0, **more):
    """All half hours of a local month (UTC+1), less the first ``hours_missing`` hours."""
    first = datetime(year, month, 1, tzinfo=timezone(timedelta(hours=1))) + timedelta(hours=hours_missing)
    after = datetime(year + month // 12, month % 12 + 1, 1, tzinfo=timezone(timedelta(hours=1)))
    count = int((after - first) / timedelta(minutes=30))
    return [
        slot((first + timedelta(minutes=30 * i)).astimezone(timezone.utc).isoformat(), 2000, **more) for i in range(count)
    ]


@pytest.mark.parametrize(
    ("year", "month", "missing", "slots", "complete"),
    [(2024, 2, 0, 1392, True), (2024, 3, 1, 1486, True), (2024, 3, 0, 1488, False), (2024, 10, 0, 1488, True),
     (2018, 1, 1, 1486, False)],
)
def test_complete_months(log, year, month, missing, slots, complete):
    df = silver.power_months(silver.power_slots(log(*[(CD, s, load_time(1)) for s in month_of_slots(year, month, missing)])))
    row = df.first()
    assert (row.nb_creneaux, row.est_mois_complet, row.mois_debut) == (slots, complete, date(year, month, 1))
    assert row.consommation_mwh == Decimal(slots * 1000)


def test_months_use_the_consolidated_dataset_and_keep_empty_sources_empty(log):
    rows = [
        (CD, slot("2024-01-01T10:00:00", 100, eolien=10), load_time(1)),
        (CD, slot("2024-01-01T10:30:00", 101, eolien=None), load_time(1)),
        (TR, slot("2024-01-01T10:45:00", 500, REALTIME), load_time(1)),
        (CD, slot("2024-01-01T11:00:00", 100, CONSOLIDATED), load_time(1)),
        (TR, slot("2024-01-01T11:00:00", 900, FINAL), load_time(1)),  # replaces the consolidated slot: out of the month
    ]
    df = silver.power_months(silver.power_slots(log(*rows)))
    row = df.first()
    assert (row.nb_creneaux, row.consommation_mwh) == (2, Decimal("100.5"))
    assert (row.production_eolien_mwh, row.production_nucleaire_mwh) == (Decimal("5.0"), None)
    assert df.schema["consommation_mwh"].dataType.simpleString() == "decimal(22,1)"


def test_mix_counts_missing_sources_as_zero(log):
    rows = [(CD, slot("2024-01-01T10:00:00", 1000, eolien=100, solaire=50, thermique=30), load_time(1)),
            (CD, slot("2024-02-01T10:00:00", 0, eolien=1), load_time(1))]
    df = gold.regional_mix(silver.power_months(silver.power_slots(log(*rows)))).orderBy("mois")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert (types["prod_totale_mwh"], types["prod_enr_mwh"], types["taux_couverture_enr"]) == (
        "decimal(27,1)", "decimal(25,1)", "decimal(32,2)",
    )
    january, february = df.collect()
    assert (january.prod_enr_mwh, january.prod_totale_mwh, january.prod_hydraulique_mwh) == (75, 90, 0)
    assert (january.taux_couverture_enr, january.periode) == (Decimal("15.00"), "2024-01")
    assert february.taux_couverture_enr is None


def test_balance_of_slots(log, spark):
    rows = [
        (CD, slot("2024-01-01T10:00:00", 1000, eolien=100, nucleaire=None), load_time(1)),
        (CD, slot("2024-01-01T10:30:00", 1000, eolien=300), load_time(1)),
        (TR, slot("2024-01-01T10:45:00", 400, REALTIME, solaire=80), load_time(1)),
        (CD, slot("2024-01-01T11:00:00", 0, eolien=5), load_time(1)),
        (CD, slot("2023-12-31T23:30:00", 100, eolien=20), load_time(1)),
    ]
    slots = stager(spark, "slots")(silver.power_slots(log(*rows)))
    df = gold.slot_balance(slots, stager(spark, "means")).orderBy("date_heure")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert (types["prod_mwh"], types["ecart_mwh"], types["pas_minutes"]) == ("decimal(17,6)", "decimal(18,6)", "int")
    night, first, second, quarter, idle = df.collect()
    # 23:30 UTC on 31 December is local January, yet its year is that of the UTC instant
    assert (night.annee, night.date, night.heure) == (2023, date(2024, 1, 1), "00:30")
    assert (first.prod_mwh, first.conso_mwh, first.ecart_mwh) == (Decimal(50), Decimal(500), Decimal(-450))
    assert (quarter.pas_minutes, quarter.prod_mwh) == (15, Decimal(20))
    assert (first.taux_couverture_locale, idle.taux_couverture_locale) == (10.0, None)
    # mean of 20, 10, 30, 20: slots count equally, the one without consumption not at all
    assert [r.variation_couverture_pct for r in (night, first, second, quarter, idle)] == [0.0, -50.0, 50.0, 0.0, None]


def place(**more):
    record = {
        "annee": "2023", "code_commune": "1001", "nom_commune": "Ici", "code_region": "52",
        "code_grand_secteur": " industrie", "code_secteur_naf2": "10", "code_categorie_consommation": "ent ",
        "nb_sites": "3", "conso_totale_mwh": "12.5",
    }
    return {**record, **more}


def test_annual_consumption(log):
    rows = [
        ("d", place(), load_time(1)),
        ("d", place(code_secteur_naf2="11", conso_totale_mwh=None), load_time(1)),
        ("d", place(code_secteur_naf2=None, code_categorie_consommation="PRO", nb_sites="1"), load_time(1)),
        ("d", place(code_secteur_naf2=None, code_categorie_consommation="PRO", nb_sites="2"), load_time(2)),
        ("d", place(code_grand_secteur="Tertiaire"), load_time(1)),
        ("d", place(annee="ND"), load_time(1)),
    ]
    annual = silver.annual_consumption(log(*rows))
    assert annual.count() == 4
    assert {r.code_commune for r in annual.collect()} == {"01001"}
    mart = gold.industrial_consumption(annual)
    assert mart.columns == [
        "conso_industrielle_id", "annee", "code_commune", "libelle_commune", "code_secteur_naf2",
        "categorie_consommation", "conso_mwh", "nb_points_de_soutirage",
    ]
    assert {(r.code_secteur_naf2, r.categorie_consommation, r.conso_mwh, r.nb_points_de_soutirage) for r in mart.collect()} == {
        ("10", "ENT", 12.5, 3), ("11", "ENT", None, 3), (None, "PRO", 12.5, 2),
    }


def observation(period, value, series=feeds.MART_INDEX_SERIES):
    return {"idbank": series, "libelle_serie": "T", "time_period": period, "obs_value": value, "obs_status": "A"}


def opinion(period, value, series=feeds.MART_SURVEY_SERIES):
    return {"series_key": series, "title_fr": "T", "time_period": period, "obs_value": value, "obs_status": "A"}


def test_series_keep_the_newest_value_of_real_months(log):
    rows = [
        ("s", observation("2024-01", "97.3"), load_time(2)),
        ("s", observation("2024-01", "95.0"), load_time(1)),
        ("s", observation("2024-Q1", "1"), load_time(1)),
        ("s", observation("2025", "2"), load_time(1)),
        ("s", observation("2024-02", "ND"), load_time(1)),
    ]
    index = {r.mois: r.valeur for r in silver.production_index(log(*rows)).collect()}
    assert index == {date(2024, 1, 1): 97.3, date(2025, 1, 1): 2.0, date(2024, 2, 1): None}
    survey = silver.business_survey(log(("s", opinion("2024-01", 98.5), load_time(1))))
    assert survey.columns == ["bdf_pmi_id", "cle_serie", "libelle_serie", "periode", "mois", "valeur", "source_dataset", "ingested_at"]
    assert survey.first().valeur == 98.5


def test_indicators(log):
    power = [(CD, slot(f"2024-{m:02d}-05T10:00:00", mw), load_time(1)) for m, mw in ((1, 100), (2, 120), (4, 90), (5, 99))]
    index = [("s", observation(f"2024-{m:02d}", v), load_time(1)) for m, v in ((1, 50), (2, 75), (3, 1), (4, 0), (5, 5))]
    index.append(("s", observation("2024-01", "1", "other"), load_time(1)))
    survey = [("s", opinion(f"2024-{m:02d}", 100 + m), load_time(1)) for m in (1, 2, 4, 5, 6)]
    df = gold.aligned_indicators(
        silver.power_months(silver.power_slots(log(*power))),
        silver.production_index(log(*index)),
        silver.business_survey(log(*survey)),
    )
    assert df.schema["variation_conso_pct"].dataType.simpleString() == "decimal(30,2)"
    rows = df.orderBy("mois").collect()
    assert [r.periode for r in rows] == ["2024-01", "2024-02", "2024-04", "2024-05"]
    assert [r.variation_conso_pct for r in rows] == [None, Decimal("20.00"), None, Decimal("10.00")]
    assert [r.variation_ipi_pct for r in rows] == [None, 50.0, None, None]  # after a gap, after a zero
    assert [r.variation_bdf_pct for r in rows] == [None, 0.99, None, 0.96]
    correlation = reports.indicator_correlation(df.withColumn("est_mois_complet", F.col("mois") < 4)).first()
    assert (correlation.nb_mois, round(correlation.correlation_ipi, 9)) == (2, 1.0)


def test_top_communes_orders_ties_by_code(spark):
    rows = [("00002", "B", 5.0), ("00001", "A", 2.0), ("00001", "A", 3.0), ("00003", "C", None), ("00004", "D", 9.0)]
    df = spark.createDataFrame(rows, "code_commune string, libelle_commune string, conso_mwh double")
    assert [r.code_commune for r in reports.top_communes(df, 3).collect()] == ["00004", "00001", "00002"]


def test_versions_are_sorted_by_what_tells_them_apart_first(log, plan):
    """Every version has its region in common with many, its instant with few."""
    text = plan(silver.power_slots(log(("d", {"code_insee_region": "52", "date_heure": "2026-10-05T00:00:00"}, load_time(6)))))
    sorts = re.findall(r"\(\d+\) Sort\b.*\n(?:Input.*\n)?Arguments: \[(\w+)#", text)
    assert sorts and set(sorts) == {"horodatage_utc"}
