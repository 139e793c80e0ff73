"""Loads keep what the request asked for and label it."""

import json
from datetime import date, datetime, timedelta, timezone

import pytest
from test_models import opinion, place, slot
from test_sources import TWO_SETS, sdmx

from gridmart import feeds
from gridmart.operators.parse import json_texts, may_hold
from gridmart.plans import loads
from gridmart.session import scratch_path
from gridmart.sources.tables import Layers


@pytest.fixture
def layers(spark):
    layers = Layers(spark, scratch_path(spark, "layers"), base="loads", isolated=True)
    for table in feeds.BRONZE_TABLES:
        layers.create_log(table)
    return layers


def records(spark, rows):
    return spark.createDataFrame([(json.dumps(row, ensure_ascii=False),) for row in rows], "payload string")


def logged(layers, table):
    return sorted((r.source_dataset, r.extracted_for, r.payload) for r in layers.read_log(table).collect())


def test_power_day(spark, layers):
    day = [slot(f"2026-10-05T{h:02d}:00:00+00:00", 1) for h in range(24)]
    rows = records(spark, [*day, slot("2026-10-05T10:00:00+00:00", 1, code_insee_region="53")])
    # the local day starts an hour before the UTC one
    assert loads.load_power_day(layers, rows, date(2026, 10, 5)) == 23
    assert {r[:2] for r in logged(layers, feeds.RAW_POWER)} == {(feeds.DATASET_REALTIME, "2026-10-05")}


@pytest.mark.parametrize("minutes", [45, 200])
def test_power_recent(spark, layers, minutes):
    now = datetime(2021, 3, 1, 0, 5, tzinfo=timezone.utc)
    times = [now + timedelta(minutes=m) for m in range(-400, 60, 9)]
    rows = [slot(t.isoformat(), 1) for t in times] + [slot(t.isoformat(), 1, code_insee_region="11") for t in times]
    unusable = [{"code_insee_region": "52"}, {"code_insee_region": "52", "date_heure": "demain"}]
    inside = sum(now - timedelta(minutes=minutes) <= t < now for t in times)
    assert loads.load_power_recent(layers, records(spark, rows + unusable), now, date(2021, 2, 28), minutes) == inside
    assert {r[1] for r in logged(layers, feeds.RAW_POWER)} == {"2021-02-28"}


def test_power_months(spark, layers):
    """Every slot is labelled with its UTC month, and only whole months between the two bounds are kept."""
    times = [datetime(2022, 10, 30, tzinfo=timezone.utc) + timedelta(hours=7 * i) for i in range(500)]
    rows = records(spark, [slot(t.isoformat(), 1) for t in times])
    wanted = sorted(f"{t:%Y-%m}" for t in times if "2022-11" <= f"{t:%Y-%m}" <= "2023-01")
    assert loads.load_power_months(layers, rows, "2022-11", "2023-01") == len(wanted)
    assert sorted(r[1] for r in logged(layers, feeds.RAW_POWER)) == wanted
    assert loads.load_power_months(layers, rows, "2023-01", "2022-11") == 0


def test_annual(spark, layers):
    rows = records(spark, [place(), place(annee=2024), place(annee="2022"), place(code_region="53")])
    assert loads.load_annual(layers, rows, [2023, 2024]) == 2
    assert {r[1] for r in logged(layers, feeds.RAW_ANNUAL)} == {"2023", "2024"}


@pytest.mark.parametrize(
    ("series", "bounds", "rows", "label"),
    [(["S7", "S9"], (), 4, "full"), (["S7"], ("2019-12", None), 1, "2019-12/"), (["S7", "S9"], (None, "2020-01"), 3, "/2020-01")],
)
def test_index(spark, layers, series, bounds, rows, label):
    documents = spark.createDataFrame([(sdmx(TWO_SETS),)], "document string")
    assert loads.load_index(layers, documents, series, *bounds) == rows
    log = logged(layers, feeds.RAW_INDEX)
    assert {r[:2] for r in log} == {(feeds.DATASET_INDEX, label)}
    assert set(json.loads(log[0][2])) == {"idbank", "libelle_serie", "time_period", "obs_value", "obs_status"}


def test_survey(spark, layers):
    rows = [{**opinion(p, 61.25), "more": 1} for p in ("2024-01", "2024-02", "2024-03")] + [opinion("2024-02", 1, "other")]
    assert loads.load_survey(layers, records(spark, rows), start="2024-02", end="2024-03") == 2
    log = logged(layers, feeds.RAW_SURVEY)
    assert {r[1] for r in log} == {"2024-02/2024-03"}
    assert set(json.loads(log[0][2])) == set(feeds.SURVEY_FIELDS)


def test_a_day_written_with_escapes_is_found(spark):
    rows = [('{"date": "2026-10-05"}',), ('{"date": "2026\\u002d10-05"}',), ('{"date": "2026-10-06"}',), (None,)]
    kept = spark.createDataFrame(rows, "payload string").where(may_hold("2026-10-05"))
    assert [r.json_date for r in json_texts(kept, ["date"]).collect()] == ["2026-10-05", "2026-10-05"]
