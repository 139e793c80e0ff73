"""The ledger of landed files: what it notes, and which files a request opens."""

import json
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from test_sources import TWO_SETS, sdmx

from gridmart import feeds
from gridmart.plans import loads
from gridmart.session import scratch_path
from gridmart.sources.landing import INDEX, POWER, POWER_LINES, SURVEY, Landing
from gridmart.sources.tables import Layers


def slot(instant, region="52"):
    return {"code_insee_region": region, "date": instant[:10], "date_heure": instant}


@pytest.fixture
def folder(spark):
    path = Path(scratch_path(spark, "landing"))
    path.mkdir(parents=True)
    return path


def names(files):
    return [Path(f.removeprefix("file:")).name for f in files]


def test_a_day_opens_the_files_that_hold_it(spark, folder):
    """Also with names that need escapes or look like patterns, and with a file that landed later."""
    days = {f"day {d}+[{d}].json": [slot(f"2026-10-{d:02d}T{h:02d}:00:00+00:00") for h in (1, 9)] for d in range(1, 9)}
    for name, rows in days.items():
        (folder / name).write_text(json.dumps(rows))
    landing = Landing(spark, str(folder), POWER)
    assert landing.register() == 8 and landing.register() == 0
    (folder / "late.json").write_text(json.dumps([slot("2026-10-03T23:45:00+00:00"), slot("2026-10-05T00:00:00+00:00", "53")]))
    (folder / "empty.json").write_text("[]")
    assert landing.register() == 2 and landing.register() == 0
    asked = landing.of_day("52", date(2026, 10, 3))
    assert sorted(names(landing.files("key = '52' AND first_day = '2026-10-03'"))) == ["day 3+[3].json", "late.json"]
    assert len(asked.inputFiles()) == 2
    layers = Layers(spark, scratch_path(spark, "layers"), base="landing", isolated=True)
    layers.create_log(feeds.RAW_POWER)
    assert loads.load_power_day(layers, asked, date(2026, 10, 3)) == 3
    assert landing.of_day("53", date(2026, 10, 3)).count() == 0
    assert landing.of_day("99", date(2026, 10, 3)).count() == 0


def test_windows_are_half_open(spark, folder):
    for h in range(6):
        (folder / f"{h}.jsonl").write_text(json.dumps(slot(f"2026-10-05T{h:02d}:00:00+00:00")) + "\n\n")
    (folder / "broken.jsonl").write_text('{"code_insee_region": "52", "date_heure": "demain"}\n{broken\n')
    landing = Landing(spark, str(folder), POWER_LINES)
    assert landing.register() == 7
    first, after = (datetime(2026, 10, 5, h, tzinfo=timezone.utc) for h in (2, 4))
    assert sorted(names(landing.of_window("52", first, after).inputFiles())) == ["2.jsonl", "3.jsonl"]
    noted = {Path(r.file).name: r for r in landing.ledger().where("key = '52'").collect()}
    assert noted["broken.jsonl"].first is None and noted["broken.jsonl"].records == 1
    assert landing.ledger().where("key IS NULL").count() == 1


def test_series_by_month(spark, folder):
    for month in ("2024-01", "2024-02", "2024-03"):
        (folder / month).write_text(json.dumps({"series_key": "A", "time_period": month}) + "\n" + json.dumps({"series_key": "B", "time_period": "2024-Q1"}))
    landing = Landing(spark, str(folder), SURVEY)
    landing.register()
    assert names(landing.files("key = 'A' AND records = 1")) == ["2024-01", "2024-02", "2024-03"]
    assert sorted(names(landing.of_series(["A"], "2024-02").inputFiles())) == ["2024-02", "2024-03"]
    assert sorted(names(landing.of_series(["A"], None, "2024-01").inputFiles())) == ["2024-01"]
    assert landing.of_series(["B"], "2024-01").count() == 0 and landing.of_series(["B"]).count() == 6


def test_sdmx_documents(spark, folder):
    (folder / "a.xml").write_text(sdmx(TWO_SETS))
    landing = Landing(spark, str(folder), INDEX)
    assert landing.register() == 1
    assert {"S7", "S9"} <= {r.key for r in landing.ledger().collect()}
    assert landing.of_series(["S7"]).columns == ["idbank", "libelle_serie", "time_period", "obs_value", "obs_status"]
    assert landing.of_series(["S0"]).count() == 0
