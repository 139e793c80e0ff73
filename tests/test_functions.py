import hashlib
import math
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmart.functions import casts, energy, periods, slices
from gridmart.functions.keys import NULL_MEMBER, surrogate_key
from gridmart.session import shared_folder, shuffle_partitions


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("3000", 3000), (" 12 ", 12), ("-5", -5), ("+7", 7), ("ND", None), ("", None), ("12.0", None),
        ("1e3", None), ("99999999999", None), (None, None), ("-", None), ("1 2", None),
    ],
)
def test_as_int(spark, text, expected):
    column = F.lit(text).cast("string")
    assert one(spark, casts.as_int(column)) == expected
    assert one(spark, casts.as_int(column)) == one(spark, column.try_cast("int"))


@pytest.mark.parametrize("text", ["98.5", "1e3", " 2.5 ", "ND", "", None, "NaN", "Infinity", "-inf", ".", "12,5"])
def test_as_double_is_the_tolerant_cast(spark, text):
    column = F.lit(text).cast("string")
    ours, plain = one(spark, casts.as_double(column)), one(spark, column.try_cast("double"))
    assert ours == plain or (math.isnan(ours) and math.isnan(plain))


@pytest.mark.parametrize(
    ("period", "expected"),
    [("2024-02", date(2024, 2, 1)), ("2024-Q1", None), ("2024-13", None), ("2024", date(2024, 1, 1)), (None, None)],
)
def test_month_of_period(spark, period, expected):
    assert one(spark, casts.month_of_period(F.lit(period).cast("string"))) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("2026-10-05T12:30:00+02:00", "10:30"), ("2026-10-05T10:30:00", "10:30"), ("pas une date", None), (None, None)],
)
def test_as_instant(spark, text, expected):
    assert one(spark, F.date_format(casts.as_instant(F.lit(text).cast("string")), "HH:mm")) == expected


@pytest.mark.parametrize(("code", "expected"), [("1001", "01001"), ("44109", "44109"), ("123456", "12345"), (None, None)])
def test_padded_code(spark, code, expected):
    assert one(spark, casts.padded_code(F.lit(code).cast("string"))) == expected


def test_clean_code(spark):
    assert one(spark, casts.clean_code(F.lit("  Industrie "))) == "INDUSTRIE"


def test_surrogate_key_tells_null_from_empty(spark):
    key = one(spark, surrogate_key(F.lit(2024), F.lit(None).cast("string"), F.lit("ENT")))
    assert key == hashlib.md5(f"2024-{NULL_MEMBER}-ENT".encode()).hexdigest()
    assert key != one(spark, surrogate_key(F.lit(2024), F.lit(""), F.lit("ENT")))


def test_energy_of_slot_is_an_exact_decimal(spark):
    assert one(spark, energy.energy_of_slot(F.lit(3001), F.lit(15))) == Decimal("750.25")
    assert spark.range(1).select(energy.energy_of_slot(F.lit(1), F.lit(15)).alias("x")).schema["x"].dataType.simpleString() == (
        "decimal(17,6)"
    )


def test_energy_of_the_largest_power(spark):
    assert one(spark, energy.energy_of_slot(F.lit(2**31 - 1), F.lit(30))) == Decimal(2**31 - 1) / 2


def test_energy_of_sum_keeps_null_groups(spark):
    rows = spark.createDataFrame([("a", 3), ("a", None), ("b", None)], "k string, mw int")
    sums = {r.k: r.e for r in rows.groupBy("k").agg(energy.energy_of_sum(F.col("mw")).alias("e")).collect()}
    assert sums == {"a": Decimal("1.5"), "b": None}


def test_percentages(spark):
    assert one(spark, energy.percent_of(F.lit(1), F.lit(4))) == 25.0
    assert one(spark, energy.percent_of(F.lit(1), F.lit(0))) is None
    assert one(spark, energy.percent_change(F.lit(110.0), F.lit(100.0))) == 10.0
    assert one(spark, energy.percent_change(F.lit(110.0), F.lit(0.0))) is None


def test_rank_and_slot_length(spark):
    ranks = spark.createDataFrame([("f",), ("c",), ("r",), (None,)], "n string")
    rows = ranks.select(energy.version_rank(F.col("n"), ("f", "c")).alias("r"), energy.slot_minutes(F.col("n")).alias("m"))
    assert [tuple(r) for r in rows.collect()] == [(1, 30), (2, 30), (3, 30), (3, 30)]
    assert one(spark, energy.slot_minutes(F.lit("eco2mix-regional-tr"))) == 15


def test_slots_expected(spark):
    expected = {date(2024, 2, 1): 1392, date(2024, 3, 1): 1486, date(2024, 10, 1): 1488, date(2023, 2, 1): 1344}
    for day, slots in expected.items():
        assert one(spark, periods.slots_expected(F.lit(day))) == slots


MONTHS = st.dates(date(1990, 1, 1), date(2040, 12, 31)).map(lambda d: f"{d:%Y-%m}")


@given(start=st.none() | MONTHS, end=st.none() | MONTHS)
def test_load_label_gives_both_bounds_back(start, end):
    label = periods.load_label(start, end)
    assert (label == "full") == (start is None and end is None)
    if label != "full":
        assert tuple(part or None for part in label.split("/")) == (start, end)


def month_after(month, n):
    index = int(month[:4]) * 12 + int(month[5:]) - 1 + n
    return f"{index // 12:04d}-{index % 12 + 1:02d}"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(start=MONTHS, n=st.integers(-3, 40))
def test_month_windows_tile_their_range(spark, start, n):
    """One window per month, each ends where the next begins; none where the range runs backwards."""
    rows = periods.month_windows(spark, start, month_after(start, n)).orderBy("label").collect()
    assert [r.label for r in rows] == [month_after(start, i) for i in range(n + 1)]
    assert all(f"{r.window_start:%Y-%m-%d}" == f"{r.label}-01" for r in rows)
    assert all(a.window_end == b.window_start for a, b in zip(rows, rows[1:]))


@given(day=st.dates(date(2000, 1, 1), date(2100, 1, 1)), months=st.integers(0, 30))
def test_trailing_months_end_with_the_day(day, months):
    first, last = periods.trailing_months(day, months)
    assert last == f"{day:%Y-%m}" and month_after(first, months) == last


@given(day=st.dates(date(2000, 1, 1), date(2100, 1, 1)), published=st.integers(1990, 2110))
def test_annual_year_is_over_and_published(day, published):
    year = periods.annual_year_to_load(day, published)
    assert year <= published and year < day.year and year in (published, day.year - 1)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    now=st.datetimes(datetime(2001, 1, 1), datetime(2030, 1, 1)).map(lambda t: t.replace(tzinfo=timezone.utc)),
    minutes=st.integers(1, 600),
    offset=st.sampled_from([0, 60, -210]),
)
def test_recent_window_is_exactly_the_slots_that_began_in_it(spark, now, minutes, offset):
    """Slots around the window, at any alignment, over midnight and month ends, published with any offset."""
    zone = timezone(timedelta(minutes=offset))
    first = now.replace(minute=0, second=0, microsecond=0) - timedelta(hours=11)
    times = [first + timedelta(minutes=15 * i) for i in range(60)] + [now, now - timedelta(minutes=minutes)]
    texts = [t.astimezone(zone).isoformat() for t in times] + [None, "", "hier"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    kept = {r.i for r in rows.where(slices.in_last_minutes(F.col("t"), now, minutes)).collect()}
    assert kept == {i for i, t in enumerate(times) if now - timedelta(minutes=minutes) <= t < now}


@pytest.mark.parametrize(
    ("start", "end", "expected"),
    [(None, None, 4), ("2024-02", None, 3), (None, "2024-02", 2), ("2024-02", "2024-03", 2)],
)
def test_series_bounds_are_inclusive(spark, start, end, expected):
    rows = spark.createDataFrame([("s", date(2024, m, 1)) for m in range(1, 5)] + [("t", date(2024, 2, 1))], "k string, m date")
    assert rows.where(slices.in_series(F.col("k"), F.col("m"), ["s"], start, end)).count() == expected


def test_day_and_year_slices(spark):
    rows = spark.createDataFrame([("52", "2026-10-05", "2023"), ("53", "2026-10-05", "2023"), ("52", "2026-10-06", "2024")], "r string, d string, y string")
    assert rows.where(slices.on_local_day(F.col("r"), F.col("d"), "52", date(2026, 10, 5))).count() == 1
    assert rows.where(slices.in_region_year(F.col("r"), F.col("y"), "52", 2024)).count() == 1


def test_shuffle_partitions_follow_the_size():
    assert [shuffle_partitions(n) for n in (1, 10**12, 10**15)] == [200, 3726, 3_725_291]


def fake_session(**conf):
    settings = {key.replace("__", "."): value for key, value in conf.items()}
    return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(applicationId="app-1"))


def test_shared_folder_is_the_one_the_cluster_names():
    assert shared_folder(fake_session(spark__checkpoint__dir="s3a://b/shared/")) == "s3a://b/shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(fake_session(spark__master="yarn"))
    local = fake_session(spark__master="local[2]")
    assert shared_folder(local) == shared_folder(local)
