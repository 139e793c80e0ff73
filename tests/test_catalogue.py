"""Every registered query equals its SQL on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as contract
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from gridmart.catalogue import common, derived, load_catalogue
from gridmart.sources import bronze

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(load_catalogue().queries))
def test_query_equals_its_sql(spark, tables, name):
    assert compare(contract.queries()[name](spark, SF_DIR), tables, contract.oracle_sql()[name]) is None


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.schema == second.schema and first.count() > 0


def test_no_python_in_any_plan(spark, plan):
    """Everything but sinks and file listing runs on JVM expressions."""
    for name in ("silver_power_slots", "silver_annual_consumption", "gold_regional_mix", "q22_calendar_change", "q32_sdmx_flatten"):
        text = plan(contract.queries()[name](spark, SF_DIR))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text and "CartesianProduct" not in text


def test_range_scan_is_pushed_down(spark, plan):
    text = plan(contract.queries()["q03_range_scan"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in text


def test_month_deviation_does_not_shuffle_rows(spark, plan):
    text = plan(contract.queries()["q24_month_deviation"](spark, SF_DIR))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_the_entry_works_without_the_optional_subpackage(tmp_path):
    """A copy of the package without it imports, and registers every other query."""
    root = Path(contract.__file__).parent
    for path in (root / "gridmart").rglob("*.py"):
        part = path.relative_to(root)
        if "llm" not in part.parts:
            (tmp_path / part).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / part).write_text(path.read_text())
    (tmp_path / "__spark_entry__.py").write_text((root / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(load_catalogue().queries)), str(len(load_catalogue().oracles))]


def test_months_of_both_kinds_occur(spark):
    """A constant would not pass for the flag of complete months."""
    for name, flag in (("q17_complete_month", "is_complete"), ("silver_power_months", "est_mois_complet")):
        assert contract.queries()[name](spark, SF_DIR).select(flag).distinct().count() == 2


def test_day_scan_is_pushed_down(spark, plan):
    text = plan(contract.queries()["q02_day_scan"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text and "EqualTo(event_type,click)" in text


def test_records_come_in_as_many_parts_as_asked_for(spark):
    log = derived.power_log(spark, SF_DIR, parts=3)
    assert log.rdd.getNumPartitions() == 6  # three of lines, three of orders: no shuffle of the records
    assert sorted(log.collect()) == sorted(derived.power_log(spark, SF_DIR).collect())


def test_parts_are_bounded_in_rows_however_well_they_compress(spark, tmp_path, monkeypatch):
    """Rows that compress to next to nothing, with one key or none: the parts are equal, and no row is lost."""
    key = F.when(F.col("id") % 3 > 0, F.lit(7)).alias("key")
    spark.range(40_000, numPartitions=1).select(key, F.col("id").alias("number")).write.parquet(f"{tmp_path}/t.parquet")
    rows = common.table(spark, tmp_path, "t")
    monkeypatch.setattr(common, "MOST_ROWS", 2_000)
    dealt = common.spread(rows)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 2 * 2_000
    assert dealt.exceptAll(rows).isEmpty() and rows.exceptAll(dealt).isEmpty()


def test_parts_follow_rows_and_cores():
    """Nothing and little are one part, work is given to every core, and then parts grow no further."""
    assert [common.parts_of(rows, 12) for rows in (0, 1, 20_001, 600_000, 3_600_000)] == [1, 1, 2, 12, 12]
    assert common.parts_of(36_000_000, 12) == 35 and common.parts_of(216_000_000, 12) == 206


def test_a_table_in_enough_parts_is_read_without_a_shuffle(spark, tmp_path, plan):
    rows = spark.range(400_000).select(F.col("id").alias("number"), F.when(F.col("id") % 3 > 0, 7).alias("key"))
    rows.repartition(16).write.parquet(f"{tmp_path}/many.parquet")
    rows.coalesce(1).write.parquet(f"{tmp_path}/one.parquet")
    many, one = (common.as_read(common.table(spark, tmp_path, name)) for name in ("many", "one"))
    assert "Exchange" not in plan(many) and "Exchange" in plan(one)
    for read in (many, one):
        assert read.count() == 400_000 and read.agg(F.sum("number"), F.sum("key")).first() == rows.agg(F.sum("number"), F.sum("key")).first()


def test_rows_of_a_load_become_the_records_of_its_log(spark):
    for log, load in (
        (derived.power_log(spark, SF_DIR, one_region=True), derived.power_load(spark, SF_DIR, one_region=True)),
        (derived.annual_log(spark, SF_DIR), derived.annual_load(spark, SF_DIR)),
        (derived.survey_log(spark, SF_DIR, complete=True), derived.survey_load(spark, SF_DIR, complete=True)),
    ):
        records = bronze.records(*load)
        assert records.exceptAll(log).isEmpty() and log.exceptAll(records).isEmpty()
        assert "payload" not in load[0].columns
