"""Streams give what a rebuild from the whole log gives."""

import json
import os
import shutil
from datetime import date, timedelta

import pytest
from conftest import load_time
from pyspark.sql import functions as F
from test_models import CD, CONSOLIDATED, FINAL, REALTIME, TR, slot

from gridmart.plans import silver
from gridmart.session import scratch_path
from gridmart.sources import bronze, landed
from gridmart.sources.tables import Layers
from gridmart.streaming import slots as slots_module
from gridmart.streaming.loads import UNTIL_CAUGHT_UP, recent_power, start_log_stream
from gridmart.streaming.slots import _switches, compact_slots, last_batch, merge_slots, read_slots, start_slot_stream, touched_periods
from gridmart.streaming.windows import energy_by_slot


def test_landed_files_are_loaded_once_and_read_with_the_loads(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    log, checkpoint = scratch_path(spark, "log"), scratch_path(spark, "checkpoint")

    def land(name, count):
        (landing / name).write_text(json.dumps([{"i": i} for i in range(count)]))

    def run():
        documents = spark.readStream.format("text").option("wholetext", True).load(str(landing))
        records = landed.export_records(documents.select(F.col("value").alias("document")))
        start_log_stream(bronze.envelope(records, "tr", "now"), log, checkpoint, UNTIL_CAUGHT_UP).awaitTermination()

    land("a.json", 3)
    run()
    run()
    land("b.json", 2)
    run()
    assert bronze.read(spark, log).count() == 5


def test_a_log_holds_loads_and_streamed_records(spark, log):
    layers = Layers(spark, scratch_path(spark, "layers"), base="streams", isolated=True)
    layers.create_log("raw_x")
    loads, streamed = layers.log_paths("raw_x")
    rows = log((CD, {"i": 1}, load_time(1)), (TR, {"i": 2}, load_time(2)))
    rows.write.parquet(landing := scratch_path(spark, "landing"))
    stream = spark.readStream.schema(rows.schema).parquet(landing)
    start_log_stream(stream, streamed, scratch_path(spark, "checkpoint"), UNTIL_CAUGHT_UP).awaitTermination()
    bronze.append(rows, loads)
    layers.create_log("raw_x")
    assert layers.read_log("raw_x").count() == 4


VERSIONS = [
    (CD, slot("2024-01-01T10:00:00", 1, FINAL), load_time(1)),
    (TR, slot("2024-01-01T10:15:00", None, REALTIME), load_time(1)),
    (TR, slot("2024-01-01T10:00:00", 2, REALTIME), load_time(2)),  # late and less consolidated: must lose
    (TR, slot("2024-01-01T10:15:00", 5, REALTIME), load_time(2)),  # filled on the second read
    (CD, slot("2024-01-01T10:15:00", 6, CONSOLIDATED), load_time(3)),
    (TR, slot("2024-01-02T10:15:00", 7, REALTIME), load_time(3)),
]
COLUMNS = ["rte_ecomix_id", "horodatage_utc", "consommation_mw", "nature_donnees", "ingested_at"]


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


def test_micro_batches_equal_a_rebuild_and_replays_change_nothing(spark, log):
    path = scratch_path(spark, "store")
    batches = [log(*VERSIONS[i : i + 2]) for i in (0, 2, 4)]
    expected = rows(silver.power_slots(log(*VERSIONS)))
    for _ in range(2):
        for number, batch in enumerate(batches):
            merge_slots(batch, path, number)
        assert rows(read_slots(spark, path)) == expected
    assert read_slots(spark, path).columns == silver.power_slots(log(*VERSIONS)).columns


def files(spark, path):
    return {r.f for r in spark.read.parquet(f"{path}/batches").select(F.input_file_name().alias("f")).distinct().collect()}


def test_a_batch_writes_nothing_but_its_own(spark, log):
    path = scratch_path(spark, "store")
    merge_slots(log(*VERSIONS), path, 0)
    before = files(spark, path)
    merge_slots(log((TR, slot("2024-01-02T10:30:00", 8, REALTIME), load_time(4))), path, 1)
    assert before < files(spark, path)


def test_a_batch_that_stops_midway_loses_nothing(spark, log):
    """The second batch fails in a task after others have run; the first one's rows are there, and a replay completes it."""
    path = scratch_path(spark, "store")
    merge_slots(log(*VERSIONS[:2]), path, 0)
    before = rows(read_slots(spark, path))

    def broken(batches):
        for batch in batches:
            yield batch
            raise RuntimeError("executor lost")

    second = log(*VERSIONS[2:])
    with pytest.raises(Exception, match="executor lost"):
        merge_slots(second.mapInPandas(broken, second.schema), path, 1)
    assert rows(read_slots(spark, path)) == before
    merge_slots(second, path, 1)
    assert rows(read_slots(spark, path)) == rows(silver.power_slots(log(*VERSIONS)))


def test_compaction_changes_no_row_and_batches_go_on(spark, log, monkeypatch):
    path = scratch_path(spark, "store")
    for number, batch in enumerate((VERSIONS[:2], VERSIONS[2:4])):
        merge_slots(log(*batch), path, number)
    before = rows(read_slots(spark, path))
    # It stops before the switch: the new folder is there and nobody reads it.
    monkeypatch.setattr(slots_module, "_SWITCH", None)
    with pytest.raises(Exception):
        compact_slots(spark, path)
    monkeypatch.undo()
    assert rows(read_slots(spark, path)) == before
    for _ in range(2):
        compact_slots(spark, path)
        assert rows(read_slots(spark, path)) == before
    merge_slots(log(*VERSIONS[4:]), path, 2)
    assert rows(read_slots(spark, path)) == rows(silver.power_slots(log(*VERSIONS)))
    compact_slots(spark, path)
    assert rows(read_slots(spark, path)) == rows(silver.power_slots(log(*VERSIONS)))


def remove(path):
    shutil.rmtree(path.removeprefix("file:"))


def test_compaction_up_to_batch_0_is_a_compaction(spark, log):
    """Read with the batches' folder gone, as the docstring allows; a second call has nothing to do."""
    landing, store, checkpoint = (scratch_path(spark, n) for n in ("landing", "store", "checkpoint"))
    whole = log(*VERSIONS)
    whole.coalesce(1).write.parquet(landing)
    stream = spark.readStream.schema(whole.schema).parquet(landing)
    start_slot_stream(stream, store, checkpoint, UNTIL_CAUGHT_UP, compact_after=99).awaitTermination()
    assert last_batch(spark, store) == 0 and _switches(spark, store) == {}
    assert [str(p) for p in compact_slots(spark, store)] == ["2024-01-01", "2024-01-02"]
    assert {upto for upto, _ in _switches(spark, store).values()} == {0}
    assert compact_slots(spark, store) == []
    merge_slots(log((TR, slot("2024-01-02T10:30:00", 8, REALTIME), load_time(4))), store, 1)
    remove(f"{store}/batches/batch=0")
    assert rows(read_slots(spark, store)) == rows(silver.power_slots(log(*VERSIONS, (TR, slot("2024-01-02T10:30:00", 8, REALTIME), load_time(4)))))


def test_only_touched_periods_are_compacted(spark, log):
    store, batches = scratch_path(spark, "store"), [VERSIONS[:2], VERSIONS[2:4], VERSIONS[4:]]
    for number, batch in enumerate(batches):
        merge_slots(log(*batch), store, number)
    assert [str(p) for p in compact_slots(spark, store, least=3)] == ["2024-01-01"]
    assert {r[0] for r in spark.read.parquet(f"{store}/compacted").select(F.col("utc_period").cast("string")).distinct().collect()} == {"2024-01-01"}
    assert rows(read_slots(spark, store)) == rows(silver.power_slots(log(*VERSIONS)))
    # A later run of another period leaves the first one's rows where they are.
    assert [str(p) for p in compact_slots(spark, store)] == ["2024-01-02"]
    assert rows(read_slots(spark, store)) == rows(silver.power_slots(log(*VERSIONS)))
    assert [str(p) for p in touched_periods(spark, store, after=1)] == ["2024-01-01", "2024-01-02"]
    assert read_slots(spark, store, [date(2024, 1, 2)]).count() == 1


@pytest.mark.parametrize("step", ["rows", "switch"])
def test_a_stopped_compaction_can_be_repeated(spark, log, monkeypatch, step):
    store = scratch_path(spark, "store")
    for number, batch in enumerate((VERSIONS[:2], VERSIONS[2:4], VERSIONS[4:])):
        merge_slots(log(*batch), store, number)
    before = rows(read_slots(spark, store))
    broken = {"rows": ("silver", None), "switch": ("_SWITCH", "no schema!")}[step]
    switches = _switches(spark, store)
    monkeypatch.setattr(slots_module, "_switches", lambda *_: switches)
    monkeypatch.setattr(slots_module, *broken)
    with pytest.raises(Exception):
        compact_slots(spark, store)
    monkeypatch.undo()
    assert rows(read_slots(spark, store)) == before
    assert len(compact_slots(spark, store)) == 2 and rows(read_slots(spark, store)) == before


def test_a_reader_opens_a_bounded_number_of_files(spark, log):
    """Twenty batches of one day: at most one compaction and three batches are left to read; a replay changes nothing."""
    landing, store, checkpoint = (scratch_path(spark, n) for n in ("landing", "store", "checkpoint"))
    versions = [(TR, slot("2024-01-02T10:15:00", k, REALTIME), load_time(1, k)) for k in range(12)]
    for version in versions:
        log(version).coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(log(versions[0]).schema).option("maxFilesPerTrigger", 1).parquet(landing)
    start_slot_stream(stream, store, checkpoint, UNTIL_CAUGHT_UP, compact_after=4).awaitTermination()
    switches = _switches(spark, store)
    assert max(upto for upto, _ in switches.values()) >= 7
    opened = slots_module._live(spark, store).select(F.input_file_name()).distinct().count()
    assert opened <= 4
    merge_slots(log(versions[3]), store, 3)
    assert rows(read_slots(spark, store)) == rows(silver.power_slots(log(*versions)))


def test_slot_stream(spark, log):
    landing, store, checkpoint = (scratch_path(spark, n) for n in ("landing", "store", "checkpoint"))
    whole = log(*VERSIONS)
    whole.repartition(3).write.parquet(landing)
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    start_slot_stream(stream, store, checkpoint, UNTIL_CAUGHT_UP).awaitTermination()
    assert rows(read_slots(spark, store)) == rows(silver.power_slots(whole))


def test_windows_come_out_after_the_lateness(spark, tmp_path):
    times = ["10:00", "10:07", "10:15", "12:31"]
    data = spark.createDataFrame([(f"2024-01-01 {t}:00", 4) for t in times], "t string, mw int")
    data.select(F.col("t").cast("timestamp").alias("t"), "mw").write.parquet(landing := scratch_path(spark, "landing"))
    stream = spark.readStream.schema("t timestamp, mw int").parquet(landing)
    slots = energy_by_slot(stream, "t", [F.sum("mw").alias("mw")])
    out = scratch_path(spark, "out")
    run = slots.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "cp"))
    run.trigger(**UNTIL_CAUGHT_UP).start().awaitTermination()
    got = spark.read.parquet(out).select(F.date_format("slot_start", "HH:mm").alias("s"), "mw").collect()
    assert {tuple(r) for r in got} == {("10:00", 8), ("10:15", 4)}


def test_landed_exports_to_the_log_cut_to_the_last_minutes(spark, tmp_path):
    """Files of JSON arrays land one after the other; each is loaded once, and only what began in the window."""
    now = load_time(12)
    landing, log, checkpoint = tmp_path / "in", scratch_path(spark, "log"), scratch_path(spark, "cp")
    landing.mkdir()
    for name, minutes in (("a", [1, 119, 121]), ("b", [0, 60, 300])):
        records = [slot((now - timedelta(minutes=m)).isoformat(), 1) for m in minutes] + [{"code_insee_region": "52"}, slot(now.isoformat(), 1, code_insee_region="1")]
        (landing / f"{name}.json").write_text(json.dumps(records, ensure_ascii=False))
        documents = spark.readStream.format("text").option("wholetext", True).load(str(landing)).select(F.col("value").alias("document"))
        stream = recent_power(documents, now=F.lit(now.isoformat()).cast("timestamp"))
        start_log_stream(stream, log, checkpoint, UNTIL_CAUGHT_UP).awaitTermination()
    assert bronze.read(spark, log).count() == 3
    assert {(r.source_dataset, r.extracted_for) for r in bronze.read(spark, log).collect()} == {(TR, "2026-10-05")}


def test_a_stream_that_stood_still_loses_nothing(spark, tmp_path):
    """Three exports land, six hours apart by their names or file times; the stream runs once, long after."""
    landing, log, checkpoint = tmp_path / "in", scratch_path(spark, "log"), scratch_path(spark, "cp")
    landing.mkdir()
    asked = [load_time(h) for h in (2, 8, 14)]
    for k, now in enumerate(asked):
        records = [slot((now - timedelta(minutes=m)).isoformat(), 1) for m in (1, 119, 121)]
        path = landing / (f"tr_{now:%Y%m%dT%H%M%SZ}.json" if k < 2 else "unnamed.json")
        path.write_text(json.dumps(records, ensure_ascii=False))
        os.utime(path, (load_time(23 if k < 2 else 14).timestamp(),) * 2)
    stream = recent_power(landed.stream_documents(spark, str(landing)))
    start_log_stream(stream, log, checkpoint, UNTIL_CAUGHT_UP).awaitTermination()
    got = bronze.read(spark, log)
    assert got.count() == 6
    assert sorted(r.ingested_at.hour for r in got.select("ingested_at").distinct().collect()) == [2, 8, 14]
    versions = slots_module.silver.power_slots(got).agg(F.max("ingested_at"), F.count("*")).first()
    assert tuple(versions) == (asked[2].replace(tzinfo=None), 6)


@pytest.mark.parametrize("name, want", [("x_20261005T020000Z.json", 2), ("asked=20261005T0300Z/a.json", 3), ("x_20261305T020000Z.json", None), ("plain.json", None)])
def test_request_time_of_a_name(spark, name, want):
    got = spark.range(1).select(landed.request_time(F.lit(f"file:/landing/{name}"))).first()[0]
    assert (got and got.hour) == want


def test_a_late_reading_leaves_the_windows_but_not_the_log(spark):
    """The third file holds a reading of a slot that the watermark has closed."""
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "out", "cp"))
    got = []
    for times in (["10:01", "10:20"], ["13:00"], ["10:05", "13:20"], ["17:00"]):
        data = spark.createDataFrame([(f"2024-01-01 {t}:00", 4) for t in times], "t string, mw int")
        data.select(F.col("t").cast("timestamp").alias("t"), "mw").write.mode("append").parquet(landing)
        stream = spark.readStream.schema("t timestamp, mw int").parquet(landing)
        sums = energy_by_slot(stream, "t", [F.sum("mw").alias("mw")])
        run = sums.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        run.trigger(**UNTIL_CAUGHT_UP).start().awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(out).select(F.date_format("slot_start", "HH:mm"), "mw").collect()}
    assert got == {("10:00", 4), ("10:15", 4), ("13:00", 4), ("13:15", 4)}
    assert spark.read.parquet(landing).count() == 6


def test_the_store_is_not_listed_before_a_compaction_can_be_due(spark, log, monkeypatch):
    landing, store, checkpoint = (scratch_path(spark, name) for name in ("landing", "store", "checkpoint"))
    records = log(*[(CD, slot(f"2024-01-05T{h:02d}:00:00", h + 1), load_time(1)) for h in range(3)])
    records.repartition(3).sortWithinPartitions("ingested_at").write.parquet(landing)
    n_files = len(spark.read.parquet(landing).inputFiles())
    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    listed, compact = [], slots_module.compact_slots
    monkeypatch.setattr(slots_module, "compact_slots", lambda *arguments: listed.append(1) or compact(*arguments))
    start_slot_stream(stream, store, checkpoint, UNTIL_CAUGHT_UP, compact_after=2).awaitTermination()
    assert n_files > 1 and len(listed) == n_files - 1
    assert read_slots(spark, store).count() == 3


def test_versions_compete_only_where_a_period_has_several_parts(spark, log, plan):
    """A period with one batch, or one compaction, is read as it is; the rows are those of a rebuild at every step."""
    store = scratch_path(spark, "store")
    merge_slots(log(*VERSIONS[:4]), store, 0)
    first = read_slots(spark, store)
    assert "Window" not in plan(first) and rows(first) == rows(silver.power_slots(log(*VERSIONS[:4])))
    merge_slots(log(*VERSIONS[4:]), store, 1)
    assert "Window" in plan(read_slots(spark, store)) and rows(read_slots(spark, store)) == rows(silver.power_slots(log(*VERSIONS)))
    assert "Window" not in plan(read_slots(spark, store, [date(2024, 1, 2)]))
    compact_slots(spark, store)
    assert "Window" not in plan(read_slots(spark, store)) and rows(read_slots(spark, store)) == rows(silver.power_slots(log(*VERSIONS)))
    assert read_slots(spark, store, [date(2024, 1, 3)]).count() == 0
