import json
import os

import pytest
from conftest import values

from doseledger.operators import event_log
from doseledger.streaming import replay


def _month(base, name, ids, drug="metformin"):
    folder = os.path.join(base, drug, name)
    os.makedirs(folder)
    with open(os.path.join(folder, "prescribing.jsonl"), "w") as out:
        for i in ids:
            out.write(json.dumps({"date": "202506", "actual_cost": 2.5, "items": i, "row_id": f"A{i}", "setting": 4}) + "\n\n")


@pytest.fixture
def base(tmp_path):
    _month(str(tmp_path / "lake"), "EPD_202505", range(100, 110))
    _month(str(tmp_path / "lake"), "EPD_202506", range(1, 6))
    return str(tmp_path / "lake")


def test_newest_month_is_replayed(spark, base, tmp_path):
    sink = str(tmp_path / "sink")
    totals = replay.run_stream(replay.replay_stream(spark, base, "metformin"), sink, str(tmp_path / "c"))
    assert [tuple(r) for r in totals.collect()] == [("metformin", 5, 15, 12.5)]
    row = replay.read_sink(spark, sink).filter("items = 1").first()
    assert (row["date"], row["setting"], row["ccg"], row["batch_num"]) == ("202506", "4", "", 1)
    assert row["arrived_at"] is not None


def test_missing_medicine(spark, base):
    with pytest.raises(FileNotFoundError):
        replay.replay_stream(spark, base, "nothing")


def test_reset_and_rerun_does_not_double(spark, base, tmp_path):
    sink, progress = str(tmp_path / "sink"), str(tmp_path / "c")
    for _ in range(2):
        replay.reset_stream(spark, sink, "metformin", progress)
        totals = replay.run_stream(replay.replay_stream(spark, base, "metformin"), sink, progress)
    assert totals.first()["total_records"] == 5


def test_same_checkpoint_takes_nothing_twice(spark, base, tmp_path):
    sink, progress = str(tmp_path / "sink"), str(tmp_path / "c")
    for _ in range(2):
        totals = replay.run_stream(replay.replay_stream(spark, base, "metformin"), sink, progress)
    assert totals.first()["total_records"] == 5


@pytest.mark.parametrize("rows, size, sizes", [(5, 2, [2, 2, 1]), (6, 3, [3, 3]), (4, 10, [4])])
def test_fixed_batches(spark, tmp_path, rows, size, sizes):
    data = [("202506", float(i), str(i), "1", f"A{i}", "4", "C", None, "d") for i in range(rows)]
    df = spark.createDataFrame(data, "date string, actual_cost double, items string, quantity string, row_id string, setting string, ccg string, icb_name string, drug string")
    path, sink = str(tmp_path / "numbered"), str(tmp_path / "sink")
    replay.number_batches(df.repartition(3), ["row_id"], size).write.json(path)
    replay.run_stream(spark.readStream.schema(replay.NUMBERED).json(path), sink, str(tmp_path / "c"))
    stored = replay.read_sink(spark, sink)
    got = values(stored.groupBy("batch_num").count(), "batch_num", "count")
    assert got == [(i + 1, n) for i, n in enumerate(sizes)]
    assert replay.stream_overview(stored).first()["total_batches"] == len(sizes)
    snapshot = replay.batch_snapshot(stored, 2).collect()
    assert snapshot[0]["records_in_batch"] == sizes[0] and len(snapshot) == min(2, len(sizes))
    order = [r["batch_num"] for r in stored.orderBy("row_id").collect()]
    assert order == sorted(order)


def test_running_totals_equal_the_batch_sum(spark, base, tmp_path):
    stream = replay.replay_stream(spark, base, "metformin")
    totals = replay.run_totals(stream, str(tmp_path / "totals"), str(tmp_path / "c"))
    assert [tuple(r) for r in totals.collect()] == [("metformin", 5, 15, 12.5)]


def _files(path, *batches):
    """One file of records a batch, in the order of their names."""
    os.makedirs(path, exist_ok=True)
    for n, rows in enumerate(batches, len(os.listdir(path))):
        with open(f"{path}/{n}.json", "w") as out:
            for drug, items in rows:
                out.write(json.dumps({"date": "202506", "actual_cost": 1.5, "items": items, "row_id": "A", "drug": drug}) + "\n")
        os.utime(f"{path}/{n}.json", (n, n))


def _stream(spark, path):
    return spark.readStream.schema(replay.RAW_RECORD).option("maxFilesPerTrigger", 1).json(path)


BATCHES = [[("a", 1), ("b", 2)], [("a", 3)], [("c", 4), ("a", 5)], [("b", 6)]]


@pytest.mark.parametrize("late", [False, True])
def test_a_trigger_that_failed_is_stored_once_after_a_restart(spark, tmp_path, monkeypatch, late):
    source, sink, progress = str(tmp_path / "in"), str(tmp_path / "sink"), str(tmp_path / "c")
    _files(source, *BATCHES)
    whole, calls = replay.sink_rows, []

    def failing(rows):
        calls.append(1)
        if len(calls) == 3:
            if late:  # some of its rows are stored already
                whole(rows).filter("drug = 'c'").selectExpr("*", "2L AS epoch").write.partitionBy("drug", "epoch").mode("append").parquet(sink)
            raise RuntimeError("killed")
        return whole(rows)

    with monkeypatch.context() as patch:
        patch.setattr(replay, "sink_rows", failing)
        with pytest.raises(Exception, match="killed"):
            replay.run_stream(_stream(spark, source), sink, progress)
    assert replay.read_sink(spark, sink).filter("drug <> 'c'").count() == 3
    totals = replay.run_stream(_stream(spark, source), sink, progress)
    assert values(totals, "drug", "total_records", "total_items") == [("a", 3, 9), ("b", 2, 8), ("c", 1, 4)]
    assert values(replay.read_sink(spark, sink), "items", "batch_num") == [(1, 1), (2, 1), (3, 2), (4, 3), (5, 3), (6, 4)]


def test_totals_of_changed_medicines_replace_theirs(spark, tmp_path, monkeypatch):
    source, target, progress = str(tmp_path / "in"), str(tmp_path / "totals"), str(tmp_path / "c")
    _files(source, *BATCHES[:2])
    shown = ("drug", "total_records", "total_items", "total_cost_gbp")
    assert values(replay.run_totals(_stream(spark, source), target, progress), *shown) == [("a", 2, 4, 3.0), ("b", 1, 2, 1.5)]
    _files(source, *BATCHES[2:])
    real, calls = replay.delete_path, []

    def failing(own, path):
        calls.append(path)
        if len(calls) == 1:
            raise RuntimeError("killed")  # after the write of an epoch
        return real(own, path)

    with monkeypatch.context() as patch:
        patch.setattr(replay, "delete_path", failing)
        with pytest.raises(Exception, match="killed"):
            replay.run_totals(_stream(spark, source), target, progress)
    totals = replay.run_totals(_stream(spark, source), target, progress)
    assert values(totals, *shown) == [("a", 3, 9, 4.5), ("b", 2, 8, 3.0), ("c", 1, 4, 1.5)]
    assert len([d for d in os.listdir(target) if d.startswith("epoch=")]) <= 3


def test_empty_sink(spark, tmp_path):
    assert replay.read_sink(spark, str(tmp_path / "none")).count() == 0


def test_event_log(spark, tmp_path):
    log = str(tmp_path / "log")
    with event_log.recorded(spark, log, "good", ["a"], ["b"]) as first:
        pass
    with pytest.raises(KeyError):
        with event_log.recorded(spark, log, "bad") as second:
            raise KeyError
    events = event_log.read_events(spark, log)
    assert first != second
    assert values(events, "job_name", "event_type") == [
        ("bad", "FAIL"), ("bad", "START"), ("good", "COMPLETE"), ("good", "START"),
    ]
    bad = events.filter("job_name = 'bad'").first()
    assert bad["inputs"] == [] and bad["event_time"] is not None
    runs = {r["job_name"]: r["state"] for r in event_log.lineage_runs(events).collect()}
    assert runs == {"good": "COMPLETE", "bad": "FAIL"}
    assert values(event_log.lineage_edges(events), "input", "job_name", "output") == [("a", "good", "b")]


def test_open_run_and_missing_lists(spark, tmp_path):
    path = tmp_path / "e.json"
    path.write_text(
        json.dumps({"eventType": "START", "eventTime": "2025-01-01T00:00:00+00:00", "run": {"runId": "r"}, "job": {"namespace": "n", "name": "j"}})
        + "\n" + json.dumps({"eventType": "OTHER", "run": {"runId": "x"}}) + "\n"
    )
    row = event_log.lineage_runs(event_log.read_events(spark, str(path))).collect()
    assert [(r["run_id"], r["state"], r["ended_at"]) for r in row] == [("r", "START", None)]


def test_upstream_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "j", "b"), ("b", "j", "c"), ("c", "j", "a"), ("x", "j", "y")], "input string, job_name string, output string")
    assert values(event_log.upstream(edges, "c"), "dataset", "distance") == [("a", 2), ("b", 1)]


def test_rejected_events(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text('{"eventType":"START"}\n{"eventType":"ABORT"}\nnot json\n\n')
    rejected = event_log.rejected_events(spark, str(tmp_path / "log"))
    assert values(rejected, "reason") == [("no event type or not JSON",), ("unknown event type",)]
