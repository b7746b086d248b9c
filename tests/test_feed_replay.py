"""Change records that are delivered again."""

from __future__ import annotations

import json

from panelforge.streaming.feed import change_records


def put(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def run(spark, folder, tmp_path, **options):
    batches = []
    stream = change_records(spark, str(folder), **options).writeStream.foreachBatch(
        lambda batch, _: batches.append(sorted(map(tuple, batch.collect()), key=str))
    )
    stream.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    return [r for b in batches for r in b]


def test_a_record_acts_once_and_none_is_late(spark, tmp_path):
    folder = tmp_path / "feed"
    a = {"fileId": "a", "removed": False, "time": "2024-05-01T00:00:00Z"}
    b = {"fileId": "b", "removed": True, "time": None}
    put(folder, "1.json", a, a, b)
    assert run(spark, folder, tmp_path) == [("a", False, a["time"]), ("b", True, None)]
    # The next run gets the file again under another name, a later change of a file, and a very old record.
    again, old = {**a, "time": "2024-05-02T00:00:00Z"}, {"fileId": "c", "removed": False, "time": "1990-01-01T00:00:00Z"}
    put(folder, "2.json", a, b, again, old)
    assert run(spark, folder, tmp_path) == [("a", False, again["time"]), ("c", False, old["time"])]
    put(folder, "3.json", old, a, again)
    assert run(spark, folder, tmp_path) == []


def test_without_a_window_records_act_each_time(spark, tmp_path):
    a = {"fileId": "a", "removed": False, "time": "2024-05-01T00:00:00Z"}
    put(tmp_path / "feed", "1.json", a, a)
    assert len(run(spark, tmp_path / "feed", tmp_path, replay_window=None)) == 2
