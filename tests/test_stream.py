import json
from datetime import datetime

from tipoff.operators import upsert as up
from tipoff.sources import bronze, landing
from tipoff.streaming.ingest import drain, stream_to_bronze


def write(folder, name, payload):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(payload))


def run(spark, tmp_path, root, **kw):
    records = landing.stream_scoreboard_files(spark, str(tmp_path / "landing"), "u")
    drain(stream_to_bronze(spark, records, root, str(tmp_path / "checkpoint"), **kw))


def state(spark, root):
    return {r.date: r.raw_data for r in bronze.read_table(spark, root, bronze.SCOREBOARD).collect()}


def test_stream_equals_batch_and_restart_writes_nothing_new(spark, root, tmp_path):
    landed = tmp_path / "landing"
    write(landed, "2023-03-15.json", {"events": [1]})
    write(landed, "2023-03-16.json", {"events": [2]})
    write(landed, "nameless.json", {})
    seen = []
    run(spark, tmp_path, root, rejects=str(tmp_path / "rejects"), after=lambda df, i: seen.append((i, df.count())))
    assert seen == [(0, 2)]
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 1

    run(spark, tmp_path, root)
    assert up.read_outcomes(spark, root, bronze.SCOREBOARD).select("run").distinct().count() == 1

    batch_root = str(tmp_path / "batch")
    good, _ = bronze.prepare_scoreboard(landing.read_scoreboard_files(spark, str(landed), "u"))
    up.upsert(spark, batch_root, bronze.SCOREBOARD, good)
    assert state(spark, root) == state(spark, batch_root)


def test_late_correction_replaces_and_touches_only_its_date(spark, root, tmp_path):
    landed = tmp_path / "landing"
    write(landed, "2023-03-15.json", {"events": [1]})
    write(landed, "2023-03-16.json", {"events": [2]})
    run(spark, tmp_path, root)
    write(landed, "fix-2023-03-15.json", {"events": [1, "corrected"]})
    run(spark, tmp_path, root)
    assert state(spark, root) == {"2023-03-15": '{"events": [1, "corrected"]}', "2023-03-16": '{"events": [2]}'}
    second = up.read_outcomes(spark, root, bronze.SCOREBOARD, "stream-1").collect()
    assert [(r.date, r.action) for r in second] == [("2023-03-15", "update")]


def test_repeated_batch_id_is_applied_once(spark, root):
    def records(content, day):
        row = spark.createDataFrame([("2023-03-15", content, datetime(2024, 1, day))], "date string, raw_data string, created_at timestamp")
        return bronze.prepare_scoreboard(row)[0]

    up.upsert(spark, root, bronze.SCOREBOARD, records("A", 1), run="stream-0")
    up.upsert(spark, root, bronze.SCOREBOARD, records("B", 2), run="stream-1")
    up.upsert(spark, root, bronze.SCOREBOARD, records("A", 1), run="stream-0")
    assert state(spark, root) == {"2023-03-15": "B"}
