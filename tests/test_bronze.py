import hashlib
import itertools
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tipoff.operators import upsert as up
from tipoff.plans import migrate
from tipoff.sources import bronze, files, landing

T0 = datetime(2024, 1, 1)
SCHEMA = "date string, source_url string, parameters string, raw_data string, created_at timestamp, content_hash string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def records(spark, rows):
    """(date, payload, day offset[, hash]) tuples as incoming records."""
    data = [(d, "u", "{}", raw, T0 + timedelta(days=t), h[0] if h else None) for d, raw, t, *h in rows]
    return bronze.prepare_scoreboard(spark.createDataFrame(data, SCHEMA))[0]


def put(spark, root, rows, run=None):
    outcome = up.upsert(spark, root, bronze.SCOREBOARD, records(spark, rows), run)
    return {r.date: r.action for r in outcome.collect()}


def state(spark, root):
    rows = bronze.read_table(spark, root, bronze.SCOREBOARD).collect()
    return sorted((r.date, r.raw_data, (r.created_at - T0).days) for r in rows)


def test_absent_key_is_inserted(spark, root):
    assert put(spark, root, [("2023-03-15", "A", 0)]) == {"2023-03-15": "insert"}
    assert put(spark, root, [("2023-03-16", "B", 1)]) == {"2023-03-16": "insert"}
    assert state(spark, root) == [("2023-03-15", "A", 0), ("2023-03-16", "B", 1)]


def test_same_hash_keeps_the_stored_row_and_time(spark, root):
    put(spark, root, [("2023-03-15", "A", 0)])
    assert put(spark, root, [("2023-03-15", "A", 5)]) == {"2023-03-15": "unchanged"}
    assert state(spark, root) == [("2023-03-15", "A", 0)]


def test_different_hash_replaces_and_other_rows_stay(spark, root):
    put(spark, root, [("2023-03-15", "A", 0), ("2023-03-16", "B", 0), ("2023-04-01", "C", 0)])
    assert put(spark, root, [("2023-03-15", "A2", 3)]) == {"2023-03-15": "update"}
    assert state(spark, root) == [("2023-03-15", "A2", 3), ("2023-03-16", "B", 0), ("2023-04-01", "C", 0)]


@pytest.mark.parametrize("stored_hash", ["", None])
def test_empty_stored_hash_is_replaced(spark, root, stored_hash):
    row = [("2023-03-15", "u", "{}", stored_hash, "A", T0, "2023", "03")]
    table = spark.createDataFrame(row, bronze.SCOREBOARD.schema)
    table.write.partitionBy("year", "month").parquet(f"{root}/scoreboard")
    assert put(spark, root, [("2023-03-15", "A", 1)]) == {"2023-03-15": "update"}
    assert state(spark, root) == [("2023-03-15", "A", 1)]


def test_first_of_several_stored_rows_decides_and_a_replace_drops_all(spark, root):
    rows = [("2023-03-15", "u", "{}", sha(p), p, T0 + timedelta(days=i), "2023", "03") for i, p in enumerate("AB")]
    table = spark.createDataFrame(rows, bronze.SCOREBOARD.schema)
    table.write.partitionBy("year", "month").parquet(f"{root}/scoreboard")
    assert put(spark, root, [("2023-03-15", "A", 5)]) == {"2023-03-15": "unchanged"}
    assert put(spark, root, [("2023-03-15", "B", 6)]) == {"2023-03-15": "update"}
    assert state(spark, root) == [("2023-03-15", "B", 6)]


def serial(batches):
    """What applying records one by one gives."""
    table = {}
    for batch in batches:
        for d, raw, t in sorted(batch, key=lambda r: (r[2], sha(r[1]))):
            if d not in table or table[d][0] != raw:
                table[d] = (raw, t)
    return sorted((d, raw, t) for d, (raw, t) in table.items())


def test_one_batch_equals_serial_application(spark, root):
    """Every order of contents A and B over three captures, after A was stored."""
    day = lambda i: f"2023-03-{i + 1:02d}"
    patterns = list(itertools.product("AB", repeat=3))
    first = [(day(i), "A", 0) for i in range(len(patterns))]
    second = [(day(i), c, 1 + t) for i, p in enumerate(patterns) for t, c in enumerate(p)]
    put(spark, root, first)
    actions = put(spark, root, second)
    assert state(spark, root) == serial([first, second])
    assert actions == {day(i): "unchanged" if set(p) == {"A"} else "update" for i, p in enumerate(patterns)}


def test_content_may_return_to_an_earlier_form(spark, root):
    for i, content in enumerate("ABA"):
        put(spark, root, [("2023-03-15", content, i)])
    assert state(spark, root) == [("2023-03-15", "A", 2)]


def test_repeating_a_batch_changes_nothing(spark, root):
    batch = [("2023-03-15", "A", 0), ("2023-03-16", "B", 0)]
    put(spark, root, batch)
    before = state(spark, root)
    assert set(put(spark, root, batch).values()) == {"unchanged"}
    assert state(spark, root) == before


def test_identical_copies_become_one_row(spark, root):
    put(spark, root, [("2023-03-15", "A", 0)] * 50)
    assert state(spark, root) == [("2023-03-15", "A", 0)]


def test_a_committed_run_is_not_applied_twice(spark, root):
    put(spark, root, [("2023-03-15", "A", 0)], run="r1")
    put(spark, root, [("2023-03-15", "B", 1)], run="r2")
    assert put(spark, root, [("2023-03-15", "A", 0)], run="r1") == {"2023-03-15": "insert"}
    assert state(spark, root) == [("2023-03-15", "B", 1)]


def test_interrupted_swap_is_replayed(spark, root, monkeypatch):
    put(spark, root, [("2023-03-15", "A", 0), ("2023-04-15", "A", 0), ("2023-04-16", "K", 0)])
    moved = []
    real = files.replace

    def dies_after_one(session, source, target):
        if moved:
            raise KeyboardInterrupt
        moved.append(target)
        real(session, source, target)

    monkeypatch.setattr(files, "replace", dies_after_one)
    with pytest.raises(KeyboardInterrupt):
        put(spark, root, [("2023-03-15", "B", 1), ("2023-04-15", "B", 1)], run="dies")
    monkeypatch.setattr(files, "replace", real)
    assert up.recover(spark, root, bronze.SCOREBOARD) == ["dies"]
    assert state(spark, root) == [("2023-03-15", "B", 1), ("2023-04-15", "B", 1), ("2023-04-16", "K", 0)]
    assert up.read_outcomes(spark, root, bronze.SCOREBOARD, "dies").count() == 2
    assert files.subdirectories(spark, f"{root}/_stage/scoreboard") == []


def test_incomplete_stage_is_dropped(spark, root):
    put(spark, root, [("2023-03-15", "A", 0)])
    spark.range(1).write.parquet(f"{root}/_stage/scoreboard/half/decided")
    assert up.recover(spark, root, bronze.SCOREBOARD) == []
    assert state(spark, root) == [("2023-03-15", "A", 0)]


def test_unreadable_partition_is_never_replaced(spark, root):
    put(spark, root, [("2023-03-15", "A", 0), ("2023-04-15", "A", 0)])
    folder = f"{root}/scoreboard/year=2023/month=03"
    junk = os.path.join(folder, "part-junk.parquet")
    with open(junk, "wb") as f:
        f.write(b"not parquet at all")
    with pytest.raises(Exception, match="junk|Parquet|parquet"):
        put(spark, root, [("2023-03-16", "B", 1)])
    assert os.path.exists(junk)
    assert put(spark, root, [("2023-04-16", "B", 1)]) == {"2023-04-16": "insert"}
    found = [r.date for r in bronze.processed_dates(spark, root).collect()]
    assert found == ["2023-03-15", "2023-04-15", "2023-04-16"]


def test_partition_values_stay_zero_padded_strings(spark, root):
    put(spark, root, [("2023-3-5", "A", 0)])
    put(spark, root, [("2023-03-06", "B", 0)])
    assert files.leaf_directories(spark, f"{root}/scoreboard", 2) == ["year=2023/month=03"]
    row = bronze.read_table(spark, root, bronze.SCOREBOARD).where("date = '2023-03-05'").first()
    assert (row.year, row.month) == ("2023", "03")


def test_bad_records_are_rejected_with_a_reason(spark):
    rows = [("", "A"), (None, "A"), ("2023-02-30", "A"), ("15.03.2023", "A"), ("2023-03-15", None), ("2023-03-15", "A")]
    good, rejected = bronze.prepare_scoreboard(spark.createDataFrame(rows, "date string, raw_data string"))
    assert good.count() == 1
    reasons = sorted(r.reason for r in rejected.collect())
    assert reasons == ["date is required"] * 2 + ["invalid date format"] * 2 + ["payload is missing"]


def test_given_hash_is_kept_and_missing_one_is_sha256(spark):
    rows = spark.createDataFrame([("2023-03-15", "{}", "given"), ("2023-03-16", "{}", None)],
                                 "date string, raw_data string, content_hash string")
    good = bronze.prepare_scoreboard(rows)[0]
    assert sorted(r.content_hash for r in good.collect()) == sorted(["given", sha("{}")])


def test_nested_parameters_and_payload_become_json(spark):
    rows = spark.range(1).select(
        F.lit("2023-03-15").alias("date"),
        F.struct(F.lit("20230315").alias("dates"), F.lit(200).alias("limit")).alias("parameters"),
        F.struct(F.array(F.struct(F.lit("1").alias("id"))).alias("events")).alias("raw_data"),
    )
    row = bronze.prepare_scoreboard(rows)[0].first()
    assert row.parameters == '{"dates":"20230315","limit":200}'
    assert row.raw_data == '{"events":[{"id":"1"}]}'


def test_reading_one_date(spark, root):
    put(spark, root, [("2023-03-15", "A", 0), ("2023-03-16", "B", 0)])
    extra = [("2023-03-15", "u", "{}", "h", "newer", T0 + timedelta(days=9), "2023", "03")]
    spark.createDataFrame(extra, bronze.SCOREBOARD.schema).write.mode("append").partitionBy("year", "month").parquet(
        f"{root}/scoreboard"
    )
    assert [r.raw_data for r in bronze.read_scoreboard(spark, root, "2023-03-15").collect()] == ["newer"]
    assert bronze.read_scoreboard(spark, root, "2023-03-15", latest_only=False).count() == 2
    for absent in ("2023-03-17", "2024-01-01", "nonsense"):
        assert bronze.read_scoreboard(spark, root, absent).count() == 0
    in_range = bronze.read_scoreboard_range(spark, root, "2023-03-01", "2023-04-02")
    assert sorted(r.raw_data for r in in_range.collect()) == ["B", "newer"]


def test_reading_one_date_prunes_directories(spark, root):
    put(spark, root, [("2023-03-15", "A", 0), ("2023-04-16", "B", 0)])
    plan = bronze.read_scoreboard(spark, root, "2023-03-15", latest_only=False)
    assert [os.path.basename(os.path.dirname(p)) for p in plan.inputFiles()] != []
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text and "month" in text.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_empty_store(spark, root):
    assert bronze.read_scoreboard(spark, root, "2023-03-15").count() == 0
    assert bronze.processed_dates(spark, root).count() == 0
    assert bronze.read_teams(spark, root).count() == 0
    assert bronze.list_endpoints(spark, root) == []


def test_team_records_are_keyed_by_parameters(spark, root):
    def teams(rows):
        data = [("u", p, raw, T0 + timedelta(days=t)) for p, raw, t in rows]
        frame = spark.createDataFrame(data, "source_url string, parameters string, raw_data string, created_at timestamp")
        return {r.parameters: r.action for r in up.upsert(spark, root, bronze.TEAMS, bronze.prepare_teams(frame)[0]).collect()}

    assert teams([("p1", "A", 0), ("p2", "B", 1)]) == {"p1": "insert", "p2": "insert"}
    assert teams([("p1", "A", 2), ("p2", "C", 3)]) == {"p1": "unchanged", "p2": "update"}
    assert bronze.read_teams(spark, root).first().raw_data == "C"
    assert bronze.read_teams(spark, root, latest_only=False).count() == 2
    assert {r.parameters: r.raw_data for r in bronze.read_teams_per_request(spark, root).collect()} == {"p1": "A", "p2": "C"}
    put(spark, root, [("2023-03-15", "A", 0)])
    assert bronze.list_endpoints(spark, root) == ["scoreboard", "teams"]


def test_processed_dates_of_other_endpoints_are_empty(spark, root):
    put(spark, root, [("2023-03-16", "A", 0), ("2023-03-15", "A", 0)])
    assert [r.date for r in bronze.processed_dates(spark, root).collect()] == ["2023-03-15", "2023-03-16"]
    assert bronze.processed_dates(spark, root, "teams").count() == 0


def test_insert_absent_numbers_on_and_never_changes_a_key(spark, tmp_path):
    path = str(tmp_path / "legacy")
    schema = "date string, source_url string, parameters string, content_hash string, raw_data string, created_at timestamp"

    def frame(rows):
        return spark.createDataFrame([(d, u, "{}", sha(raw), raw, T0 + timedelta(days=t)) for d, u, raw, t in rows], schema)

    up.insert_absent(spark, path, frame([("2023-03-15", "u1", "A", 0), ("2023-03-15", "u2", "B", 0)]))
    stored = up.insert_absent(
        spark, path, frame([("2023-03-15", "u1", "Z", 1), ("2023-03-16", "u1", "C", 2), ("2023-03-16", "u1", "D", 3)])
    )
    rows = sorted((r.id, r.date, r.source_url, r.raw_data) for r in stored.collect())
    assert [r[0] for r in rows] == [1, 2, 3]
    assert {(r[1], r[2]): r[3] for r in rows} == {
        ("2023-03-15", "u1"): "A", ("2023-03-15", "u2"): "B", ("2023-03-16", "u1"): "C"
    }
    assert rows[2][1:] == ("2023-03-16", "u1", "C")


def legacy(spark, hashes):
    rows = [(i, f"2023-03-{15 + i}", "u", "{}", h, f"payload {i}", f"2023-03-{15 + i}T12:00:00") for i, h in enumerate(hashes)]
    return spark.createDataFrame(
        rows, "id int, date string, source_url string, parameters string, content_hash string, raw_data string, created_at string"
    )


def test_migration_counts_and_planted_mismatch(spark, root, tmp_path):
    legacy(spark, ["hash1", "hash2", "hash3"]).write.parquet(str(tmp_path / "extract"))
    source = migrate.read_legacy(spark, str(tmp_path / "extract"))
    counts = migrate.migrate(spark, source, root).first()
    assert (counts.source_count, counts.migrated_count, counts.rejected_count) == (3, 3, 0)
    assert migrate.validate_table(spark, source, root).first().content_match
    assert bronze.read_table(spark, root, bronze.SCOREBOARD).where("date = '2023-03-15'").first().created_at == datetime(2023, 3, 15, 12)
    changed = migrate.read_legacy(spark, str(tmp_path / "extract")).withColumn(
        "content_hash", F.when(F.col("id") == 1, "other").otherwise(F.col("content_hash"))
    )
    report = migrate.validate_table(spark, changed.where("id < 2"), root).first()
    assert (report.matched, report.different, report.missing, report.extra) == (1, 1, 0, 1)
    assert not report.content_match


def test_migration_by_endpoint(spark, root):
    frames = {
        "scoreboard": legacy(spark, ["hash1", "hash2"]).withColumn("created_at", F.col("created_at").try_cast("timestamp")),
        "teams": spark.createDataFrame([("u", "p1", "h", "A", T0)], "source_url string, parameters string, content_hash string, raw_data string, created_at timestamp"),
    }
    done = {r.table: (r.source_count, r.migrated_count, r.success) for r in migrate.migrate_endpoint(spark, "all", frames, root).collect()}
    assert done == {"scoreboard": (2, 2, True), "teams": (1, 1, True)}
    assert all(r.success for r in migrate.migrate_endpoint(spark, "validate", frames, root).collect())
    assert migrate.legacy_dates(frames["scoreboard"]).count() == 2
    with pytest.raises(ValueError, match="Unknown endpoint"):
        migrate.migrate_endpoint(spark, "players", frames, root)


def test_landed_files_become_records(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "scoreboard-2023-03-15.json").write_text('{"events":[]}\n')
    (folder / "20230316.json").write_text('{"events":[]}')
    (folder / "undated.json").write_text("{}")
    rows = landing.read_scoreboard_files(spark, str(folder), "u")
    good, rejected = bronze.prepare_scoreboard(rows)
    found = {r.date: r for r in good.collect()}
    assert set(found) == {"2023-03-15", "2023-03-16"}
    assert found["2023-03-15"].content_hash == sha('{"events":[]}\n')
    assert found["2023-03-16"].parameters == '{"dates":"20230316","groups":"50","limit":200}'
    assert rejected.count() == 1


def test_page_completeness(spark):
    pages = spark.createDataFrame([("2020", 1, 2), ("2020", 2, 2), ("2020", 2, 2), ("2021", 1, 4)], "season string, page int, pages int")
    rows = {r.season: r.complete for r in landing.page_completeness(pages, "season", "page", "pages").collect()}
    assert rows == {"2020": True, "2021": False}
