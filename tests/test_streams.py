import datetime as dt
import json
import os
import time

import pytest
from helpers import DAY, bronze, bronze_row, by, traffic
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playqos.operators import checks
from playqos.operators import metrics as M
from playqos.operators import reports as R
from playqos.paths import LakePaths
from playqos.plans.daily import run_daily
from playqos.schemas import BUFFERING_METRICS, QUALITY_METRICS, REPORT, VIEWER, bronze_schema
from playqos.sources import evolution
from playqos.sources import reports as sources
from playqos.streaming import bronze as bronze_table
from playqos.streaming import publish
from playqos.streaming.ingest import finish, ingest_json, ingest_parquet
from playqos.streaming.silver import bronze_to_silver, write_batch

NEXT = DAY + dt.timedelta(days=1)
RAW = [*REPORT.fieldNames(), "eventDate"]


@pytest.fixture
def paths(tmp_path):
    return LakePaths(str(tmp_path / "lake"))


def land(spark, paths, *rows, kind="parquet"):
    df = bronze(spark, *rows).select(*RAW)
    df.coalesce(1).write.mode("append").partitionBy("eventDate").format(kind).save(paths.raw)


def run(spark, paths, mode="recompute", **options):
    finish(ingest_parquet(spark, paths, "2025-02-01", max_files=options.pop("max_files", None)), 120)
    finish(bronze_to_silver(spark, paths, mode, **options), 120)


def buffering(spark, paths):
    table = sources.silver(spark, paths.buffering, BUFFERING_METRICS)
    return by(table, "clientId", "eventDate", "totalBufferings", "snapshotCount")


def quality(spark, paths):
    table = sources.silver(spark, paths.quality, QUALITY_METRICS)
    return by(table, "clientId", "eventDate", "qualityLabel", "totalReceivedBytes")


def level(received):
    return (traffic(received=received), None)


def test_key_split_over_two_runs(spark, tmp_path):
    for mode, total in (("replace", (2, 1)), ("recompute", (3, 2))):
        paths = LakePaths(str(tmp_path / mode))
        land(spark, paths, bronze_row(server=1, bufferings=1), bronze_row(client="other", server=1, bufferings=7))
        run(spark, paths, mode)
        land(spark, paths, bronze_row(server=2, bufferings=2))
        run(spark, paths, mode)
        assert buffering(spark, paths) == [("c1", DAY, *total), ("other", DAY, 7, 1)]
        run(spark, paths, mode)  # nothing new
        assert buffering(spark, paths) == [("c1", DAY, *total), ("other", DAY, 7, 1)]


def test_number_of_batches_does_not_change_recomputed_totals(spark, paths):
    rows = [bronze_row(client=f"c{i % 3}", server=i % 7, bufferings=i % 4, day=DAY if i % 5 else NEXT,
                       levels={"720p": level(i)}) for i in range(24)]
    for row in rows[::8]:
        land(spark, paths, row)
    land(spark, paths, *rows)
    run(spark, paths, max_files=1, max_batches=1)
    every = R.healthy(bronze_table.table(spark, paths))
    want = M.buffering_from_bronze(every)
    assert buffering(spark, paths) == by(want, "clientId", "eventDate", "totalBufferings", "snapshotCount")
    want = M.quality_from_bronze(every)
    assert quality(spark, paths) == by(want, "clientId", "eventDate", "qualityLabel", "totalReceivedBytes")


@pytest.mark.parametrize("small", [True, False])
def test_late_copy_moves_the_credit_and_empties_a_day(spark, paths, monkeypatch, small):
    monkeypatch.setattr("playqos.session.is_small", lambda keys: small)
    land(spark, paths, bronze_row(server=5, bufferings=4, day=NEXT, levels={"720p": level(9)}))
    run(spark, paths)
    assert buffering(spark, paths) == [("c1", NEXT, 4, 1)]
    land(spark, paths, bronze_row(server=5, bufferings=4, day=DAY, levels={"720p": level(9)}))
    run(spark, paths)
    assert buffering(spark, paths) == [("c1", DAY, 4, 1)]
    assert quality(spark, paths) == [("c1", DAY, "720p", 9)]


def test_a_copy_that_loses_changes_nothing(spark, paths):
    land(spark, paths, bronze_row(server=5, bufferings=4), bronze_row(server=6, bufferings=1, day=NEXT))
    run(spark, paths)
    land(spark, paths, bronze_row(server=5, bufferings=4, day=NEXT))
    run(spark, paths)
    assert buffering(spark, paths) == [("c1", DAY, 4, 1), ("c1", NEXT, 1, 1)]


def test_null_server_timestamps_are_copies_of_each_other(spark, paths):
    land(spark, paths, bronze_row(server=None, bufferings=2, day=NEXT))
    run(spark, paths)
    land(spark, paths, bronze_row(server=None, bufferings=2, day=DAY), bronze_row(server=3, day=DAY))
    run(spark, paths)
    assert buffering(spark, paths) == [("c1", DAY, 2, 2)]


def test_strict_replace_duplicates_null_keys(spark, paths):
    for server in (1, 2):
        rows = bronze_row(client=None, server=server, bufferings=server), bronze_row(server=server, bufferings=5)
        land(spark, paths, *rows)
        run(spark, paths, "replace", strict=True)
    table = sources.silver(spark, paths.buffering, BUFFERING_METRICS)
    assert table.where("clientId IS NULL").count() == 2 and table.where("clientId IS NOT NULL").count() == 1
    with pytest.raises(ValueError):
        bronze_to_silver(spark, paths, "recompute", strict=True)


def test_unhealthy_rows_stay_in_bronze_only(spark, paths):
    land(spark, paths, bronze_row(client=None), bronze_row())
    run(spark, paths)
    table = bronze_table.table(spark, paths)
    assert (table.count(), R.quarantined(table).count()) == (2, 1)
    assert buffering(spark, paths) == [("c1", DAY, 0, 1)]
    assert quality(spark, paths) == []  # no report had traffic, yet the table can be read


def test_replay_publishes_the_staged_copy(spark, paths, monkeypatch):
    """The driver dies after the copy is complete, amid publishing: a part is gone, its copy not yet in its place."""
    land(spark, paths, bronze_row(bufferings=1))
    run(spark, paths, "replace")

    def die(*_):
        raise RuntimeError("driver lost")

    batch = R.compact(bronze(spark, bronze_row(bufferings=3), bronze_row(client="new")))
    monkeypatch.setattr(publish, "move", die)
    with pytest.raises(RuntimeError):
        write_batch(batch, 7, paths, "replace")
    assert buffering(spark, paths) == []
    monkeypatch.undo()
    for rows in (batch, batch.limit(1)):  # the copy counts, not what is computed again
        write_batch(rows, 7, paths, "replace")
        assert buffering(spark, paths) == [("c1", DAY, 3, 1), ("new", DAY, 0, 1)]


def test_a_table_without_success_marker_is_still_a_table(spark, paths):
    """Copied or compacted by other means, it must not be taken for an unfinished one."""
    kept = M.buffering_from_bronze(bronze(spark, bronze_row(client="kept")))
    filed = kept.withColumn("bucket", publish.bucket_of(VIEWER, paths.buckets))
    filed.write.partitionBy("eventDate", "bucket").parquet(paths.buffering)
    os.remove(f"{paths.buffering}/_SUCCESS")
    write_batch(R.compact(bronze(spark, bronze_row())), 0, paths, "replace")
    assert buffering(spark, paths) == [("c1", DAY, 0, 1), ("kept", DAY, 0, 1)]


def test_lookback_keeps_old_days_of_late_files(spark, paths):
    old = DAY - dt.timedelta(days=40)
    land(spark, paths, bronze_row(server=1, bufferings=1, day=old), bronze_row(server=9, bufferings=1))
    run(spark, paths, lookback_days=2)
    land(spark, paths, bronze_row(server=2, bufferings=1, day=old))
    run(spark, paths, lookback_days=2)
    assert buffering(spark, paths) == [("c1", old, 2, 2), ("c1", DAY, 1, 1)]


def test_both_formats_and_rerun(spark, paths):
    land(spark, paths, bronze_row(server=1, bufferings=1), bronze_row(server=2, day=NEXT))
    folder = f"{paths.raw}/eventDate={DAY}"
    report = {"customerId": "k1", "contentId": "m1", "clientId": "j1", "timestampInfo": {"server": 3, "agent": 3},
              "player": {"bufferings": 2, "bufferingTime": 10},
              "qualityDistribution": {"720p": {"sourceTraffic": {"receivedData": 8}}}}
    with open(f"{folder}/part-pretty.json", "w") as out:
        json.dump(report, out, indent=2)
    for _ in range(2):
        finish(ingest_parquet(spark, paths, "2025-02-01"), 120)
        finish(ingest_json(spark, paths, "2025-02-01", multi_line=True), 120)
    table = bronze_table.table(spark, paths)
    assert by(table, "clientId", "eventDate", "_ingested_date") == [
        ("c1", DAY, "2025-02-01"), ("c1", NEXT, "2025-02-01"), ("j1", DAY, "2025-02-01"),
    ]
    assert tuple(checks.lineage_nulls(table).first()) == (0, 0, 0)
    assert checks.schema_differences(table.schema, bronze_schema()) == []
    sourced = table.where(F.col("_source_file").contains("part-pretty.json") & (F.col("clientId") == "j1"))
    assert sourced.first().qualityDistribution["720p"].sourceTraffic.receivedData == 8


def test_landed_batches_read_as_reports_have_ids_only(spark, paths):
    """Batches put into the raw zone pass the report schema: ids match, the rest is null."""
    land(spark, paths, bronze_row())
    with open(f"{paths.raw}/eventDate={DAY}/batch.json", "w") as out:
        json.dump({"clientId": "b", "contentId": "m", "customerId": "k", "events": [{}], "batchSize": 1}, out)
    run(spark, paths)
    finish(ingest_json(spark, paths), 120)
    row = bronze_table.table(spark, paths).where("clientId = 'b'").first()
    assert (row.timestampInfo, row.player, row.qualityDistribution, row.eventDate) == (None, None, None, DAY)


def test_pretty_printed_needs_multi_line(spark, paths):
    land(spark, paths, bronze_row())
    with open(f"{paths.raw}/eventDate={DAY}/a.json", "w") as out:
        out.write('{\n "clientId": "j1",\n "contentId": "m1"\n}')
    finish(ingest_json(spark, paths), 120)
    assert bronze_table.table(spark, paths).where("clientId = 'j1'").count() == 0
    assert {r[0].strip(' ,') for r in bronze_table.corrupt_reports(spark, paths).select("_corrupt_record").collect()} == {
        "{", '"clientId": "j1"', '"contentId": "m1"', "}"}


def json_lines(paths, name, *clients):
    folder = f"{paths.raw}/eventDate={DAY}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.writelines(json.dumps({"clientId": c, "contentId": "m1", "customerId": "k1"}) + "\n" for c in clients)
    return f"{folder}/{name}"


def test_many_records_in_a_file_by_default(spark, paths):
    json_lines(paths, "a.json", *[f"c{i}" for i in range(50)])
    finish(ingest_json(spark, paths), 120)
    assert bronze_table.table(spark, paths).count() == 50


def test_old_files_that_come_late_are_ingested(spark, paths):
    json_lines(paths, "a.json", "new")
    finish(ingest_json(spark, paths), 120)
    month_ago = time.time() - 30 * 86_400
    os.utime(json_lines(paths, "b.json", "old"), (month_ago, month_ago))
    json_lines(paths, "c.json", "newer")
    finish(ingest_json(spark, paths), 120)
    assert by(bronze_table.table(spark, paths), "clientId") == [("new",), ("newer",), ("old",)]


def test_unreadable_records_keep_their_text(spark, paths):
    with open(json_lines(paths, "a.json", "c1"), "a") as out:
        out.write('{"clientId": "c2", broken\n')
    finish(ingest_json(spark, paths), 120)
    corrupt = bronze_table.corrupt_reports(spark, paths)
    assert by(corrupt, "_corrupt_record", "eventDate") == [('{"clientId": "c2", broken', DAY)]
    assert corrupt.first()._source_file.endswith("a.json")
    assert bronze_table.table(spark, paths).count() == 2


def test_daily_run_on_an_empty_zone(spark, paths):
    result = run_daily(spark, paths, timeout=120)
    assert result.buffering.count() == result.quality.count() == 0
    assert result.charts["quality_consumption"].count() == 0


def test_daily_run_and_full_refresh(spark, paths):
    land(spark, paths, bronze_row(server=1, bufferings=6, levels={"4K": level(10)}))
    first = run_daily(spark, paths, ingested_date="2025-02-01", timeout=120)
    assert tuple(first.charts["qos_summary"].first()) == (1, 0, 0.0, 0.0)
    assert by(first.charts["quality_consumption"], "qualityLabel", "qualityRank", "totalSrcBytes") == [("4K", 7, 10)]
    land(spark, paths, bronze_row(client="c2", server=2))
    again = run_daily(spark, paths, full_refresh="g1", timeout=120)
    assert again.buffering.count() == 2 and first.buffering.count() == 1
    assert again.paths.buffering != first.paths.buffering


def test_raw_day_and_listing(spark, paths):
    land(spark, paths, bronze_row(), bronze_row(day=NEXT))
    one = sources.raw_day(spark, paths, DAY.isoformat())
    assert one.count() == 1 and "eventDate" not in one.columns
    assert checks.schema_differences(one.schema, REPORT) == []
    assert sources.raw_day(spark, paths, DAY.isoformat(), REPORT).first().clientId == "c1"
    seen = checks.preview(one, ["clientId", "timestampInfo.server", "player.bufferings"])
    assert [tuple(r) for r in seen.collect()] == [("c1", 1_000, 0)]
    assert seen.columns == ["clientId", "timestampInfo_server", "player_bufferings"]
    files = sources.raw_files(spark, paths.raw)
    assert files.where("length > 0 AND path LIKE '%.parquet'").count() == 2
    assert by(sources.rows_per_file(one), "rowCount") == [(1,)]
    assert set(paths.describe()) >= {"raw", "bronze_parquet", "buffering_metrics"}


def test_schema_differences():
    have = T.StructType().add("a", "integer").add("n", T.StructType().add("x", "integer")).add("extra", "string")
    want = T.StructType().add("a", "long").add("n", T.StructType().add("x", "integer").add("y", "integer"))
    assert checks.schema_differences(have, want) == ["type a: int instead of bigint", "missing n.y", "unexpected extra"]


def test_evolution_rules(spark, paths):
    wide = T.StructType().add("a", "integer").add("n", T.StructType().add("x", "long"))
    nested = T.StructType().add("x", "integer").add("y", "string")
    grown = evolution.merged(wide, T.StructType().add("n", nested).add("b", "double"))
    assert grown.simpleString() == "struct<a:int,n:struct<x:bigint,y:string>,b:double>"
    with pytest.raises(evolution.SchemaConflict, match="n.x"):
        evolution.merged(wide, T.StructType().add("n", T.StructType().add("x", "string")))
    assert evolution.evolve(spark, paths) == REPORT  # no raw zone yet
    assert bronze_table.table(spark, paths).count() == 0
    land(spark, paths, bronze_row())
    assert evolution.evolve(spark, paths) == REPORT
    newer = spark.range(1).selectExpr("'c' AS clientId", "'v2' AS sdk")
    newer.write.mode("append").parquet(f"{paths.raw}/eventDate={NEXT}")
    assert evolution.evolve(spark, paths).fieldNames() == [*REPORT.fieldNames(), "sdk"]
    assert evolution.stored_schema(spark, paths).fieldNames()[-1] == "sdk"
    spark.range(1).selectExpr("1 AS contentId").write.mode("append").parquet(f"{paths.raw}/eventDate=2025-03-01")
    with pytest.raises(Exception):
        evolution.evolve(spark, paths)


@pytest.mark.parametrize("mode, victim", [("replace", "quality"), ("recompute", "buffering")])
def test_a_dying_driver_is_healed_by_the_restart(spark, tmp_path, monkeypatch, mode, victim):
    """The run dies while one table is half published; the restarted stream ends as if nothing happened."""
    outcome = []
    for crash in (False, True):
        paths = LakePaths(str(tmp_path / str(crash)))
        land(spark, paths, bronze_row(bufferings=1, levels={"4K": level(1)}), bronze_row(client="a", day=NEXT))
        run(spark, paths, mode)
        late = bronze_row(server=2, bufferings=2, levels={"4K": level(3)})
        land(spark, paths, late, bronze_row(client="b", day=NEXT))
        if crash:
            whole = publish.swap

            def half(spark, staged, stored, has_rows, whole=whole, paths=paths):
                if stored.startswith(getattr(paths, victim)):
                    publish.remove(spark, stored)
                    raise RuntimeError("driver lost")
                whole(spark, staged, stored, has_rows)

            monkeypatch.setattr(publish, "swap", half)
            with pytest.raises(Exception, match="driver lost"):
                run(spark, paths, mode)
            monkeypatch.undo()
        run(spark, paths, mode)
        outcome.append((buffering(spark, paths), quality(spark, paths)))
    assert outcome[0] == outcome[1]
    assert outcome[0][0][-1] == ("c1", DAY, *((2, 1) if mode == "replace" else (3, 2)))


def part_files(folder):
    return {f"{at}/{name}" for at, _, names in os.walk(folder) for name in names if name.endswith(".parquet")}


def test_new_reports_are_added_without_looking_back(spark, paths, monkeypatch):
    """No report was there before: bronze's history is not opened, and one late report rewrites one bucket of its day."""
    clients = [f"c{k}" for k in range(40)]
    land(spark, paths, *[bronze_row(client=c, server=1, bufferings=1, levels={"4K": level(5)}) for c in clients])
    run(spark, paths)
    before = part_files(paths.buffering)
    assert len(before) == paths.buckets

    def scan(*_):
        raise AssertionError("history was opened")

    monkeypatch.setattr("playqos.streaming.silver.affected_scope", scan)
    land(spark, paths, bronze_row(client="c7", server=2, bufferings=3, levels={"4K": level(1), "720p": level(9)}))
    run(spark, paths)
    assert ("c7", DAY, 4, 2) in buffering(spark, paths) and len(buffering(spark, paths)) == 40
    table = sources.silver(spark, paths.quality, QUALITY_METRICS).where("clientId = 'c7'")
    assert by(table, "qualityLabel", "totalReceivedBytes", "isDominantQuality") == [("4K", 6, False), ("720p", 9, True)]
    after = part_files(paths.buffering)
    assert len(before - after) == len(after - before) == 1


def test_only_viewers_with_a_copy_are_computed_again(spark, paths, monkeypatch):
    land(spark, paths, bronze_row(server=1, bufferings=1), bronze_row(client="other", server=1, bufferings=5))
    run(spark, paths)
    from playqos.streaming import silver

    seen, whole = [], silver.affected_scope

    def noted(rows_on, theirs, *rest):
        seen.extend(r.clientId for r in theirs.collect())
        return whole(rows_on, theirs, *rest)

    monkeypatch.setattr(silver, "affected_scope", noted)
    land(spark, paths, bronze_row(server=1, bufferings=1, day=NEXT), bronze_row(server=2, bufferings=2),
         bronze_row(client="other", server=2, bufferings=1))
    run(spark, paths)
    assert set(seen) == {"c1"}
    assert buffering(spark, paths) == [("c1", DAY, 3, 2), ("other", DAY, 6, 2)]


def test_a_batch_that_runs_again_is_added_once(spark, paths):
    first = R.compact(bronze(spark, bronze_row(server=1, bufferings=1)))
    second = R.compact(bronze(spark, bronze_row(server=2, bufferings=2), bronze_row(client="n", server=2)))
    write_batch(first, 0, paths)
    for _ in range(3):
        write_batch(second, 1, paths)
        assert buffering(spark, paths) == [("c1", DAY, 3, 2), ("n", DAY, 0, 1)]


def test_a_later_commit_is_not_counted_before_its_turn(spark, paths):
    """A copy makes a viewer computed again while bronze already holds a batch that silver has not taken yet."""
    land(spark, paths, bronze_row(server=1, bufferings=1))
    run(spark, paths)
    land(spark, paths, bronze_row(server=1, bufferings=1))
    finish(ingest_parquet(spark, paths, "2025-02-01"), 120)
    land(spark, paths, bronze_row(server=2, bufferings=5))
    run(spark, paths, max_batches=1)
    assert buffering(spark, paths) == [("c1", DAY, 6, 2)]


def test_replaced_totals_are_never_added_to(spark, paths):
    for mode, server in (("replace", 1), ("replace", 2), ("recompute", 3), ("recompute", 4)):
        land(spark, paths, bronze_row(server=server, bufferings=1))
        run(spark, paths, mode)
    assert buffering(spark, paths) == [("c1", DAY, 4, 4)]


def test_a_run_that_dies_while_creating_is_healed(spark, paths, monkeypatch):
    land(spark, paths, bronze_row(bufferings=1, levels={"4K": level(1)}))
    whole = publish.publish

    def half(spark, table, schema, token):
        if table == paths.quality:
            raise RuntimeError("driver lost")
        whole(spark, table, schema, token)

    monkeypatch.setattr(publish, "publish", half)
    with pytest.raises(Exception, match="driver lost"):
        run(spark, paths)
    monkeypatch.undo()
    run(spark, paths)
    assert buffering(spark, paths) == [("c1", DAY, 1, 1)]
    assert quality(spark, paths) == [("c1", DAY, "4K", 1)]


def test_files_with_old_times_are_ingested(spark, paths):
    land(spark, paths, bronze_row(server=1))
    finish(ingest_parquet(spark, paths, "2025-02-01"), 120)
    land(spark, paths, bronze_row(server=2, day=NEXT))
    for folder, _, names in os.walk(f"{paths.raw}/eventDate={NEXT}"):
        for name in names:
            month_ago = time.time() - 30 * 86_400
            os.utime(f"{folder}/{name}", (month_ago, month_ago))
    finish(ingest_parquet(spark, paths, "2025-02-01"), 120)
    assert bronze_table.table(spark, paths).count() == 2
