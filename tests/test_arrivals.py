"""New files by ledger, bronze by committed batches, schema conflicts, JSON layouts."""

import datetime as dt
import json
import os
import re
import time

import pytest
from helpers import DAY, bronze, bronze_row, by
from pyspark.sql import functions as F

from playqos.paths import LakePaths
from playqos.plans import queries
from playqos.schemas import REPORT
from playqos.sources import arrivals, evolution
from playqos.streaming import bronze as B
from playqos.streaming.ingest import finish, ingest_json, ingest_parquet
from playqos.streaming.silver import bronze_to_silver

RAW = [*REPORT.fieldNames(), "eventDate"]


@pytest.fixture
def paths(tmp_path):
    return LakePaths(str(tmp_path / "lake"))


def land(spark, paths, *rows):
    df = bronze(spark, *rows).select(*RAW)
    df.coalesce(1).write.mode("append").partitionBy("eventDate").parquet(paths.raw)


def ingest(spark, paths, **options):
    return finish(ingest_parquet(spark, paths, "2025-02-01", **options), 120)


def test_a_look_enters_each_file_once(spark, paths):
    days = [DAY + dt.timedelta(days=k) for k in range(5)]
    land(spark, paths, *[bronze_row(server=k, day=day) for k, day in enumerate(days)])
    with open(f"{paths.raw}/loose.parquet", "w") as out:
        out.write("x")
    odd = f"{paths.raw}/a {{b}}[1]*"
    os.makedirs(odd)
    with open(f"{odd}/deep.parquet", "w") as out:
        out.write("x")
    for at_once in (1, 2, 50):
        arrivals.look(spark, paths, "parquet", folders_at_once=at_once)
        found = by(arrivals.ledger(spark, paths, "parquet"), "folder")
        assert found == sorted([(f"eventDate={d}",) for d in days] + [("a {b}[1]*",), (".",)])
    files = [r.path for r in arrivals.ledger(spark, paths, "parquet").collect()]
    assert len(set(files)) == 7
    # What is not new leaves no file in the ledger either.
    ledgers = sum(name.endswith(".parquet") for _, _, names in os.walk(paths.arrivals("parquet")) for name in names)
    assert ledgers == 7


def test_loose_files_and_odd_folders_are_ingested(spark, paths):
    land(spark, paths, bronze_row())
    one = bronze(spark, bronze_row(client="loose")).select(*REPORT.fieldNames())
    one.coalesce(1).write.parquet(f"{paths.root}/x")
    part = next(n for n in os.listdir(f"{paths.root}/x") if n.endswith(".parquet"))
    os.makedirs(f"{paths.raw}/a [b]")
    os.rename(f"{paths.root}/x/{part}", f"{paths.raw}/a [b]/c{{1}}.parquet")
    ingest(spark, paths)
    assert by(B.table(spark, paths), "clientId", "eventDate") == [("c1", DAY), ("loose", None)]
    assert B.table(spark, paths, days=[None]).count() == 1


def test_small_batches_open_only_what_is_new(spark, paths):
    """25 runs of one file each: a run's stream lists the new commit's folder, not the table."""
    opened = []
    for k in range(25):
        land(spark, paths, bronze_row(server=k, day=DAY + dt.timedelta(days=k % 3)))
    ingest(spark, paths, max_files=1)
    entries = B.commits(spark, paths).collect()
    assert len(entries) == 25 and {e.eventDate for e in entries} == {DAY + dt.timedelta(days=k) for k in range(3)}
    for entry in entries:
        files = B.rows_of(spark, paths, [entry]).inputFiles()
        assert len(files) == 1 and f"batch={entry.batch}/" in files[0]
        opened += files
    assert len(set(opened)) == 25 and B.table(spark, paths).count() == 25
    assert len(B.table(spark, paths, days=[DAY]).inputFiles()) == 9
    land(spark, paths, bronze_row(server=99))
    ingest(spark, paths)
    new = [e for e in B.commits(spark, paths).collect() if e not in entries]
    assert len(new) == 1 and len(B.rows_of(spark, paths, new).inputFiles()) == 1


def test_an_unfinished_batch_is_invisible_and_replaced(spark, paths):
    rows = bronze(spark, bronze_row(), bronze_row(client="c2", day=None))
    rows.write.partitionBy("eventDate", "_ingested_date").parquet(f"{paths.bronze('parquet')}/batch=r-0")
    assert B.table(spark, paths).count() == 0
    for _ in range(2):
        B.write(rows, paths, "parquet", "r-0")
        assert by(B.table(spark, paths), "clientId", "eventDate") == [("c1", DAY), ("c2", None)]
    B.write(rows, paths, "json", "r-0")
    assert B.table(spark, paths).count() == 4


def test_old_times_and_copies_under_a_new_name(spark, paths):
    land(spark, paths, bronze_row(server=1))
    ingest(spark, paths)
    land(spark, paths, bronze_row(server=2))
    for folder, _, names in os.walk(paths.raw):
        for name in names:
            os.utime(f"{folder}/{name}", (time.time() - 90 * 86_400,) * 2)
    ingest(spark, paths)
    assert B.table(spark, paths).count() == 2


def test_conflicting_and_unreadable_files_stay_aside(spark, paths):
    land(spark, paths, bronze_row(server=1), bronze_row(server=2, day=DAY + dt.timedelta(days=1)))
    folder = f"{paths.raw}/eventDate=2025-03-01"
    spark.range(1).selectExpr("1 AS contentId", "'x' AS clientId").coalesce(1).write.mode("append").parquet(folder)
    spark.range(1).selectExpr("'c9' AS clientId", "'v2' AS sdk").coalesce(1).write.mode("append").parquet(folder)
    with open(f"{folder}/zz.parquet", "w") as out:
        out.write("no footer")
    for _ in range(2):
        ingest(spark, paths)
        assert sorted(c for c, in by(B.table(spark, paths), "clientId")) == ["c1", "c1", "c9"]
        aside = arrivals.set_aside(spark, paths).orderBy("path").collect()
        assert len(aside) == 2 and all(r.folder == "eventDate=2025-03-01" for r in aside)
        assert any("contentId: int does not fit string" in r.reason for r in aside)
    assert evolution.stored_schema(spark, paths).fieldNames()[-1] == "sdk"


def test_only_new_files_are_looked_at(spark, paths, monkeypatch):
    land(spark, paths, bronze_row())
    seen = []
    whole = evolution.admit
    monkeypatch.setattr(evolution, "admit", lambda s, p, files: seen.append(len(files)) or whole(s, p, files))
    for _ in range(2):
        ingest(spark, paths)
    land(spark, paths, bronze_row(server=2))
    ingest(spark, paths)
    assert seen == [1, 1]


REPORTS = [
    {"clientId": f"c{k}", "contentId": "m", "customerId": "k", "timestampInfo": {"server": k, "agent": 0},
     "qualityDistribution": {"720p": {"sourceTraffic": {"receivedData": 8}}}} for k in range(4)
]


def test_json_layouts_side_by_side(spark, paths):
    folder = f"{paths.raw}/eventDate={DAY}"
    os.makedirs(folder)
    texts = {
        "lines": "\n".join(map(json.dumps, REPORTS)),
        "one": json.dumps(REPORTS[0], indent=2),
        "several": "\n".join(json.dumps(r, indent=4) for r in REPORTS) + "\r\n",
        "array": json.dumps(REPORTS, indent=2),
        "first line broken": "{\"clientId\": \"x\",\n" + json.dumps(REPORTS[1]),
        "second broken": json.dumps(REPORTS[2], indent=2) + "\n{\n  \"clientId\": 5 5\n}\n" + json.dumps(REPORTS[3], indent=2),
        "empty": "",
    }
    for name, text in texts.items():
        with open(f"{folder}/{name}.json", "w") as out:
            out.write(text)
    finish(ingest_json(spark, paths, "2025-02-01", multi_line=None), 120)
    table = B.table(spark, paths).withColumn("name", F.regexp_extract("_source_file", "([a-z%0-9]+)[.]json", 1))
    found = {}
    for row in table.collect():
        found.setdefault(row.name.replace("%20", " "), []).append(row.clientId)
    ids = [r["clientId"] for r in REPORTS]
    assert {k: sorted(v, key=str) for k, v in found.items()} == {
        "lines": ids, "one": ids[:1], "several": ids, "array": ids, "first line broken": sorted([None, "c1"], key=str),
        "second broken": sorted([None, "c2", "c3"], key=str),
    }
    assert table.where("timestampInfo.server = 2").first().qualityDistribution["720p"].sourceTraffic.receivedData == 8
    corrupt = [r[0] for r in B.corrupt_reports(spark, paths).select("_corrupt_record").collect()]
    assert len(corrupt) == 2 and any("5 5" in c for c in corrupt)


def test_silver_takes_commits_one_by_one_or_together(spark, tmp_path):
    results = []
    for max_batches in (None, 1):
        paths = LakePaths(str(tmp_path / str(max_batches)))
        for k in range(3):
            land(spark, paths, bronze_row(server=k, bufferings=1))
        ingest(spark, paths, max_files=1)
        finish(bronze_to_silver(spark, paths, max_batches=max_batches), 120)
        results.append(by(spark.read.parquet(paths.buffering), "clientId", "totalBufferings", "snapshotCount"))
    assert results == [[("c1", 3, 3)]] * 2


def test_the_files_that_do_not_fit_are_written_by_many_tasks(spark, paths, sf_dir, monkeypatch):
    """A file for each day as before, but no task sorts the reports of all days."""
    monkeypatch.setattr(queries, "_lake", lambda spark, purpose: paths)
    queries.QUERIES["schema_conflict_set_aside"](spark, sf_dir)
    aside = arrivals.set_aside(spark, paths)
    per_folder = {r["folder"]: r["count"] for r in aside.groupBy("folder").count().collect()}
    tasks = {re.search(r"/part-(\d+)-", r.path)[1] for r in aside.collect()}
    assert len(per_folder) > 20 and set(per_folder.values()) == {1}
    assert len(tasks) > len(per_folder) * 2 // 3


def test_streamed_events_are_made_once(spark, sf_dir, monkeypatch):
    """All arrivals are parts of one stored table of events."""
    made, arrived = [], []
    scratch, write = queries.scratch_dir, queries.write_batches
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, purpose: made.append((purpose, scratch(spark, purpose))) or made[-1][1])
    monkeypatch.setattr(queries, "write_batches", lambda spark, folder, *a: arrived.append(folder) or write(spark, folder, *a))
    queries.QUERIES["event_batches_stream"](spark, sf_dir)
    events = spark.read.parquet(dict(made)["player-events"])
    every = spark.read.schema(events.schema).parquet(arrived[0])
    assert len(arrived) == 3 and every.exceptAll(events).count() == 1 and events.exceptAll(every).count() == 0
