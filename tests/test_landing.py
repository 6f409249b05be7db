import datetime as dt
import json
import re

import pytest

from playqos.operators import landing as L
from playqos.paths import LakePaths
from playqos.sources import reports as sources
from playqos.streaming.ingest import finish

AT = dt.datetime(2025, 11, 13, 23, 59, 59, 999_999)
IDS = '"clientId":"c","contentId":"m","customerId":"k"'
OK = "accepted"


def bodies(spark, *texts):
    return spark.createDataFrame([(t, AT) for t in texts], "body string, receivedAt timestamp")


@pytest.mark.parametrize(
    "body, verdict",
    [
        (None, L.INVALID_JSON),
        ("", L.INVALID_JSON),
        ("{bad", L.INVALID_JSON),
        ("null", L.MISSING_IDS),
        ("[1]", L.MISSING_IDS),
        ("5", L.MISSING_IDS),
        ('{"clientId":0,"contentId":"m","customerId":"k","events":[1]}', L.MISSING_IDS),
        ('{"clientId":0.0,"contentId":"m","customerId":"k","events":[1]}', L.MISSING_IDS),
        ('{"clientId":false,"contentId":"m","customerId":"k","events":[1]}', L.MISSING_IDS),
        ('{"clientId":null,"contentId":"m","customerId":"k","events":[1]}', L.MISSING_IDS),
        ('{"clientId":"","contentId":"m","customerId":"k","events":[1]}', L.MISSING_IDS),
        ('{"clientId":"c","contentId":"m","events":[1]}', L.MISSING_IDS),
        ('{"clientId":"0","contentId":"m","customerId":"k","events":[1]}', OK),
        ('{"clientId":" ","contentId":"m","customerId":"k","events":[1]}', OK),
        ('{"clientId":7,"contentId":true,"customerId":{"a":1},"events":[{}]}', OK),
        ("{%s}" % IDS, L.NO_EVENTS),
        ('{%s,"events":[]}' % IDS, L.NO_EVENTS),
        ('{%s,"events":"nope"}' % IDS, L.NO_EVENTS),
        ('{%s,"events":{"a":1}}' % IDS, L.NO_EVENTS),
        ('{%s,"events":null}' % IDS, L.NO_EVENTS),
        ('{%s,"events":[null]}' % IDS, OK),
        ('{"clientId":"a",%s,"events":[1]}' % IDS, OK),
        ('{%s,"clientId":"","events":[1]}' % IDS, L.MISSING_IDS),
    ],
)
def test_verdicts(spark, body, verdict):
    reason = L.classify(bodies(spark, body)).first().reason
    assert (reason or OK) == verdict


def test_enrichment(spark):
    body = '{%s,"events":[{"x":1},{"x":2}],"batchSize":99,"sentAt":42}' % IDS
    accepted = L.accepted(bodies(spark, body))
    row = accepted.drop("events", "part").first()
    assert tuple(row) == ("c", "m", "k", 2, 42, "2025-11-13T23:59:59.999Z", "2025-11-13", "1.0")
    told = L.responses(bodies(spark, body, "{bad")).select("status", "message", "received").collect()
    assert [tuple(r) for r in told] == [(200, "OK", 2), (400, L.INVALID_JSON, None)]
    part = accepted.first().part
    assert re.fullmatch("part-[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", part)
    assert L.responses(bodies(spark, body)).first().path == f"raw/eventDate=2025-11-13/{part}.json"


def test_of_a_repeated_key_the_last_counts(spark):
    body = '{"clientId":"a","clientId":"b","contentId":"m","customerId":"k","events":[1]}'
    assert L.accepted(bodies(spark, body)).first().clientId == "b"


def test_landing_keeps_unknown_fields_and_is_one_object_per_line(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    body = '{%s,"events":[{"eventType":"buffering_start","timestamp":5,"novel":{"deep":[1]}}],"sentAt":1}' % IDS
    for _ in range(2):  # the second is a retry
        L.land(bodies(spark, body, "{bad"), paths, "b1")
    lines = [r.value for r in spark.read.text(paths.landed_batches).collect()]
    assert len(lines) == 1
    assert json.loads(lines[0])["events"] == [{"eventType": "buffering_start", "timestamp": 5, "novel": {"deep": [1]}}]
    batch = sources.landed_batches(spark, paths.landed_batches).first()
    assert batch.part == L.accepted(bodies(spark, body)).first().part
    assert (batch.events[0].eventType, batch.events[0].timestamp, batch.eventDate) == ("buffering_start", 5, "2025-11-13")
    assert spark.read.parquet(paths.rejected_batches).first().reason == L.INVALID_JSON


def test_landing_stream_lands_once(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    inbox = str(tmp_path / "inbox")
    texts = ['{%s,"events":[{"timestamp":%d}]}' % (IDS, i) for i in range(5)] + ["{bad"]
    for _ in range(2):
        bodies(spark, *texts).write.mode("append").parquet(inbox)
        for _ in range(2):
            stream = spark.readStream.schema("body string, receivedAt timestamp").parquet(inbox)
            finish(L.land_stream(stream, paths), 120)
    assert sources.landed_batches(spark, paths.landed_batches).count() == 10
    assert spark.read.parquet(paths.rejected_batches).count() == 2
