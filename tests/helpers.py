"""Hand-made reports for unit tests."""

import datetime as dt

from playqos.schemas import bronze_schema

DAY = dt.date(2025, 1, 10)


def traffic(requests=0, responses=0.0, requested=0, received=0):
    return (requests, responses, requested, received)


def bronze_row(
    client="c1",
    server=1_000,
    bufferings=0,
    time=0,
    levels=None,
    day=DAY,
    content="m1",
    customer="k1",
    ingested=dt.datetime(2025, 2, 1),
    source="f1",
    player=True,
):
    return (
        customer,
        content,
        client,
        (server, server),
        (bufferings, time) if player else None,
        None,
        levels,
        day,
        ingested,
        source,
        "2025-02-01",
    )


def bronze(spark, *rows):
    return spark.createDataFrame(list(rows), bronze_schema())


def by(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())
