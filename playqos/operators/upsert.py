"""Keyed upsert as plain DataFrame algebra.

Both functions return the *new content* of the partitions they were given;
storing it is :mod:`playqos.streaming.publish`'s job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def replace_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows win, target rows without a match stay.

    Plain equality: a null in the key never matches, so such a source row is
    always an insert. The anti join carries the keys of a silver table, which
    are unique, so there is no hot key to split.
    """
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def replace_viewers(target: DataFrame, source: DataFrame, viewers: DataFrame) -> DataFrame:
    """Everything the target holds for ``viewers`` gives way to ``source``.

    ``target`` is already restricted to the recomputed days. Unlike
    :func:`replace_rows` this also removes rows that no longer exist.
    """
    kept = target.join(viewers, viewers.columns, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)
