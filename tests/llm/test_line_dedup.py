"""Line dedup against a plain version, and the store of runs."""

import random
from collections import defaultdict

import pytest

from playqos.llm import line_dedup as L

BLANKS = " \t\n\v\f\r"


def plain(rows, least, min_docs):
    """rows of (doc_id, text) -> the same rows with (n_lines, n_dropped, kept)."""
    low = L.NO_ID
    holders = defaultdict(set)

    def key(line):
        bare = line.strip(BLANKS)
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bare) if len(bare) >= least else None

    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(low if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        at = low if i is None else i
        kept = [x for x in lines if key(x) is None or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == at]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def found(docs, **options):
    rows = L.dedup_lines(docs, **options).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    return sorted(map(tuple, rows), key=repr)


def test_odd_documents(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for least, min_docs in [(5, 2), (0, 1)]:
        want = sorted(plain(rows, least, min_docs), key=repr)
        assert found(odd_docs, least=least, min_docs=min_docs, batches=3) == want
    kept = L.dedup_lines(odd_docs)
    assert kept.columns == [*odd_docs.columns, "n_lines", "n_dropped", "kept"]
    assert L.dedup_lines(no_docs).count() == 0


def test_clashing_columns_are_replaced(odd_docs):
    clash = odd_docs.selectExpr("doc_id", "text", "lang AS kept", "lang AS at", "lang AS row", "lang AS lost", "lang AS key")
    out = L.dedup_lines(clash, batches=1)
    assert out.columns == ["doc_id", "text", "at", "row", "lost", "key", "n_lines", "n_dropped", "kept"]
    assert out.where("kept <> text").count() == 0


@pytest.mark.parametrize("batches, fanout, broadcast", [(1, 2, True), (4, 2, False), (5, 3, False)])
def test_any_batches_and_levels_give_the_plain_result(spark, monkeypatch, batches, fanout, broadcast):
    monkeypatch.setattr(L, "is_small", lambda rows: broadcast)
    monkeypatch.setattr("playqos.session.is_small", lambda rows: broadcast)
    rng = random.Random(batches)
    pool = [f"Line Number {i} of the pool" for i in range(12)] + ["été À É", "  nbsp stays  ", "x", ""]
    shown = lambda s: rng.choice([s, s.upper(), f" \t{s}\r", s.lower()])
    rows = [(i, "\n".join(shown(rng.choice(pool)) for _ in range(rng.randrange(6)))) for i in range(60)]
    rows += [(i, "Line Number 1 of the pool") for i in (7, 7, 59, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = sorted(plain(rows, 5, 4), key=repr)
    assert found(docs, least=5, min_docs=4, batches=batches, fanout=fanout) == want


def batch(spark, *rows):
    return spark.createDataFrame([(i, bytes([k])) for i, k in rows], "at long, key binary")


def test_a_store_is_opened_again_and_takes_a_batch_once(spark, tmp_path):
    folder = str(tmp_path / "store")
    store = L.Runs(spark, folder, buckets=4, fanout=2)
    first = store.add(batch(spark, (1, 1), (1, 2), (2, 2)), "a")
    assert sorted((bytes(r.key)[0], r.holder) for r in first.collect()) == [(1, 1), (2, 2)]
    store.close()
    again = L.Runs(spark, folder, fanout=2)
    assert again.buckets == 4 and again.add(batch(spark, (1, 1)), "a") is None
    new = again.add(batch(spark, (5, 2), (5, 3)), "b")
    assert [(bytes(r.key)[0], r.holder) for r in new.collect()] == [(3, 5)]
    assert [len(level) for level in again.levels] == [0, 1]
    assert sorted((bytes(r.key)[0], r.n, r.holder) for r in again.totals().collect()) == [(1, 1, 1), (2, 3, 5), (3, 1, 5)]
    assert again.add(batch(spark, (6, 3), (6, 4)), "c").count() == 1
    again.close()


def test_earlier_runs_do_not_move(spark, tmp_path):
    """Joining a batch's run with the store, and merging two runs, has no exchange."""
    store = L.Runs(spark, str(tmp_path / "store"), buckets=4, fanout=9)
    for name in "ab":
        store.add(batch(spark, (1, ord(name)), (2, 7)), name)
    for frame in (store.new_in(store.runs()[1]), store.totals()):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    store.close()
