"""The divergence audit against a plain version in Python's own integers."""

import random
import re
from collections import Counter, defaultdict

import pytest

from playqos.llm import divergence as D

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "lang string, source string, text string"


def plain(rows, min_docs=3, top=200):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, terms = lang or "", source or "", TERM.findall((text or "").translate(low))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        in_docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in in_docs[lang].items() if n >= min_docs)
        total = sum((counts[lang, s] for s in sources), Counter())

        def p(counter, kept=kept):
            whole = sum(counter[t] for t in kept) + len(kept)
            return {t: 1 + 1_000_000_000 * (counter[t] + 1) // whole for t in kept}

        ps, of_lang = {s: p(counts[lang, s]) for s in sources}, p(total)
        f = lambda x, q: (x - q) * (x - q) // q
        for s in sources:
            pairs = [(o, sum(f(ps[s][t], ps[o][t]) for t in kept)) for o in sources - {s}]
            terms = [
                (t, f(ps[s][t], of_lang[t])) for t in kept if counts[lang, s][t] and ps[s][t] > of_lang[t]
            ]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items[:limit], 1)]
    return sorted(out)


def found(docs, **options):
    return sorted(map(tuple, D.audit(docs, **options).select("lang", "source", "part", "item", "value", "rank").collect()))


def rows_of(seed, n=150, words=60):
    rng = random.Random(seed)
    pool = [rng.choice("abÀßé一") * rng.randrange(1, 4) + rng.choice("xyzÖ") + str() for _ in range(words)]
    pool += ["Over", "over", "don", "it's", "e2e"]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "en", "de", None, "1:x"]), rng.choice(["s1", "s1", "s1", "s2", "é", None])
        rows.append((lang, source, " ".join(rng.choice(pool) for _ in range(rng.randrange(30)))))
    return [*rows, ("lone", "s", "one two three"), ("en", "empty", None), ("fr", "a", ""), ("fr", "b", "12 ")]


@pytest.mark.parametrize("bits", [64, 3])
def test_as_the_plain_version(spark, bits):
    """With three bits all terms share a digest with others and are told apart by their strings."""
    rows = rows_of(bits)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4), top=7, bits=bits) == plain(rows, top=7)


def test_large_groups_chunk_by_chunk_and_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(D, "CELLS", 8)
    monkeypatch.setattr(D, "HELD", 40)
    monkeypatch.setattr(D, "is_small", lambda rows: False)
    rows = rows_of(5)
    # Python workers take the bounds by value with the functions, so the small ones reach them.
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == plain(rows)


def test_odd_and_empty_tables(odd_docs, no_docs):
    rows = [(r.lang, r.source, r.text) for r in odd_docs.collect()]
    assert found(odd_docs) == plain(rows)
    assert found(odd_docs, min_docs=1, top=3) == plain(rows, 1, 3)
    assert found(no_docs) == []


def test_scaling_is_exact_for_large_counts(spark):
    for n, whole in [(0, 1), (10**13 - 2, 10**13 + 7), (3, 7), (0, 2 * 10**14), (10**14, 2 * 10**14)]:
        import numpy as np

        want = 1 + 1_000_000_000 * (n + 1) // whole
        assert D._scaled_array(np.array([n]), np.array([whole]))[0] == want
        row = spark.range(1).selectExpr(f"{n}L AS n", f"{whole}L AS w")
        assert row.select(D._scaled(row.n, row.w)).first()[0] == want
