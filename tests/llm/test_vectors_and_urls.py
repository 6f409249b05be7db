import math
import re

import numpy as np
import pytest

from playqos.llm import neighbours, url_rules
from playqos.llm.common import table


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(0, 100, 2)]  # very many equal ones
    rows += [(1, [0.0, 1.0, 0.0]), (3, [2.0, 0.0, 1.0]), (5, [0.0, 0.0, 0.0]), (7, None), (9, [nan, 1.0, 0.0])]
    rows += [(11, [inf, 1.0, 0.0]), (13, [None, 1.0, 0.0]), (15, [1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (1, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 4, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score string")
    got = [tuple(r) for r in neighbours.nearest(df, every=50, k=5).orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in got if r[0] == 0] == [(0, k + 1, v) for k, v in enumerate([2, 3, 4, 6, 8])]
    assert [r[2] for r in got if r[0] == 50] == [0, 2, 3, 4, 6]
    assert all(math.isclose(r[3], 1.0) for r in got)
    assert neighbours.nearest(df.limit(0)).count() == 0
    lonely = df.where("vec_id in (0, 1)")
    assert [tuple(r) for r in neighbours.nearest(lonely, every=50).collect()] == [(0, 1, 1, 0.0)]


def test_recall_against_brute_force(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    rows = df.orderBy("vec_id").toPandas()
    x = np.array(rows["embedding"].tolist(), float)
    ids, unit = rows["vec_id"].to_numpy(), x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in neighbours.nearest(df, every=10).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    found = 0
    asked = np.flatnonzero(ids % 10 == 0)
    for i in asked:
        near = unit @ unit[i]
        near[i] = -2
        found += len(got[ids[i]].keys() & set(ids[np.argsort(-near)[:5]].tolist()))
        for v, score in got[ids[i]].items():
            assert score == pytest.approx(near[np.searchsorted(ids, v)], abs=1e-12)
    assert found / (5 * len(asked)) >= 0.9


@pytest.mark.parametrize("passes", [2048, 3])
def test_clusters_and_outliers_have_whole_results(spark, monkeypatch, passes):
    """Four tight clusters and 2 % outliers: every query gets five rows, those of the outliers the true ones."""
    monkeypatch.setattr(neighbours, "EXACT_QUERIES", passes)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(4, 64))
    x = np.repeat(centres, 490, axis=0) + 0.02 * rng.normal(size=(1960, 64))
    x = np.concatenate((x, rng.normal(size=(40, 64))))[rng.permutation(2000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, every=5).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(range(0, 2000, 5)) and all(len(v) == 5 for v in got.values())
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T
    np.fill_diagonal(near, -2)
    true = np.argsort(-near, axis=1)[:, :5]
    assert np.mean([len(set(v) & set(true[i].tolist())) for i, v in got.items()]) / 5 >= 0.9


def test_ties_go_to_the_smaller_id(spark):
    """Forty vectors of one direction, each another multiple by a power of two."""
    base = np.array([0.3, -1.5, 2.25, 0.75])
    rows = [(i, (base * 2.0 ** (i % 40 - 20)).tolist()) for i in range(100, 140)] + [(50, [1.0, -1.5, 2.25, 0.75]), (7, [-1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows[::-1], "vec_id long, embedding array<double>")
    got = [r.vec_id for r in neighbours.nearest(df, every=50).where("query_id = 50").orderBy("rank").collect()]
    assert got == [100, 101, 102, 103, 104]


URLS = [
    "https://EXAMPLE.com/en/1", "http://www.example.com/en/", "http://a.www.example.com/en/x?y", "https://x.net/es/",
    "https://net/fr/", "http://example.com", "http://example.com/EN/", "http://badexample.com/en/", "no scheme", "", None,
    "ftp://h.org?a=/en/", "http://free-bets.example.org/x", "http://free-bets.example.com/x", "http://a.org/login/",
    "http://a://b.net/es/", "http://a.org/x\n/login", "https://x.net/es", "https://x.net/es/", "http://x.com:80/",
]


def judged(url):
    """The contract in plain Python."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for text, verdict in url_rules.HOST_RULES:
        rule_host, slash, rule_path = text.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rule_path):
            fits.append((len(text), text, verdict))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    bad = host and any(re.search(p, host + path) for _, _, p in url_rules.PATTERNS)
    return host, path, None, "block" if bad else "allow"


def test_url_rules(spark):
    rules = [*url_rules.compiled(url_rules.HOST_RULES), *url_rules.patterns(url_rules.PATTERNS)]
    rows = [*enumerate(URLS), (0, URLS[0]), (None, URLS[3])]
    df = spark.createDataFrame([(i, u, "<p>", "x") for i, u in rows], "page_id long, url string, html string, host string")
    got = sorted((tuple(r) for r in url_rules.judge(df, rules).drop("pattern").collect()), key=str)
    assert got == sorted([(i, *judged(u)) for i, u in rows], key=str)
    assert url_rules.judge(df.limit(0), rules).count() == 0


def test_rules_are_filed_under_whole_tokens_only():
    assert url_rules._literal_tokens(url_rules.Rule("example.com/en", "block")) == ["example", "com"]
    assert url_rules._literal_tokens(url_rules.Rule("com", "block")) == ["com"]


def test_patterns_are_filed_under_every_alternative_token(spark):
    rules = [*url_rules.compiled(url_rules.HOST_RULES), *url_rules.patterns(url_rules.PATTERNS)]
    urls = ["http://bet.example.org/x", "http://my-bet.example.net/x", "http://a-bets.bet.org/", "http://bets.org/", "http://alphabet.org/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = sorted((tuple(r) for r in url_rules.judge(df, rules).drop("pattern").collect()), key=str)
    assert got == [(i, *judged(u)) for i, u in enumerate(urls)]
    assert [r[4] for r in got] == ["block"] * 4 + ["allow"]


@pytest.mark.parametrize("tokens, pattern", [(["bets"], r"(^|[.-])bets?[.-]"), (["bet"], r"bet[.-]"), (["a"], r"\.a.*\.")])
def test_tokens_that_a_pattern_does_not_need_are_refused(tokens, pattern):
    with pytest.raises(ValueError):
        url_rules.patterns([("x", tokens, pattern)])
