"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playqos.llm import (
    alignment,
    bpe,
    divergence,
    imatch,
    language,
    licences,
    line_dedup,
    mixing,
    neighbours,
    packing,
    quality,
    simhash,
    url_rules,
)
from playqos.llm.common import held_out, stored, table
from playqos.session import configure


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found of every fiftieth vector."""
    return neighbours.nearest(table(configure(spark), sf_dir, "embeddings"), every=50, k=5)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document the mix takes, and when; in training order."""
    docs = table(configure(spark), sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"))
    mixed = mixing.mix(sized, size=F.col("size"))
    return mixed.select("doc_id", "mix.*").orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every URL, by host rules and patterns."""
    rules = [*url_rules.compiled(url_rules.HOST_RULES), *url_rules.patterns(url_rules.PATTERNS)]
    return url_rules.judge(table(configure(spark), sf_dir, "pages"), rules)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each text's ids and of what they decode to."""
    path = bpe.default_vocabulary()
    docs = table(configure(spark), sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs, path).drop("text"), path)
    return decoded.select(
        "doc_id",
        bpe.count_of(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(configure(spark), sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; a quarter of them is never learned from."""
    docs = table(configure(spark), sf_dir, "documents")
    model = language.fit(docs)
    found = language.identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    docs = table(configure(spark), sf_dir, "documents").select("doc_id", "text")
    return imatch.compare_with_edits(docs, imatch.lexicon(docs))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of token ids."""
    return packing.pack(table(configure(spark), sf_dir, "documents"), packing.default_vocabulary())


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, or none."""
    found = licences.scan(table(configure(spark), sf_dir, "documents"))
    return found.select("doc_id", "licence", "score", "n_units")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a quarter of them is never learned from."""
    configure(spark)
    found = stored(quality.statistics(table(spark, sf_dir, "documents")), "statistics")
    scored = quality.score(found, quality.fit(found, table(spark, sf_dir, "labels")))
    passed = (F.col("score") >= quality.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", passed.alias("predicted"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without lines that five documents share."""
    docs = table(configure(spark), sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", kept)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, from each other and in which terms."""
    return divergence.audit(table(configure(spark), sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies line up in every document."""
    return alignment.align(table(configure(spark), sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py, one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_neighbours,
        op2_mixing,
        op3_url_rules,
        op4_bpe,
        op5_simhash,
        op6_language,
        op7_imatch,
        op8_packing,
        op9_licences,
        op10_quality,
        op11_line_dedup,
        op12_divergence,
        op13_alignment,
        pipeline,
    )
}

_SIZE = r"CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT)"


def _position(share: str) -> str:
    """Inverse of the schedules' integrals. They have one piece each: w0 + (w1 - w0) * t."""
    cases = []
    for i, ((_, w0), (_, w1)) in enumerate(mixing.SCHEDULES):
        whole, slope = (w0 + w1) / 2, w1 - w0
        rest = f"({share} * CAST({whole} AS DOUBLE))"
        root = f"sqrt(greatest(CAST({w0 * w0} AS DOUBLE) + CAST({2 * slope} AS DOUBLE) * {rest}, CAST(0 AS DOUBLE)))"
        spent = f"(CAST(2 AS DOUBLE) * {rest} / (CAST({w0} AS DOUBLE) + {root}))"
        cases.append(f"WHEN {i} THEN least(CASE WHEN {rest} > 0 THEN {spent} ELSE CAST(0 AS DOUBLE) END, CAST(1 AS DOUBLE))")
    return f"CASE kind {' '.join(cases)} END"


_WEIGHTS = ", ".join(f"CAST({mixing.integral(s)} AS DOUBLE)" for s in mixing.SCHEDULES)

_OP2 = f"""
WITH d AS (SELECT doc_id, source, {_SIZE} AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM d GROUP BY source),
w AS (SELECT *, turn % 3 AS kind, ([{_WEIGHTS}])[turn % 3 + 1] AS weight, source_size * CAST(2 AS DOUBLE) AS most,
  CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) AS wanted FROM s),
l AS (SELECT *, most / weight AS full_at, (wanted
    - coalesce(sum(most) OVER (ORDER BY most / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, kind, least(most, coalesce(weight * max(CASE WHEN level <= full_at THEN level END) OVER (), most)) AS target
  FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.kind, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS quota,
  CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS rounds FROM r),
a AS (SELECT *, CAST(rounds * size + greatest(least(quota - rounds * source_size - start, size), 0) AS BIGINT) AS taken FROM k)
SELECT doc_id, size, source_size, target, taken,
  CASE WHEN taken > 0 THEN {_position("(CAST(start AS DOUBLE) / CAST(greatest(quota, 1) AS DOUBLE))")} END AS position,
  CASE WHEN taken > size THEN {_position("(CAST(source_size + start AS DOUBLE) / CAST(greatest(quota, 1) AS DOUBLE))")} END AS position_2
FROM a
"""

_RULES = ", ".join(f"('{r.text}', '{r.verdict}')" for r in url_rules.HOST_RULES)
_PATTERNS = ", ".join(f"('{name}', '{pattern}')" for name, _, pattern in url_rules.PATTERNS)

_OP3 = f"""
WITH p AS (SELECT page_id, url, row_number() OVER () AS n,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules AS (SELECT r AS rule, v AS verdict, split_part(r, '/', 1) AS rule_host, substr(r, strpos(r, '/')) AS rule_path
  FROM (VALUES {_RULES}) AS x(r, v)),
fits AS (SELECT n, rule, verdict, row_number() OVER (PARTITION BY n ORDER BY length(rule) DESC, verdict = 'allow', rule) AS i
  FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
other AS (SELECT n, min(name) AS pattern FROM p JOIN (VALUES {_PATTERNS}) AS x(name, pattern)
  ON host <> '' AND regexp_matches(host || path, x.pattern) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN other.pattern IS NOT NULL THEN 'block' END, 'allow') AS verdict,
  CASE WHEN rule IS NULL THEN other.pattern END AS pattern
FROM p LEFT JOIN fits ON p.n = fits.n AND fits.i = 1 LEFT JOIN other ON p.n = other.n
"""


def _licence_sql() -> str:
    t = licences.THRESHOLD
    rows = ", ".join(
        f"({i}, '{name}', {b}, '{bigram}', {times})"
        for i, name, b, bigram, times in licences.template_table(licences.TEMPLATES)
    )
    places = ", ".join(
        f"({i}, '{name}', {b}, {j}, '{bigram}', {times})"
        for i, name, b, j, bigram, times in licences.place_table(licences.TEMPLATES)
    )
    low, high = t / (2 - t), (2 - t) / t
    words = """string_split(trim(regexp_replace(regexp_replace(regexp_replace(
    translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9.]+', ' ', 'g'), '\\.+( |$)', ' ', 'g'), ' +', ' ', 'g')), ' ')"""
    return f"""
WITH places(template, licence, b, j, bigram, times) AS (VALUES {places}),
templates(template, licence, b, bigram, times) AS (VALUES {rows}),
d AS (SELECT doc_id, text, row_number() OVER () AS n FROM documents),
u AS (SELECT n, 0 AS kind, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS unit_number FROM d
  UNION ALL
  SELECT n, 1, unit, unit_number FROM (SELECT n, unnest(string_split_regex(text, '\\n[ \\t\\r]*\\n')) AS unit,
    generate_subscripts(string_split_regex(text, '\\n[ \\t\\r]*\\n'), 1) - 1 AS unit_number FROM d) WHERE contains(trim(unit, chr(10)), chr(10))),
w AS (SELECT n, kind, unit_number, string_split(trim(regexp_replace(regexp_replace(regexp_replace(
    translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9.]+', ' ', 'g'), '\\.+( |$)', ' ', 'g'), ' +', ' ', 'g')), ' ') AS words FROM u),
g AS (SELECT n, kind, unit_number, len(words) - 1 AS a, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS bigram
  FROM w WHERE len(words) BETWEEN 2 AND 400),
c AS (SELECT n, kind, unit_number, a, template, licence, b, bigram, times, count(*) AS k FROM g JOIN templates USING (bigram)
  WHERE a >= b * CAST({low!r} AS DOUBLE) AND a <= b * CAST({high!r} AS DOUBLE) GROUP BY ALL),
s AS (SELECT n, kind, unit_number, licence, CAST(2 AS DOUBLE) * CAST(sum(least(k, times)) AS DOUBLE) / (a + b) AS score
  FROM c GROUP BY n, kind, unit_number, a, template, licence, b),
x AS (SELECT n, {words.format("text")} AS words FROM d WHERE text IS NOT NULL),
y AS (SELECT n, len(words) - 1 AS a, unnest(range(0, len(words) - 1)) AS i,
    unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS bigram FROM x WHERE len(words) > 1),
h AS (SELECT n, a, i, template, licence, b, j, bigram, times FROM y JOIN places USING (bigram)),
starts AS (SELECT n, a, template, licence, b, i - j AS start FROM h GROUP BY ALL HAVING count(*) >= 2 AND count(*) * 3 >= b),
inside AS (SELECT n, a, template, licence, b, start, bigram, times, count(*) AS k FROM starts
  JOIN (SELECT DISTINCT n, template, i, bigram, times FROM h) USING (n, template) WHERE i >= start AND i < start + b GROUP BY ALL),
v AS (SELECT n, 2 AS kind, start AS unit_number, licence, CAST(2 AS DOUBLE) * CAST(sum(least(k, times)) AS DOUBLE)
    / (least(start + b, a) - greatest(start, 0) + b) AS score FROM inside GROUP BY n, a, template, licence, b, start),
every AS (SELECT * FROM s UNION ALL SELECT * FROM v),
best AS (SELECT n, licence, score, row_number() OVER (PARTITION BY n ORDER BY score DESC, licence) AS i,
    coalesce(nullif(count(DISTINCT CASE WHEN kind < 2 THEN kind * 1000000000 + unit_number END) OVER (PARTITION BY n), 0),
      count(DISTINCT CASE WHEN kind = 2 THEN unit_number END) OVER (PARTITION BY n)) AS n_units FROM every WHERE score >= CAST({t!r} AS DOUBLE))
SELECT doc_id, licence, coalesce(score, CAST(0 AS DOUBLE)) AS score, coalesce(n_units, 0) AS n_units
FROM d LEFT JOIN best ON d.n = best.n AND best.i = 1
"""


_OP11 = """
WITH d AS (SELECT doc_id, row_number() OVER () AS n, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, n, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, coalesce(k.doc_id <> holder, false) AS lost FROM k LEFT JOIN often ON k.key = often.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count_if(lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM j GROUP BY n
"""

_P = "1 + CAST((CAST(1000000000 AS HUGEINT) * ({n} + 1)) // {whole} AS BIGINT)"

_OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 3),
c AS (SELECT lang, source, term, lang_n, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, CAST(sum(lang_n) AS BIGINT) + count(*) AS lang_whole FROM kept GROUP BY lang),
g AS (SELECT x.lang, x.source, coalesce(v, 0) AS v, lang_whole, coalesce(s.n, 0) + coalesce(v, 0) AS whole
  FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN langs ON x.lang = langs.lang
  LEFT JOIN (SELECT lang, source, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY ALL) s ON s.lang = x.lang AND s.source = x.source),
every AS (SELECT g.lang, g.source, kept.term, kept.lang_n, lang_whole, coalesce(c.n, 0) AS n, {_P.format(n="coalesce(c.n, 0)", whole="whole")} AS p
  FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
sums AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM every a JOIN every b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
  FROM (SELECT *, {_P.format(n="lang_n", whole="lang_whole")} AS q FROM every WHERE n > 0) WHERE p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


ORACLES = {"op2_mixing": _OP2, "op3_url_rules": _OP3, "op9_licences": _licence_sql(), "op11_line_dedup": _OP11, "op12_divergence": _OP12}
