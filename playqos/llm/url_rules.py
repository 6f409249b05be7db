"""URL filter: rules found by their rarest literal token.

A rule is a host and path, or a pattern, with literal tokens. Each URL is cut into tokens, the tokens fetch the rules filed
under them, and only the fetched rules run their regular expression. A host rule needs all its tokens and is filed
under whichever is rarest in the URLs at hand, so few URLs fetch it; a pattern needs one of its tokens, which is
checked against its expression, and is filed under each. DataFrame functions only.

Defined results: a null URL, or one without `://`, has an empty host and path; it meets no rule and no
pattern and is allowed. Of several fitting rules the longest wins, then a blocking one, then the smaller
string. Repeated rows and pages that share an id are judged one by one. An empty table gives no rows.
Columns other than the id and the URL are not carried.
"""

from __future__ import annotations

import re
import re._parser as sre
from collections.abc import Iterable
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest number of rules: the rule table is sent to every task.
MAX_RULES = 100_000


class Rule(NamedTuple):
    """`text` is host + path, as in `example.com/en/`; it fits the host and its subdomains."""

    text: str
    verdict: str


#: The host and path rules of the production filter.
HOST_RULES = [
    Rule("com/", "allow"),
    Rule("example.com/en/", "block"),
    Rule("www.example.com/en/", "allow"),
    Rule("net/es/", "block"),
    Rule("net/fr/", "block"),
]

#: Patterns on host + path, for URLs that no host rule fits: (name, literal tokens of which one must occur, regular expression).
PATTERNS = [
    ("betting", ["bet", "bets"], r"(^|[.-])bets?[.-]"),
    ("casino", ["casino"], r"(^|[.-])casino[.-]"),
    ("pills", ["pills"], r"(^|[.-])pills[.-]"),
    ("adult", ["adult"], r"(^|[.-])adult[.-]"),
    ("tracker", ["track"], r"(^|[.-])ads?-track[.-]"),
    ("login page", ["login"], r"/login([/.]|$)"),
    ("tracking pixel", ["pixel"], r"/pixel\.gif$"),
]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(address: Column) -> Column:
    """Distinct lower-case ASCII tokens of host + path, and the empty one, under which rules without a token are filed."""
    parts = F.split(F.lower(address), r"[^a-z0-9]+")
    return F.array_distinct(F.concat(parts, F.array(F.lit(""))))


def _literal_tokens(rule: Rule) -> list[str]:
    """Tokens that every fitting URL must have whole: a path that ends inside a token may go on."""
    tokens = re.split(r"[^a-z0-9]+", rule.text.lower())
    ends_inside = "/" in rule.text and re.search(r"[A-Za-z0-9]$", rule.text)
    return [t for t in (tokens[:-1] if ends_inside else tokens) if t]


def compiled(rules: Iterable[Rule]) -> list[tuple]:
    """(kind, rule, verdict, length, tokens, pattern) of host and path rules. `kind` 0 goes before 1."""
    made = []
    for rule in rules:
        host, slash, path = rule.text.partition("/")
        pattern = rf"(?s)^(?:[^/]*\.)?{re.escape(host.lower())}(?=/|$){re.escape(slash + path)}"
        made.append((0, rule.text, rule.verdict, len(rule.text), _literal_tokens(rule) or [""], pattern))
    return made


def _texts_of(parsed: Iterable) -> list[str]:
    """All texts an expression of few of them can fit, with NUL for a bound; the surroundings are unknown."""
    found = [""]
    for kind, value in parsed:
        if kind is sre.LITERAL:
            some = [chr(value)]
        elif kind is sre.AT and value in (sre.AT_BEGINNING, sre.AT_END):
            some = ["\0"]
        elif kind is sre.IN and all(k is sre.LITERAL for k, _ in value):
            some = [chr(v) for _, v in value]
        elif kind is sre.BRANCH:
            some = [t for branch in value[1] for t in _texts_of(branch)]
        elif kind is sre.SUBPATTERN and not value[1] and not value[2]:
            some = _texts_of(value[3])
        elif kind is sre.MAX_REPEAT and value[1] is not sre.MAXREPEAT and value[1] <= 4:
            once = _texts_of(value[2])
            some = ["".join(c) for n in range(value[0], value[1] + 1) for c in product(once, repeat=n)]
        else:
            raise ValueError(f"{kind} in a pattern with tokens: they cannot be checked; give none")
        found = [a + b for a in found for b in some]
        if len(found) > 10_000:
            raise ValueError("a pattern of too many texts for its tokens to be checked; give none")
    return found


def patterns(rows: Iterable[tuple[str, list[str], str]], verdict: str = "block") -> list[tuple]:
    rows = list(rows)
    for name, tokens, pattern in rows:
        for text in _texts_of(sre.parse(pattern)) if tokens else []:
            if not set(re.findall(r"(?<=[^a-z0-9])[a-z0-9]+(?=[^a-z0-9])", text.lower())) & set(tokens):
                raise ValueError(f"pattern {name} fits {text!r}, which has none of its tokens whole")
    return [(1, name, verdict, 0, tokens or [""], pattern) for name, tokens, pattern in rows]


def rule_index(addresses: DataFrame, rules: list[tuple]) -> DataFrame:
    """Patterns under each of their tokens, host rules under the one that the fewest addresses have (`addresses`: one
    row each, `tokens`)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} can be sent to every task")
    schema = "kind int, rule string, verdict string, length int, tokens array<string>, pattern string"
    table = addresses.sparkSession.createDataFrame(rules, schema)
    filed = table.withColumn("token", F.explode("tokens")).drop("tokens")
    wanted = F.broadcast(filed.select("token").distinct())
    seen = addresses.select(F.explode("tokens").alias("token")).join(wanted, "token").groupBy("token").count()
    counted = filed.join(seen, "token", "left").withColumn("n", F.coalesce("count", F.lit(0)))
    best = F.min_by(F.struct("verdict", "length", "pattern", "token"), F.struct("n", "token")).alias("best")
    any_of = F.when(F.col("kind") == 1, F.col("token"))
    return counted.groupBy("kind", "rule", any_of.alias("own")).agg(best).select("kind", "rule", "best.*")


def judge(pages: DataFrame, rules: list[tuple], key: str = "page_id", url: str = "url") -> DataFrame:
    """Every page with `host, path, rule, verdict, pattern`: `rule` is the winning host rule, `pattern` the
    pattern that decided where no rule fits."""
    # One page may come twice: pages are judged by address, of which each row has one.
    named = pages.select(F.col(key).alias(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    address = F.concat("host", "path")
    addresses = named.select("host", "path", tokens_of(address).alias("tokens")).where(F.col("host") != "")
    index = F.broadcast(rule_index(addresses, rules))
    fetched = addresses.select("host", "path", F.explode("tokens").alias("token")).join(index, "token")
    fitting = fetched.where(F.expr("concat(host, path) RLIKE pattern"))
    order = F.struct("kind", -F.col("length"), F.when(F.col("verdict") == "block", 0).otherwise(1), "rule")
    won = fitting.groupBy("host", "path").agg(F.min_by(F.struct("kind", "rule", "verdict"), order).alias("won"))
    by_rule = F.col("won.kind") == 0
    return named.join(won, ["host", "path"], "left").select(
        key,
        "host",
        "path",
        F.when(by_rule, F.col("won.rule")).alias("rule"),
        F.coalesce("won.verdict", F.lit("allow")).alias("verdict"),
        F.when(~by_rule, F.col("won.rule")).alias("pattern"),
    )
