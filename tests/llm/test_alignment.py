"""Alignment of two tokenizers against a plain version over the libraries themselves."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from playqos.llm import alignment as L


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    path_a, path_b = L.default_vocabularies()
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=path_b)


def tokens(libraries, text):
    a, b = libraries
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(x): x for x in plain}
    byte_of |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
    one = a.encode(" " + text, add_special_tokens=False)
    two = b.encode(text)
    pieces = [b.id_to_piece(i) for i in two]
    return (
        [(i, bytes(byte_of[c] for c in t)) for i, t in zip(one.ids, one.tokens, strict=True)],
        [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(two, pieces, strict=True)],
    )


def plain(libraries, rows):
    made = []
    for doc_id, text in rows:
        a, b = tokens(libraries, text) if text else ([], [])
        joined = (" " + text).encode() if text else b""
        if not text or b"".join(t for _, t in a) != joined or b"".join(t for _, t in b) != joined:
            made.append((doc_id, [], [], [], []))
            continue
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, t in side:
                out.append((at, at + len(t), i))
                at += len(t)
            spans.append(out)
        a, b = spans
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in a} & {y[1] for y in b})
        groups, before = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if s >= before and e <= cut) for side in (a, b)))
            before = cut
        made.append((doc_id, a, b, groups, links))
    count = Counter(pair for *_, links in made for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return sorted(
        (
            (
                i, len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
                sum(count[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
            )
            for i, a, b, groups, links in made
        ),
        key=repr,
    )


def found(docs, **options):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, L.align(docs, **options).select(*names).collect()), key=repr)


def test_as_the_libraries_have_it(spark, libraries):
    rng = random.Random(3)
    parts = ["the", " the", "Straße", "\n\n", "  ", "\t", "👍🏽", "é", "é", "▁", "<|endoftext|>", "<s>", "12345", "don't",
             "\x00", " ", "　", "一二三", "<0x41>", "﻿", "…", "\r\n", "Ünïcode", "\U0010ffff"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(12)))) for i in range(150)]
    rows += [(7, "the the the the"), (None, None), (None, "the end"), (8, " "), (9, "▁ of this"), (10, "x" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain(libraries, rows)
    assert found(docs) == want
    assert found(docs, chunk_bytes=1) == want  # a chunk for each document


def test_odd_and_empty_tables(odd_docs, no_docs, libraries):
    short = odd_docs.where("coalesce(length(text), 0) < 1000")
    assert found(short) == plain(libraries, [(r.doc_id, r.text) for r in short.collect()])
    whole = found(odd_docs)
    assert len(whole) == odd_docs.count() and [r[0] for r in whole if r[1] > 10_000] == [7, 8]
    assert found(no_docs) == []


def test_every_kind_of_letter_is_cut_alike(libraries):
    """The first side's tokenizer works on ranks; the library on merges. All of the basic plane in three surroundings."""
    side = L._byte_level(L.default_vocabularies()[0])
    letters = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f" a{c}b {c}{c} 1{c}'{c}s" for c in letters[i : i + 64]) for i in range(0, len(letters), 64)]
    want = libraries[0].encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert side.encode(texts) == [w.ids for w in want]


def test_packed_numbers_come_back():
    import pyarrow as pa

    for top in (3, 300, 70_000):
        values, begins = np.array([0, top, 1, 2]), np.array([0, 1, 1, 4])
        packed, width = L._packed(values, begins)
        back, at = L._unpacked(pa.chunked_array([packed]), width)
        assert back.tolist() == values.tolist() and at.tolist() == begins.tolist()
