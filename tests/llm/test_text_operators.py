"""Every text operator on odd and on empty tables, and against plain versions of itself."""

import hashlib
import re
import sys
import types

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import corpus_pipeline
from playqos.llm import bpe, imatch, language, licences, mixing, packing, quality, simhash
from playqos.llm.common import table


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


# --- op2 ---------------------------------------------------------------------


def test_mix_meets_targets(odd_docs):
    got = mixing.mix(odd_docs).select("doc_id", "source", "mix.*").collect()
    assert len(got) == odd_docs.count()
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r["size"]
        assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.target <= 2 * r.source_size + 1e-9
    for r in got:
        assert taken[r.source] == int(r.target + 0.5)
    order = [s for s in sorted(x for x in sizes if x is not None)] + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    wanted, left, target = 1.5 * sum(sizes.values()), dict(sizes), {}
    while left:  # the contract's own words: stop at the cap, share the excess again
        level = (wanted - sum(target.values())) / sum(weight[s] for s in left)
        full = [s for s in left if weight[s] * level > 2 * sizes[s]]
        for s in full or list(left):
            target[s] = min(2 * sizes[s], weight[s] * level)
            del left[s]
    for r in got:
        assert r.target == pytest.approx(target[r.source])


def test_mix_of_whole_documents(odd_docs, no_docs):
    got = mixing.mix(odd_docs, whole_documents=True).select("mix.*").collect()
    assert all(r.taken % r["size"] == 0 for r in got if r["size"])
    assert mixing.mix(no_docs).count() == 0


def test_positions_invert_the_schedule(spark):
    schedule = [(0.0, 4.0), (0.5, 1.0), (1.0, 3.0)]
    shares = [i / 20 for i in range(21)]
    df = spark.createDataFrame([(s,) for s in shares], "s double")
    for share, t in df.select("s", mixing.position_of(F.col("s"), schedule)).collect():
        area = np.trapezoid([np.interp(x, *zip(*schedule)) for x in np.linspace(0, t, 2001)], np.linspace(0, t, 2001))
        assert area == pytest.approx(share * mixing.integral(schedule), abs=1e-3)


# --- op4 ---------------------------------------------------------------------


def test_bpe_equals_the_library(spark, odd_docs, no_docs, sf_dir):
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    library = Tokenizer.from_file(path)
    docs = odd_docs.unionByName(table(spark, sf_dir, "documents").limit(60), allowMissingColumns=True)
    got = bpe.decode(bpe.encode(docs, path), path)
    assert set(got.columns) == {*docs.columns, "decoded"}  # `ids` is replaced
    for r in got.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(no_docs, path).count() == 0


# --- op5 ---------------------------------------------------------------------


def plain_fingerprint(text):
    import xxhash

    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, bool(words)))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    want = {(i, f"{plain_fingerprint(t):016x}") for i, t in texts(odd_docs)}
    assert {(r.doc_id, r.fingerprint) for r in got} == want and len(got) == odd_docs.count()
    component = {r.doc_id: r.component_id for r in got if r.doc_id != 9}
    assert component[1] == component[2] == 1 and component[4] == component[5] == component[6] == 4
    assert {r.component_id for r in got if r.doc_id is None} == {4, None}
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(key((r.doc_id,)) for r in kept.collect() if r.doc_id in (1, 2, 4, 5, 6)) == [key((1,)), key((4,))]


@pytest.mark.parametrize("block", [4096, 4])
def test_links_equal_brute_force(spark, block):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = {0, (1 << 64) - 1}
    for c in centres.tolist():
        for _ in range(12):
            c ^= int(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)))
            values.add(c)
    values = sorted(values)
    df = spark.createDataFrame([(simhash._signed(v),) for v in values], "fingerprint long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, block=block)).collect()}
    group = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 2:
                x, y = group[i], group[j]
                group = [min(x, y) if g in (x, y) else g for g in group]
    ours = [roots.get(simhash._signed(v), simhash._signed(v)) for v in values]
    for i in range(len(values)):
        for j in range(i):
            assert (ours[i] == ours[j]) == (group[i] == group[j])


def test_bit_planes_find_what_counting_finds():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 12, 1500, dtype=np.uint64)
    for radius in (0, 1, 2, 3):
        got = {p for i, j in simhash.near_in_block(values, radius) for p in zip(i.tolist(), j.tolist())}
        distance = np.bitwise_count(values[:, None] ^ values)
        assert got == {(i, j) for i, j in zip(*np.nonzero(distance <= radius)) if i < j}


def test_one_of_each_equals_brute_force(spark, monkeypatch):
    """Edited copies, repeated ids and missing ids: one row of each component stays, that of the smallest id."""
    rng = np.random.default_rng(11)
    rows = [" ".join(f"w{w}" for w in rng.integers(0, 5000, n)) for n in (3, 4, 5, 6, 80, 400, 900)]
    rows += ["", " ", None, *rows[:6]]
    for text in rows[4:7]:
        for edits in rng.integers(1, 4, 12):
            words = text.split()
            for at in rng.integers(0, len(words), edits):
                words[at] = f"x{rng.integers(0, 1 << 30)}"
            rows.append(" ".join(words))
    ids = [int(i) for i in rng.permutation(len(rows))]
    ids[3] = ids[4] = ids[20] = ids[25]
    ids[1] = ids[12] = ids[30] = ids[33] = None
    prints = [plain_fingerprint(t) for t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 2:
                x, y = group[i], group[j]
                group = [min(x, y) if g in (x, y) else g for g in group]
    order = lambda i: (ids[i] is None, ids[i] or 0, simhash._signed(prints[i]), rows[i] is not None, rows[i] or "", i % 3)
    want = [min((i for i in range(len(rows)) if group[i] == g), key=order) for g in sorted(set(group))]
    docs = [(ids[i], t, i % 3) for i, t in enumerate(rows)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, row int")
    for small in (True, False):
        monkeypatch.setattr(simhash, "is_small", lambda ids, small=small: small)
        got = [tuple(r) for r in simhash.one_of_each(frame).collect()]
        assert sorted(got, key=str) == sorted([docs[i] for i in want], key=str)
    assert 8 < len(want) < len(rows) - 20


def test_blocks_are_abandoned():
    """Tiles off the diagonal without a near pair are left before the last plane; those with one are not."""
    rng = np.random.default_rng(6)
    values = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    values[3000] = values[5] ^ np.uint64(1)
    left: list = []
    pairs = [p for i, j in simhash.near_in_block(values, 2, left) for p in zip(i.tolist(), j.tolist())]
    assert pairs == [(5, 3000)]
    assert len(left) == 5 and all(seen < 64 for _, _, seen in left) and (0, 2048) not in {x[:2] for x in left}


# --- op6, op10 ---------------------------------------------------------------


def test_language(spark, odd_docs, no_docs, sf_dir):
    docs = table(spark, sf_dir.replace("sf0.001", "sf0.01"), "documents")
    model = language.fit(docs)
    got = language.identify(docs, model).join(docs, "doc_id").where("crc32(cast(doc_id as string)) % 4 = 2")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
    odd = {(r.doc_id, r.lang_pred, r.score > 0) for r in language.identify(odd_docs, model).where("doc_id in (4,5,6,10)").collect()}
    assert odd == {(i, "und", False) for i in (4, 5, 6, 10)}
    assert {r.lang_pred for r in language.identify(odd_docs, language.fit(no_docs)).collect()} == {"und"}
    assert language.known_only(odd_docs, model).columns == odd_docs.columns
    assert language.identify(no_docs, model).count() == 0


def test_unknown_languages_are_rejected(spark, sf_dir):
    docs = table(spark, sf_dir.replace("sf0.001", "sf0.1"), "documents").where("doc_id % 3 = 0")
    rng = np.random.default_rng(2)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    junk = [" ".join("".join(rng.choice(letters, rng.integers(2, 10))) for _ in range(200)) for _ in range(50)]
    for left_out in ("en", "fr"):  # the most and one of the least frequent
        model = language.fit(docs.where(F.col("lang") != left_out))
        got = language.identify(docs, model).join(docs.select("doc_id", "lang", "n_chars"), "doc_id")
        got = got.where("crc32(cast(doc_id as string)) % 4 = 2 or lang = '" + left_out + "'").toPandas()
        unknown = got[(got.lang == left_out) & (got.n_chars > 600)]
        assert len(unknown) > 100 and unknown.rejected.mean() > 0.95
        known = got[got.lang != left_out]
        print(left_out, len(unknown), unknown.rejected.sum(), len(known), known.rejected.sum())
        assert known.rejected.mean() < 0.01
        assert model.predict(junk)[2].all()


def test_quality(spark, odd_docs, no_docs, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    found, labels = quality.statistics(table(spark, folder, "documents")), table(spark, folder, "labels")
    model = quality.fit(found, labels)
    got = quality.score(found, model).join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 4 = 2")
    right = got.agg(F.avg(((F.col("score") >= 0.7) == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert right > 0.95
    odd = quality.score(quality.statistics(odd_docs), model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    untrained = quality.fit(found, labels.limit(0))
    assert quality.good_only(odd_docs, untrained).count() == odd_docs.count()
    assert quality.score(quality.statistics(no_docs), model).count() == 0


# --- op7 ---------------------------------------------------------------------


def test_imatch(odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text")
    got = imatch.compare_with_edits(docs, imatch.lexicon(docs)).collect()
    rows = sorted(texts(docs), key=lambda r: key(r) if r[1] is not None else (key(r)[0], (False, "")))
    edited = {}
    for n, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(n + 1) % len(rows)][1] or ""
        half = len(text) // 2
        whole = text[: len(text) - half] + following[:half]
        edited.setdefault(doc_id, []).append(hashlib.sha256(whole.encode()).hexdigest())
    assert len(got) == len(rows)
    for doc_id, want in edited.items():
        assert sorted(want) == sorted(r.edited_sha256 for r in got if r.doc_id == doc_id)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[2].fingerprint and by_id[1].near_next == 1.0
    assert set(by_id[5].fingerprint) == {"0"} and by_id[4].near_next == 1.0 and by_id[6].near_next == 0.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert imatch.compare_with_edits(no_docs, imatch.lexicon(no_docs)).count() == 0
    alone = {(r.doc_id, r.fingerprint) for r in imatch.fingerprints(docs, imatch.lexicon(docs)).collect()}
    assert alone == {(r.doc_id, r.fingerprint) for r in got}


def test_imatch_hashes_as_defined_and_keeps_no_terms():
    """Terms and chains equal a plain version of their definition; no table of the vocabulary grows beside them."""
    rng = np.random.default_rng(7)
    words = [f"w{i}" + ".,;'"[i % 4] * (i % 3) for i in range(900)]
    texts = ["", "- . --", "a A a. (a)", "ΑΣ ΑΣ.Σ İx\x1cé\x85\u3000\u200bz", "x \ud800y", "one"]
    texts += [" ".join(rng.choice(words, n)) for n in (3, 40, 2000)]
    vars(sys.modules.get("_playqos_worker_state", types.ModuleType("none"))).get("made", {}).clear()
    make = imatch.Fingerprinter(np.packbits(rng.random(imatch.SLOTS) < 0.5))
    for text in texts:
        bare = {t.strip(".,;:!?()[]{}\"'|*#$%&-") for t in text.lower().split()} - {""}
        terms = sorted({xxh64_intdigest(t.encode("utf-8", "replace")) for t in bare})
        assert imatch.terms_of(text).tolist() == terms
        kept = [t for t in terms if make.inside[t % imatch.SLOTS]] or terms
        want = [xxh64_intdigest(np.array(kept, np.uint64).tobytes()) | 1] if kept else [0] * (1 + imatch.SEEDS)
        for seed, bits in enumerate(imatch._SEED_BITS.tolist() if kept else []):
            lots = []
            for term in kept:
                lot = (term ^ bits ^ (term ^ bits) >> 31) * 0x9E3779B97F4A7C15 % 2**64
                lots.append((lot ^ lot >> 29) * 0xBF58476D1CE4E5B9 % 2**64 >> 32)
            halvings = 32 - min(lots).bit_length()
            left = [t for t, lot in zip(kept, lots) if lot < 1 << (32 - halvings)]
            want.append(halvings << 16 | xxh64_intdigest(np.array(left, np.uint64).tobytes(), seed) & 0xFFFF)
        assert make.hashes(text).tolist() == want
        assert imatch.hexadecimal(np.array(want, np.uint64)) == f"{want[0]:016x}" + "".join(f"{h:06x}" for h in want[1:])
    assert not vars(sys.modules.get("_playqos_worker_state", types.ModuleType("none"))).get("made")


# --- op8 ---------------------------------------------------------------------


def test_packing_loses_nothing(odd_docs, no_docs):
    path, row = packing.default_vocabulary(), 64
    encoder = packing.Encoder(path)
    want = sorted(encoder.encode([t])[0].tolist() for _, t in texts(odd_docs) if t)
    pieces, whole, docs = [], {}, 0
    for r in packing.pack(odd_docs, path, row).collect():
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(positions) == row and r.ends[0] == 0 and r.ends[-1] <= row
        assert (ids[r.ends[-1] :] == encoder.pad).all()
        for start, end, doc_id, at in zip(r.ends, r.ends[1:], r.doc_ids, r.starts):
            assert positions[start:end].tolist() == list(range(end - start))
            pieces.append((doc_id, at, ids[start:end].tolist()))
    # Pieces that begin a document; the others follow a full one.
    assert sum(len(p) for _, _, p in pieces) == sum(map(len, want))
    assert all(len(p) == row for d, at, p in pieces if any(d2 == d and at2 == at + row for d2, at2, _ in pieces) and d == 7)
    seven = [i for _, _, p in sorted(x for x in pieces if x[0] == 7) for i in p]
    assert seven in want
    assert packing.pack(no_docs, path).count() == 0


def test_packing_encodes_whole_texts_as_their_words(monkeypatch):
    """A text is one call of the library, a very long one a call for each word; the ids are the same."""
    encoder = packing.Encoder(packing.default_vocabulary())
    texts = ["It's  two\n \n words", "", " \t", "é\u0301 👍🏽 12３ \x1c\x85\u3000a", "x" * 5000 + " " * 5000]
    calls, one = [], encoder.one
    monkeypatch.setattr(encoder, "one", lambda text: calls.append(text) or one(text))
    whole = [ids.tolist() for ids in encoder.encode(texts)]
    assert calls == texts and all(len(ids) > 0 for ids, text in zip(whole, texts) if text)
    monkeypatch.setattr(packing, "WHOLE", 0)
    assert [ids.tolist() for ids in encoder.encode(texts)] == whole and len(calls) > 2 * len(texts)


def test_best_fit_decreasing_equals_a_plain_search():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = rng.integers(1, 33, 200)
        rows, left = [], []
        for i in np.argsort(-sizes, kind="stable").tolist():
            fits = [(room, -k) for k, room in enumerate(left) if room >= sizes[i]]
            if fits:
                k = -min(fits, key=lambda f: f[0])[1]
                left[k] -= sizes[i]
                rows[k].append(i)
            else:
                left.append(32 - sizes[i])
                rows.append([i])
        ours = packing.best_fit_decreasing(sizes, 32)
        assert sorted(i for r in ours for i in r) == list(range(200))
        assert all(sizes[r].sum() <= 32 for r in ours) and len(ours) == len(rows)


# --- op9 ---------------------------------------------------------------------


def test_licences(odd_docs, no_docs):
    got = {r.doc_id: r for r in licences.scan(odd_docs).collect()}
    assert licences.scan(odd_docs).count() == odd_docs.count()
    nine = [(r.licence, r.score, r.n_units) for r in licences.scan(odd_docs).where("doc_id = 9").collect()]
    assert sorted(nine, key=str) == sorted([("CC-BY-NC-4.0", 1.0, 1)] * 2 + [(None, 0.0, 0)], key=str)
    assert got[4].licence is None and got[4].score == 0
    assert licences.scan(no_docs).count() == 0


def test_notices_inside_longer_units(spark):
    apache, gpl = licences.TEMPLATES[1][1], licences.TEMPLATES[6][1]
    rows = [
        (1, "This file is part of Foo and was written by its authors. Licensed under the Apache License, Version 2.0."),
        (2, "word " * 400 + "licensed under the apache license version 2.0 " + "word " * 400),
        (3, "Foo\n" + apache.replace(". ", ".\n").replace("compliance", "full compliance") + "\nmore of Foo here"),
        (4, "Apache License notes: the version of the license was not named here, under the tree."),
        (5, "License, Version 2.0. is the end of a notice that was cut"),
        (6, ("intro " + gpl + " ") * 30),
        (7, "under the Apache License, Version 2.0"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.licence, r.n_units) for r in licences.scan(docs).collect()}
    assert got == {1: ("Apache-2.0", 1), 2: ("Apache-2.0", 1), 3: ("Apache-2.0", got[3][1]), 4: (None, 0), 5: (None, 0),
                   6: ("GPL-3.0", got[6][1]), 7: ("Apache-2.0", 1)}
    assert got[6][1] >= 30
    with_anchor = {r.doc_id for r in licences.possible(docs, licences.TEMPLATES, licences.THRESHOLD).collect()}
    assert {1, 2, 3, 6, 7} <= with_anchor


def test_anchors_cannot_all_be_missing():
    """Without the anchors, no template keeps as many bigrams as the threshold asks for."""
    words = set(licences.anchors(licences.TEMPLATES))
    for _, text in licences.TEMPLATES:
        pairs = licences.bigrams_of(licences.words_of(text))
        left = sum(n for pair, n in pairs.items() if not words & set(pair.split(" ")))
        assert left < pairs.total() * licences.THRESHOLD / (2 - licences.THRESHOLD)


# --- the pipeline --------------------------------------------------------------


def test_pipeline_against_its_parts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns
        ids = {r.doc_id for r in after.collect()}
        assert ids and ids <= kept
        docs, kept = after, ids
    prints = {}
    for i, t in texts(docs):
        f = plain_fingerprint(t)
        assert all((f ^ g).bit_count() > 2 for g in prints)
        prints[f] = i
    mixed = corpus_pipeline.mixed_sources(spark, docs, sf_dir)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.select("doc_id").collect()} <= kept
    last = corpus_pipeline.token_ids(spark, mixed, sf_dir)
    assert last.where("octet_length(ids) <> 4 * n_tokens").count() == 0 and last.count() == mixed.count()


def test_pipeline_on_odd_and_empty_tables(odd_docs, no_docs, spark, sf_dir):
    """Columns that clash with names the stages use stay what they are."""
    for docs, some in ((odd_docs.withColumn("due", F.lit(1)), True), (no_docs, False)):
        for _, stage in corpus_pipeline.STAGES[:4]:
            after = stage(spark, docs, sf_dir)
            assert after.columns == docs.columns
        rows = {tuple(r) for r in docs.collect()}
        kept = corpus_pipeline.mixed_sources(spark, corpus_pipeline.no_near_copies(spark, docs, sf_dir), sf_dir).collect()
        assert bool(kept) == some and {tuple(r) for r in kept} <= rows
        assert corpus_pipeline.token_ids(spark, docs, sf_dir).count() == len(docs.collect())
