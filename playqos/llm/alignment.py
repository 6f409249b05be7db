"""Alignment of two tokenizers over the same bytes, in Arrow columns.

A text's tokens of both vocabularies are flattened to columns with the index of their document, their byte lengths
summed up document by document, and the two columns of ends joined on (document, end) by Acero's hash join. Ends of
both close a group; between two successive ends of either exactly one token of each side lies, so the rows of the full join
in order, each null filled from below, are the links: pairs of tokens whose bytes overlap. `Table.group_by` counts them by
document and pair, and by pair for a chunk of documents; Spark adds the chunks up.

Each chunk (`CHUNK_BYTES` of text, or one longer document) keeps its documents' links as numbers into its own list of
pairs. Only that list, with counts, is shuffled by pair; what the corpus says about it comes back by chunk, where
it meets the documents. So a pair that every document has is one row of each chunk, no table of pairs is sent
to all tasks, and texts and tokens are never shuffled.

The first vocabulary is a file of the tokenizers library with byte-level BPE, the second one of sentencepiece; texts get
a space in front (sentencepiece adds its own). Strings of special tokens are plain text.

Defined results: a null or empty text, and one whose tokens do not spell its bytes on either side, has no tokens:
zeros and an empty digest. Rows are judged one by one, whatever their id. An empty table gives no rows. Other
columns are not carried.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playqos.llm.common import per_process, stored, texts_of

CHUNK_BYTES = 3 << 20
#: Bits of an end inside its document, in a (document, end) key.
END_BITS = 40


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Side:
    """A tokenizer: ids of texts, and the bytes of every id."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], tokens: list[bytes]):
        self.encode, self.size = encode, len(tokens)
        self.tokens = pa.array(tokens, pa.large_binary())
        self.lengths = pa.array([len(t) for t in tokens], pa.int64())


def _byte_level(path: str) -> Side:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, kind = spec["model"], spec["pre_tokenizer"]["type"]
    if spec["normalizer"] or kind != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or model["type"] != "BPE":
        raise ValueError(f"{path}: settings of this kind are not supported")
    # Printable bytes of Latin-1 stand for themselves, the others for the letters from 256 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {t["id"] for t in spec["added_tokens"]}
    known = {i: bytes(byte_of[c] for c in token) for token, i in model["vocab"].items() if i not in special}
    tokens = [known.get(i, b"") for i in range(max([*known, *special]) + 1)]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in pairs]
    if made == list(range(256, 256 + len(made))) and set(known) == set(range(256 + len(made))):
        # Ids in the order of the merges: the same merges, told as ranks, several times as fast.
        import public_tokenizers
        import tiktoken

        ranks = {t: i for i, t in known.items()}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Side(lambda texts: [fast.encode_ordinary(" " + t) for t in texts], tokens)
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    slow.no_truncation()
    slow.no_padding()
    slow.encode_special_tokens = True
    return Side(
        lambda texts: [e.ids for e in slow.encode_batch([" " + t for t in texts], add_special_tokens=False)], tokens
    )


def _pieces(path: str) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def spelled(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return Side(lambda texts: model.encode(texts, num_threads=1), [spelled(i) for i in range(model.get_piece_size())])


def sides(paths: tuple[str, str]) -> tuple[Side, Side]:
    return per_process(("alignment", paths), lambda: (_byte_level(paths[0]), _pieces(paths[1])))


def _bounds(lengths: pa.Array) -> np.ndarray:
    """Where each list begins among the flat values, and the end."""
    return np.concatenate(([0], np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)))


def _spells(side: Side, ids: pa.Array, want: list[bytes]) -> np.ndarray:
    """Which lists of ids are, token by token, the wanted bytes."""
    flat = pc.list_flatten(ids)
    offsets = np.concatenate(([0], np.cumsum(side.lengths.take(flat).to_numpy(), dtype=np.int64)))
    at = offsets[_bounds(pc.list_value_length(ids))]
    joined = side.tokens.take(flat).buffers()[2]
    data = joined.to_pybytes() if joined else b""
    ends = zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
    return np.array([j - i == len(w) and data[i:j] == w for w, (i, j) in zip(want, ends, strict=True)], bool)


def _ends(side: Side, ids: pa.Array, name: str) -> pa.Table:
    """(end: document and end of each token in it, id), by a cumulative sum that begins anew in each document."""
    flat, parent = pc.list_flatten(ids), pc.cast(pc.list_parent_indices(ids), pa.int64())
    total = pc.cumulative_sum(side.lengths.take(flat))
    sums = np.concatenate(([0], total.to_numpy()))
    base = pa.array(sums[_bounds(pc.list_value_length(ids))[:-1]]).take(parent)
    key = pc.add(pc.shift_left(parent, pa.scalar(END_BITS, pa.int64())), pc.subtract(total, base))
    return pa.table({"end": key, name: flat})


class Aligned:
    """The links and groups of a chunk of documents that all have tokens of both sides."""

    def __init__(self, a: Side, b: Side, ids_a: pa.Array, ids_b: pa.Array):
        self.n = len(ids_a)
        self.n_a, self.n_b = (pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in (ids_a, ids_b))
        joined = _ends(a, ids_a, "a").join(_ends(b, ids_b, "b"), "end", join_type="full outer", use_threads=False)
        joined = joined.sort_by("end").combine_chunks()
        self.end, in_a, in_b = (joined[c].combine_chunks() for c in ("end", "a", "b"))
        self.doc = self.end.to_numpy() >> END_BITS
        self.ends_a, self.ends_b = (pc.is_valid(x).to_numpy(zero_copy_only=False) for x in (in_a, in_b))
        self.a, self.b = (pc.fill_null_backward(x).to_numpy() for x in (in_a, in_b))
        self.shared = self.ends_a & self.ends_b
        self.n_links = np.bincount(self.doc, minlength=self.n)
        self.n_groups = np.bincount(self.doc[self.shared], minlength=self.n)
        self.pair = self.a.astype(np.int64) * b.size + self.b
        self.names = per_process(("alignment names", max(a.size, b.size)), lambda: _names(max(a.size, b.size)))

    def group_texts(self) -> Iterator[memoryview]:
        """`a1,a2|b1;a3|b2,b3` of each document, in bytes: each token is written with what follows it."""
        group = np.cumsum(self.shared) - self.shared
        of_a, of_b = np.flatnonzero(self.ends_a), np.flatnonzero(self.ends_b)
        groups = int(self.shared.sum())
        a_to, b_to = (np.cumsum(np.bincount(group[x], minlength=groups)) for x in (of_a, of_b))
        order = np.empty(len(of_a) + len(of_b), np.int64)
        kinds = len(self.names) // 3
        order[np.arange(len(of_a)) + np.concatenate(([0], b_to[:-1]))[group[of_a]]] = (
            self.a[of_a] + np.where(self.shared[of_a], kinds, 0)
        )
        order[np.arange(len(of_b)) + a_to[group[of_b]]] = self.b[of_b] + np.where(self.shared[of_b], 2 * kinds, 0)
        written = self.names.take(pa.array(order))
        offsets = np.frombuffer(written.buffers()[1], np.int64, len(written) + 1)
        at = offsets[np.concatenate(([0], np.cumsum(self.n_a + self.n_b, dtype=np.int64)))].tolist()
        data = memoryview(written.buffers()[2])
        return (data[i : j - 1] for i, j in zip(at[:-1], at[1:], strict=True))

    def counted(self, pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each document's distinct pairs as numbers into the chunk's list, how often each, where each document begins;
        the chunk's list of pairs, the most frequent first, and in how many documents each is."""
        links = pa.table({"at": self.doc * pairs + self.pair})
        each = links.group_by("at", use_threads=False).aggregate([([], "count_all")]).sort_by("at")
        at, times = each["at"].to_numpy(), each["count_all"].to_numpy()
        doc, pair = at // pairs, at % pairs
        held = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
        held = held.sort_by([("count_all", "descending"), ("pair", "ascending")])
        listed, in_docs = held["pair"].to_numpy(), held["count_all"].to_numpy()
        by_pair = np.argsort(listed)
        code = by_pair[np.searchsorted(listed[by_pair], pair)]
        return code, times, np.searchsorted(doc, np.arange(self.n + 1)), listed, in_docs


def _names(size: int) -> pa.Array:
    return pa.array([f"{i}{end}" for end in ",|;" for i in range(size)], pa.large_string())


def _packed(values: np.ndarray, begins: np.ndarray) -> tuple[pa.Array, int]:
    """One binary value for each document, of the narrowest whole numbers that fit; their width."""
    small = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    offsets = pa.py_buffer((begins * small.itemsize).astype(np.int64))
    made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins) - 1, [None, offsets, pa.py_buffer(small)])
    return made.cast(pa.binary()), small.itemsize


def _unpacked(values: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all values in a row, and where each value's begin."""
    parts = values.to_pylist()
    begins = np.concatenate(([0], np.cumsum([len(p) // width for p in parts])))
    return np.frombuffer(b"".join(parts), f"<u{width}").astype(np.int64), begins


_SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, chunk long, "
    "codes binary, code_width int, times binary, time_width int, pairs binary, in_docs binary"
)


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows in slices of about ``size`` bytes of text."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        sums, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < batch.num_rows:
            before = sums[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sums, before + size, "right")))
            yield batch.slice(start, end - start)
            start = end


def chunk_rows(docs: DataFrame, paths: tuple[str, str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row for each document, and one for each chunk with its list of pairs (`pairs` not null)."""
    names = [part.split()[0] for part in _SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(paths)
        pa.set_cpu_count(1)
        number = TaskContext.get().partitionId() << 32
        for rows in _chunks(batches, chunk_bytes):
            ids, texts = rows.column("doc_id"), texts_of(rows)
            want = [b" " + t.encode("utf-8", "surrogatepass") for t in texts]
            ids_a, ids_b = (pa.array(side.encode(texts), pa.list_(pa.int32())) for side in (a, b))
            sound = np.array([bool(t) for t in texts]) & _spells(a, ids_a, want) & _spells(b, ids_b, want)
            if not sound.all():
                without = ids.filter(pa.array(~sound))
                zeros = [pa.array(np.zeros(len(without), np.int64))] * 4
                yield _row_batch(names, [without, *zeros, pa.array([""] * len(without))])
                ids, ids_a, ids_b = (x.filter(pa.array(sound)) for x in (ids, ids_a, ids_b))
            if not len(ids):
                continue
            found = Aligned(a, b, ids_a, ids_b)
            codes, times, begins, pairs, in_docs = found.counted(a.size * b.size)
            (codes, code_width), (times, time_width) = _packed(codes, begins), _packed(times, begins)
            counts = [pa.array(x.astype(np.int64)) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)]
            digests = pa.array([hashlib.sha256(t).hexdigest() for t in found.group_texts()])
            many = lambda value, kind: pa.array(np.full(len(ids), value), kind)
            packed = [codes, many(code_width, pa.int32()), times, many(time_width, pa.int32())]
            yield _row_batch(names, [ids, *counts, digests, many(number, pa.int64()), *packed])
            lists = [pa.array([x.astype("<i8").tobytes()], pa.binary()) for x in (pairs, in_docs)]
            yield _row_batch(names, [*[None] * 6, pa.array([number]), *[None] * 4, *lists])
            number += 1

    # Nulls must have their types, so the arrays are cast where they are put together.
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _row_batch(names: list[str], columns: list[pa.Array | None]) -> pa.RecordBatch:
    rows = next(len(c) for c in columns if c is not None)
    kinds = [_KINDS[part.split()[1]] for part in _SCHEMA.split(", ")]
    columns = [*columns, *[None] * (len(names) - len(columns))]
    made = [pa.nulls(rows, k) if c is None else c for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(made, names)


def _listed(rows: DataFrame) -> DataFrame:
    """(chunk, code, pair, in_docs): the chunks' lists, a row for each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, in_docs in zip(*[batch.column(c).to_pylist() for c in ("chunk", "pairs", "in_docs")], strict=True):
                pairs, in_docs = np.frombuffer(pairs, "<i8"), np.frombuffer(in_docs, "<i8")
                columns = [np.full(len(pairs), chunk), np.arange(len(pairs), dtype=np.int32), pairs, in_docs]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["chunk", "code", "pair", "in_docs"])

    lists = rows.where(F.col("pairs").isNotNull()).select("chunk", "pairs", "in_docs")
    return lists.mapInArrow(run, "chunk long, code int, pair long, in_docs long")


def pair_counts(listed: DataFrame, size_b: int) -> DataFrame:
    """(pair, count: documents that link it, best: whether no other pair of its first id has more)."""
    counts = stored(listed.groupBy("pair").agg(F.sum("in_docs").alias("count")), "pair-counts")
    first = F.expr(f"pair div {size_b}")
    most = counts.groupBy(first.alias("a")).agg(F.max("count").alias("most"))
    both = counts.withColumn("a", first).join(most, "a")
    return both.select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _looked_up(docs: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of one chunk with what the corpus says about their links."""
    if not docs.num_rows:
        return pa.table({n: pa.array([], _KINDS[k]) for n, k in (part.split() for part in RESULT.split(", "))})
    order = np.argsort(known["code"].to_numpy())
    codes, begins = _unpacked(docs["codes"], docs["code_width"][0].as_py())
    times, _ = _unpacked(docs["times"], docs["time_width"][0].as_py())
    summed = {}
    for name, column in (("n_best", "best"), ("count_sum", "count")):
        summed[name] = pa.array(np.add.reduceat(known[column].to_numpy()[order][codes] * times, begins[:-1]))
    plain = {c: docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table({**plain, **summed, "groups_sha256": docs["groups_sha256"]})


def align(docs: DataFrame, paths: tuple[str, str] | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """How the tokens of two vocabularies line up in each document: tokens, groups, links, the links whose pair is the best
    of its first id by documents, the sum of the links' counts, and the SHA-256 of the groups."""
    paths = paths or default_vocabularies()
    rows = stored(chunk_rows(docs, paths, chunk_bytes), "alignments")
    listed = _listed(rows)
    counts = pair_counts(listed, sides(paths)[1].size)
    known = listed.join(counts, "pair").select("chunk", "code", "count", "best")
    linked = rows.where(F.col("codes").isNotNull())
    own = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    linked = linked.select(*own, "chunk", "codes", "code_width", "times", "time_width")
    found = linked.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(_looked_up, RESULT)
    none = rows.where(F.col("codes").isNull() & F.col("pairs").isNull()).select(*own)
    zero = F.lit(0).cast("long")
    return found.unionByName(none.withColumns({"n_best": zero, "count_sum": zero}).select(*found.columns))
