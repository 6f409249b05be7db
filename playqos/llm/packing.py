"""Token ids packed into rows of one length, as binary matrices.

Texts are encoded, and documents longer than a row are cut into whole rows and a rest, without loss. Pieces are packed by
best fit decreasing: the longest piece first, each into the fullest row that still has room, found with a
segment tree over the rooms that rows have left. Packing works on groups of at most about `GROUP` tokens as they come
from a task's input, so it holds a bounded number of tokens, needs no shuffle, and a lost task packs the same rows again.

Each row has its ids as little-endian unsigned 16-bit integers (`ids`, padded with `pad`), the positions that start again
at 0 with every segment (`positions`, alike), the cumulative lengths of its segments (`ends`, from 0), and
of each segment the document (`doc_ids`) and where in the document's ids it begins (`starts`).

Defined results: a null or empty text has no ids and is in no row. A null id stays null in `doc_ids`. Repeated rows are
packed as often as they come. Which documents share a row follows the order and the splits of the input files. An empty
table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from playqos.llm.common import per_process, slices, texts_of

ROW = 2048
#: Tokens of a group, and the longest text (in code points) that is encoded in one go.
GROUP, WHOLE = 4_000_000, 200_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Byte-level BPE of a rank file. Texts are encoded whole; very long ones word by word, as the library's own search
    for words gives up on endless white space."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError(f"{path}: ids need more than 16 bits")
        self.pad = max(ranks.values()) + 1
        self.find_words = regex.compile(public_tokenizers.PATTERN).findall
        self.one = tiktoken.Encoding(
            "given", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self._ids(text), "<u2") for text in texts]

    def _ids(self, text: str) -> list[int]:
        if len(text) <= WHOLE:
            return self.one(text)
        return [i for word in self.find_words(text) for i in self.one(word)]


class Rooms:
    """How many open rows have each room left; the smallest room of at least a size in logarithmic time."""

    def __init__(self, most: int):
        self.base = 1 << most.bit_length()
        self.tree = [0] * (2 * self.base)

    def add(self, room: int, n: int) -> None:
        node = room + self.base
        while node:
            self.tree[node] += n
            node >>= 1

    def best(self, size: int) -> int:
        """The smallest room >= size that a row has, or -1."""
        node, tree = size + self.base, self.tree
        if tree[node]:
            return size
        while node > 1:
            if not node & 1 and tree[node + 1]:
                node += 1
                break
            node >>= 1
        if node <= 1:
            return -1
        while node < self.base:
            node = 2 * node if tree[2 * node] else 2 * node + 1
        return node - self.base


def best_fit_decreasing(sizes: np.ndarray, row: int) -> list[list[int]]:
    """Rows as lists of indices of pieces, each of which has at most ``row`` tokens."""
    rooms, open_rows, rows = Rooms(row), [[] for _ in range(row + 1)], []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        if size == row:
            rows.append([i])
            continue
        room = rooms.best(size)
        if room < 0:
            rows.append([i])
            at, room = len(rows) - 1, row
        else:
            at = open_rows[room].pop()
            rooms.add(room, -1)
            rows[at].append(i)
        if room > size:
            open_rows[room - size].append(at)
            rooms.add(room - size, 1)
    return rows


def _packed(documents: list[tuple], row: int, pad: int, shard: int, first: int) -> pa.RecordBatch:
    pieces = [
        (doc_id, start, ids[start : start + row]) for doc_id, ids in documents for start in range(0, len(ids), row)
    ]
    out: dict[str, list] = {k: [] for k in ("ids", "positions", "ends", "doc_ids", "starts")}
    for members in best_fit_decreasing(np.array([len(p[2]) for p in pieces], np.int64), row):
        ids = np.full(row, pad, "<u2")
        positions = np.zeros(row, "<u2")
        ends = [0]
        for m in members:
            end = ends[-1] + len(pieces[m][2])
            ids[ends[-1] : end] = pieces[m][2]
            positions[ends[-1] : end] = np.arange(end - ends[-1])
            ends.append(end)
        out["ids"].append(ids.tobytes())
        out["positions"].append(positions.tobytes())
        out["ends"].append(ends)
        out["doc_ids"].append([pieces[m][0] for m in members])
        out["starts"].append([pieces[m][1] for m in members])
    n = len(out["ids"])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard] * n, pa.int32()),
            pa.array(range(first, first + n), pa.int64()),
            pa.array(out["ids"], pa.binary()),
            pa.array(out["positions"], pa.binary()),
            pa.array(out["ends"], pa.list_(pa.int32())),
            pa.array(out["doc_ids"], pa.list_(pa.int64())),
            pa.array(out["starts"], pa.list_(pa.int64())),
        ],
        ["shard", "row", "ids", "positions", "ends", "doc_ids", "starts"],
    )


def pack(docs: DataFrame, path: str, row: int = ROW, group: int = GROUP) -> DataFrame:
    """(shard, row, ids, positions, ends, doc_ids, starts). A shard is what one task read; rows are numbered in it."""
    if not 0 < row <= 1 << 16:
        raise ValueError("rows have 1 to 65,536 tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("packing", path), lambda: Encoder(path))
        shard, first, held, waiting = TaskContext.get().partitionId(), 0, 0, []
        for batch in slices(batches, 500):
            ids = encoder.encode(texts_of(batch))
            waiting += zip(batch.column("doc_id").to_pylist(), ids, strict=True)
            held += sum(map(len, ids))
            if held >= group:
                made = _packed(waiting, row, encoder.pad, shard, first)
                first, held, waiting = first + made.num_rows, 0, []
                yield from slices([made], 512)
        if held:
            yield from slices([_packed(waiting, row, encoder.pad, shard, first)], 512)

    schema = (
        "shard int, row long, ids binary, positions binary, ends array<int>, doc_ids array<long>, starts array<long>"
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)
