"""BPE encoding by speculation: propose tokens greedily, verify every adjacent pair, merge only what fails.

For each distinct word the longest tokens from the left are proposed. A sequence of tokens is what the merges
would give exactly if no merge would have crossed a boundary, which is a property of each adjacent pair:
undo the pair's merges from the latest back, and see whether a merge across the boundary would have come
earlier. All pairs of a batch are tested together in numpy. Words with a failing pair go through the merges.

Vocabularies: files of the tokenizers library with BPE merges, an end-of-word suffix, NFC, white space and
lower-case normalisers, a split by pattern and byte-level letters. Other settings are refused.

Defined results: a null or empty text has no ids and decodes to the empty text. Strings of special tokens in
a text are their special ids. Rows are encoded one by one, so repeated ids, ties and nulls elsewhere
do not matter. All other columns are kept; a column named like a result is replaced.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playqos.llm.common import per_process, slices, texts_of

NEVER = 1 << 40
#: Words of at most so many letters are merged by scanning; longer ones with a heap.
SHORT = 48
#: Stands for the end-of-word suffix where tokens are matched letter by letter; no byte has this letter.
END = "\uffff"
#: Words kept with their ids in each worker process, and the longest word kept.
CACHED_WORDS, CACHED_LENGTH = 400_000, 64


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies. Printable bytes of
    Latin-1 stand for themselves, the others for the letters from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, others = [], 256
    for b in range(256):
        letters.append(chr(b if b in plain else others))
        others += b not in plain
    return letters


class Vocabulary:
    """A vocabulary with its merges, and the tables for testing pairs."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        odd = model["dropout"] or model["unk_token"] or model["continuing_subword_prefix"] or model["byte_fallback"]
        if kinds != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in split] != ["Split", "ByteLevel"] or odd:
            raise ValueError(f"{path}: settings of this kind are not supported")
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.find_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.find_words = regex.compile(split[0]["pattern"]["Regex"]).findall
        self.letters = _byte_letters()
        self.tokens = np.empty(max([*self.ids.values(), *self.special.values()]) + 1, object)
        for token, i in (self.ids | self.special).items():
            self.tokens[i] = token
        self._learn(model["merges"])
        # Every beginning of a usable token: its id, or -1. The suffix is one letter here.
        self.begins: dict[str, int] = {}
        for token, i in self.greedy.items():
            spelled = self._ending(token)
            for end in range(1, len(spelled)):
                self.begins.setdefault(spelled[:end], -1)
            self.begins[spelled] = i

    def _ending(self, token: str) -> str:
        return token.removesuffix(self.suffix) + END if self.suffix and token.endswith(self.suffix) else token

    def _learn(self, merges: list) -> None:
        n = len(self.tokens)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        left, right = (np.array([self.ids[p[k]] for p in pairs], np.int64) for k in (0, 1))
        made = np.array([self.ids[a + b] for a, b in pairs], np.int64)
        self.rank_of = {(a, b): r for r, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True))}
        self.made = made.tolist()
        order = np.argsort(left * n + right, kind="stable")
        self.codes, self.code_ranks = (left * n + right)[order], order.astype(np.int64)
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        self.rank[made[::-1]] = np.arange(len(made))[::-1]  # the first merge that makes a token counts
        self.left[made[::-1]], self.right[made[::-1]] = left[::-1], right[::-1]
        # A token is usable if the merges turn its own letters into it.
        sound = self.separate(left, right, np.arange(len(made)))
        whole = np.ones(n, bool)
        for r, (a, b, t, ok) in enumerate(zip(left.tolist(), right.tolist(), self.made, sound.tolist(), strict=True)):
            if self.rank[t] == r:
                whole[t] = ok and whole[a] and whole[b]
        self.greedy = {t: i for t, i in self.ids.items() if whole[i]}

    def separate(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens a and b stay apart when side by side, or up to merge number ``before``."""
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), NEVER) if before is None else before.astype(np.int64)
        good, at = np.ones(len(a), bool), np.arange(len(a))
        while len(at):
            code = a * len(self.tokens) + b
            where = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            crossing = np.where(self.codes[where] == code, self.code_ranks[where], NEVER)
            ra, rb = self.rank[a], self.rank[b]
            bad = crossing < limit
            good[at[bad]] = False
            go = ~bad & ((ra >= 0) | (rb >= 0))
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)[go]
            a, b = np.where(undo_a, self.right[a], a)[go], np.where(undo_a, b, self.left[b])[go]
            at = at[go]
        return good

    def propose(self, word: str) -> list[int]:
        """Longest tokens from the left. Only a token with the suffix may end the word."""
        ids, begins, i, n = [], self.begins.get, 0, len(word)
        whole = word + END if self.suffix else word
        last = n - bool(self.suffix)  # a token without the suffix ends here at the latest
        while i < n:
            j, best, stop = i + 1, -1, i
            while (found := begins(whole[i:j])) is not None and j <= len(whole):
                if found >= 0 and (j <= last or j == len(whole)):
                    best, stop = found, j
                j += 1
                if j > len(whole):
                    break
            if best < 0:
                raise KeyError(word[i])
            ids.append(best)
            i = stop
        return ids

    def merged(self, word: str) -> list[int]:
        """The word's letters after all merges, the lowest rank first and the leftmost of equals."""
        ids = [self.ids[c] for c in word[:-1]] + [self.ids[word[-1] + self.suffix]]
        if len(ids) <= SHORT:
            return self._merged_short(ids)
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of, made = self.rank_of, self.made
        waiting = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank_of.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(waiting)
        while waiting:
            r, i, a, b = heapq.heappop(waiting)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of.get((ids[i], ids[k]))) is not None:
                    heapq.heappush(waiting, (r, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (r := rank_of.get((ids[h], ids[i]))) is not None:
                heapq.heappush(waiting, (r, h, ids[h], ids[i]))
        return [t for t in ids if t >= 0]

    def _merged_short(self, ids: list[int]) -> list[int]:
        rank, made = self.rank_of.get, self.made
        ranks = [rank(pair, NEVER) for pair in zip(ids, ids[1:], strict=False)]
        while ranks and (r := min(ranks)) != NEVER:
            i = ranks.index(r)
            ids[i] = made[r]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), NEVER)
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), NEVER)
        return ids

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of byte-level words: proposed, verified, and merged where a pair fails."""
        proposed = [self.propose(w) for w in words]
        lengths = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((t for ids in proposed for t in ids), np.int64, int(lengths.sum()))
        word = np.repeat(np.arange(len(words)), lengths)
        inner = np.flatnonzero(word[1:] == word[:-1])
        codes, back = np.unique(flat[inner] * len(self.tokens) + flat[inner + 1], return_inverse=True)
        good = self.separate(codes // len(self.tokens), codes % len(self.tokens))[back]
        for w in np.unique(word[inner[~good]]).tolist():
            proposed[w] = self.merged(words[w])
        return proposed

    def normalised(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # letter by letter: a capital sigma does not see its word
        return text.lower()

    def words_of(self, text: str) -> list[str]:
        """Words of a text; special tokens come as themselves, between null characters."""
        if self.find_special is None or not self.find_special.search(text):
            return self.find_words(self.normalised(text))
        found: list[str] = []
        for k, part in enumerate(self.find_special.split(text)):
            found += [f"\0{part}\0"] if k % 2 else self.find_words(self.normalised(part))
        return found

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        known: dict[str, bytes] = per_process(("bpe words", id(self)), dict)
        for s, i in self.special.items():
            known[f"\0{s}\0"] = np.uint32(i).tobytes()
        cut = [self.words_of(t) for t in texts]
        new = [w for w in set().union(*cut) if w not in known]
        letters = self.letters
        spelled = ["".join([letters[b] for b in w.encode("utf-8", "replace")]) for w in new]
        found = {w: np.array(ids, "<u4").tobytes() for w, ids in zip(new, self.encode_words(spelled), strict=True)}
        known.update(found)
        ids = [b"".join(map(known.__getitem__, words)) for words in cut]
        if len(known) > CACHED_WORDS:
            known.clear()
        else:
            for w in new:
                if len(w) > CACHED_LENGTH:
                    del known[w]
        return ids

    def decode(self, ids: bytes) -> str:
        """Tokens as the vocabulary spells them, with spaces between, as a file without a decoder has it."""
        return " ".join(self.tokens[np.frombuffer(ids, "<u4")].tolist())


def vocabulary(path: str) -> Vocabulary:
    return per_process(("bpe", path), lambda: Vocabulary(path))


def _with_column(docs: DataFrame, name: str, kind: T.DataType, made) -> DataFrame:
    """``docs`` and a column made from whole Arrow batches."""
    kept = [c for c in docs.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            rest = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*rest, made(batch)], [*kept, name])

    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(name, kind)])
    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids``: binary, little-endian unsigned 32-bit integers."""
    return _with_column(
        docs, ids, T.BinaryType(), lambda b: pa.array(vocabulary(path).encode(texts_of(b, text)), pa.binary())
    )


def decode(encoded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids (null ids: the empty text)."""
    return _with_column(
        encoded,
        decoded,
        T.StringType(),
        lambda b: pa.array([vocabulary(path).decode(i or b"") for i in b.column(ids).to_pylist()], pa.string()),
    )


def count_of(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
