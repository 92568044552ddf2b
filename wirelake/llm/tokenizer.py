"""Byte-level BPE by backtracking over Aho-Corasick matches (problem 7).

A vocabulary file holds token bytes and ranks. Inside one pretoken the encoder
takes the longest token that starts at the current byte (Aho-Corasick), accepts
it if it is compatible with the token before, tries its next shorter prefix if
not, and steps back when none is left; positions that led nowhere are marked, so
every byte is left at most once and the run is linear. Two tokens are compatible
if merging the joined bytes would give just these two; this is read off the merge
tree of the tokens (``compatible``) and kept in a pair table.

The vocabulary's size is fixed by its file (about 1 MB), so it is sent to the
executors as is; the automaton is built once per Python worker.

Defined results: NULL and empty texts have the empty list; strings that look
like special tokens are ordinary text; rows with a NULL id and repeated rows are
kept.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: where the public vocabulary files lie, on the driver
TOKENIZER_DIR = "/opt/tokenizers"
# Fixed value: the pretoken pattern that belongs to these vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_LIMIT = 400_000


def load_vocabulary(name: str, folder: str = TOKENIZER_DIR) -> list[bytes]:
    """Token bytes by id from a ``.tiktoken`` file."""
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * len(pairs)
    for tok, rank in pairs:
        out[int(rank)] = base64.b64decode(tok)
    return out


class Bpe:
    """Encoder of single pretokens; see the module's description."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.size = [len(t) for t in tokens]
        self.auto = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            self.auto.add_word(t.decode("latin-1"), i)
        self.auto.make_automaton()
        self.shorter = [self._next_prefix(t) for t in tokens]
        self.left = list(range(len(tokens)))
        self.right = list(range(len(tokens)))
        self.merged: dict[tuple[int, int], int] = {}
        for i, t in enumerate(tokens):
            if len(t) > 1:
                a, b = self._split(t, i)
                self.left[i], self.right[i] = a, b
                self.merged[a, b] = i
        self.pairs: dict[tuple[int, int], bool] = {}

    def _next_prefix(self, t: bytes) -> int:
        for n in range(len(t) - 1, 0, -1):
            if (i := self.rank.get(t[:n])) is not None:
                return i
        return -1

    def _split(self, t: bytes, own: int) -> tuple[int, int]:
        """The two tokens whose merge is ``t``: the merge is possible with lower ranks only."""
        get = self.rank.get
        opts = [(a, b) for n in range(1, len(t)) if (a := get(t[:n], own)) < own and (b := get(t[n:], own)) < own]
        if len(opts) == 1:
            return opts[0]
        parts = self._merge(t, own)
        return (get(parts[0]), get(parts[1])) if len(parts) == 2 else opts[0]

    def _merge(self, t: bytes, below: int) -> list[bytes]:
        parts = [t[i : i + 1] for i in range(len(t))]
        while len(parts) > 1:
            best, at = min((self.rank.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if best >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` and ``b`` together encode to just ``a, b``.

        Undoes the merges of both sides from the last one back; where the border
        tokens of a moment could merge before the next step of either side was
        taken, the pair breaks.
        """
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        x, y, limit, ok = a, b, len(self.tokens), None
        left, right, merged = self.left, self.right, self.merged
        while ok is None:
            m = merged.get((x, y))
            if m is not None and m < limit:
                ok = False
            elif x > y and right[x] != x or x <= y and left[y] == y:
                if right[x] == x:
                    ok = True
                else:
                    limit, x = x, right[x]
            elif left[y] == y:
                ok = True
            else:
                limit, y = y + 1, left[y]
        self.pairs[a, b] = ok
        return ok

    def word(self, w: str) -> tuple[int, ...]:
        """Token ids of one pretoken."""
        data = w.encode()
        whole = self.rank.get(data)
        if whole is not None:
            return (whole,)
        text, n, size, ok = data.decode("latin-1"), len(data), self.size, self.compatible
        greedy = [i for _, i in self.auto.iter_long(text)]
        if all(map(ok, greedy, greedy[1:])):
            return tuple(greedy)
        longest = [0] * n
        for end, i in self.auto.iter(text):  # later ends overwrite: the longest stays
            longest[end + 1 - size[i]] = max(longest[end + 1 - size[i]], end + 1)
        dead = bytearray(n + 1)
        out: list[int] = []
        pos, nxt = 0, self.rank[data[: longest[0]]]
        while pos < n:
            tok, last = nxt, out[-1] if out else -1
            while tok >= 0 and (dead[pos + size[tok]] or last >= 0 and not ok(last, tok)):
                tok = self.shorter[tok]
            if tok >= 0:
                out.append(tok)
                pos += size[tok]
                if pos < n:
                    nxt = self.rank[data[pos : longest[pos]]]
            else:
                dead[pos] = 1
                out.pop()
                pos -= size[last]
                nxt = last
        return tuple(out)


class _Words(dict):
    """Pretoken to ids; emptied when it grows beyond its limit."""

    def __init__(self, bpe: Bpe, value: Callable[[tuple[int, ...]], object]):
        self.bpe, self.value = bpe, value

    def __missing__(self, w: str):
        if len(self) >= CACHE_LIMIT:
            self.clear()
        v = self[w] = self.value(self.bpe.word(w))
        return v


class Tokenizer:
    def __init__(self, tokens: list[bytes]):
        self.bpe = Bpe(tokens)
        self.find = regex.compile(PATTERN).findall
        self.ids_of = _Words(self.bpe, lambda ids: ids)
        self.count_of = _Words(self.bpe, len)
        offsets = np.cumsum([0, *map(len, tokens)])
        self.begin, self.length = offsets[:-1], np.diff(offsets)
        self.blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.ids_of.__getitem__, self.find(text)))) if text else []

    def count(self, text: str | None) -> int:
        return sum(map(self.count_of.__getitem__, self.find(text))) if text else 0

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """Bytes of all ids at once, gathered from one blob by its offset table."""
        ids = np.asarray(ids, dtype=np.int64)
        if not len(ids):
            return ""
        n = self.length[ids]
        at = np.repeat(self.begin[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.blob[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def _built(blob: bytes) -> Tokenizer:
    return Tokenizer([base64.b64decode(x) for x in blob.split(b"\n")])


def worker_tokenizer(spark: SparkSession, name: str, folder: str = TOKENIZER_DIR) -> Callable[[], Tokenizer]:
    """A function for executors that gives the worker's own tokenizer."""
    sent = spark.sparkContext.broadcast(b"\n".join(base64.b64encode(t) for t in load_vocabulary(name, folder)))
    return lambda: _built(sent.value)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZER_DIR) -> DataFrame:
    """``doc_id, ids``: one row per row of ``docs``."""
    get = worker_tokenizer(docs.sparkSession, tokenizer, folder)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = get()
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                ids = [np.array(t.encode(x), dtype=np.int32) for x in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, folder: str = TOKENIZER_DIR) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; NULL ids give the empty text."""
    get = worker_tokenizer(encoded.sparkSession, tokenizer, folder)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = get()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZER_DIR) -> DataFrame:
    """``doc_id, n_tokens``: one row per row of ``docs``."""
    get = worker_tokenizer(docs.sparkSession, tokenizer, folder)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = get()
        for b in batches:
            n = [t.count(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col)).mapInArrow(run, "doc_id bigint, n_tokens bigint")
