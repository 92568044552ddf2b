"""Near-duplicate records with small edits (problem 1).

SuperMinHash signatures of the five-character shingles of two text fields, banding,
exact verification of each candidate pair, union-find by label propagation over the
verified links.

A band is two registers of each signature: a pair falls in one bucket with probability
``(s1 * s2) ** 2``. The low 24 bits of a band's number are no key but a sketch, one bit of
each of 24 registers outside the band; of two records in a bucket at least ``LIKE`` = 16
must agree, which a pair at the threshold, 0.60 in both fields, does with 0.97 and a
chance pair with 0.28. With ``BANDS`` = 56 a pair at the threshold is missed with 1 in 1 760,
at 0.65 in both with 1 in 50 000.

Before any text moves, candidates are compared by two bits of each of 64 registers a
field: a field at the threshold agrees in 45 of 64 on average and in fewer than ``AGREE`` =
30 with 1 in 30 000; one of a chance pair in 25 or so. Registers are kept as one byte each.

Equal copies (same texts as stored, then same comparison form of both fields) are one
class from the start: only the class representative, its smallest id, is hashed, so a group of copies of any size puts one row in each bucket.
Buckets are joined by key; adaptive execution splits a bucket that grows hot among
tasks.

Defined results: NULL counts as empty; a record with an empty comparison form in
either field is similar to nothing (and in a class of its own); repeated rows of
one id count once; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelake.llm.components import components
from wirelake.session import discard, materialize

SHINGLE = 5
BANDS, ROWS = 56, 2
LIKE, BITS = 16, 24
SKETCH, AGREE = 64, 30
#: texts whose shingles are worked on at once: they stay in the cache of a core
LOT = 250
THRESHOLD = 0.6
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, elementwise."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def shingle_hashes(texts: list[str], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-character runs of each text (the whole text if shorter).

    Returns the distinct (document, hash) pairs as two arrays, ordered by document. A
    run is a sum of its characters' mixed values times odd factors by place, mixed again.
    """
    n = np.array([len(t) for t in texts], dtype=np.int64)
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    begin = np.cumsum(n) - n
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(texts)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - begin, count)
    with np.errstate(over="ignore"):
        value = np.concatenate([mix(code + np.uint64(1)), np.zeros(k, dtype=np.uint64)])
        whole = value[: len(code)] * _FACTORS[0]
        for i in range(1, k):
            whole += value[i : i + len(code)] * _FACTORS[i]
        h = whole[at]
        for j in np.flatnonzero((n < k) & (n > 0)).tolist():  # the run over the end belongs to other texts
            own = value[begin[j] : begin[j] + n[j]]
            h[np.searchsorted(doc, j)] = (own * _FACTORS[: n[j]]).sum()
        return doc, mix(h)


def superminhash(doc: np.ndarray, h: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """SuperMinHash signatures, ``n_docs`` x ``m``, of the element hashes ``h``.

    Every element draws a random permutation of the registers step by step and
    offers ``step + uniform`` to the register it reaches. A document stops as soon
    as each of its registers holds a value below the next step, which no later
    offer can beat; the steps run over all live documents at once.
    """
    sig = np.full((n_docs, m), np.inf)
    flat = sig.reshape(-1)
    swaps = np.empty((len(h), 0), dtype=np.int16)
    with np.errstate(over="ignore"):
        for step in range(m):
            if not len(h):
                break
            r = mix(h + np.uint64(2 * step + 1) * _STEP)
            k = step + ((r & np.uint64(0xFFFFFFFF)) * np.uint64(m - step) >> np.uint64(32)).astype(np.int16)
            # register now at place k of the element's permutation: undo earlier swaps
            at = k.copy()
            for j in range(step - 1, -1, -1):
                at = np.where(at == swaps[:, j], np.int16(j), np.where(at == j, swaps[:, j], at))
            np.minimum.at(flat, doc * m + at, step + (r >> np.uint64(11)).astype(np.float64) * 2.0**-53)
            live = (sig >= step + 1).any(axis=1)
            keep = live[doc]
            swaps = np.concatenate([swaps[keep], k[keep, None]], axis=1)
            doc, h = doc[keep], h[keep]
    return sig


def signatures(t_texts: list[str], s_texts: list[str]) -> np.ndarray:
    """``n`` x 2 x registers: a byte of each register of both fields."""
    out = np.empty((len(t_texts), 2, BANDS * ROWS), dtype=np.uint8)
    for f, texts in enumerate((t_texts, s_texts)):
        doc, h = shingle_hashes(texts)
        with np.errstate(over="ignore"):
            out[:, f] = mix(superminhash(doc, h, len(texts), BANDS * ROWS).view(np.uint64)) >> np.uint64(56)
    return out


def band_numbers(sig: np.ndarray) -> np.ndarray:
    """One number per document and band: 40 bits of key, 24 bits of sketch."""
    n = len(sig)
    bits = sig.reshape(n, 2, BANDS, ROWS)
    keys = np.tile(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (n, 1))
    sketch = np.zeros((n, BANDS), dtype=np.uint64)
    half = BITS // 2
    with np.errstate(over="ignore"):
        for f in range(2):
            for r in range(ROWS):
                keys = mix((keys ^ bits[:, f, :, r].astype(np.uint64)) * _STEP)
            one = (bits[:, f, :, 0] >> 7).astype(np.uint64)
            for i in range(half):  # of the bands after it, one register each
                sketch |= np.roll(one, -(i + 1), axis=1) << np.uint64(f * half + i)
    return ((keys >> np.uint64(BITS) << np.uint64(BITS)) | sketch).view(np.int64)


def sketches(sig: np.ndarray) -> list[np.ndarray]:
    """Two bits of each of ``SKETCH`` registers a field, as two numbers a field."""
    return [np.packbits(sig[:, f, :SKETCH] >> i & 1, axis=1, bitorder="little").view(np.int64).reshape(-1) for f in range(2) for i in range(2)]


def _banded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, LOT):
            part = b.slice(lo, LOT)
            sig = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint8).reshape(part.num_rows, 2, -1)
            keys = band_numbers(sig)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(np.repeat(part.column(0).to_numpy(), BANDS))], names=["v", "id"])


class _Letters(dict):
    """Letters and digits as they are, all else a space; filled as characters come."""

    def __missing__(self, c: int) -> int:
        self[c] = c if unicodedata.category(chr(c))[0] in "LN" else 32
        return self[c]


_LETTERS = _Letters()


def form_of(text: str | None) -> str | None:
    """The comparison form: lower case, runs of other than letters and digits one space, trimmed."""
    return None if text is None else " ".join(text.lower().translate(_LETTERS).split())


_FORMS = "id bigint, rep bigint, t string, s string, sig binary, k1 bigint, k2 bigint, k3 bigint, k4 bigint"


def _prepared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, rep, t, s`` with the comparison forms, their signature and sketches."""
    names = [c.split()[0] for c in _FORMS.split(", ")]
    for b in batches:
        for lo in range(0, b.num_rows, LOT):
            part = b.slice(lo, LOT)
            lt, ls = ([form_of(x) for x in part.column(i).to_pylist()] for i in (2, 3))
            sig = signatures([x or "" for x in lt], [y or "" for y in ls])
            cells = [x.tobytes() if y else None for x, y in zip(sig, lt)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(lt, pa.string()), pa.array(ls, pa.string()), pa.array(cells, pa.binary()), *map(pa.array, sketches(sig))], names=names)


def _jaccards(x: list[str], y: list[str], k: int) -> np.ndarray:
    """Exact similarity of the k-run sets of two lists of texts, pair by pair."""
    out = np.empty(len(x))
    for i, (a, b) in enumerate(zip(x, y)):
        if a == b:
            out[i] = 1.0 if a else 0.0
            continue
        p = {a[j : j + k] for j in range(len(a) - k + 1)} if len(a) >= k else {a} - {""}
        q = {b[j : j + k] for j in range(len(b) - k + 1)} if len(b) >= k else {b} - {""}
        both = len(p & q)
        out[i] = both / (len(p) + len(q) - both) if both else 0.0
    return out


def similarities(x: list[str], y: list[str]) -> np.ndarray:
    """Similarity of the shingle sets of two lists of at most ``LOT`` texts, pair by pair.

    Sets are told by 52-bit hashes: sorted with the number of the pair in the low bits,
    equal neighbours of the two sides are what both have.
    """
    low, sides = np.uint64(0xFFF), []
    for texts in (x, y):
        doc, h = shingle_hashes(texts)
        side = np.sort((h & ~low) | doc.astype(np.uint64))
        sides.append(side[np.append(side[1:] != side[:-1], True)] if len(side) else side)
    n = sum(np.bincount((s & low).astype(np.int64), minlength=len(x)) for s in sides)
    both = np.sort(np.concatenate(sides))
    both = np.bincount((both[1:][both[1:] == both[:-1]] & low).astype(np.int64), minlength=len(x))
    return both / np.maximum(n - both, 1)


def _verify(threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, LOT):
                part = b.slice(lo, LOT)
                for i, j in ((2, 3), (4, 5)):
                    part = part.filter(pa.array(similarities(part.column(i).to_pylist(), part.column(j).to_pylist()) >= threshold))
                yield part.select(["a", "b"])

    return run


def classes(records: DataFrame, id_col: str = "article_id", title: str = "title", snippet: str = "snippet") -> tuple[DataFrame, DataFrame]:
    """(``member(id, rep)``, ``texts(id, t, s, sig, k1, k2, k3, k4)`` of the representatives with both texts).

    Copies as stored are found first, on a hash of the raw texts; the comparison form
    is then made once a class, and classes of one form are joined.
    """
    raw = records.select(F.col(id_col).cast("bigint").alias("id"), F.col(title).alias("t"), F.col(snippet).alias("s")).filter("id is not null and t is not null and s is not null")
    raw = raw.withColumn("h", F.unhex(F.md5(F.concat(F.length("t").cast("string"), F.lit(":"), "t", "s"))))
    rep = raw.groupBy("h").agg(F.min("id").alias("rep"))
    own = F.col("id") == F.col("rep")
    forms = raw.join(rep, "h").select("id", "rep", F.when(own, F.col("t")).alias("t"), F.when(own, F.col("s")).alias("s"))
    forms = forms.mapInArrow(_prepared, _FORMS)
    forms = materialize(forms.filter("t is null or t <> '' and s <> ''"), "p1-forms")
    first = forms.filter("t is not null").withColumn("h", F.unhex(F.md5(F.concat_ws("\n", "t", "s"))))
    several = first.groupBy("h").agg(F.min("id").alias("best"), F.max("id").alias("last")).filter("best < last")
    again = materialize(first.select("h", F.col("id").alias("other")).join(several, "h").filter("other <> best").select("other", "best").distinct(), "p1-again")
    # these are few as a rule; where they are not, the join shuffles
    texts = first.drop("rep", "h").join(again, F.col("id") == F.col("other"), "left_anti")
    copies = forms.filter("t is null").select("id", "rep").join(first.select(F.col("id").alias("of")), F.col("rep") == F.col("of"), "left_semi")
    member = first.select("id", F.col("id").alias("rep")).unionByName(copies).join(again, F.col("rep") == F.col("other"), "left")
    return member.select("id", F.coalesce("best", "rep").alias("rep")).distinct(), texts


def links(texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All verified pairs ``(a, b)``, a < b, of class representatives; rows of one id count once."""
    bands = texts.select("id", "sig").mapInArrow(_banded, "v bigint, id bigint")
    # the number stands first: the zero bytes of an id then compress with the head of the next row
    x = bands.select(F.col("v").alias("v1"), F.col("id").alias("a"))
    # many rows come of each text, which the planner can't know: never broadcast them
    y = bands.select(F.col("v").alias("v2"), F.col("id").alias("b")).hint("merge")
    same = F.shiftright("v1", BITS) == F.shiftright("v2", BITS)
    unlike = F.bit_count(F.col("v1").bitwiseXOR(F.col("v2")))  # the keys are equal
    cand = x.join(y, same & (F.col("a") < F.col("b")) & (unlike <= BITS - LIKE)).select("a", "b").distinct()
    one = texts.select(F.col("id").alias("a"), *(F.col(f"k{i}").alias(f"a{i}") for i in range(1, 5)))
    two = texts.select(F.col("id").alias("b"), *(F.col(f"k{i}").alias(f"b{i}") for i in range(1, 5)))

    def agrees(i: int, j: int):
        off = [F.col(f"a{x}").bitwiseXOR(F.col(f"b{x}")) for x in (i, j)]
        return F.bit_count(off[0].bitwiseOR(off[1])) <= SKETCH - AGREE

    close = materialize(cand.join(one, "a").join(two, "b").filter(agrees(1, 2) & agrees(3, 4)).select("a", "b"), "p1-close")
    one = texts.select(F.col("id").alias("a"), F.col("t").alias("t1"), F.col("s").alias("s1"))
    two = texts.select(F.col("id").alias("b"), F.col("t").alias("t2"), F.col("s").alias("s2"))
    both = close.join(one, "a").join(two, "b").select("a", "b", "t1", "t2", "s1", "s2")
    out = materialize(both.mapInArrow(_verify(threshold), "a bigint, b bigint").distinct(), "p1-links")
    discard(close)
    return out


def p1_found(articles: DataFrame) -> DataFrame:
    """All pairs of similar articles: the links between classes and the copies within."""
    member, texts = classes(articles)
    link = links(texts)
    left = member.select(F.col("rep").alias("a"), F.col("id").alias("x"))
    right = member.select(F.col("rep").alias("b"), F.col("id").alias("y"))
    across = link.join(left, "a").join(right, "b").select("x", "y")
    several = member.groupBy("rep").count().filter("count > 1").select(F.col("rep").alias("a"))
    copies = left.join(several, "a", "left_semi")
    within = copies.join(copies.select("a", F.col("x").alias("y")), "a").filter("x < y").select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("a_id"), F.greatest("x", "y").alias("b_id"))


def p1_groups(articles: DataFrame) -> DataFrame:
    """One row per article: ``article_id, class_id, n_links`` (links of its class representative)."""
    member, texts = classes(articles)
    link = links(texts)
    comp = components(link)
    ends = link.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    ids = articles.select(F.col("article_id").cast("bigint").alias("id")).filter("id is not null").distinct()
    return (
        ids.join(member, "id", "left")
        .withColumn("rep", F.coalesce("rep", "id"))
        .join(comp.select(F.col("id").alias("rep"), "class_id"), "rep", "left")
        .join(ends, "rep", "left")
        .select(F.col("id").alias("article_id"), F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
    )
