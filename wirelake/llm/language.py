"""Language of documents and of their segments (problem 5).

A word is the average of the embeddings of its hashed character n-grams, a sentence
the average of its words, so that short function words count as much as long ones;
a linear softmax follows; embeddings and weights are trained together
by stochastic gradient descent in numpy on at most ``TRAIN_LIMIT`` labelled samples a
language. A temperature is fitted on held-out samples. The confidence below which a
unit is rejected is calibrated by the number of its words: of held-out runs of so many
words at most ``WRONG_SHARE`` are wrong above it, so a short sentence counts if its few
words are clear enough. Rejected units, names, numbers and code belong to the segment
around them.

As embedding and softmax are linear, a trained model is one logit vector per
n-gram bucket: a fixed table of ``BUCKETS`` x languages (about 2 MB), which is what
the executors get.

Defined results: NULL title and snippet count as empty; an article without any
word has no row; without samples there is no language to tell and no row; rows with a NULL id and repeated rows are kept.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wirelake.llm import markup, residue

BUCKETS, DIM, EPOCHS, RATE, BATCH, STRENGTH = 1 << 15, 12, 8, 0.25, 32, 8
#: the most labelled rows a language that are read for training: clean samples, labelled articles
TRAIN_LIMIT, ARTICLE_LIMIT = 3_000, 100
#: lengths in words at which rejection is calibrated; the share that may be wrong above it
LENGTHS, WRONG_SHARE = (1, 2, 3, 4, 6, 9), 0.001
NGRAMS = range(1, 5)
SEED = 11

# Other notations of the languages' codes.
SAME_LANGUAGE = {"he": "iw", "heb": "iw", "por": "pt", "eng": "en", "spa": "es", "rus": "ru", "ara": "ar", "zho": "zh", "chi": "zh", "cmn": "zh"}

_WORD = re.compile(r"[^\W\d_]+")
_HAN = re.compile(r"[一-鿿㐀-䶿]")
_SENTENCE = re.compile(r"(?<=[.!?…؟])[\"”’»)]*\s+|(?<=[。！？])[”’」』）]*\s*|\n+")
# what is no language: the sign that announces it, its pattern
_CODE = [
    ("`", re.compile(r"(?s)```.*?(?:```|\Z)")),
    ("$", re.compile(r"(?s)\$\$.*?\$\$|\$[A-Za-z\\][^$\n]*\$")),
    ("://", re.compile(r"https?://\S+")),
    ("@", re.compile(r"(?<!\w)[\w.-]+@[\w.-]+")),
    ("_", re.compile(r"\b\w+_\w+(?:\.\w+)*")),
]


def norm_code(label):
    """The base language of a label column: region, script and case dropped, older code kept."""
    base = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]*)", 1))
    pairs = [F.lit(x) for kv in SAME_LANGUAGE.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), base), base)


def words_of(sentence: str) -> list[str]:
    """The words that tell a language: names inside a sentence are left out, Han is cut to signs.

    Where most words have a capital it is the writing of a heading and tells no names.
    """
    out = []
    found = _WORD.findall(sentence)
    heading = len(found) > 2 and 3 * sum(w[0].isupper() for w in found) > 2 * len(found)
    for i, w in enumerate(found):
        if _HAN.search(w):
            out += [c for c in w if _HAN.match(c)]
        elif i == 0 or heading or not w[0].isupper() or w.isupper() and len(w) > 1:
            out.append(w.lower())
    return out


def buckets_of(word: str) -> list[int]:
    s = f"<{word}>"
    grams = {s[i : i + n] for n in NGRAMS for i in range(len(s) - n + 1)} - {"<", ">"} | {s}
    return [zlib.crc32(g.encode()) % BUCKETS for g in grams]


class Model:
    """Trained logits per bucket, with temperature and rejection."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, temperature: float = 1.0, reject: tuple[float, ...] = (0.0,) * len(LENGTHS)):
        self.langs, self.table, self.bias, self.temperature, self.reject = langs, table, bias, temperature, reject
        self.row: dict[str, int] = {}
        self.sums = np.zeros((1024, len(langs)), dtype=np.float32)

    def __getstate__(self):
        return self.langs, self.table, self.bias, self.temperature, self.reject

    def __setstate__(self, s):
        self.__init__(*s)

    def least(self, words: list[str]) -> float:
        """The confidence that a unit of these words needs; two Han signs weigh as one word."""
        n = len(words) // 2 if words and _HAN.match(words[0]) else len(words)
        return self.reject[max(0, int(np.searchsorted(LENGTHS, n, side="right")) - 1)]

    def index(self, word: str) -> int:
        """The place of a word's logits in ``sums``."""
        i = self.row.get(word)
        if i is None:
            if len(self.row) >= 400_000:
                self.row.clear()
            i = self.row[word] = len(self.row)
            if i >= len(self.sums):
                self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
            b = buckets_of(word)
            self.sums[i] = self.table[b].mean(axis=0)
        return i

    def probabilities(self, units: list[list[str]]) -> np.ndarray:
        """One row per unit; a unit without words gets the same share for each language."""
        n = np.array([len(u) for u in units])
        out = np.full((len(units), len(self.langs)), 1 / len(self.langs))
        some = np.flatnonzero(n)
        if len(some):
            if sum(n) + len(self.row) > 400_000:
                self.row.clear()
            idx = [self.index(w) for u in units for w in u]
            total = np.add.reduceat(self.sums[idx], np.cumsum(n[some]) - n[some], axis=0)
            z = (total / n[some, None] + self.bias) / self.temperature
            e = np.exp(z - z.max(axis=1, keepdims=True))
            out[some] = e / e.sum(axis=1, keepdims=True)
        return out


def _sgd(samples: list[tuple[np.ndarray, np.ndarray, int]], k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, weights and bias after ``EPOCHS`` passes in batches of ``BATCH``.

    A sample is its n-gram buckets, their shares of the sentence, and the language.
    """
    emb = rng.uniform(-1, 1, (BUCKETS, DIM)).astype(np.float32) / DIM
    w, bias = np.zeros((DIM, k), dtype=np.float32), np.zeros(k, dtype=np.float32)
    batches = -(-len(samples) // BATCH)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(samples))
        for j in range(batches):
            which = order[j * BATCH : (j + 1) * BATCH]
            rate = RATE * (1 - (epoch * batches + j) / (EPOCHS * batches))
            n = np.array([len(samples[i][0]) for i in which])
            idx = np.concatenate([samples[i][0] for i in which])
            share = np.concatenate([samples[i][1] for i in which])
            x = np.add.reduceat(emb[idx] * share[:, None], np.cumsum(n) - n, axis=0)
            z = x @ w + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(which)), [samples[i][2] for i in which]] -= 1
            grad = p @ w.T
            w -= rate * (x.T @ p + 1e-4 * w)
            bias -= rate * p.mean(axis=0)
            touched, at = np.unique(idx, return_inverse=True)
            spread = np.repeat(np.arange(len(which)), n)
            for d in range(DIM):
                emb[touched, d] -= rate * STRENGTH * np.bincount(at, weights=grad[spread, d] * share, minlength=len(touched))
    return emb, w, bias


def plain(text: str) -> str:
    """Without accents, as careless copies are."""
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


def train(rows: list[tuple[str, str]], seed: int = SEED, calibrated: bool = True) -> Model:
    """A model from (language, text); a fifth of the samples calibrates it."""
    rng = np.random.default_rng(seed)
    rows = [(lang, t) for lang, t in rows if lang and t and words_of(t)]
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        raise ValueError("no labelled samples")
    order = rng.permutation(len(rows))
    held, used = order[: len(rows) // 5], order[len(rows) // 5 :]

    def samples(which: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
        out = []
        for i in which:
            lang, text = rows[i]
            ws, y = words_of(text), langs.index(lang)
            half = len(ws) // 2
            for part in (ws, ws[:half], ws[half:], words_of(plain(text)) if i % 2 else []):
                b = [buckets_of(w) for w in part]
                if b:
                    share = [1 / (len(x) * len(b)) for x in b for _ in x]
                    out.append((np.array([i for x in b for i in x]), np.array(share, dtype=np.float32), y))
        return out

    def fit(which: np.ndarray) -> Model:
        emb, w, bias = _sgd(samples(which), len(langs), rng)
        return Model(langs, (emb @ w).astype(np.float32), bias)

    if not calibrated or not len(held):
        return fit(order)
    model = fit(used)
    cal = [(words_of(rows[i][1]), langs.index(rows[i][0])) for i in held]
    temperature, reject = 1.0, (0.0,) * len(LENGTHS)
    if cal:
        y = np.array([c for _, c in cal])

        def loss(t: float) -> float:
            model.temperature = t
            return float(-np.log(model.probabilities([w for w, _ in cal])[np.arange(len(y)), y] + 1e-12).mean())

        temperature = min((0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.5, 2.0), key=loss)
        model.temperature = temperature
        reject = tuple(rejection(model, cal, n) for n in LENGTHS)
    final = fit(order)
    final.temperature, final.reject = temperature, reject
    return final


def rejection(model: Model, held: list[tuple[list[str], int]], n: int) -> float:
    """The confidence above which at most ``WRONG_SHARE`` of the held-out runs of ``n`` words are wrong."""
    runs = []
    for words, y in held:
        k = 2 * n if words and _HAN.match(words[0]) else n
        runs += [(words[i : i + k], y) for i in range(0, max(1, len(words) - k + 1), max(1, k // 2))]
    p = model.probabilities([w for w, _ in runs])
    top, right = p.max(axis=1), p.argmax(axis=1) == np.array([y for _, y in runs])
    order = np.argsort(-top, kind="stable")
    bad = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    fine = np.flatnonzero(bad <= WRONG_SHARE)
    return float(top[order[fine[-1]]]) if len(fine) else 1.0


def widened(seed_rows: list[tuple[str, str]], labelled: list[tuple[str, str, str]]) -> list[tuple[str, str]]:
    """The clean samples and the units of labelled articles whose label the first model confirms."""
    first = train(seed_rows, calibrated=False)
    rows = list(seed_rows)
    units = [(lang, u) for lang, title, snippet in labelled for u in units_of(title, snippet)]
    words = [words_of(u) for _, u in units]
    probs = first.probabilities(words)
    for (lang, u), ws, p in zip(units, words, probs):
        if ws and lang in first.langs and (p[first.langs.index(lang)] > 1 / len(first.langs)):
            rows.append((lang, u))
    return rows


def read_samples(samples: DataFrame) -> list[tuple[str, str]]:
    """``TRAIN_LIMIT`` samples of each language: those with the lowest hashes."""
    h = F.xxhash64("sample_id", "text")
    some = samples.filter("lang is not null and text is not null").select("lang", "text", F.row_number().over(Window.partitionBy("lang").orderBy(h)).alias("k"))
    return [(r["lang"], r["text"]) for r in some.filter(F.col("k") <= TRAIN_LIMIT).orderBy("lang", "k").collect()]


def read_labelled(articles: DataFrame) -> list[tuple[str, str, str]]:
    """About ``ARTICLE_LIMIT`` articles of each stated language, at most twice as many.

    A language's share of the hash range is set by its number of articles, so whole
    rows leave the executors only for the articles that are taken.
    """
    lang, span = norm_code(F.col("source_lang")), 1 << 30
    h = F.pmod(F.xxhash64("article_id"), F.lit(span))
    counts = articles.select(lang.alias("lang")).filter("lang <> ''").groupBy("lang").count().orderBy(F.desc("count")).limit(100).collect()
    bound = F.coalesce(*[F.when(lang == r["lang"], F.lit(min(span, span * ARTICLE_LIMIT // r["count"] + 1))) for r in counts], F.lit(0)) if counts else F.lit(0)
    rows = articles.filter(h < bound).select(lang.alias("lang"), "title", "snippet", h.alias("h")).orderBy("h", "title", "snippet").collect()
    out, taken = [], {}
    for r in rows:
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= 2 * ARTICLE_LIMIT:
            out.append((r["lang"], r["title"], r["snippet"]))
    return out


def units_of(title: str | None, snippet: str | None) -> list[str]:
    """The title and the sentences of the snippet, without markup and code."""
    out = [title.strip() if title and title.strip() else ""]
    if snippet and snippet.strip():
        text = markup.clean(snippet, markup.kinds(snippet))
        for sign, pattern in _CODE:
            if sign in text:
                text = pattern.sub(" ", text)
        out += [s for s in _SENTENCE.split(text) if s and s.strip()]
    return [u for u in out if u]


#: an open line (no mark at its end) of so many words counts as a full sentence
OPEN_WORDS = 8
_FULL = re.compile(r"[.!?…。！？؟:][\"”’»)」』）]*\s*\Z")


def _judged(i: int, unit: str, ws: list[str]) -> bool:
    """Whether a unit can be a segment: the title, a closed sentence, or an open line of some length."""
    n = len(ws) * 2 // 3 if ws and _HAN.match(ws[0]) else len(ws)
    return bool(ws) and (i == 0 or bool(_FULL.search(unit)) or n >= OPEN_WORDS)


def segments(texts: list[str], units: list[list[str]], probs: np.ndarray, model: Model) -> list[tuple[str, float, int, int]]:
    """(language, confidence, first unit, last unit) of the maximal runs in one language."""
    out: list[list] = []
    for i, ws in enumerate(units):
        k = int(probs[i].argmax())
        p = float(probs[i, k])
        if not _judged(i, texts[i], ws) or p < model.least(ws):
            continue
        if out and out[-1][0] == k:
            out[-1][1] += p * len(ws)
            out[-1][2] += len(ws)
            out[-1][4] = i
        else:
            out.append([k, p * len(ws), len(ws), i, i])
    if not out and any(units):
        # nothing clear enough by itself: all words together
        k = int(probs.sum(axis=0).argmax())
        out.append([k, float(probs[:, k].mean()), 1, 0, len(units) - 1])
    return [(model.langs[k], c / n, a, b) for k, c, n, a, b in out]


@lru_cache(maxsize=2)
def _unpickled(blob: bytes) -> Model:
    import pickle

    return pickle.loads(blob)


_OUT = pa.schema([("article_id", pa.int64()), ("source_lang", pa.string()), ("no", pa.int32()), ("n", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64())])


def label_segments(articles: DataFrame, samples: DataFrame) -> DataFrame:
    """``article_id, source_lang, no, n, lang, confidence``: all segments of all articles, from 1."""
    import pickle

    spark = articles.sparkSession
    clean = read_samples(samples)
    if not clean:
        return spark.createDataFrame([], "article_id bigint, source_lang string, no int, n int, lang string, confidence double")
    sent = spark.sparkContext.broadcast(pickle.dumps(train(widened(clean, read_labelled(articles)))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _unpickled(sent.value)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                ids, labels, titles, snippets = (c.to_pylist() for c in part.columns)
                texts = [units_of(t, s) for t, s in zip(titles, snippets)]
                units = [[words_of(u) for u in us] for us in texts]
                probs = model.probabilities([u for us in units for u in us])
                rows, at = [], 0
                for rid, lab, ts, us in zip(ids, labels, texts, units):
                    segs = segments(ts, us, probs[at : at + len(us)], model)
                    at += len(us)
                    rows += [(rid, lab, i + 1, len(segs), lang, c) for i, (lang, c, _, _) in enumerate(segs)]
                cols = list(zip(*rows)) if rows else [[] for _ in _OUT]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT)], schema=_OUT)

    cols = articles.select(F.col("article_id").cast("bigint"), "source_lang", "title", "snippet")
    return cols.mapInArrow(run, "article_id bigint, source_lang string, no int, n int, lang string, confidence double")


def p5_cases(articles: DataFrame, samples: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """``article_id, seg_no, lang, confidence`` of wrongly labelled and mixed articles.

    Residue is told over both tables, as a label can reach an article through an item.
    """
    records = residue.article_records(articles)
    bad = residue.residue(records) if items is None else residue.p4_found(articles, items).filter("rec_table = 'articles'")
    bad = bad.select(F.col("rec_id").alias("article_id"))
    seg = label_segments(articles, samples).join(bad, "article_id", "left_anti")
    stated = F.when(F.col("source_lang").isNull(), "pt").otherwise(norm_code(F.col("source_lang")))
    return seg.filter((F.col("n") > 1) | (stated != F.col("lang"))).select(
        "article_id", F.when(F.col("n") > 1, F.col("no")).otherwise(0).cast("int").alias("seg_no"), "lang", "confidence"
    )


def p5_found(articles: DataFrame, samples: DataFrame, items: DataFrame | None = None) -> DataFrame:
    return p5_cases(articles, samples, items).select("article_id", "seg_no", "lang")


def accuracy(model: Model, rows: list[tuple[str, str]]) -> pd.DataFrame:
    """Per language: samples and share judged right."""
    probs = model.probabilities([words_of(t) for _, t in rows])
    got = [model.langs[k] for k in probs.argmax(axis=1)]
    df = pd.DataFrame({"lang": [r[0] for r in rows], "right": [g == r[0] for g, r in zip(got, rows)]})
    return df.groupby("lang")["right"].agg(["size", "mean"]).reset_index()
