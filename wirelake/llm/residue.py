"""Template residue, filler and error-page text (problem 4).

Texts are cut into fragments (sentences, lines, headings). A few fragments are
trusted from the start: the ``SEEDS`` (short messages by label), filler by its
vocabulary, and runs of one repeated word. A template field or a stand-in for a
missing value inside a sentence marks the record, not the sentence.

Trusted labels then spread through the connected components of the fragment graph,
from the labelled fragments outwards, round by round, until no component they touch
has an unlabelled fragment left. There are two kinds of links:

* near copies: both SimHashes share a key in one of ``TABLES`` partitioned tables,
  lie within ``HAMMING`` bits, and the five-character shingle sets of the texts have a
  similarity of ``SIMILARITY``. A pair at similarity 0.80 shares a key with 99.7 %;
* companions: a fragment that stands beside at least ``PARTNERS`` labelled fragments, in
  at least ``SUPPORT`` different texts and in ``SHARE`` of all texts that hold it, belongs
  to the same pages. A news sentence copied together with one message has one partner.

Components without a trusted label are never expanded, so the work follows the
residue and not the square of the corpus. The fragments labelled last are looked up
in every task as long as they are at most ``FRONTIER``; beyond it their table keys
are joined.

Defined results: NULL, empty and blank texts are no cases; a NULL id is kept as
such; repeated rows give one case.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelake.llm.neardup import _jaccards, mix, shingle_hashes
from wirelake.session import discard, materialize

SIMILARITY, SHINGLE = 0.8, 5
HAMMING, TABLES, KEY_BITS = 18, 40, 12
SUPPORT, SHARE, PARTNERS = 4, 0.2, 3
FRONTIER = 100_000

# Unfilled template fields, in any place of a text.
FIELD = re.compile(
    r"\{\{[^{}|\n]{1,60}\}\}|\{%[^%\n]{1,60}%\}|[$#]\{[A-Za-z_][\w.]*\}|%%[A-Za-z_]\w*%%|@@[A-Za-z_]\w*@@|%\([A-Za-z_]\w*\)s"
    r"|\[[\w. ]{2,40} (?:AQUI|AQUÍ|HERE)\]|(?<![\\A-Za-z}\]^_*$#{%\"'])\{[A-Za-z_]{3,}\}(?!\})"
)
# What programs print for a missing value.
STAND_IN = re.compile(r"\[object Object\]|\(null\)|(?<![A-Za-z])(?:undefined|NaN|None None)(?![A-Za-z])|\A\s*(?:None|null|NULL|nil|N/A)\s*\Z")

# Trusted messages as whole fragments; lower case, numbers as 0.
SEEDS = {
    "filler": """
texto de exemplo|sample text|texto de muestra|texto de prueba|пример текста|placeholder|legenda da foto|pie de foto|your caption goes here
insira aqui o resumo da matéria com até 0 caracteres|enter the summary of the story here, 0 characters at most|escriba aquí el resumen de la noticia, máximo 0 caracteres
aqui vai o texto de apoio da notícia, substituir antes de publicar|this is placeholder copy for the standfirst, replace before publishing|aquí va la entradilla provisional, sustituir antes de publicar
""",
    "error": """
error 0|erro 0|http 0|ошибка 0|خطأ 0|错误 0|שגיאה 0|0 not found|0 forbidden|0 bad gateway|0 page not found|0 internal server error|0 service unavailable
page not found|not found|forbidden|access denied|internal server error|bad gateway|service unavailable|gateway time-out|gateway timeout|too many requests|something went wrong|connection refused by the server|request timed out
página não encontrada|acesso negado|erro interno do servidor|serviço temporariamente indisponível|tempo de resposta esgotado|muitas requisições|algo deu errado|conexão recusada pelo servidor
página no encontrada|acceso denegado|error interno del servidor|servicio no disponible|servicio temporalmente no disponible|tiempo de respuesta agotado|demasiadas solicitudes|algo salió mal|vaya, algo salió mal|conexión rechazada
страница не найдена|доступ запрещён|внутренняя ошибка сервера|сервис временно недоступен|что-то пошло не так|слишком много запросов
الصفحة غير موجودة|تم رفض الوصول|خطأ داخلي في الخادم|الخدمة غير متاحة
页面不存在|页面未找到|访问被拒绝|服务器内部错误|服务不可用|服务暂时不可用
הדף לא נמצא|הגישה נדחתה|שגיאת שרת פנימית|השירות אינו זמין
""",
    "notice": """
please enable javascript to continue|javascript is not available|your browser does not support scripts|this site requires javascript to run|checking that you are human|you need to turn on cookies and scripts to read this page|disable your ad blocker and reload the page
para continuar, ative o javascript no seu navegador|o javascript não está disponível|seu navegador não oferece suporte a scripts|este site precisa de javascript para funcionar|verificando se você é humano|você precisa habilitar os cookies e scripts para ler esta página|desative o bloqueador de anúncios e recarregue a página
para continuar, active javascript en su navegador|javascript no está disponible|su navegador no admite scripts|este sitio necesita javascript para funcionar|comprobando que usted es humano|debe habilitar las cookies y los scripts para leer esta página|desactive el bloqueador de anuncios y recargue la página
для просмотра этой страницы включите javascript|ваш браузер не поддерживает скрипты|проверяем, что вы человек
يرجى تفعيل جافا سكريبت للمتابعة|متصفحك لا يدعم البرامج النصية|جار التحقق من أنك إنسان
请启用 javascript 以继续浏览|您的浏览器不支持脚本|正在验证您是否为真人
יש להפעיל javascript כדי להמשיך|הדפדפן שלך אינו תומך בסקריפטים|בודקים שאתם בני אדם
""",
}


def seed_labels(seeds: dict[str, str] = SEEDS) -> dict[str, str]:
    """Seed text to label."""
    return {s: label for label, block in seeds.items() for line in block.strip().split("\n") for s in line.split("|") if s}


_TAG = re.compile(r"<(?:script|style)\b.*?</(?:script|style)\s*>|<!--.*?-->|<!\[CDATA\[|\]\]>|</?[A-Za-z][^<>]*>", re.S | re.I)
_CUT = re.compile(r"\n+|(?<=[.!?…؟])\s+|(?<=[。！？])|:\s+(?=\S)|\s+[|–—-]\s+")
_REF = re.compile(r"\(\s*ref[^()]*\)", re.I)
_NUM = re.compile(r"\d[\d.,:/-]*")
_WS = re.compile(r"\s+")


def fragments(text: str) -> list[str]:
    """Comparison forms of a text's sentences, lines and headings."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub("\n", text)
    out = []
    for part in _CUT.split(_REF.sub(" ", text.lower())):
        part = _WS.sub(" ", _NUM.sub("0", part)).strip(" \t.!…。,:;-*#>=_|'\"")
        if part:
            out.append(part)
    return out


# The words of the usual filler text.
FILLER_WORDS = frozenset(
    "lorem ipsum dolor amet consectetur adipiscing elit eiusmod tempor incididunt labore dolore magna aliqua veniam nostrud ullamco laboris"
    " vivamus sagittis lacus augue laoreet rutrum faucibus auctor maecenas mollis interdum nullam quis risus eget urna ornare".split()
)


_RUN = re.compile(r"(?:x{4,}\b[x ]*|aaaa+ bbbb+(?: c{4,})?|(?:asdf\w*\s*)+)(?:\s.*)?", re.S)
_REPEAT = re.compile(r"(?:0 )?(\w[\w ]*?)(?:[ ,.]+(?:0[ ,.]+)?\1){2,}(?:[ ,.]+0)?", re.S)


def rule_label(fragment: str) -> str | None:
    """Filler by its words: known filler vocabulary, keys held down, one thing said three times."""
    words = fragment.split()
    if len(words) >= 3 and 2 * sum(w.strip(".,;") in FILLER_WORDS for w in words) >= len(words):
        return "filler"
    if _RUN.fullmatch(fragment) or len(words) >= 3 and len(set(words)) <= 4 and _REPEAT.fullmatch(fragment):
        return "filler"
    return None


def bit_counts(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set in each run of ``h``; ``starts`` begin the runs.

    Eight bits are counted at once in the bytes of a word, in pieces of at most 255.
    """
    n = np.diff(np.append(starts, len(h)))
    pieces = -(-n // 255)
    first = np.cumsum(pieces) - pieces
    at = np.repeat(starts, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    ones = np.uint64(0x0101010101010101)
    lanes = [np.add.reduceat((h >> np.uint64(i)) & ones, at).view(np.uint8).reshape(-1, 8) for i in range(8)]
    counts = np.stack(lanes, axis=2).reshape(len(at), 64)
    if len(at) == len(starts):
        return counts.astype(np.int32)
    return np.add.reduceat(counts, first, axis=0, dtype=np.int32)


def simhash(texts: list[str]) -> np.ndarray:
    """64-bit SimHash of each text over its five-character shingles."""
    doc, h = shingle_hashes(texts, SHINGLE)
    out = np.zeros(len(texts), dtype=np.int64)
    if len(doc):
        starts = np.flatnonzero(np.diff(doc, prepend=-1))
        n = np.diff(np.append(starts, len(doc)))
        most = bit_counts(h, starts) * 2 > n[:, None]
        out[doc[starts]] = np.packbits(most, axis=1, bitorder="little").view(np.int64).reshape(-1)
    return out


def frag_hash(texts: list[str]) -> np.ndarray:
    """64-bit identity of each text: two of its shingle sums, mixed."""
    doc, h = shingle_hashes([f"\x02{t}\x03" for t in texts], SHINGLE)
    out = np.zeros(len(texts), dtype=np.uint64)
    if len(doc):
        starts = np.flatnonzero(np.diff(doc, prepend=-1))
        at = np.arange(len(h), dtype=np.uint64) - np.repeat(starts.astype(np.uint64), np.diff(np.append(starts, len(h))))
        with np.errstate(over="ignore"):
            out[doc[starts]] = mix(np.add.reduceat(mix(h + at * np.uint64(0x9E3779B97F4A7C15)), starts))
    return out.view(np.int64)


def _weights() -> np.ndarray:
    """For each table the bits of its key, drawn once for all."""
    rng = np.random.default_rng(64)
    w = np.zeros((64, TABLES), dtype=np.float32)
    for t in range(TABLES):
        w[rng.permutation(64)[:KEY_BITS], t] = 2.0 ** np.arange(KEY_BITS)
    return w


_KEYS = _weights()


def table_keys(sims: np.ndarray) -> np.ndarray:
    """``len(sims)`` x ``TABLES`` keys."""
    bits = np.unpackbits(sims.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return (bits.astype(np.float32) @ _KEYS).astype(np.int32)


class Tables:
    """The labelled fragments of one round in their SimHash tables, for look-up in a task."""

    def __init__(self, texts: list[str], labels: list[str], known: np.ndarray):
        self.texts, self.labels, self.known = texts, labels, np.sort(known)
        self.sims = simhash(texts)
        keys = table_keys(self.sims) + (np.arange(TABLES, dtype=np.int32) << KEY_BITS)
        flat = keys.T.reshape(-1)
        self.order = (np.argsort(flat, kind="stable") % max(1, len(texts))).astype(np.int32)
        self.first = np.searchsorted(np.sort(flat), np.arange((TABLES << KEY_BITS) + 1)).astype(np.int64)

    def near(self, sims: np.ndarray, most: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct (query, labelled) places that share a key and lie within ``HAMMING`` bits."""
        keys = table_keys(sims) + (np.arange(TABLES, dtype=np.int32) << KEY_BITS)
        lo, n = self.first[keys], self.first[keys + 1] - self.first[keys]
        upto = np.cumsum(n.sum(axis=1))
        a = 0
        while a < len(sims):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + most, side="right")))
            m, l = n[a:b].reshape(-1), lo[a:b].reshape(-1)
            q = np.repeat(np.repeat(np.arange(a, b), TABLES), m)
            f = self.order[np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(l, m)]
            ok = np.bitwise_count((sims[q] ^ self.sims[f]).view(np.uint64)) <= HAMMING
            pair = np.unique(q[ok] * np.int64(len(self.sims)) + f[ok])
            if len(pair):
                yield pair // len(self.sims), pair % len(self.sims)
            a = b


_ROWS = "rec_table string, rec_id bigint, inline boolean, rec_hash bigint, frags array<bigint>, sims array<bigint>, texts array<string>, labels array<string>"


def _analyse(seeds: dict[str, str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                texts = part.column(2).to_pylist()
                inline = [bool(FIELD.search(t) or STAND_IN.search(t)) for t in texts]
                frags = [list(dict.fromkeys(fragments(t))) for t in texts]
                flat = [f for fs in frags for f in fs]
                labels = [seeds.get(f) or rule_label(f) for f in flat]
                ids = frag_hash(flat)
                offsets = pa.array(np.cumsum([0, *map(len, frags)], dtype=np.int32))

                def lists(cells: pa.Array) -> pa.ListArray:
                    return pa.ListArray.from_arrays(offsets, cells)

                n = np.array([len(f) for f in frags])
                own = np.repeat(np.arange(len(frags)), n)
                with np.errstate(over="ignore"):
                    whole = np.zeros(len(frags), dtype=np.uint64)
                    np.add.at(whole, own, mix(ids.view(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(inline), pa.array(whole.view(np.int64)), lists(pa.array(ids)), lists(pa.array(simhash(flat))), lists(pa.array(flat, pa.string())), lists(pa.array(labels, pa.string()))],
                    names=["rec_table", "rec_id", "inline", "rec_hash", "frags", "sims", "texts", "labels"],
                )

    return run


_FOUND = pa.schema([("frag", pa.int64()), ("text", pa.string()), ("label", pa.string())])


def _look_up(sent):
    """Rows ``(frags, sims, texts)`` to the fragments near one of the labelled: ``frag, text, label``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: Tables = sent.value
        seen = np.zeros(0, dtype=np.int64)  # judged in this task, so that copies cost one look each
        for b in batches:
            frags = b.column(0).flatten().to_numpy(zero_copy_only=False)
            sims = b.column(1).flatten().to_numpy(zero_copy_only=False)
            texts = b.column(2).flatten()
            once, first = np.unique(frags, return_index=True)
            new = ~np.isin(once, tables.known) & ~np.isin(once, seen)
            once, first = once[new], first[new]
            seen = np.concatenate([seen[-200_000:], once])
            found: dict[int, tuple[int, str, str]] = {}
            for q, f in tables.near(sims[first]):
                mine = texts.take(pa.array(first[q])).to_pylist()
                ok = _jaccards(mine, [tables.texts[i] for i in f], SHINGLE) >= SIMILARITY
                for i in np.flatnonzero(ok).tolist():
                    label, k = tables.labels[f[i]], int(once[q[i]])
                    if k not in found or label < found[k][2]:
                        found[k] = (k, mine[i], label)
            cols = list(zip(*found.values())) if found else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, _FOUND)], schema=_FOUND)

    return run


def _with_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(frag, text)`` to ``frag, text, sim, keys`` (table and key in one number)."""
    for b in batches:
        for lo in range(0, b.num_rows, 5000):
            part = b.slice(lo, 5000)
            sims = simhash(part.column(1).to_pylist())
            keys = table_keys(sims) + (np.arange(TABLES, dtype=np.int32) << KEY_BITS)
            offsets = pa.array(np.arange(0, keys.size + 1, TABLES, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sims), pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1)))], names=["frag", "text", "sim", "keys"])


def _similar(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ok = pa.array(_jaccards(b.column(1).to_pylist(), b.column(2).to_pylist(), SHINGLE) >= SIMILARITY)
        yield pa.RecordBatch.from_arrays([b.column(i).filter(ok) for i in (0, 1, 3)], schema=_FOUND)


def near_copies(rows: DataFrame, new: DataFrame, known: DataFrame, frontier: int = FRONTIER) -> DataFrame:
    """``frag, text, label`` of the unlabelled fragments of ``rows`` near one of ``new``; may repeat.

    ``new(frag, text, label)`` and the identities of ``known`` are sent to the tasks if
    they are at most ``frontier``; otherwise the table keys of both sides are joined.
    """
    spark = rows.sparkSession
    if known.count() <= frontier:
        got = new.select("text", "label").collect()
        ids = np.array([r[0] for r in known.select("frag").collect()], dtype=np.int64)
        sent = spark.sparkContext.broadcast(Tables([r[0] for r in got], [r[1] for r in got], ids))
        return rows.select("frags", "sims", "texts").mapInArrow(_look_up(sent), "frag bigint, text string, label string")
    keyed = "frag bigint, text string, sim bigint, keys array<int>"
    open_ = rows.select(F.explode(F.arrays_zip("frags", "texts")).alias("x")).select(F.col("x.frags").alias("frag"), F.col("x.texts").alias("text"))
    open_ = open_.groupBy("frag").agg(F.min("text").alias("text")).join(known.select("frag"), "frag", "left_anti").mapInArrow(_with_keys, keyed)
    seeds = new.select("frag", "text").mapInArrow(_with_keys, keyed).select(F.col("frag").alias("seed"), F.col("sim").alias("seed_sim"), F.explode("keys").alias("key"))
    pairs = (
        open_.select("frag", "sim", F.explode("keys").alias("key"))
        .join(seeds, "key")
        .filter(F.bit_count(F.col("sim").bitwiseXOR(F.col("seed_sim"))) <= HAMMING)
        .select("frag", "seed")
        .distinct()
    )
    both = pairs.join(new.select(F.col("frag").alias("seed"), F.col("text").alias("seed_text"), "label"), "seed").join(open_.select("frag", "text"), "frag")
    return both.select("frag", "text", "seed_text", "label").mapInArrow(_similar, "frag bigint, text string, label string")


def companions(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``frag, label`` of the unlabelled fragments that stand almost only beside labelled ones.

    Counted over different texts, so that copies of one page count once.
    """
    one = rows.select("rec_hash", F.explode("frags").alias("frag"))
    labelled = one.join(known.select("frag", "label"), "frag").select("rec_hash", F.col("frag").alias("partner"), "label").distinct()
    met = one.join(labelled, "rec_hash").join(known.select("frag"), "frag", "left_anti")
    beside = met.groupBy("frag").agg(F.count_distinct("rec_hash").alias("with_label"), F.count_distinct("partner").alias("partners"), F.min("label").alias("label"))
    beside = beside.filter((F.col("with_label") >= SUPPORT) & (F.col("partners") >= PARTNERS))
    every = one.join(beside.select("frag"), "frag", "left_semi").groupBy("frag").agg(F.count_distinct("rec_hash").alias("n"))
    return beside.join(every, "frag").filter(F.col("with_label") >= SHARE * F.col("n")).select("frag", "label")


def spread(rows: DataFrame, frontier: int = FRONTIER) -> DataFrame:
    """``frag, text, label, how`` of all labelled fragments; ``how``: seed, copy or companion.

    Each round adds at least one fragment, so the rounds end; a written table cuts
    the lineage of each.
    """
    flat = rows.select(F.explode(F.arrays_zip("frags", "texts", "labels")).alias("x")).filter("x.labels is not null")
    known = materialize(flat.groupBy(F.col("x.frags").alias("frag")).agg(F.min("x.texts").alias("text"), F.min("x.labels").alias("label")).withColumn("how", F.lit("seed")), "p4-known")
    new = known
    while True:
        parts = []
        if not new.isEmpty():
            near = near_copies(rows, new.select("frag", "text", "label"), known, frontier)
            parts.append(near.groupBy("frag").agg(F.min("text").alias("text"), F.min("label").alias("label")).withColumn("how", F.lit("copy")))
        beside = companions(rows, known).select("frag", F.lit(None).cast("string").alias("text"), "label", F.lit("companion").alias("how"))
        got = beside if not parts else parts[0].unionByName(beside)
        order = F.when(F.col("how") == "copy", 0).otherwise(1)
        step = got.groupBy("frag").agg(F.min_by(F.struct("text", "label", "how"), F.struct(order, "label", "text")).alias("x")).select("frag", "x.*")
        step = materialize(step.join(known.select("frag"), "frag", "left_anti"), "p4-step")
        if step.isEmpty():
            return known
        last, known = known, materialize(known.unionByName(step), "p4-known")
        discard(last)
        new = step.filter("how = 'copy'")


def residue(records: DataFrame, seeds: dict[str, str] | None = None, frontier: int = FRONTIER) -> DataFrame:
    """``records(rec_table, rec_id, text)`` to the cases ``rec_table, rec_id, how``.

    ``how`` tells what marked the record first: ``field``, ``seed``, ``copy`` or ``companion``.
    """
    some = records.select("rec_table", F.col("rec_id").cast("bigint").alias("rec_id"), "text").filter(F.col("text").rlike(r"\S"))
    rows = materialize(some.mapInArrow(_analyse(seed_labels() if seeds is None else seeds), _ROWS), "p4-rows")
    known = spread(rows, frontier)
    rank = F.when(F.col("how") == "seed", 1).when(F.col("how") == "copy", 2).otherwise(3)
    by_fragment = rows.select("rec_table", "rec_id", F.explode("frags").alias("frag")).join(known.select("frag", rank.alias("rank")), "frag").select("rec_table", "rec_id", "rank")
    by_field = rows.filter("inline").select("rec_table", "rec_id", F.lit(0).alias("rank"))
    name = F.element_at(F.array(*[F.lit(x) for x in ("field", "seed", "copy", "companion")]), F.min("rank") + 1)
    return by_field.unionByName(by_fragment).groupBy("rec_table", "rec_id").agg(name.alias("how"))


def article_records(articles: DataFrame) -> DataFrame:
    return articles.select(F.lit("articles").alias("rec_table"), F.col("article_id").alias("rec_id"), F.col("snippet").alias("text"))


def p4_found(articles: DataFrame, items: DataFrame) -> DataFrame:
    raw = items.select(F.lit("raw_items").alias("rec_table"), F.col("item_id").alias("rec_id"), F.col("summary").alias("text"))
    return residue(article_records(articles).unionByName(raw)).select("rec_table", "rec_id")
