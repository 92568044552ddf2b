"""Markup residue to clean text, with page differencing (problem 2).

Each text is converted from HTML, Markdown, wiki or LaTeX to plain text that keeps
headings (``# ``), lists (``- ``), code (fenced) and formulas (``$``). A page is the
records of one URL path; its neighbour is the page of the same host, next before or
next after it in path order, whose path has more leading characters in common (the one
before, if both have as many). The clean lines of a record and of its neighbour page
are aligned by their longest common subsequence; shared lines are the site's and not
the page's, and are deleted. Lines of structure (fences, blank lines) and of code are
never deleted, and nothing is deleted where nothing else would be left: such a record
is a copy of its neighbour.

What differencing can't do is tell markup from prose, so the kinds of markup come
from the conversion's own patterns, over the whole raw text, shared lines too.

Neighbours are found on the keys alone, in range partitions whose borders are then
joined, so the result is the same for any number of partitions; texts meet their
neighbour's line hashes in a join that adaptive execution splits where a path is hot.

Defined results: NULL, empty and blank texts hold no markup and give empty clean
text; a NULL or unreadable URL has no host and no neighbour; of several records of a
path the first by table and id stands for the page; repeated rows are kept; rows with
a NULL id are kept.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelake.session import materialize

# Element and command names that count as markup.
_ENTITY = r"&(?:[A-Za-z][A-Za-z0-9]{1,31}|#\d{1,7}|#[xX][0-9A-Fa-f]{1,6});"
_COMMANDS = "item|section|subsection|emph|textbf|textit|cite|ref|label|href|url|frac|sqrt|sum|int|times|cdot|leq|geq|Delta|alpha|beta|mathrm|begin|end|footnote|caption|hline|par|quad|left|right|text"
KINDS = {
    "html": re.compile(rf"</?[A-Za-z][A-Za-z0-9:-]*(?:\s[^<>]*)?/?>|<!--|-->|<!\[CDATA\[|\]\]>|<!DOCTYPE|<\?xml|{_ENTITY}|<[a-z]+\s[^<>]*$"),
    "markdown": re.compile(
        r"(?m)^ {0,3}#{1,6}[ \t]+\S|^ {0,3}>(?:[ \t]|$)|^[ \t]*(?:```|~~~)|`[^`\n]+`|~~\S[^~\n]*~~"
        r"|(?<![\w*])\*\*(?=\S)[^*\n]+\*\*|(?<![A-Za-z0-9_])__(?=[^\s_])[^_\n]+__(?![A-Za-z0-9_])"
        r"|(?<![A-Za-z0-9*\\])\*(?=[^\s*])[^*\n]*[^\s*]\*(?![A-Za-z0-9*])|(?<![A-Za-z0-9_\\])_(?=[^\s_])[^_\n]*[^\s_]_(?![A-Za-z0-9_])"
        r"|!?\[[^\]\n]*\]\((?:https?:|/|#|mailto:)[^)\n]*\)|^\[[^\]\n]+\]:\s*\S+|^ {0,3}(?:-{3,}|\*{3,}|_{3,})[ \t]*$"
        r"|^\|.*\|[ \t]*\n\|[ :|-]*-{2,}[ :|-]*\|?|^[ \t]*[*+][ \t]+\S|^[ \t]*-[ \t]+\S.*\n+[ \t]*-[ \t]+\S|^[ \t]*\d{1,3}[.)][ \t]+\S.*\n+[ \t]*\d{1,3}[.)][ \t]+\S|^={3,}[ \t]*$"
        r"|\*\*(?=\S)[^*\n]+\S\*\*"
    ),
    "wiki": re.compile(
        r"(?m)'''?(?=\S)[^'\n]+'{2,3}|\[\[[^\[\]\n]+\]\]|^={2,6}[^=\n]+={2,6}[ \t]*$|^\{\||^\|\}|^\|-|\[https?://[^\s\]]+ [^\]\n]+\]|\{\{[^{}\n]*\|[^{}]*\}\}|^[#*:;]+[ \t]*\[\["
        r"|__(?:TOC|NOTOC|FORCETOC)__|<nowiki>|<ref\b"
    ),
    "latex": re.compile(
        rf"\\(?:begin|end)\{{|\\(?:{_COMMANDS})\b|\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{{|\$\$|\$(?=[A-Za-z\\({{|+-])[^$\n]*(?:\\[A-Za-z]|[\^_]\{{)[^$\n]*\$|\\\[|\\\(|\\\\[ \t]*$", re.M
    ),
}
_ANY = re.compile(r"[<&*_#`~\[|\\^{]|''|==|(?m:^[ \t]*(?:>|-{2,}|[+-][ \t]|\d{1,3}[.)][ \t]))|\$\$|\]\]>|-->")
# an unfilled template field is no markup (problem 4 has those)
_FIELD = re.compile(r"\{\{[^{}|\n]{1,60}\}\}|\{%[^%\n]{1,60}%\}|[$#]\{[A-Za-z_][\w.]*\}|%%\w+%%|@@\w+@@|%\(\w+\)s")


def kinds(text: str | None) -> list[str]:
    """The kinds of markup that ``text`` holds."""
    if not text or not _ANY.search(text):
        return []
    if "{" in text or "%%" in text or "@@" in text:
        text = _FIELD.sub(" ", text)
    return [k for k, p in KINDS.items() if p.search(text)]


_DROP = re.compile(r"<(script|style|noframes)\b[^>]*>.*?</\1\s*>|<!--.*?(?:-->|\Z)|<!DOCTYPE[^>]*>|<\?xml[^>]*>", re.S | re.I)
_CDATA = re.compile(r"<!\[CDATA\[(.*?)\]\]>", re.S)
_PRE = re.compile(r"<pre\b[^>]*>\s*(?:<code\b[^>]*>)?(.*?)(?:</code>\s*)?</pre\s*>", re.S | re.I)
_FENCED = re.compile(r"(?ms)^[ \t]*(```|~~~)[^\n]*\n(.*?)^[ \t]*\1[ \t]*$")
_ESCAPED = re.compile(r"&lt;/?[A-Za-z!][^<>]{0,300}?&gt;")
_TAG = re.compile(r"<[^<>]*>")
_NAME = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)")
_INLINE = frozenset("a abbr b big cite code del em font i img ins kbd mark nobr q s samp small span strike strong sub sup time tt u var wbr".split())


def _tag(m: re.Match) -> str:
    n = _NAME.match(m[0])
    if not n:
        return " " if m[0][1:2] in "!?/" else m[0]
    name = n[2].lower()
    if name in _INLINE:
        return ""
    if not n[1]:
        if len(name) == 2 and name[0] == "h" and name[1] in "123456":
            return "\n\n" + "#" * int(name[1]) + " "
        if name == "li":
            return "\n- "
        if name in ("td", "th"):
            return " | "
    elif len(name) == 2 and name[0] == "h" and name[1] in "123456" or name in ("p", "ul", "ol", "table", "blockquote"):
        return "\n\n"
    return "" if name in ("td", "th") else "\n"


def _from_html(t: str) -> str:
    t = _CDATA.sub(r"\1", t)
    for _ in range(2):
        if _ESCAPED.search(t):
            t = html.unescape(t)
    t = _DROP.sub(" ", t)
    if "<" in t:
        t = _TAG.sub(_tag, t)
    return html.unescape(t) if "&" in t else t


_WIKI = [
    (re.compile(r"(?m)^(={2,6})[ \t]*([^=\n]+?)[ \t]*={2,6}[ \t]*$"), lambda m: "#" * len(m[1]) + " " + m[2]),
    (re.compile(r"(?m)^\{\|.*$|^\|\}[ \t]*$|^\|-.*$"), ""),
    (re.compile(r"(?m)^[!|](?![|}-])[ \t]*(.+)$"), lambda m: m[0] if m[0].rstrip().endswith("|") else "| " + re.sub(r"\s*(?:!!|\|\|)\s*", " | ", m[1]) + " |"),
    (re.compile(r"\[\[(?:[Cc]ategor\w*|[Ff]ile|[Ii]mage|[Ff]icheiro|[Aa]rchivo):[^\]]*\]\]"), ""),
    (re.compile(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]*)\]\]"), r"\1"),
    (re.compile(r"\[https?://\S+ ([^\]\n]+)\]"), r"\1"),
    (re.compile(r"\{\{[^{}\n]*\|[^{}]*\}\}|__(?:TOC|NOTOC|FORCETOC)__"), ""),
    (re.compile(r"'{2,5}(?=\S)([^'\n]+)'{2,5}"), r"\1"),
    (re.compile(r"(?m)^\*+[ \t]*(?=[^*\s])(?![^*\n]*\*(?:\W|$))"), "- "),
    (re.compile(r"(?m)^#(?=[ \t]*\S)(?= \S*?$)"), "- "),
]
_LATEX = [
    (re.compile(r"\\begin\{(?:equation|align|displaymath)\*?\}\s*(.*?)\s*\\end\{(?:equation|align|displaymath)\*?\}", re.S), r"\n$$\1$$\n"),
    (re.compile(r"\\\[(.*?)\\\]", re.S), r"$$\1$$"),
    (re.compile(r"\\\((.*?)\\\)", re.S), r"$\1$"),
]
_LATEX_TEXT = [
    (re.compile(r"\\((?:sub){0,2})section\*?\{([^{}]*)\}"), lambda m: "\n" + "#" * (1 + len(m[1]) // 3) + " " + m[2] + "\n"),
    (re.compile(r"\\href\{[^{}]*\}\{([^{}]*)\}"), r"\1"),
    (re.compile(r"~?\\(?:cite|label|ref|footnote)[pt]?\{[^{}]*\}"), ""),
    (re.compile(r"\\(?:begin|end)\{[^{}]*\}(?:\{[^{}]*\}|\[[^\]]*\])?"), "\n"),
    (re.compile(r"\s*\\item\b[ \t]*"), "\n- "),
    (re.compile(r"(?m)^(.*&.*?)[ \t]*\\\\[ \t]*$"), lambda m: "| " + re.sub(r"\s*(?<!\\)&\s*", " | ", m[1].strip()) + " |"),
    (re.compile(r"\\[A-Za-z]+\*?\{([^{}]*)\}"), r"\1"),
    (re.compile(r"\\\\[ \t]*$", re.M), ""),
    (re.compile(r"\\([%&$#_{}])"), r"\1"),
]
_MARKDOWN = [
    (re.compile(r"!?\[([^\]\n]*)\]\([^)\n]*\)"), r"\1"),
    (re.compile(r"(?m)^\[[^\]\n]+\]:\s*\S+.*$"), ""),
    (re.compile(r"(?m)^ {0,3}>[ \t]?"), ""),
    (re.compile(r"(?m)^\|?[ :|-]*-{3,}[ :|-]*\|?[ \t]*$|^ {0,3}(?:\*{3,}|_{3,})[ \t]*$"), ""),
    (re.compile(r"\*\*(?=\S)([^*\n]+)\*\*|(?<![A-Za-z0-9_])__(?=[^\s_])([^_\n]+)__(?![A-Za-z0-9_])|~~(?=\S)([^~\n]+)~~"), lambda m: m[1] or m[2] or m[3]),
    (re.compile(r"(?<![A-Za-z0-9*\\])\*(?=[^\s*])([^*\n]*[^\s*])\*(?![A-Za-z0-9*])|(?<![A-Za-z0-9_\\])_(?=[^\s_])([^_\n]*[^\s_])_(?![A-Za-z0-9_])"), lambda m: m[1] or m[2]),
    (re.compile(r"`([^`\n]+)`"), r"\1"),
    (re.compile(r"(?m)^([ \t]*)[*+][ \t]+(?=\S)"), r"\1- "),
]
_MATH = re.compile(r"\$\$.*?\$\$|\$(?=[A-Za-z\\({|+-])[^$\n]*(?:\\[A-Za-z]|[\^_]\{)[^$\n]*\$", re.S)
_KEPT = re.compile("\ue000(\\d+)\ue001")


def clean(text: str | None, found: list[str]) -> str:
    """Plain text of ``text``, of which ``found`` are the kinds of markup."""
    if not text or not text.strip():
        return ""
    t = text.replace("\r\n", "\n").replace("\r", "\n").replace("\ue000", "").replace("\ue001", "")
    kept: list[str] = []

    def keep(s: str) -> str:
        kept.append(s)
        return f"\ue000{len(kept) - 1}\ue001"

    def apply(rules: list, t: str) -> str:
        for p, r in rules:
            t = p.sub(r, t)
        return t

    if found:
        t = _FENCED.sub(lambda m: "\n" + keep("```\n" + m[2].rstrip("\n") + "\n```"), t)
        if "html" in found:
            t = _PRE.sub(lambda m: "\n" + keep("```\n" + html.unescape(_TAG.sub("", m[1])).strip("\n") + "\n```") + "\n", t)
            t = _from_html(t)
        if "latex" in found:
            t = apply(_LATEX, t)
            t = _MATH.sub(lambda m: keep(m[0]), t)
            t = apply(_LATEX_TEXT, t)
        if "wiki" in found:
            t = apply(_WIKI, t)
        if "markdown" in found or "wiki" in found:
            t = apply(_MARKDOWN, t)
    lines, blank = [], True
    for line in t.split("\n"):
        line = re.sub(r"[ \t\xa0]+", " ", line).strip() if "\ue000" not in line else line.strip()
        if line or not blank:
            lines.append(line)
        blank = not line
    t = "\n".join(lines).strip()
    return _KEPT.sub(lambda m: kept[int(m[1])], t) if kept else t


def _lengths(a: list, b: list) -> np.ndarray:
    """Lengths of the longest common subsequence of ``a`` with each prefix of ``b``, bit-parallel."""
    at: dict = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & at.get(x, 0)
        v = (v + u | v - u) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), dtype=np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _halves(a: list, b: list, lo: int, out: list[int]) -> None:
    """Appends the positions (plus ``lo``) of a common subsequence in ``a``, in linear space."""
    if not a or not b:
        return
    if len(a) == 1:
        if a[0] in b:
            out.append(lo)
        return
    mid = len(a) // 2
    cut = int(np.argmax(_lengths(a[:mid], b) + _lengths(a[mid:][::-1], b[::-1])[::-1]))
    _halves(a[:mid], b[:cut], lo, out)
    _halves(a[mid:], b[cut:], lo + mid, out)


def common_lines(a: list, b: list) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b`` (equal ends first)."""
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    ea, eb = len(a), len(b)
    while ea > lo and eb > lo and a[ea - 1] == b[eb - 1]:
        ea, eb = ea - 1, eb - 1
    out = [*range(lo), *range(ea, len(a))]
    both = set(a[lo:ea]) & set(b[lo:eb])
    if both:
        # only lines that occur on both sides can be part of the subsequence
        x = [i for i in range(lo, ea) if a[i] in both]
        found: list[int] = []
        _halves([a[i] for i in x], [s for s in b[lo:eb] if s in both], 0, found)
        out += [x[i] for i in found]
    return sorted(out)


_STRUCTURE = re.compile(r"\s*(?:```.*|~~~.*)?\s*\Z")


def without_shared(lines: list[str], mine: list, other: list) -> tuple[list[str], int]:
    """``lines`` (told apart by ``mine``) less those shared with ``other``, and how many went."""
    if not other or not set(mine) & set(other):
        return lines, 0
    shared = set(common_lines(mine, other))
    code, out, gone, own = False, [], 0, False
    for i, s in enumerate(lines):
        structure = bool(_STRUCTURE.match(s))
        if s.lstrip().startswith("```"):
            code = not code
        if i in shared and not structure and not code:
            gone += 1
        else:
            out.append(s)
            own = own or not structure
    return (out, gone) if own else (lines, 0)


def line_hashes(lines: list[str]) -> list[int]:
    """What tells lines apart in the alignment; blank ones are all alike."""
    return [int.from_bytes(hashlib.blake2b(s.strip().encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) for s in lines]


_CLEANED = "host string, path string, rec_table string, rec_id bigint, kinds array<string>, clean string, hashes array<bigint>"
_CLEANED_ARROW = pa.schema([("host", pa.string()), ("path", pa.string()), ("rec_table", pa.string()), ("rec_id", pa.int64()), ("kinds", pa.list_(pa.string())), ("clean", pa.string()), ("hashes", pa.list_(pa.int64()))])


def _convert(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 1000):
            part = b.slice(lo, 1000)
            texts = part.column(4).to_pylist()
            found = [kinds(t) for t in texts]
            plain = [clean(t, ks) for t, ks in zip(texts, found)]
            hashes = [line_hashes(t.split("\n")) for t in plain]
            new = (pa.array(x, f.type) for x, f in zip((found, plain, hashes), list(_CLEANED_ARROW)[4:]))
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(4)), *new], schema=_CLEANED_ARROW)


def _common(path, other):
    """How many leading characters two path columns share; other paths differ somewhere."""
    same = F.zip_with(F.split(path, ""), F.split(other, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.coalesce(F.array_position(same, F.lit(False)), F.lit(0))


_LINK = "part int, edge string, host string, path string, before string, after string"
_LINK_ARROW = pa.schema([("part", pa.int32()), ("edge", pa.string()), ("host", pa.string()), ("path", pa.string()), ("before", pa.string()), ("after", pa.string())])


def _linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted keys with the keys before and after them; ``edge`` marks the ends of the partition."""
    part = TaskContext.get().partitionId()
    held, first = None, True  # the key that waits for the one after it
    for b in batches:
        rows = []
        for key in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if held is not None:
                rows.append((part, "first" if first else None, *held[:2], held[2], key[1] if key[0] == held[0] else None))
                first = False
            held = (*key, held[1] if held is not None and held[0] == key[0] else None)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _LINK_ARROW)], schema=_LINK_ARROW)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((part, "both" if first else "last", *held, None), _LINK_ARROW)], schema=_LINK_ARROW)


def neighbours(keys: DataFrame, parts: int | None = None) -> DataFrame:
    """Distinct ``keys(host, path)`` to ``host, path, other``: the neighbour's path, if the host has one."""
    order = ["host", "path"]
    ranged = keys.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    linked = materialize(ranged.mapInArrow(_linked, _LINK), "p2-links")
    # two rows a partition: the borders, in order
    edges = linked.filter("edge is not null").select("part", "edge", "host", "path").orderBy("host", "path").collect()
    fixed = {}
    for x, y in zip(edges, edges[1:]):
        if x["part"] != y["part"] and x["host"] == y["host"]:
            fixed.setdefault((x["host"], x["path"]), [None, None])[1] = y["path"]
            fixed.setdefault((y["host"], y["path"]), [None, None])[0] = x["path"]
    rows = [(*k, *v) for k, v in fixed.items()]
    fix = keys.sparkSession.createDataFrame(rows, "host string, path string, b string, a string")
    whole = linked.filter("edge is null").select("host", "path", "before", "after").unionByName(
        linked.filter("edge is not null").join(F.broadcast(fix), order, "left").select("host", "path", F.coalesce("before", "b").alias("before"), F.coalesce("after", "a").alias("after"))
    )
    common = _common(F.col("path"), F.col("after")) > _common(F.col("path"), F.col("before"))
    other = F.when(F.col("before").isNull() | (F.col("after").isNotNull() & common), F.col("after")).otherwise(F.col("before"))
    return whole.select("host", "path", other.alias("other")).filter("other is not null")


_OUT = "rec_table string, rec_id bigint, kinds array<string>, shared_lines int, clean string"
_OUT_ARROW = pa.schema([("rec_table", pa.string()), ("rec_id", pa.int64()), ("kinds", pa.list_(pa.string())), ("shared_lines", pa.int32()), ("clean", pa.string())])


def _difference(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, mine, others = (b.column(i).to_pylist() for i in (3, 4, 5))
        done = [without_shared(t.split("\n"), m, o) if o else (None, 0) for t, m, o in zip(texts, mine, others)]
        plain = [t if lines is None else "\n".join(lines).strip() for t, (lines, _) in zip(texts, done)]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array([n for _, n in done], pa.int32()), pa.array(plain, pa.string())], schema=_OUT_ARROW)


def difference(records: DataFrame, parts: int | None = None) -> DataFrame:
    """``records(rec_table, rec_id, url, text)`` to ``rec_table, rec_id, kinds, shared_lines, clean``."""
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:www\.)?([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:www\.)?([^/?#]*)([^?#]*?)/*(?:[?#].*)?$", 2)
    pages = records.select(F.lower(host).alias("host"), path.alias("path"), "rec_table", F.col("rec_id").cast("bigint").alias("rec_id"), "text")
    pages = materialize(pages.mapInArrow(_convert, _CLEANED), "p2-clean")
    first = pages.filter("host <> ''").groupBy("host", "path").agg(F.min_by("hashes", F.struct("rec_table", "rec_id", "hashes")).alias("hashes"))
    first = materialize(first, "p2-pages")
    link = neighbours(first.select("host", "path"), parts)
    other = link.join(first.select("host", F.col("path").alias("other"), F.col("hashes").alias("theirs")), ["host", "other"]).select("host", "path", "theirs")
    both = pages.join(other, ["host", "path"], "left").select("rec_table", "rec_id", "kinds", "clean", "hashes", "theirs")
    return both.mapInArrow(_difference, _OUT)


def both_tables(articles: DataFrame, items: DataFrame) -> DataFrame:
    a = articles.select(F.lit("articles").alias("rec_table"), F.col("article_id").alias("rec_id"), "url", F.col("snippet").alias("text"))
    return a.unionByName(items.select(F.lit("raw_items").alias("rec_table"), F.col("item_id").alias("rec_id"), "url", F.col("summary").alias("text")))


def p2_clean(articles: DataFrame, items: DataFrame) -> DataFrame:
    return difference(both_tables(articles, items))


def p2_found(articles: DataFrame, items: DataFrame) -> DataFrame:
    return p2_clean(articles, items).filter(F.size("kinds") > 0).select("rec_table", "rec_id")
