"""Cutting oversized texts at natural boundaries by structure-tree packing (problem 9).

A text is read as a tree: sections under their headings (Markdown, HTML, wiki,
LaTeX), then blocks. A paragraph, a list, a table and a piece of fenced code is one
block each; a list has its items as children and nested items below them, a table
its rows, code its paragraphs and lines. Below come sentences, clauses, words, and at
the bottom the token borders between two characters. A node is cut into its children
only if it is larger than the limit; sibling subtrees are merged from the bottom up as
long as they fit together. Each piece after the first starts with the last ``overlap``
tokens of the piece before, which may reach into that piece's own overlap.

Sizes are counted on the real tokens: a prefix sum over the pretokens of the
text, with the borders inside a pretoken where one has to be cut. The start of an
overlap is the border between characters whose text, encoded by itself, comes nearest
to the stated number of tokens. Every piece is encoded again by itself; if its new
context made it longer than the limit, its core gives up its end, which goes to the
next piece. Only a core of a single character gives up overlap instead.

Defined results: NULL and empty texts and texts within the limit give no rows;
repeated rows are each cut; the pieces' cores (``core_start`` to ``end_char``)
join to the whole text exactly.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelake.llm import tokenizer

_HEADING = re.compile(
    r"(?im)^[ \t]*(?:(?P<md>#{1,6})[ \t]+\S|(?P<wiki>={2,6})[^=\n]+=+[ \t]*$|\\(?P<tex>(?:sub){0,2}section|chapter|part)\*?\{|<h(?P<html>[1-6])\b)|<h(?P<mid>[1-6])\b"
)
_SIGNS = re.compile(r"[#\\]|==|<[hH][1-6]")
_TEX = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4}
_FENCE = re.compile(r"(?m)^[ \t]*(?:```|~~~)")
# blocks of more than one line that are one node each
_ATOMS = [
    re.compile(r"(?ms)^[ \t]*(```|~~~)[^\n]*\n.*?(?:^[ \t]*\1[^\n]*(?:\n|\Z)|\Z)"),
    re.compile(r"(?is)<(table|ul|ol|pre)\b[^>]*>.*?</\1\s*>\n?"),
    re.compile(r"(?s)\\begin\{(itemize|enumerate|description|tabular|verbatim|equation|align)\*?\}.*?\\end\{\1\*?\}\n?"),
    re.compile(r"(?m)(?:^[ \t]*(?:[-*+\u2022]|\d{1,3}[.)])[ \t]+\S[^\n]*(?:\n|\Z)(?:^[ \t]+\S[^\n]*(?:\n|\Z))*){2,}"),
    re.compile(r"(?m)(?:^[ \t]*(?:\{\||\||!)[^\n]*(?:\n|\Z)){2,}"),
]
_ATOM_SIGNS = re.compile(r"```|~~~|<(?:table|ul|ol|pre)\b|\\begin|^[ \t]*(?:[-*+\u2022|!]|\d{1,3}[.)])", re.M | re.I)
_ITEM = re.compile(r"(?m)^([ \t]*)(?:[-*+\u2022]|\d{1,3}[.)]|\\item\b)[ \t]*(?=\S)|<li\b", re.I)
# what ends a child, level by level below the sections and list items
_BLANK = re.compile(r"\n[ \t\r]*\n\s*|</(?:p|div|ul|ol|table|pre|blockquote|section)>", re.I)
_ENDS = [
    _BLANK,
    re.compile(r"\r\n|[\n\r\u2028\u2029]|</(?:li|tr|dd|dt)>|<br ?/?>", re.I),
    re.compile(r"[.!?…؟]+[\"'”’»)\]]*\s+|[。！？]+[”’」』）]*"),
    re.compile(r"[,;:—،؛]\s+|[，；：、]"),
    re.compile(r"\s+"),
]
_SECTIONS, _ITEMS = 6, 3  # levels of headings, of nested list items
_BLOCKS, _PARTS = _SECTIONS, _SECTIONS + 1 + _ITEMS
_WORDS, _BORDERS = _PARTS + 4, _PARTS + 5


class Tree:
    """The nested cut positions of one text, found level by level as they are needed."""

    def __init__(self, text: str, tok: tokenizer.Tokenizer):
        self.text, self.tok = text, tok
        self.words = tok.find(text)  # the pretokens tile the text
        self.at = [0, *accumulate(map(len, self.words))]
        self.sum = [0, *accumulate(map(tok.count_of.__getitem__, self.words))]
        self._inside: dict[int, tuple[list[int], list[int]]] = {}
        self._heads: list[tuple[int, int]] | None = None
        self._atoms: list[tuple[int, int]] | None = None

    @property
    def heads(self) -> list[tuple[int, int]]:
        """(position, level) of headings outside fenced code."""
        if self._heads is None:
            self._heads = []
            if _SIGNS.search(self.text):
                fences = [m.start() for m in _FENCE.finditer(self.text)]
                for m in _HEADING.finditer(self.text):
                    if bisect_right(fences, m.start()) % 2:
                        continue
                    if m["tex"]:
                        level = _TEX[m["tex"].lower()]
                    elif m["html"] or m["mid"]:
                        level = int(m["html"] or m["mid"])
                    else:
                        level = len(m["md"] or m["wiki"])
                    self._heads.append((m.start(), level))
        return self._heads

    @property
    def atoms(self) -> list[tuple[int, int]]:
        """Spans of lists, tables and code, in order and apart; code and tags go before plain lines."""
        if self._atoms is None:
            self._atoms = []
            if _ATOM_SIGNS.search(self.text):
                for pattern in _ATOMS:
                    for m in pattern.finditer(self.text):
                        k = bisect_right(self._atoms, (m.start(), m.end()))
                        if (not k or self._atoms[k - 1][1] <= m.start()) and (k == len(self._atoms) or m.end() <= self._atoms[k][0]):
                            self._atoms.insert(k, m.span())
        return self._atoms

    def blocks(self, lo: int, hi: int) -> list[int]:
        """Ends of paragraphs outside lists, tables and code, and the borders of these."""
        atoms = self.atoms
        out = {m.end() for m in _BLANK.finditer(self.text, lo, hi)}
        if atoms:
            starts = [x for x, _ in atoms]
            k = max(0, bisect_right(starts, lo) - 1)
            near = [x for x in atoms[k : bisect_right(starts, hi)] if x[1] > lo]
            out = {p for p in out if not any(x < p < y for x, y in near)} if len(near) < 4 else {p for p in out if not self._within(p, starts)}
            out |= {p for x in near for p in x}
        return sorted(out)

    def _within(self, pos: int, starts: list[int]) -> bool:
        k = bisect_right(starts, pos) - 1
        return k >= 0 and self.atoms[k][0] < pos < self.atoms[k][1]

    def items(self, lo: int, hi: int) -> list[int]:
        """Starts of the outermost list items in the span, if it lies in a list."""
        atoms = self.atoms
        k = bisect_right(atoms, (lo, len(self.text) + 1)) - 1
        if k < 0 or atoms[k][1] <= lo:
            return []
        found = [(len((m[1] or "").expandtabs(4)), m.start()) for m in _ITEM.finditer(self.text, lo, min(hi, atoms[k][1])) if m.start() > lo]
        least = min((n for n, _ in found), default=0)
        return [p for n, p in found if n == least]

    def inside(self, k: int) -> tuple[list[int], list[int]]:
        """Characters, and tokens before them, at the borders of pretoken ``k`` that lie between characters."""
        if k not in self._inside:
            w = self.words[k]
            chars, n = {0: 0}, 0
            for i, c in enumerate(w):
                n += len(c.encode("utf-8", "surrogatepass"))
                chars[n] = i + 1
            at, before, n = [], [], 0
            for j, t in enumerate(self.tok.bpe.word(w)):
                if n in chars:
                    at.append(self.at[k] + chars[n])
                    before.append(j)
                n += self.tok.bpe.size[t]
            self._inside[k] = at, before
        return self._inside[k]

    def tokens_to(self, pos: int) -> int:
        k = bisect_right(self.at, pos) - 1
        n = self.sum[k]
        if pos > self.at[k]:
            at, before = self.inside(k)
            n += before[bisect_right(at, pos) - 1]
        return n

    def size(self, lo: int, hi: int) -> int:
        """Tokens of the span when it is encoded by itself."""
        piece = self.text[lo:hi]
        body = lo + len(piece.rstrip())
        i, j = bisect_left(self.at, lo), bisect_left(self.at, body)
        if self.at[i] != lo or self.at[j] != body or body <= lo:
            return self.tok.count(piece)
        # whole pretokens; only the white space at the end is read anew, as what follows it is gone
        return self.sum[j] - self.sum[i] + (self.tok.count(self.text[body:hi]) if body < hi else 0)

    def cuts(self, level: int, lo: int, hi: int) -> list[int]:
        """Inner positions where a node of this level may be cut."""
        if level < _SECTIONS:
            return [p for p, lv in self.heads if lv == level + 1 and lo < p < hi]
        if level == _BLOCKS:
            return [p for p in self.blocks(lo, hi) if lo < p < hi]
        if level < _PARTS:
            return [p for p in self.items(lo, hi) if lo < p < hi]
        if level < _BORDERS:
            found = (m.start() if level == _WORDS else m.end() for m in _ENDS[level - _PARTS].finditer(self.text, lo, hi))
            return [p for p in found if lo < p < hi]
        a, b = bisect_right(self.at, lo) - 1, bisect_left(self.at, hi)
        return [c for k in range(a, b) for c in self.inside(k)[0] if lo < c < hi]

    def pack(self, lo: int, hi: int, limit: int, level: int = 0) -> list[tuple[int, int]]:
        """Spans within the limit that cover lo to hi: subtrees merged bottom-up."""
        if self.tokens_to(hi) - self.tokens_to(lo) <= limit:
            return [(lo, hi)]
        cuts: list[int] = []
        while not cuts:
            if level > _BORDERS:
                return [(lo, hi)]
            cuts, level = self.cuts(level, lo, hi), level + 1
        edges = [lo, *cuts, hi]
        cum = [self.tokens_to(p) for p in edges]
        out: list[tuple[int, int]] = []
        first = None  # start of the run of siblings that is being merged
        for i in range(len(edges) - 1):
            if cum[i + 1] - cum[i] > limit:
                if first is not None:
                    out.append((edges[first], edges[i]))
                    first = None
                out += self.pack(edges[i], edges[i + 1], limit, level)
            elif first is None:
                first = i
            elif cum[i + 1] - cum[first] > limit:
                out.append((edges[first], edges[i]))
                first = i
        if first is not None:
            out.append((edges[first], hi))
        return self.merged(out, limit)

    def merged(self, spans: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
        """Neighbours joined while they fit, across the borders of cut children too."""
        out: list[tuple[int, int]] = []
        for lo, hi in spans:
            if out and self.tokens_to(hi) - self.tokens_to(out[-1][0]) <= limit:
                out[-1] = (out[-1][0], hi)
            else:
                out.append((lo, hi))
        return out

    def back(self, pos: int, tokens: int, least: int) -> int:
        """The position up to ``tokens`` tokens before ``pos``, not before ``least``."""
        if tokens <= 0:
            return pos
        want = self.tokens_to(pos) - tokens
        k = bisect_left(self.sum, want)
        best = self.at[k]
        if k and self.sum[k] > want:
            at, before = self.inside(k - 1)
            j = bisect_left(before, want - self.sum[k - 1])
            best = at[j] if j < len(at) else best
        return min(pos, max(best, least))


def overlap_start(tree: Tree, core: int, overlap: int, least: int) -> int:
    """Where ``overlap`` tokens end at ``core``, counted on the overlap by itself."""
    ask, best = overlap, (overlap + 1, core)
    for _ in range(4):
        at = tree.back(core, ask, least)
        off = tree.tok.count(tree.text[at:core]) - overlap
        best = min(best, (abs(off), at))
        if off == 0 or at == least and off < 0:
            break
        ask = max(1, ask - off)
    return best[1]


def split_text(text: str, tok: tokenizer.Tokenizer, limit: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """(start, core start, end, tokens) of each piece; nothing if the text is within the limit."""
    tree = Tree(text, tok)
    if tree.sum[-1] <= limit:
        return []
    room = max(1, limit - overlap)
    todo = tree.pack(0, len(text), room)[::-1]
    out: list[tuple[int, int, int, int]] = []
    while todo:
        core, end = todo.pop()
        start = overlap_start(tree, core, overlap, out[-1][0]) if out and overlap else core
        n = tree.size(start, end)
        if n > limit and end - core > 1:
            inner = tree.pack(core, end, max(1, tree.tokens_to(end) - tree.tokens_to(core) - (n - limit)))
            if len(inner) == 1:
                inner = [(core, (core + end) // 2), ((core + end) // 2, end)]
            if todo and tree.tokens_to(todo[-1][1]) - tree.tokens_to(inner[-1][0]) <= room:
                inner[-1] = (inner[-1][0], todo.pop()[1])  # the end goes to the next piece
            todo += inner[::-1]
            continue
        while n > limit and start < core:
            start += 1
            n = tree.size(start, end)
        out.append((start, core, end, n))
    return out


def p9_pieces(docs: DataFrame, limits: DataFrame, task: str, folder: str = tokenizer.TOKENIZER_DIR) -> DataFrame:
    """Pieces of the texts above the task's limit.

    ``doc_id, piece_no, start_char, core_start, end_char, n_tokens, piece``.
    """
    lim = limits.filter(F.col("task") == task).first()
    limit, overlap = int(lim["max_tokens"]), int(lim["overlap_tokens"])
    get = tokenizer.worker_tokenizer(docs.sparkSession, lim["tokenizer"], folder)
    schema = pa.schema([("doc_id", pa.int64()), ("piece_no", pa.int32()), ("start_char", pa.int32()), ("core_start", pa.int32()), ("end_char", pa.int32()), ("n_tokens", pa.int32()), ("piece", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = get()
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if text:
                        rows += [(doc, i, s, c, e, n, text[s:e]) for i, (s, c, e, n) in enumerate(split_text(text, tok, limit, overlap))]
                cols = list(zip(*rows)) if rows else [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    # a text has at least as many bytes as tokens, so shorter ones needn't be read in Python
    long = docs.select(F.col("doc_id").cast("bigint"), "text").filter(F.octet_length("text") > limit)
    return long.mapInArrow(run, "doc_id bigint, piece_no int, start_char int, core_start int, end_char int, n_tokens int, piece string")
