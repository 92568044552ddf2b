"""HTML extraction: a small tree over the standard library's parser, as Arrow UDFs.

Only what needs the tree is done in Python (paragraphs, selectors, meta data,
listing hints); cleaning and cutting of the results are column expressions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements and class or id parts that never hold article text.
NOISE_TAGS = frozenset("figure figcaption aside script style iframe form nav".split())
NOISE_PARTS = (
    "advertisement", "publicidade", "newsletter", "related", "relacionad", "leia-tambem", "leia-mais", "recomend", "share-", "social-share",
    "tags-list", "author-box", "byline", "sponsor", "subscribe", "breadcrumb", "comments", "content-ads", "tag-manager-publicidade",
    "read-more", "mc-read-more", "recommend-theme", "box-seja-assinante", "seja-assinante", "assine-", "paywall-wrap", "subscription", "premium-content-wall",
)
CTA = frozenset(("ler noticia", "ler notícia", "leia mais", "leia", "saiba mais", "veja mais", "continue lendo", "confira", "acesse"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": frozenset("p address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()), "li": frozenset(("li",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "tr": frozenset(("tr",)), "option": frozenset(("option",))}
# Body selectors for sites without rows of their own, in order of trial.
DEFAULT_SELECTORS = (
    'div[itemprop="articleBody"]', "div.article-content", "div.article-body", "div.article__content", "div.article__body", "div.post-content", "div.post__content",
    "div.post-body", "div.entry-content", "div.entry__content", "div.single-content", "div.single__content", "div.content-text", "div.news-text", "div.news-content",
    "div.news__body", "div.materia-conteudo", "div.conteudo-materia", "div.texto-materia", "div.texto", "div.content", "div.body", "div.main-content",
    "section.article-body", "section.content", "main article", "article .content", "article",
)
_DATE = re.compile(r"\b(\d{2})/(\d{2})/(\d{4})\b")


class Node:
    __slots__ = ("tag", "attrs", "kids", "up")

    def __init__(self, tag: str, attrs: dict[str, str], up: Node | None):
        self.tag, self.attrs, self.up, self.kids = tag, attrs, up, []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(k for k in reversed(n.kids) if isinstance(k, Node))

    def find(self, tag: str) -> list[Node]:
        return [n for n in self.walk() if n.tag == tag and n is not self]

    def raw(self) -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack.extend(reversed(n.kids))
        return "".join(out)

    def text(self) -> str:
        """The pieces of text, each stripped, joined by single spaces; scripts don't count."""
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                if n.strip():
                    out.append(n.strip())
            elif n.tag not in ("script", "style") or n is self:
                stack.extend(reversed(n.kids))
        return " ".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        n = self.at
        while n.up is not None and n.tag not in ("div", "article", "section", "body", "table", "ul", "ol"):
            if tag in CLOSES.get(n.tag, ()):
                self.at = n.up
                break
            n = n.up
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.kids.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.kids.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n.up is not None and n.tag != tag:
            n = n.up
        if n.up is not None:
            self.at = n.up

    def handle_data(self, data):
        self.at.kids.append(data)


def parse(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def _step(n: Node, part: str) -> bool:
    m = re.match(r"^([A-Za-z][\w-]*|\*)?", part)
    if m[0] and m[0] != "*" and n.tag != m[0].lower():
        return False
    for cls, ident, attr, op, value in re.findall(r"\.([\w-]+)|#([\w-]+)|\[([\w:-]+)(?:([*^]?=)[\"']?([^\]\"']*)[\"']?)?\]", part[m.end():]):
        if cls and cls not in n.attrs.get("class", "").split() or ident and n.attrs.get("id") != ident:
            return False
        if attr:
            have = n.attrs.get(attr)
            if have is None or op == "=" and have != value or op == "*=" and value not in have or op == "^=" and not have.startswith(value):
                return False
    return True


def select_first(root: Node, selector: str) -> Node | None:
    """The first element that matches tag, ``.class``, ``#id``, ``[attr]`` parts with descent by space."""
    parts = selector.split()
    for n in root.walk():
        if n.up is None or not _step(n, parts[-1]):
            continue
        up, left = n.up, parts[:-1]
        while left and up is not None:
            if _step(up, left[-1]):
                left = left[:-1]
            up = up.up
        if not left:
            return n
    return None


def strip_noise(n: Node) -> None:
    def noisy(k: Node) -> bool:
        mark = (k.attrs.get("class", "") + " " + k.attrs.get("id", "")).lower()
        return k.tag in NOISE_TAGS or any(p in mark for p in NOISE_PARTS)

    for x in list(n.walk()):
        x.kids = [k for k in x.kids if isinstance(k, str) or not noisy(k)]


def paragraphs(n: Node | None) -> list[str]:
    """Texts of the ``<p>`` below, without those that are only links."""
    if n is None:
        return []
    strip_noise(n)
    out = []
    for p in n.find("p"):
        t, kids = p.text(), [k for k in p.kids if isinstance(k, Node)]
        only_links = kids and all(k.tag == "a" for k in kids) and t == " ".join(k.text() for k in kids)
        if t and not only_links:
            out.append(t)
    return out


def br_paragraphs(n: Node | None) -> list[str]:
    """Parts of a body that is divided by ``<br>`` only."""
    if n is None:
        return []
    strip_noise(n)
    for x in list(n.walk()):
        x.kids = ["\n" if isinstance(k, Node) and k.tag == "br" else k for k in x.kids]
    return [s for s in (re.sub(r"[ \t]+", " ", x).strip() for x in n.raw().split("\n")) if s]


def _meta(root: Node, *keys: tuple[str, str]) -> str:
    for attr, value in keys:
        for m in root.find("meta"):
            if m.attrs.get(attr, "").lower() == value and m.attrs.get("content", "").strip():
                return m.attrs["content"].strip()
    return ""


def title_of(root: Node) -> str:
    t = _meta(root, ("property", "og:title"), ("name", "twitter:title"), ("itemprop", "headline"))
    if t:
        return t
    for tag in ("h1", "title"):
        for n in root.find(tag):
            if n.text():
                return n.text()
    return ""


def island(root: Node, path: str, ident: str = "__NEXT_DATA__") -> str | None:
    """A non-blank string at a dotted path of a JSON script; None on any failure."""
    for s in root.find("script"):
        if s.attrs.get("id") == ident:
            try:
                cur = json.loads(s.raw())
            except ValueError:
                return None
            for key in path.split("."):
                cur = cur.get(key) if isinstance(cur, dict) else None
            return cur if isinstance(cur, str) and cur.strip() else None
    return None


def date_candidates(root: Node) -> list[str]:
    """Written dates in order of trust: meta, JSON-LD, ``<time>``."""
    out = [v for k in (("property", "article:published_time"), ("name", "article:published_time"), ("name", "date"), ("itemprop", "datepublished")) if (v := _meta(root, k))]
    for s in root.find("script"):
        if s.attrs.get("type") == "application/ld+json":
            try:
                data = json.loads(s.raw() or "{}")
            except ValueError:
                continue
            out += [str(o["datePublished"]) for o in (data if isinstance(data, list) else [data]) if isinstance(o, dict) and o.get("datePublished")]
    return out + [n.attrs["datetime"] for n in root.find("time") if n.attrs.get("datetime")]


def extract(html: str | None, spec: str | None = None) -> dict:
    """Title, description, date candidates and paragraphs of a page.

    ``spec`` names where the body is: selectors divided by ``|``, with a leading
    ``br:`` for a body divided by ``<br>`` or ``json:path`` for a JSON island.
    """
    root = parse(html)
    out = {"title": title_of(root), "description": _meta(root, ("property", "og:description"), ("name", "description")), "dates": date_candidates(root)}
    kind, _, rest = (spec or "").partition(":")
    if kind == "json" and (body := island(root, rest.split("|")[0])):
        out["paragraphs"] = paragraphs(parse(body))
        return out
    names = [x for x in ((rest if kind in ("br", "json") else spec) or "").split("|")[kind == "json":] if x] or list(DEFAULT_SELECTORS)
    body = next((n for s in names if (n := select_first(root, s)) is not None), None)
    if kind == "br":
        out["paragraphs"] = br_paragraphs(body)
    else:
        out["paragraphs"] = paragraphs(body or next(iter(root.find("article")), None))
        if not out["paragraphs"] and body is None:
            out["paragraphs"] = paragraphs(root)
    return out


PAGE = T.StructType([T.StructField("title", T.StringType()), T.StructField("description", T.StringType()), T.StructField("dates", T.ArrayType(T.StringType())), T.StructField("paragraphs", T.ArrayType(T.StringType()))])


@F.pandas_udf(PAGE)
def extract_page(html: pd.Series, spec: pd.Series) -> pd.DataFrame:
    rows = [extract(h, s) for h, s in zip(html, spec)]
    return pd.DataFrame(rows, columns=["title", "description", "dates", "paragraphs"])


@F.pandas_udf(T.ArrayType(T.StringType()))
def html_paragraphs(html: pd.Series) -> pd.Series:
    """Texts of all ``<p>`` after figures, asides and scripts are gone."""

    def one(h: str | None) -> list[str]:
        root = parse(h)
        for x in list(root.walk()):
            x.kids = [k for k in x.kids if isinstance(k, str) or k.tag not in ("script", "style", "figure", "figcaption", "aside", "iframe")]
        return [t for p in root.find("p") if (t := p.text())]

    return html.map(one, na_action=None)


@F.pandas_udf(T.StringType())
def html_text(html: pd.Series) -> pd.Series:
    """Plain text: entities resolved, tags away, white space collapsed; empty for NULL."""
    return html.map(lambda h: re.sub(r"\s+", " ", parse(unescape(h)).text()).strip() if isinstance(h, str) and h else "", na_action=None)


def listing_links(html: str | None) -> list[dict]:
    """All links of a page with headline and date hints, in order."""
    out = []
    for i, a in enumerate(parse(html).find("a")):
        href = a.attrs.get("href", "").strip()
        if not href:
            continue
        label = re.sub(r"\s+", " ", _DATE.sub("", a.text()).strip(" -|·–—"))
        title = label[:300] if len(label) >= 15 and label.lower() not in CTA else ""
        when, n = "", a
        for _ in range(3):
            if n is None or n.up is None:
                break
            times = [t.attrs["datetime"] for t in n.find("time") if t.attrs.get("datetime")]
            found = _DATE.findall(n.text())
            when = times[0] if times else "-".join(reversed(found[0])) if len(found) == 1 else ""
            if when:
                break
            n = n.up
        out.append({"pos": i, "href": href, "title_hint": title, "date_hint": when})
    return out


LINKS = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType()), T.StructField("title_hint", T.StringType()), T.StructField("date_hint", T.StringType())]))


@F.pandas_udf(LINKS)
def page_links(html: pd.Series) -> pd.Series:
    return html.map(listing_links, na_action=None)
