"""URL functions on columns, by regular expression so that odd URLs don't become NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that don't name the page.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "mc_cid", "mc_eid", "ref", "ref_src", "__twitter_impression")
_PARTS = r"^(?s)([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _PARTS, 1))


def host(url: Column) -> Column:
    """Lower-case host without ``www.``."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, _PARTS, 2)), r"^www\.", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 3)


def query(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 4), F.lit(""))


def segments(p: Column) -> Column:
    return F.filter(F.split(p, "/"), lambda s: s != "")


def plus_decode(c: Column) -> Column:
    """Form decoding; the text as is where its escapes are broken."""
    return F.coalesce(F.try_url_decode(c), c)


def form_encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def normalize(url: Column) -> Column:
    """Stable form for comparison: no fragment, ``www.``, tracking parameters or slash at the end."""
    pairs = F.filter(F.split(query(url), "&"), lambda p: p != "")
    kept = F.filter(pairs, lambda p: ~F.lower(plus_decode(F.substring_index(p, "=", 1))).isin(*TRACKING))

    def again(p: Column) -> Column:
        key = F.substring_index(p, "=", 1)
        value = F.when(F.contains(p, F.lit("=")), F.substring(p, F.length(key) + 2, F.length(p))).otherwise(F.lit(""))
        return F.concat(form_encode(plus_decode(key)), F.lit("="), form_encode(plus_decode(value)))

    q = F.array_join(F.transform(kept, again), "&")
    p = F.regexp_replace(path(url), r"/+$", "")
    p = F.when(p == "", path(url)).otherwise(p)
    out = F.concat(scheme(url), F.lit("://"), host(url), p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")))
    return F.when(url.rlike(_PARTS), out).otherwise(url)


def unwrap_redirect(url: Column) -> Column:
    """The target of a ``redir.`` link: what follows the first ``*``, else its ``url`` parameter."""
    starred = F.regexp_extract(url, r"\*(https?://.*)$", 1)
    param = plus_decode(query_param(url, "url"))
    target = F.when(starred != "", starred).when(param.rlike("^https?://"), param).otherwise(url)
    return F.when(F.startswith(host(url), F.lit("redir.")), target).otherwise(url)


def query_param(url: Column, name: str) -> Column:
    return F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)


def absolutise(href: Column, base: Column) -> Column:
    """A link of a page as full URL; NULL for anchors, scripts and mail links."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    return (
        F.when(href.rlike(r"^(?i)(?:#|javascript:|mailto:|tel:)") | (href == ""), F.lit(None))
        .when(F.startswith(href, F.lit("//")), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, href))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .otherwise(F.concat(F.regexp_replace(base, r"[^/]*$", ""), href))
    )


def encoded_weight(url: Column) -> Column:
    """Characters the URL takes in a request, with its separators."""
    return F.length(F.url_encode(url)) + 3


def slug(url: Column) -> Column:
    """The last segment of the path."""
    return F.regexp_extract(F.regexp_replace(path(url), r"/+$", ""), r"([^/]*)$", 1)


def slug_title(url: Column) -> Column:
    """A headline made of the slug; the URL where there is none."""
    s = F.trim(F.replace(plus_decode(F.replace(slug(url), F.lit("+"), F.lit("%2B"))), F.lit("-"), F.lit(" ")))
    return F.when(s == "", url).otherwise(F.concat(F.upper(F.left(s, F.lit(1))), F.substring(s, F.lit(2), F.length(s))))


def feed_label(url: Column) -> Column:
    """A short name of a feed: the site it searches, else host and path."""
    site = F.regexp_extract(url, r"site(?:%3A|:)([^\s+&]+)", 1)
    return F.when(site != "", site).otherwise(F.concat(host(url), F.regexp_replace(path(url), r"/+$", "")))
