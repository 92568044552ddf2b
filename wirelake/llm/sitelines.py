"""Lines repeated across one site's documents, by distributed PrefixSpan (problem 6).

A document is the sequence of its lines' identifiers (hash of the comparison
form), of which only frequent ones are kept; equal sequences of a site become one row
with a weight, so a site with a third of all rows is as small as its variety. Frequent
sequences grow from single lines: a pattern's projected database is what follows its
first occurrence in each sequence; its extensions are counted there, with partial
sums before the shuffle.

Only sequences that no line extends at the same support are told (a prefix that
always goes on is part of the longer one). Where lines follow a pattern in all
its documents, extensions that come only behind the first of them, x, are left to the
branch of x: k lines
that always stand together cost k steps and not 2^k patterns.

Every frequent line is part of such a sequence: what is excessive is what the
sequences are made of, and each of its occurrences is deleted, in sequence or alone.

Defined results: NULL and blank snippets count as documents of the site and have
no lines; a NULL site is no site, its lines are never excessive; rows with a NULL
id are kept; repeated rows count as documents each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirelake.session import discard, materialize

MIN_DOCS, MIN_SHARE = 5, 10

#: a line's comparison form is the same in the SQL of ``p6_found``
SPACES, DIGITS = r"[\s\p{Z}\x{85}]+", r"\p{Nd}+"


def compare_line(c):
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), SPACES, " "), DIGITS, "0"))


def line_ids(articles: DataFrame) -> DataFrame:
    """``article_id, domain, items``: a hash per line, NULL for an empty one. Written once, read by each step."""

    def one(line):
        form = compare_line(line)
        return F.when(form != "", F.xxhash64(form))

    found = articles.filter(F.col("domain").isNotNull()).select("article_id", "domain", F.transform(F.split(F.coalesce("snippet", F.lit("")), "\n", -1), one).alias("items"))
    return materialize(found.withColumn("row_key", F.monotonically_increasing_id()), "p6-lines")


def _enough(n_docs: str = "n", site: str = "n_site"):
    return (F.col(n_docs) >= MIN_DOCS) & (F.col(n_docs) * MIN_SHARE >= F.col(site))


def frequent_lines(seq: DataFrame) -> DataFrame:
    """``domain, item, n, n_site``: the frequent single lines."""
    sites = seq.groupBy("domain").agg(F.count(F.lit(1)).alias("n_site"))
    items = seq.select("domain", F.explode(F.array_distinct(F.array_compact("items"))).alias("item"))
    return items.groupBy("domain", "item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_DOCS).join(sites, "domain").filter(_enough())


def _suffixes(db: DataFrame, grown: DataFrame) -> DataFrame:
    """``db(domain, pattern, rest, w)`` projected on ``grown(domain, pattern, item, n)``."""
    after = F.slice("rest", F.array_position("rest", F.col("item")).cast("int") + 1, F.size("rest"))
    return (
        db.join(grown, ["domain", "pattern"])
        .filter(F.array_contains("rest", F.col("item")))
        .select("domain", F.array_append("pattern", F.col("item")).alias("pattern"), after.alias("rest"), "w", F.col("n").alias("support"))
        .groupBy("domain", "pattern", "rest", "support")
        .agg(F.sum("w").alias("w"))
    )


def prefixspan(seq: DataFrame) -> DataFrame:
    """``domain, pattern, n_docs``: the frequent sequences of line hashes that nothing extends at the same support."""
    single = materialize(frequent_lines(seq), "p6-single")
    sites = single.select("domain", "n_site").distinct()
    lines = seq.select("domain", "row_key", F.posexplode("items").alias("at", "item")).join(single.select("domain", "item"), ["domain", "item"])
    whole = lines.groupBy("domain", "row_key").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "item"))), lambda x: x.item).alias("rest"))
    base = whole.groupBy("domain", "rest").agg(F.count(F.lit(1)).alias("w"))
    empty = F.array().cast("array<bigint>")
    db = materialize(_suffixes(base.withColumn("pattern", empty), single.select("domain", empty.alias("pattern"), "item", "n")), "p6-projected")
    level = single.select("domain", F.array("item").alias("pattern"), F.col("n").alias("n_docs"))
    parts = []
    while True:
        far = db.filter(F.size("rest") > 0)
        seen = far.select("domain", "pattern", "support", "w", "rest", F.explode(F.array_distinct("rest")).alias("item"))
        place = F.col("w") * F.array_position("rest", F.col("item"))
        ext = seen.groupBy("domain", "pattern", "support", "item").agg(F.sum("w").alias("n"), F.sum(place).alias("place")).join(sites, "domain").filter(_enough()).drop("n_site")
        ext = materialize(ext, "p6-extensions")
        always = ext.filter("n = support").groupBy("domain", "pattern").agg(F.min_by("item", F.struct("place", "item")).alias("always"))
        parts.append(level.join(always, ["domain", "pattern"], "left_anti"))
        # extensions that only come behind the line that always follows are found in its branch
        led = far.join(always, ["domain", "pattern"]).select("domain", "pattern", "w", "rest", "always", F.explode(F.array_distinct("rest")).alias("item"))
        behind = led.filter(F.array_position("rest", F.col("always")) < F.array_position("rest", F.col("item")))
        behind = behind.groupBy("domain", "pattern", "item").agg(F.sum("w").alias("n"))
        grown = materialize(ext.join(behind, ["domain", "pattern", "item", "n"], "left_anti").select("domain", "pattern", "item", "n"), "p6-grown")
        if grown.isEmpty():
            break
        level = grown.select("domain", F.array_append("pattern", F.col("item")).alias("pattern"), F.col("n").alias("n_docs"))
        last, db = db, materialize(_suffixes(db.drop("support"), grown), "p6-projected")
        discard(last)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def excessive(seq: DataFrame) -> DataFrame:
    """``domain, item``: the lines that the frequent sequences are made of."""
    return materialize(prefixspan(seq).select("domain", F.explode("pattern").alias("item")).distinct(), "p6-excessive")


def p6_found(articles: DataFrame) -> DataFrame:
    """``article_id, line_no`` of each occurrence of an excessive line."""
    seq = line_ids(articles)
    rows = seq.select("article_id", "domain", F.posexplode("items").alias("at", "item"))
    return rows.join(excessive(seq), ["domain", "item"], "left_semi").select("article_id", (F.col("at") + 1).alias("line_no"))


def p6_clean(articles: DataFrame) -> DataFrame:
    """``article_id, snippet`` without the occurrences; NULL stays NULL.

    A site has at most ten times as many excessive lines as lines a document, so its
    set is one array, which meets the site's rows in a join.
    """
    sets = excessive(line_ids(articles)).groupBy("domain").agg(F.collect_set("item").alias("frequent"))
    kept = F.filter(F.split("snippet", "\n", -1), lambda x: ~F.coalesce(F.array_contains("frequent", F.xxhash64(compare_line(x))) & (compare_line(x) != ""), F.lit(False)))
    cleaned = F.when(F.col("frequent").isNull() | F.col("snippet").isNull(), F.col("snippet")).otherwise(F.array_join(kept, "\n"))
    return articles.select("article_id", "domain", "snippet").join(sets, "domain", "left").select("article_id", cleaned.alias("snippet"))


def sequences(articles: DataFrame) -> DataFrame:
    """The frequent sequences: ``domain, n_lines, lines, n_docs``."""
    seq = line_ids(articles)
    found = materialize(prefixspan(seq), "p6-sequences")
    items = found.select("domain", F.explode("pattern").alias("item")).distinct()
    forms = articles.select("domain", F.explode(F.split("snippet", "\n", -1)).alias("line")).select("domain", compare_line(F.col("line")).alias("form")).withColumn("item", F.xxhash64("form"))
    names = forms.join(items, ["domain", "item"], "left_semi").groupBy("domain", "item").agg(F.min("form").alias("form"))
    named = found.withColumn("key", F.monotonically_increasing_id()).select("key", "domain", "n_docs", F.size("pattern").alias("n_lines"), F.posexplode("pattern").alias("at", "item"))
    return (
        named.join(names, ["domain", "item"])
        .groupBy("key", "domain", "n_docs", "n_lines")
        .agg(F.sort_array(F.collect_list(F.struct("at", "form"))).alias("x"))
        .select("domain", "n_lines", F.array_join(F.transform("x", lambda e: e.form), "\n").alias("lines"), "n_docs")
    )


P6_SQL = rf"""
WITH l AS (
  SELECT article_id, domain, unnest(string_split(snippet, chr(10))) AS line,
         generate_subscripts(string_split(snippet, chr(10)), 1) AS line_no
  FROM articles WHERE snippet IS NOT NULL AND domain IS NOT NULL),
k AS (
  SELECT article_id, domain, CAST(line_no AS INTEGER) AS line_no,
         trim(regexp_replace(regexp_replace(lower(line), '{SPACES}', ' ', 'g'), '{DIGITS}', '0', 'g')) AS form FROM l),
n AS (SELECT domain, count(*) AS n_site FROM articles GROUP BY domain),
f AS (
  SELECT domain, form FROM k JOIN n USING (domain) WHERE form <> '' GROUP BY domain, form, n_site
  HAVING count(DISTINCT article_id) >= {MIN_DOCS} AND count(DISTINCT article_id) * {MIN_SHARE} >= n_site)
SELECT article_id, line_no FROM k JOIN f USING (domain, form)
"""

P6_CLEAN_SQL = P6_SQL.replace("SELECT article_id, line_no FROM k JOIN f USING (domain, form)", """, z AS (
  SELECT article_id, string_agg(line, chr(10) ORDER BY l.line_no) FILTER (f.form IS NULL) AS kept
  FROM l JOIN k USING (article_id, domain, line_no) LEFT JOIN f USING (domain, form) GROUP BY article_id)
SELECT article_id, CASE WHEN snippet IS NULL OR domain IS NULL THEN snippet ELSE coalesce(kept, '') END AS snippet
FROM articles LEFT JOIN z USING (article_id)""")
