"""Boilerplate lines by their frequency within a site.

Pages are grouped by the host of their URL. A line's site ratio is the number of
the host's pages that contain it over all pages of the host; lines above
``max_ratio`` that stand on at least ``min_pages`` pages are dropped (a line on
one page is no repetition).

Lines are the visible text of the HTML, cut at block elements: script, style and
comments go, other tags vanish, blanks are collapsed, empty lines are skipped.
A page counts a line once however often it repeats it, and loses every repeat.

Lines travel as hashes (128 bits). Counts are combined before the shuffle, so a
line on all pages of a hot host is one row per task; dropped lines are found by
a join that adaptive execution can split. A page without a host (null or
malformed URL) keeps all its lines; a null page has none. Repeated rows are
separate pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import materialise

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
HIDDEN = r"(?is)<(?:script\b.*?</script\s*>|style\b.*?</style\s*>|!--.*?-->)"
BLOCK = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*+>"
TAG = r"<[^>]*+>"


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)


def html_lines(html: Column) -> Column:
    """Visible lines of a page, blanks collapsed, empty ones left out."""
    visible = F.translate(F.regexp_replace(html, HIDDEN, ""), "\t\r\n\f", "    ")
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(visible, BLOCK, "\n"), TAG, ""), " {2,}", " ")
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: F.trim(s)), lambda s: s != "")


def drop_boilerplate(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_ratio: float = 0.3, min_pages: int = 2) -> DataFrame:
    """One row per page: id, host, n_lines, n_dropped and the kept lines joined by newlines."""
    spark = pages.sparkSession
    host, html = host_of(F.col(url_col)), F.col(html_col)
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("\0null")), host, F.hex(F.xxhash64(html)), F.hex(F.xxhash64(F.lit(1), html)))
    page = pages.select(F.col(id_col).alias("id"), host.alias("host"), html_lines(html).alias("lines"), key.alias("key"))
    line_hash = lambda s: F.struct(F.xxhash64(s).alias("a"), F.xxhash64(F.lit(1), s).alias("b"))
    # the hashes are written once; the lines themselves are cut again where they are needed, which costs less than storing them
    hashed = materialise(spark, page.where("host is not null").select("key", "host", F.transform("lines", line_hash).alias("h")), "lines")
    sites = hashed.groupBy("host").agg(F.count("*").alias("pages"))
    seen = hashed.select("host", F.explode(F.array_distinct("h")).alias("h")).groupBy("host", "h.a", "h.b").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    frequent = seen.join(sites, "host").where(F.col("n") > F.lit(max_ratio) * F.col("pages")).select("host", "a", "b")
    placed = hashed.select("key", "host", F.posexplode("h").alias("at", "h")).select("key", "host", "at", "h.a", "h.b")
    dropped = placed.join(frequent, ["host", "a", "b"], "left_semi").groupBy("key").agg(F.collect_set("at").alias("gone"))
    joined = page.join(dropped, "key", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.filter("lines", lambda s, i: ~F.array_contains(F.col("gone"), i))
    return joined.select(
        F.col("id").alias(id_col), "host", F.size("lines").alias("n_lines"), (F.size("lines") - F.size(kept)).alias("n_dropped"), F.array_join(kept, "\n").alias("text")
    )
