"""Line dedup by site-relative frequency.

Per host, the pages that contain a line are divided by the host's pages; a line whose
ratio exceeds ``RATIO`` is that site's boilerplate and goes from all its pages. A line
must also be on ``MIN_PAGES`` pages or more: on a host of a few pages, any line would
have a high ratio. A line counts once a page, compared without the white space at its
ends; blank lines are layout, neither counted nor dropped. With ``copies_once`` rows of
a host with one text are one page, so that a group of copies, whatever its size, does
not make boilerplate of its own text.

Scale: pages are counted by (host, line digest) with map-side sums, so a hot host and a
line on all its pages are one row per task. A host keeps fewer than (mean lines a page)
/ RATIO lines above the ratio, as each stands on more than RATIO of its pages, so the
result of the count is small; it is grouped into one row per host. That table is
broadcast only if its measured size is below BROADCAST_LINES; else the join is
shuffled and adaptive execution splits a hot host.

With ``copies_once`` the texts are first grouped by (host, text digest), with map-side
combination, so that the copies of a text are one row per task.

Everything runs on built-in functions. The digest is MD5 (128 bits).

Edge cases: a null text stays null, an empty one empty; null hosts form one host;
repeated rows are pages of their own unless ``copies_once`` (null and empty texts are
then one page each); a text whose lines all go becomes empty; ratios
equal to RATIO stay; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

RATIO = 0.1
MIN_PAGES = 5
BROADCAST_LINES = 1 << 20


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """Digest of the line without outer white space; null for a blank line."""
    bare = F.regexp_replace(line, r"^[ \t\r]+|[ \t\r]+$", "")
    return F.when(bare != "", F.md5(bare))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """(host, line, pages, host_pages): digests of the lines above the ratio."""
    pages = docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    totals = pages
    if copies_once:
        copy = F.md5("text").alias("copy")
        totals = pages.select("host", copy).distinct()
        pages = pages.groupBy("host", copy).agg(F.first("text").alias("text"))
    totals = totals.groupBy("host").agg(F.count("*").alias("host_pages"))
    each = pages.select("host", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _key))).alias("line")).where("line is not null")
    counted = each.groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    return (counted.join(totals.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
            .where(F.col("pages") > F.lit(ratio) * F.col("host_pages")))


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                     ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """``docs`` with the text less its site's boilerplate lines, and n_lines and
    n_dropped (long) added (input columns of these names are replaced)."""
    found = cut_lineage(boilerplate(docs, host_col, text_col, ratio, min_pages, copies_once), "boilerplate")
    per_host = found.groupBy("host").agg(F.collect_set("line").alias("__drop")).withColumnRenamed("host", "__host")
    if found.count() <= BROADCAST_LINES:
        per_host = F.broadcast(per_host)
    lines = _lines(F.col(text_col))
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("__drop"), _key(x)), F.lit(False)))
    left = docs.drop("n_lines", "n_dropped", "__host", "__drop").join(per_host, F.col(host_col).eqNullSafe(F.col("__host")), "left")
    some = F.col("__drop").isNotNull()
    left = left.withColumn("__kept", F.when(some, kept).otherwise(lines))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return left.select(
        *(F.when(F.col(text_col).isNotNull(), F.array_join("__kept", "\n")).alias(c) if c == text_col else F.col(c) for c in names),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(lines) - F.size("__kept"), F.lit(0)).cast("long").alias("n_dropped"))


#: The same rows in DuckDB SQL, with the default parameters.
SQL = f"""
WITH pages AS (SELECT row_number() OVER () AS r, * FROM documents),
lines AS (
  SELECT r, source, i, line, trim(line, ' ' || chr(9) || chr(13)) AS bare
  FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM pages)),
totals AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
boiler AS (
  SELECT l.source, l.bare FROM (SELECT DISTINCT r, source, bare FROM lines WHERE bare <> '') l
  JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
  GROUP BY l.source, l.bare, t.n
  HAVING count(*) >= {MIN_PAGES} AND count(*) > {RATIO} * t.n),
kept AS (
  SELECT l.r, count(*) AS n_lines, count(b.bare) AS n_dropped,
         string_agg(CASE WHEN b.bare IS NULL THEN l.line END, chr(10) ORDER BY l.i) AS text
  FROM lines l LEFT JOIN boiler b ON l.source IS NOT DISTINCT FROM b.source AND l.bare = b.bare
  GROUP BY l.r)
SELECT p.doc_id, CASE WHEN p.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped
FROM pages p LEFT JOIN kept k ON p.r = k.r
"""
