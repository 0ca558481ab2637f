"""Line dedup by site-relative frequency.

Pages are grouped by site; a line on more than `ratio` of a site's pages, and on
`min_pages` of them at least, is boilerplate there and goes from all of them.
A line counts once per page, compared without blanks at its ends; blank lines
count nowhere and stay.

Equal texts of a site are one page, unless `copies` is set: a text that was
copied often has no boilerplate for that.

Cases: null text counts as a page without lines and stays null; null site is a
site of its own; repeated rows stay as often as they come; an empty table gives an
empty table; other columns of the rows pass through unchanged whatever their
names (a column named like an added one is replaced).

Plan: lines become 64-bit keys of (site, line) inside the page, are counted
with partial sums, and only keys over the limits go on. Pages meet their
dropped keys by a key of the whole row, which no site skews.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import query, table
from segloom.runtime import cut

RATIO = 0.1
MIN_PAGES = 2  # a line on one page is not repeated; what goes beyond that is the ratio's to decide


def _key(site: Column, line: Column) -> Column:
    return F.xxhash64(site.isNull(), site, F.btrim(line, F.lit(" \t\r")))


def boilerplate(df: DataFrame, text: str, site: str, ratio: float = RATIO, min_pages: int = MIN_PAGES, copies: bool = False) -> DataFrame:
    """Keys of the lines that go, one column `_line`."""
    pages = df.select(F.col(site).alias("_site"), F.col(text).alias("_text"))
    named = F.xxhash64(F.col("_site").isNull(), "_site").alias("_host")
    same = F.xxhash64(F.col("_text").isNull(), "_text").alias("_same")
    totals = pages.select(named) if copies else pages.select(named, same).distinct()
    totals = totals.groupBy("_host").agg(F.count("*").alias("_pages"))
    keys = F.array_distinct(F.transform(_lines(F.col("_text")), lambda x: _key(F.col("_site"), x))).alias("_keys")
    found = pages.select(named, keys) if copies else pages.select(named, same, keys).groupBy("_host", "_same").agg(F.first("_keys").alias("_keys"))
    found = found.select("_host", F.explode("_keys").alias("_line"))
    counts = found.groupBy("_host", "_line").agg(F.count("*").alias("_on")).where(F.col("_on") >= min_pages)
    return counts.join(totals, "_host").where(F.col("_on") > F.col("_pages") * F.lit(float(ratio))).select("_line")


def _lines(text: Column) -> Column:
    """Lines that are not blank."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\r")) != "")


def drop_boilerplate(df: DataFrame, text: str = "text", site: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, copies: bool = False) -> DataFrame:
    """`df` with boilerplate lines removed from `text`, and `n_lines`, `n_dropped` (long) appended."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    pages = df.select(row.alias("_row"), F.col(site).alias("_site"), F.col(text).alias("_text"))
    pages = pages.withColumn("_page", F.xxhash64(F.col("_site").isNull(), "_site", "_text"))
    gone = boilerplate(df, text, site, ratio, min_pages, copies)
    keys = F.array_distinct(F.transform(_lines(F.col("_text")), lambda x: _key(F.col("_site"), x)))
    found = pages.select("_page", F.explode(keys).alias("_line")).join(gone, "_line", "left_semi")
    found = found.groupBy("_page").agg(F.collect_set("_line").alias("_gone"))  # at most a page's own lines
    both = pages.join(found, "_page", "left")
    blank = lambda x: F.btrim(x, F.lit(" \t\r")) == ""
    kept = F.filter(F.split("_text", "\n"), lambda x: blank(x) | ~F.array_contains("_gone", _key(F.col("_site"), x)))
    both = both.withColumns({"_kept": F.when(F.col("_gone").isNotNull(), kept), "_all": F.coalesce(F.size(_lines(F.col("_text"))), F.lit(0)).cast("long")})
    left = F.size(F.filter("_kept", lambda x: ~blank(x)))
    cleaned = F.when(F.col("_kept").isNull(), F.col("_text")).otherwise(F.array_join("_kept", "\n"))
    dropped = F.when(F.col("_kept").isNull(), F.lit(0)).otherwise(F.col("_all") - left).cast("long")
    out = {c: F.col("_row")[c] for c in df.columns} | {text: cleaned, "n_lines": F.when(F.col("_text").isNull(), F.lit(0)).otherwise(F.col("_all")).cast("long"), "n_dropped": dropped}
    return both.select(*[v.alias(k) for k, v in out.items()])


# Elements without text for readers, comments, and the tags that end a line of a rendered page.
_HIDDEN = r"(?is)<script.*?</script>|<style.*?</style>|<title.*?</title>|<!--.*?-->"
_BREAK = r"(?i)</?(?:p|div|li|ul|ol|nav|h[1-6]|article|section|header|footer|br|table|tr|td|body|html|head)(?:\s[^>]*)?/?>"
_TAG = r"<[^>]*>"


def html_text(html: Column) -> Column:
    """Text of a page, a line for each block element."""
    shown = F.regexp_replace(html, _HIDDEN, "")
    return F.btrim(F.regexp_replace(F.regexp_replace(F.regexp_replace(shown, _BREAK, "\n"), _TAG, ""), "\n+", "\n"), F.lit("\n"))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


_SQL = rf"""
WITH pages_ AS (
  SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
    trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '{_HIDDEN}', '', 'g'), '{_BREAK}', chr(10), 'g'), '{_TAG}', '', 'g'), '\n+', chr(10), 'g'), chr(10)) AS body
  FROM pages),
totals AS (SELECT host, count(*) AS n FROM pages_ GROUP BY host),
lines AS (SELECT page_id, host, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS pos FROM pages_),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS k FROM lines),
gone AS (
  SELECT host, k FROM keyed JOIN totals USING (host) WHERE k <> '' GROUP BY host, k, n
  HAVING count(DISTINCT page_id) >= {MIN_PAGES} AND count(DISTINCT page_id) > n * {RATIO}::DOUBLE),
marked AS (SELECT keyed.*, gone.k IS NOT NULL AS out_ FROM keyed LEFT JOIN gone USING (host, k))
SELECT page_id, host, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT out_), '') AS text,
  count(*) FILTER (WHERE k <> '') AS n_lines, count(*) FILTER (WHERE out_) AS n_dropped
FROM marked GROUP BY page_id, host
"""


@query("op10_line_dedup", _SQL)
def op10_line_dedup(spark, sf_dir):
    """Text of every page without its site's boilerplate lines."""
    pages = table(spark, sf_dir, "pages").select("page_id", url_host(F.col("url")).alias("host"), html_text(F.col("html")).alias("text"))
    pages = cut(pages)  # markup is taken out once, and read back three times
    return drop_boilerplate(pages, "text", "host", copies=True).select("page_id", "host", "text", "n_lines", "n_dropped")
