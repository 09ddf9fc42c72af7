"""Line dedup by site-relative frequency: a line that more than `share` of a site's pages
contain is boilerplate of that site, and goes from all of them.

Lines are counted by (site, 128 bits of the line's digest), each once a page, with partial sums
before the shuffle. A site's boilerplate is bounded: no more lines can each be on a share r of its
pages than a page has distinct lines on average, divided by r. It is gathered as one array for
each site, and joined to the pages by site: broadcast while its checked size is small, else in a
join of which Spark splits the hot sites. Pages are not exploded again: lines are filtered in
place.

Defined cases: lines end at a line feed; the lines of a page that are kept are joined by line
feeds in their order. A null text stays null and a null site is a site of its own. Repeated rows
are pages of their own. Blank lines stay. Other columns are passed through, whatever their names. An empty table gives an empty one.

Which lines are boilerplate is said by one ratio, `share`, and a least number of pages that rises
slowly with the site, so that small sites are judged too and a few copies of one page don't make
its text boilerplate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainflow.llm.common import materialize, table

#: The one parameter of usual(): the widest gap of line shares between 1 and 3 % on sf0.1 (1.81 to 2.22 %).
SHARE = 0.02
#: The least pages with a line, on the smallest sites: two alike may be a page and its copy.
LEAST = 3
#: A broadcast of boilerplate beyond these many lines gives way to a join.
BROADCAST_LINES = 100_000


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def host(url: Column) -> Column:
    """The host of a url in lower case, without user and port; null if there is none."""
    named = F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    found = F.lower(F.regexp_replace(F.regexp_replace(named, "^.*@", ""), ":[0-9]*$", ""))
    return F.when(found != "", found)


def usual(n: Column, pages: Column, share: float = SHARE) -> Column:
    """Over `share` of the pages, and at least LEAST and 1 + log2(pages) of them."""
    return (n >= LEAST) & (F.pow(F.lit(2.0), n - 1) >= pages) & (n > pages * F.lit(share))


def boilerplate(pages: DataFrame, site: Column, text: Column, rule: Callable[[Column, Column], Column] = usual) -> DataFrame:
    """(site, lines): the digests of each site's boilerplate lines, for sites that have any.
    rule(n, pages): whether a line on n of a site's pages is boilerplate; never if n is 1."""
    totals = pages.groupBy(site.alias("site")).agg(F.count("*").alias("pages"))
    lines = pages.select(site.alias("site"), F.explode(F.array_distinct(F.split(text, "\n"))).alias("line"))
    counted = lines.filter(F.trim("line") != "").groupBy("site", _digest(F.col("line")).alias("digest")).agg(F.count("*").alias("n")).filter("n > 1")
    often = counted.join(totals, counted["site"].eqNullSafe(totals["site"])).filter(rule(F.col("n"), F.col("pages")))
    return often.groupBy(counted["site"].alias("site")).agg(F.collect_list("digest").alias("lines"))


def drop_boilerplate(pages: DataFrame, *, site: Column | str = "source", text_col: str = "text", rule: Callable[[Column, Column], Column] = usual) -> DataFrame:
    """pages with a column `_kept` (array of the lines that stay; null for a null text)."""
    site, text = F.col(site) if isinstance(site, str) else site, F.col(text_col).cast("string")
    found = materialize(boilerplate(pages, site, text, rule), "boilerplate")
    size = found.agg(F.sum(F.size("lines"))).first()[0] or 0
    known = F.map_from_arrays("lines", F.array_repeat(F.lit(True), F.size("lines")))
    side = found.select(F.col("site").alias("_site"), known.alias("_lines"))
    side = F.broadcast(side) if size <= BROADCAST_LINES else side
    joined = pages.join(side, site.eqNullSafe(F.col("_site")), "left")
    lines = F.split(text, "\n")
    kept = F.when(F.col("_lines").isNull(), lines).otherwise(F.filter(lines, lambda line: ~F.coalesce(F.element_at("_lines", _digest(line)), F.lit(False))))
    return joined.withColumn("_kept", kept).drop("_site", "_lines")


def _counted(out: DataFrame, *columns: str, text_col: str) -> DataFrame:
    text = F.array_join("_kept", "\n")
    n = F.size(F.split(text_col, "\n")).cast("bigint")
    return out.select(
        *columns,
        F.coalesce(n, F.lit(0)).alias("n_lines"),
        F.coalesce(n - F.size("_kept"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.sha2(F.coalesce(text, F.lit("")), 256).alias("kept_sha256"),
    )


def op3_site_lines(spark, sf_dir: str) -> DataFrame:
    """Every document without its source's boilerplate lines."""
    out = drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return _counted(out, "doc_id", "source", text_col="text")


def op3_host_lines(spark, sf_dir: str) -> DataFrame:
    """Every web page without the boilerplate lines of its url's host."""
    pages = table(spark, sf_dir, "pages").select("page_id", host(F.col("url")).alias("host"), "html")
    return _counted(drop_boilerplate(pages, site="host", text_col="html"), "page_id", "host", text_col="html")


OP3_SQL = f"""
with totals as (select source, count(*) as pages from documents group by source),
lines as (select source, unnest(list_distinct(string_split(text, chr(10)))) as line from documents),
often as (
  select l.source, l.line from lines l join totals t on l.source is not distinct from t.source
  where trim(l.line, ' ') <> '' group by l.source, l.line, t.pages
  having count(*) >= {LEAST} and pow(2::double, count(*) - 1) >= t.pages and count(*) > t.pages * {SHARE}::double),
sets as (select source, list(line) as bad from often group by source),
kept as (
  select d.doc_id, d.source, string_split(d.text, chr(10)) as lines,
         list_filter(string_split(d.text, chr(10)), lambda x: not list_contains(coalesce(s.bad, []), x)) as good
  from documents d left join sets s on d.source is not distinct from s.source)
select doc_id, source, coalesce(len(lines), 0)::bigint as n_lines, coalesce(len(lines) - len(good), 0)::bigint as n_dropped,
       sha256(coalesce(array_to_string(good, chr(10)), '')) as kept_sha256
from kept
"""

OP3_HOST_SQL = f"""
with named as (select page_id, html, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) as h from pages),
sited as (select page_id, string_split(html, chr(10)) as lines, nullif(lower(regexp_replace(regexp_replace(h, '^.*@', ''), ':[0-9]*$', '')), '') as host from named),
totals as (select host, count(*) as pages from sited group by host),
each as (select host, unnest(list_distinct(lines)) as line from sited),
often as (
  select e.host, e.line from each e join totals t on e.host is not distinct from t.host
  where trim(e.line, ' ') <> '' group by e.host, e.line, t.pages
  having count(*) >= {LEAST} and pow(2::double, count(*) - 1) >= t.pages and count(*) > t.pages * {SHARE}::double),
sets as (select host, list(line) as bad from often group by host),
kept as (
  select page_id, s.host, lines, list_filter(lines, lambda x: not list_contains(coalesce(b.bad, []), x)) as good
  from sited s left join sets b on s.host is not distinct from b.host)
select page_id, host, coalesce(len(lines), 0)::bigint as n_lines, coalesce(len(lines) - len(good), 0)::bigint as n_dropped,
       sha256(coalesce(array_to_string(good, chr(10)), '')) as kept_sha256
from kept
"""
