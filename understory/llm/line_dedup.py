"""Line dedup by site-relative frequency. SQL functions only.

Pages are grouped by host. For each line (trimmed, not blank) the pages of the host that contain it are divided by all
pages of the host; lines above ``max_ratio`` that ``min_pages`` pages hold are boilerplate and leave every page of the
host. Pages with the same text count as one page, so that copies don't make their own lines boilerplate.

A host has at most (mean lines a page) / max_ratio boilerplate lines, whatever its size: they fit one array. The arrays
are sent to every task if their counted size is under ``BROADCAST_LINES``, else joined by host with a salted key, so
that a host with a third of all pages is spread.

Defined results: a null text stays null; blank lines stay; a null host is a host of its own; a page keeps its row even
if no line is left (empty text); lines on exactly ``max_ratio`` of the pages stay; repeated rows repeat; an empty table
gives an empty table; further columns pass through untouched, whatever their names, but for one named like
``dropped_col``, which gives way to the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Saved, table

MAX_RATIO, MIN_PAGES, BROADCAST_LINES, SALTS = 0.1, 5, 500_000, 32


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line_hash, pages, host_pages) of the boilerplate lines."""
    pages = docs.select(F.col(f"`{host_col}`").alias("host"), F.col(f"`{text_col}`").alias("t")).where("t is not null").select("host", F.xxhash64("t").alias("page"), F.expr("array_distinct(transform(filter(split(t, '\\n'), x -> trim(x) <> ''), x -> xxhash64(trim(x))))").alias("lines"))
    totals = pages.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    counts = pages.select("host", "page", F.explode("lines").alias("line_hash")).distinct().groupBy("host", "line_hash").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    totals = totals.withColumnRenamed("host", "_host")
    return counts.join(totals, counts["host"].eqNullSafe(totals["_host"])).where(F.col("pages") > max_ratio * F.col("host_pages")).select("host", "line_hash", "pages", "host_pages")


def line_dedup(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, dropped_col: str = "_dropped") -> DataFrame:
    """docs with its text cleaned in place, and ``dropped_col``, the lines that left."""
    saved = Saved(docs.sparkSession)
    bad = saved(boilerplate(docs, host_col, text_col, max_ratio, min_pages))
    hosts = bad.groupBy("host").agg(F.collect_set("line_hash").alias("bad"))  # bounded by lines / max_ratio
    # the row is one struct: its names meet no others
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{host_col}`").alias("h"), F.col(f"`{text_col}`").alias("t"))
    if bad.count() <= BROADCAST_LINES:
        out = rows.join(F.broadcast(hosts), rows["h"].eqNullSafe(hosts["host"]), "left")
    else:
        salted = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("row_salt", F.pmod(F.xxhash64("t"), F.lit(SALTS)).cast("int"))
        out = rows.join(salted, rows["h"].eqNullSafe(salted["host"]) & (rows["row_salt"] == salted["salt"]), "left")
    # most texts hold no boilerplate: those are not taken apart again. The intersection is by hash, not line by line
    found = F.expr("array_intersect(transform(split(t, '\\n'), x -> xxhash64(trim(x))), bad)")
    out = out.withColumn("found", F.when(F.col("bad").isNotNull() & F.col("t").isNotNull(), found))
    keep = "filter(split(t, '\\n'), x -> trim(x) = '' or not array_contains(found, xxhash64(trim(x))))"
    out = out.withColumn("kept", F.expr(f"if(size(found) > 0, {keep}, cast(null as array<string>))"))
    out = out.withColumn("gone", F.expr("if(kept is null, 0, size(split(t, '\\n')) - size(kept))"))
    text = F.expr("if(gone = 0, t, array_join(kept, '\\n'))")
    return out.select(*[text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c != dropped_col], F.col("gone").alias(dropped_col))


def op4_line_dedup(spark, sf_dir):
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "text", F.col("_dropped").cast("long").alias("n_dropped"))


OP4_SQL = r"""
with d as (select doc_id, source, text from documents),
lines as (select distinct source, text as page, trim(l, ' ') as line from (select source, text, unnest(string_split(text, chr(10))) as l from d where text is not null) where trim(l, ' ') <> ''),
totals as (select source, count(distinct text) as host_pages from d where text is not null group by source),
bad as (select l.source, l.line from (select source, line, count(*) as pages from lines group by source, line) l join totals t on l.source is not distinct from t.source where pages >= 5 and pages > 0.1 * host_pages),
hosts as (select source, list(line) as bad from bad group by source)
select d.doc_id, d.source,
  case when d.text is null or h.bad is null then d.text else array_to_string(list_filter(string_split(d.text, chr(10)), lambda x: trim(x, ' ') = '' or not list_contains(h.bad, trim(x, ' '))), chr(10)) end as text,
  case when d.text is null or h.bad is null then 0 else len(string_split(d.text, chr(10))) - len(list_filter(string_split(d.text, chr(10)), lambda x: trim(x, ' ') = '' or not list_contains(h.bad, trim(x, ' ')))) end::bigint as n_dropped
from d left join hosts h on d.source is not distinct from h.source
"""
