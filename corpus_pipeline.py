"""A training corpus from documents: toxicity, line dedup, near duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame; run() writes
each to the shared folder as Parquet and reads it again as the next one's docs. All but the last return the columns of
documents, and whatever other columns docs has, unchanged.

Defined results: null and empty texts stay up to mixing, which takes no document without words; documents without an id
are handled like others; of equal rows one passes the near duplicates (all, if their text has no words); equal rows that
mixing gets are taken alike; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from understory.llm import bpe, line_dedup, mixing, ngram_join, toxicity
from understory.llm.common import Saved, remove, table, unused

#: Near duplicates: word shingles of five, similarity 0.8. Rows up to which ids go to all tasks.
WORDS, PERCENT, SEND = 5, 80, 1_000_000
#: Boilerplate: lines on over this share of a source's pages (and on line_dedup.MIN_PAGES of them).
SHARE = 0.01


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under the limit. The lexicon is learned from labelled rows."""
    lexicon = toxicity.learn(docs, toxicity.train_rows(table(spark, sf_dir, "labels")))
    at, matches = unused(docs, "_score"), unused(docs, "_matches")
    return toxicity.score(docs, lexicon, score_col=at, matches_col=matches).where(F.col(at) < toxicity.REJECT).select(*_columns(docs))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that too many pages of their source hold leave; n_chars follows the text."""
    gone = unused(docs, "_dropped")
    out = line_dedup.line_dedup(docs, max_ratio=SHARE, dropped_col=gone)
    changed = F.when(F.col(gone) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays: the one with the smallest id, those without an id last."""
    saved = Saved(spark)
    found = saved(ngram_join.jaccard_components(docs, WORDS, PERCENT).where("group_id is not null").select("doc_id", "text_hash", "group_id"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = found.groupBy("group_id").agg(F.min(key).alias("best"), F.count("*").alias("rows")).where("rows > 1")
    best = saved(best.select(F.col("group_id").alias("_g"), "best"))
    rows = found.join(F.broadcast(best) if best.count() <= SEND else best, F.col("group_id") == F.col("_g")).groupBy("doc_id", "text_hash").agg(F.first(key.eqNullSafe(F.col("best"))).alias("stays"), F.count("*").alias("times"))
    rows = saved(rows.where("not stays or times > 1").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "stays"))
    row = unused(docs, "_row")
    whole = docs.select(F.struct(*_columns(docs)).alias(row), F.col("doc_id").alias("_d"), F.xxhash64("text").alias("_h"))
    same = F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash"))
    out = whole.join(F.broadcast(rows) if rows.count() <= SEND else rows, same, "left_anti").select(row)
    again = rows.where("stays")
    if n := again.count():  # equal rows of which one stays
        one = whole.join(F.broadcast(again) if n <= SEND else again, same, "left_semi").groupBy("_d", "_h").agg(F.min(row).alias(row))
        out = out.unionByName(one.select(row))
    return out.select(*[F.col(row).getField(c).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in the order of training positions."""
    mixed = mixing.mix(docs).where("passes > 0")
    plan = Saved(spark)(mixed.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("source").alias("_source")).agg(F.max("positions").alias("_positions")))
    plan = F.broadcast(plan) if plan.count() <= SEND else plan
    row = unused(docs, "_row")
    whole = docs.select(F.struct(*_columns(docs)).alias(row), F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.xxhash64(F.lit(42), "doc_id", "text").alias("_h"))
    out = whole.join(plan, (F.col("_h") == F.col("_hash")) & F.col("_d").eqNullSafe(F.col("_id")) & F.col("_s").eqNullSafe(F.col("_source"))).select(row, "_d", F.explode("_positions").alias("_at"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartitionByRange(n, "_at", "_d").sortWithinPartitions("_at", "_d")
    return out.select(*[F.col(row).getField(c).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts, one row for each of docs; a null text counts as empty."""
    return bpe.digests(bpe.bpe_encode(docs))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_boilerplate), ("ngram_join", drop_near_duplicates), ("mixing", mix_sources), ("bpe", encode)]

#: Lexicon learning and BPE aren't SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table. What a stage read and wrote besides is removed once its result is written."""
    docs, saved, before = table(spark, sf_dir, "documents"), Saved(spark), None
    for _, stage in STAGES:
        own = len(Saved.roots)
        out = saved(stage(spark, docs, sf_dir))
        remove(spark, *Saved.roots[own:], *([before] if before else []))
        del Saved.roots[own:]
        docs, before = out, out._understory_path
    return docs
