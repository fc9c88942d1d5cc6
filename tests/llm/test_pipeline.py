"""The pipeline's stages at the smallest size, and the line-dedup query against its SQL."""

import collections
import os

import duckdb
from pyspark.sql import functions as F

from understory.llm import line_dedup, ngram_join


def test_pipeline(spark, sf):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(p.STAGES):
        docs = stage(spark, docs, sf).cache()
        seen[name] = docs.collect()
        assert i == len(p.STAGES) - 1 or docs.columns == columns
    before = [(r.doc_id, r.text) for r in seen["line_dedup"]]
    keep = {i for i, (_, c) in ngram_join.brute(before, 5, 80).items() if i == c}
    assert {r.doc_id for r in seen["ngram_join"]} == keep
    assert len(seen["bpe"]) == len(seen["mixing"]) and {r.doc_id for r in seen["mixing"]} <= keep
    assert {r.doc_id for r in seen["toxicity"]} == {i for i, _ in before}


DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def awkward(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, copies under one id and without one, ties."""
    near = " ".join(f"n{i}" for i in range(120))
    rows = [(1, near, "en", "a", 5, "x"), (2, near + " end", None, "b", None, "x"), (2, "another text of the id two", "en", "b", 0, None), (None, near, "en", None, 0, "x")]
    rows += [(None, "no id and no other", "en", "a", 0, "x")] * 3 + [(7, "a repeated row here now", "en", "a", 0, "x")] * 2
    rows += [(8, None, None, None, None, None), (9, "", "en", "a", 0, "x"), (9, "", "en", "a", 0, "x"), (10, "long word " * 40_000, "en", "b", 0, "x"), (11, near.upper(), "en", "b", 0, "x")]
    return spark.createDataFrame(rows, DOCS)


def test_near_duplicates_by_row(spark):
    import corpus_pipeline as p

    out = p.drop_near_duplicates(spark, awkward(spark), "")
    assert out.columns == awkward(spark).columns
    got = sorted((str(r.doc_id), (r.text or "-")[:12]) for r in out.collect())
    assert got == sorted([("1", "n0 n1 n2 n3 "), ("2", "another text"), ("None", "no id and no"), ("7", "a repeated r"), ("8", "-"), ("9", "-"), ("9", "-"), ("10", "long word lo")])


def test_stages_on_awkward_rows(spark, sf):
    import corpus_pipeline as p

    for _, stage in p.STAGES:
        out = stage(spark, awkward(spark), sf)
        rows = out.collect()
        none = stage(spark, awkward(spark).limit(0), sf)
        assert none.columns == out.columns and none.count() == 0 and rows
        if stage is not p.encode:
            assert out.columns == awkward(spark).columns
    words = lambda df: sorted((r.text or "") for r in df.collect())
    d = awkward(spark)
    assert words(p.drop_toxic(spark, d, sf)) == words(d) == words(p.drop_boilerplate(spark, d, sf))
    odd = d.withColumns({c: F.lit(c) for c in ("_score", "_matches", "_dropped", "_row", "_id", "_at", "_hash", "_positions")})
    for _, stage in p.STAGES[:4]:
        out = stage(spark, odd, sf)
        assert out.columns == odd.columns and out.where("_score = '_score' and _row = '_row' and _at = '_at'").count() == out.count() > 0


def test_run(spark, sf):
    """run() gives what the stages give one after another, and leaves no table but the last."""
    import corpus_pipeline as p
    from understory.llm import bpe
    from understory.llm.common import Saved, table

    got = collections.Counter(r.ids_sha256 for r in p.run(spark, sf).collect())
    docs = table(spark, sf, "documents")
    for _, stage in p.STAGES[:-1]:
        docs = Saved(spark)(stage(spark, docs, sf))
    want = collections.Counter(r.ids_sha256 for r in bpe.digests(bpe.bpe_encode(docs)).collect())
    assert got == want


def test_line_dedup_sql(spark, sf):
    c, p = duckdb.connect(), f"{sf}/documents.parquet"
    c.execute(f"create view documents as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    assert sorted(c.execute(line_dedup.OP4_SQL).fetchall(), key=str) == sorted((tuple(r) for r in line_dedup.op4_line_dedup(spark, sf).collect()), key=str)


def test_rare_boilerplate(spark):
    """A line on 3 per cent of a source's pages leaves; one on four pages may be chance and stays."""
    import corpus_pipeline as p

    rows = [(i, "\n".join([f"body {i}", *(["rare foot"] if i < 6 else []), *(["chance"] if 10 <= i < 14 else [])]), "en", "a", 0) for i in range(200)]
    out = {r.doc_id: r for r in p.drop_boilerplate(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "").collect()}
    assert all(out[i].text == f"body {i}" and out[i].n_chars == len(out[i].text) for i in range(6))
    assert all(out[i].text == f"body {i}\nchance" for i in range(10, 14)) and len(out) == 200
