"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from understory import queries as core

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        c.execute(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def norm(v):
    return round(v, 4) if isinstance(v, float) else float(v) if hasattr(v, "as_tuple") else v


@pytest.mark.parametrize("name", sorted(core.ORACLE_SQL))
def test_sql(name, spark, sf, duck):
    df = core.QUERIES[name](spark, sf)
    r = duck.execute(core.ORACLE_SQL[name])
    cols = [d[0] for d in r.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    want = sorted((tuple(norm(x[cols.index(c)]) for c in order) for x in r.fetchall()), key=repr)
    assert sorted((tuple(norm(x[c]) for c in order) for x in df.collect()), key=repr) == want


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_whole_tables(spark, sf):
    """No voxel, cloud, query vector or owner is left out."""
    n = core.voxels(spark, sf).count()
    assert core.QUERIES["geometry_features"](spark, sf).count() == core.QUERIES["point_density"](spark, sf).count() == n
    points = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert core.QUERIES["merge_intersect"](spark, sf).count() == points
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").where("vec_id % 50 = 0").count()
    assert core.QUERIES["knn_vectors"](spark, sf).count() == 5 * vectors


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.ORACLE_SQL)))
def test_without_sql(name, spark, sf):
    """These run; what they give is tested on fixtures."""
    assert core.QUERIES[name](spark, sf).count() > 0


def test_hulls_hold_all_points(spark, sf, duck):
    """Every point lies on the inner side of each edge of its tree's ring, and the ring's corners are points."""
    rings = core.inventory.hull_areas(core.src.seg(spark, sf)).select("segmentation_source", "instance_id", "ring", "convex_hull_area_m2").collect()
    pts = duck.execute(f"with {core.src.SEG_SQL} select src, id, X, Y from seg where Z > 0.5").fetchall()
    of: dict = {}
    for s, i, x, y in pts:
        of.setdefault((s, i), []).append((x, y))
    assert len(rings) == len(of)
    for r in rings:
        ring, own = [(p.x, p.y) for p in r.ring], of[r.segmentation_source, r.instance_id]
        assert set(ring) <= set(own)
        if len(ring) > 2:
            for a, b in zip(ring, ring[1:] + ring[:1]):
                assert max((b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) for x, y in own) < 1e-9
            area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2
            assert r.convex_hull_area_m2 == pytest.approx(area, rel=1e-9)
