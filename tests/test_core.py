import heapq
import math
import struct

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from understory.functions import crs
from understory.functions import scalar as fn
from understory.model import Config, ConfigError, SegmentationSpec, identity_seed, parse_args, partition_count
from understory.operators import circle, features, graph, hull, inventory, neighbors, sampling, terrain, voxel
from understory.operators.nearest import nearest_points
from understory.plans import run as plans
from understory.sources import copc, output
from understory.sources import points as src

F5 = [(1.0, 1.0, 3.0, 1, 7.0, 0.8, 0.4), (2.0, 2.0, 5.0, 2, 8.0, 0.7, 0.5), (3.0, 3.0, 4.0, 1, 7.0, 0.9, 0.6), (4.0, 4.0, 6.0, 2, 8.0, 0.6, 0.7)]
SPEC = SegmentationSpec("PredInstance_FM", "sp", "prob", "score")


def cloud(spark, rows=F5):
    return spark.createDataFrame(rows, "X double, Y double, Z double, PredInstance_FM int, sp double, prob double, score double")


def test_settings():
    assert SPEC.label == "FM"
    assert identity_seed(42, "PredInstance_FM", 2) == 2091750084
    assert [partition_count(n) for n in (29_011, 192_000_000, 668_000_000, 4_260_000_000, 10**11)] == [64, 64, 256, 2048, 4096]
    paths, cfg = parse_args("--input a --output-dir b --instance-attribute PredInstance_FM --non-tree-ids 0,2 --dbh-runs 3".split())
    assert cfg.specs[0].non_tree_ids == (0, 2) and cfg.dbh_runs == 3 and paths["input"] == "a"
    paths, cfg = parse_args("--input a --output-dir b --inventory-attributes PredInstance_A,PredInstance_B --dtm-strategy auto --read-chunk-size 500 --inventory-workers 4 --scratch-dir /tmp --dbh-evidence no --debug-outputs 1 --seed-mode automatic --seed-file s".split())
    assert [s.instance for s in cfg.specs] == ["PredInstance_A", "PredInstance_B"] and not cfg.dbh_evidence and cfg.debug_outputs and "seed-file" not in paths
    for bad in ("--input a --output-dir b --instance-attribute x --dtm-strategy fast", "--input a --output-dir b --instance-attribute x --seed-mode supplied", "--input a --output-dir b --instance-attribute x --inventory-workers many", "--input a --output-dir b", "--input a --output-dir b --what 1", "--input a --output-dir b --instance-attribute x --instance-attribute x", "--input a --output-dir b --instance-attribute x --slice-width 0.2", "--input a --output-dir b --instance-attribute x --species-attribute s", "--input a --output-dir b --instance-attribute Zref", "--input a --output-dir b --instance-attribute PredInstance_CSP --enable-csp true"):
        with pytest.raises(ConfigError):
            parse_args(bad.split())


def test_two_trees(spark):
    seg = src.unpivot(cloud(spark), (SPEC,)).withColumn("Zref", F.col("Z")).withColumn("Z", F.col("Z") - 2)
    rows = {r.instance_id: r for r in inventory.inventory(seg, Config(specs=(SPEC,))).collect()}
    one = rows[1]
    assert (one.point_count, one.x, one.y, one.height_m, one.species_id, one.dbh_m, one.dbh_quality_code) == (2, 2.0, 2.0, 1.0, 7.0, None, 1)
    assert (one.z, one.dbh_quality_label, one.dbh_runs, one.dbh_band_points, one.metrics_point_count) == (3.5, "dbh_unavailable", 1, 2.0, 2)
    assert rows[2].z == 5.0 and rows[2].dbh_quality_code == 1  # one of its points is in the band: its mean
    assert one.species_prob == pytest.approx(0.85)
    assert one.pred_score_values == '[{"score":0.4,"point_count":1},{"score":0.6,"point_count":1}]'
    only = src.unpivot(cloud(spark), (SegmentationSpec("PredInstance_FM", non_tree_ids=(0, 2)),))
    assert {r.instance_id for r in only.collect()} == {1}


def test_vote_and_medians(spark):
    rows = [(0.0, 0.0, 0.0, 1, 4.0, 0.8, 0.9), (0.0, 0.0, 0.0, 1, 4.0, 0.6, 0.9), (0.0, 0.0, 0.0, 1, 7.0, 0.9, 0.2), (0.0, 0.0, 0.0, 2, -1.0, -1.0, -1.0)]
    seg = src.unpivot(cloud(spark, rows), (SPEC,))
    v = inventory.species_vote(seg).collect()
    assert [(r.instance_id, r.species_id, round(r.species_prob, 9), round(r.species_conflict_fraction, 9)) for r in v] == [(1, 4.0, 0.7, round(1 / 3, 9))]
    assert {r.instance_id: r.pred_score_values for r in inventory.score_histogram(seg).collect()} == {1: '[{"score":0.9,"point_count":2},{"score":0.2,"point_count":1}]'}
    m = spark.createDataFrame([("a", x) for x in (1.0, 2.0, 2.0, 4.0)] + [("b", x) for x in (1.0, 2.0, 2.0, 4.0, 5.0)] + [("c", None)], "k string, v double")
    assert {r.k: r["median"] for r in inventory.weighted_median(m, ("k",), "v").collect()} == {"a": 2.0, "b": 2.0}


def test_summary(spark):
    t = spark.createDataFrame([("A", "d", 1, 0.3, 18.0), ("A", "d", 2, None, 20.0)], "segmentation_source string, instance_dimension string, instance_id long, dbh_m double, height_m double")
    s = inventory.stand_summary(t, 10_000.0).first()
    assert (s.tree_count, s.dbh_measured_count, s.dbh_coverage_fraction, s.basal_area_m2_ha, s.trees_per_ha, s.mean_dbh_m, s.mean_height_m) == (2, 1, 0.5, None, 2.0, 0.3, 19.0)


def test_merge(spark):
    a = spark.createDataFrame([(1.0, 1.0, 1.0, 5)], "X double, Y double, Z double, Intensity int")
    b = spark.createDataFrame([(1.0, 1.0, 1.0, 5, 2)] * 2, "X double, Y double, Z double, Intensity int, Classification int")
    assert src.merge([a, b]).columns == ["X", "Y", "Z", "Intensity", "oci"]
    f = src.merge([a, b, a.limit(0)], fill=True)
    assert f.count() == 3 and f.where("Classification is null").count() == 1
    for bad in ([], [1], [a.drop("Z")]):
        with pytest.raises(ConfigError):
            src.merge(bad)
    with pytest.raises(ConfigError):
        src.merge([a, b], crs=["EPSG:1", "EPSG:2"])
    with pytest.raises(ConfigError):
        src.require(a, ["nope"])


def test_seed_checks(spark):
    ok = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0), (2.0, 1.0, 1.0, 2.0)], "X double, Y double, Z double, TreeID double")
    assert src.check_seeds(ok).count() == 2
    with pytest.raises(ConfigError):
        src.check_seeds(ok.unionByName(ok))


def test_terrain_hole_is_an_error(spark):
    dtm = spark.createDataFrame([(0, 0, 2.0)], "row long, col long, z float")
    p = spark.createDataFrame([(0.5, 0.5, 5.0)], "X double, Y double, Z double")
    assert terrain.normalise_height(p, dtm, 1.0).first().Z == 3.0
    with pytest.raises(PySparkException):
        terrain.normalise_height(p.withColumn("X", F.lit(9.0)), dtm, 1.0).collect()


def test_inventory_stops_without_terrain(spark):
    """A tree beyond the terrain must not vanish from the inventory."""
    dtm = spark.createDataFrame([(r, c, 0.0) for r in range(10) for c in range(10)], "row long, col long, z float")
    far = [*F5, (50.0, 50.0, 9.0, 3, 7.0, 0.8, 0.4)]
    cfg = Config(specs=(SPEC,), dtm_resolution=1.0, stand_area_m2=100.0)
    assert plans.inventory_from_points(cloud(spark), cfg, dtm)[0].count() == 2
    for bad in (dtm, dtm.unionByName(spark.createDataFrame([(50, 50, math.nan)], "row long, col long, z float"))):
        with pytest.raises(PySparkException, match="outside the terrain"):
            plans.inventory_from_points(cloud(spark, far), cfg, bad)


def test_terrain_model_of_a_plane(spark):
    p = spark.range(0, 6000).select((F.col("id") % 60 * 0.5).alias("X"), (F.floor(F.col("id") / 60) * 0.5).alias("Y")).withColumn("Z", F.col("X") * 0.1 + F.col("Y") * 0.05).withColumn("Classification", F.lit(2))
    d = terrain.make_dtm(p, 1.0, tile=20.0, candidate=0.5).collect()
    # a candidate stands at its cell's centre, a quarter metre from its point
    assert d and max(abs(r.z - ((r.col + 0.5) * 0.1 + (r.row + 0.5) * 0.05)) for r in d) < 0.05
    bumps = p.unionByName(p.where("X > 10 and X < 12 and Y > 10 and Y < 12").withColumn("Z", F.col("Z") + 8)).drop("Classification")
    low = terrain.make_dtm(bumps, 1.0, tile=30.0, candidate=0.5).collect()
    assert max(r.z for r in low) < 7


def test_terrain_covers_all_points(spark):
    """Ground stands in one corner of the cloud only; the terrain goes as far as the points of the tile do."""
    p = spark.range(0, 400).select((F.col("id") % 20 * 0.5).alias("X"), (F.floor(F.col("id") / 20) * 0.5).alias("Y"), F.lit(2.0).alias("Z"), F.lit(2).alias("Classification"))
    tree = spark.createDataFrame([(14.5, 13.5, 9.0, 5), (0.2, 14.9, 8.0, 5)], "X double, Y double, Z double, Classification int")
    points = p.unionByName(tree)
    d = terrain.make_dtm(points, 0.3, tile=20.0, candidate=0.5)
    assert {round(r.Z, 3) for r in terrain.normalise_height(points, d, 0.3).where("Classification = 5").collect()} == {7.0, 6.0}
    assert d.count() == d.select("row", "col").distinct().count()


def test_radius_and_knn(spark):
    rng = np.random.default_rng(3)
    xyz = rng.uniform(0, 5, (120, 3))
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(xyz)], "id long, X double, Y double, Z double")
    d = np.sqrt(((xyz[:, None] - xyz[None]) ** 2).sum(-1))
    got = {(r.src, r.dst) for r in neighbors.radius_join(df, df, 1.0).collect()}
    assert got == {(i, j) for i in range(120) for j in range(120) if i != j and d[i, j] <= 1.0}
    near: dict = {}
    for r in neighbors.knn(df, 4, size=0.3).collect():
        near.setdefault(r.src, {})[r["rank"]] = r.dst
    assert all([near[i][k] for k in (1, 2, 3, 4)] == list(np.argsort(d[i], kind="stable")[:4]) for i in range(120))


def test_knn_of_a_lone_point(spark):
    """It lies more than 2,048 cells away and still has its neighbours."""
    df = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 1.0, 0.0, 0.0), (3, 9000.0, 0.0, 0.0), (4, math.nan, 0.0, 0.0)], "id long, X double, Y double, Z double")
    got = {(r.src, r["rank"]): r.dst for r in neighbors.knn(df, 2).collect()}
    assert got == {(1, 1): 1, (1, 2): 2, (2, 1): 2, (2, 2): 1, (3, 1): 3, (3, 2): 2}


def test_features_match_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(50, 3)) * [3, 1, 0.2]
    c = spark.createDataFrame([tuple(map(float, p)) for p in x], "X double, Y double, Z double").groupBy().agg(*features.covariance())
    r = features.eigen_features(features.eigen_decomposition(c)).first()
    val, vec = np.linalg.eigh(np.cov(x.T))
    assert (r.l1, r.l2, r.l3) == pytest.approx(tuple(val[::-1]), rel=1e-6)
    assert r.Verticality == pytest.approx(1 - abs(vec[2, 0]), abs=1e-6)
    assert r.Linearity == pytest.approx((val[2] - val[1]) / val[2])


def test_components_and_paths(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (5, 4)], "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6)], "id long")
    assert {r.id: r.component for r in graph.connected_components(nodes, e).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6}
    rng = np.random.default_rng(5)
    edges = [(a, b, float(rng.uniform(0.1, 3))) for a in range(25) for b in range(a + 1, 25) if rng.random() < 0.15]
    adj: dict = {}
    for a, b, w in edges:
        adj.setdefault(a, []).append((b, w))
        adj.setdefault(b, []).append((a, w))

    def dijkstra(s):
        d, q = {s: 0.0}, [(0.0, s)]
        while q:
            x, u = heapq.heappop(q)
            for v, w in adj.get(u, ()) if x <= d[u] else ():
                if x + w < d.get(v, math.inf):
                    d[v] = x + w
                    heapq.heappush(q, (x + w, v))
        return d

    far = {s: dijkstra(s) for s in (0, 7, 11)}
    got: dict = {}
    for r in graph.nearest_seeds(spark.createDataFrame(edges, "a long, b long, w double"), spark.createDataFrame([(s, s) for s in far], "id long, seed long"), 2).collect():
        got.setdefault(r.id, []).append((r["rank"], r.seed, round(r.dist, 9)))
    for v in range(25):
        best = sorted((round(d[v], 9), s) for s, d in far.items() if v in d)[:2]
        assert sorted(got.get(v, [])) == [(i + 1, s, d) for i, (d, s) in enumerate(best)]


def test_csp(spark):
    line = lambda x0: [(x0, 0.0, z / 10) for z in range(1, 40)]
    df = spark.createDataFrame(line(0.0) + line(5.0) + [(50.0, 50.0, 1.0)], "X double, Y double, Z double")
    seeds = spark.createDataFrame([(0.0, 0.0, 0.2, 1), (5.0, 0.0, 0.2, 2)], "X double, Y double, Z double, TreeID long")
    got = {(r.X, r.TreeID) for r in graph.csp_cost_segmentation(df, seeds, 0.3).collect()}
    assert got == {(0.0, 1), (5.0, 2)}  # the lone voxel is outside the graph
    for bad in (seeds.drop("Z"), seeds.limit(0)):
        with pytest.raises(ValueError):
            graph.csp_cost_segmentation(df, bad, 0.3)
    with pytest.raises(ValueError):
        graph.csp_cost_segmentation(df, seeds, 0)


def test_circles():
    i = np.arange(1, 51)
    t = np.linspace(0, np.pi, 50)
    xy = np.column_stack([10 + 0.3 * np.cos(t) + 0.001 * np.sin(i), 20 + 0.3 * np.sin(t) + 0.001 * np.cos(i)])
    f = circle.ransac_circle_fit(xy, 1000, 0.01, 3, seed=1)
    assert f["inliers"] == 50 and f["bins"] in (19, 20)
    assert abs(f["cx"] - 10) < 0.005 and abs(f["cy"] - 20) < 0.005 and abs(f["r"] - 0.3) < 0.005
    assert circle.ransac_circle_fit(xy[:2])["r"] is None
    assert circle.reject_radii([0.2, 0.21, 0.3, 0.03, None, 0.2]) == [0.2, 0.21, None, None, None, 0.2]
    assert circle.slice_status([None, 0.2, 0.27, 0.03, 0.21, None], [2, 9, 9, 9, 9, 9]) == ["too_few_points", "fitted", "growth_1_3x", "radius_below_0_04m", "fitted", "no_fit"]
    assert circle.slice_status([0.2] * 9 + [9.0])[-1] == "outlier_2sd" and circle.slice_status([0.01, 0.2])[0] == "fitted"
    runs = [{"dbh": d, "code": c} for d, c in ((0.3, 4), (None, 3), (0.4, 4))]
    assert circle.median_run(runs)["dbh"] == 0.3
    none = circle.median_run([runs[1], runs[1], runs[0]])
    assert (none["dbh"], none["code"], none["fitted"], none["spread"], none["chosen"]) == (None, 3, 1, 0.0, 0)
    x = np.arange(8.0)
    assert circle.Spline(x, 2 * x + 1, 3)(3.3) == pytest.approx(7.6) and circle.Spline(x, 2 * x + 1)(9.0) == pytest.approx(19.0)


def test_pratt_stops():
    """Exact circles come back; where the steps leave the rules the root is 0, as in the published fit."""
    t = np.array([0.1, 0.9, 2.0, 3.3, 5.0])
    c = circle.pratt_fit(np.array([3 + 0.4 * np.cos(t)]), np.array([-2 + 0.4 * np.sin(t)]))
    assert c[0] == pytest.approx([3, -2, 0.4], abs=1e-9)
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(500, 5)), rng.normal(size=(500, 5))

    def one(x, y):
        mx, my = x.mean(), y.mean()
        u, v = x - mx, y - my
        z = u * u + v * v
        m = lambda a, b: float((a * b).mean())
        xx, yy, xy, xz, yz, zz = m(u, u), m(v, v), m(u, v), m(u, z), m(v, z), m(z, z)
        mz, cov = xx + yy, xx * yy - xy * xy
        a2, a1 = 4 * cov - 3 * mz * mz - zz, (zz - mz * mz) * mz + 4 * cov * mz - xz * xz - yz * yz
        a0 = xz * xz * yy + yz * yz * xx - 2 * xz * yz * xy - (zz - mz * mz) * cov
        root, last = 0.0, math.inf
        for i in range(20):
            f = a0 + root * (a1 + root * (a2 + 4 * root * root))
            if abs(f) > abs(last):
                root = 0.0
                break
            last, new = f, root - f / (a1 + root * (2 * a2 + 16 * root * root))
            near = abs((new - root) / new) < 1e-12
            root = new
            if near:
                break
            root = 0.0 if i == 19 or root < 0 else root
        det = root * root - root * mz + cov
        a, b = (xz * (yy - root) - yz * xy) / det / 2, (yz * (xx - root) - xz * xy) / det / 2
        return a + mx, b + my, math.sqrt(a * a + b * b + mz + 2 * root)

    got = circle.pratt_fit(x, y)
    assert all(got[i] == pytest.approx(one(x[i], y[i]), rel=1e-6, abs=1e-9) for i in range(500))


def test_nearest_points():
    rng = np.random.default_rng(7)
    for dims, n, m, k in ((3, 300, 300, 10), (2, 50, 400, 8), (2, 5, 20, 8), (3, 200, 3, 4)):
        p, q = rng.normal(size=(n, dims)) ** 3, rng.normal(size=(m, dims)) * 2
        got = nearest_points(p, q, k, room=2000)
        d = np.sqrt(((q[:, None] - p[None]) ** 2).sum(2))
        assert np.allclose(np.sort(np.take_along_axis(d, got, 1), 1), np.sort(d, 1)[:, : min(k, n)])
    xyz = rng.normal(size=(200, 3)) * [3, 1, 0.1]
    f = circle.stem_features(xyz, 12)
    i = np.argsort(((xyz - xyz[9]) ** 2).sum(1))[:12]
    val, vec = np.linalg.eigh(np.cov(xyz[i].T))
    assert f[9] == pytest.approx([(val[1] - val[0]) / val[2], 1 - abs(vec[2, 0])])


def stem(radius=0.2, low=0.0, high=6.0, step=0.05, n=60, x=10.0, y=20.0, lean=0.0, seed=1):
    rng, out = np.random.default_rng(seed), []
    for z in np.arange(low, high, step):
        a = np.linspace(0, 2 * np.pi, n, endpoint=False)
        r = radius + rng.normal(0, 0.001, n)
        out.append(np.column_stack([x + lean * z + r * np.cos(a), y + r * np.sin(a), np.full(n, z)]))
    return np.concatenate(out)


def test_diameter_codes():
    cfg, mean = Config(), lambda b: pytest.approx(tuple(b[:, :2].mean(0)))
    band = lambda p: p[(p[:, 2] > cfg.slice_min) & (p[:, 2] < cfg.slice_max)]
    few = circle.fit_tree(stem()[:2] + [0, 0, 1], None, cfg, 1)
    assert (few["code"], few["dbh"], few["slices"]) == (1, None, [])
    good = band(stem())
    four = circle.fit_tree(good, None, cfg, 1)
    assert four["code"] == 4 and four["dbh"] == pytest.approx(0.4, abs=0.01) and len(four["slices"]) == 19 and abs(four["x"] - 10) < 0.01
    two = circle.fit_tree(band(stem(low=0.3, high=0.8)), None, cfg, 1)
    assert two["code"] == 2 and two["dbh"] == pytest.approx(0.4, abs=0.01) and (two["x"], two["y"]) == mean(band(stem(low=0.3, high=0.8)))
    thin = band(stem(high=5.0, step=0.2, n=2))
    none = circle.fit_tree(thin, None, cfg, 1)  # slices of two points: no circle is left, still code 2 at the mean
    assert (none["code"], none["dbh"]) == (2, None) and (none["x"], none["y"]) == mean(thin) and {s["status"] for s in none["slices"]} == {"too_few_points"}
    wide = band(stem(radius=0.7))
    three = circle.fit_tree(wide, None, cfg, 1)
    assert (three["code"], three["dbh"]) == (3, None) and (three["x"], three["y"]) == mean(wide)
    lean = band(np.concatenate([stem(high=2.0), stem(low=2.0, x=30.0)]))  # the spline's place is over 5 m off the mean
    assert circle.fit_tree(lean, None, cfg, 1)["code"] == 3
    # the geometry filter: a plane of loose points beside the stem doesn't take part
    row = circle.measure_band(good, good[:, 2] + 100, None, cfg, "d", 1)
    assert row[2] == pytest.approx(101.3) and row[3] == pytest.approx(0.4, abs=0.02) and row[4] == 4 and row[5] == 5
    assert sum(f["reported"] for f in row[9]) == 1 and next(f for f in row[9] if f["reported"])["dbh_m"] == row[3]
    assert all(s["n_fit_points"] < s["n_points"] and s["ground_z"] == pytest.approx(100) for s in row[10] if s["n_points"] >= 100)


def trees(spark, parts):
    rows = [(float(x), float(y), float(z), i) for i, p in parts.items() for x, y, z in p]
    return spark.createDataFrame(rows, "X double, Y double, Z double, TreeID long")


def test_tree_rows(spark, monkeypatch):
    """Position, height, label and fallbacks of each kind of tree, on thinned points."""
    low = np.array([[1.0, 1.0, 0.1], [1.0, 2.0, 0.2], [2.0, 1.0, 0.4]])
    crown = np.array([[5.0, 5.0, 8.0], [6.0, 5.0, 9.0], [5.0, 7.0, 7.0], [5.0, 5.0, 8.0]])
    p = trees(spark, {1: stem(step=0.1), 2: low, 3: crown})
    seg = src.unpivot(p.withColumn("Zref", F.col("Z") + 50), (SegmentationSpec("TreeID"),), ("X", "Y", "Z", "Zref"))
    rows = {r.instance_id: r for r in inventory.inventory(seg, Config(dbh_runs=3)).collect()}
    assert rows[1].dbh_quality_label == "spline_fit" and rows[1].z == pytest.approx(51.3) and rows[1].dbh_runs_fitted == 3 and '"reported":true' in rows[1].dbh_fits
    # nothing above half a metre, and nothing in the band: code 9, the thinned points' median place and lowest height
    assert [(rows[i].dbh_quality_code, rows[i].dbh_quality_label, rows[i].dbh_m, rows[i].dbh_runs) for i in (2, 3)] == [(9, "dbh_unavailable", None, None)] * 2
    assert (rows[2].x, rows[2].y, rows[2].z, rows[2].convex_hull_area_m2) == (1.0, 1.0, 50.1, 0.5)
    assert (rows[3].x, rows[3].y, rows[3].z, rows[3].point_count, rows[3].metrics_point_count, rows[3].height_m) == (5.0, 5.0, 57.0, 4, 3, 2.0)
    bad = circle.tree_diameters(seg.withColumn("X", F.when(F.col("instance_id") == 1, F.lit(math.nan)).otherwise(F.col("X"))), Config(dbh_runs=1, random_seed=None))
    assert bad.select("dbh_quality_code", "dbh_m").first()[:] == (9, None)  # a failure costs one tree, not the job
    with pytest.raises(PySparkException):
        circle.tree_diameters(seg, Config(dbh_runs=1, random_seed=None), strict=True).collect()


def test_forest_inventory(spark):
    p = trees(spark, {1: stem(step=0.1), 2: stem(radius=0.1, x=15.0, step=0.1), 0: stem(x=1.0, step=0.5)}).withColumn("Znorm", F.col("Z")).withColumn("Z", F.col("Z") + 7).withColumn("label", (F.col("TreeID") == 1).cast("int"))
    got = {r.TreeID: r for r in inventory.forest_inventory(p, return_evidence=True).collect()}
    assert set(got) == {1, 2} and abs(got[1].DBH - 0.4) < 0.02 and abs(got[2].DBH - 0.2) < 0.02 and got[1].Z == pytest.approx(8.3) and got[1].quality_flag == 4 and len(got[1].dbh_slices) == 19
    assert got[1].Height == pytest.approx(5.9, abs=1e-6) and got[1].ConvexHullArea == pytest.approx(math.pi * 0.04, rel=0.05)
    stems = inventory.forest_inventory(p, use_stem_segmentation=True, semantic_colname="label", stem_semantic_label=1).collect()
    assert [r.TreeID for r in stems] == [1]
    simple = {r.TreeID: r for r in inventory.forest_inventory_simple(p).collect()}
    assert set(simple) == {1, 2} and abs(simple[1].DBH - 0.4) < 0.02 and simple[1].quality_flag == 4 and simple[1].Z == pytest.approx(7.0)
    for bad in ({"width": 0.2}, {"tree_id_col": "nope"}, {"use_stem_segmentation": True}):
        with pytest.raises(ConfigError):
            inventory.forest_inventory(p, **bad)
    with pytest.raises(ConfigError):
        inventory.forest_inventory(p.drop("Znorm"))


def test_areas(spark, tmp_path):
    """Holes are no part of an area, and what polygons share counts once."""
    square = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    assert fn.polygons_area([[square(0, 0, 10), square(2, 2, 3)]]) == pytest.approx(91)
    assert fn.polygons_area([[square(0, 0, 10)], [square(5, 5, 10)]]) == pytest.approx(175)
    assert fn.polygons_area([[square(0, 0, 4), square(1, 1, 2)], [square(1, 1, 1)]]) == pytest.approx(13)
    assert fn.polygons_area([[[(0, 0), (4, 4), (4, 0), (0, 4)]]]) == pytest.approx(8) and fn.polygons_area([]) == 0
    (tmp_path / "a.json").write_text('{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[0,0],[10,0],[10,10],[0,10],[0,0]],[[2,2],[5,2],[5,5],[2,5],[2,2]]]}}')
    area = src.read_aoi(spark, f"{tmp_path}/a.json")
    t = spark.createDataFrame([(1.0, 1.0), (3.0, 3.0), (11.0, 1.0), (6.0, 6.0)], "x double, y double")
    assert sorted(r.x for r in inventory.in_area(t, area).collect()) == [1.0, 6.0] and fn.polygons_area(area) == pytest.approx(91)
    (tmp_path / "b.json").write_text('{"type":"Point","coordinates":[0,0]}')
    with pytest.raises(ConfigError):
        src.read_aoi(spark, f"{tmp_path}/b.json")


def test_paths_that_dont_end(spark):
    e = spark.createDataFrame([(i, i + 1, 1.0) for i in range(6)], "a long, b long, w double")
    with pytest.raises(RuntimeError):
        graph.nearest_seeds(e, spark.createDataFrame([(0, 0)], "id long, seed long"), 1, most_rounds=3)


def test_stem_diameter(spark):
    s = src.stems(spark, 2).select(F.lit("S").alias("segmentation_source"), F.lit("stem").alias("instance_dimension"), "instance_id", "X", "Y", "Z")
    one = {r.instance_id: r for r in circle.tree_diameters(s, Config(dbh_runs=3)).collect()}
    assert all(abs(one[i].dbh_m - 2 * (0.1 + 0.05 * i)) < 0.02 and len(one[i].dbh_slices) == 19 for i in (1, 2))
    again = {r.instance_id: r for r in circle.tree_diameters(s.repartition(7).orderBy(F.desc("Z")), Config(dbh_runs=3)).collect()}
    assert one == again


def test_hulls(spark):
    assert hull.convex_hull(np.array([(i, i) for i in range(10)], float)).tolist() == [[0, 0], [9, 9]]
    df = spark.createDataFrame([(1, 0.0, 0.0), (1, 2.0, 0.0), (1, 2.0, 2.0), (1, 0.0, 2.0), (1, 1.0, 1.0), (2, 0.0, 0.0)], "k int, X double, Y double").repartition(3)
    got = {r.k: r.a for r in hull.hull_vertices(df, ("k",)).select("k", fn.ring_area(F.col("ring")).alias("a")).collect()}
    assert got == {1: 4.0, 2: None}


def test_sampling_and_colours(spark):
    v = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(11)], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in sampling.fds(v, 3).orderBy("order").collect()] == [10, 0, 5]
    assert sampling.fds(v, 0.5).count() == 6 and sampling.fds(v, 99).count() == 11
    near = {i: [j for j in (i - 1, i + 1) if 0 < j < 9] for i in range(1, 9)}
    c = sampling.choose_colours(near, dict.fromkeys(near, 1.0), sampling.get_pal("rainbow")(8))
    assert all(c[i] != c[i + 1] for i in range(1, 8))
    assert sampling.get_pal("boring")(2) == [(222, 226, 230), (25, 28, 31)] and sampling.get_pal(("#000000", "#ffffff"))(3)[1] == (128, 128, 128) and len(sampling.PALETTES) == 9
    with pytest.raises(ValueError):
        sampling.get_pal("nope")
    df = spark.createDataFrame([(float(i % 30), float(i // 30), 0.0, i, 1, 2, 3) for i in range(300)], "X double, Y double, Z double, TreeID long, R int, G int, B int")
    rows = {r.TreeID: r for r in sampling.color_ids(df).collect()}
    assert (rows[0].color_ID, rows[0].R, rows[0].G, rows[0].B) == (0, 255, 255, 255) and {r.color_ID for r in rows.values()} <= {*range(11)}
    pal = sampling.get_pal("sky")(10)
    assert all((r.R, r.G, r.B) == pal[r.color_ID - 1] for i, r in rows.items() if i) and all(rows[i].color_ID != rows[i + 1].color_ID for i in range(1, 299) if (i + 1) % 30)
    assert sampling.color_ids(df, overwrite_rgb=False).where("R = 1 and G = 2 and B = 3").count() == 300
    assert sampling.color_ids(df.where("TreeID = 0")).count() == 1


def test_streams(spark, tmp_path):
    """A point that comes again counts once; a result of many batches is one table; an empty folder gives none."""
    from understory.streaming import accumulate

    schema = "event_id long, ts timestamp, value double"
    for i in range(3):
        spark.createDataFrame([(j, f"2024-01-01 00:0{i}:00", 1.0 * j) for j in range(i, i + 3)], "event_id long, t string, value double").select("event_id", F.col("t").cast("timestamp").alias("ts"), "value").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    s = accumulate.read_stream(spark, f"{tmp_path}/in", schema, 1)
    assert sorted(r.event_id for r in accumulate.run_available(accumulate.distinct_points(s), "append").collect()) == [0, 1, 2, 3, 4]
    total = accumulate.run_available(accumulate.accumulate(s, ("event_id",), "value"))
    assert {r.event_id: r.point_count for r in total.collect()} == {0: 1, 1: 2, 2: 3, 3: 2, 4: 1}
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none")
    assert accumulate.run_available(accumulate.accumulate(accumulate.read_stream(spark, f"{tmp_path}/none", schema), ("event_id",), "value")).count() == 0


def test_seeds_by_features(spark):
    """Clusters of stem-like points; small ones and flat ones go."""
    rows = [(x + 0.01 * i, 0.0, 0.6 + 0.1 * i, 0.95, 0.8, 1) for x, n in ((0.0, 8), (10.0, 9), (20.0, 2)) for i in range(n)] + [(30.0, 0.0, 1.0, 0.1, 0.9, 1), (40.0, 0.0, 1.0, 0.95, 0.9, 2)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, X double, Y double, Z double, Verticality double, Planarity double, Classification int")
    got = graph.find_base_coordinates_geom(df, res=0.5, min_cluster_size=3).orderBy("TreeID").collect()
    assert [(r.TreeID, round(r.X), round(r.Z, 1)) for r in got] == [(1, 0, 0.6), (2, 10, 0.6)]
    assert graph.find_base_coordinates_geom(df, res=0.5).count() == 1  # over the median size of 8
    with pytest.raises(ValueError):
        graph.find_base_coordinates_geom(df.where("X > 25"))


def test_small_helpers(spark):
    p = spark.createDataFrame([(1.0, 2.0, 3.0, 5.0, "x", 2.5)], "X double, Y double, Z double, Intensity double, note string, score float")
    out = src.add_las_attributes(p)
    assert out.columns == ["X", "Y", "Z", "Intensity", "score"] and dict(out.dtypes)["Intensity"] == "int" and dict(out.dtypes)["score"] == "double"
    ids = lambda *v: spark.createDataFrame([(float(x),) for x in v], "i double").select(src.safe_id(F.col("i")).alias("i"))
    assert [r.i for r in ids(1, 2**53).collect()] == [1, 2**53]
    for bad in (1.5, 2.0**60):
        with pytest.raises(PySparkException):
            ids(bad).collect()
    fn.register(spark)
    r = spark.sql("select p_dist(array(0D, 3D), array(4D, 0D)) as d, point_circle_distance(3D, 4D, 0D, 0D, 2D) as c, point_center_angle(0D, 1D, 0D, 0D) as a").first()
    assert (r.d, r.c, r.a) == (5.0, 3.0, 90.0)


def test_utm(spark):
    lon, lat = fn.utm_to_wgs84(F.lit(500000.0), F.lit(5000000.0), 32632)
    r = spark.range(1).select(lon.alias("a"), lat.alias("b")).first()
    assert r.a == pytest.approx(9.0, abs=1e-9) and r.b == pytest.approx(45.153, abs=1e-3)
    with pytest.raises(ValueError):
        fn.utm_to_wgs84(F.lit(0.0), F.lit(0.0), 4326)


def test_voxel_metamorphic(spark, sf):
    p = src.pts(spark, sf).select("X", "Y", "Z")
    a = voxel.grid_thin(p.withColumn("t", F.lit(1)), 5.0, ("t",)).collect()
    b = voxel.grid_thin(p.withColumn("t", F.lit(1)).repartition(9).orderBy("Z"), 5.0, ("t",)).collect()
    assert sorted(a) == sorted(b)
    with pytest.raises(ValueError):
        voxel.add_voxel_coordinates(p, 0)


def test_outputs_and_run(spark, tmp_path):
    rows = [("SAT" if s == 0 else "FM", 3 * i + s, 0.1 * i if i % 3 else None, True) for s, n in ((0, 200), (1, 100)) for i in range(1, n + 1)]
    df = spark.createDataFrame(rows, "instance_dimension string, instance_id long, dbh_m double, ok boolean")
    output.write_parquet(df, f"{tmp_path}/t.parquet")
    output.write_csv(df, f"{tmp_path}/t.csv")
    back = spark.read.parquet(f"{tmp_path}/t.parquet").collect()
    assert [r.instance_id for r in back][:2] == [4, 7] and len(back) == 300
    text = spark.read.text(f"{tmp_path}/t.csv").collect()
    assert text[0].value == "instance_dimension,instance_id,dbh_m,ok" and text[1].value == "FM,4,0.1,TRUE" and text[3].value == "FM,10,,TRUE"
    s = src.stems(spark, 2, 2400).select("X", "Y", (F.col("Z") + 2).alias("Z"), F.col("instance_id").cast("int").alias("PredInstance_A"))
    ground = spark.range(0, 1600).select((F.col("id") % 40 * 0.5 + 5).alias("X"), (F.floor(F.col("id") / 40) * 0.5).alias("Y"), F.lit(2.0).alias("Z"), F.lit(0).alias("PredInstance_A"))
    s.unionByName(ground).write.parquet(f"{tmp_path}/in.parquet")
    spark.range(0, 10000).select(F.floor(F.col("id") / 100).alias("row"), (F.col("id") % 100).alias("col"), F.lit(2.0).cast("float").alias("z")).write.parquet(f"{tmp_path}/dtm.parquet")
    args = f"--input {tmp_path}/in.parquet --dtm {tmp_path}/dtm.parquet --dtm-resolution 1 --output-dir {tmp_path}/out --instance-attribute PredInstance_A --dbh-runs 1".split()
    plans.run(spark, args, 32632)
    inv = spark.read.parquet(f"{tmp_path}/out/tree_inventory.parquet").collect()
    assert [r.instance_id for r in inv] == [1, 2] and abs(inv[0].dbh_m - 0.3) < 0.02 and inv[0].longitude
    with pytest.raises(Exception):
        plans.run(spark, args, 32632)
    spark.range(0, 4).select(F.col("id").alias("row"), F.col("id").alias("col"), F.lit(2.0).cast("float").alias("z")).write.parquet(f"{tmp_path}/small.parquet")
    with pytest.raises(ConfigError, match="doesn't cover"):
        plans.run(spark, [a.replace("/dtm.parquet", "/small.parquet").replace("/out", "/out2") for a in args])


def test_segmentation_run(spark, tmp_path):
    """A run with the shortest paths publishes the terrain, the whole cloud with its new attribute, the seeds and a record."""
    import json

    a, b = stem(step=0.1, n=40, x=5.0, y=5.0, high=4.0), stem(step=0.1, n=40, x=9.0, y=6.0, high=4.0, seed=2)
    rows = [(float(x), float(y), float(z) + 3, 1, 7) for p in (a, b) for x, y, z in p]
    rows += [(i * 0.25, j * 0.25, 3.0, 2, 7) for i in range(56) for j in range(44)]
    spark.createDataFrame(rows, "X double, Y double, Z double, Classification int, Intensity int").write.parquet(f"{tmp_path}/in.parquet")
    args = f"--input {tmp_path}/in.parquet --output-dir {tmp_path}/out --enable-csp true --debug-outputs true --dbh-runs 1 --dtm-resolution 0.5 --dtm-candidate-resolution 0.25 --seed-resolution 0.5 --seed-quantile 0.5 --seed-eps 0.8 --dbh-evidence false".split()
    plans.run(spark, args)
    inv = spark.read.parquet(f"{tmp_path}/out/tree_inventory.parquet")
    assert inv.count() == 2 and "dbh_slices" not in inv.columns and {"seed_x", "seed_height_m"} <= set(inv.columns)
    got = spark.read.parquet(f"{tmp_path}/out/segmented_points.parquet")
    assert got.count() == len(rows) and {"Classification", "Intensity", "PredInstance_CSP"} <= set(got.columns) and got.agg(F.min("Z")).first()[0] == 3.0
    assert spark.read.parquet(f"{tmp_path}/out/terrain.parquet").agg(F.max(F.abs(F.col("z") - 3))).first()[0] < 0.01
    m = json.loads((tmp_path / "out/manifest.json").read_text())
    assert [t["name"] for t in m["tables"]] == ["segmented_points", "stand_summary", "terrain", "tree_inventory"]
    assert json.loads((tmp_path / "out/run.json").read_text())["trees"] == 2
    assert spark.read.csv(f"{tmp_path}/out/effective_seeds.tsv", sep="\t", header=True).columns == ["X", "Y", "Z", "TreeID"]


def test_changed_input(spark, tmp_path):
    cloud(spark).coalesce(1).write.parquet(f"{tmp_path}/in.parquet")
    one = plans.input_stamp(spark, f"{tmp_path}/in.parquet")
    assert one == plans.input_stamp(spark, f"{tmp_path}/in.parquet")
    cloud(spark).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in.parquet")
    assert one != plans.input_stamp(spark, f"{tmp_path}/in.parquet")


UTM1 = 'PROJCS["WGS 84 / UTM zone 32N",GEOGCS["WGS 84",DATUM["WGS_1984",SPHEROID["WGS 84",6378137,298.257223563]],UNIT["degree",0.0174532925199433]],PROJECTION["Transverse_Mercator"],PARAMETER["central_meridian",9],UNIT["metre",1]{}]'
UTM3 = 'PROJCRS["a",BASEGEOGCRS["WGS 84",DATUM["World",ELLIPSOID["WGS 84",6378137,298.25]]],CONVERSION["c",METHOD["Transverse Mercator"],PARAMETER["x",9,ANGLEUNIT["degree",0.017]]],CS[Cartesian,3],AXIS["(E)",east,ORDER[1],LENGTHUNIT["metre",1]],AXIS["(N)",north,ORDER[2],LENGTHUNIT["metre",1]],AXIS["(h)",up,ORDER[3],LENGTHUNIT["metre",1]]]'


def test_coordinate_systems():
    one, coded = UTM1.format(""), UTM1.format(',AUTHORITY["EPSG","32632"]')
    assert crs.require_metric(one) == one and crs.epsg(coded) == 32632 and crs.epsg(one) is None
    for bad in (None, "", "EPSG", 'GEOGCS["WGS 84",UNIT["degree",0.017]]', one.replace('UNIT["metre",1]', 'UNIT["US survey foot",0.3048006]'), "PROJCS[", 'PROJCS["a"'):
        with pytest.raises(ConfigError):
            crs.require_metric(bad)
    flat = crs.horizontal(UTM3)
    assert "CS[Cartesian,2]" in flat and "ORDER[3]" not in flat and "ORDER[2]" in flat and crs.horizontal(one) == one and crs.require_metric(flat)
    assert crs.same_horizontal(UTM3, flat) and crs.same_horizontal(one, one.replace('PROJCS["WGS 84 / UTM zone 32N"', 'PROJCS["mine"').replace(",9]", ",9.0]"))
    assert crs.same_horizontal(coded, f'COMPD_CS["x",{coded},VERT_CS["h",UNIT["metre",1]]]') and not crs.same_horizontal(one, one.replace(",9]", ",15]"))
    assert not crs.same_horizontal(coded, coded.replace("32632", "32633")) and not crs.same_horizontal(one, None) and not crs.same_horizontal('GEOGCS["w",UNIT["degree",0.017]]', one)


def test_octree_nodes(spark, tmp_path):
    """Two pages, one of them behind a reference; a window leaves out cubes and pages beside it."""
    entry = lambda level, x, y, z, at, size, n: struct.pack("<4iQ2i", level, x, y, z, at, size, n)
    start = 375 + 54 + 160
    deep = entry(2, 3, 3, 0, 2000, 40, 5) + entry(2, 2, 3, 1, 2040, 40, 6)
    root = entry(0, 0, 0, 0, 1000, 100, 10) + entry(1, 0, 0, 0, 1100, 100, 20) + entry(1, 1, 0, 0, 0, 0, 0) + entry(1, 1, 1, 0, start + 128, len(deep), -1)
    h = bytearray(375)
    h[:4], h[24], h[25] = b"LASF", 1, 4
    struct.pack_into("<6d", h, 179, 8, 0, 8, 0, 8, 0)
    struct.pack_into("<Q", h, 247, 41)
    info = struct.pack("<H16sHH32s", 0, b"copc", 1, 160, b"") + struct.pack("<5d2Q2d", 4, 4, 4, 4, 0.1, start, len(root), 0, 0) + bytes(88)
    path = str(tmp_path / "a.copc.laz")
    (tmp_path / "a.copc.laz").write_bytes(bytes(h) + info + root + deep)
    assert copc.is_copc(bytes(h) + info) and not copc.is_copc(bytes(h) + bytes(60)) and not copc.is_copc(b"LASF")
    rows = {(r.level, r.x, r.y, r.z): (r.points, r.offset, r.xmin, r.size) for r in copc.copc_nodes(spark, path).collect()}
    assert rows == {(0, 0, 0, 0): (10, 1000, 0.0, 8.0), (1, 0, 0, 0): (20, 1100, 0.0, 4.0), (2, 3, 3, 0): (5, 2000, 6.0, 2.0), (2, 2, 3, 1): (6, 2040, 4.0, 2.0)}
    assert {(r.level, r.x) for r in copc.copc_nodes(spark, path, (0.0, 0.0, 1.0, 1.0)).collect()} == {(0, 0), (1, 0)}
    assert copc.copc_nodes(spark, path, (6.5, 6.5, 9.0, 9.0)).count() == 2 and copc.copc_info(spark, path)["points"] == 41
    struct.pack_into("<Q", h, 247, 42)
    (tmp_path / "b.laz").write_bytes(bytes(h) + info + root + deep)
    (tmp_path / "c.laz").write_bytes(bytes(h) + info + root)
    (tmp_path / "d.laz").write_bytes(bytes(h))
    for bad in "bcd":
        with pytest.raises(ConfigError):
            copc.copc_nodes(spark, f"{tmp_path}/{bad}.laz")


def test_las(spark, tmp_path):
    from understory.sources.las import LasSource, header_table

    pts = [(100, 200, 300, 7, 2), (110, 210, 310, 8, 1)]
    extra = b"\0\0" + bytes([6, 0]) + b"PredInstance_A".ljust(32, b"\0") + bytes(192 - 36)
    vlr = struct.pack("<H16sHH32s", 0, b"LASF_Spec", 4, 192, b"") + extra
    h = bytearray(375)
    h[:4], h[24], h[25] = b"LASF", 1, 4
    struct.pack_into("<HII", h, 94, 375, 375 + len(vlr), 1)
    struct.pack_into("<BHI", h, 104, 6, 34, 0)
    struct.pack_into("<3d3d6d", h, 131, 0.01, 0.01, 0.01, 0, 0, 0, 1.1, 1.0, 2.1, 2.0, 3.1, 3.0)
    struct.pack_into("<Q", h, 247, 2)
    body = b"".join(struct.pack("<iiiHBBBBhHd", x, y, z, 5, 0x11, 0, c, 0, 0, 1, 0.5) + struct.pack("<i", i) for x, y, z, i, c in pts)
    (tmp_path / "a.las").write_bytes(bytes(h) + vlr + body)
    spark.dataSource.register(LasSource)
    rows = spark.read.format("las").load(f"{tmp_path}/a.las").orderBy("X").collect()
    assert [(r.X, r.Y, r.Z, r.Classification, r.PredInstance_A) for r in rows] == [(1.0, 2.0, 3.0, 2, 7.0), (1.1, 2.1, 3.1, 1, 8.0)]
    assert header_table(spark, f"{tmp_path}").first().n == 2
