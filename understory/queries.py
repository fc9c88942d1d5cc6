"""The registered queries of the engine and the SQL that must give the same rows.

The driver's tables hold no point cloud; sources.points maps them to one (lineitem as points with two segmentations).
Doubles are rounded on both sides. Queries without SQL (group functions, iterations with no bound on their depth) are
tested on fixtures instead.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import scalar as fn
from .model import Config
from .operators import circle, features, graph, hull, inventory, neighbors, sampling, terrain, voxel
from .sources import points as src
from .streaming import accumulate

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
PTS, SEG = f"with {src.PTS_SQL}", f"with {src.SEG_SQL}"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def r6(*cols: str, digits: int = 6) -> list:
    return [F.round(F.col(c), digits).alias(c) for c in cols]


def table(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


VOTE_SQL = """votes as (select src, dim, id, species as sp, count(*) as n, quantile_cont(prob, 0.5) as p50 from seg where species >= 0 group by all),
vote as (select src, dim, id, arg_max(sp, (n, -sp)) as species_id, arg_max(p50, (n, -sp)) as species_prob, 1 - max(n)::double / sum(n) as conflict from votes group by all)"""

@query(
    "tree_inventory",
    f"""{SEG}, thin as (select src, dim, id, floor(X / 0.5)::bigint as kx, floor(Y / 0.5)::bigint as ky, floor(Z / 0.5)::bigint as kz, min({{'x': X, 'y': Y, 'z': Z}}) as p from seg group by all), {VOTE_SQL}, base as (select src, dim, id, count(*) as point_count from seg group by all),
m as (select src, dim, id, count(*)::integer as metrics_point_count, round(max(p.z - 1) - min(p.z - 1), 6) as height_m, round(median(p.x), 6) as x, round(median(p.y), 6) as y, min(p.z) as z from thin group by all)
select base.src as segmentation_source, base.dim as instance_dimension, base.id as instance_id, point_count, metrics_point_count, height_m, x, y, z, species_id, round(species_prob, 6) as species_prob, round(conflict, 6) as species_conflict_fraction
from base join m using (src, dim, id) left join vote using (src, dim, id)""",
)
def tree_inventory(spark, sf_dir):
    """The flagship: valid instances, terrain, thinning, counts, height, vote; place and height of the thinned points, as
    for trees without a diameter. Joins are between tables of trees."""
    s = src.seg(spark, sf_dir).withColumn("Zref", F.col("Z")).withColumn("Z", F.col("Z") - 1)
    thin = voxel.grid_thin(s.select(*inventory.TREE, "X", "Y", "Zref", "Z"), 0.5, inventory.TREE, z="Zref")
    geometry = inventory.thinned_geometry(thin, "Zref").select(*inventory.TREE, "metrics_point_count", *r6("height_m"), F.round("mx", 6).alias("x"), F.round("my", 6).alias("y"), F.col("mz").alias("z"))
    out = inventory.tree_counts(s).join(geometry, [*inventory.TREE]).join(inventory.species_vote(s), [*inventory.TREE], "left")
    return out.select(*inventory.TREE, "point_count", "metrics_point_count", "height_m", "x", "y", "z", "species_id", *r6("species_prob", "species_conflict_fraction"))


@query("voxel_mean", f"{PTS} select floor(X / 2)::bigint as vx, floor(Y / 2)::bigint as vy, floor((Z + 1) / 2)::bigint as vz, count(*) as n, round(avg(X), 6) as X_gr, round(avg(Y), 6) as Y_gr, round(avg(Z), 6) as Z_gr, round(avg(prob), 6) as prob from pts group by all")
def voxel_mean(spark, sf_dir):
    return voxel.voxelize_points_mean_attributes(src.pts(spark, sf_dir).select("X", "Y", "Z", "prob"), 2.0).select("vx", "vy", "vz", "n", *r6("X_gr", "Y_gr", "Z_gr", "prob"))


@query("voxel_coordinates", f"{PTS} select (floor(X / 2) * 2 + 1)::double as x_vox, (floor(Y / 2) * 2 + 1)::double as y_vox, (floor((Z + 1) / 2) * 2)::double as z_vox, count(*) as n from pts group by all")
def voxel_coordinates(spark, sf_dir):
    return voxel.add_voxel_coordinates(src.pts(spark, sf_dir), 2.0).groupBy("x_vox", "y_vox", "z_vox").agg(F.count("*").alias("n"))


@query("grid_thin", f"{PTS} select tree_a, floor(X / 5)::bigint as kx, floor(Y / 5)::bigint as ky, floor(Z / 5)::bigint as kz, round(min((X, Y, Z))[1], 6) as X, round(min((X, Y, Z))[2], 6) as Y, min((X, Y, Z))[3] as Z from pts group by all".replace("[1]", ".x").replace("[2]", ".y").replace("[3]", ".z").replace("min((X, Y, Z))", "min({'x': X, 'y': Y, 'z': Z})"))
def grid_thin(spark, sf_dir):
    out = voxel.grid_thin(src.pts(spark, sf_dir).select("tree_a", "X", "Y", "Z"), 5.0, ("tree_a",))
    return out.select("tree_a", "kx", "ky", "kz", *r6("X", "Y"), "Z")


@query("instance_filter_counts", f"{SEG} select src as segmentation_source, dim as instance_dimension, id as instance_id, count(*) as point_count from seg group by all")
def instance_filter_counts(spark, sf_dir):
    return inventory.tree_counts(src.seg(spark, sf_dir))


@query("height_range", f"{SEG} select src as segmentation_source, dim as instance_dimension, id as instance_id, count(*) as point_count, max(Z) - min(Z) as height_m, round(median(X), 6) as x, round(median(Y), 6) as y, min(Z) as z from seg group by all")
def height_range(spark, sf_dir):
    return inventory.tree_geometry(src.seg(spark, sf_dir)).select(*inventory.TREE, "point_count", "height_m", *r6("x", "y"), "z")


@query("species_vote", f"{SEG}, {VOTE_SQL} select src as segmentation_source, dim as instance_dimension, id as instance_id, species_id, round(species_prob, 6) as species_prob, round(conflict, 6) as species_conflict_fraction from vote")
def species_vote(spark, sf_dir):
    return inventory.species_vote(src.seg(spark, sf_dir)).select(*inventory.TREE, "species_id", *r6("species_prob", "species_conflict_fraction"))


@query(
    "score_histogram_json",
    f"{SEG}, c as (select src, dim, id, score, count(*) as n from seg where score >= 0 group by all) select src as segmentation_source, dim as instance_dimension, id as instance_id, '[' || string_agg('{{\"score\":' || score || ',\"point_count\":' || n || '}}', ',' order by n desc, score) || ']' as pred_score_values from c group by all",
)
def score_histogram_json(spark, sf_dir):
    return inventory.score_histogram(src.seg(spark, sf_dir))


@query("weighted_median", f"{PTS} select tree_a, round(quantile_cont(prob, 0.5), 6) as median from pts group by all")
def weighted_median(spark, sf_dir):
    return inventory.weighted_median(src.pts(spark, sf_dir), ("tree_a",), "prob").select("tree_a", *r6("median"))


_STATS = ", ".join(f"round(avg({c}), 6) as mean_{n}_m, round(median({c}), 6) as median_{n}_m, " + ", ".join(f"round(quantile_cont({c}, {q / 100}), 6) as p{q:02d}_{n}_m" for q in (5, 25, 75, 95)) for c, n in (("dbh_m", "dbh"), ("height_m", "height")))


@query(
    "stand_summary",
    f"""{SEG}, t as (select src, dim, id, max(Z) - min(Z) as height_m, case when dim = 'tree_b' or id % 10 <> 0 then (id % 40) / 100.0::double end as dbh_m from seg group by all)
select src as segmentation_source, dim as instance_dimension, count(*) as tree_count, count(dbh_m) as dbh_measured_count, round(count(dbh_m)::double / count(*), 6) as dbh_coverage_fraction, 10000.0::double as stand_area_m2, round(count(*)::double, 6) as trees_per_ha, case when count(dbh_m) = count(*) then round(sum(pi() / 4 * dbh_m * dbh_m), 6) end as basal_area_m2_ha, {_STATS} from t group by all""",
)
def stand_summary(spark, sf_dir):
    t = inventory.tree_geometry(src.seg(spark, sf_dir)).withColumn("dbh_m", F.when((F.col("instance_dimension") == "tree_b") | (F.col("instance_id") % 10 != 0), (F.col("instance_id") % 40) / 100.0))
    s = inventory.stand_summary(t, 10_000.0)
    return s.select(*[F.round(c, 6).alias(c) if k == "double" and c != "stand_area_m2" else F.col(c) for c, k in s.dtypes])


@query("density_raster", f"{PTS} select floor(X / 2)::bigint as px, floor(Y / 2)::bigint as py, count(*) as n, round(avg(Z), 6) as z from pts group by all")
def density_raster(spark, sf_dir):
    return voxel.raster(src.pts(spark, sf_dir), 2.0, n=F.count("*"), z=F.round(F.avg("Z"), 6))


@query("density_quantile", f"{PTS}, p as (select floor(X / 2) as px, floor(Y / 2) as py, count(*) as n from pts group by all), q as (select quantile_cont(n, 0.9) as q from p) select px::bigint as px, py::bigint as py, n from p, q where n > q.q")
def density_quantile(spark, sf_dir):
    p = voxel.raster(src.pts(spark, sf_dir), 2.0, n=F.count("*"))
    return p.join(F.broadcast(p.agg(F.percentile("n", F.lit(0.9)).alias("q"))), F.col("n") > F.col("q")).select("px", "py", "n")


@query("min_surface", f"{PTS} select floor(X / 2)::bigint as px, floor(Y / 2)::bigint as py, min(Z::float) as z from pts group by all")
def min_surface(spark, sf_dir):
    return voxel.min_surface(src.pts(spark, sf_dir), 2.0)


def plane(spark, sf_dir) -> DataFrame:
    """Terrain table over all of the adapter cloud's extent."""
    r, c = spark.range(0, 60).select(F.col("id").alias("row")), spark.range(0, 60).select(F.col("id").alias("col"))
    return r.crossJoin(c).withColumn("z", (F.col("row") * 0.5 + F.col("col") * 0.25).cast("float"))


@query("terrain_normalise", f"{PTS}, t as (select r.range as r, c.range as c, (r.range * 0.5 + c.range * 0.25)::float as z from range(0, 60) r, range(0, 60) c) select floor(X)::bigint as px, count(*) as n, round(sum(pts.Z - t.z), 4) as z, round(sum(pts.Z), 4) as zref from pts join t on floor(Y) = t.r and floor(X) = t.c group by all")
def terrain_normalise(spark, sf_dir):
    n = terrain.normalise_height(src.pts(spark, sf_dir), plane(spark, sf_dir), 1.0, cells=3600)
    return n.groupBy(fn.cell(F.col("X"), 1.0).alias("px")).agg(F.count("*").alias("n"), F.round(F.sum("Z"), 4).alias("z"), F.round(F.sum("Zref"), 4).alias("zref"))


_SLICES = "slices as (select i::integer as slice_id, 0.5 + (i - 1) * 2 as lo from range(1, 26) t(i))"


@query("slice_range_join", f"{PTS}, {_SLICES} select slice_id, count(p.X) as n from slices left join (select Y as Z, X from pts) p on p.Z >= lo and p.Z < lo + 1 group by all")
def slice_range_join(spark, sf_dir):
    return voxel.slice_counts(src.pts(spark, sf_dir).select("X", F.col("Y").alias("Z")), 0.5, 50.0, 2.0, 1.0)


@query("stem_band", f"{PTS} select tree_a, count(*) as band_points from pts where Z > 2 and Z < 7 group by all")
def stem_band(spark, sf_dir):
    return voxel.height_slice(src.pts(spark, sf_dir), 2, 7).groupBy("tree_a").agg(F.count("*").alias("band_points"))


@query("quantile_filter", f"{PTS}, q as (select tree_b, quantile_cont(X, 0.8) as qx, quantile_cont(Y, 0.8) as qy from pts group by all) select p.tree_b, count(*) as n, round(sum(p.Y), 4) as y from pts p join q using (tree_b) where X > qx and Y > qy group by all")
def quantile_filter(spark, sf_dir):
    return voxel.quantile_filter(src.pts(spark, sf_dir), "tree_b", ("X", "Y"), 0.8).groupBy("tree_b").agg(F.count("*").alias("n"), F.round(F.sum("Y"), 4).alias("y"))


#: Voxels of the adapter cloud: a table whose size is set by the extent, not by the rows.
VOX_SQL = "vox as (select floor(X / 5)::bigint as vx, floor(Y / 5)::bigint as vy, floor((Z + 1) / 2)::bigint as vz, round(avg(X) + 3.3e-9, 6) as X, round(avg(Y) + 3.3e-9, 6) as Y, round(avg(Z) + 3.3e-9, 6) as Z, round(avg(prob) + 3.3e-9, 6) as f from pts group by all), v as (select (vx * 1000000 + vy * 1000 + vz) as id, * from vox)"


def voxels(spark, sf_dir) -> DataFrame:
    p = src.pts(spark, sf_dir)
    k = {"vx": fn.cell(F.col("X"), 5.0), "vy": fn.cell(F.col("Y"), 5.0), "vz": fn.cell(F.col("Z"), 2.0, -1.0)}
    v = p.withColumns(k).groupBy(*k).agg(*[F.round(F.avg(c) + 3.3e-9, 6).alias(n) for c, n in (("X", "X"), ("Y", "Y"), ("Z", "Z"), ("prob", "f"))])
    return v.withColumn("id", F.col("vx") * 1_000_000 + F.col("vy") * 1000 + F.col("vz"))


D2 = "(a.X - b.X) * (a.X - b.X) + (a.Y - b.Y) * (a.Y - b.Y) + (a.Z - b.Z) * (a.Z - b.Z)"


@query("radius_edges", f"{PTS}, {VOX_SQL} select a.id as src, b.id as dst, round(sqrt({D2}), 6) as d from v a join v b on a.id <> b.id and {D2} <= 25 + 1e-12")
def radius_edges(spark, sf_dir):
    v = voxels(spark, sf_dir)
    return neighbors.radius_join(v, v, 5.0).select("src", "dst", *r6("d"))


@query("point_density", f"{PTS}, {VOX_SQL} select a.id, count(*) as density from v a join v b on (a.X - b.X) * (a.X - b.X) + (a.Y - b.Y) * (a.Y - b.Y) <= 16 + 1e-12 group by all")
def point_density(spark, sf_dir):
    return neighbors.density(voxels(spark, sf_dir), 4.0)


@query("knn_points", f"{PTS}, {VOX_SQL}, d as (select a.id as src, b.id as dst, {D2} as d2, row_number() over (partition by a.id order by sqrt({D2}), b.id) as rank from v a, v b) select src, rank::integer as rank, dst, round(sqrt(d2), 6) as d from d where rank <= 5")
def knn_points(spark, sf_dir):
    return neighbors.knn(voxels(spark, sf_dir), 5, size=4.0).select("src", "rank", "dst", *r6("d"))


@query("knn_vectors", "with d as (select a.vec_id as src, b.vec_id as dst, array_distance(a.embedding::double[64], b.embedding::double[64]) as d from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0), r as (select *, row_number() over (partition by src order by d, dst) as rank from d) select src, rank::integer as rank, dst, round(d, 6) as d from r where rank <= 5")
def knn_vectors(spark, sf_dir):
    """The stated query set, ids divisible by 50, against all vectors."""
    e = table(spark, sf_dir, "embeddings")
    return neighbors.knn_arrays(e.where("vec_id % 50 = 0"), e, 5).select("src", "rank", "dst", *r6("d"))


COMPONENTS_SQL = f"""{PTS.replace("with", "with recursive", 1)}, {VOX_SQL}, e as (select a.id as s, b.id as t from v a join v b on {D2} <= 9 + 1e-12),
reach as (select id as s, id as t from v union select r.s, e.t from reach r join e on e.s = r.t)
select s as id, min(t) as component from reach group by all"""


@query("components", COMPONENTS_SQL)
def components(spark, sf_dir):
    v = voxels(spark, sf_dir)
    return graph.connected_components(v, neighbors.radius_join(v, v, 3.0))


EDGES_SQL = f"e0 as (select a.id as src, b.id as dst, {D2} as d2, a.id % 500 = 1 as seed, b.f as f from v a join v b on a.id <> b.id and {D2} <= 100 + 1e-12), e1 as (select src, dst, case when seed then 0 when d2 + ((1 - f) * 0.5 + f * 0.3 + f * -0.2) * 5 < 0 then 5e-5 else d2 + ((1 - f) * 0.5 + f * 0.3 + f * -0.2) * 5 end as w from e0), e as (select least(src, dst) as a, greatest(src, dst) as b, sum(w) as w from e1 group by all)"


def cost_graph(spark, sf_dir) -> DataFrame:
    v = voxels(spark, sf_dir).select("id", F.col("X").alias("X_gr"), F.col("Y").alias("Y_gr"), F.col("Z").alias("Z_gr"), F.col("f").alias("Verticality"), F.col("f").alias("Sphericity"), F.col("f").alias("Linearity"), (F.col("id") % 500 == 1).alias("is_seed"))
    return graph.cost_edges(v, 5.0, 0.5, 0.3, -0.2)


@query("edge_weights", f"{PTS}, {VOX_SQL}, {EDGES_SQL} select a, b, round(w + 3.3e-9, 4) as w from e")
def edge_weights(spark, sf_dir):
    # many weights end in a 5 at the fifth digit: a tiny shift keeps the last bit from deciding how they round
    return cost_graph(spark, sf_dir).select("a", "b", F.round(F.col("w") + 3.3e-9, 4).alias("w"))


def _seeds(edges: DataFrame) -> DataFrame:
    ids = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct().where(F.col("id") % 500 == 1)
    return ids.select("id", F.col("id").alias("seed"))


def _paths_sql(rounds: int) -> str:
    """Distances of all nodes to all seeds by so many rounds over the edges, more than any cheapest path has."""
    steps = ["d0 as materialized (select a as id, a as seed, 0::double as dist from both_ways where a % 500 = 1 group by all)"]
    steps += [f"d{i} as materialized (select id, seed, min(dist) as dist from (select * from d{i - 1} union all select e.b, d.seed, d.dist + e.w from d{i - 1} d join both_ways e on d.id = e.a) group by id, seed)" for i in range(1, rounds + 1)]
    return f"both_ways as materialized (select a, b, w from e union all select b, a, w from e), {', '.join(steps)}, best as (select id, seed, dist, row_number() over (partition by id order by dist, seed) as rank from d{rounds})"


PATHS_SQL = f"{PTS}, {VOX_SQL}, {EDGES_SQL}, {_paths_sql(24)}"


@query("csp_distances", f"{PATHS_SQL} select id, seed, round(dist, 4) as dist from best where rank = 1")
def csp_distances(spark, sf_dir):
    edges = graph.written(cost_graph(spark, sf_dir))
    return graph.nearest_seeds(edges, _seeds(edges), 1).select("id", "seed", *r6("dist", digits=4))


@query("top2_seeds", f"{PATHS_SQL} select id, coalesce(max(case when rank = 1 then seed end), 0) as TreeID, coalesce(max(case when rank = 2 then seed end), 0) as TreeID2, round(max(case when rank = 1 then dist end), 4) as dist, round(max(case when rank = 2 then dist end), 4) as dist2 from best group by id")
def top2_seeds(spark, sf_dir):
    edges = graph.written(cost_graph(spark, sf_dir))
    out = graph.pivot_ranks(graph.nearest_seeds(edges, _seeds(edges), 2), 2)
    return out.select("id", "TreeID", "TreeID2", *r6("dist", "dist2", digits=4))


@query("csp_segmentation")
def csp_segmentation(spark, sf_dir):
    p = src.pts(spark, sf_dir).select("X", "Y", "Z")
    seeds = spark.createDataFrame([(5.0, 5.0, 0.5, 1), (40.0, 20.0, 0.5, 2), (25.0, 45.0, 0.5, 3)], "X double, Y double, Z double, TreeID long")
    return graph.csp_cost_segmentation(p, seeds, 2.0).groupBy("TreeID").agg(F.count("*").alias("n"))


PCA = "case when p > 0 then acos(greatest(-1, least(1, ((cxx - q) / p * ((cyy - q) / p * (czz - q) / p - cyz / p * cyz / p) - cxy / p * (cxy / p * (czz - q) / p - cyz / p * cxz / p) + cxz / p * (cxy / p * cyz / p - (cyy - q) / p * cxz / p)) / 2))) / 3 else 0 end"


#: From covariances in a table c to the features' parts in n.
EIGEN_SQL = f"""c1 as (select *, (cxx + cyy + czz) / 3 as q from c), c2 as (select *, sqrt(((cxx - q) ^ 2 + (cyy - q) ^ 2 + (czz - q) ^ 2 + 2 * (cxy ^ 2 + cxz ^ 2 + cyz ^ 2)) / 6) as p from c1), c3 as (select *, {PCA} as phi from c2),
l as (select *, q + 2 * p * cos(phi) as l1, q + 2 * p * cos(phi + 2 * pi() / 3) as l3 from c3), m as (select *, 3 * q - l1 - l3 as l2 from l),
n as (select *, (cyy - l3) * (czz - l3) - cyz ^ 2 as axx, (cxx - l3) * (czz - l3) - cxz ^ 2 as ayy, (cxx - l3) * (cyy - l3) - cxy ^ 2 as azz from m)"""
FEATURES_SQL = ", ".join(f"round({x}, 5) as {n}" for n, x in (("Curvature", "l3 / (l1 + l2 + l3)"), ("Linearity", "(l1 - l2) / l1"), ("Planarity", "(l2 - l3) / l1"), ("Sphericity", "l3 / l1"), ("Anisotropy", "(l1 - l3) / l1"), ("Verticality", "1 - sqrt(azz / (axx + ayy + azz))")))
COVARIANCE_SQL = "covar_samp(X, X) as cxx, covar_samp(Y, Y) as cyy, covar_samp(Z, Z) as czz, covar_samp(X, Y) as cxy, covar_samp(X, Z) as cxz, covar_samp(Y, Z) as cyz"


@query(
    "pca_features",
    f"{PTS}, c as (select tree_a, {COVARIANCE_SQL} from pts group by all), {EIGEN_SQL} select tree_a, {FEATURES_SQL} from n",
)
def pca_features(spark, sf_dir):
    c = src.pts(spark, sf_dir).groupBy("tree_a").agg(*features.covariance())
    return features.eigen_features(features.eigen_decomposition(c)).select("tree_a", *r6(*features.FEATURES, digits=5))


@query(
    "geometry_features",
    f"{PTS}, {VOX_SQL}, d as (select a.id, b.X, b.Y, b.Z, row_number() over (partition by a.id order by sqrt({D2}), b.id) as rank from v a, v b), c as (select id, {COVARIANCE_SQL} from d where rank <= 8 group by id), {EIGEN_SQL} select id, {FEATURES_SQL} from n",
)
def geometry_features(spark, sf_dir):
    return features.add_geometry(voxels(spark, sf_dir).select("id", "X", "Y", "Z"), 8, size=4.0).select("id", *r6(*features.FEATURES, digits=5))


#: All seven clouds of tree_b; what they hold besides takes turns.
_CLOUD_COLUMNS = {i: ("X", "Y", "Z", "prob", *((), ("score",), ("species",))[(i - 1) % 3]) for i in range(1, 8)}
_CLOUDS_SQL = " union all by name ".join(f"select {i} as oci, {', '.join(c)} from pts where tree_b = {i}" for i, c in _CLOUD_COLUMNS.items())


def _clouds(spark, sf_dir):
    p = src.pts(spark, sf_dir)
    return [p.where(f"tree_b = {i}").select(*c) for i, c in _CLOUD_COLUMNS.items()]


@query("merge_fill", f"{PTS}, m as ({_CLOUDS_SQL}) select oci::integer as oci, count(*) as n, count(score) as scores, count(species) as species, round(sum(X), 4) as x from m group by all")
def merge_fill(spark, sf_dir):
    return src.merge(_clouds(spark, sf_dir), fill=True).groupBy("oci").agg(F.count("*").alias("n"), F.count("score").alias("scores"), F.count("species").alias("species"), F.round(F.sum("X"), 4).alias("x"))


@query("merge_intersect", f"{PTS} select tree_b::integer as oci, X, round(Y, 6) as Y, Z, prob from pts")
def merge_intersect(spark, sf_dir):
    return src.merge(_clouds(spark, sf_dir)).select("oci", "X", F.round("Y", 6).alias("Y"), "Z", "prob")


@query("species_lookup_join", f"{PTS}, t as (select tree_a as species_id, count(*) as n from pts group by all) select t.species_id, n, n_name as scientific_name from t left join (select s_suppkey, n_name from supplier join nation on s_nationkey = n_nationkey) l on l.s_suppkey = t.species_id")
def species_lookup_join(spark, sf_dir):
    t = src.pts(spark, sf_dir).groupBy(F.col("tree_a").alias("species_id")).agg(F.count("*").alias("n"))
    return inventory.with_species_names(t, src.lookup(spark, sf_dir))


RING = [(10.0, 5.0), (40.0, 8.0), (35.0, 40.0), (22.0, 20.0), (12.0, 35.0)]


def _ring_sql(x, y):
    return "(" + " + ".join(f"(({y} > {a[1]}) <> ({y} > {b[1]}) and {x} < ({b[0]} - {a[0]})::double * ({y} - {a[1]}) / ({b[1]} - {a[1]}) + {a[0]})::integer" for a, b in zip(RING, RING[1:] + RING[:1])) + ") % 2 = 1"


@query("aoi_semi_join", f"{PTS}, t as (select okey % 2000 as k, avg(X) as x, avg(Y) as y from pts group by all) select k, round(x, 6) as x, round(y, 6) as y from t where {_ring_sql('x', 'y')}")
def aoi_semi_join(spark, sf_dir):
    t = src.pts(spark, sf_dir).groupBy((F.col("okey") % 2000).alias("k")).agg(F.avg("X").alias("x"), F.avg("Y").alias("y"))
    return inventory.in_area(t, [[RING]]).select("k", *r6("x", "y"))


@query("identity_seed", "select s_suppkey as id, list_reduce(list_prepend(42::bigint, list_transform(string_split('tree_a:' || s_suppkey, ''), lambda c: ord(c)::bigint)), lambda s, b: (s * 131 + b) % 2147483647) as seed from supplier")
def identity_seed(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), fn.identity_seed(42, F.lit("tree_a"), F.col("s_suppkey")).alias("seed"))


@query("instance_index", f"{SEG}, i as (select *, round(X / 0.001)::bigint as ix, round(Y / 0.001)::bigint as iy, round(Z / 0.001)::bigint as iz from seg) select src as segmentation_source, dim as instance_dimension, id as instance_id, count(*) as n, min(ix) as min_x, max(ix) as max_x, min(iy) as min_y, max(iy) as max_y, min(iz) as min_z, max(iz) as max_z, sum(ix)::bigint as sum_x, sum(iy)::bigint as sum_y from i group by all")
def instance_index(spark, sf_dir):
    return inventory.instance_index(src.seg(spark, sf_dir)).withColumns({c: F.col(c).cast("long") for c in ("sum_x", "sum_y")})


@query("owner_core", f"{SEG}, i as (select src, dim, id, count(*) as n, sum(round(X / 0.001)::bigint) as sx, sum(round(Y / 0.001)::bigint) as sy, min(round(X / 0.001)::bigint) as mx, min(round(Y / 0.001)::bigint) as my from seg group by all), o as (select min(mx) as ox, min(my) as oy from i) select src as segmentation_source, dim as instance_dimension, id as instance_id, n, floor((sx::double / n * 0.001 - ox * 0.001) / 0.5)::bigint as core_x, floor((sy::double / n * 0.001 - oy * 0.001) / 0.5)::bigint as core_y from i, o")
def owner_core(spark, sf_dir):
    return inventory.owner_core(inventory.instance_index(src.seg(spark, sf_dir)), 0.5)


@query("owned_rows", f"{SEG} select src as segmentation_source, id as instance_id, count(*) as n from seg group by all")
def owned_rows(spark, sf_dir):
    """Every instance has an owner, so all rows come back."""
    s = src.seg(spark, sf_dir)
    return inventory.owned_rows(s, inventory.tree_counts(s)).groupBy("segmentation_source", "instance_id").agg(F.count("*").alias("n"))


@query("circle_functions", f"{PTS} select okey, round(abs(sqrt((X - 25) ^ 2 + (Y - 25) ^ 2) - 10), 6) as d, round(degrees(atan2(Y - 25, X - 25)), 6) as angle, floor((case when degrees(atan2(Y - 25, X - 25)) < 0 then degrees(atan2(Y - 25, X - 25)) + 360 else degrees(atan2(Y - 25, X - 25)) end) / 10)::bigint as bin from pts")
def circle_functions(spark, sf_dir):
    x, y, c = F.col("X"), F.col("Y"), F.lit(25.0)
    a = fn.point_center_angle(x, y, c, c)
    return src.pts(spark, sf_dir).select("okey", F.round(fn.point_circle_distance(x, y, c, c, F.lit(10.0)), 6).alias("d"), F.round(a, 6).alias("angle"), fn.angle_bin(a).alias("bin"))


@query("vector_distance", "select a.vec_id, round(array_distance(a.embedding::double[64], b.embedding::double[64]), 6) as d from embeddings a, (select embedding from embeddings where vec_id = 0) b")
def vector_distance(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"))
    return e.join(F.broadcast(e.where("vec_id = 0").select(F.col("a").alias("b")))).select("vec_id", F.round(fn.p_dist(F.col("a"), F.col("b")), 6).alias("d"))


@query("quality_label", "select s_suppkey as id, case when s_suppkey % 5 = 0 then 'dbh_unavailable' else case s_suppkey % 6 when 1 then 'too_few_stem_slice_points' when 2 then 'fallback_circle_estimate' when 3 then 'rejected_or_unstable_fit' when 4 then 'spline_fit' else 'measurement_unavailable' end end as label from supplier")
def quality_label(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), fn.quality_label(F.col("s_suppkey") % 6, F.when(F.col("s_suppkey") % 5 != 0, 0.3)).alias("label"))


@query("valid_values", f"{PTS} select tree_a, count(case when v >= 0 then 1 end) as n, round(avg(case when v >= 0 then v end), 6) as mean from (select tree_a, case when okey % 11 = 0 then 'nan'::double when okey % 13 = 0 then 'infinity'::double when okey % 5 = 0 then -1 else prob end as v from pts) where not isnan(v) and not isinf(v) group by all")
def valid_values(spark, sf_dir):
    v = F.expr("case when okey % 11 = 0 then double('NaN') when okey % 13 = 0 then double('Infinity') when okey % 5 = 0 then -1D else prob end")
    p = src.pts(spark, sf_dir).select("tree_a", fn.finite(v).alias("f")).where("f is not null")
    return p.groupBy("tree_a").agg(F.count(fn.non_negative(F.col("f"))).alias("n"), F.round(F.avg(fn.non_negative(F.col("f"))), 6).alias("mean"))


_RULES_SQL = """r0 as (select tree_a, floor(Y)::bigint as sl, avg(X) as x from pts group by all),
r as (select tree_a, sl, x * (1 + 0.9 * ((sl * 7 + tree_a) % 5 = 0)::integer - 0.9985 * ((sl + tree_a) % 11 = 3)::integer) as r from r0),
w as (select tree_a, list(round(r, 6) order by sl) as rs, median(round(r, 6)) as mid, stddev_samp(round(r, 6)) as sd from r group by all),
k as (select tree_a, list_transform(rs, lambda x: case when len(rs) > 1 and abs(x - mid) > 2 * sd then null else x end) as rs from w)"""


@query(
    "reject_radii",
    f"{PTS}, {_RULES_SQL} select tree_a, len(rs) as n, len(list_filter(rs, lambda x: x is null)) as outliers, list_reduce(list_prepend([coalesce(rs[1], 'infinity'::double), (rs[1] is not null)::integer], list_transform(rs[2:], lambda x: [x, 0])), lambda s, x: case when x[1] is null or x[1] < 0.04 or x[1] > 1.3 * s[1] then s else [least(s[1], x[1]), s[2] + 1] end)[2]::bigint as kept from k",
)
def reject_radii(spark, sf_dir):
    """The quality rules of slices on each tree's ordered radii, by the fit's own function: mean X by unit of Y, some of
    them blown up or shrunk so that every rule has cases."""
    k = F.floor("Y").cast("long")
    odd = 1 + 0.9 * ((k * 7 + F.col("tree_a")) % 5 == 0).cast("int") - 0.9985 * ((k + F.col("tree_a")) % 11 == 3).cast("int")
    r = src.pts(spark, sf_dir).groupBy("tree_a", k.alias("sl"), odd.alias("odd")).agg(F.avg("X").alias("r")).select("tree_a", "sl", F.round(F.col("r") * F.col("odd"), 6).alias("r"))
    lists = r.groupBy("tree_a").agg(F.transform(F.array_sort(F.collect_list(F.struct("sl", "r"))), lambda x: x["r"]).alias("rs"))  # one value for each slice

    def rules(batches):
        for b in batches:
            found = [circle.slice_status(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([f(x) for x in found], pa.int64()) for f in (len, lambda x: x.count("outlier_2sd"), lambda x: x.count("fitted")))], ["tree_a", "n", "outliers", "kept"])

    return lists.mapInArrow(rules, "tree_a bigint, n bigint, outliers bigint, kept bigint")


@query("keep_last", "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by event_id desc) as r from events) where r = 1")
def keep_last(spark, sf_dir):
    return inventory.last_by(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ("user_id",), "event_id")


@query("cluster_size_filter", f"{PTS}, c as (select tree_a, count(*) as n, avg(X) as x, avg(Y) as y, min(Z) as z from pts group by all) select tree_a, n, round(x, 6) as x, round(y, 6) as y, z from c where n > (select median(n) from c)")
def cluster_size_filter(spark, sf_dir):
    c = src.pts(spark, sf_dir).groupBy("tree_a").agg(F.count("*").alias("n"), F.avg("X").alias("x"), F.avg("Y").alias("y"), F.min("Z").alias("z"))
    return c.join(F.broadcast(c.agg(F.median("n").alias("m"))), F.col("n") > F.col("m")).select("tree_a", "n", *r6("x", "y"), "z")


@query("tile_core", f"{PTS} select floor(X / 25)::bigint as tx, floor(Y / 25)::bigint as ty, count(*) as n from pts where X >= 0 and X < 50 and Y >= 0 and Y < 50 group by all")
def tile_core(spark, sf_dir):
    return src.spatial_filter(src.pts(spark, sf_dir), 0, 0, 50, 50).groupBy(fn.cell(F.col("X"), 25.0).alias("tx"), fn.cell(F.col("Y"), 25.0).alias("ty")).agg(F.count("*").alias("n"))


@query("partition_id", f"{PTS} select abs(tree_a) % 64 as part, count(*) as n from pts group by all")
def partition_id(spark, sf_dir):
    return src.pts(spark, sf_dir).groupBy((F.abs("tree_a") % 64).alias("part")).agg(F.count("*").alias("n"))


@query("cloud_bounds", f"{PTS} select count(*) as n, min(X) as min_x, max(X) as max_x, min(Y) as min_y, max(Y) as max_y, min(Z) as min_z, max(Z) as max_z from pts")
def cloud_bounds(spark, sf_dir):
    return src.bounds(src.pts(spark, sf_dir))


@query("largest_instance", f"{SEG}, c as (select src, id, count(*) as n from seg group by all) select src as segmentation_source, max(n) as points, arg_max(id, (n, -id)) as instance_id, count(*) as instances from c group by all")
def largest_instance(spark, sf_dir):
    c = inventory.tree_counts(src.seg(spark, sf_dir))
    return c.groupBy("segmentation_source").agg(F.max("point_count").alias("points"), F.max_by("instance_id", F.struct("point_count", -F.col("instance_id"))).alias("instance_id"), F.count("*").alias("instances"))


@query("standardise", "with s as (select vec_id, embedding[1]::double as a, embedding[2]::double as b from embeddings), m as (select avg(a) as ma, stddev_samp(a) as sa, avg(b) as mb, stddev_samp(b) as sb from s) select vec_id, round((a - ma) / sa, 5) as a, round((b - mb) / sb, 5) as b from s, m")
def standardise(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("a"), F.col("embedding")[1].cast("double").alias("b"))
    return sampling.standardise(e, ["a", "b"]).select("vec_id", *r6("a", "b", digits=5))


@query("polygon_json", "select n_nationkey as id, '{\"type\":\"Polygon\",\"coordinates\":[[' || printf('[%.3f,%.3f],[%.3f,%.3f],[%.3f,%.3f],[%.3f,%.3f]', k, 0.0, k + 1.5, 0.25, k, 2.0, k, 0.0) || ']]}' as g, round(1.5, 6)::double as area from (select n_nationkey, n_nationkey::double as k from nation)")
def polygon_json(spark, sf_dir):
    k = F.col("n_nationkey").cast("double")
    p = lambda x, y: F.struct(x.alias("x"), F.lit(y).alias("y"))
    ring = F.array(p(k, 0.0), p(k + 1.5, 0.25), p(k, 2.0))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), fn.geojson_polygon(ring).alias("g"), F.round(fn.ring_area(ring), 6).alias("area"))


@query("batch_aggregates", "select user_id, count(*) as point_count, round(max(value) - min(value), 6) as height_m, min(value) as low, max(value) as high from events group by all")
def batch_aggregates(spark, sf_dir):
    """What the streaming accumulation gives, in one batch."""
    return accumulate.accumulate(table(spark, sf_dir, "events"), ("user_id",), "value").withColumn("height_m", F.round("height_m", 6))


@query("streaming_accumulate", ORACLE_SQL["batch_aggregates"])
def streaming_accumulate(spark, sf_dir):
    """The same over micro-batches of the table's files."""
    t = table(spark, sf_dir, "events")
    pattern = f"{sf_dir}/events.parquet"
    s = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{sf_dir}/events.parque[t]" if "://" not in pattern else pattern)
    return accumulate.run_available(accumulate.accumulate(s, ("user_id",), "value")).withColumn("height_m", F.round("height_m", 6))


@query("event_windows", "select cast(date_trunc('hour', ts) as timestamp) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all")
def event_windows(spark, sf_dir):
    """Event-time windows; in a batch no row is late."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return accumulate.windowed(e).withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn("total", F.round("total", 4))


# group functions and iterations: rows only here, fixtures in tests


@query("hull_area")
def hull_area(spark, sf_dir):
    return inventory.hull_areas(src.seg(spark, sf_dir)).select(*inventory.TREE, F.round("convex_hull_area_m2", 4).alias("convex_hull_area_m2"), "crown_hull")


@query("stand_hull")
def stand_hull(spark, sf_dir):
    return hull.hull_vertices(src.pts(spark, sf_dir), ()).select(F.explode("ring").alias("p")).select("p.x", "p.y")


def _stems(spark, sf_dir) -> DataFrame:
    """A generated stem for ten suppliers: the driver's tables hold no stems, but the number of trees follows them."""
    return src.stems(spark, max(4, table(spark, sf_dir, "supplier").count() // 10))


@query("dbh_inventory")
def dbh_inventory(spark, sf_dir):
    s = _stems(spark, sf_dir).select(F.lit("S").alias("segmentation_source"), F.lit("stem").alias("instance_dimension"), "instance_id", "X", "Y", "Z", *[F.lit(None).cast("double").alias(c) for c in ("species", "prob", "score")])
    return inventory.inventory(s, Config(dbh_runs=3, metrics_grid=0.01)).drop("dbh_fits", "dbh_slices")


@query("circle_fit")
def circle_fit(spark, sf_dir):
    s = _stems(spark, sf_dir).withColumnRenamed("instance_id", "TreeID").withColumn("Znorm", F.col("Z"))
    return inventory.forest_inventory(s, slice_min=1.0, slice_max=2.0).select("TreeID", *r6("X", "Y", "DBH", digits=4), "quality_flag")


@query("simple_inventory")
def simple_inventory(spark, sf_dir):
    s = _stems(spark, sf_dir).withColumnRenamed("instance_id", "TreeID").withColumn("Znorm", F.col("Z"))
    return inventory.forest_inventory_simple(s).select("TreeID", *r6("X", "Y", "DBH", digits=4), "quality_flag", F.round("Height", 4).alias("Height"))


def _farthest_sql(n: int) -> str:
    steps = ["p1 as materialized (select vec_id, v from e order by v[1] desc, vec_id limit 1), s1 as materialized (select e.vec_id, e.v, array_distance(e.v, p1.v) as d from e, p1)"]
    for i in range(2, n + 1):
        steps.append(f"p{i} as materialized (select vec_id, v from s{i - 1} order by d desc, vec_id limit 1), s{i} as materialized (select s.vec_id, s.v, least(s.d, array_distance(s.v, p.v)) as d from s{i - 1} s, p{i} p)")
    return f"with e as materialized (select vec_id, embedding::double[64] as v from embeddings), {', '.join(steps)} " + " union all ".join(f'select {i}::integer as "order", vec_id from p{i}' for i in range(1, n + 1))


@query("farthest_points", _farthest_sql(10))
def farthest_points(spark, sf_dir):
    return sampling.fds(table(spark, sf_dir, "embeddings"), 10)


@query("color_ids")
def color_ids(spark, sf_dir):
    return sampling.color_ids(src.pts(spark, sf_dir).withColumn("TreeID", F.col("tree_a")), "TreeID").groupBy("TreeID", "R", "G", "B").agg(F.count("*").alias("n"))


_CLUSTERS_SQL = "e as (select a.id as s, b.id as t from v a join v b on (a.X - b.X) ^ 2 + (a.Y - b.Y) ^ 2 <= 1.21 + 1e-12), reach as (select id as s, id as t from v union select r.s, e.t from reach r join e on e.s = r.t), g as (select s as id, min(t) as component from reach group by all)"


@query(
    "seeds_raster",
    f"""{PTS.replace("with", "with recursive", 1)}, pix as (select floor(X)::bigint as px, floor(Y)::bigint as py, count(*) as n, avg(Z) as z from pts where Z > 1 and Z < 9 group by all), v as (select px * 1000 + py as id, px + 0.5 as X, py + 0.5 as Y from pix where n > (select quantile_cont(n, 0.9) from pix)), {_CLUSTERS_SQL},
c as (select avg(X) as X, avg(Y) as Y from v join g using (id) group by component) select round(c.X, 6) as X, round(c.Y, 6) as Y, round(coalesce(pix.z, 5), 6) as Z, row_number() over (order by c.X, c.Y, coalesce(pix.z, 5)) as TreeID from c left join pix on floor(c.X) = px and floor(c.Y) = py""",
)
def seeds_raster(spark, sf_dir):
    return graph.find_base_coordinates_raster(src.pts(spark, sf_dir).select("X", "Y", "Z"), 1.0, 1.0, 9.0, 0.9, 1.1).select(*r6("X", "Y", "Z"), "TreeID")


@query("terrain_model")
def terrain_model(spark, sf_dir):
    return terrain.make_dtm(src.pts(spark, sf_dir).select("X", "Y", "Z", F.lit(2).alias("Classification")), 1.0, candidate=1.0)
