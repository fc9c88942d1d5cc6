"""Graphs as edge tables: components, clusters, edge weights and multi-source shortest paths by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import edge_weight
from ..plans.storage import written
from .neighbors import radius_join
from .voxel import add_voxel_coordinates, voxelize_points_mean_attributes


def connected_components(nodes: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, component): the smallest id that edges (src, dst) reach.

    Alternating large-star and small-star steps: every join is on a node and its own neighbours, never on a component, and
    edges only become fewer. Each step is written, so no lineage grows."""
    e = written(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = written(large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct())
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    ids = nodes.select(F.col(id_col).alias("id")).distinct()
    return ids.join(e, F.col("id") == F.col("u"), "left").select("id", F.coalesce("v", "id").alias("component"))


def dbscan_min1(points: DataFrame, eps: float, dims: tuple[str, ...] = ("X", "Y"), id_col: str = "id") -> DataFrame:
    """DBSCAN with every point a core: components of the eps graph. Adds ``component``."""
    edges = radius_join(points, points, eps, dims, id_col)
    return points.join(connected_components(points, edges, id_col).withColumnRenamed("id", id_col), id_col)


def cost_edges(voxels: DataFrame, voxel: float, v_w: float, s_w: float, l_w: float) -> DataFrame:
    """Undirected (a, b, w) between voxel centres of gravity within two cells. Both directions' weights are summed; each
    uses the features of the voxel it leads to, and costs 0 if it starts at a seed."""
    pos = voxels.select("id", F.col("X_gr").alias("X"), F.col("Y_gr").alias("Y"), F.col("Z_gr").alias("Z"))
    far = radius_join(pos, pos, 2 * voxel)
    to = voxels.select(F.col("id").alias("dst"), "Verticality", "Sphericity", "Linearity")
    start = voxels.select(F.col("id").alias("src"), F.col("is_seed"))
    w = edge_weight(F.col("d"), F.col("Verticality"), F.col("Sphericity"), F.col("Linearity"), v_w, s_w, l_w, voxel)
    e = far.join(to, "dst").join(start, "src").select("src", "dst", F.when(F.col("is_seed"), 0.0).otherwise(w).alias("w"))
    return e.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.sum("w").alias("w"))


def nearest_seeds(edges: DataFrame, seeds: DataFrame, n_trees: int = 1, most_rounds: int = 10_000) -> DataFrame:
    """(id, rank, seed, dist): the n nearest seeds of each node by path length; ties go to the lower seed.

    State is the best n_trees for each node, never a seed x node matrix. Only nodes that changed send along their edges.
    """
    both = written(edges.select("a", "b", "w").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")))
    order = Window.partitionBy("id").orderBy("dist", "seed")
    state = written(seeds.select("id", "seed", F.lit(0.0).alias("dist"), F.lit(True).alias("new")))
    for _ in range(most_rounds):
        sent = state.where("new").join(both, F.col("id") == F.col("a")).select(F.col("b").alias("id"), "seed", (F.col("dist") + F.col("w")).alias("dist"))
        every = state.select("id", "seed", "dist", F.lit(0).alias("o")).unionByName(sent.withColumn("o", F.lit(1)))
        best = every.groupBy("id", "seed").agg(F.min(F.struct("dist", "o")).alias("m")).select("id", "seed", "m.dist", (F.col("m.o") == 1).alias("new"))
        state = written(best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_trees))
        if not state.where("new").limit(1).count():
            break
        state = state.select("id", "seed", "dist", "new", "rank")
    else:
        raise RuntimeError(f"paths are still growing shorter after {most_rounds} rounds")
    return state.select("id", F.col("rank").cast("int").alias("rank"), "seed", "dist")


def pivot_ranks(best: DataFrame, n_trees: int) -> DataFrame:
    """TreeID, TreeID2 ... and dist, dist2 ...; a missing rank is tree 0."""
    cols = []
    for r in range(1, n_trees + 1):
        s = "" if r == 1 else str(r)
        cols += [F.coalesce(F.max(F.when(F.col("rank") == r, F.col("seed"))), F.lit(0)).alias(f"TreeID{s}"), F.max(F.when(F.col("rank") == r, F.col("dist"))).alias(f"dist{s}")]
    return best.groupBy("id").agg(*cols)


def comparative_shortest_path(voxels: DataFrame, seeds: DataFrame, voxel: float, v_w: float = 0.0, l_w: float = 0.0, s_w: float = 0.0, n_trees: int = 1) -> DataFrame:
    """voxels (id, features, centres of gravity) and seeds (id, seed): voxels with TreeID and dist columns. Voxels
    without a neighbour are no part of the graph and aren't returned."""
    edges = written(cost_edges(voxels, voxel, v_w, s_w, l_w))
    in_graph = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct()
    found = pivot_ranks(nearest_seeds(edges, seeds.join(in_graph, "id", "left_semi"), n_trees), n_trees)
    ids = [c for c in found.columns if c.startswith("TreeID")]
    return voxels.join(in_graph, "id", "left_semi").join(found, "id", "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ids})


def csp_cost_segmentation(df: DataFrame, seeds: DataFrame, voxel: float = 0.3, v_w: float = 0.0, l_w: float = 0.0, s_w: float = 0.0, n_trees: int = 1) -> DataFrame:
    """Every point to the seed with the cheapest path through the voxel graph. seeds: X, Y, Z, TreeID.

    Points in voxels outside the graph are dropped. Missing features count as 0; seeds at height 0 are lifted to 0.5."""
    for c in ("X", "Y", "Z", "TreeID"):
        if c not in seeds.columns:
            raise ValueError(f"seeds need a column {c}")
    if voxel <= 0:
        raise ValueError("the voxel size must be above 0")
    facts = seeds.agg(F.count("*"), F.sum("Z"), F.max("Z")).first()
    low = df.agg(F.min("Z")).first()[0]
    if not facts[0] or low is None:
        raise ValueError("the cloud and the seeds must hold rows")
    seed_z = F.lit(0.5) if facts[1] == 0 else F.col("Z")
    if low > (0.5 if facts[1] == 0 else facts[2]):
        raise ValueError("the cloud lies above all seeds")
    df = df.drop("TreeID")
    features = ("Sphericity", "Linearity", "Verticality")
    full = df.withColumns({c: F.lit(0.0) for c in features if c not in df.columns})
    vox = voxelize_points_mean_attributes(full.select("X", "Y", "Z", *features), voxel)
    key = F.struct("vx", "vy", "vz")
    # ids: seeds are the last; numbers come from a hash of the cell, so that no global sort is needed
    base = vox.select(F.xxhash64(key).alias("id"), "vx", "vy", "vz", "X_gr", "Y_gr", "Z_gr", *features, F.lit(False).alias("is_seed"))
    extra = seeds.select((F.lit(-(1 << 62)) - F.col("TreeID").cast("long")).alias("id"), *[F.lit(None).cast("long").alias(c) for c in ("vx", "vy", "vz")], F.col("X").alias("X_gr"), F.col("Y").alias("Y_gr"), seed_z.alias("Z_gr"), *[F.lit(0.0).alias(c) for c in features], F.lit(True).alias("is_seed"))
    nodes = written(base.unionByName(extra))
    start = seeds.select((F.lit(-(1 << 62)) - F.col("TreeID").cast("long")).alias("id"), F.col("TreeID").cast("long").alias("seed"))
    found = comparative_shortest_path(nodes, start, voxel, v_w, l_w, s_w, n_trees).where("not is_seed")
    out = [c for c in found.columns if c.startswith(("TreeID", "dist"))]
    return add_voxel_coordinates(df, voxel).join(found.select("vx", "vy", "vz", *out), ["vx", "vy", "vz"]).drop("vx", "vy", "vz", "x_vox", "y_vox", "z_vox")


def assign_back(df: DataFrame, labels: DataFrame, id_col: str = "point_id") -> DataFrame:
    """Labels to the original rows; unmatched rows get tree 0."""
    return df.join(labels.select(id_col, "TreeID"), id_col, "left").withColumn("PredInstance_CSP", F.coalesce("TreeID", F.lit(0)).cast("long")).drop("TreeID")


def find_base_coordinates_raster(df: DataFrame, res: float = 0.1, zmin: float = 0.5, zmax: float = 2.0, q: float = 0.975, eps: float = 0.2) -> DataFrame:
    """Seeds (X, Y, Z, TreeID) where the slice is densest: pixels strictly above the q-quantile, clustered by eps."""
    pixels = written(df.where((F.col("Z") > zmin) & (F.col("Z") < zmax)).groupBy(F.floor(F.col("X") / res).cast("long").alias("px"), F.floor(F.col("Y") / res).cast("long").alias("py")).agg(F.count("*").alias("n"), F.avg("Z").alias("z")))
    limit = pixels.agg(F.percentile("n", F.lit(q))).first()[0]
    if limit is None:
        raise ValueError("no points in the slice")
    centre = lambda c: (F.col(c) + 0.5) * res
    high = written(pixels.where(F.col("n") > limit).select(F.xxhash64("px", "py").alias("id"), centre("px").alias("X"), centre("py").alias("Y")))
    seeds = dbscan_min1(high, eps).groupBy("component").agg(F.avg("X").alias("X"), F.avg("Y").alias("Y"))
    seeds = seeds.withColumns({"px": F.floor(F.col("X") / res).cast("long"), "py": F.floor(F.col("Y") / res).cast("long")}).join(pixels.select("px", "py", "z"), ["px", "py"], "left")
    return number_trees(seeds.select("X", "Y", F.coalesce("z", F.lit((zmin + zmax) / 2)).alias("Z")))


def find_base_coordinates_geom(df: DataFrame, zmin: float = 0.5, zmax: float = 2.0, res: float = 0.5, min_verticality: float = 0.9, min_planarity: float = 0.5, min_cluster_size: int | None = None) -> DataFrame:
    """Seeds from points with stem-like features (Verticality, Planarity columns), clustered by res in 3-D."""
    part = df.where((F.col("Z") > zmin) & (F.col("Z") < zmax) & (F.col("Planarity") > min_planarity) & (F.col("Verticality") > min_verticality))
    if "Classification" in df.columns:
        part = part.where("Classification <> 2")
    part = written(part)
    if not part.limit(1).count():
        raise ValueError("no points pass the slice and feature limits")
    c = written(dbscan_min1(part, res, ("X", "Y", "Z")).groupBy("component").agg(F.count("*").alias("n"), F.avg("X").alias("X"), F.avg("Y").alias("Y"), F.min("Z").alias("Z")))
    least = c.agg(F.median("n")).first()[0] if min_cluster_size is None else min_cluster_size
    return number_trees(c.where(F.col("n") > least).select("X", "Y", "Z"))


def number_trees(seeds: DataFrame) -> DataFrame:
    """TreeID 1..n by place; one row for each tree, a small table."""
    return seeds.withColumn("TreeID", F.row_number().over(Window.orderBy("X", "Y", "Z")).cast("long"))
