"""Approximate nearest neighbours: inverted multi-index.

Vectors are cut into two halves; each half is quantised by its own small codebook (k-means on a bounded sample, at most
``SAMPLE`` vectors). A cell is a pair of centroids. For a query, the pairs are taken from a heap in the order of their
summed half-scores: the largest inner product that a half in this cell can have, <q, c> + |q| r, where r is the largest
distance of an indexed half from its centroid. Every vector is indexed; entries are reranked by exact inner product.

Two rounds. The first takes cells until they hold ``first_entries`` entries, which gives each query a k-th score to
beat. The second goes on through the heap until the summed bound can't reach that score. So the search stops early
where the data have structure, and is exact in any case: the recall is 1.

Entries stand in parts of at most ``PART_BYTES``: small cells share a part, a large cell has several. A part is shuffled
once; the queries that need it come to it behind its entries, in batches, each with the cells it wants, and a batch meets
a cell in one matrix product. So a task holds one part and one batch, however many queries there are, and each query is
sent to each part that it needs, once. The second round gives only entries that reach the score to beat.

Of equal vectors a part keeps the k + 1 smallest ids, as no result can use more of them.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components take
no part; a query never finds its own row; ties go to the smaller id; with fewer candidates than k all are given;
repeated rows of one id and vector count once; an empty table gives an empty table; only the two named columns are read,
whatever others there are.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Saved, table

#: Vectors for the codebooks, entries of the first round.
SAMPLE, FIRST = 10_000, 2_000
#: Bytes of a part's vectors at most and at least; entries and queries scored in one product.
PART_BYTES, LEAST_BYTES, CHUNK, BATCH = 32 << 20, 1 << 20, 4_096, 512


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means from a fixed start; an empty centroid stays where it is."""
    c = x[np.random.default_rng(7).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = ((c * c).sum(1)[None, :] - 2 * x @ c.T).argmin(1)
        for j in range(len(c)):
            if (own := near == j).any():
                c[j] = x[own].mean(0)
    return c


def assign(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = (x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * x @ c.T
    j = d.argmin(1)
    return j, np.sqrt(np.maximum(d[np.arange(len(x)), j], 0))


def traverse(a: np.ndarray, b: np.ndarray, counts: dict[int, int], width: int):
    """(cell, summed bound) of the non-empty cells, largest bound first, by a heap over pairs of the two sorted lists."""
    ia, ib = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
    heap, seen = [(-(a[ia[0]] + b[ib[0]]), 0, 0)], {(0, 0)}
    while heap:
        s, i, j = heapq.heappop(heap)
        cell = int(ia[i]) * width + int(ib[j])
        if cell in counts:
            yield cell, -s
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(ia) and y < len(ib) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (-(a[ia[x]] + b[ib[y]]), x, y))


def _matrix(col, d: int) -> np.ndarray:
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, d)


def _parts(counts: dict[int, int], room: int) -> tuple[dict[int, tuple[int, int]], int]:
    """(first part, number of parts) of each cell, and the number of parts; a part has about ``room`` entries at most."""
    out, n, used = {}, 0, 0
    for c, m in sorted(counts.items()):
        if used and used + m > room:
            n, used = n + 1, 0
        out[c] = n, -(-m // room)
        n, used = (n, used + m) if m <= room else (n + out[c][1], 0)
    return out, n + (used > 0)


def _load(pieces: list[pa.RecordBatch], d: int, kind, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Vectors, ids and cells of a part, of equal vectors the k + 1 smallest ids; each row of a repeated id once."""
    if not pieces:
        return None
    t = pa.Table.from_batches(pieces)
    raw = b"".join(t["v"].to_pylist())
    ids, cell = t["id"].to_numpy(), t["cell"].to_numpy()
    _, same = np.unique(np.frombuffer(raw, np.dtype((np.void, d * np.dtype(kind).itemsize))), return_inverse=True)
    turn = np.lexsort((ids, same))
    s, i = same[turn], ids[turn]
    turn = turn[np.concatenate([[True], (s[1:] != s[:-1]) | (i[1:] != i[:-1])])]
    s = same[turn]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    place = np.arange(len(s)) - np.repeat(first, np.diff(np.concatenate([first, [len(s)]])))
    turn = np.sort(turn[place <= k])
    return np.frombuffer(raw, kind).reshape(-1, d)[turn].astype(np.float64), ids[turn], cell[turn]


def nearest(q: np.ndarray, qids: np.ndarray, wanted: list[list[int]], e: np.ndarray, ids: np.ndarray, cell: np.ndarray, k: int):
    """(query's place, entry's place, score) of the k best entries for each query among the cells it wants."""
    width = 2 * k + 1  # k, as many ties at the edge as equal vectors there can be, and the query itself
    best, at = np.full((len(q), width), -np.inf), np.full((len(q), width), -1)
    order = np.argsort(cell, kind="stable")
    cells, starts = np.unique(cell[order], return_index=True)
    places = dict(zip(cells.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(cell)])))
    who = np.repeat(np.arange(len(q)), [len(x) for x in wanted])
    what = np.fromiter((c for x in wanted for c in x), np.int64, len(who))
    turn = np.argsort(what, kind="stable")
    who, (names, firsts) = who[turn], np.unique(what[turn], return_index=True)
    for c, lo, hi in zip(names.tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(who)]):
        rows = who[lo:hi]
        start, end = places.get(c, (0, 0))
        for i in range(start, end, CHUNK):
            own = order[i : min(end, i + CHUNK)]
            s = q[rows] @ e[own].T
            better = s.max(1) >= best[rows].min(1) - 1e-9
            r, s = rows[better], s[better]
            if len(own) > width:
                pick = np.argpartition(s, len(own) - width, axis=1)[:, -width:]
                s, own = np.take_along_axis(s, pick, 1), own[pick]
            else:
                own = np.broadcast_to(own, s.shape)
            s, own = np.concatenate([best[r], s], 1), np.concatenate([at[r], own], 1)
            pick = np.argpartition(s, s.shape[1] - width, axis=1)[:, -width:]
            best[r], at[r] = np.take_along_axis(s, pick, 1), np.take_along_axis(own, pick, 1)
    found = []
    for i in range(0, len(q), 64):  # the few that are left, in extended precision
        j, x = at[i : i + 64], q[i : i + 64].astype(np.longdouble)
        s = (x[:, None, :] * e[j]).sum(2).astype(np.float64)
        s[(j < 0) | (ids[j] == qids[i : i + 64, None])] = -np.inf
        first = np.lexsort((ids[j], -s), axis=1)[:, :k]
        s, j = np.take_along_axis(s, first, 1), np.take_along_axis(j, first, 1)
        on = s > -np.inf
        found.append((np.repeat(np.arange(i, i + len(j)), on.sum(1)), j[on], s[on]))
    return tuple(np.concatenate(x) for x in zip(*found))


def search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", cells: int | None = None, first_entries: int = FIRST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query. is_query: a condition on ``id``."""
    spark, saved = vectors.sparkSession, Saved(vectors.sparkSession)
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = "id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)"
    v = v.where(fine)
    d = _dimension(v)
    if not d:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    every = v.where(F.size("v") == d)
    n = every.count()
    size = cells or max(2, min(64, round((n / 200) ** 0.5)))
    picked = every.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
    x = _matrix(picked.column(0).combine_chunks(), d)
    x = x[np.lexsort(x.T)]
    h = d // 2
    c1, c2 = codebook(x[:, :h], size), codebook(x[:, h:], size)
    single = dict(vectors.select(vec_col).dtypes)[vec_col] == "array<float>"
    kind = np.float32 if single else np.float64  # as stored: nothing is rounded

    def place(batches):
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0), d)
                (j1, r1), (j2, r2) = assign(x[:, :h], c1), assign(x[:, h:], c2)
                yield pa.RecordBatch.from_arrays([pa.array(j1 * len(c2) + j2, pa.int32()), pa.array(r1), pa.array(r2), pa.array([r.tobytes() for r in x.astype(kind)], pa.binary()), b.column(1)], ["cell", "r1", "r2", "v", "id"])

    index = saved(every.select("v", "id").mapInArrow(place, "cell int, r1 double, r2 double, v binary, id bigint"))
    stats = index.groupBy("cell").agg(F.count("*").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect()  # cells: size^2 at most
    counts = {r.cell: r.n for r in stats}
    w = len(c2)
    rad1, rad2 = np.zeros(len(c1)), np.zeros(w)
    for r in stats:
        rad1[r.cell // w], rad2[r.cell % w] = max(rad1[r.cell // w], r.r1), max(rad2[r.cell % w], r.r2)
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts, _ = _parts(counts, max(1, min(PART_BYTES, max(LEAST_BYTES, 8 * d * n // tasks)) // (8 * d)))
    where = spark.createDataFrame([(c, *p) for c, p in parts.items()], "cell int, start int, parts int")  # a row for each cell
    entries = index.join(F.broadcast(where), "cell").select((F.col("start") + F.pmod(F.xxhash64("v", "id"), F.col("parts"))).cast("int").alias("part"), F.lit(False).alias("asks"), "id", "cell", "v", F.lit(None).cast("array<int>").alias("cells"), F.lit(None).cast("double").alias("beat"))
    queries = every.where(is_query).select(F.col("id").alias("qid"), "v").dropDuplicates(["qid", "v"])

    row = "part int, asks boolean, id bigint, cell int, v binary, cells array<int>, beat double"

    def asked(part, qid, vec, wanted, beat):
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([True] * len(part), pa.bool_()), pa.array(qid, pa.int64()), pa.nulls(len(part), pa.int32()), pa.array(vec, pa.binary()), pa.array(wanted, pa.list_(pa.int32())), pa.array(beat, pa.float64())], [f.split()[0] for f in row.split(", ")])

    def probes(first: bool):
        def run(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                q = _matrix(b.column(1), d)
                q1, q2 = q[:, :h], q[:, h:]
                u1 = q1 @ c1.T + np.sqrt((q1 * q1).sum(1))[:, None] * rad1[None, :]
                u2 = q2 @ c2.T + np.sqrt((q2 * q2).sum(1))[:, None] * rad2[None, :]
                beat = None if first else b.column(2).to_pylist()
                rows: list[list] = [[], [], [], [], []]
                for i, query in enumerate(b.column(0).to_pylist()):
                    got, mine = 0, {}
                    for c, bound in traverse(u1[i], u2[i], counts, w):
                        if first and got >= first_entries or not first and beat[i] is not None and bound < beat[i] - 1e-9:
                            break
                        if first or got >= first_entries:
                            start, m = parts[c]
                            for p in range(start, start + m):
                                mine.setdefault(p, []).append(c)
                        got += counts[c]
                    own = q[i].tobytes()
                    for x, y in zip(rows, (mine.keys(), [query] * len(mine), [own] * len(mine), mine.values(), [None if first else beat[i]] * len(mine))):
                        x += y
                    if len(rows[0]) >= CHUNK:
                        yield asked(*rows)
                        rows = [[], [], [], [], []]
                yield asked(*rows)

        return run

    def rerank(batches):
        """Sorted by part, entries before queries: the k best entries of a part for each query that asks it."""

        def answers(part, asked):
            q = np.frombuffer(b"".join(asked.column("v").to_pylist()), np.float64).reshape(-1, d)
            ids = asked.column("id").to_numpy()
            i, j, s = nearest(q, ids, asked.column("cells").to_pylist(), *part, k)
            beat = asked.column("beat").to_numpy(zero_copy_only=False).astype(float)[i]
            on = ~(s < beat)
            return pa.RecordBatch.from_arrays([pa.array(ids[i[on]], pa.int64()), pa.array(part[1][j[on]], pa.int64()), pa.array(s[on], pa.float64())], ["qid", "vec_id", "score"])

        now, held, part = None, [], None
        for b in batches:
            number, asks = b.column("part").to_numpy(), b.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                if hi == lo:
                    continue
                piece = b.slice(lo, hi - lo)
                if number[lo] != now:
                    now, held, part = number[lo], [], None
                if not asks[lo]:
                    held.append(piece.select(["id", "cell", "v"]))
                    continue
                if part is None:
                    part = _load(held, d, kind, k)
                    held = []
                if part is not None:
                    for at in range(0, piece.num_rows, BATCH):
                        yield answers(part, piece.slice(at, BATCH))

    def found(asked: DataFrame) -> DataFrame:
        both = entries.unionByName(asked).repartition("part").sortWithinPartitions("part", "asks")
        return both.mapInArrow(rerank, "qid long, vec_id long, score double")

    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")

    def top(df: DataFrame) -> DataFrame:
        return df.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    one = saved(top(found(queries.mapInArrow(probes(True), row))))
    beat = one.where(F.col("rank") == k).select(F.col("qid").alias("_q"), F.col("score").alias("beat"))
    rest = queries.join(beat, queries["qid"] == beat["_q"], "left").select("qid", "v", "beat")
    two = found(rest.mapInArrow(probes(False), row))
    out = top(one.select("qid", "vec_id", "score").unionByName(two))
    return out.select(F.col("qid").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _dimension(v: DataFrame) -> int:
    """The commonest length; the larger on ties."""
    row = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return row.d if row else 0


def op7_ann(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"), F.expr("id % 20 = 0"))


OP7_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings where embedding is not null and list_count(embedding) = len(embedding) and len(list_filter(embedding, lambda x: isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v) as score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0)
select query_id, rank::integer as rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p) where rank <= 20
"""
