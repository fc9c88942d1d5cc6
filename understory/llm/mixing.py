"""Mixing sources to target weights along a time-varying curriculum. SQL functions only.

Targets: the sources share all words by weight; a source can give at most ``max_passes`` times its words, and what it
can't give is shared again among the others by weight until none is above (water filling; each turn settles one source
at least, so it is done in closed form on the sources sorted by how soon they fill up).

Which documents: a source's documents stand in a fixed order of a hash. Whole passes take each document once; the rest
of the target takes the documents from the front that fit, leaving out up to ``RUNS`` that are too large for what is
still missing, and then the one document whose size fits that best. Running sums come from two levels, bucket totals and sums within a bucket, so that a source with a third of all
rows is no task of its own.

When: a source's weight over the time t in [0, 1] is piecewise linear (``schedule``: its values at evenly spaced knots;
sources take the rows of the schedule in turn). The integral of its weight, scaled to its target, is its cumulative
demand. A document is due at the time at which its source's demand reaches its offset, in closed form. The sum of all
sources' demands is a piecewise parabola too, kept at its knots: its value at that time, over all demanded words, is the
document's training position. So any interval of positions holds its share of all words, mixed as the weights say for its
time. Documents are range-sorted by their first position.

Only sizes and hashes are shuffled: the texts are scanned once, and three numbers of each document are written.

Defined results: null texts and texts of white space have size 0 and are never taken; a null source is a source of its
own, last in the order; ties and repeated rows are ordered by id and text hash, equal rows are interchangeable; a source
of size 0 has target 0; an empty table gives an empty table; only the named and the carried columns are read, whatever
others there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Saved, spark_words, table

WEIGHTS, MAX_PASSES, BUCKET_ROWS = (5.0, 2.0, 1.0), 3, 2_000
#: A source's weight at evenly spaced knots of time, by its place in the order of sources, repeating.
SCHEDULE = ((1.0, 0.75, 0.5), (1.0, 1.0, 1.0), (0.5, 0.75, 1.0))
#: Runs of documents that fill a source's rest.
RUNS = 3
#: Rows up to which a table is sent to all tasks.
SEND = 1_000_000


def _sent(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SEND else df


def knots(schedule) -> list[tuple[list[float], list[float]]]:
    """(density, cumulative share) at the knots of each row of the schedule, for a whole of 1."""
    out = []
    for row in schedule:
        if len(row) < 2 or min(row) < 0 or max(row) <= 0 or len(row) != len(schedule[0]):
            raise ValueError("a schedule has the same two or more weights, none negative and not all zero, in each row")
        h = 1 / (len(row) - 1)
        area = [0.0]
        for a, b in zip(row, row[1:]):
            area.append(area[-1] + (a + b) * h / 2)
        out.append(([x / area[-1] for x in row], [x / area[-1] for x in area]))
    return out


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES, schedules: int = len(SCHEDULE)) -> DataFrame:
    """(source, n, source_size) to the same with weight, target and plan, the number of its row of the schedule. Three
    numbers for each source, whose order is one: the windows over all of them are a sort of that small table."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    ranked = sizes.withColumn("_i", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("_i") % len(weights) + 1).cast("int")))
    # in the order of cap / weight: those before the first that the level doesn't fill are full
    order = Window.orderBy(F.col("_cap") / F.col("weight"), "_i")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    f = ranked.withColumn("_cap", F.lit(float(max_passes)) * F.col("source_size")).withColumn("_total", F.sum("source_size").over(everything).cast("double"))
    f = f.withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    f = f.withColumn("_level", F.min(F.when(F.col("_cap") >= F.col("_level") * F.col("weight"), F.struct(F.col("_cap") / F.col("weight"), F.col("_i"), F.col("_level")))).over(everything)["_level"])
    target = F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("weight"), F.col("_cap")))
    return f.withColumn("target", target).select("source", "n", "source_size", "weight", (F.col("_i") % schedules).cast("int").alias("plan"), "target")


def _array(rows: list[list[float]], plan: Column) -> Column:
    return F.element_at(F.array(*(F.array(*map(F.lit, r)) for r in rows)), plan + 1)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, max_passes: int = MAX_PASSES, schedule=SCHEDULE, bucket_rows: int = BUCKET_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each document: id, source, size, source_size, target, passes, taken, positions (one for each pass),
    text_hash and the carried columns."""
    spark, saved = docs.sparkSession, Saved(docs.sparkSession)
    q = lambda c: F.col(f"`{c}`")
    sized = saved(docs.select(q(id_col).alias("doc_id"), q(source_col).alias("source"), spark_words(text_col).alias("size"), F.xxhash64(F.lit(42), q(id_col), q(text_col)).alias("_h"), *[q(c).alias(f"_c_{c}") for c in carry]))
    curve = knots(schedule)
    m = len(schedule[0]) - 1
    sources = saved(source_targets(sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")), weights, max_passes, len(schedule)), 1)
    # the demand of all sources at the knots of time: density and sum, a row of two short arrays
    at = lambda part, j: F.element_at(_array([c[part] for c in curve], F.col("plan")), j + 1)
    summed = sources.agg(*[F.sum(F.col("target") * at(p, j)).alias(f"{'dc'[p]}{j}") for p in (0, 1) for j in range(m + 1)]).first()
    total = summed[f"c{m}"] or 1.0
    density, sums = [(summed[f"d{j}"] or 0.0) / total for j in range(m + 1)], [(summed[f"c{j}"] or 0.0) / total for j in range(m + 1)]

    u = F.col("_h").cast("double") / F.lit(2.0**64) + 0.5
    rows = sized.join(_sent(sources), sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    rows = rows.withColumn("_b", F.floor(u * F.ceil(F.col("n") / F.lit(bucket_rows))).cast("long"))
    # running sums: of the buckets before, then within the bucket
    ahead = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = saved(rows.groupBy("source", "_b").agg(F.sum("size").alias("_s")).withColumn("_ahead", F.coalesce(F.sum("_s").over(ahead), F.lit(0))).select(F.col("source").alias("_bs"), F.col("_b").alias("_bb"), "_ahead"))
    inner = Window.partitionBy("source", "_b").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    rows = rows.join(_sent(buckets), rows["source"].eqNullSafe(buckets["_bs"]) & (rows["_b"] == buckets["_bb"])).withColumn("_at", F.col("_ahead") + F.col("_in"))
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(max_passes), F.floor(F.col("target") / F.col("source_size")))).otherwise(0)
    rows = rows.withColumn("_whole", whole.cast("long")).withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
    rows = saved(rows.drop("_b", "_in", "_ahead", "_bs", "_bb", "n", "weight"))
    # runs of documents that fit the rest: (first offset, words taken before). A document too large for what is still
    # missing is left out, and the next run begins behind it
    usable = rows.where((F.col("_whole") < max_passes) & (F.col("size") > 0))
    fill = saved(sources.select(F.col("source").alias("_fs"), F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("filled"))).alias("_runs")))
    fits = "_at >= {r}.start and {r}.filled + _at - {r}.start + size <= _rest"
    for _ in range(RUNS):
        run = usable.join(_sent(fill), F.col("source").eqNullSafe(F.col("_fs"))).withColumn("_r", F.expr("element_at(_runs, -1)")).withColumn("_fit", F.expr(fits.format(r="_r"))).where("_at >= _r.start")
        run = run.groupBy("source").agg(F.first("_runs").alias("_runs"), F.coalesce(F.max(F.expr("if(_fit, _r.filled + _at - _r.start + size, null)")), F.max("_r.filled")).alias("filled"), F.min(F.expr("if(_fit, null, struct(_at, size))")).alias("big"))
        longer = run.where("big is not null").select(F.col("source").alias("_ns"), F.expr("array(struct(big._at + big.size as start, filled))").alias("_new"))
        fill = saved(fill.join(longer, F.col("_fs").eqNullSafe(F.col("_ns")), "left").select("_fs", F.expr("if(_new is null, _runs, concat(_runs, _new))").alias("_runs")))
    rows = rows.join(_sent(fill), F.col("source").eqNullSafe(F.col("_fs"))).withColumn("_in_rest", (F.col("_whole") < max_passes) & F.expr(f"exists(_runs, r -> {fits.format(r='r')})")).drop("_fs")
    rows = saved(rows)
    # then the one document that fits best what is still missing; none if it is nearer without one
    filled = saved(rows.groupBy("source").agg(F.coalesce(F.sum(F.when(F.col("_in_rest"), F.col("size"))), F.lit(0)).alias("_filled")).withColumnRenamed("source", "_fs"))
    open_rows = rows.where((F.col("_whole") < max_passes) & ~F.col("_in_rest") & (F.col("size") > 0)).join(_sent(filled), F.col("source").eqNullSafe(F.col("_fs")))
    miss = F.abs(F.col("_rest") - F.col("_filled") - F.col("size"))
    last = open_rows.where(miss < F.col("_rest") - F.col("_filled")).groupBy("source").agg(F.min(F.struct(miss.alias("miss"), "_h", "_at")).alias("_best"))
    last = saved(last.select(F.col("source").alias("_ls"), F.col("_best._at").alias("_last")))
    rows = rows.join(_sent(last), F.col("source").eqNullSafe(F.col("_ls")), "left")
    part = F.col("_in_rest") | F.coalesce(F.col("_at") == F.col("_last"), F.lit(False))
    rows = rows.withColumn("passes", F.when(F.col("size") > 0, F.col("_whole") + part.cast("long")).otherwise(0).cast("int"))

    # demand share of each pass -> time -> position. In a knot's interval: share = c + d u + s u^2 / 2 with slope s
    rows = rows.withColumns({"_d": _array([c[0] for c in curve], F.col("plan")), "_c": _array([c[1] for c in curve], F.col("plan")), "_td": F.array(*map(F.lit, density)), "_tc": F.array(*map(F.lit, sums))})
    share = f"transform(filter(sequence(1, {max_passes}), p -> p <= passes), p -> least(1D, (_at + (p - 1) * source_size) / target))"
    j = f"greatest(1, least({m}, size(filter(_c, x -> x <= y))))"
    # (y, j) -> (u, j) -> position; the root in the form that needs no division by the slope
    step = f"transform({share}, y -> struct(y as y, {j} as j))"
    left = "(x.y - _c[x.j - 1])"
    root = f"sqrt(greatest(0D, _d[x.j - 1] * _d[x.j - 1] + 2D * {left} * (_d[x.j] - _d[x.j - 1]) * {m}D))"
    u_of = f"if({left} <= 0D, 0D, least({1 / m!r}D, 2D * {left} / (_d[x.j - 1] + {root})))"
    time = f"transform({step}, x -> struct({u_of} as u, x.j as j))"
    position = f"transform({time}, x -> least(1D, _tc[x.j - 1] + _td[x.j - 1] * x.u + (_td[x.j] - _td[x.j - 1]) * {m}D * x.u * x.u / 2D))"
    out = rows.withColumn("positions", F.expr(position)).withColumn("taken", F.col("passes") * F.col("size"))
    return out.select("doc_id", "source", "size", "source_size", "target", "passes", "taken", "positions", F.col("_h").alias("text_hash"), *[F.col(f"_c_{c}").alias(c) for c in carry])


def by_position(mixed: DataFrame) -> DataFrame:
    """Range-sorted by first training position; documents that aren't taken come last."""
    first = F.expr("if(passes > 0, positions[0], 2D)")
    out = mixed.withColumn("position", first)
    n = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(n, "position", "doc_id").sortWithinPartitions("position", "doc_id")


def op2_mixing(spark, sf_dir):
    mixed = mix(table(spark, sf_dir, "documents"))
    return by_position(mixed).select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "source", "passes", "position", "positions")
