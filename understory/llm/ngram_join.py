"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its word shingles (64-bit hashes). Equal sets are one node. All tokens have one global order,
rare first, by a count sketch over all documents (fixed size, summed over the tasks); the same sketch splits them into
*rare* and *frequent* ones. Two sets with Jaccard >= t share at least o = ceil(t / (1 + t) * (|a| + |b|)) tokens, so their
first common token lies among the first |a| - o + 1 tokens of a and the first |b| - o + 1 of b.

* If it is rare, the index of single rare tokens of these prefixes brings a and b together.
* If it is frequent, so are all common tokens after it, and all rare tokens of a set stand before it: sets with too many
  rare tokens of their own are out. Prefixes extended to |a| - o + k tokens hold k common tokens, all
  frequent. They are dealt by hash into k - 1 classes, so two of them meet in one class: the index of pairs of frequent
  tokens of a class brings a and b together. k follows from the size's power of two; a set near such a power is indexed
  for both. A prefix of L tokens so has about L * L / 2k pairs, a few for each token, and not L * L / 2.

Frequent tokens are never indexed alone, and sets whose prefixes hold no frequent token have no pairs at all.

Two rounds keep groups of thousands of near copies from being compared all with all. The first links each node to one
centre for each of its keys (the node with the commonest tokens: most likely the original; the same one for all keys
that it has) and merges what verifies.
The second drops the keys whose nodes are all in one component by now, and tries for every other key the nodes outside
the centre's component against all of its nodes, under the exact length and position conditions. What is left out is
either too far apart for a link or already connected, so the components are exact.

Single tokens, by far the most rows, travel once, packed: a task's tokens of one bucket are one compressed block. A
bucket holds about ``BUCKET`` tokens and, as frequent tokens aren't in it, no token of more than the border's count.

Verification compares whole sets: pairs are dealt into blocks of about ``BLOCK`` shingles by centre, a large star into
several, and each block gets the texts of its nodes once. Components come from alternating large-star and small-star
steps.

Defined results: without words or text a set is empty and the component is the document itself; fewer words than a
shingle make one shingle; a null id gets the component of its equal texts (null if there are none) but never names
one; repeated rows and ties are one node; an empty table gives an empty table; only ``id_col`` and ``text_col`` are
read. Nodes are told apart by 64 bits of a hash of the set. The similarity is 60 per cent at least.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Saved, give_back, map_texts, table

#: Sketch cells (4 bytes each, whatever the input), its pieces, rows up to which a table is sent to all tasks.
CELLS, PIECES, SEND = 1 << 22, 64, 250_000
#: A token is frequent if its sketch cell counts over this, and over so many times the mean of all cells.
FREQUENT, ABOVE_MEAN = 64, 4
#: Tokens of a bucket, buckets at most, bytes that a task collects before it packs, shingles of a verification block.
BUCKET, MOST_BUCKETS, PACK, BLOCK = 250_000, 1 << 16, 16 << 20, 200_000
#: Word hashes and node hashes kept by a Python worker, tokens counted at a time.
KNOWN, SEEN, COUNTED = 100_000, 100_000, 1_000_000
#: Bits for a set's size, and for a position in it.
BITS = 27
_MUL = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_S29, _S32 = np.uint64(29), np.uint64(32)


class Shingles:
    """The sorted distinct shingle hashes of a text; words are hashed once."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        ws = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
        known = self.known
        if len(known) > KNOWN:
            known.clear()
        try:
            a = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
        except KeyError:
            for w in ws:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            a = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
        if not len(a):
            return a
        n = max(1, len(a) - self.words + 1)
        x = np.full(n, min(len(a), self.words), np.uint64)
        for j in range(min(self.words, len(a))):
            x = (x ^ (x >> _S29)) * _MUL[0] + a[j : n + j]
        x = (x ^ (x >> _S32)) * _MUL[1]
        x ^= x >> _S29
        x.sort()
        return x[np.concatenate([[True], x[1:] != x[:-1]])]


def node(s: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63)


def components(edges: DataFrame, saved: Saved) -> DataFrame:
    """(k, root) of the nodes of edges (a, b); the root is the smallest node. Each step is written: no lineage grows."""
    e = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        new = saved(small)
        saved.drop(e)
        e = new
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            return e.select(F.col("u").alias("k"), F.col("v").alias("root"))
        seen = now


def size_class(n: int) -> int:
    return n.bit_length() - 1


def extension(c: int, percent: int) -> int:
    """k of size class c: that many common tokens are sure to lie in the prefixes extended by k - 1."""
    return max(2, (100 - percent) * (1 << c) // 100)


def combinations(order: np.ndarray, frequent: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """(key, place) of the pairs of frequent tokens. order: the set rare first; frequent: which of it are.

    The place is at most n - o for a pair that links and has no rare token in common (the single tokens find the others):
    its first common token stands behind all rare ones, and the second of the key at most k - 1 places further."""
    n, out, rare = len(order), [], int(len(order) - frequent.sum())
    least = -(-percent * n // 100)
    for c in {size_class(n), size_class(max(1, least))}:
        k = extension(c, percent)
        length = min(n, n - least + k)
        at = np.flatnonzero(frequent[:length])
        if len(at) < 2:
            continue
        t = order[at]
        group = ((t * _MUL[1]) >> _S32).astype(np.int64) % (k - 1)
        turn = np.argsort(group, kind="stable")
        at, t, group = at[turn], t[turn], group[turn]
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(at)]):
            if hi - lo > 1:
                i, j = np.triu_indices(hi - lo, 1)
                x, y = t[lo + i], t[lo + j]
                x, y = np.minimum(x, y), np.maximum(x, y)
                key = (((x ^ (x >> _S29)) * _MUL[0] + y) ^ np.uint64(c)) * _MUL[1]
                key ^= key >> _S32
                out += zip(key.view(np.int64).tolist(), np.maximum(rare, at[lo + j] - (k - 1)).tolist())
    return out


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low bytes of whole numbers, byte by byte: equal high bytes stand side by side and compress."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unplane(raw: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


#: Columns of a packed block and their bytes: token (what the bucket leaves of it; sorted, as differences), node, size, position, commonness.
_WIDTHS = (5, 8, 4, 4, 2)


def pack(t: np.ndarray, k: np.ndarray, n: np.ndarray, pos: np.ndarray, common: np.ndarray) -> bytes:
    turn = np.argsort(t, kind="stable")
    t = t[turn]
    cols = (np.diff(t, prepend=np.uint64(0)), *(x[turn].astype(np.int64).view(np.uint64) for x in (k, n, pos, common)))
    raw = b"".join(_planes(x, w) for x, w in zip(cols, _WIDTHS))
    return len(t).to_bytes(4, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(block: bytes) -> tuple[np.ndarray, ...]:
    n = int.from_bytes(block[:4], "little")
    raw = memoryview(pa.decompress(block[4:], n * sum(_WIDTHS), "zstd", asbytes=True))
    cols, at = [], 0
    for w in _WIDTHS:
        cols.append(_unplane(raw[at : at + n * w], n, w))
        at += n * w
    return (np.cumsum(cols[0]), *(x.view(np.int64) for x in cols[1:]))


def _sketch(spark, both: DataFrame) -> np.ndarray:
    """The sum of the tasks' sketches, in two steps of 256 tasks: none gets a piece of every task."""

    def total(t: pa.Table) -> pa.Table:
        out = np.zeros(CELLS // PIECES, np.uint64)
        for x in t["counts"].to_pylist():
            out += np.frombuffer(pa.decompress(x, CELLS // PIECES * 4, "zstd", asbytes=True), "<u4")
        out = np.minimum(out, 0xFFFFFFFF).astype("<u4").tobytes()
        return pa.table([t["piece"][:1], t["salt"][:1], pa.array([pa.compress(out, "zstd", asbytes=True)], pa.binary())], ["piece", "salt", "counts"])

    kind = "piece int, salt int, counts binary"
    parts = both.where("piece is not null").select("piece", F.col("n").cast("int").alias("salt"), "counts")
    half = parts.groupBy("piece", "salt").applyInArrow(total, kind)
    pieces = half.withColumn("salt", F.lit(0)).groupBy("piece", "salt").applyInArrow(total, kind).select("piece", "counts").collect()
    if not pieces:
        return np.zeros(CELLS, "<u4")
    return np.concatenate([np.frombuffer(pa.decompress(p.counts, CELLS // PIECES * 4, "zstd", asbytes=True), "<u4") for p in sorted(pieces)])


def jaccard_components(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, group_id, text_hash) of each document; documents link at 100 * intersection >=
    percent * union. group_id is the same for the documents of a component, with or without ids; null for empty sets."""
    if not 60 <= percent <= 100:
        raise ValueError("the similarity is from 60 to 100 per cent")
    spark = docs.sparkSession
    saved = Saved(spark)
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def first(batches):
        sh, counts, number = Shingles(words), np.zeros(CELLS, np.uint32), _task() // 256
        held, room = [], 0

        def count():
            if held:
                np.add(counts, np.bincount(np.concatenate(held), minlength=CELLS), out=counts, casting="unsafe")
                held.clear()

        for b in batches:
            sets = [sh(t) for t in b.column(1).to_pylist()]
            n, k = [len(s) for s in sets], [node(s) if len(s) else None for s in sets]
            held += [(s >> _S32).astype(np.int32) & (CELLS - 1) for s in sets]
            if (room := room + sum(n)) > COUNTED:
                count()
                room = 0
            del sets
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(k, pa.int64()), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names)
        count()
        parts = [pa.compress(x.astype("<u4").tobytes(), "zstd", asbytes=True) for x in counts.reshape(PIECES, -1)]
        none = pa.nulls(PIECES, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.array([number] * PIECES, pa.int64()), none, pa.array(range(PIECES), pa.int32()), pa.array(parts, pa.binary())], names)

    names = ["doc_id", "h", "n", "k", "piece", "counts"]
    both = saved(map_texts(docs.withColumn("h", F.xxhash64("text")), first, "doc_id bigint, h bigint, n bigint, k bigint, piece int, counts binary"))
    nodes_of = both.where("piece is null").select("doc_id", "h", "n", "k")
    sketch = _sketch(spark, both)
    border = max(FREQUENT, ABOVE_MEAN * int(sketch.sum(dtype=np.int64)) // CELLS)
    all_tokens = nodes_of.agg(F.sum(F.expr(f"n - (n * {percent} + 99) div 100 + 1"))).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), int(all_tokens) // BUCKET))
    sent = spark.sparkContext.broadcast(sketch)  # 16 MB, whatever the input
    index = saved(map_texts(docs.where(F.col("text").isNotNull()).select("text"), _indexer(words, percent, buckets, border, sent), "bucket int, block binary, t bigint, k bigint, place bigint"))

    # single tokens: buckets give, for each token of several nodes, its nodes and their centre
    blocks = index.where("bucket is not null").select("bucket", "block").repartition("bucket").sortWithinPartitions("bucket")
    row = ["t", "k", "place", "ck", "cplace"]
    single = saved(blocks.mapInArrow(_merge_buckets, ", ".join(f"{c} bigint" for c in row)))
    # pairs of tokens: the same by SQL, as one pair may be in a great share of all nodes
    combos = index.where("bucket is null").select("t", "k", "place")
    centres = combos.groupBy("t").agg(F.max(F.struct(F.expr(f"shiftright(place, {BITS})").alias("high"), "k", "place")).alias("c"), F.min("k").alias("_least"), F.max("k").alias("_most")).where("_least <> _most").select(F.col("t").alias("_t"), F.col("c.k").alias("ck"), F.col("c.place").alias("cplace"))
    centres = saved(centres)
    several = combos.join(sendable(centres), F.col("t") == F.col("_t")).select(*row)
    shared = single.withColumn("pair", F.lit(False)).unionByName(saved(several).withColumn("pair", F.lit(True)))
    shared = shared.select("t", "pair", "k", "ck", *_unpack("place", ""), *_unpack("cplace", "c"))
    saved.drop(index, centres)

    # round 1: each node against the centres of its keys
    o = f"((({percent} * (n + cn)) + {99 + percent}) div {100 + percent})"
    near = f"k <> ck and 100 * least(n, cn) >= {percent} * greatest(n, cn) and pos <= n - {o} and cpos <= cn - {o}"
    tried = saved(shared.where(near).groupBy(F.col("k").alias("a"), F.col("ck").alias("b")).agg(F.max("n").alias("n"), F.max("cn").alias("m"), F.max("pair").alias("pair")))
    links = saved(_verify(docs, nodes_of, tried, words, percent, saved))
    roots = components(links, saved)

    # round 2: keys that hold nodes of several components
    both_roots = sendable(roots.withColumnRenamed("k", "_k"))
    kr = shared.join(both_roots, F.col("k") == F.col("_k"), "left").select("t", "pair", "k", "n", "common", "pos", F.coalesce("root", "k").alias("root"))
    hubs = saved(kr.groupBy("t", "pair").agg(F.max_by("root", F.struct("common", "n", "k")).alias("hub"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select(F.col("t").alias("_t"), F.col("pair").alias("_pair"), "hub"))
    left = saved(kr.join(sendable(hubs), (F.col("t") == F.col("_t")) & (F.col("pair") == F.col("_pair"))).select("t", "pair", "k", "n", "pos", "root", "hub"))
    outside = left.where("root <> hub").select("t", "pair", *[F.col(c).alias(f"o_{c}") for c in ("k", "n", "root", "pos")])
    o = f"((({percent} * (n + o_n)) + {99 + percent}) div {100 + percent})"
    rule = f"k <> o_k and root <> o_root and 100 * least(n, o_n) >= {percent} * greatest(n, o_n) and pos <= n - {o} and o_pos <= o_n - {o}"
    rest = outside.join(left, ["t", "pair"]).where(rule).groupBy(F.col("o_k").alias("a"), F.col("k").alias("b")).agg(F.max("o_n").alias("n"), F.max("n").alias("m"), F.max("pair").alias("pair"))
    done = tried.select("a", "b").unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = saved(rest.join(done, ["a", "b"], "left_anti"))
    more = saved(_verify(docs, nodes_of, rest, words, percent, saved))
    saved.drop(hubs, left, tried, rest, single)
    if more.limit(1).count():
        roots = components(links.unionByName(more), saved)

    # components by their smallest id. A node of one document without links keeps its own id: only the others are joined
    nodes = nodes_of.where("k is not null").groupBy("k").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("copies"))
    linked = saved(roots.unionByName(roots.select(F.col("root").alias("k"), "root").distinct()).withColumnRenamed("k", "_k"))
    nodes = nodes.join(sendable(linked), F.col("k") == F.col("_k"), "left").where("_k is not null or copies > 1").select("k", "least_id", F.coalesce("root", "k").alias("root"))
    nodes = saved(nodes)
    least = nodes.groupBy("root").agg(F.min("least_id").alias("component_id")).withColumnRenamed("root", "_root")
    named = saved(nodes.join(least, F.col("root") == F.col("_root")).select(F.col("k").alias("_k"), "component_id", "root"))
    out = nodes_of.join(sendable(named), F.col("k") == F.col("_k"), "left")
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("root", "k").alias("group_id"), F.col("h").alias("text_hash"))


def sendable(df: DataFrame) -> DataFrame:
    """A written table, to all tasks if it is counted small."""
    return F.broadcast(df) if df.count() <= SEND else df


def _task() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _indexer(words: int, percent: int, buckets: int, border: int, sent):
    """Texts to packed single tokens by bucket, and rows of token pairs. A node that a task has seen isn't indexed again."""

    def second(batches):
        sh, counts, seen = Shingles(words), sent.value, set()
        parts: list[list] = [[], [], [], [], []]
        room = 0

        def flush():
            nonlocal room
            t, k, n, pos, common = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in parts)
            for x in parts:
                x.clear()
            room = 0
            if not len(t):
                return
            t = t.view(np.uint64)
            b = (t % np.uint64(buckets)).astype(np.int64)
            # 40 bits are left of a token: two tokens that share them only make a candidate more
            t = (t // np.uint64(buckets)) & np.uint64((1 << 40) - 1)
            turn = np.argsort(b, kind="stable")
            names, starts = np.unique(b[turn], return_index=True)
            packed = [pack(*(x[turn[lo:hi]] for x in (t, k, n, pos, common))) for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(turn)])]
            for at in range(0, len(names), 256):
                own = packed[at : at + 256]
                none = pa.nulls(len(own), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(names[at : at + 256], pa.int32()), pa.array(own, pa.binary()), none, none, none], ["bucket", "block", "t", "k", "place"])

        for b in batches:
            pairs: list[tuple[int, int, int]] = []
            for text in b.column(0).to_pylist():
                s = sh(text)
                n = len(s)
                if not n or (k := node(s)) in seen:
                    continue
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(k)
                c = counts[(s >> _S32).astype(np.int64) & (CELLS - 1)]
                turn = np.lexsort((s, c))
                s, c = s[turn], c[turn]
                prefix = n - -(-percent * n // 100) + 1
                common = int(16 * np.log2(1.0 + c).mean())
                often = c > border
                rare = int(prefix - often[:prefix].sum())  # rare ones come first
                if rare:
                    for x, y in zip(parts, (s[:rare].view(np.int64), np.full(rare, k), np.full(rare, n), np.arange(rare), np.full(rare, common))):
                        x.append(y)
                    room += 40 * rare
                if rare < prefix:
                    base = min(common, 511) << 2 * BITS | n << BITS
                    pairs += [(key, k, base | pos) for key, pos in combinations(s, often, percent)]
            if pairs:
                none = [None] * len(pairs)
                yield pa.RecordBatch.from_arrays([pa.array(none, pa.int32()), pa.array(none, pa.binary()), *(pa.array([x[j] for x in pairs], pa.int64()) for j in range(3))], ["bucket", "block", "t", "k", "place"])
            if room > PACK:
                yield from flush()
        yield from flush()

    return second


def _merge_buckets(batches):
    """Sorted by bucket: (t, k, place, ck, cplace) of each token that several nodes have."""

    def merged(bucket, blocks):
        t, k, n, pos, common = (np.concatenate(x) for x in zip(*map(unpack, blocks)))
        turn = np.lexsort((k, t))
        t, k = t[turn], k[turn]
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])])  # a node that several tasks met is one
        turn, t, k = turn[new], t[new], k[new]
        starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(t)]]))
        keep = np.repeat(sizes > 1, sizes)
        if not keep.any():
            return
        turn, t, k, sizes = turn[keep], t[keep], k[keep], sizes[sizes > 1]
        place = np.minimum(common[turn], 511) << 2 * BITS | n[turn] << BITS | pos[turn]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        group = np.repeat(np.arange(len(sizes)), sizes)
        last = np.lexsort((k, place >> BITS, group))[starts + sizes - 1]  # the centre: the commonest, largest, then last node
        # tokens of different buckets get different names: what the bucket took away comes back in the high bits
        name = (t.astype(np.uint64) | np.uint64(bucket) << np.uint64(40)).view(np.int64)
        cols = (name, k, place, k[last][group], place[last][group])
        for at in range(0, len(t), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000], pa.int64()) for x in cols], ["t", "k", "place", "ck", "cplace"])

    now, held = None, []
    for b in batches:
        for bucket, block in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if bucket != now and held:
                yield from merged(now, held)
                held = []
            now = bucket
            held.append(block)
    if held:
        yield from merged(now, held)
    give_back()


def _unpack(place: str, prefix: str) -> list:
    """common, n and pos of a packed place."""
    low = (1 << BITS) - 1
    return [F.expr(f"shiftright({place}, {2 * BITS})").alias(f"{prefix}common"), F.expr(f"shiftright({place}, {BITS}) & {low}L").alias(f"{prefix}n"), F.expr(f"{place} & {low}L").alias(f"{prefix}pos")]


def _verify(docs: DataFrame, nodes_of: DataFrame, pairs: DataFrame, words: int, percent: int, saved: Saved) -> DataFrame:
    """The pairs (a, b, pair) of nodes whose whole sets reach the similarity. pairs: also n and m, the sizes of a and b.

    Blocks follow b, most often a centre; the pairs of a b with many are dealt into several."""
    stars = saved(pairs.groupBy(F.col("b").alias("_b")).agg(F.sum("n").alias("_load")))
    load = stars.agg(F.sum("_load")).first()[0] or 0
    if not load:
        return pairs.select("a", "b", "pair").limit(0)
    n_blocks = 1 + load // BLOCK
    salt = F.pmod(F.xxhash64("a"), F.expr(f"1 + _load div {BLOCK}"))
    dealt = pairs.join(sendable(stars), F.col("b") == F.col("_b")).select("a", "b", "pair", F.pmod(F.xxhash64("b", salt), F.lit(n_blocks)).alias("block"))
    dealt = saved(dealt)
    members = saved(dealt.select("block", F.col("a").alias("k")).unionByName(dealt.select("block", F.col("b").alias("k"))).distinct())
    need = members.select("k").distinct()
    ids = nodes_of.where("doc_id is not null").join(sendable(need), "k", "left_semi").groupBy("k").agg(F.min("doc_id").alias("_id"))
    wanted = saved(members.join(ids, "k").select("_id", "k", "block"))
    texts = docs.join(sendable(wanted), F.col("doc_id") == F.col("_id")).select("block", "k", "text")

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        sh, sets = Shingles(words), {}
        for k, t in zip(left["k"].to_pylist(), left["text"].to_pylist()):
            if k not in sets and len(s := sh(t)) and node(s) == k:  # an id that stands for several texts gives only the node's own
                sets[k] = s
        keep = []
        for a, b in zip(right["a"].to_pylist(), right["b"].to_pylist()):
            x, y = sets.get(a), sets.get(b)
            if x is None or y is None:
                keep.append(False)
                continue
            z = np.concatenate([x, y])
            z.sort()
            same = int((z[1:] == z[:-1]).sum())
            keep.append(100 * same >= percent * (len(x) + len(y) - same))
        return right.select(["a", "b", "pair"]).filter(pa.array(keep, pa.bool_()))

    return texts.groupBy("block").cogroup(dealt.groupBy("block")).applyInArrow(check, "a bigint, b bigint, pair boolean")


def op3_ngram_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))


def brute(rows: list[tuple[int, str | None]], words: int = 4, percent: int = 85) -> dict[int, tuple[int, int]]:
    """id to (set size, component) by comparing all pairs: the small reference for tests."""
    sets = {}
    for i, t in rows:
        w = [x for x in (t or "").encode().lower().split()]
        sets[i] = {tuple(w[j : j + words]) for j in range(max(1, len(w) - words + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}
