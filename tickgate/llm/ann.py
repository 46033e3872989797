"""Approximate nearest neighbours with a forest of hash prefixes.

Every tree gives each vector a hash string of ``DEPTH`` symbols. A symbol is the largest coordinate, with
its sign, of the centred vector in a random rotation cut to ``AXES`` axes, so near vectors agree in long
prefixes. A tree is the sorted array of its strings; the rows below a node are a range of that array.

A query descends every tree to its longest prefix match. Ascending synchronously, all trees go up one
symbol at a time, and at each level trees are visited in turn, until the ranges hold enough entries; the last
level may so be taken in some trees only. Candidates are then measured exactly, in double precision.

Enough is what the data ask for: the true neighbours of ``SAMPLE`` queries are found by measuring all vectors,
and the stopping point is the least at which ``RECALL`` of them are reached, ``CANDIDATES`` entries at least. On
vectors without structure that is a share of the table, so the work of a query grows with the table.

Distribution: the strings of all trees are dealt by (tree, prefix); prefixes are as long as the number of
vectors asks for, and a prefix that holds more than ``PIECE`` strings is split into pieces by a hash of the
id. Counts add up over pieces, so splitting changes no result. A query that must ascend above the dealt prefix
counts by sums over nodes and then asks all nodes below; so every query ends with k candidates, or all. Candidates meet vectors in blocks by a hash
of the id. No row or task holds all candidates of a query: found ids travel in lists of ``CHUNK``, and a piece or
block that many queries ask is handled for ``ASKED`` or ``PART`` of them at a time. Equal vectors are indexed once; of each only the ids that can be among the nearest are kept.

Defined cases: vectors that are null, zero, or hold null or non-finite components, and vectors whose length
is not the most common one, take no part, neither as queries nor as candidates; null ids take no part; rows
that repeat an id and vector are one candidate, an id with several vectors is one candidate per vector; ties go to the smaller
id; with fewer than k other vectors all are returned; other columns are ignored; an empty table gives an
empty result.
"""
from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickgate.llm.common import ready, written

TREES = 160
DEPTH = 4             # symbols of a string
AXES = 16             # a symbol is one of 2 * AXES
BITS = 5              # of a symbol
CANDIDATES = 14_000   # entries, over all trees, that a query takes before it stops ascending, at least
RECALL = 0.95         # share of the sampled queries' true neighbours that the stopping point must reach
SAMPLE = 64           # queries measured against all vectors
PIECE = 32_768        # strings of a tree in one task
BLOCK = 4096          # vectors measured in one task
CHUNK = 4096          # found ids in one row
ASKED = 256           # queries that collect from a piece in one task, about
PART = 4096           # queries measured against a block in one task, about
SEED = 7


def usable(v: Column) -> Column:
    """No null or non-finite component, and not zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce(~F.exists(v, bad) & F.exists(v, lambda x: x != 0), F.lit(False))


@functools.lru_cache(maxsize=4)
def rotations(dim: int, trees: int, seed: int):
    """(trees * DEPTH, dim, axes) cuts of random rotations."""
    import numpy as np
    rng = np.random.default_rng(seed)
    axes = min(AXES, dim)
    return np.stack([np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :axes] for _ in range(trees * DEPTH)]).astype(np.float32)


def strings(x, centre, trees: int, seed: int):
    """(rows, trees) hash strings, first symbol in the highest bits."""
    import numpy as np
    r = rotations(x.shape[1], trees, seed)
    x = (x - centre).astype(np.float32)
    out = np.zeros((len(x), trees), np.int32)
    rows = np.arange(len(x))
    for t in range(trees):
        for d in range(DEPTH):
            z = x @ r[t * DEPTH + d]
            a = np.abs(z).argmax(1)
            out[:, t] = out[:, t] << BITS | (a * 2 + (z[rows, a] > 0)).astype(np.int32)
    return out


def _hashed(vectors: DataFrame, centre: list[float], trees: int, seed: int) -> DataFrame:
    ready(vectors.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                v = part.column(2)
                x = np.asarray(v.flatten(), np.float64).reshape(len(v), -1)
                s = strings(x, np.array(centre), trees, seed)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * trees), pa.array(s.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], names=["id", "asks", "strings"])

    return vectors.select("id", "asks", "v").mapInArrow(run, "id long, asks boolean, strings array<int>")


def _ranges(found, keys, depth: int):
    """Ranges of sorted strings that share their first ``depth`` symbols with each key."""
    import numpy as np
    cut = BITS * (DEPTH - depth)
    short = found >> cut
    return np.searchsorted(short, keys >> cut, "left"), np.searchsorted(short, keys >> cut, "right")


def _dealt(rows: DataFrame, prefix: int, piece: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, queries, sizes): one row per string, with tree, node (its first symbols) and piece; entries per node."""
    flat = rows.select("id", "asks", F.posexplode("strings").alias("tree", "string")).withColumn(
        "node", F.shiftright("string", BITS * (DEPTH - prefix)))
    sizes = written(flat.groupBy("tree", "node").agg(F.count("*").alias("n")))
    # only crowded nodes are listed, a handful next to the rows
    crowded = sizes.where(F.col("n") > piece).select("tree", "node", F.ceil(F.col("n") / piece).cast("int").alias("pieces"))
    flat = flat.join(crowded, ["tree", "node"], "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    entries = flat.withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    queries = flat.where("asks").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    cols = ["tree", "node", "piece", "string", "id"]
    # own column names' identities on either side, so that the two can be grouped together
    return entries.select(cols), queries.select([F.col(c).alias(c) for c in cols]), sizes


def _above(rows: DataFrame, prefix: int) -> DataFrame:
    """One row per row and level d above the prefix, with ``top``: the first d symbols of its node."""
    return rows.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(prefix - 1)))).withColumn(
        "top", F.expr(f"shiftright(node, {BITS} * ({prefix} - d))"))


def _shared_above(hashed: DataFrame, sizes: DataFrame, prefix: int) -> DataFrame:
    """(id, tree, d, n) as ``_shared`` has it, for the levels above the dealt prefix."""
    n = _above(sizes, prefix).groupBy("tree", "d", "top").agg(F.sum("n").alias("n"))
    asked = hashed.where("asks").select("id", F.posexplode("strings").alias("tree", "string"))
    asked = _above(asked.withColumn("node", F.shiftright("string", BITS * (DEPTH - prefix))), prefix)
    return asked.join(n, ["tree", "d", "top"]).select("id", "tree", "d", "n")


def _targets(queries: DataFrame, level: DataFrame, sizes: DataFrame, prefix: int, piece: int) -> DataFrame:
    """The pieces that each query asks: those of its own node or, above the dealt prefix, of all nodes below its level."""
    asked = queries.join(level, ["id", "tree"])
    cols = ["tree", "node", "piece", "string", "id", "level"]
    near = asked.where(F.col("level") >= prefix).select(cols)
    if not prefix:
        return near
    # a query has a row for each piece of its own node; one is enough
    far = asked.where((F.col("level") < prefix) & (F.col("piece") == 0)).select("tree", "node", "string", "id", "level")
    far = far.withColumn("top", F.expr(f"shiftright(node, {BITS} * ({prefix} - level))")).drop("node")
    below = _above(sizes, prefix).withColumn("piece", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / piece).cast("int") - 1)))
    below = below.select("tree", F.col("d").alias("level"), "top", "node", "piece")
    return near.unionByName(far.join(below, ["tree", "level", "top"]).select(cols))


def _counts(key, entries, queries):
    """How many entries of this piece share at least d symbols with each query."""
    import numpy as np
    import pyarrow as pa
    found, asked = np.sort(entries.column("string").to_numpy()), queries.column("string").to_numpy()
    levels = []
    for d in range(DEPTH + 1):
        lo, hi = _ranges(found, asked, d)
        levels.append(hi - lo)
    counts = np.stack(levels, 1).astype(np.int64) if len(asked) else np.zeros((0, DEPTH + 1), np.int64)
    offsets = pa.array(np.arange(len(asked) + 1, dtype=np.int32) * (DEPTH + 1))
    return pa.table({"id": queries.column("id").combine_chunks(), "tree": queries.column("tree").combine_chunks(),
                     "counts": pa.ListArray.from_arrays(offsets, pa.array(counts.ravel()))})


def _collect(key, entries, queries):
    """The ids of the entries that share at least a query's ``level`` symbols, ``CHUNK`` in a row at most."""
    import numpy as np
    import pyarrow as pa
    strings_, ids = entries.column("string").to_numpy(), entries.column("id").to_numpy()
    order = np.argsort(strings_, kind="stable")
    strings_, ids = strings_[order], ids[order]
    asked, level = queries.column("string").to_numpy(), queries.column("level").to_numpy()
    lo, hi = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
    for d in range(DEPTH + 1):
        at = level == d
        if at.any():
            lo[at], hi[at] = _ranges(strings_, asked[at], d)
    cuts = [(i, a, min(a + CHUNK, b)) for i, b in enumerate(hi) for a in range(lo[i], b, CHUNK)]
    parts = [ids[a:b] for _, a, b in cuts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.table({"id": queries.column("id").to_numpy()[[i for i, _, _ in cuts]] if cuts else ids[:0],
                     "found": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else ids[:0]))})


def _slotted(entries: DataFrame, targets: DataFrame, nodes: list[str]) -> tuple[DataFrame, DataFrame]:
    """Adds ``slot``: queries of a piece that more than ``ASKED`` ask are dealt to slots, and its entries go to each."""
    busy = written(targets.groupBy(nodes).agg(F.count("*").alias("n")).where(F.col("n") > ASKED)
                   .select(*nodes, F.ceil(F.col("n") / ASKED).cast("int").alias("slots")))
    many = lambda rows: rows.join(busy, nodes, "left").withColumn("slots", F.coalesce("slots", F.lit(1)))
    dealt = many(targets).withColumn("slot", F.pmod(F.xxhash64("id"), F.col("slots")).cast("int")).drop("slots")
    held = many(entries).withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))).drop("slots")
    return held.select([F.col(c).alias(c) for c in held.columns]), dealt.select([F.col(c).alias(c) for c in dealt.columns])


def levels(counts: DataFrame, prefix: int, most: int) -> DataFrame:
    """(id, tree, level): how far each tree is ascended. ``counts``: id, tree, counts by symbols shared.

    A level is taken in all trees while the entries are fewer than ``most``; on the last one, trees are visited in
    turn until they are not. Ascending ends at the dealt prefix.
    """
    return _ascended(_shared(counts, prefix), most)


def _shared(counts: DataFrame, prefix: int) -> DataFrame:
    """(id, tree, d, n): entries that share at least d symbols, summed over pieces."""
    return counts.select("id", "tree", F.posexplode("counts").alias("d", "n")).where(F.col("d") >= prefix) \
        .groupBy("id", "tree", "d").agg(F.sum("n").alias("n"))


def _held(per: DataFrame) -> DataFrame:
    """Adds ``held``: entries held before a tree is visited on a level."""
    deeper = Window.partitionBy("id", "tree").orderBy(F.desc("d"))
    per = per.withColumn("gain", F.col("n") - F.coalesce(F.lag("n").over(deeper), F.lit(0)))
    visits = Window.partitionBy("id").orderBy(F.desc("d"), "tree").rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("held", F.coalesce(F.sum("gain").over(visits), F.lit(0)))


def _ascended(per: DataFrame, most: int) -> DataFrame:
    taken = _held(per).where(F.col("held") < most)
    return taken.groupBy("id", "tree").agg(F.min("d").cast("int").alias("level"))


def _true_neighbours(reps: DataFrame, asked: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """(query, id): the k nearest of each asked vector, by measuring all."""
    ready(reps.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        names, q = np.array([i for i, _ in asked]), np.array([v for _, v in asked], np.float64)
        best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in asked]
        for batch in batches:
            own, v = batch.column(0).to_numpy(), batch.column(1)
            x = np.asarray(v.flatten(), np.float64).reshape(len(v), -1)
            for i, name in enumerate(names):
                score = measure(x, q[i])
                near = np.argpartition(score, k)[:k + 1] if len(score) > k + 1 else np.arange(len(score))
                near = near[own[near] != name]
                ids, score = np.concatenate([best[i][0], own[near]]), np.concatenate([best[i][1], score[near]])
                order = np.lexsort((ids, score))[:k]
                best[i] = ids[order], score[order]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(names, [len(b[0]) for b in best])), pa.array(np.concatenate([b[0] for b in best])),
            pa.array(np.concatenate([b[1] for b in best]))], names=["query", "id", "score"])

    near = reps.select("id", "v").mapInArrow(run, "query long, id long, score double")
    order = Window.partitionBy("query").orderBy("score", "id")
    return near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("query", "id")


def stopping_point(reps: DataFrame, hashed: DataFrame, per: DataFrame, k: int, recall: float, sample: int) -> int:
    """The least number of entries to stop at with which ``recall`` of the sampled queries' true neighbours are reached.

    A neighbour is reached when some tree is visited on the level of the symbols that the two share, that is, when
    fewer entries than the stopping point are held before that visit.
    """
    asked = [(r.id, list(r.v)) for r in
             reps.where("asks").orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "v").collect()]
    if not asked:
        return 0
    names = [i for i, _ in asked]
    pairs = written(_true_neighbours(reps, asked, k))
    own = hashed.where(F.col("id").isin(names)).select(F.col("id").alias("query"), F.col("strings").alias("a"))
    met = pairs.join(hashed.select("id", F.col("strings").alias("b")), "id").join(own, "query")
    met = met.select("query", "id", F.posexplode(F.arrays_zip("a", "b")).alias("tree", "s"))
    agree = [(F.shiftright("s.a", BITS * (DEPTH - d)) == F.shiftright("s.b", BITS * (DEPTH - d))).cast("int") for d in range(1, DEPTH + 1)]
    met = met.select("query", "id", "tree", functools.reduce(lambda a, b: a + b, agree).alias("d"))
    held = _held(per.where(F.col("id").isin(names))).select(F.col("id").alias("query"), "tree", "d", "held")
    # neighbours that no tree reaches stay out of the list and count as missed
    needs = sorted(r.held for r in met.join(held, ["query", "tree", "d"]).groupBy("query", "id").agg(F.min("held").alias("held")).collect())
    wanted = math.ceil(recall * pairs.count())
    return int(needs[min(wanted, len(needs)) - 1]) + 1 if wanted and needs else 0


def _blocks(found: DataFrame, blocks: int) -> DataFrame:
    """(block, query, ids): each query's distinct candidates by the block that holds their vectors."""
    return found.select(F.col("id").alias("query"), F.explode("found").alias("id")).where("id <> query") \
        .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")) \
        .groupBy("block", "query").agg(F.collect_set("id").alias("ids"))


def measure(x, y):
    """Euclidean distances of rows, in double precision."""
    import numpy as np
    d = x - y
    return np.sqrt((d * d).sum(-1))


def _nearest(k: int):
    def run(key, asked, vectors):
        import numpy as np
        import pyarrow as pa
        if not asked.num_rows or not vectors.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        flat = lambda t, c: np.asarray(t.column(c).combine_chunks().flatten(), np.float64).reshape(t.num_rows, -1)
        own, x, q = vectors.column("id").to_numpy(), flat(vectors, "v"), flat(asked, "v")
        order = np.argsort(own)
        own, x = own[order], x[order]
        out = ([], [], [])
        for i in range(asked.num_rows):
            ids = asked.column("ids")[i].values.to_numpy(zero_copy_only=False)
            score = measure(x[np.searchsorted(own, ids)], q[i])
            best = np.lexsort((ids, score))[:k]
            out[0].append(np.full(len(best), asked.column("query")[i].as_py(), np.int64))
            out[1].append(ids[best])
            out[2].append(score[best])
        return pa.table({"query": np.concatenate(out[0]), "id": np.concatenate(out[1]), "score": np.concatenate(out[2])})
    return run


def search(rows: DataFrame, asks: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           trees: int = TREES, candidates: int = CANDIDATES, seed: int = SEED, piece: int = PIECE,
           recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """The k nearest found of every row for which ``asks`` holds: query_id, rank, vec_id, score."""
    v = rows.select(F.col(id_col).cast("long").alias("id"), F.coalesce(asks, F.lit(False)).alias("asks"),
                    F.col(vec_col).cast("array<double>").alias("v")).where(usable(F.col("v")) & F.col("id").isNotNull())
    v = v.select("id", "asks", "v", F.size("v").alias("dim"))
    sizes = v.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = sizes[0]["dim"] if sizes else 1
    v = v.where(F.col("dim") == dim).drop("dim")

    # equal vectors: the k + 1 smallest ids stand for all; the filter on the rank is applied before the shuffle too
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    ids = v.groupBy("id", "v").agg(F.max("asks").alias("asks"))
    first = written(ids.select("id", "v", rank.alias("r")).where(F.col("r") <= k + 1))
    rep = written(first.where("r = 1").select(F.col("id").alias("rep"), "v"))
    members = first.join(rep, "v").select("rep", "id")
    askers = written(ids.where("asks").select("id", "v").join(rep, "v").select("rep", F.col("id").alias("query_id")))
    reps = written(rep.join(askers.select("rep").distinct().withColumn("asks", F.lit(True)), "rep", "left")
                   .select(F.col("rep").alias("id"), F.coalesce("asks", F.lit(False)).alias("asks"), "v"))

    n = reps.count()
    prefix = 0
    while prefix < DEPTH and n > piece * (2 * min(AXES, dim)) ** prefix:
        prefix += 1
    means = [F.avg(F.get("v", F.lit(i))).alias(f"m{i}") for i in range(dim)]
    centre = [float(m or 0.0) for m in reps.agg(*means).first()]
    hashed = written(_hashed(reps, centre, trees, seed))
    entries, queries, sizes = _dealt(hashed, prefix, piece)
    nodes = ["tree", "node", "piece"]
    counts = entries.groupBy(nodes).cogroup(queries.groupBy(nodes)).applyInArrow(
        _counts, "id long, tree int, counts array<long>")
    per = _shared(counts, prefix)
    per = written(per.unionByName(_shared_above(hashed, sizes, prefix)) if prefix else per)
    # a tree holds an id once, so that many entries are k others at least
    most = max(candidates, trees * (k + 1), stopping_point(reps, hashed, per, k, recall, sample))
    level = written(_ascended(per, most))
    held, targets = _slotted(entries, written(_targets(queries, level, sizes, prefix, piece)), nodes)
    found = held.groupBy(*nodes, "slot").cogroup(targets.groupBy(*nodes, "slot")).applyInArrow(
        _collect, "id long, found array<long>")
    blocks = max(1, -(-n // BLOCK))
    asked = _blocks(found, blocks).join(reps.select(F.col("id").alias("query"), F.col("v").alias("v")), "query")
    parts = max(1, -(-reps.where("asks").count() // PART))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int"))
    asked = asked.select([F.col(c).alias(c) for c in asked.columns])
    held = reps.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    near = asked.groupBy("block", "part").cogroup(held.groupBy("block", "part")).applyInArrow(_nearest(k), "query long, id long, score double")
    order = Window.partitionBy("query").orderBy("score", "id")
    best = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select(
        F.col("query").alias("rep"), F.col("id").alias("near"), "score")
    best = written(best.unionByName(askers.select("rep").distinct().select("rep", F.col("rep").alias("near"), F.lit(0.0).alias("score"))))
    # back from classes to rows; one class has k + 1 members at most
    listed = best.join(members.withColumnRenamed("rep", "near"), "near").select("rep", "id", "score")
    listed = listed.withColumn("r", F.row_number().over(Window.partitionBy("rep").orderBy("score", "id"))).where(F.col("r") <= k + 1)
    pairs = askers.join(listed.drop("r"), "rep").where("id <> query_id")
    final = Window.partitionBy("query_id", "rep").orderBy("score", "id")
    return pairs.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")
