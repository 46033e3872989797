"""Centroid clustering: Lloyd rounds in exact integers over a zone map of Hilbert-ordered blocks.

Vectors become integers (``floor(SCALE * x)``) and are sorted along a Hilbert curve through the ``AXES`` components
that vary most; every ``BLOCK`` consecutive ones are one row of a written table, with the smallest and largest value
of each component (the box). A round reads blocks only. The box gives, for each centroid, the least and the greatest
distance a vector of the block can have; a centroid farther at best than another at worst is no candidate, nor is one
on the far side of the whole box from the likeliest centroid. The block's vectors are compared with the candidates
alone, all at once and exactly. Bounds are integers too, so a block never loses its nearest centroid.

Shuffled are the vectors once (to sort them) and then, per round, one sum per centroid, component and task. The
driver holds the centroids: ``k`` rows of ``dim`` integers, whatever the table's size. Equal vectors are spread over
the sort's partitions by a hash of their id.

Defined cases: a vector takes part if it has exactly ``dim`` components, none null or non-finite, all below 2 ** 19 in
absolute value (beyond, a squared distance may not fit a long); others have no row in the result. Rows that repeat an id
are vectors of their own; a null id counts as empty when starts are drawn; ties among starts go to the smaller vector.
Fewer vectors than ``k`` give that many centroids; an empty table gives an empty result. A centroid without vectors
stays. An inertia too large for a long is null. Other columns are not touched.
"""
from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickgate.llm.blocks import written_blocks
from tickgate.llm.common import ready, written

SCALE = 256
LIMIT = float(1 << 19)
BLOCK = 256
AXES, BITS = 16, 4        # the curve: 16 components, 4 bits each
EXACT = 1 << 22           # below, dot products of 64 components are exact in double precision


def _usable(vec: str, dim: int) -> Column:
    ok = F.forall(vec, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < LIMIT))
    return F.coalesce((F.size(vec) == dim) & ok, F.lit(False))


def _matrix(batch, dim: int):
    """The vectors of a batch as integers."""
    import numpy as np
    flat = batch.column(batch.schema.get_field_index("vec")).flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.astype(np.float64) * SCALE).astype(np.int64).reshape(-1, dim)


def _spread(kept: DataFrame, dim: int) -> list[tuple[float, float]]:
    """Mean and deviation of each component; they shape the curve, never the result."""
    def sums(batches):
        import numpy as np
        import pyarrow as pa
        s, ss, n = np.zeros(dim), np.zeros(dim), 0
        for b in batches:
            q = _matrix(b, dim).astype(np.float64)
            s, ss, n = s + q.sum(0), ss + (q * q).sum(0), n + len(q)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(np.full(dim, n)), pa.array(s), pa.array(ss)],
                                         names=["at", "n", "s", "ss"])
    rows = (kept.mapInArrow(sums, "at bigint, n bigint, s double, ss double").groupBy("at")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect())
    if not rows or not rows[0]["n"]:
        return []
    mean = {r["at"]: (r["s"] / r["n"], r["ss"] / r["n"]) for r in rows}
    return [(m, max(0.0, ss - m * m) ** 0.5) for m, ss in (mean[i] for i in range(dim))]


def hilbert_keys(cells, bits: int):
    """Places along the Hilbert curve, as byte strings that sort like them, of ``cells`` (rows of small integers)."""
    import numpy as np
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    step = 1 << (bits - 1)
    while step > 1:                                   # undo the curve's turns, from the coarsest level
        for i in range(axes):
            turned = (x[:, i] & step) != 0
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & (step - 1))
            x[:, 0] ^= np.where(turned, step - 1, swap)
            x[:, i] ^= swap
        step >>= 1
    for i in range(1, axes):                          # Gray code across the axes
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] >> b & 1, (1 << b) - 1, 0)
    x ^= flip[:, None]
    planes = x[:, None, :] >> np.arange(bits - 1, -1, -1)[None, :, None] & 1
    return np.packbits(planes.reshape(len(x), -1).astype(np.uint8), axis=1)


def _keyed(spread: list[tuple[float, float]], dim: int):
    """Adds each vector's place on a grid of +-3 deviations around the mean of the components that vary most."""
    axes = sorted(range(dim), key=lambda i: (-spread[i][1], i))[:AXES]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        mid, dev = (np.array([spread[i][j] for i in axes]) for j in (0, 1))
        for b in batches:
            q = _matrix(b, dim)
            cell = np.floor(((q[:, axes] - mid) / np.where(dev > 0, 6 * dev, 1) + 0.5) * (1 << BITS))
            keys = hilbert_keys(np.clip(cell, 0, (1 << BITS) - 1), BITS)
            offsets = pa.array(np.arange(len(q) + 1, dtype=np.int32) * dim)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([k.tobytes() for k in keys], pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(q.ravel().astype(np.int32)))], names=["id", "key", "vec"])
    return run


def _blocked(dim: int, id_type):
    """Every ``BLOCK`` consecutive rows of a partition as one row: ids, box, vectors."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def block(rows):
            q = rows.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)
            return [rows.column("id").to_pylist(), q.min(0), q.max(0), q.astype("<i4").tobytes()]

        def out(blocks):
            ids, lo, hi, vecs = zip(*blocks)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.list_(id_type)), pa.array(lo, pa.list_(pa.int32())),
                 pa.array(hi, pa.list_(pa.int32())), pa.array(vecs, pa.binary())], names=["ids", "lo", "hi", "vecs"])
        held = None
        for b in batches:
            rows = pa.Table.from_batches([b.select(["id", "vec"])])
            held = rows if held is None else pa.concat_tables([held, rows])
            whole = len(held) // BLOCK * BLOCK
            if whole:
                yield out([block(held.slice(i, BLOCK)) for i in range(0, whole, BLOCK)])
                held = held.slice(whole).combine_chunks()
        if held is not None and len(held):
            yield out([block(held)])
    return run


def zone_map(vectors: DataFrame, dim: int) -> DataFrame:
    """The written table of blocks (ids, lo, hi, vecs) of ``vectors`` (id, vec), in Hilbert order; None if empty."""
    from pyspark.sql.pandas.types import to_arrow_type
    spread = _spread(vectors, dim)
    if not spread:
        return None
    kind = vectors.schema["id"].dataType
    name = kind.simpleString()
    keyed = vectors.mapInArrow(_keyed(spread, dim), f"id {name}, key binary, vec array<int>")
    mix = F.xxhash64("id")
    blocks = keyed.repartitionByRange("key", mix).sortWithinPartitions("key", mix).mapInArrow(
        _blocked(dim, to_arrow_type(kind)), f"ids array<{name}>, lo array<int>, hi array<int>, vecs binary")
    return written_blocks(blocks)


def candidates(lo, hi, centres):
    """Numbers, ascending, of the centroids that can be nearest to some vector in the box."""
    import numpy as np
    below, above = lo - centres, centres - hi
    near = (np.maximum(np.maximum(below, above), 0) ** 2).sum(1)
    far = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(1)
    best = int(far.argmin())
    maybe = np.flatnonzero(near <= far[best])
    # min over the box of (distance to c) - (distance to best): positive if c loses everywhere
    step = centres[maybe] - centres[best]
    norms = (centres * centres).sum(1)
    loses = norms[maybe] - norms[best] - 2 * np.maximum(lo * step, hi * step).sum(1) > 0
    return maybe[~loses]


def _nearest(q, box, centres):
    """(number, squared distance) of each vector's nearest centroid, ties to the smaller number."""
    import numpy as np
    at = candidates(*box, centres)
    c = centres[at]
    if max(np.abs(q).max(), np.abs(c).max()) < EXACT:
        f, g = q.astype(np.float64), c.astype(np.float64)
        d = ((f * f).sum(1)[:, None] - 2 * f @ g.T + (g * g).sum(1)).astype(np.int64)
    else:
        d = np.stack([((q - one) ** 2).sum(1) for one in c], 1)
    first = d.argmin(1)
    return at[first], d[np.arange(len(q)), first]


def _blocks_of(batch, dim: int):
    import numpy as np
    lo, hi = (batch.column(n).flatten().to_numpy().reshape(-1, dim).astype(np.int64) for n in ("lo", "hi"))
    vecs = batch.column("vecs")
    for i in range(len(vecs)):
        yield i, np.frombuffer(vecs[i].as_buffer(), "<i4").reshape(-1, dim).astype(np.int64), (lo[i], hi[i])


def _round(blocks: DataFrame, centres: list[list[int]], dim: int) -> list[list[int]]:
    """The centroids after one assignment; sums and counts are exact."""
    def sums(batches):
        import numpy as np
        import pyarrow as pa
        c = np.array(centres, np.int64)
        total = np.zeros((len(c), dim + 1), np.int64)          # the last column counts
        for b in batches:
            for _, q, box in _blocks_of(b, dim):
                which, _ = _nearest(q, box, c)
                for j in np.unique(which):
                    mine = q[which == j]
                    total[j, :dim] += mine.sum(0)
                    total[j, dim] += len(mine)
        j, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(j), pa.array(at), pa.array(total[j, at])], names=["j", "at", "s"])
    got = blocks.mapInArrow(sums, "j bigint, at bigint, s bigint").groupBy("j", "at").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    total = {(r["j"], r["at"]): int(r["s"]) for r in got}
    return [[total.get((j, i), 0) // total[j, dim] for i in range(dim)] if (j, dim) in total else old
            for j, old in enumerate(centres)]


def _assigned(blocks: DataFrame, centres: list[list[int]], dim: int, id_name: str) -> DataFrame:
    def run(batches):
        import numpy as np
        import pyarrow as pa
        c = np.array(centres, np.int64)
        for b in batches:
            found = [_nearest(q, box, c) for _, q, box in _blocks_of(b, dim)]
            if found:
                which, d = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([b.column("ids").flatten(), pa.array(which.astype(np.int32)), pa.array(d)],
                                                 names=["id", "cluster", "distance"])
    return blocks.mapInArrow(run, f"id {id_name}, cluster int, distance bigint")


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dim: int = 64,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per usable vector: id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Starts are the ``k`` vectors with the smallest SHA-256 of ``seed:id``, in that order.
    """
    spark = vectors.sparkSession
    ready(spark)
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where(_usable("vec", dim))
    name = kept.schema["id"].dataType.simpleString()
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    starts = kept.select(drawn.alias("drawn"), "vec").orderBy("drawn", "vec").limit(k).collect()
    blocks = zone_map(kept, dim) if starts else None
    if blocks is None:
        return spark.createDataFrame([], f"`{id_col}` {name}, cluster int, distance bigint, cluster_inertia bigint, "
                                         "inertia bigint, centroid_sha256 string")
    centres = [[math.floor(SCALE * x) for x in r["vec"]] for r in starts]
    for _ in range(rounds):
        centres = _round(blocks, centres, dim)
    found = written(_assigned(blocks, centres, dim, name))
    inertia = {r["cluster"]: int(r["d"]) for r in
               found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    fits = lambda x: x if x < 1 << 63 else None
    table = [(j, fits(d), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
             for j, d in inertia.items()]
    per = spark.createDataFrame(table, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # at most k rows
    return found.withColumnRenamed("id", id_col).join(F.broadcast(per), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
