"""MinHash near-dedup with sequential Bayesian verification.

1. One pass over whole texts gives each document the size and a 128-bit hash of its set of word
   shingles, ``HASHES`` minima, and a key for each of ``BANDS`` bands. Documents with equal sets are
   one class; only its smallest id goes on.
2. Documents that share a band key are candidates. A bucket's smallest id is its hub; first every
   member is compared with the hub only, so a bucket of n members makes n - 1 pairs.
3. A pair's minima are compared in batches. With a uniform prior the similarity has a Beta posterior;
   a pair goes as soon as the posterior probability of reaching the threshold is below ``MISS``.
   Pairs that are left are verified on their full shingle sets, so every link is exact.
4. Links are joined to components. A bucket whose members are not yet in one component is searched in
   full: members outside its largest component are compared with all other members of other
   components, in blocks of bounded size that hold their sets: pruned by their minima and verified there,
   so that only links leave, one for each member and component. Members of one component need no further
   link, so nothing is lost that the band keys offer.

A pair at the threshold shares no band with probability (1 - t**4) ** 32, 5e-6 at t = 0.75; above it
the chance falls steeply. Nothing else is approximate.

Words are runs of characters other than ASCII white space, lower-cased in A-Z. Shingles are kept as
64-bit hashes.

Defined cases: null text has no words; documents without words have an empty set and no links; with
fewer than ``SHINGLE`` words the whole sequence is the one shingle; rows with a null id take no part
and get a null component, kept; rows that repeat an id and text get the same answer, rows that repeat
an id with other texts are judged by their own; other columns are not touched; an empty table gives
an empty result.
"""
from __future__ import annotations

import functools
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickgate.llm.common import narrowed, ready, written
from tickgate.llm.components import connected

SHINGLE = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
THRESHOLD = (75, 100)      # intersection / union, as a fraction
MISS = 1e-5
BATCH = 32
BLOCK = 1024               # members of a block in the full search of a bucket


# ---------------------------------------------------------------- shingles and minima

def shingles(text: str | None):
    """The sorted distinct 64-bit shingle hashes of one text."""
    import numpy as np
    import xxhash
    words = text.encode().lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(n, SHINGLE)
    # each position has its own odd factor; sequences shorter than a shingle start from another constant
    s = np.full(n - k + 1, 0x9E3779B97F4A7C15 * k & 0xFFFFFFFFFFFFFFFF if k < SHINGLE else 0, np.uint64)
    factor = 0xD6E8FEB86659FD93
    for i in range(k):
        s += w[i:n - k + 1 + i] * np.uint64(factor)
        factor = factor * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF | 1
    s ^= s >> np.uint64(32)
    s *= np.uint64(0xD6E8FEB86659FD93)
    s ^= s >> np.uint64(29)
    return np.unique(s)


@functools.cache
def _factors():
    import numpy as np
    rng = np.random.default_rng(20240607)
    a = rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    return a, rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def minima(s):
    """HASHES minima of a set of shingle hashes."""
    import numpy as np
    a, b = _factors()
    x = (s >> np.uint64(32)).astype(np.uint32) ^ s.astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 512):
        np.minimum(out, (x[at:at + 512, None] * a + b).min(0), out=out)
    return out


def band_keys(sig):
    """A 64-bit key per band, of the band's number and minima."""
    import numpy as np
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        key = (key ^ rows[:, r]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def _schema(df: DataFrame, col: str, rest: str) -> StructType:
    return StructType([df.schema[col], *StructType.fromDDL(rest)])


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n, set_hi, set_lo, sig (HASHES little-endian 32-bit minima), bands (a key per band)."""
    ready(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash
        for batch in batches:
            rows = []
            for t in batch.column(1):
                s = shingles(t.as_py())
                h = xxhash.xxh3_128_intdigest(s.tobytes())
                sig = minima(s) if len(s) else None
                rows.append((len(s), (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63),
                             None if sig is None else sig.tobytes(), None if sig is None else band_keys(sig)))
            n, hi, lo, sig, bands = zip(*rows) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()),
                 pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "n", "set_hi", "set_lo", "sig", "bands"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, _schema(src, "id", "n long, set_hi long, set_lo long, sig binary, bands array<long>"))


# ---------------------------------------------------------------- verification

@functools.cache
def fewest_matches(hashes: int, threshold: float, miss: float) -> int:
    """Fewest equal minima out of ``hashes`` that leave P(similarity >= threshold) at ``miss`` or more.

    The posterior after m matches is Beta(m + 1, hashes - m + 1), whose upper tail at t is the lower
    tail of a binomial: P(Bin(hashes + 1, t) <= m).
    """
    tail = 0.0
    for m in range(hashes + 1):
        tail += math.comb(hashes + 1, m) * threshold ** m * (1 - threshold) ** (hashes + 1 - m)
        if tail >= miss:
            return m
    return hashes


def survivors(a, b, threshold: float, miss: float = MISS):
    """Row numbers of two equal-shaped arrays of minima that no batch prunes."""
    import numpy as np
    left = np.arange(len(a))
    same = np.zeros(len(a), np.int32)
    for at in range(0, HASHES, BATCH):
        same = same + (a[left, at:at + BATCH] == b[left, at:at + BATCH]).sum(1, dtype=np.int32)
        ok = same >= fewest_matches(at + BATCH, threshold, miss)
        left, same = left[ok], same[ok]
    return left


def _matrix(col):
    import numpy as np
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(-1, HASHES)


def prune(pairs: DataFrame, reps: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) that sequential comparison of their minima leaves."""
    sig = reps.select("id", "sig")
    joined = pairs.join(sig.withColumnsRenamed({"id": "a", "sig": "sig_a"}), "a") \
        .join(sig.withColumnsRenamed({"id": "b", "sig": "sig_b"}), "b").select("a", "b", "sig_a", "sig_b")
    t = threshold[0] / threshold[1]

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if batch.num_rows:
                yield batch.select([0, 1]).take(_take(survivors(_matrix(batch.column(2)), _matrix(batch.column(3)), t)))

    return joined.mapInArrow(run, StructType(joined.schema.fields[:2]))


def _take(rows):
    import pyarrow as pa
    return pa.array(rows, pa.int64())


def shingle_sets(wanted: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, words): the packed shingle set of every document in ``wanted`` (id); other texts stay where they are."""
    texts = narrowed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", wanted)

    def sets(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            packed = [shingles(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["id", "words"])

    return texts.mapInArrow(sets, _schema(texts, "id", "words binary"))


def verify(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold. Sets are made only of documents in pairs."""
    pairs = written(pairs)
    wanted = written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    full = written(shingle_sets(wanted, docs, id_col, text_col))
    joined = pairs.join(full.withColumnsRenamed({"id": "b", "words": "set_b"}), "b") \
        .join(full.withColumnsRenamed({"id": "a", "words": "set_a"}), "a").select("a", "b", "set_a", "set_b")
    num, den = threshold

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        for batch in batches:
            ok = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint64) for k in (2, 3))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                if both and den * both >= num * (len(x) + len(y) - both):
                    ok.append(i)
            yield batch.select([0, 1]).take(_take(ok))

    return joined.mapInArrow(run, StructType(joined.schema.fields[:2]))


# ---------------------------------------------------------------- candidates

def _sizes_fit(n_a, n_b, threshold: tuple[int, int]):
    """Sets whose sizes alone rule out the threshold."""
    num, den = threshold
    return F.least(n_a, n_b) * den >= F.greatest(n_a, n_b) * num


def _cross_search(threshold: tuple[int, int]):
    """Links between a block of probes and a block of targets of one bucket, verified on their full sets.

    One link from a probe into a component is enough, so the links found are no more than probes times
    components, whatever the number of pairs.
    """
    num, den = threshold

    def search(table):
        import numpy as np
        import pyarrow as pa
        probe = np.asarray(table.column("probe").combine_chunks().to_numpy(zero_copy_only=False), bool)
        ids = table.column("id").to_numpy()
        comps, n, sig = table.column("component").to_numpy(), table.column("n").to_numpy(), _matrix(table.column("sig"))
        words = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("words")]
        sizes = np.array([len(w) for w in words])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        vocabulary, numbers = np.unique(np.concatenate(words), return_inverse=True)
        marked = np.zeros(len(vocabulary), bool)
        t, left, right = np.flatnonzero(~probe), [], []
        for i in np.flatnonzero(probe):
            j = t[(comps[t] != comps[i]) & (np.minimum(n[t], n[i]) * den >= np.maximum(n[t], n[i]) * num)]
            j = j[survivors(np.broadcast_to(sig[i], (len(j), HASHES)), sig[j], num / den)]
            if not len(j):
                continue
            own = numbers[starts[i]:starts[i + 1]]
            marked[own] = True
            hits = marked[np.concatenate([numbers[starts[k]:starts[k + 1]] for k in j])]
            both = np.add.reduceat(hits, np.cumsum(sizes[j]) - sizes[j], dtype=np.int64)
            marked[own] = False
            j = j[den * both >= num * (sizes[j] + sizes[i] - both)]
            _, one = np.unique(comps[j], return_index=True)
            left.append(np.minimum(ids[i], ids[j[one]]))
            right.append(np.maximum(ids[i], ids[j[one]]))
        return pa.table({"a": np.concatenate([ids[:0], *left]), "b": np.concatenate([ids[:0], *right])})
    return search


def cross_links(members: DataFrame, reps: DataFrame, comp: DataFrame, docs: DataFrame, id_col: str, text_col: str,
                threshold: tuple[int, int]) -> DataFrame:
    """Verified links (a, b) between members of one bucket that are in different components.

    Probes are the members outside their bucket's largest component, targets are all but the hub. Both
    are dealt into blocks by a hash of the id, and each pair of blocks is one bounded group, with the
    sets of its members; no pair leaves it but links.
    """
    # every member has been compared with the hub
    m = members.where("id <> hub").join(comp, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    open_ = m.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("c")) \
        .where("lo <> hi")
    main = m.groupBy("key", "component").agg(F.count("*").alias("c")) \
        .groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("main"), F.max("c").alias("most"))
    open_ = written(open_.join(main, "key").select(
        "key", "main", F.ceil(F.col("c") / BLOCK).cast("int").alias("targets"),
        F.ceil((F.col("c") - F.col("most")) / BLOCK).cast("int").alias("probes")))
    rows = written(m.join(open_, "key"))
    wanted = written(rows.select("id").distinct())
    known = written(shingle_sets(wanted, docs, id_col, text_col).join(reps.select("id", "n", "sig"), "id"))
    block = lambda k: F.pmod(F.xxhash64("id"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    cols = ["key", "t", "p", "probe", "id", "component"]
    targets = rows.withColumn("t", block("targets")).withColumn("p", every("probes")).withColumn("probe", F.lit(False))
    probes = rows.where("component <> main").withColumn("p", block("probes")).withColumn("t", every("targets")) \
        .withColumn("probe", F.lit(True))
    dealt = targets.select(cols).unionByName(probes.select(cols)).join(known, "id")
    kind = reps.schema["id"].dataType.simpleString()
    return dealt.groupBy("key", "t", "p").applyInArrow(_cross_search(threshold), f"a {kind}, b {kind}").distinct()


def links(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, threshold: tuple[int, int]) -> DataFrame:
    """Verified pairs (a, b) between class representatives whose components are those of all links."""
    keyed = reps.select("id", "n", F.explode("bands").alias("key"))
    buckets = written(keyed.groupBy("key").agg(F.min(F.struct("id", "n")).alias("h"), F.count("*").alias("c")).where("c > 1")
                      .select("key", F.col("h.id").alias("hub"), F.col("h.n").alias("hub_n")))
    members = written(keyed.join(buckets, "key"))
    pairs = members.where("hub <> id").where(_sizes_fit(F.col("n"), F.col("hub_n"), threshold)) \
        .select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    first = written(verify(prune(pairs, reps, threshold), docs, id_col, text_col, threshold))
    return first.unionByName(cross_links(members, reps, connected(first), docs, id_col, text_col, threshold))


def classes(sigs: DataFrame) -> DataFrame:
    """Equal sets of at least two documents: set_hi, set_lo, rep. Aggregated before the shuffle."""
    return sigs.where("n > 0 AND id IS NOT NULL").groupBy("set_hi", "set_lo").agg(
        F.min("id").alias("rep"), F.count("*").alias("c")).where("c > 1").drop("c")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    sigs = written(signatures(docs, id_col, text_col))
    same = written(classes(sigs))
    known = written(sigs.select("id", "n", "set_hi", "set_lo").join(same, ["set_hi", "set_lo"], "left")
                    .select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("rep")))
    others = written(known.where("id <> rep").select("id").distinct())
    reps = narrowed(sigs.where("n > 0 AND id IS NOT NULL"), "id", others, anti=True)
    comp = connected(links(docs, reps, id_col, text_col, threshold))
    out = known.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component", "rep")).otherwise(F.col("id")).alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    gone = written(group(docs, id_col, text_col, threshold).where("NOT kept").select(F.col(id_col).alias("__id")).distinct())
    return narrowed(docs, id_col, gone, "__id", anti=True)


