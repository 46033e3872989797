"""Merkle manifest of a dataset as a postorder log written by aligned builders.

Documents are leaves, ascending by id within their language; every ``FAN`` consecutive nodes have a parent, and the
languages' roots are the leaves of one more tree. A builder takes ``SPAN`` = FAN ** 3 leaves that begin at a multiple
of SPAN, and writes its leaves and the three levels above in the order in which they are completed: a child before its
parent, a parent as soon as its last child is there. Builders of the next three levels take the roots of SPAN builders
each. Since a whole subtree of h levels has (FAN ** (h + 1) - 1) / (FAN - 1) nodes, a node's place in the log follows from
its level and number alone (``position``). Proofs are read that way: within a builder's segment the siblings of a
leaf are addressed by their places, and the siblings above come down from the segments of the levels above, one list
for all leaves of a builder. Only digests move: a text is read once, where it is.

Numbering sorts narrow rows (language, id, digest) by range, so a language with most documents is spread over all
partitions; builders group ``SPAN`` rows at most.

Defined cases: a null field is written as ``-``; documents of null language are a tree of their own, first in order;
null ids come first and are never tampered with; rows that repeat an id are leaves of their own, in the order of their
digests; a language with one document has that leaf as its root, and a single language's root is the root; an empty
table gives an empty result. Other columns are not touched.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickgate.llm.blocks import written_blocks
from tickgate.llm.common import ready, written

FAN, STEP = 8, 3
SPAN = FAN ** STEP
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PATH = "array<struct<at:int,others:binary>>"      # per level, bottom up: place in the run, digests of the others


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def position(level: int, index: int, n: int) -> int:
    """Place in the postorder log of node ``index`` of ``level`` in a tree of ``n`` leaves."""
    last = min((index + 1) * FAN ** level, n) - 1
    return last + sum(last // FAN ** m for m in range(1, height(n) + 1)) + level


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, id_col: str, source_col: str, lang_col: str, size_col: str, text_col: str) -> DataFrame:
    """(tree, id, leaf, other): one narrow row per document; ``other`` is the digest of a tampered text."""
    def digest(text: Column) -> Column:
        parts = [_field(F.col(c)) for c in (id_col, source_col, lang_col, size_col)] + [_field(text)]
        return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))
    tampered = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0
    # a name that sorts a null language first and the others as their bytes
    tree = F.coalesce(F.concat(F.lit("="), F.col(lang_col).cast("string")), F.lit(""))
    return docs.select(tree.alias("tree"), F.col(id_col).alias("id"), digest(F.col(text_col)).alias("leaf"),
                       F.when(tampered, digest(F.translate(F.col(text_col), UPPER, UPPER.lower()))).alias("other"))


def _counted(batches):
    """Numbers the sorted rows of a partition within each tree."""
    import pyarrow as pa
    from pyspark import TaskContext
    part, tree, k = TaskContext.get().partitionId(), None, 0
    for b in batches:
        at = []
        for t in b.column("tree").to_pylist():
            k = k + 1 if t == tree else 0
            tree = t
            at.append(k)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * len(at), pa.int32()), pa.array(at, pa.int64())],
                                         names=[*b.schema.names, "part", "k"])


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``i``, the number of a row within its tree by (id, leaf), and ``n``, the tree's rows. Written.

    Rows are numbered within their range partition; a row per (partition, tree) carries what precedes it.
    """
    order = [F.asc("tree"), F.asc_nulls_first("id"), F.asc("leaf")]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    at = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _counted, f"{kinds}, part int, k bigint"))
    per = at.groupBy("tree", "part").agg(F.count("*").alias("here"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("tree", "part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"),
                     F.sum("here").over(Window.partitionBy("tree")).alias("n"))
    return at.join(per, ["tree", "part"]).select(*rows.columns, (F.col("k") + F.col("before")).alias("i"), "n")


def _parent(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def postorder(digests: list[bytes], levels: int) -> list[bytes]:
    """``digests`` and the ``levels`` above them, in the order in which nodes are completed."""
    log, open_runs = [], [[] for _ in range(levels + 1)]
    for i, d in enumerate(digests):
        node, end = d, i == len(digests) - 1
        log.append(node)
        for level in range(levels):
            open_runs[level].append(node)
            if len(open_runs[level]) < FAN and not end:
                break
            node, open_runs[level] = _parent(open_runs[level]), []
            log.append(node)
    return log


def _builder(key, rows):
    """One segment: (tree, block, n, log, top, names, others)."""
    import pyarrow as pa
    rows = rows.sort_by("i")
    n = rows.column("n")[0].as_py()
    log = postorder(rows.column("leaf").to_pylist(), min(STEP, height(n)))
    lists = {c: rows.column(c).combine_chunks() for c in ("name", "other")}
    cut = pa.array([0, len(rows)], pa.int32())
    return pa.table({"tree": [key[0].as_py()], "block": pa.array([key[1].as_py()], pa.int64()), "n": pa.array([n], pa.int64()),
                     "log": pa.array([b"".join(log)], pa.binary()), "top": pa.array([log[-1]], pa.binary()),
                     "names": pa.ListArray.from_arrays(cut, lists["name"]), "others": pa.ListArray.from_arrays(cut, lists["other"])})


def segments(rows: DataFrame) -> DataFrame:
    """The builders' segments over ``rows`` (tree, i, n, name, leaf, other), written."""
    name = rows.schema["name"].dataType.simpleString()
    blocks = rows.withColumn("block", F.floor(F.col("i") / SPAN)).groupBy("tree", "block")
    return written_blocks(blocks.applyInArrow(_builder, "tree string, block bigint, n bigint, log binary, top binary, "
                                                        f"names array<{name}>, others array<binary>"))


def grown(rows: DataFrame) -> list[DataFrame]:
    """Segments of levels 0 to STEP, STEP to 2 * STEP and so on, until every tree has its root."""
    out = [segments(rows)]
    while True:
        tops = out[-1].where(F.col("n") > SPAN).select(
            "tree", F.col("block").alias("i"), F.ceil(F.col("n") / SPAN).alias("n"),
            F.lit(None).cast("string").alias("name"), F.col("top").alias("leaf"), F.lit(None).cast("binary").alias("other"))
        if tops.isEmpty():
            return out
        out.append(segments(tops))


def roots(grown_: list[DataFrame]) -> DataFrame:
    """(tree, top): the root of every tree."""
    tops = [s.where(F.col("n") <= SPAN).select("tree", "top") for s in grown_]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def siblings(log: bytes, count: int, levels: int, i: int) -> list[tuple[int, bytes]]:
    """(place in the run, digests of its other nodes) on each level above leaf ``i`` of a segment of ``count`` leaves.

    Nodes are addressed by their closed-form places in the segment's log.
    """
    out = []
    for level in range(levels):
        node = i // FAN ** level
        first, width = node // FAN * FAN, -(-count // FAN ** level)
        run = [position(level, j, count) * 32 for j in range(first, min(first + FAN, width)) if j != node]
        out.append((node - first, b"".join(log[p:p + 32] for p in run)))
    return out


def _children(batches):
    """Each child of the segments with its way to the root: (tree, i, name, digest, path, subroot)."""
    import pyarrow as pa
    for b in batches:
        out = []
        for r in b.to_pylist():
            count, levels = len(r["names"]), min(STEP, height(r["n"]))
            above = [(p["at"], p["others"]) for p in r["path"]]
            for i in range(count):
                p = position(0, i, count) * 32
                out.append((r["tree"], r["block"] * SPAN + i, r["names"][i], r["log"][p:p + 32],
                            [{"at": a, "others": o} for a, o in siblings(r["log"], count, levels, i) + above], r["subroot"]))
        kinds = [pa.string(), pa.int64(), pa.string(), pa.binary(),
                 pa.list_(pa.struct([("at", pa.int32()), ("others", pa.binary())])), pa.binary()]
        cols = list(zip(*out)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                         names=["tree", "i", "name", "digest", "path", "subroot"])


def _expanded(segs: DataFrame) -> DataFrame:
    return segs.mapInArrow(_children, f"tree string, i bigint, name string, digest binary, path {PATH}, subroot binary")


def with_paths(grown_: list[DataFrame], given: DataFrame) -> DataFrame:
    """The lowest segments with ``path`` (bottom up) and ``subroot``; ``given`` has both for each tree's root."""
    below = None
    for segs in reversed(grown_):
        rooted = segs.where(F.col("n") <= SPAN).join(given, "tree")
        if below is not None:
            way = below.select("tree", F.col("i").alias("block"), "path", "subroot")
            rooted = rooted.unionByName(segs.where(F.col("n") > SPAN).join(way, ["tree", "block"]).select(*rooted.columns))
        last, below = rooted, None if segs is grown_[0] else written(_expanded(rooted))
    return last


def _proved(root: bytes, id_name: str):
    def run(batches):
        import pyarrow as pa
        want = root.hex()
        for b in batches:
            out = {k: [] for k in ("leaf", "subroot", "proof", "folded")}
            ids = b.column("names").flatten()
            for r in b.drop_columns(["names"]).to_pylist():
                log, count = r["log"], len(r["others"])
                levels, subroot = min(STEP, height(r["n"])), r["subroot"].hex()
                above = [(p["at"] * 64, p["others"].hex()) for p in r["path"]]
                for i in range(count):
                    p = position(0, i, count) * 32
                    leaf = log[p:p + 32]
                    way = [(a * 64, o.hex()) for a, o in siblings(log, count, levels, i)] + above
                    node = (r["others"][i] or leaf).hex()
                    for cut, others in way:
                        node = hashlib.sha256((others[:cut] + node + others[cut:]).encode()).hexdigest()
                    out["leaf"].append(leaf.hex())
                    out["subroot"].append(subroot)
                    out["proof"].append(hashlib.sha256("".join(o for _, o in way).encode()).hexdigest())
                    out["folded"].append(node)
            n = len(out["leaf"])
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(out[k], pa.string()) for k in ("leaf", "subroot")), pa.array([want] * n, pa.string()),
                 *(pa.array(out[k], pa.string()) for k in ("proof", "folded")),
                 pa.array([f == want for f in out["folded"]], pa.bool_())],
                names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return run


class Manifest:
    """The written log of a dataset: segments of every language's tree and of the tree of languages."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang",
                 size_col: str = "n_chars", text_col: str = "text"):
        ready(docs.sparkSession)
        self.id_col = id_col
        rows = numbered(leaves(docs, id_col, source_col, lang_col, size_col, text_col))
        self.trees = grown(rows.withColumn("name", F.col("id")))
        subroots = roots(self.trees).select(F.lit("root").alias("tree"), F.col("tree").alias("id"), F.col("top").alias("leaf"))
        subroots = numbered(subroots.withColumn("other", F.lit(None).cast("binary")))
        self.upper = grown(subroots.withColumn("name", F.col("id")))
        first = roots(self.upper).first()
        self.root = None if first is None else bytes(first["top"])

    def proofs(self) -> DataFrame:
        """Per document: id, leaf, subroot, root, proof_sha256, folded_root, verified."""
        name = self.trees[0].schema["names"].dataType.elementType.simpleString()
        shape = (f"id {name}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                 "verified boolean")
        if self.root is None:
            return self.trees[0].sparkSession.createDataFrame([], shape).withColumnRenamed("id", self.id_col)
        start = self.upper[0].sparkSession.createDataFrame([("root", [], None)], f"tree string, path {PATH}, subroot binary")
        upper = _expanded(with_paths(self.upper, start)).select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"))
        low = with_paths(self.trees, written(upper))
        return low.select("n", "log", "names", "others", "path", "subroot").mapInArrow(
            _proved(self.root, name), shape).withColumnRenamed("id", self.id_col)

    def log(self) -> DataFrame:
        """(tree, position, level, index, digest): every node of the languages' trees at its place in its tree's log."""
        def nodes(base: int):
            def run(batches):
                import pyarrow as pa
                for b in batches:
                    out = []
                    for r in b.to_pylist():
                        # n counts this base level's nodes; a tree's leaves end where its last node does
                        levels, count = min(STEP, height(r["n"])), len(r["others"])
                        for level in range(1 if base else 0, levels + 1):
                            for j in range(-(-count // FAN ** level)):
                                p = position(level, j, count) * 32
                                index = r["block"] * (SPAN // FAN ** level) + j
                                out.append((r["tree"], position(base + level, index, r["leaves"]), base + level, index,
                                            r["log"][p:p + 32]))
                    cols = list(zip(*out)) if out else [[]] * 5
                    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                     names=["tree", "position", "level", "index", "digest"])
            return run
        sizes = self.trees[0].select("tree", F.col("n").alias("leaves")).distinct()
        out = None
        for k, segs in enumerate(self.trees):
            rows = segs.select("tree", "block", "n", "log", "others").join(sizes, "tree").mapInArrow(
                nodes(k * STEP), "tree string, position bigint, level int, index bigint, digest binary")
            out = rows if out is None else out.unionByName(rows)
        return out


def prove(docs: DataFrame, **columns: str) -> DataFrame:
    """Builds the manifest of ``docs`` and checks every document against it (see ``Manifest.proofs``)."""
    return Manifest(docs, **columns).proofs()
