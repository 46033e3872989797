"""Line dedup with two Bloom filters: one of hashes seen once, one of hashes seen twice.

A line's key is the line without white space at both ends, A-Z lower-cased; keys of fewer than ``min_chars`` code
points are never dropped. Pass 1 reads the texts in as many slices as the cluster has cores. A slice keeps two filters:
a hash that the first already holds goes into the second. Slices meet as filter words, not as rows: a bit set in the
first filter of two slices, or in the second of one, is set in the merged second filter. A key found twice, in one
slice or two, therefore always hits it. Pass 2 tests every key: one that misses stands in a single document and stays
where it is; only suspected repeats shuffle, as SHA-256 and id, to be counted exactly and to choose the document that
keeps them. Texts move only if they lose a line: a filter of their ids is broadcast, the others pass straight through.

Filters have ``BITS_A_KEY`` bits for each key that the texts can hold, 2 ** ``MAX_WORDS`` words of 64 bits (32 MiB) at
most, the proven bound behind the broadcast of the second. Fuller filters make more keys suspects, never a wrong
answer: beyond some 10 ** 8 long lines nearly all keys shuffle.

A frequent line meets the document that keeps it in a broadcast join: keys that hold more than a thousandth of all
suspects are fewer than a thousand.

Defined cases: a null or empty text is one empty line; lines are split at ``\\n`` alone; a key counts once a document,
and rows that repeat an id are one document; rows with null ids are together one document, which loses to any other;
all lines with a dropped key go, also repeated ones, and the document with the largest id keeps all of its own; an
empty table gives an empty result; other columns are not touched, names that begin with ``__`` are reserved.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickgate.llm.common import narrowed, ready, text_or_empty, written

MIN_CHARS, MIN_DOCS = 40, 5
BITS_A_KEY, PROBES, MAX_WORDS = 16, 4, 22
CHUNK = 8                  # words travel in chunks of 2 ** CHUNK
FREQUENT = 1000            # keys holding more than 1 / FREQUENT of the suspects are joined by broadcast

BLANK = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_keys(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """The distinct keys of a text's lines that are long enough."""
    key = lambda line: F.translate(F.btrim(line, F.lit(BLANK)), UPPER, UPPER.lower())
    return F.array_distinct(F.filter(F.transform(F.split(text, "\n"), key), lambda k: F.char_length(k) >= min_chars))


def _lines(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")


def _word_bits(docs: DataFrame, text: Column, min_chars: int) -> int:
    """log2 of the number of filter words, from the most keys that texts of this length and as many lines can hold."""
    most = F.least(_lines(text), F.floor((F.char_length(text) + 1) / (min_chars + 1)))
    keys = docs.agg(F.sum(most)).first()[0] or 0
    return max(CHUNK, min(MAX_WORDS, math.ceil(math.log2(keys * BITS_A_KEY / 64 + 1))))


def _probes(h, bits: int):
    """Word number and bits of each hash."""
    import numpy as np
    h = h.view(np.uint64)
    mask = np.zeros(len(h), np.uint64)
    for i in range(PROBES):
        mask |= np.uint64(1) << (h >> np.uint64(6 * i) & np.uint64(63))
    return (h >> np.uint64(64 - bits)).astype(np.int64), mask


def _slice_filters(bits: int):
    """Both filters of one slice, as chunks of words that are not empty."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        once, twice = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        for b in batches:
            h, n = np.unique(b.column(0).flatten().to_numpy(), return_counts=True)
            at, mask = _probes(h, bits)
            again = (once[at] & mask == mask) | (n > 1)
            np.bitwise_or.at(twice, at[again], mask[again])
            np.bitwise_or.at(once, at, mask)
        once, twice = once.reshape(-1, 1 << CHUNK), twice.reshape(-1, 1 << CHUNK)
        chunks = np.flatnonzero(once.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunks), pa.array([c.tobytes() for c in once[chunks]], pa.binary()),
             pa.array([c.tobytes() if c.any() else b"" for c in twice[chunks]], pa.binary())], names=["chunk", "once", "twice"])
    return run


def _merged(key, rows):
    """Second filter of all slices over one chunk."""
    import numpy as np
    import pyarrow as pa
    once, twice = np.zeros(1 << CHUNK, np.uint64), np.zeros(1 << CHUNK, np.uint64)
    for o, t in zip(rows.column("once").to_pylist(), rows.column("twice").to_pylist()):
        o = np.frombuffer(o, np.uint64)
        twice |= once & o
        if t:
            twice |= np.frombuffer(t, np.uint64)
        once |= o
    words = twice.view(np.int64)
    keep = [(key[0].as_py(), words)] if twice.any() else []
    return pa.table({"chunk": pa.array([c for c, _ in keep], pa.int64()),
                     "words": pa.array([w.tolist() for _, w in keep], pa.list_(pa.int64()))})


def seen_twice(keys: DataFrame, bits: int) -> DataFrame:
    """(chunk, words): the second filter of ``keys`` (one array of keys a row), written."""
    spark = keys.sparkSession
    hashes = keys.select(F.transform("keys", lambda k: F.xxhash64(k)).alias("h"))
    slices = hashes.coalesce(spark.sparkContext.defaultParallelism).mapInArrow(
        _slice_filters(bits), "chunk bigint, once binary, twice binary")
    return written(slices.groupBy("chunk").applyInArrow(_merged, "chunk bigint, words array<bigint>"))


def _suspects(keys: DataFrame, twice: DataFrame, bits: int) -> DataFrame:
    """(id, sha) of the keys that hit the second filter."""
    flat = keys.select("id", F.explode("keys").alias("key")).withColumn("h", F.xxhash64("key"))
    word = F.shiftrightunsigned("h", 64 - bits)
    mask = F.lit(0).cast("long")
    for i in range(PROBES):
        bit = F.shiftrightunsigned("h", 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    # at most 2 ** (MAX_WORDS - CHUNK) rows of 2 KiB
    met = flat.withColumn("chunk", F.shiftright(word, CHUNK)).join(F.broadcast(twice), "chunk")
    held = F.get("words", word.bitwiseAND(F.lit((1 << CHUNK) - 1)).cast("int"))
    return met.where(held.bitwiseAND(mask) == mask).select("id", F.unhex(F.sha2(F.col("key").cast("binary"), 256)).alias("sha"))


def drops(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
          min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, shas): the documents that lose lines, with the SHA-256 of each key they lose. Written."""
    ready(docs.sparkSession)
    text = text_or_empty(text_col)
    bits = _word_bits(docs, text, min_chars)
    keys = docs.select(F.col(id_col).alias("id"), line_keys(text, min_chars).alias("keys"))
    suspects = written(_suspects(keys, seen_twice(keys, bits), bits))
    total = suspects.count()
    # by (sha, id) first: repeated ids count once, and no task holds a frequent key whole
    repeated = written(suspects.distinct().groupBy("sha").agg(F.count("*").alias("n"), F.max("id").alias("keep"))
                       .where(F.col("n") >= min_docs))
    often = F.col("n") > total // FREQUENT
    met = suspects.join(F.broadcast(repeated.where(often)), "sha").unionByName(
        suspects.join(F.broadcast(repeated.where(often).select("sha")), "sha", "left_anti").join(repeated.where(~often), "sha"))
    return written(met.where(~F.col("id").eqNullSafe(F.col("keep"))).groupBy("id").agg(F.collect_set("sha").alias("shas")))


def _kept_lines(at_text: str, out: list[str]):
    """Drops the lines with a dropped key; adds n_lines, n_dropped and sets the text to what stays."""
    lower = str.maketrans(UPPER, UPPER.lower())

    def run(batches):
        import hashlib
        import pyarrow as pa
        for b in batches:
            texts, kept, n, gone = b.column(at_text).to_pylist(), [], [], []
            for text, shas in zip(texts, b.column("__shas").to_pylist()):
                shas, lines = set(shas), (text or "").split("\n")
                stay = [x for x in lines if hashlib.sha256(x.strip(BLANK).translate(lower).encode()).digest() not in shas]
                kept.append("\n".join(stay))
                n.append(len(lines))
                gone.append(len(lines) - len(stay))
            cols = {name: b.column(name) for name in b.schema.names} | {at_text: pa.array(kept, pa.string())}
            cols |= {"__n_lines": pa.array(n, pa.int64()), "__n_dropped": pa.array(gone, pa.int64())}
            yield pa.RecordBatch.from_arrays([cols[name] for name in out], names=out)
    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
          min_docs: int = MIN_DOCS, lost: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` with the text that stays, and ``__n_lines`` and ``__n_dropped``.

    Only texts that may lose a line shuffle, by id; a null text becomes the empty one.
    """
    lost = drops(docs, id_col, text_col, min_chars, min_docs) if lost is None else lost
    ids = lost.select("id")
    text = text_or_empty(text_col)
    whole = narrowed(docs, id_col, ids, anti=True).withColumns(
        {"__n_lines": _lines(text), "__n_dropped": F.lit(0).cast("long"), text_col: text})
    hits = narrowed(docs, id_col, ids, exact=False)
    given = lost.select(F.col("id").alias("__lost"), F.col("shas").alias("__shas"))
    # the lists of dropped keys grow with the input, so they are never broadcast
    hits = hits.join(given.hint("merge"), hits[id_col].eqNullSafe(given["__lost"])).drop("__lost")
    out = whole.schema
    cut = hits.mapInArrow(_kept_lines(text_col, out.names), out)
    return whole.unionByName(cut)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
           min_docs: int = MIN_DOCS) -> DataFrame:
    """Per row: id, n_lines, n_dropped, kept_sha256 of the text that stays."""
    d = dedup(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "__id", "__text", min_chars, min_docs)
    return d.select(F.col("__id").alias(id_col), F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                    F.sha2(F.col("__text").cast("binary"), 256).alias("kept_sha256"))
