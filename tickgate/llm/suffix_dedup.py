"""Repeated byte strings of a fixed length, found by blockwise suffix sorting with a difference cover.

A byte goes if it is covered by a string of ``length`` bytes that also starts anywhere else, in another
document or at another place of the same one.

1. Equal texts are one class. A class of several rows goes whole; only one of its rows goes on.
2. Cover sample. Positions whose residue is in a difference cover modulo ``v`` are sampled: any two equal
   strings of ``length`` bytes hold, at one common distance below ``v``, a sampled position each, and the
   ``length - v + 1`` bytes that follow are equal. Samples are dealt to buckets by a fingerprint of those
   bytes, and a bucket at a time is sorted. A suffix with no sample of equal rank elsewhere is unique.
3. Long ties. Samples of equal rank are sorted once more by ``length + v - 1`` bytes. Where these are equal
   too, the ranks settle all suffixes that start in the next ``v`` bytes. Those of the first sample of a rank
   stand for the others', which need no sorting. (A suffix is left out only if the same string starts at a
   smaller place, so one of each string is always sorted.)
4. The suffixes left are dealt to buckets by a fingerprint of their first ``length`` bytes, and sorted a
   bucket at a time; equal neighbours are repeated.

Suffixes are compared to ``length`` bytes only, so any total order that puts equal strings side by side will
do, and the order of fingerprints is taken; characters are not compared. The first fingerprint may collide
without harm (40 bits and the bucket); those that decide have 62 bits and, of a second one, the bucket, so that
they grow with the input. Fingerprints are polynomials over a prime field whose bases are drawn anew for every run, so no
texts can be built to collide; equality is still that of fingerprints, bytes are not compared again.

The number of buckets grows with the input, so a bucket's size does not. A bucket holds positions, not texts;
documents travel only if they hold a sample of equal rank, once. Entries with one fingerprint are combined before the
shuffle: a task sends one for all that it holds and answers the others itself, so a string that very many documents
share fills no bucket.

Defined cases: null text is the empty text; texts shorter than ``length`` lose nothing; null ids and rows that
repeat an id are answered row by row; rows that repeat id and text are equal texts of two rows, so both go;
other columns are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickgate.llm.common import narrowed, ready, text_or_empty, written

LENGTH = 400
BUCKET = 2_000_000      # positions that a bucket should hold
FLUSH = 1_000_000       # positions held by a task before it deals them out
PART = 1 << 18          # bytes hashed at a time

# Entries of one bucket: their keys; the documents in turn, with the number of entries of each; places; flags.
PACK = "bucket int, keys binary, refs binary, counts binary, places binary, flags binary"
FOUND = "ref long, places binary"
FIRST = 1 << 31         # in a place of FOUND: the first of its rank
SHORT = 5               # bytes of a key that need not decide


# ---------------------------------------------------------------- difference cover

@functools.cache
def difference_cover(length: int) -> tuple[int, tuple[int, ...]]:
    """(v, residues): the largest cover of the family of Colbourn and Ling with v at most half of ``length``."""
    r = -1
    while 24 * (r + 1) ** 2 + 36 * (r + 1) + 13 <= length / 2:
        r += 1
    if r < 0:
        return 1, (0,)
    gaps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    out = [0]
    for g in gaps:
        out.append(out[-1] + g)
    return 24 * r * r + 36 * r + 13, tuple(out)


# ---------------------------------------------------------------- fingerprints

PRIME = (1 << 31) - 1


def new_secret() -> tuple[int, ...]:
    """Bases of four fingerprints and the seed of the byte codes, drawn anew for every run.

    A polynomial over a prime field with a secret base has no texts that collide by construction: two different
    strings of ``width`` bytes agree for at most ``width`` of the 2 ** 31 bases, and two bases decide together.
    """
    import secrets
    return (*(1000 + secrets.randbelow(PRIME - 2000) for _ in range(4)), secrets.randbits(32))


def _reduced(x):
    """``x`` modulo PRIME, for x below 2 ** 62."""
    import numpy as np
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return np.where(x >= PRIME, x - np.uint64(PRIME), x)


@functools.lru_cache(24)
def _powers(base: int, n: int):
    import numpy as np
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:            # doubling: base ** (have + i) = base ** have * base ** i
        more = min(have, n - have)
        out[have:have + more] = _reduced(out[:more] * np.uint64(pow(base, have, PRIME)))
        have += more
    return out


@functools.lru_cache(8)
def _codes(seed: int):
    import numpy as np
    return np.random.default_rng(seed).integers(1, PRIME, 256, dtype=np.uint64)


SECRET = new_secret()      # of this process; a run passes its own to all its tasks


def fingerprints(b, starts, width: int, secret: tuple[int, ...] = SECRET, which: int = 0):
    """64-bit fingerprints of ``b[s:s + width]`` for increasing ``starts``: two polynomials modulo PRIME by prefix sums."""
    import numpy as np
    size = PART + width
    out = np.zeros(len(starts), np.uint64)
    for base in secret[2 * which:2 * which + 2]:
        up, down = _powers(base, size + 1), _powers(pow(base, -1, PRIME), size + 1)
        done = 0
        for at in range(0, len(b), PART):
            end = int(np.searchsorted(starts, at + PART))
            if end > done:
                s = starts[done:end] - at
                part = _codes(secret[4])[b[at:at + size]]
                part = _reduced(part * up[:len(part)])
                sums = np.zeros(len(part) + 1, np.uint64)      # below 2 ** 50
                np.cumsum(part, out=sums[1:])
                out[done:end] = out[done:end] << np.uint64(31) | _reduced(_reduced(sums[s + width] - sums[s]) * down[s])
                done = end
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xA0761D6478BD642F)
    out ^= out >> np.uint64(32)
    return out


def samples(n: int, length: int):
    """Sampled positions of a text of n bytes whose window fits."""
    import numpy as np
    v, cover = difference_cover(length)
    width = length - v + 1
    if n < length:
        return np.empty(0, np.int64)
    p = (np.arange(0, n, v, dtype=np.int64)[:, None] + np.array(cover, np.int64)).ravel()
    return p[p <= n - width]


# ---------------------------------------------------------------- buckets

def _pack(number: int, at, doc, refs, key_bytes, place, flags) -> tuple:
    """A row of PACK of the entries ``at``, whose documents stand in turn. Places take two bytes where they can."""
    import numpy as np
    docs, counts = np.unique(doc[at], return_counts=True)
    p = place[at]
    p = p.astype(np.uint16 if not len(p) or p.max() < 1 << 16 else np.uint32)
    return (number, key_bytes, refs[docs].tobytes(), counts.astype(np.uint32).tobytes(), p.tobytes(), np.packbits(flags[at]).tobytes())


def _batch(rows: list[tuple]):
    import pyarrow as pa
    out = list(zip(*rows)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *[pa.array(c, pa.binary()) for c in out[1:]]],
                                      names=[c.split()[0] for c in PACK.split(", ")])


def _unpack(table):
    """(refs, places, flags, raw key bytes) of all entries in rows of PACK."""
    import numpy as np
    view = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]
    counts = view("counts", np.uint32)
    sizes = [int(c.sum()) for c in counts]
    refs = [np.repeat(r, c) for r, c in zip(view("refs", np.int64), counts)]
    places = [x.view(np.uint16 if len(x) == 2 * n else np.uint32).astype(np.uint32)
              for x, n in zip(view("places", np.uint8), sizes)]
    flags = [np.unpackbits(x, count=n).astype(bool) for x, n in zip(view("flags", np.uint8), sizes)]
    join = lambda parts, kind: np.concatenate([np.empty(0, kind), *parts])
    return join(refs, np.int64), join(places, np.uint32), join(flags, bool), join(view("keys", np.uint8), np.uint8)


class Dealer:
    """Holds (fingerprint, document, place) and gives them out as one packed row per bucket."""

    def __init__(self, bits: int, wide: bool):
        self.bits, self.wide = bits, wide
        self.clear()

    def clear(self) -> None:
        self.keys, self.more, self.refs, self.sizes, self.places, self.held = [], [], [], [], [], 0

    def add(self, ref: int, key, more, places) -> None:
        self.keys.append(key)
        self.refs.append(ref)
        self.sizes.append(len(key))
        self.places.append(places)
        if self.wide:
            self.more.append(more)
        self.held += len(key)

    def rows(self):
        """A record batch of PACK: a row per bucket, and one (without keys) of the entries that are answered here.

        A flag says that the entry stands for others of its fingerprint.
        """
        import numpy as np
        key, place = np.concatenate(self.keys), np.concatenate(self.places).astype(np.uint32)
        refs, doc = np.array(self.refs, np.int64), np.repeat(np.arange(len(self.refs)), self.sizes)
        spread = np.concatenate(self.more) if self.wide else key
        bucket = (spread >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(key), np.int64)
        hit, after, before = _ranks(key, bucket, refs[doc], place)
        stands = np.zeros(len(key), bool)
        stands[hit[before & ~after]] = True
        rest = np.sort(hit[after])
        dealt = np.ones(len(key), bool)
        dealt[rest] = False
        dealt = np.flatnonzero(dealt)
        dealt = dealt[np.argsort(bucket[dealt], kind="stable")]   # documents stay in turn inside a bucket
        ends = np.searchsorted(bucket[dealt], np.arange((1 << self.bits) + 1))
        out = []
        for b in range(1 << self.bits):
            at = dealt[ends[b]:ends[b + 1]]
            if len(at):
                low = key[at] if self.wide else np.ascontiguousarray(key[at].view(np.uint8).reshape(-1, 8)[:, :SHORT])
                out.append(_pack(b, at, doc, refs, low.tobytes(), place, stands))
        if len(rest):
            out.append(_pack(int(bucket[rest[0]]), rest, doc, refs, b"", place, stands))
        self.clear()
        return _batch(out)


def _ranks(key, bucket, refs, places):
    """Entries with an equal neighbour, by fingerprint and place; whether each follows, or is followed by, an equal one."""
    import numpy as np
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    hit = np.zeros(len(order), bool)
    hit[1:] |= same
    hit[:-1] |= same
    hit = order[hit]
    hit = hit[np.lexsort((places[hit], refs[hit], bucket[hit], key[hit]))]
    after, before = np.zeros(len(hit), bool), np.zeros(len(hit), bool)
    after[1:] = before[:-1] = (key[hit[1:]] == key[hit[:-1]]) & (bucket[hit[1:]] == bucket[hit[:-1]])
    return hit, after, before


def _repeated_in_bucket(lanes: int):
    def run(table):
        """Sort one bucket and give the entries that have an equal one, here or where they came from, by lane of documents.

        A flag marks the first of its rank.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        empty = pc.equal(pc.binary_length(table.column("keys")), 0)
        refs, places, stands, raw = _unpack(table.filter(pc.invert(empty)))
        if len(raw) == 8 * len(places):
            keys = raw.view(np.uint64)
        else:
            keys = np.zeros((len(places), 8), np.uint8)
            keys[:, :SHORT] = raw.reshape(-1, SHORT)
            keys = keys.view(np.uint64).ravel()
        hit, after, before = _ranks(keys, np.zeros(len(keys), np.int8), refs, places)
        first = np.ones(len(places), bool)
        first[hit[after]] = False
        found = stands
        found[hit[after | before]] = True
        found = np.flatnonzero(found)
        other_refs, other_places, _, _ = _unpack(table.filter(empty))
        r, p = np.concatenate([refs[found], other_refs]), np.concatenate([places[found], other_places])
        f = np.concatenate([first[found], np.zeros(len(other_refs), bool)])
        back = np.lexsort((p, r, r % lanes))
        r, p, f = r[back], p[back], f[back]
        turn = np.zeros(len(r), np.int64)     # number of the document, in the order of lanes
        turn[1:] = np.cumsum(r[1:] != r[:-1])
        order = r[np.concatenate([[0], np.flatnonzero(np.diff(turn)) + 1]).astype(np.int64)] if len(r) else r
        ends = np.searchsorted(r % lanes, np.arange(lanes + 1))
        return pa.Table.from_batches([_batch([
            _pack(k, np.arange(ends[k], ends[k + 1]), turn, order, b"", p, f) for k in range(lanes) if ends[k] < ends[k + 1]])])
    return run


def gathered(table):
    """All found places of the documents of one lane: (ref, places), a row per document."""
    import numpy as np
    import pyarrow as pa
    r, p, f, _ = _unpack(table)
    order = np.lexsort((~f, p, r))
    r, p, f = r[order], p[order], f[order]
    once = np.ones(len(r), bool)      # a place found twice counts as a first if it was one
    once[1:] = (r[1:] != r[:-1]) | (p[1:] != p[:-1])
    r, p = r[once], p[once] | np.where(f[once], np.uint32(FIRST), np.uint32(0))
    starts = np.concatenate([[0], np.flatnonzero(np.diff(r)) + 1]).astype(np.int64) if len(r) else np.empty(0, np.int64)
    offsets = np.append(starts, len(r)).astype(np.int32) * 4
    packed = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(p))])
    return pa.table({"ref": pa.array(r[starts], pa.int64()), "places": packed})


def _repeated(dealt: DataFrame, bits: int) -> DataFrame:
    """(ref, places): all repeated places of a document, in one row."""
    lanes = 1 << max(3, bits - 3)
    found = dealt.groupBy("bucket").applyInArrow(_repeated_in_bucket(lanes), PACK)
    return found.withColumnRenamed("bucket", "lane").groupBy("lane").applyInArrow(gathered, FOUND)


def _bits(positions: float) -> int:
    bits = 0
    while positions > BUCKET << bits:
        bits += 1
    return bits


# ---------------------------------------------------------------- passes over texts

def _deal(rows: DataFrame, bits: int, wide: bool, choose) -> DataFrame:
    """Deal the positions that ``choose(text bytes, other columns)`` gives: (key, more, places)."""
    ready(rows.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        dealer = Dealer(bits, wide)
        for batch in batches:
            others = [batch.column(k) for k in range(2, batch.num_columns)]
            for i in range(batch.num_rows):
                b = np.frombuffer(batch.column(1)[i].as_buffer(), np.uint8)
                key, more, places = choose(b, *[c[i] for c in others])
                if len(key):
                    dealer.add(batch.column(0)[i].as_py(), key, more, places)
                    if dealer.held >= FLUSH:
                        yield dealer.rows()
        if dealer.held:
            yield dealer.rows()

    return rows.mapInArrow(run, PACK)


def _places(value, firsts: bool = True):
    """The positions in ``places`` of FOUND, in order, with or without the firsts of ranks; none for null."""
    import numpy as np
    if not value.is_valid:
        return np.empty(0, np.int64)
    p = np.frombuffer(value.as_buffer(), np.uint32)
    if not firsts:
        p = p[p < FIRST]
    return (p & np.uint32(FIRST - 1)).astype(np.int64)


def _marked(size: int, starts, before: int, after: int):
    """Which of ``size`` positions lie in [s - before, s + after) of any start."""
    import numpy as np
    steps = np.zeros(size + 1, np.int32)
    np.add.at(steps, np.clip(starts - before, 0, size), 1)
    np.add.at(steps, np.clip(starts + after, 0, size), -1)
    return np.cumsum(steps[:-1]) > 0


def _choose_samples(length: int, secret: tuple[int, ...]):
    v, _ = difference_cover(length)

    def choose(b):
        p = samples(len(b), length)
        return fingerprints(b, p, length - v + 1, secret), None, p
    return choose


def _choose_long(length: int, secret: tuple[int, ...]):
    v, _ = difference_cover(length)
    width = length + v - 1

    def choose(b, ranked):
        p = _places(ranked)
        p = p[p <= len(b) - width]
        return fingerprints(b, p, width, secret), fingerprints(b, p, width, secret, 1), p
    return choose


def _choose_rest(length: int, secret: tuple[int, ...]):
    import numpy as np
    v, _ = difference_cover(length)

    def choose(b, ranked, settled):
        size = len(b) - length + 1
        open_ = _marked(size, _places(ranked), v - 1, 1) & ~_marked(size, _places(settled, firsts=False), 0, v)
        p = np.flatnonzero(open_)
        return fingerprints(b, p, length, secret), fingerprints(b, p, length, secret, 1), p
    return choose


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """(ref, spans, kept) from (ref, bytes, settled, repeated)."""
    v, _ = difference_cover(length)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            ids, spans, kept = [], [], []
            for i in range(batch.num_rows):
                b = np.frombuffer(batch.column(1)[i].as_buffer(), np.uint8)
                settled, repeated = _places(batch.column(2)[i]), _places(batch.column(3)[i])
                gone = _marked(len(b), settled, 0, length + v - 1) | _marked(len(b), repeated, 0, length)
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                if len(edges):
                    ids.append(batch.column(0)[i].as_py())
                    spans.append([{"s": int(s), "e": int(e)} for s, e in edges.reshape(-1, 2)])
                    kept.append(b[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(spans, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                 pa.array(kept, pa.binary())], names=["ref", "spans", "kept"])

    return rows.mapInArrow(run, StructType.fromDDL("ref long, spans array<struct<s:int,e:int>>, kept binary"))


# ---------------------------------------------------------------- whole job

def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: id, n_bytes, text_sha256 (binary), spans (byte ranges that go), kept (bytes left; null if all)."""
    v, cover = difference_cover(length)
    secret = new_secret()
    data = text_or_empty(text_col).cast("binary")
    hashed = docs.select(F.col(id_col).alias("id"), data.alias("bytes"), F.unhex(F.sha2(data, 256)).alias("sha"))
    hashed = hashed.withColumn("ref", F.xxhash64("id", "sha"))   # of a row, for the positions below
    rows = written(hashed.select("id", "ref", "sha", F.octet_length("bytes").cast("long").alias("n")))
    copies = written(rows.where(F.col("n") >= length).groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("c"))
                     .where("c > 1").select("sha", "first", F.lit(True).alias("again")))
    known = written(rows.join(copies, "sha", "left"))
    others = written(known.where("again AND NOT id <=> first").select("ref").distinct())
    total = rows.where(F.col("n") >= length).agg(F.sum("n")).first()[0] or 0

    # any row but the further copies
    texts = narrowed(hashed.where(F.octet_length("bytes") >= length).select("ref", "bytes"), "ref", others, "ref", anti=True)
    bits = _bits(total * len(cover) / v)
    ranked = written(_repeated(_deal(texts, bits, False, _choose_samples(length, secret)), bits))
    held = narrowed(texts, "ref", ranked.select("ref"), "ref", exact=False)
    held = written(held.join(ranked, "ref").dropDuplicates(["ref"]).select("ref", "bytes", F.col("places").alias("ranked")))
    size = held.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    bits = _bits(size * len(cover) / v)
    settled = written(_repeated(_deal(held, bits, True, _choose_long(length, secret)), bits))
    held = held.join(settled.withColumnRenamed("places", "settled"), "ref", "left")
    bits = _bits(size)
    last = written(_repeated(_deal(held, bits, True, _choose_rest(length, secret)), bits))
    marked = held.join(last.withColumnRenamed("places", "repeated"), "ref", "left") \
        .where("settled IS NOT NULL OR repeated IS NOT NULL").select("ref", "bytes", "settled", "repeated")
    cut = _cut(marked, length)

    out = known.join(cut, "ref", "left")
    whole = F.array(F.struct(F.lit(0).alias("s"), F.col("n").cast("int").alias("e")))
    none = F.array().cast("array<struct<s:int,e:int>>")
    gone = F.coalesce("again", F.lit(False))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_bytes"), F.col("sha").alias("text_sha256"),
        F.when(gone, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256."""
    d = repeats(docs, id_col, text_col, length)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return d.select(id_col, "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                    F.when(F.col("kept").isNull(), F.lower(F.hex("text_sha256"))).otherwise(F.sha2("kept", 256)).alias("kept_sha256"))
