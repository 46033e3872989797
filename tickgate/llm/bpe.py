"""Byte-level BPE encoding and decoding.

Each match of the split pattern is encoded by itself. Over its byte positions a segment tree
holds, at every inner node, the leftmost minimum pair rank below; the root names the next merge,
and a merge updates at most three leaves (the merged pair, its left neighbour, the vanished
position), each in logarithmic time. A piece that is a token as a whole takes that id, as the
public library does.

The trees of many pieces are worked on together, as rows of one matrix per width: each step merges
one pair of every row that still has one, and refreshes the three leaves of each row level by level.
The rank of a pair of ids comes from one sorted table of all pairs that make a token.

Pieces repeat, so their ids are kept in a per-process dictionary of bounded size, in two generations:
when the young one is full it becomes the old one, and pieces found there move on. It changes
no result. Decoding gathers the vocabulary's byte strings by id, a batch at a time.

Defined cases: null text is the empty text and has no ids; null ids decode to no bytes; ids
outside the vocabulary raise; any text that Arrow can hold round-trips to its UTF-8 bytes.
"""
from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tickgate.llm.common import ready

NONE = 1 << 62
MEMO = 200_000       # pieces kept per process and generation
MEMO_CHARS = 48      # longer pieces are not kept
OUT_ROWS = 1024      # rows per outgoing batch, and
OUT_CHARS = 1 << 20  # characters after which it ends
CELLS = 1 << 16      # leaves of a matrix of trees
FEW = 12             # fewer pieces of a width are merged one by one


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of 'base64 rank' lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    n = len(piece)
    if n == 0:
        return []
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    get = ranks.get
    after = list(range(1, n + 1))       # start of the next live part
    before = list(range(-1, n - 1))     # start of the previous live part
    width = 1 << (n - 1).bit_length()
    # leaf i: rank of the pair that starts at i, then i itself, so that a minimum is the leftmost
    tree = [NONE] * (2 * width)
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            tree[width + i] = r << 32 | i
    for i in range(width - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    def put(i: int, value: int) -> None:
        i += width
        tree[i] = value
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            low = a if a < b else b
            if tree[i] == low:
                break
            tree[i] = low
            i >>= 1

    while tree[1] != NONE:
        i = tree[1] & 0xFFFFFFFF
        gone = after[i]
        end = after[gone]
        after[i] = end
        put(gone, NONE)
        if end < n:
            before[end] = i
            r = get(piece[i:after[end]])
            put(i, NONE if r is None else r << 32 | i)
        else:
            put(i, NONE)
        left = before[i]
        if left >= 0:
            r = get(piece[left:end])
            put(left, NONE if r is None else r << 32 | left)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:after[i]]])
        i = after[i]
    return ids


class Pairs:
    """Rank of the token that two adjacent tokens make, for whole arrays of id pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np
        get = ranks.get
        found = [(a << 32 | b, rank) for token, rank in ranks.items() for i in range(1, len(token))
                 if (a := get(token[:i])) is not None and (b := get(token[i:])) is not None]
        found.sort()
        # an end mark, so that every search lands on an entry
        self.keys = np.array([k for k, _ in found] + [NONE], np.int64)
        self.ranks = np.array([r for _, r in found] + [-1], np.int64)
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)

    def leaf(self, left, right, at):
        """Tree leaves of pairs that start at ``at``; NONE where the two ids make no token or one is -1."""
        import numpy as np
        key = left << 32 | right
        place = np.searchsorted(self.keys, key)
        return np.where((self.keys[place] == key) & (left >= 0) & (right >= 0), self.ranks[place] << 32 | at, NONE)


def _merge_rows(pieces: list[bytes], width: int, pairs: Pairs) -> list[bytes]:
    """``packed`` ids of pieces of at most ``width`` (a power of two, 2 at least) bytes, their trees as rows of a matrix."""
    import numpy as np
    m = len(pieces)
    size = np.array([len(p) for p in pieces])
    # columns beyond a piece's end hold no token; so does one more, which stands for "no neighbour"
    ids = np.full((m, width + 1), -1, np.int64)
    inside = np.arange(width) < size[:, None]
    ids[:, :width][inside] = pairs.single[np.frombuffer(b"".join(pieces), np.uint8)]
    if (ids[:, :width][inside] < 0).any():
        raise ValueError("a byte of the text is no token")
    after = np.tile(np.arange(1, width + 2, dtype=np.int64), (m, 1))
    after[:, width] = width
    np.minimum(after, width, out=after)
    after[np.arange(m), size - 1] = width
    before = np.tile(np.arange(-1, width, dtype=np.int64), (m, 1))
    before[:, 0] = width
    live = inside.copy()
    tree = np.full((m, 2 * width), NONE, np.int64)
    tree[:, width:2 * width - 1] = pairs.leaf(ids[:, :width - 1], ids[:, 1:width], np.arange(width - 1))
    level = width
    while level > 1:
        level //= 2
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
    row = np.flatnonzero(tree[:, 1] != NONE)
    while len(row):
        low = tree[row, 1]
        i = low & 0xFFFFFFFF
        gone = after[row, i]
        end = after[row, gone]
        left = before[row, i]
        ids[row, i] = low >> 32
        live[row, gone] = False
        after[row, i] = end
        before[row, end] = i             # the column of "no neighbour" takes writes that nobody reads
        ids[row, gone] = -1
        me = ids[row, i]
        tree[row, width + gone] = NONE
        tree[row, width + i] = pairs.leaf(me, ids[row, end], i)
        at = np.minimum(left, width - 1)
        mine = left < width
        tree[row[mine], width + at[mine]] = pairs.leaf(ids[row, left], me, left)[mine]
        nodes = np.stack([width + i, width + gone, width + np.where(mine, at, i)])
        while nodes[0, 0] > 1:
            nodes >>= 1
            tree[row, nodes] = np.minimum(tree[row, 2 * nodes], tree[row, 2 * nodes + 1])
        row = row[tree[row, 1] != NONE]
    flat = ids[:, :width][live].astype(np.int32).tobytes()
    ends = (4 * np.cumsum(live.sum(1))).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def packed(ids: list[int]) -> bytes:
    """Ids as 32-bit integers: compact to keep, and quick to join."""
    return array("i", ids).tobytes()


def merge_pieces(pieces: list[bytes], ranks: dict[bytes, int], pairs: Pairs) -> list[bytes]:
    """``packed(merge_piece(...))`` of each piece; pieces of similar length share a matrix of trees."""
    out: list[bytes | None] = [None] * len(pieces)
    widths: dict[int, list[int]] = {}
    for k, p in enumerate(pieces):
        whole = ranks.get(p)
        if whole is not None or not p:
            out[k] = b"" if whole is None else packed([whole])
        else:
            widths.setdefault(max(2, 1 << (len(p) - 1).bit_length()), []).append(k)
    for width, at in widths.items():
        if len(at) < FEW or width * FEW > CELLS:
            for k in at:
                out[k] = packed(merge_piece(pieces[k], ranks))
            continue
        rows = CELLS // width
        for first in range(0, len(at), rows):
            part = at[first:first + rows]
            for k, ids in zip(part, _merge_rows([pieces[k] for k in part], width, pairs)):
                out[k] = ids
    return out


class Codec:
    """Encoder and decoder of one rank file; built once per Python worker."""

    _built: dict[tuple[str, str], "Codec"] = {}

    def __init__(self, path: str, pattern: str):
        import pyarrow as pa
        import regex
        self.ranks = load_ranks(path)
        self.split = regex.compile(pattern).findall
        self.pairs = Pairs(self.ranks)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        size = max(self.ranks.values(), default=-1) + 1
        words: list[bytes | None] = [None] * size
        for token, rank in self.ranks.items():
            words[rank] = token
        self.words = pa.array(words, pa.large_binary())

    @classmethod
    def of(cls, path: str, pattern: str) -> "Codec":
        key = (path, pattern)
        if key not in cls._built:
            cls._built[key] = cls(path, pattern)
        return cls._built[key]

    def _known(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of each piece."""
        known, missing = {}, []
        for p in pieces:
            ids = self.young.get(p)
            if ids is None:
                ids = self.old.get(p)
                if ids is None:
                    missing.append(p)
                    continue
                self._keep(p, ids)
            known[p] = ids
        for p, ids in zip(missing, merge_pieces([p.encode() for p in missing], self.ranks, self.pairs)):
            known[p] = ids
            if len(p) <= MEMO_CHARS:
                self._keep(p, ids)
        return known

    def _keep(self, piece: str, ids: bytes) -> None:
        if len(self.young) >= MEMO:
            self.old, self.young = self.young, {}
        self.young[piece] = ids

    def encode_all(self, texts: list[str | None]) -> list:
        """Ids of each text as an int32 array."""
        import numpy as np
        split = [self.split(t) if t else [] for t in texts]
        ids = self._known(set(chain.from_iterable(split))).__getitem__
        return [np.frombuffer(b"".join(map(ids, pieces)), np.int32) for pieces in split]

    def encode(self, text: str | None):
        """Ids of one text as an int32 array."""
        return self.encode_all([text])[0]

    def decode(self, ids):
        """Byte strings of a list array of ids, as a binary array."""
        import numpy as np
        import pyarrow as pa
        flat = ids.flatten()
        if flat.null_count:
            raise ValueError("null token id")
        parts = self.words.take(flat)
        if parts.null_count:
            raise ValueError("token id outside the vocabulary")
        ends = np.frombuffer(parts.buffers()[1], np.int64, len(flat) + 1, parts.offset * 8)
        counts = np.asarray(ids.value_lengths().fill_null(0), np.int64)
        offsets = ends[np.concatenate([[0], np.cumsum(counts)])]
        data = parts.buffers()[2]
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ids), [None, pa.py_buffer(np.ascontiguousarray(offsets)), data])


def _defaults(path: str | None, pattern: str | None) -> tuple[str, str]:
    if path is None or pattern is None:
        import public_tokenizers as P
        path, pattern = path or P.path("byte_bpe_multi_50k.tiktoken"), pattern or P.PATTERN
    return path, pattern


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           path: str | None = None, pattern: str | None = None) -> DataFrame:
    """id and ``token_ids`` (array of int) of every whole text.

    ``path`` names the rank file; like the installed vocabulary packages it is read on the executors.
    """
    ready(docs.sparkSession)
    path, pattern = _defaults(path, pattern)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for ids, tokens in _encoded(Codec.of(path, pattern), batches):
            yield pa.RecordBatch.from_arrays([ids, tokens], names=["id", "token_ids"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, StructType([
        StructField("id", src.schema["id"].dataType), *_ids_field()])).withColumnRenamed("id", id_col)


def _encoded(codec: Codec, batches: Iterator) -> Iterator:
    """(ids, lists of token ids) of each small part of the batches of (id, text)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    for batch in batches:
        sizes = np.cumsum([0 if n is None else n for n in pc.utf8_length(batch.column(1)).to_pylist()])
        at = 0
        while at < batch.num_rows:
            # rows up to the one that passes OUT_CHARS; a long text is a part of its own
            base = sizes[at - 1] if at else 0
            end = min(at + OUT_ROWS, max(at + 1, int(np.searchsorted(sizes, base + OUT_CHARS, "right"))))
            part = batch.slice(at, end - at)
            at = end
            found = codec.encode_all(part.column(1).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            values = np.concatenate([np.empty(0, np.int32), *found])
            yield part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _ids_field() -> StructType:
    return StructType.fromDDL("token_ids array<int>")


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "token_ids",
           path: str | None = None, pattern: str | None = None) -> DataFrame:
    """id, ``token_ids`` and ``decoded`` (the bytes that the ids stand for)."""
    ready(tokens.sparkSession)
    path, pattern = _defaults(path, pattern)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        codec = Codec.of(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                out = codec.decode(part.column(1)).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), out],
                                                 names=["id", "token_ids", "decoded"])

    src = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("token_ids"))
    schema = StructType([StructField("id", src.schema["id"].dataType), *_ids_field(),
                         StructField("decoded", BinaryType())])
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``decode(encode(docs))`` in one Python pass: id, ``token_ids``, ``decoded``."""
    ready(docs.sparkSession)
    path, pattern = _defaults(path, pattern)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        codec = Codec.of(path, pattern)
        for ids, tokens in _encoded(codec, batches):
            yield pa.RecordBatch.from_arrays([ids, tokens, codec.decode(tokens).cast(pa.binary())],
                                             names=["id", "token_ids", "decoded"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = StructType([src.schema["id"], *_ids_field(), StructField("decoded", BinaryType())])
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode, decode, and reduce both to digests: id, n_tokens, ids_sha256, decoded_sha256."""
    d = round_trip(docs, id_col, text_col, path, pattern)
    return d.select(
        id_col, F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
