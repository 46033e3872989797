"""BPE against the public library, and exact round trips."""
from __future__ import annotations

import hashlib
import random

import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from tickgate.llm import bpe  # noqa: E402

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def _texts():
    rng = random.Random(3)
    letters = "aaabcdeéèüßñ  \n\t'.,!?0123456789ththeringЖ中🙂́\x00"
    out = ["", " ", "\n\n \n x", "don't we'll I'M", "<|endoftext|>", "a" * 5000, "ab" * 3000, "🙂" * 500, " " * 700,
           "é" * 999 + "x"]
    return out + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 400))) for _ in range(300)]


def test_ids_equal_the_library(library):
    codec = bpe.Codec.of(PATH, P.PATTERN)
    for t in _texts():
        assert codec.encode(t).tolist() == library.encode_ordinary(t), repr(t[:60])


def test_trees_of_many_pieces_equal_single_ones():
    ranks = bpe.load_ranks(PATH)
    pairs = bpe.Pairs(ranks)
    rng = random.Random(9)
    pieces = [bytes(rng.choice([rng.randrange(256), 97, 101, 32]) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 16, 17, 60])))
              for _ in range(1500)] + [b"", b"a" * 64, b"ab" * 31, b"the", b"x" * 3000]
    assert bpe.merge_pieces(pieces, ranks, pairs) == [bpe.packed(bpe.merge_piece(p, ranks)) for p in pieces]


def test_full_memo_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 7)
    codec = bpe.Codec(PATH, P.PATTERN)
    texts = _texts()
    for part in (texts[:40], texts[20:60], texts[:40]):
        assert [x.tolist() for x in codec.encode_all(part)] == [library.encode_ordinary(t) for t in part]
    assert len(codec.young) <= 7 and len(codec.old) <= 7


def test_ties_take_the_leftmost_pair():
    ranks = {b"a": 0, b"aa": 1, b"aaaa": 2}
    assert bpe.merge_piece(b"aaa", ranks) == [1, 0]
    assert bpe.merge_piece(b"aaaaa", ranks) == [2, 0]


def test_query_columns_and_edges(spark, library):
    texts = _texts()[:40] + [None]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(0, texts[0], "clash"), (None, "x", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    got = bpe.digests(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        t = (texts[r.doc_id] if r.doc_id is not None else "x") or ""
        ids = library.encode_ordinary(t)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert bpe.digests(docs.limit(0)).count() == 0


def test_decode_takes_null_lists_and_refuses_unknown_ids(spark):
    t = spark.createDataFrame([(1, None), (2, [])], "doc_id long, token_ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(t).collect()] == [b"", b""]
    bad = spark.createDataFrame([(1, [10 ** 6])], "doc_id long, token_ids array<int>")
    with pytest.raises(Exception):
        bpe.decode(bad).collect()
