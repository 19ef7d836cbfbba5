from __future__ import annotations

import random
import struct
from hashlib import sha256

import public_tokenizers
import pytest
import tiktoken
from helpers import ODD_TEXTS, documents

from tidemart.llm import byte_bpe
from tidemart.llm.queries import BYTE_RANKS, byte_bpe_round_trip

PATH, PATTERN = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def encoder(ranks):
    return byte_bpe.Encoder(ranks, byte_bpe.MergeTable(ranks), PATTERN, byte_bpe.class_stand_ins(PATTERN))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(encoder, text):
    data = encoder.encode(text)
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def test_random_texts_equal_the_library(encoder, library, ranks):
    rng, tokens = random.Random(3), list(ranks)
    texts = [b"".join(rng.choices(tokens, k=rng.randint(1, 8))).decode("utf-8", "replace") for _ in range(4000)]
    texts += ["".join(rng.choices("aeinorst '\n1é", k=rng.randint(1, 80))) for _ in range(4000)]
    for text in texts:
        assert ids(encoder, text) == library.encode_ordinary(text)


def test_every_token_and_every_pair_kind(encoder, library, ranks):
    for token in ranks:
        text = token.decode("utf-8", "replace")
        assert ids(encoder, text) == library.encode_ordinary(text)


def test_code_points_of_other_unicode_versions(encoder, library):
    rng = random.Random(5)
    codes = list(encoder.stand_ins) + [rng.randrange(0x80, 0xD800) for _ in range(2000)]
    for code in codes[::5]:
        for text in (f"a{chr(code)}b", f"1{chr(code)}2 {chr(code)}", f"!{chr(code)}{chr(code)} ?"):
            assert ids(encoder, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 20_000, " " * 20_000 + "x", "é" * 9_000 + "!" * 9_000])
def test_one_piece_over_many_blocks(encoder, library, text):
    assert ids(encoder, text) == library.encode_ordinary(text)


def plain_merging(data, ranks):
    parts = [data[i:i + 1] for i in range(len(data))]
    while True:
        best = min(((ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks), default=None)
        if best is None:
            return parts
        parts[best[1]:best[1] + 2] = [b"".join(parts[best[1]:best[1] + 2])]


def test_backtracking_against_plain_merging():
    """Small trained vocabularies of three letters, in which longest matches are often wrong."""
    rng = random.Random(7)
    for _ in range(30):
        ranks = {bytes([b]): b for b in range(256)}
        while len(ranks) < 256 + 40:
            parts = plain_merging(bytes(rng.choices(b"abc", k=60)), ranks)
            i = rng.randrange(len(parts) - 1)
            ranks.setdefault(parts[i] + parts[i + 1], len(ranks))
        own = byte_bpe.Encoder(ranks, byte_bpe.MergeTable(ranks), r"(?s).+", {})
        for _ in range(200):
            data = bytes(rng.choices(b"abc", k=rng.randint(1, 60)))
            assert own.merged(data).tolist() == [ranks[p] for p in plain_merging(data, ranks)]


def test_a_vocabulary_that_merges_do_not_build_is_refused():
    ranks = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError, match="256"):
        byte_bpe.MergeTable(ranks | {b"abc": 256})
    with pytest.raises(ValueError, match="single bytes"):
        byte_bpe.MergeTable({b"a": 0})
    with pytest.raises(ValueError, match="repeat"):
        byte_bpe.MergeTable(ranks | {b"ab": 7})


def test_full_memories_change_nothing(ranks, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMORY", 7)
    small = byte_bpe.Encoder(ranks, byte_bpe.MergeTable(ranks), PATTERN, {})
    text = "The quick brown fox jumps over the lazy dog, again and again and again. " * 3
    assert ids(small, text) == library.encode_ordinary(text)


def test_frames(spark, library):
    texts = [*ODD_TEXTS, "same", "same", "x<|endoftext|>y", "word " * 60_000]
    docs = documents(spark, texts).selectExpr("*", "'x' AS ids", "1 AS n_tokens", "2 AS data")
    encoded = byte_bpe.encode_texts(docs.union(docs.where("doc_id = 3")), PATH, PATTERN)
    rows = byte_bpe.decode_ids(encoded, PATH).collect()
    assert sorted(r.doc_id for r in rows) == sorted([*range(len(texts)), 3])
    for r in rows:
        expected = library.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, bytes(r.ids)) == (len(expected), struct.pack(f"<{len(expected)}I", *expected))
        assert bytes(r.data) == (texts[r.doc_id] or "").encode()
    assert byte_bpe.decode_ids(byte_bpe.encode_texts(docs.limit(0), PATH, PATTERN), PATH).count() == 0


def test_null_ids_and_unknown_ids(spark):
    frame = spark.createDataFrame([(1, 0, None), (None, 0, b"")], "doc_id long, n_tokens long, ids binary")
    assert [bytes(r.data) for r in byte_bpe.decode_ids(frame, PATH).collect()] == [b"", b""]
    with pytest.raises(Exception, match="4294967295"):
        byte_bpe.decode_ids(spark.createDataFrame([(1, 1, b"\xff" * 4)], frame.schema), PATH).collect()


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = byte_bpe_round_trip(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        expected = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(expected)
        assert r.ids_sha256 == sha256(struct.pack(f"<{len(expected)}I", *expected)).hexdigest()
        assert r.decoded_sha256 == sha256(texts[r.doc_id].encode()).hexdigest()
