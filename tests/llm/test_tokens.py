"""Packing, token files and SentencePiece ids against the libraries themselves."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sparkmart.llm import packing, piece_rounds, queries, token_ids, wavelet
from tests.conftest import SF

ALPHABET = list("aab  \n\t'sdé漢ß1203.,!<|▁ ́ x🙂") + ["the", "ing", " the", "<|endoftext|>", "</s>", "   ", "'re", "end.\nÉt"]


def noise(n, seed=1):
    pick = random.Random(seed)
    return ["".join(pick.choices(ALPHABET, k=pick.randint(0, 40))) for _ in range(n)]


def library(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name, spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_equal_the_library(name, spaces):
    texts, encode = noise(1500), library(name)
    encoder = token_ids.TokenIds(public_tokenizers.path(name), spaces, limit=300)  # a store that overflows
    for at in range(0, len(texts), 250):
        part = texts[at : at + 250]
        ids, offsets = encoder.encode(pa.array(part, pa.large_string()))
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [encode(t) for t in part]


def test_merge_rounds_equal_the_library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, encoder, texts = sentencepiece.SentencePieceProcessor(model_file=path), piece_rounds.PieceIds(path, 300), noise(1500, 2)
    texts += ["thethethe aaaa", "   ", " a", "a ", "▁▁a", ""]
    ids, offsets = encoder.encode(pa.array(texts, pa.large_string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [model.encode(t) for t in texts]


def test_wavelet_shard():
    ids = np.random.default_rng(0).integers(0, 50, 600_000).astype(np.uint32)
    shard = wavelet.WaveletMatrix(wavelet.build_shard(ids, [3, None], np.array([599_990, 10]), 16))
    assert (shard.all_ids() == ids).all() and shard.doc_ids == [3, None]
    where = np.flatnonzero(ids == 7)
    assert [shard.access(k) for k in (0, 262_143, 262_144, 599_999)] == [ids[k] for k in (0, 262_143, 262_144, 599_999)]
    assert shard.count(7) == len(where) and shard.count(7, 5, 300_000) == ((where >= 5) & (where < 300_000)).sum()
    assert [shard.occurrence(7, k) for k in (0, 100, len(where) - 1)] == where[[0, 100, -1]].tolist()
    assert shard.count(1 << 20) == 0
    empty = wavelet.WaveletMatrix(wavelet.build_shard(ids[:0], [], np.zeros(0), 16))
    assert len(empty.all_ids()) == 0 and empty.count(1) == 0


def test_op4_against_the_library(spark):
    encode, start = library("byte_bpe_50k.json"), 0
    got = {r["doc_id"]: r for r in queries.op4_token_output(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(encode(r["text"]) + [2], "<u4")
        row = got[r["doc_id"]]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op2_pieces_are_whole_and_dense(spark):
    encode, rows = library("word_bpe_49k.json"), queries.op2_packing(spark, SF).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids, at = np.array(encode(r["text"]) + [2], "<u4"), 0
        for p in sorted(by_doc[r["doc_id"]], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 4096
    assert sum(r["length"] for r in rows) > 0.95 * 4096 * len(by_sequence)


def test_first_fit_decreasing():
    lengths = np.random.default_rng(3).integers(1, 100, 300)
    place, room, want = packing.first_fit_decreasing(lengths, 100), [100] * 300, {}
    for k in np.argsort(-lengths, kind="stable"):
        want[k] = next(b for b, r in enumerate(room) if r >= lengths[k])
        room[want[k]] -= lengths[k]
    assert place.tolist() == [want[k] for k in range(300)]


def test_odd_rows(spark, odd_docs):
    for make, key in (
        (lambda d: packing.pack(d, public_tokenizers.path("word_bpe_49k.json")), "length"),
        (lambda d: wavelet.token_output(spark, d, public_tokenizers.path("byte_bpe_50k.json")), "n_tokens"),
        (lambda d: piece_rounds.encode_pieces(d, public_tokenizers.path("piece_bpe_32k.model")), "n_tokens"),
    ):
        rows = make(odd_docs).collect()
        assert {r["doc_id"] for r in rows} == {None, 0, 1, 2, 3, 4, 5}
        assert sum(r["doc_id"] == 4 for r in rows) == 2
        assert len({r[key] for r in rows if r["doc_id"] in (1, 2)}) == 1
        assert make(odd_docs.limit(0)).count() == 0
