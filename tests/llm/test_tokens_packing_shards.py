"""Token counts, packing and sharding against the tokenizer libraries and brute force."""

import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from helpers import AWKWARD, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from telemill.llm import packing, queries, sharding, tokens

MODEL = P.path("piece_bpe_32k.model")
PIECES = sentencepiece.SentencePieceProcessor(model_file=MODEL)
BPE = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
ODD = st.text(alphabet=st.sampled_from(list("ab .,'19\n\t\r\x0b\x1c\x85\xa0▁éß東🙂s") + [" "]), max_size=60)


@pytest.fixture(scope="module")
def library():
    return PIECES, BPE


@given(ODD)
@settings(max_examples=400, deadline=None)
def test_any_text_counts_like_the_library(text):
    assert tokens.count(text, MODEL) == len(PIECES.encode(text))


@given(ODD)
@settings(max_examples=400, deadline=None)
def test_any_text_encodes_like_the_library(text):
    ids = BPE.encode(text, add_special_tokens=False).ids
    assert packing.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_whole_tokens_are_proven():
    sp, pattern, whole = tokens.proven(MODEL)
    assert len(whole) > 30_000
    assert all(n == 1 for n in whole.values())


def test_counts_of_awkward_and_real_texts(spark, small, library):
    real = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    texts = AWKWARD + real
    got = {r.doc_id: r for r in tokens.token_counts(documents(spark, texts), MODEL).collect()}
    for i, t in enumerate(texts):
        n = len(library[0].encode(t or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 4096)


def test_empty_table(spark):
    empty = documents(spark, ["a"]).limit(0)
    assert tokens.token_counts(empty, MODEL).count() == 0
    assert packing.pack(empty).count() == 0
    assert sharding.shard(empty, 4).count() == 0


def one_by_one(lengths, capacity):
    """Best fit decreasing with a plain list of bins."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(bins) if room >= n]
        if fits:
            room, i = min(fits)
            bins[i] = room - n
        else:
            bins.append(capacity - n)
    return Counter(bins)


@given(st.lists(st.integers(1, 40), max_size=120))
@settings(max_examples=300, deadline=None)
def test_plan_is_best_fit_decreasing(lengths):
    capacity = 40
    histogram = Counter(lengths)
    entries, bins = packing.plan(histogram, capacity)
    room, taken = defaultdict(lambda: capacity), Counter()
    for length, lo, hi, first, each, offset in entries:
        for k in range(hi - lo):
            assert capacity - room[first + k // each] == offset + k % each * length
            room[first + k // each] -= length
        taken[length] += hi - lo
    assert taken == histogram and len(room) == bins
    assert Counter(room.values()) == one_by_one(lengths, capacity)


def check_packed(rows, ids_by_doc, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(ids_by_doc)
    for doc, ids in ids_by_doc.items():
        parts = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert sum(r.length for r in parts) == len(ids)
        assert all(r.length == capacity for r in parts[1:])
        for r in parts:
            own = ids[r.start : r.start + r.length]
            assert zlib.crc32(struct.pack(f"<{len(own)}I", *own)) == r.ids_crc32
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    histogram = Counter(r.length for r in rows)
    assert len(by_seq) == packing.plan(histogram, capacity)[1]


def test_pack_awkward_and_real_texts(spark, small, library):
    texts = AWKWARD + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    packed = packing.pack(documents(spark, texts), with_ids=True).cache()
    ids = {i: library[1].encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    check_packed(packed.collect(), ids, packing.CAPACITY)
    sequences = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert sequences[r.sequence_id][r.offset : r.offset + r.length] == ids[r.doc_id][r.start : r.start + r.length]


def test_pack_splits_hot_lengths_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_SALT", 7)
    rows = packing.pack(documents(spark, ["same text"] * 50 + ["other"], [1] * 50 + [2]), capacity=8).collect()
    assert Counter(r.doc_id for r in rows) == {1: 50, 2: 1}
    assert len({(r.sequence_id, r.offset) for r in rows}) == 51


@given(st.integers(1, 5000), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_permutation_is_a_bijection(n, seed):
    p = sharding.Permutation(n, seed)
    there = p.forward(np.arange(n))
    assert (np.sort(there) == np.arange(n)).all()
    assert (p.backward(there) == np.arange(n)).all()
    shard, slot = sharding.locate(n - 1, n, 7, seed)
    assert sharding.row_at(shard, slot, n, 7, seed) == n - 1


def test_shards_are_even_gapless_and_reproducible(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 10)
    texts = [*AWKWARD, *["copy"] * 101]
    docs = documents(spark, texts, [*range(len(AWKWARD)), *[99] * 101])
    rows = sharding.shard(docs, 8).collect()
    assert Counter(r.text for r in rows) == Counter(texts)
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    again = sharding.shard(docs.repartition(5), 8).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert sorted(map(str, rows)) != sorted(map(str, sharding.shard(docs, 8, seed=1).collect()))
    with pytest.raises(ValueError, match="shard"):
        sharding.shard(docs.withColumn("shard", F.lit(1)), 8)


def test_shard_and_slot_from_first_principles(spark, monkeypatch):
    """Numbers by bucket, hash and value, then one permutation, all in plain Python."""
    monkeypatch.setattr(sharding, "LEAST_BUCKETS", 2)
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 10)
    rows = [(i % 37, None if i % 11 == 0 else f"t{i % 23}") for i in range(300)]
    table = spark.createDataFrame(rows, "a long, b string")
    hashes = {(r.a, r.b): r.h for r in table.select("a", "b", F.xxhash64("a", "b").alias("h")).distinct().collect()}
    buckets = sharding.buckets_for(300)
    assert buckets == 32 and sharding.buckets_for(0) == 2 and sharding.buckets_for(321) == 64
    order = sorted(rows, key=lambda r: (hashes[r] % buckets, hashes[r], (r[0], r[1] is not None, r[1] or "")))
    expect = Counter((r, *sharding.locate(k, 300, 7, 3)) for k, r in enumerate(order))
    got = Counter(((r.a, r.b), r.shard, r.slot) for r in sharding.shard(table, 7, seed=3).collect())
    assert got == expect


def test_any_column_name_comes_back_unchanged(spark):
    names = ["number", "bucket", "first", "n", "copy", "chunk", "row", "hash", "place", "base", "total", "__p", "__n", "a.b", "a`b"]
    rows = [tuple(f"{c}{i % 3}" for c in names) for i in range(9)]
    out = sharding.shard(spark.createDataFrame(rows, names), 4)
    assert out.columns == [*names, "shard", "slot"]
    assert Counter(tuple(r)[: len(names)] for r in out.collect()) == Counter(rows)


def test_queries(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    rows = queries.op4_feistel_shards(spark, small).collect()
    expect = Counter((d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expect
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    assert queries.op9_whole_token_counts(spark, small).count() == len(docs)
    assert len({r.doc_id for r in queries.op2_best_fit_packing(spark, small).collect()}) == len(docs)
