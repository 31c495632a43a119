"""Alignment against sets of ends and counters, byte-level BPE against the library and itself."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from helpers import AWKWARD, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from telemill.llm import align, bytebpe, queries

RANKS, MULTI, PIECES = (P.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"))
BPE = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
BPE.encode_special_tokens = True
SP = sentencepiece.SentencePieceProcessor(model_file=PIECES)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bytebpe.read_ranks(MULTI), special_tokens={})
# Among them letters and numbers that Unicode versions differ on.
ODD = st.text(alphabet=st.sampled_from([*"ab .,'19\n\t\r\x0b\x1c\x85\xa0▁éß東🙂s한Ж\0<>", "՘", "Ᲊ", "\U0003134a", "\U0001246f"]), max_size=60)
DENSE = st.text(alphabet="abe ", max_size=80)


def shared(column_a, column_b, size_a, size_b):
    """Groups as pairs of id lists, from the sets of ends."""
    at_a, at_b = np.cumsum([size_a[i] for i in column_a]).tolist(), np.cumsum([size_b[i] for i in column_b]).tolist()
    group_of = {e: k for k, e in enumerate(sorted(set(at_a) & set(at_b)))}
    groups = [([], []) for _ in group_of]
    for side, (ids, ends) in enumerate(((column_a, at_a), (column_b, at_b))):
        k = 0
        for i, e in zip(ids, ends):
            groups[k][side].append(i)
            k += e in group_of
    return groups


def brute(texts):
    own = align.pair_of(RANKS, P.PATTERN, PIECES)
    rows, counts = [], Counter()
    for t in texts:
        a, b = (BPE.encode(" " + t, add_special_tokens=False).ids, SP.encode(t)) if t else ([], [])
        joined = b"".join(own.sides[1].bytes[i] for i in b)
        if not t or joined != (" " + t).encode():
            a, b = [], []
        groups = shared(a, b, own.sizes[0], own.sizes[1])
        links = Counter()
        for x, y in groups:
            for (i, n), (j, m) in ((p, q) for p in Counter(x).items() for q in Counter(y).items()):
                links[i, j] += n * m
        rows.append((a, b, groups, links))
        counts.update(set(links))
    best = defaultdict(int)
    for (i, _), c in counts.items():
        best[i] = max(best[i], c)
    for a, b, groups, links in rows:
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (
            len(a), len(b), len(groups), sum(links.values()), sum(n for k, n in links.items() if counts[k] == best[k[0]]),
            sum(n * counts[k] for k, n in links.items()), hashlib.sha256(written.encode()).hexdigest() if a else "",
        )


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_equals_brute_force(spark, small, monkeypatch):
    texts = AWKWARD + [" " * 5000, "a" * 3000 + "東" * 500, "\x00 nul", "x" + " " * 37 + "y"] + [
        r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()
    ]
    expect = list(brute(texts))
    docs = documents(spark, texts).withColumn("keys", F.lit(1)).withColumn("block", F.lit("x"))
    rows = align.align(docs.repartition(3), RANKS, P.PATTERN, PIECES).collect()
    assert {r.doc_id: tuple(r[f] for f in FIELDS) for r in rows} == dict(enumerate(expect))
    assert len(rows) == len(texts)


def test_repeated_rows_and_null_ids_are_aligned_each(spark):
    texts = ["same text here"] * 40 + [None, "other"]
    rows = align.align(documents(spark, texts, [*[7] * 40, None, None]), RANKS, P.PATTERN, PIECES).collect()
    expect = list(brute(texts))
    assert Counter((r.doc_id, *(r[f] for f in FIELDS)) for r in rows) == Counter((i, *e) for i, e in zip([*[7] * 40, None, None], expect))


@given(st.lists(st.integers(1, 3), max_size=200), st.lists(st.integers(1, 3), max_size=200))
@settings(max_examples=300, deadline=None)
def test_stretches_cut_where_both_end(x, y):
    a, b = np.cumsum(x).tolist(), np.cumsum(y).tolist()
    top = max([0, *a, *b]) + 1
    a, b = [*a, top], [*b, top]
    cuts, i, j = [], 0, 0
    for p, q, n, m, single in align.stretches(a, b):
        assert (p, q) == (i, j) and (not single or n == m)
        cuts += a[p : p + n] if single else [a[p + n - 1]]
        if single:
            assert a[p : p + n] == b[q : q + m]
        i, j = p + n, q + m
    assert cuts == sorted(set(a) & set(b)) and (i, j) == (len(a), len(b))


def test_runs_are_jumped():
    class Looked(list):
        seen = 0

        def __getitem__(self, k):
            self.seen += 1
            return super().__getitem__(k)

    a = Looked(range(1, 100_001))
    assert align.run_length(a, 0, list(a), 0) == 100_000
    assert a.seen < 60


def test_short_runs_take_one_look():
    class Looked(list):
        seen = 0

        def __getitem__(self, k):
            self.seen += 1
            return super().__getitem__(k)

    for n in range(align.NEAR):
        a, b = Looked([*range(n), 50, 60, 70]), [*range(n), 55, 60, 70]
        assert align.run_length(a, 0, b, 0) == n and a.seen == 1
    for n in range(40):
        assert align.run_length([*range(n), 50], 0, [*range(n), 55, 60], 0) == n == align.run_length([*range(n)], 0, [*range(n)], 0)


def test_sides_give_arrays_and_no_special_tokens():
    own = align.pair_of(RANKS, P.PATTERN, PIECES)
    for text in ("", " a", "x" + "▁" * 5 + " <s></s><unk><|endoftext|>", "東京 1 2\n"):
        for side, want in zip(own.sides, (BPE.encode(text, add_special_tokens=False).ids, SP.encode(text))):
            found = side.ids(text)
            assert isinstance(found, np.ndarray) and found.tolist() == want and (found < len(side.bytes)).all()


def test_groups_are_written_in_order():
    own = align.pair_of(RANKS, P.PATTERN, PIECES)
    for text in ("one two, three", "東京" * 40 + " x", "a"):
        a, b = BPE.encode(" " + text, add_special_tokens=False).ids, SP.encode(text)
        groups = shared(a, b, own.sizes[0], own.sizes[1])
        assert align.links(own, text)[5] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


@given(ODD)
@settings(max_examples=400, deadline=None)
def test_both_sides_encode_like_their_libraries(text):
    own = align.pair_of(RANKS, P.PATTERN, PIECES)
    assert own.sides[0].encode(" " + text) == BPE.encode(" " + text, add_special_tokens=False).ids
    assert own.sides[1].encode(text) == SP.encode(text)


@given(st.one_of(ODD, DENSE))
@settings(max_examples=600, deadline=None)
def test_any_text_encodes_like_tiktoken_and_decodes(text):
    own = bytebpe.encoder(MULTI)
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


@given(st.binary(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_bytes_are_merged_exactly(piece):
    codec = bytebpe.encoder(MULTI).codec
    if piece and piece not in codec.ranks:
        assert [codec.tokens[i] for i in codec.encode_piece(piece)] == bytebpe.merged(piece, codec.ranks)


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), max_size=40), st.text(alphabet="abc", min_size=1, max_size=60))
@settings(max_examples=400, deadline=None)
def test_any_merge_table_is_followed(merges, text):
    ranks = {bytes([b]): b for b in range(256)}
    known = [b"a", b"b", b"c"]
    for i, j in merges:  # a table in which every token is a merge of earlier ones
        both = known[i % len(known)] + known[j % len(known)]
        if len(both) <= 24 and both not in ranks and bytebpe.merged(both, ranks) == [known[i % len(known)], known[j % len(known)]]:
            ranks[both] = len(ranks)
            known.append(both)
    piece = text.encode()
    own = tiktoken.Encoding("t", pat_str="[abc]+", mergeable_ranks=ranks, special_tokens={})
    assert bytebpe.Codec(ranks).encode_piece(piece) == own.encode_ordinary(text)


def test_long_pieces_take_linear_time():
    codec = bytebpe.encoder(MULTI).codec
    judged = len(codec._agree)
    for piece in (b"a" * 200_000, b" " * 200_000, "東京".encode() * 30_000):
        assert codec.decode(np.array(codec.encode_piece(piece))) == piece
    assert len(codec._agree) - judged < 1000


def test_bad_tables_are_refused():
    with pytest.raises(ValueError, match="single byte"):
        bytebpe.Codec({b"a": 0})
    with pytest.raises(ValueError, match="gaps"):
        bytebpe.Codec({bytes([b]): 2 * b for b in range(256)})


def test_codec_on_tables(spark, small):
    texts = [*AWKWARD, *AWKWARD[-3:], *[r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]]
    ids = [None, *range(1, len(texts))]
    docs = documents(spark, texts, ids).withColumn("ids", F.lit(0)).withColumn("decoded", F.lit("x"))
    rows = {r.doc_id: r for r in bytebpe.decode(bytebpe.encode(docs, MULTI), MULTI).collect()}
    assert len(rows) == len(texts)
    for i, t in zip(ids, texts):
        expect = LIBRARY.encode_ordinary(t or "")
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == expect and rows[i].n_tokens == len(expect)
        assert bytes(rows[i].decoded) == (t or "").encode()


def test_empty_tables(spark):
    empty = documents(spark, ["a"]).limit(0)
    assert bytebpe.decode(bytebpe.encode(empty, MULTI), MULTI).count() == 0
    assert align.align(empty, RANKS, P.PATTERN, PIECES).count() == 0
    assert align.align(documents(spark, [None, "", "▁"]), RANKS, P.PATTERN, PIECES).select("n_a", "groups_sha256").collect() == [(0, "")] * 3


def test_queries(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in queries.op13_backtracking_bpe(spark, small).collect()}
    for d in docs:
        ids = np.array(LIBRARY.encode_ordinary(d.text or ""), "<u4")
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
    expect = dict(zip([d.doc_id for d in docs], brute([d.text for d in docs])))
    got = queries.op12_run_skipping_alignment(spark, small)
    assert {r.doc_id: tuple(r[f] for f in FIELDS) for r in got.collect()} == expect
