"""Near duplicates and the language model against brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telemill.llm import jaccard, lm, queries


def brute(texts):
    """(class by row, links by row) of texts whose ids are their places."""
    sets = [frozenset(jaccard.shingles(t or "").tolist()) for t in texts]
    root, links = list(range(len(texts))), [0] * len(texts)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both) and both:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))], links


def near_copies(n, words=60, seed=3):
    r = random.Random(seed)
    origin = [f"w{r.randrange(5000)}" for _ in range(words)]
    out = []
    for k in range(n):
        copy = list(origin)
        if k:
            copy[r.randrange(words)] = f"new{k}"
        out.append(" ".join(copy))
    return out


def judged(docs):
    return {r.doc_id: (r.class_id, r.links) for r in jaccard.join(docs).collect()}


def test_join_awkward_texts(spark):
    texts = AWKWARD + near_copies(12) + near_copies(3, 8) + ["one two three", "One, two THREE!", "three two one", None, ""]
    classes, links = brute(texts)
    assert judged(documents(spark, texts)) == dict(enumerate(zip(classes, links)))


def test_join_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard.tiled, "__defaults__", (7, 20))  # members of a block, rows of a bundle
    texts = near_copies(60) + near_copies(25, 200, 9) + ["copy of the same few words " * 3] * 30 + [f"other text {i} " * 5 for i in range(20)]
    classes, links = brute(texts)
    assert judged(documents(spark, texts)) == dict(enumerate(zip(classes, links)))


def test_join_real_documents(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    classes, links = brute([texts[i] for i in sorted(texts)])
    rows = {r.doc_id: (r.class_id, r.links) for r in queries.op3_ngram_jaccard(spark, small).collect()}
    assert rows == dict(enumerate(zip(classes, links)))


def test_join_empty(spark):
    assert jaccard.join(documents(spark, ["a"]).limit(0)).count() == 0


def test_classes_that_share_an_id_stay_apart(spark):
    texts = [" ".join(f"{w}{i}" for i in range(12)) for w in ("alpha", "one", "red")]
    docs = documents(spark, texts, [5, 5, 6])
    assert sorted(r.text for r in jaccard.deduplicated(docs).collect()) == sorted(texts)
    rows = jaccard.join(docs).collect()
    assert [r.links for r in rows] == [0, 0, 0] and len({r.class_row for r in rows}) == 3


def test_null_ids_lose_no_document(spark):
    same = "a b c d e f g h i j k"
    docs = documents(spark, [same, same, None, "x"], [None, 1, None, None])
    rows = jaccard.deduplicated(docs).collect()
    assert sorted((r.text or "", r.doc_id or 0) for r in rows) == [("", 0), (same, 1), ("x", 0)]
    named = {(r.doc_id, r.links): r.class_id for r in jaccard.join(docs).collect()}
    assert named[1, 1] == named[None, 1] == 1


def test_deduplicated_keeps_clashing_columns(spark):
    docs = documents(spark, ["a b c d e f g"] * 3 + ["x"]).withColumns({c: F.lit(c) for c in ("__text", "id", "document", "row", "fp", "hash", "__keep")})
    rows = jaccard.deduplicated(docs).collect()
    assert len(rows) == 2 and all(r["__text"] == "__text" and r["document"] == "document" and r["id"] == "id" for r in rows)


def test_deduplicated_keeps_one_of_each_class(spark):
    texts = AWKWARD + near_copies(5) + ["same words again and again now"] * 4
    ids = [*range(len(AWKWARD) + 5), 90, 90, 90, 91]
    docs = documents(spark, [*texts, None, None], [*ids, 95, 95]).withColumnRenamed("lang", "class_id")
    rows = jaccard.deduplicated(docs).collect()
    kept = Counter(r.doc_id for r in rows)
    classes, _ = brute(texts)
    wordless = {i for i, t in enumerate(texts) if not len(jaccard.shingles(t or ""))}
    assert kept == Counter([ids[c] for c in {classes[i] for i in range(len(texts)) if i not in wordless}] + [ids[i] for i in wordless] + [95, 95])
    assert set(rows[0].asDict()) == set(docs.columns)


def test_enough_is_the_posterior_bound():
    t, draws = 0.8, np.random.default_rng(0)
    for n in (16, 48, 96):
        m = jaccard.enough(n, t, 1e-2)
        tail = lambda k: (draws.beta(k + 1, n - k + 1, 400_000) >= t).mean()
        assert tail(m) >= 0.9e-2 and tail(m - 1) <= 1.1e-2


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
@settings(max_examples=200, deadline=None)
def test_roots(pairs):
    a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    got, root = jaccard.roots(31, a, b), list(range(31))
    for _ in range(31):
        for x, y in pairs:
            root[x] = root[y] = min(root[x], root[y])
    assert got.tolist() == root


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200)]
    random.Random(1).shuffle(edges)
    got = {r.row: r.root for r in jaccard.components(spark.createDataFrame(edges, "row long, root long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200, 202: 200}


def test_overlaps_in_chunks():
    sets = [np.unique(np.random.default_rng(k).integers(0, 60, 30)).astype(np.uint64) for k in range(9)]
    got = jaccard.overlaps(sets, cells=30)
    for i in range(9):
        for j in range(9):
            if i != j:
                assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + ["\n"]


def brute_model(texts, folds):
    single, pair, held = Counter(), Counter(), Counter()
    main1, main2 = Counter(), Counter()
    for t, f in zip(texts, folds):
        w = words(t)
        both = list(zip(["\n", *w], w))
        if f:
            single.update(w)
            pair.update(both)
        if f == 2:
            main1.update(w)
            main2.update(both)
        if f == 1:
            held.update(both)
    n, v, n_main = sum(single.values()), len(single), sum(main1.values())
    cells = Counter()
    for (a, b), times in held.items():
        ratio = lambda p: round(lm.GRID * math.log2(p * (v + 1))) if p else -10_000
        cls = lm.frequency_class(np.array([main1[a]]))[0]
        cells[int(cls), ratio(main2[a, b] / main1[a] if main1[a] else 0), ratio(main1[b] / n_main if n_main else 0)] += times
    mix = lm.weights([(*k, c) for k, c in cells.items()])
    out = []
    for t in texts:
        w = words(t)
        total = 0.0
        for a, b in zip(["\n", *w], w):
            m = mix[lm.frequency_class(np.array([single[a]]))[0]]
            total += math.log10(m[0] * (pair[a, b] / single[a] if single[a] else 0) + m[1] * single[b] / max(n, 1) + m[2] / (v + 1))
        base = sum(math.log10((single[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        out.append((len(w), sum(single[x] > 0 for x in w), n, base, total))
    return out


@pytest.mark.parametrize("block", [lm.BLOCK, 3000])
def test_model_against_brute_force(spark, small, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK", block)
    monkeypatch.setattr(lm, "RANGE", 20_000)
    texts = AWKWARD + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(120).collect()] + ["A a\x0bA\x1ca É é"]
    folds = [i % 5 if i % 5 < 2 else 2 for i in range(len(texts))]
    docs = documents(spark, texts).repartition(3)
    fold = F.when(F.col("doc_id") % 5 < 2, F.col("doc_id") % 5).otherwise(2)
    rows = {r.doc_id: r for r in lm.lm_scores(docs, fold).collect()}
    for i, expect in enumerate(brute_model(texts, folds)):
        r = rows[i]
        assert (r.fold, r.n_tokens, r.n_known, r.train_tokens) == (folds[i], *expect[:3])
        assert math.isclose(r.base_score, expect[3], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r.score, expect[4], rel_tol=1e-6, abs_tol=1e-6)


def test_model_without_training_texts(spark):
    rows = lm.lm_scores(documents(spark, ["a b", None]), F.lit(0)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert lm.lm_scores(documents(spark, ["a"]).limit(0), F.lit(2)).count() == 0


def test_weights_maximise_the_held_out_likelihood():
    cells = [(3, 20, 4, 50), (3, -10_000, 8, 30), (3, -10_000, -10_000, 5), (0, -10_000, 3, 9)]
    mix = lm.weights(cells, steps=2000)
    likelihood = lambda m: sum(n * math.log((2 ** (a / 4) * (a > -999)) * m[0] + (2 ** (b / 4) * (b > -999)) * m[1] + m[2]) for c, a, b, n in cells if c == 3)
    best = likelihood(mix[3]) + sum(map(math.log, mix[3]))
    for shift in ((0.02, -0.02, 0), (0, 0.02, -0.02), (-0.02, 0, 0.02), (0.02, 0, -0.02)):
        m = np.array(mix[3]) + shift
        if (m > 0).all():
            assert likelihood(m) + sum(map(math.log, m)) <= best + 1e-9
    assert mix[0][0] == 0 and np.allclose(mix.sum(1), 1)


def test_query_shows_a_better_model_than_the_base(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op10_deleted_interpolation(spark, folder).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in rows)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
