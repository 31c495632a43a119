"""Alignment of two tokenizers' tokens by diagonal run skipping.

Both tokenizers cut the same bytes, a blank and the text. Groups are what lies between places
where tokens of both end. The ends of either side's tokens rise, so as long as groups hold one
token each, ends agree at a fixed shift between the two arrays: windows of doubling, then
halving length are compared at that shift and the whole run is jumped. Where it breaks, the side
that lags is moved on until both end together, and that irregular group sets the next shift.

Every pair of tokens of one group is a link. How many documents hold a pair linked is counted
corpus-wide: blocks of documents, written once, name each of their distinct pairs with a count,
the counts are added up by pair, and each block gets the totals of the pairs it named. So a
frequent pair is one row a block, no table of counts is broadcast, and documents move once.
Pairs of a group are made from its distinct ids, with their numbers.

Null and empty texts, and texts whose tokens don't give back the blank and the text, have no
tokens: zeros and empty groups. Repeated rows count and are aligned each by itself. An empty table
gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.bytebpe import read_ranks
from telemill.llm.common import arrow_schema, as_batch, per_worker, stored, texts
from telemill.llm.tokens import SPACE, proven

BLOCK = 16 << 20  # characters of text per block, about
LARGE = 4096  # links of a group from which on they are counted by distinct ids
NEAR = 8  # ends of a run that are compared one by one before windows are
SHIFT = 32  # a pair of ids as one number: the first above, the second below


class RankTokenizer:
    """Byte-level BPE by a file of ranks and a pattern."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        # The one special string is never allowed for; without any, the library would look for the empty one everywhere.
        own = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={SPACE * 2: len(ranks)})
        self.ids = partial(own.encode_to_numpy, disallowed_special=())
        self.bytes = sorted(ranks, key=ranks.get)

    def encode(self, text: str) -> list[int]:
        return self.ids(text).tolist()


class PieceTokenizer:
    """A sentence-piece model that leaves texts as they are, but for writing blanks as ``SPACE``, and puts a blank before them."""

    def __init__(self, path: str):
        sp, _, _ = proven(path)  # raises for a model that changes its input
        self.encode = sp.encode
        names = [(i, sp.id_to_piece(i)) for i in range(sp.get_piece_size())]
        self.bytes = [bytes([int(name[3:-1], 16)]) if sp.is_byte(i) else name.replace(SPACE, " ").encode() for i, name in names]

    def ids(self, text: str) -> np.ndarray:
        return np.fromiter(self.encode(text), np.int64)


class Pair:
    """Two tokenizers with the byte lengths and the written forms of their tokens."""

    def __init__(self, first: RankTokenizer, second: PieceTokenizer):
        self.sides = (first, second)
        self.sizes = [np.array(list(map(len, side.bytes)), np.int64) for side in self.sides]
        self.ids = max(map(len, self.sizes))
        self.written = np.array([f"{i}{mark}" for mark in ",|;" for i in range(self.ids)], np.bytes_)  # zeros fill up shorter ones

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both sides' ids and ends; none if either side's bytes aren't the blank and the text.

        Both sides' tokens are stretches of it in order, so lengths tell; the one thing that the
        second changes is its own sign for a blank.
        """
        if text and SPACE not in text:
            a, b = (side.ids(t).astype(np.int64) for side, t in zip(self.sides, (" " + text, text)))
            ends_a, ends_b = self.sizes[0][a].cumsum(), self.sizes[1][b].cumsum()
            size = len(text.encode()) + 1
            if ends_a[-1] == size and ends_b[-1] == size:
                return a, b, ends_a, ends_b
        return (np.zeros(0, np.int64),) * 4


def pair_of(ranks: str, pattern: str, pieces: str) -> Pair:
    return per_worker(("align", ranks, pattern, pieces), lambda: Pair(RankTokenizer(ranks, pattern), PieceTokenizer(pieces)))


def run_length(a: list[int], i: int, b: list[int], j: int) -> int:
    """How many ends agree one by one from (i, j) on, by exponential probing beyond the first few."""
    n, step = 0, NEAR
    for x, y in zip(a[i : i + NEAR], b[j : j + NEAR]):
        if x != y:
            return n
        n += 1
    while (window := a[i + n : i + n + step]) and window == b[j + n : j + n + step]:
        n += len(window)
        step *= 2
    while step > 1:
        step //= 2
        if (window := a[i + n : i + n + step]) and window == b[j + n : j + n + step]:
            n += len(window)
    return n


def stretches(a: list[int], b: list[int]) -> Iterator[tuple[int, int, int, int, bool]]:
    """(i, j, tokens of a, tokens of b, one to one) of two arrays of ends with the same last end.

    A one-to-one stretch is a group for each of its tokens, any other is one group.
    """
    i = j = 0
    while i < len(a):
        n = run_length(a, i, b, j) if a[i] == b[j] else 0
        if n:
            yield i, j, n, n, True
            i, j = i + n, j + n
        if i < len(a):
            p, q = i, j
            while a[p] != b[q]:
                if a[p] < b[q]:
                    p += 1
                else:
                    q += 1
            yield i, j, p + 1 - i, q + 1 - j, False
            i, j = p + 1, q + 1


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First tokens and numbers of tokens, of either side, of every group."""
    found = np.fromiter(chain.from_iterable(stretches(ends_a.tolist(), ends_b.tolist())), np.int64).reshape(-1, 5)
    i, j, n, m, single = found.T
    runs = np.where(single, n, 1)
    at = np.repeat(np.arange(len(runs)), runs)
    step = (np.arange(len(at)) - np.repeat(runs.cumsum() - runs, runs)) * single[at]
    return i[at] + step, j[at] + step, np.where(single, 1, n)[at], np.where(single, 1, m)[at]


def links(own: Pair, text: str) -> tuple[int, int, np.ndarray, np.ndarray, int, str]:
    """Numbers of tokens, distinct linked pairs (as one number each), their links, groups and the groups' text."""
    a, b, ends_a, ends_b = own.tokens(text)
    i, j, n, m = groups_of(ends_a, ends_b)
    codes = np.empty(len(a) + len(b), np.int64)  # tokens with the mark that follows, in the order of the groups' text
    group_a, group_b = np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)
    number_a, number_b = np.arange(len(a)), np.arange(len(b))
    codes[number_a + j[group_a]] = a + own.ids * (number_a == (i + n - 1)[group_a])
    codes[number_b + (i + n)[group_b]] = b + 2 * own.ids * (number_b == (j + m - 1)[group_b])
    written = own.written[codes].tobytes().translate(None, b"\0")[:-1].decode()

    size = n * m
    few = size <= LARGE
    if not few.all():
        large = [_distinct(a[x : x + p], b[y : y + q]) for x, y, p, q in zip(*(v[~few] for v in (i, j, n, m)))]
        i, j, m, size = i[few], j[few], m[few], size[few]
    at = np.repeat(np.arange(len(size)), size)
    within = np.arange(len(at)) - np.repeat(size.cumsum() - size, size)
    keys, numbers = np.unique((a[i[at] + within // m[at]] << SHIFT) | b[j[at] + within % m[at]], return_counts=True)
    if not few.all():
        every = np.concatenate([keys, *(k for k, _ in large)])
        keys, at = np.unique(every, return_inverse=True)
        numbers = _summed(at, np.concatenate([numbers, *(c for _, c in large)]), len(keys))
    return len(a), len(b), keys, numbers, len(n), written


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a large group from its distinct ids, and their links."""
    (x, nx), (y, ny) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    return ((x << SHIFT)[:, None] | y).ravel(), (nx[:, None] * ny).ravel()


def _summed(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Exact integer sums by place."""
    out = np.zeros(size, np.int64)
    np.add.at(out, at, values)
    return out


COLUMNS = "n_a long, n_b long, n_groups long, n_links long, groups string"


def aligned(docs: DataFrame, ranks: str, pattern: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document (doc_id, n_a, n_b, n_groups, n_links, groups, keys, links) and, with a null
    ``place``, one per block with its distinct pairs and how many of its documents hold them."""
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"block long, place long, doc_id {kind}, {COLUMNS}, keys array<long>, links array<long>"
    fields = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, place, size, held = TaskContext.get().partitionId() << 33, 0, 0, np.zeros(0, np.int64)
        counts = np.zeros(0, np.int64)
        summary = lambda: as_batch({
            "block": [block], "place": [None], "doc_id": [None], "n_a": [0], "n_b": [0], "n_groups": [0], "n_links": [0], "groups": [""],
            "keys": as_lists([held]), "links": as_lists([counts]),
        }, fields)
        for batch in batches:
            own, out = pair_of(ranks, pattern, pieces), []
            for value in batch.column(1):
                text = value.as_py() or ""
                out.append(links(own, text))
                size += len(text) + 1
            n_a, n_b, keys, numbers, groups, written = map(list, zip(*out)) if out else [[]] * 6
            if out:
                yield as_batch({
                    "block": [block] * len(out), "place": list(range(place, place + len(out))), "doc_id": batch.column(0), "n_a": n_a, "n_b": n_b,
                    "n_groups": groups, "n_links": [int(n.sum()) for n in numbers], "groups": written, "keys": as_lists(keys), "links": as_lists(numbers),
                }, fields)
                place += len(out)
                new, times = np.unique(np.concatenate(keys), return_counts=True)
                held, at = np.unique(np.concatenate((held, new)), return_inverse=True)
                counts = _summed(at, np.concatenate((counts, times)), len(held))
            if size >= BLOCK:
                yield summary()
                block, place, size, held, counts = block + 1, 0, 0, held[:0], counts[:0]
        if place:
            yield summary()

    return rows.mapInArrow(run, schema)


def as_lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def totals(written: DataFrame) -> DataFrame:
    """(key, count, best): documents that hold a pair, and the most that any pair of its first id has."""
    asked = written.filter(F.col("place").isNull()).select(F.explode(F.arrays_zip("keys", "links")).alias("pair"))
    counts = asked.groupBy(F.col("pair.keys").alias("key")).agg(F.sum("pair.links").alias("count"))
    counts = counts.withColumn("first", F.shiftright("key", SHIFT))
    # One row per id of the first vocabulary at most.
    best = counts.groupBy("first").agg(F.max("count").alias("best"))
    return counts.join(F.broadcast(best), "first").select("key", "count", "best")


def align(docs: DataFrame, ranks: str, pattern: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row.

    ``n_best`` are the links whose count is the highest of their first id, ``count_sum`` is the sum
    of counts over links. Texts are read once; blocks hold digests of the groups, not their texts.
    """
    found = aligned(docs, ranks, pattern, pieces, id_col, text_col)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    written = stored(found.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256"), "alignment")
    own = written.filter(F.col("place").isNull()).select("block", F.explode("keys").alias("key"))
    answers = own.join(totals(written).hint("merge"), "key").groupBy("block").agg(F.collect_list(F.struct("key", "count", "best")).alias("told"))
    answers = answers.select(F.col("block").alias("asked"), *[F.col(f"told.{c}").alias(c) for c in ("key", "count", "best")])

    kind = written.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    fields = arrow_schema(schema)

    def looked_up(rows: pa.Table, told: pa.Table) -> pa.Table:
        columns = {c: rows[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        n_best = count_sum = np.zeros(rows.num_rows, np.int64)
        lists = rows["keys"].combine_chunks()
        keys, numbers = (_flat(rows[c].combine_chunks()) for c in ("keys", "links"))
        if len(keys):
            key, count, best = (_flat(told[c].combine_chunks()) for c in ("key", "count", "best"))
            order = np.argsort(key)
            at = order[np.searchsorted(key, keys, sorter=order)]
            doc = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy())
            n_best = _summed(doc, np.where(count[at] == best[at], numbers, 0), rows.num_rows)
            count_sum = _summed(doc, count[at] * numbers, rows.num_rows)
        columns |= {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
        return pa.table({f.name: columns[f.name] for f in fields}).cast(fields)

    rows = written.filter(F.col("place").isNotNull()).groupBy("block")
    return rows.cogroup(answers.groupBy("asked")).applyInArrow(looked_up, schema)


def _flat(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)
