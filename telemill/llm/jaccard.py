"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of hashed word 5-grams. Equal sets are one representative with its number of
copies. Bands of MinHash values propose candidates; within a band's bucket, pairs compare their
MinHash values a few at a time and are dropped as soon as the posterior probability of reaching
the threshold falls below the tolerance. What survives is verified exactly on the shingle sets.

No task sees an unbounded group: buckets and clusters beyond ``BLOCK`` rows are cut into blocks,
and a task compares two blocks. Pairs live only inside such a task; it emits one row per member
(a spanning tree of what it found, and link counts). Each member goes to one task per block, so a
group of n different near copies makes some n * n / 256 shuffled rows, with signatures or shingle
sets (39 M for 100,000). The links of a near-copy group are counted exactly, hence a group's CPU
time grows with its square too. Candidates meet in at least one band with probability 1 - 3e-6 at a
similarity of exactly 0.8, and more above; clusters are verified whole, which adds to that.

``links`` of a document counts the other documents at the threshold or above, copies included;
``class_id`` is the smallest id among the documents connected by links. Documents of fewer words
than a shingle are one shingle of all their words; null texts and texts without words link to
nothing and are a class of their own. Repeated rows are copies of each other. Only the id and
text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import arrow_map, arrow_schema, bloom, in_bloom, packed, spread_join, stored, strings, texts
from telemill.llm.decontam import grams, word_hashes

GRAM = 5
THRESHOLD = Fraction(4, 5)
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
STEP = 16  # MinHash values compared at a time
TOLERANCE = 1e-6
BLOCK = 256  # members of a group that one side of a task holds
BUNDLE = 1000  # rows of small groups that share a task's call
CELLS = 200_000  # shingles hashed at a time
BLOOM_BITS = 1 << 26  # at most; passes the documents whose sets are needed again
_MULTIPLIERS = np.random.default_rng(20_240_101).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str, gram: int = GRAM) -> np.ndarray:
    """Distinct hashed word n-grams, sorted."""
    h = word_hashes(text)
    return np.unique(grams(h, min(gram, len(h)))) if len(h) else np.empty(0, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, one row of 32-bit integers per non-empty set."""
    out = np.empty((len(sets), HASHES), np.uint32)
    at = 0
    while at < len(sets):
        end, cells = at, 0
        while end < len(sets) and (end == at or cells + len(sets[end]) <= CELLS):
            cells += len(sets[end])
            end += 1
        x = np.concatenate(sets[at:end])
        starts = np.cumsum([0] + [len(s) for s in sets[at : end - 1]])
        for k in range(HASHES):
            out[at:end, k] = np.minimum.reduceat(x * _MULTIPLIERS[k], starts) >> np.uint64(32)
        at = end
    return out


def enough(n: int, threshold: float, tolerance: float) -> int:
    """The fewest equal values among n for which P(similarity >= threshold) reaches the tolerance.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1); its upper tail at t is the
    chance of at most m successes in n + 1 trials at t.
    """
    tail = 0.0
    for m in range(n + 1):
        tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= tolerance:
            return m
    return n


def pruned(sig: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Which of the pairs (a, b) survive the incremental comparison."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), np.int32)
    for at in range(0, HASHES, STEP):
        values = slice(at, at + STEP)
        equal = equal + (sig[a[alive], values] == sig[b[alive], values]).sum(1)
        keep = equal >= enough(at + STEP, threshold, tolerance)
        alive, equal = alive[keep], equal[keep]
    return alive


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def sketches(docs: DataFrame, gram: int = GRAM) -> DataFrame:
    """(doc_id, fingerprint of the text, set hash, size, MinHash values), stored with a row number."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("fp"))

    def work(batch):
        values = batch.column(1)
        for at in range(0, len(values), 1000):
            sets = [shingles(t, gram) for t in strings(values[at : at + 1000])]
            full = [s for s in sets if len(s)]
            sig = iter(signatures(full)) if full else iter(())
            yield {
                "doc_id": batch.column(0)[at : at + 1000], "fp": batch.column(2)[at : at + 1000], "size": [len(s) for s in sets],
                "hash": [set_hash(s) if len(s) else None for s in sets], "sig": [next(sig).tobytes() if len(s) else None for s in sets],
            }

    out = arrow_map(rows, work, f"doc_id {kind}, fp long, hash binary, size int, sig binary")
    return stored(out.withColumn("row", F.monotonically_increasing_id()), "sketches")


def set_hash(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def representatives(sketched: DataFrame) -> DataFrame:
    """One row per distinct set: its document of the smallest id (null last), copies and MinHash values."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row", "size", "sig")).alias("r")
    reps = sketched.filter("hash IS NOT NULL").groupBy("hash").agg(first, F.count("*").alias("copies"))
    return stored(reps.select("r.row", "r.doc_id", "hash", "r.size", "copies", "r.sig"), "representatives")


def _bands(reps: DataFrame) -> DataFrame:
    def work(batch):
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, HASHES)
        rows = batch.column(0).to_numpy(zero_copy_only=False)
        pairs = sig.astype(np.uint64)
        for band in range(BANDS):
            h = grams(pairs[:, band * ROWS : (band + 1) * ROWS].ravel(), ROWS)[::ROWS] if len(sig) else np.empty(0, np.uint64)
            yield {"group": (h ^ np.uint64(band * 0x9E3779B97F4A7C15 % 2**64)).view(np.int64), "row": rows}

    return arrow_map(reps.select("row", "sig"), work, "group long, row long")


def tiled(members: DataFrame, block: int = BLOCK, bundle: int = BUNDLE) -> DataFrame:
    """Members (group, row, ...) of groups of two or more, dealt to tasks: small groups in
    bundles, each pair of blocks of a larger group by itself. Adds tile, i, j and side."""
    counts = members.groupBy("group").agg(F.count("*").alias("__n")).filter("__n > 1")
    counts = stored(counts, "groups")
    total = counts.agg(F.sum("__n")).first()[0] or 0
    bundles = total // bundle + 1
    rows = spread_join(members, counts, ["group"], F.col("row"), "inner")
    blocks = F.ceil(F.col("__n") / F.lit(block))
    own = F.pmod(F.xxhash64("row", "group"), blocks).cast("int")
    small = rows.filter(F.col("__n") <= block).withColumns(
        {"tile": F.pmod(F.xxhash64("group"), F.lit(bundles)), "i": F.lit(-1), "j": F.lit(-1), "side": F.lit(0)}
    )
    large = rows.filter(F.col("__n") > block).withColumn("__own", own)
    other = F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    large = large.withColumn("__other", other).withColumns(
        {"tile": F.col("group"), "i": F.least("__own", "__other"), "j": F.greatest("__own", "__other"), "side": (F.col("__own") > F.col("__other")).cast("int")}
    )
    return small.drop("__n").unionByName(large.drop("__n", "__own", "__other"))


def _groups(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row indices of each group, and of the second block's members for a pair of different blocks."""
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    group = table["group"].to_numpy()
    if i >= 0:
        side = table["side"].to_numpy()
        yield np.flatnonzero(side == 0), np.flatnonzero(side == 1) if i < j else None
        return
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    for own in np.split(order, cuts):
        yield own, None


def _pairs(one: np.ndarray, two: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if two is None:
        a, b = np.triu_indices(len(one), 1)
        return one[a], one[b]
    return np.repeat(one, len(two)), np.tile(two, len(one))


def _candidates(reps: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Edges (row, root) that connect all pairs surviving the pruning, from every band."""
    members = tiled(_bands(reps))
    members = members.join(reps.select("row", "sig"), "row")
    fields = arrow_schema("row long, root long")

    def work(table: pa.Table) -> pa.Table:
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(-1, HASHES)
        rows = table["row"].to_numpy()
        left, right, size = [], [], 0
        out_a, out_b = [], []

        def flush():
            nonlocal left, right, size
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                alive = pruned(sig, a, b, threshold, tolerance)
                out_a.append(a[alive])
                out_b.append(b[alive])
            left, right, size = [], [], 0

        for one, two in _groups(table):
            a, b = _pairs(one, two)
            left.append(a)
            right.append(b)
            size += len(a)
            if size > CELLS:
                flush()
        flush()
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (out_a, out_b))
        # The same document may be here in several groups.
        nodes, at = np.unique(rows, return_inverse=True)
        root = roots(len(nodes), at[a], at[b])
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.Table.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], schema=fields)

    return members.groupBy("tile", "i", "j").applyInArrow(work, "row long, root long")


def components(edges: DataFrame, salts: int = 8) -> DataFrame:
    """(row, root) of every node of an edge: root is the smallest node of its component.

    Alternating large-star and small-star steps; each step's edges are written out, hubs are
    dealt over salts.
    """
    def star(links: DataFrame, large: bool) -> DataFrame:
        both = links.union(links.select("b", "a"))
        around = both if large else both.filter("b < a")
        low = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        met = spread_join(around, low, ["a"], F.col("b"), "inner", salts)
        if large:
            return met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return met.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").union(low.select("a", "m"))

    def mark(links: DataFrame):
        return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b", "a", F.lit(1)) % 1_000_003)).first()

    links = edges.select(F.greatest("row", "root").alias("a"), F.least("row", "root").alias("b")).filter("a != b").distinct()
    links = stored(links, "links")
    before, now = None, mark(links)
    while before != now:
        links = stored(star(star(links, True).distinct(), False).distinct(), "links")
        before, now = now, mark(links)
    return links.select(F.col("a").alias("row"), F.col("b").alias("root")).union(links.select("b", "b").distinct())


def overlaps(sets: list[np.ndarray], cells: int = 4_000_000) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of the incidence matrix in column chunks."""
    n = len(sets)
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = seen > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    total, width = np.zeros((n, n), np.float32), max(1, cells // n)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, (at, at + width))
        part = np.zeros((n, width), np.float32)
        part[row[lo:hi], column[lo:hi] - at] = 1
        total += part @ part.T
    return total.astype(np.int64)


def _verified(members: DataFrame, threshold: Fraction) -> DataFrame:
    """(row, root, links) per member and task, from exact similarities of whole clusters."""
    fields = arrow_schema("row long, root long, links long")

    def work(table: pa.Table) -> pa.Table:
        rows, copies = table["row"].to_numpy(), table["copies"].to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in table["set"].to_pylist()]
        out = [[], [], []]
        for one, two in _groups(table):
            own = one if two is None else np.concatenate((one, two))
            common = overlaps([sets[i] for i in own])
            size = np.array([len(sets[i]) for i in own])
            union = size[:, None] + size[None, :] - common
            linked = common * threshold.denominator >= union * threshold.numerator
            np.fill_diagonal(linked, False)
            if two is not None:
                linked[: len(one), : len(one)] = linked[len(one) :, len(one) :] = False
            a, b = np.nonzero(linked)
            by_row = np.argsort(rows[own])  # the root is the smallest row, not the first
            rank = np.empty(len(own), np.int64)
            rank[by_row] = np.arange(len(own))
            root = roots(len(own), rank[a], rank[b])
            out[0].append(rows[own])
            out[1].append(rows[own][by_row][root[rank]])
            out[2].append(linked.astype(np.int64) @ copies[own])
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in out], schema=fields)

    return members.groupBy("tile", "i", "j").applyInArrow(work, "row long, root long, links long")


def _sets(docs: DataFrame, wanted: DataFrame, gram: int) -> DataFrame:
    """(hash, set) of the documents whose sets are wanted: one pass, prefiltered by their ids."""
    n = wanted.count()
    bits = min(BLOOM_BITS, max(1 << 16, 1 << (16 * n).bit_length()))
    bitmap = docs.sparkSession.sparkContext.broadcast(bloom(wanted.select(F.xxhash64("doc_id").alias("h")), bits))
    rows = docs.select(F.xxhash64("doc_id").alias("h"), "text")

    def work(batch):
        near = np.flatnonzero(in_bloom(bitmap.value, batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), bits))
        for at in range(0, len(near), 1000):
            sets = [shingles(t, gram) for t in strings(batch.column(1).take(pa.array(near[at : at + 1000])))]
            sets = [s for s in sets if len(s)]
            yield {"hash": [set_hash(s) for s in sets], "set": [s.tobytes() for s in sets]}

    found = arrow_map(rows, work, "hash binary, set binary")
    return found.join(wanted.select("hash"), "hash", "left_semi").groupBy("hash").agg(F.min("set").alias("set"))


def join(docs: DataFrame, threshold: Fraction = THRESHOLD, gram: int = GRAM, tolerance: float = TOLERANCE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row as (doc_id, fp, row, class_row, class_id, links, copies, wordless): its class and its number of links.

    ``class_row`` tells classes apart. ``class_id`` names one by the smallest of its ids that
    isn't null (null if all are), so classes that share an id may share the name.
    """
    docs = texts(docs, id_col, text_col)
    sketched = sketches(docs, gram)
    reps = representatives(sketched)
    near = stored(components(_candidates(reps, float(threshold), tolerance)), "clusters")
    wanted = stored(near.join(reps.select("row", "doc_id", "hash", "copies"), "row"), "clustered")
    members = wanted.join(_sets(docs, wanted, gram), "hash").select(F.col("root").alias("group"), "row", "copies", "set")
    found = stored(_verified(tiled(stored(members, "members")), threshold), "verified")
    links = found.groupBy("row").agg(F.sum("links").alias("__links"))
    classes = stored(components(found.select("row", "root")), "classes")
    names = classes.join(reps.select("row", "doc_id"), "row").groupBy("root").agg(F.min("doc_id").alias("__name"))
    named = spread_join(classes, names, ["root"], F.col("row"), "inner").select("row", "root", "__name")
    reps = reps.select("row", "hash", "copies", F.col("doc_id").alias("__own")).join(named, "row", "left").join(links, "row", "left")
    reps = reps.select(
        "hash", "copies", F.coalesce("root", "row").alias("__class"), F.when(F.col("root").isNull(), F.col("__own")).otherwise(F.col("__name")).alias("__name"),
        F.coalesce("__links", F.lit(0)).alias("__links"),
    )
    rows = spread_join(sketched.select("doc_id", "fp", "row", "hash"), reps, ["hash"], F.col("row"))
    alone = F.col("hash").isNull()
    return rows.select(
        "doc_id", "fp", "row", F.when(alone, F.col("row")).otherwise(F.col("__class")).alias("class_row"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("__name")).alias("class_id"),
        (F.coalesce("__links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("links"), F.coalesce("copies", F.lit(1)).alias("copies"),
        alone.alias("wordless"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with one row of each class kept, the one of the smallest id; all columns stay, whatever their names.

    Rows without words stay. A class's row is found by id and text; of rows alike in both one stays.
    """
    judged = stored(join(docs, id_col=id_col, text_col=text_col, **options), "judged")
    first = judged.filter("NOT wordless").groupBy("class_row").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("f"))
    kept = stored(first.select(F.col("f.doc_id").alias("id"), F.col("f.fp").alias("text")), "kept")
    wordless = judged.filter("wordless").select(F.col("doc_id").alias("id"), F.col("fp").alias("text")).distinct()
    whole = packed(docs, id_col, text_col)
    alike = lambda other: whole["id"].eqNullSafe(other["id"]) & whole["text"].eqNullSafe(other["text"])
    with_words = whole.join(kept, alike(kept), "left_semi")
    if judged.filter("NOT wordless").groupBy("doc_id", "fp").count().filter("count > 1").limit(1).count():
        with_words = with_words.dropDuplicates(["id", "text"])  # only rows alike in both can be too many
    return with_words.unionByName(whole.join(wordless, alike(wordless), "left_semi")).select("document.*")
