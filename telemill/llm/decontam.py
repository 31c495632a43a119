"""Benchmark decontamination by winnowing.

Both sides are cut into words; every k-gram is hashed, and of every ``window`` consecutive
hashes the smallest is kept as a fingerprint. Any shared span of at least k + window - 1 words
then shares a fingerprint. Fingerprints travel with the hashes of the words around them, so that
a join on the fingerprint finds the hits and extends them on the spot. Items shorter than that
span are one window each and keep the hash of the whole item.

Document fingerprints pass a Bloom filter of fixed size over the benchmark's before they are
shuffled; the join checks what passes it, so a full filter costs time and nothing else. Equal
fingerprint contexts of the benchmark are one row with the list of their items, and the documents'
side of the join is dealt over salts, since a third of all documents may hold one passage.

Null and empty texts have no words and no hits; an item without words is in no document.
Repeated rows are judged each by itself. Empty tables give no rows, or rows without hits. Only
id and text columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import PLAIN_BYTES, arrow_map, bloom, in_bloom, per_worker, stored, strings, texts

SPAN = 10  # words of a window
GRAM = 5  # k: words of a fingerprint
BLOOM_BITS = 1 << 23
SALTS = 16
CACHE = 250_000  # word hashes kept per worker
_words = re.compile(PLAIN_BYTES).findall


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def word_hashes(text: str) -> np.ndarray:
    words = _words(text.encode().lower())  # of bytes, only A-Z changes
    return np.fromiter(map(per_worker("words", _Hashes).__getitem__, words), np.uint64, len(words))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words; depends on words and order, and differs by k."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(n, k, np.uint64)
        for j in range(k):
            out = (out ^ h[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def winnowed(g: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest hash (the rightmost among equals) of every window."""
    n = len(g) - window + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, at = g[:n].copy(), np.arange(n)
    for j in range(1, window):
        smaller = g[j : j + n] <= best
        best[smaller] = g[j : j + n][smaller]
        at[smaller] = np.flatnonzero(smaller) + j
    keep = np.ones(n, bool)
    keep[1:] = at[1:] != at[:-1]
    return at[keep]


def around(h: np.ndarray, at: int, span: int, k: int) -> tuple[int, np.ndarray]:
    """The words that windows over the k-gram at a place can reach, and where they begin."""
    lo = max(0, at + k - span)
    return lo, h[lo : at + span]


def fingerprints(h: np.ndarray, span: int, k: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(hash, place, first place of the context, context) of a benchmark item."""
    if 0 < len(h) < span:
        yield int(grams(h, len(h))[0].astype(np.int64)), 0, 0, h.tobytes()
        return
    g = grams(h, k)
    for at in winnowed(g, span - k + 1):
        lo, words = around(h, int(at), span, k)
        yield int(g[at].astype(np.int64)), int(at), lo, words.tobytes()


def shared_runs(doc: bytes, doc_at: int, item: bytes, item_at: int, span: int) -> list[tuple[int, int]]:
    """Runs of at least ``span`` equal words around a shared place, as (start, end) from the context's start.

    Contexts of fewer words are a whole short item and must be equal.
    """
    a, b = np.frombuffer(doc, np.uint64), np.frombuffer(item, np.uint64)
    lead = min(doc_at, item_at)
    a, b = a[doc_at - lead :], b[item_at - lead :]
    n = min(len(a), len(b))
    if len(item) // 8 < span:
        return [(doc_at, doc_at + len(b))] if n == len(b) and (a[:n] == b).all() else []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (a[:n] == b[:n]).astype(np.int8), [0]))))
    return [(int(s) + doc_at - lead, int(e) + doc_at - lead) for s, e in zip(edges[::2], edges[1::2]) if e - s >= span]


def joined(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Ordered spans with overlapping and adjacent ones made one."""
    out: list[dict[str, int]] = []
    for s, e in spans:
        if out and s <= out[-1]["e"]:
            out[-1]["e"] = max(out[-1]["e"], e)
        else:
            out.append({"s": s, "e": e})
    return out


def item_prints(items: DataFrame, span: int, k: int) -> DataFrame:
    """(hash, at, context, items): one row per distinct fingerprint context."""

    def work(batch):
        out = [(i, *f) for i, t in enumerate(strings(batch.column(1))) for f in fingerprints(word_hashes(t), span, k)]
        i, h, at, lo, context = map(list, zip(*out)) if out else [[]] * 5
        yield {
            "item": batch.column(0).take(pa.array(i, pa.int64())), "hash": h, "at": [a - x for a, x in zip(at, lo)],
            "context": context, "short": [len(c) // 8 if len(c) // 8 < span else 0 for c in context],
        }

    found = arrow_map(items, work, "item string, hash long, at int, context binary, short int")
    return found.groupBy("hash", "at", "context", "short").agg(F.collect_set("item").alias("items"))


def document_prints(docs: DataFrame, bitmap: bytes, lengths: list[int], span: int, k: int, bits: int) -> DataFrame:
    """Every document with its words' number and the fingerprints that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def prints(h):
        g = grams(h, k)
        at = winnowed(g, span - k + 1)
        for p in at[in_bloom(shared.value, g[at], bits)]:
            lo, words = around(h, int(p), span, k)
            yield {"hash": int(g[p].astype(np.int64)), "at": int(p) - lo, "lo": lo, "short": 0, "context": words.tobytes()}
        for n in lengths:
            g = grams(h, n)
            for p in np.flatnonzero(in_bloom(shared.value, g, bits)):
                yield {"hash": int(g[p].astype(np.int64)), "at": 0, "lo": int(p), "short": n, "context": h[p : p + n].tobytes()}

    def work(batch):
        n, found = [], []
        for text in strings(batch.column(1)):
            h = word_hashes(text)
            n.append(len(h))
            found.append(list(prints(h)))
        yield {"doc_id": batch.column(0), "fp": batch.column(2), "n_words": n, "found": found}

    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("fp"))
    schema = f"doc_id {kind}, fp long, n_words long, found array<struct<hash: long, at: int, lo: int, short: int, context: binary>>"
    return arrow_map(docs, work, schema)


def decontaminate(
    docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", bits: int = BLOOM_BITS, salts: int = SALTS,
) -> DataFrame:
    """(doc_id, fp, n_words, spans, items): hit words as ordered (start, end) spans, and the items found,
    sorted as strings; fp is a hash of the text that tells rows of one id apart."""
    benchmark = texts(items, item_col, text_col).select(F.col("doc_id").cast("string").alias("item"), "text")
    prints = stored(item_prints(benchmark, span, k), "item-prints")
    bitmap = bloom(prints.select("hash"), bits)
    lengths = sorted(r["short"] for r in prints.filter("short > 0").select("short").distinct().collect())  # fewer than ``span``
    rows = document_prints(texts(docs, id_col, text_col), bitmap, lengths, span, k, bits)
    rows = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "document-prints")

    found = rows.select("__row", F.explode("found").alias("f")).select("__row", "f.*")
    found = found.withColumn("salt", F.pmod(F.xxhash64("__row"), F.lit(salts)).cast("int"))
    spread = prints.select(
        "hash", F.col("at").alias("item_at"), F.col("context").alias("item_context"), "items", "short",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
    )
    pairs = found.join(spread, ["hash", "short", "salt"])

    @F.pandas_udf("array<struct<s: long, e: long>>")
    def extended(context, at, lo, item_context, item_at):
        out = [
            [{"s": s + x, "e": e + x} for s, e in shared_runs(c, a, ic, ia, span)]
            for c, a, x, ic, ia in zip(context, at, lo, item_context, item_at)
        ]
        return pd.Series(out)

    runs = pairs.select("__row", "items", extended("context", "at", "lo", "item_context", "item_at").alias("runs")).filter(F.size("runs") > 0)
    @F.pandas_udf("array<struct<s: long, e: long>>")
    def merged(spans):
        return spans.map(lambda runs: joined([(r["s"], r["e"]) for r in runs]))

    spans = runs.select("__row", F.explode("runs").alias("r")).groupBy("__row").agg(F.sort_array(F.collect_set("r")).alias("r"))
    spans = spans.select("__row", merged("r").alias("r"))
    named = runs.select("__row", F.explode("items").alias("i")).groupBy("__row").agg(F.sort_array(F.collect_set("i")).alias("i"))
    out = rows.select("doc_id", "fp", "n_words", "__row").join(spans, "__row", "left").join(named, "__row", "left")
    empty = F.expr("CAST(array() AS array<struct<s: bigint, e: bigint>>)")
    return out.select(
        "doc_id", "fp", "n_words", F.coalesce("r", empty).alias("spans"), F.coalesce("i", F.expr("CAST(array() AS array<string>)")).alias("items")
    )
