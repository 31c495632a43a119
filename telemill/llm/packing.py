"""Best-fit-decreasing packing of token sequences.

Documents become pieces of at most ``capacity`` tokens. Best fit depends on lengths alone, so
the bins are planned on the histogram of lengths, which has at most ``capacity`` rows however
large the corpus is: lengths descend, and a segment tree over remaining capacities finds the
tightest open bin in logarithmic time. Bins that look alike are handled as ranges, which gives
the same packing as one document at a time. Pieces then find their place by their number
within their length: one shuffle of short rows, hot lengths split by a salt.

Null and empty texts are the closing id alone. Repeated rows are packed each by itself. An empty
table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import base64
import re
import struct
import zlib
from itertools import chain

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from telemill.llm.common import arrow_map, per_worker, spark_schema, stored, strings, texts

CAPACITY = 2048
END = struct.pack("<I", 0)
ROWS_PER_SALT = 500
CACHE = 250_000  # encoded segments kept per worker
# Unicode white space (fixed values). A text may be cut before white space that follows other
# characters: no pre-token of the byte-level pattern spans such a place.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SEGMENTS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall


class _Encoded(dict):
    """Little-endian ids by segment, while there is room."""

    def __init__(self, encoding):
        super().__init__()
        self.encode = encoding.encode_ordinary

    def __missing__(self, segment: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        ids = self.encode(segment)
        out = self[segment] = struct.pack(f"<{len(ids)}I", *ids)
        return out


def _tools(vocabulary: str):
    """The library's tokenizer, its special strings, and the cache over the same vocabulary's ranks."""
    library = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    special = [t.content for t in library.get_added_tokens_decoder().values()]
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    own = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return library, special, _Encoded(own)


def encode(text: str, vocabulary: str = "byte_bpe_50k") -> bytes:
    """The ids of a text as little-endian unsigned 32-bit integers, without a closing id."""
    library, special, encoded = per_worker(("packing", vocabulary), lambda: _tools(vocabulary))
    if any(s in text for s in special):
        ids = library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)
    return b"".join(map(encoded.__getitem__, SEGMENTS(text)))


def pieces(ids: bytes, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be shorter than the capacity."""
    n = len(ids) // 4
    first = n if n <= capacity else (n % capacity or capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenized(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """One row per piece, with its ids if wanted."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def work(batch):
        out = []
        for i, text in enumerate(strings(batch.column(1))):
            ids = encode(text, vocabulary) + END
            for k, (start, length) in enumerate(pieces(ids, capacity)):
                part = ids[4 * start : 4 * (start + length)]
                out.append((i, k, start, length, zlib.crc32(part), part if with_ids else None))
        rows, piece, start, length, crc, parts = map(list, zip(*out)) if out else [[]] * 6
        columns = {"doc_id": batch.column(0).take(pa.array(rows, pa.int64())), "piece": piece, "start": start, "length": length, "ids_crc32": crc}
        yield columns | ({"ids": parts} if with_ids else {})

    return arrow_map(docs, work, schema)


class CapacityTree:
    """Segment tree over remaining capacities 0..top: which of them have open bins."""

    def __init__(self, top: int):
        self.base = 1 << (top + 1).bit_length()
        self.open = [False] * (2 * self.base)

    def set(self, capacity: int, is_open: bool) -> None:
        node = self.base + capacity
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest open capacity of at least ``length``."""
        node = self.base + length
        if self.open[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.base:
                    node = 2 * node + (not self.open[2 * node])
                return node - self.base
            node //= 2
        return None


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best fit decreasing on counts by length.

    Returns (length, first item, end item, first bin, items per bin, offset) and the number of
    bins: items of a length are numbered from 0, an entry's items fill its bins one by one.
    """
    tree, ranges, entries, bins = CapacityTree(capacity), {}, [], 0

    def keep(room: int, first: int, count: int) -> None:
        if room and count:
            ranges.setdefault(room, []).append((first, count))
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        done, n = 0, histogram[length]
        while done < n:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, bins
                count = -(-(n - done) // (capacity // length))
                bins += count
            else:
                first, count = ranges[room].pop()
                if not ranges[room]:
                    tree.set(room, False)
            each = room // length
            full = min(count, (n - done) // each)
            rest = min(each, n - done - full * each) if full < count else 0
            offset = capacity - room
            if full:
                entries.append((length, done, done + full * each, first, each, offset))
                keep(room - each * length, first, full)
            if rest:
                entries.append((length, done + full * each, done + full * each + rest, first + full, each, offset))
                keep(room - rest * length, first + full, 1)
            keep(room, first + full + bool(rest), count - full - bool(rest))
            done += full * each + rest
    return entries, bins


def pack(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with ``sequence_id`` and ``offset``; offsets are gapless from 0 in each sequence."""
    spark = docs.sparkSession
    cut = tokenized(texts(docs, id_col, text_col), capacity, with_ids).withColumn("__row", F.monotonically_increasing_id())
    cut = stored(cut, "pieces")  # texts are encoded once; row numbers stay as written
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    entries, _ = plan(histogram, capacity)
    by_length: dict[int, list] = {}
    for length, lo, hi, first, each, offset in entries:
        by_length.setdefault(length, []).append((lo, hi, first, each, offset))
    schema = "length long, entries array<struct<lo: long, hi: long, first: long, each: long, at: long>>"
    places = spark.createDataFrame(list(by_length.items()), spark_schema(schema))
    salts = spark.createDataFrame([(n, -(-c // ROWS_PER_SALT)) for n, c in histogram.items()], "length long, salts long")

    cut = cut.join(F.broadcast(salts), "length").withColumn("__salt", F.pmod(F.xxhash64("__row"), F.col("salts"))).drop("salts")
    groups = cut.groupBy("length", "__salt").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1))
    groups = groups.select("length", "__salt", F.coalesce(before, F.lit(0)).alias("__base"))
    inside = F.row_number().over(Window.partitionBy("length", "__salt").orderBy("__row")) - 1
    numbered = cut.join(groups, ["length", "__salt"]).withColumn("__k", F.col("__base") + inside)
    fits = F.filter("entries", lambda e: (e.lo <= F.col("__k")) & (F.col("__k") < e.hi))[0]
    placed = numbered.join(F.broadcast(places), "length").withColumn("__e", fits)
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids,
        F.expr("__e.first + (__k - __e.lo) div __e.each").alias("sequence_id"),
        F.expr("__e.at + (__k - __e.lo) % __e.each * length").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token ids themselves (needs ``with_ids``): one row of at most ``capacity`` ids a sequence."""

    @F.pandas_udf("array<int>")
    def joined(parts):
        return parts.map(lambda p: list(chain.from_iterable(struct.unpack(f"<{len(x) // 4}I", x) for x in p)))

    grouped = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return grouped.select("sequence_id", joined(F.transform("parts", lambda p: p.ids)).alias("ids"))
