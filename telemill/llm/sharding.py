"""Reproducible shuffle by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered by content: identical rows are counted once and take a range of numbers. The
numbering is by bucket of the rows' hash, then hash, then value; the number of buckets, a power
of two, follows from the number of rows.
The permuted number p gives shard p mod n and slot p div n, so that shards differ by at most one
row, and both directions can be computed for any number without the data.

Null values are ordinary values of a row; an empty table has no shards. Repeated rows take
different numbers. All columns given are kept, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 6
# Content buckets are numbered side by side, so both are part of the numbering.
LEAST_BUCKETS = 4096
ROWS_PER_BUCKET = 200_000
COPIES = 65_536  # copies of one row that are dealt out at a time


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit hash of the half block and the round's key."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    return [int(k) for k in _mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64), (seed * 0x632BE59BD9B4E019) % 2**64)]


class Permutation:
    """A seeded bijection of 0..n-1; works on a square of side ``ceil(sqrt(n))`` and walks back in."""

    def __init__(self, n: int, seed: int = 0):
        self.n, self.keys = n, _keys(seed)
        self.side = max(1, math.isqrt(max(n - 1, 0)) + 1)

    def _round_trip(self, x: np.ndarray, forward: bool) -> np.ndarray:
        side = np.uint64(self.side)
        left, right = x // side, x % side
        for key in self.keys if forward else reversed(self.keys):
            if forward:
                left, right = right, (left + _mixed(right, key) % side) % side
            else:
                left, right = (right + side - _mixed(left, key) % side) % side, left
        return left * side + right

    def _walk(self, numbers, forward: bool) -> np.ndarray:
        x = self._round_trip(np.asarray(numbers, dtype=np.uint64), forward)
        while (out := x >= np.uint64(self.n)).any():
            x[out] = self._round_trip(x[out], forward)
        return x.astype(np.int64)

    def forward(self, numbers) -> np.ndarray:
        return self._walk(numbers, True)

    def backward(self, numbers) -> np.ndarray:
        return self._walk(numbers, False)


def locate(number: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of a row number among n rows."""
    p = int(Permutation(n, seed).forward([number])[0])
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The row number in a shard's slot."""
    return int(Permutation(n, seed).backward([slot * shards + shard])[0])


def buckets_for(n: int) -> int:
    """Content buckets for n rows; the numbering depends on it, and so on n alone."""
    return max(LEAST_BUCKETS, 1 << max(0, -(-n // ROWS_PER_BUCKET) - 1).bit_length())


def numbered(rows: DataFrame, buckets: int) -> DataFrame:
    """(row, number): every row as one struct with its place among all rows by content bucket and value.

    One shuffle of the distinct rows; a hot group of copies travels as one row with its count
    and is dealt out again in pieces.
    """
    whole = rows.select(F.struct("*").alias("row"), F.xxhash64(*[F.col(_quoted(c)) for c in rows.columns]).alias("hash"))
    groups = whole.groupBy("row", "hash").agg(F.count("*").alias("n"))
    groups = groups.withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    base = groups.groupBy("bucket").agg(F.sum("n").alias("total"))
    before = F.sum("total").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    base = base.select("bucket", F.coalesce(before, F.lit(0)).alias("base"))  # at most ``buckets`` rows
    inside = Window.partitionBy("bucket").orderBy("hash", "row").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("base") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    placed = groups.join(base, "bucket").withColumn("first", first)
    chunks = F.explode(F.expr(f"sequence(0L, n - 1, {COPIES}L)"))
    dealt = placed.withColumn("chunk", chunks).repartition(F.col("first") + F.col("chunk"))
    each = F.explode(F.expr(f"sequence(chunk, least(chunk + {COPIES - 1}, n - 1))"))
    dealt = dealt.select("row", "first", each.alias("copy"))
    return dealt.select("row", (F.col("first") + F.col("copy")).alias("number"))


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def shard(rows: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """All rows with ``shard`` and ``slot``; counts per shard differ by at most one."""
    if clash := {"shard", "slot"} & set(rows.columns):
        raise ValueError(f"columns {sorted(clash)} would be overwritten")
    n = rows.count()

    @F.pandas_udf("long")
    def permuted(number: pd.Series) -> pd.Series:
        return pd.Series(Permutation(n, seed).forward(number.to_numpy()))

    out = numbered(rows, buckets_for(n)).withColumn("place", permuted("number"))
    return out.select("row.*", (F.col("place") % shards).cast("int").alias("shard"), F.expr(f"place div {shards}").alias("slot"))
