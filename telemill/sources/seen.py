"""Which keys a dated table holds already, found without reading its history.

Beside the table lie its keys with their dates, dealt to parts by hash, and for each part Bloom
filters of the keys that every load added. A batch of keys is held against the filters of the
parts its keys fall into; parts multiply as keys grow, so a part stays small. Only parts in which a filter says "maybe" are opened, and of the table
only the dates that their keys name. So what a batch costs follows the batch, not the history: a
key that was never sent opens nothing (but for six in a million false alarms).

Keys are added before the table is written. A load that breaks off in between leaves keys without
rows; as every hit is looked up in the table itself, such a key counts as not stored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.session import working, written
from telemill.sources.schema import PARTITION

PARTS = 8  # to begin with
KEYS_PER_PART = 1_000_000  # beyond which parts are made more
BITS_PER_KEY = 32
PROBES = 8
KEYS_PER_FILTER = 1_000_000  # a filter has at most 4 MB
KEYS_PER_GROUP = 1_000_000  # asked of a part's filters by one task
MERGE_AT = 64  # filters of a part before they are made anew


FILTER_SCHEMA = "keys long, bits binary, parts int, part int"


def table_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException:
        return None


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The probed bits of each 64-bit hash, one row per probe; ``bits`` is a power of two."""
    h = hashes.view(np.uint64)
    with np.errstate(over="ignore"):
        step = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)
        return ((h + np.arange(PROBES, dtype=np.uint64)[:, None] * step) >> np.uint64(7)) & np.uint64(bits - 1)


def _filter(hashes: np.ndarray) -> bytes:
    bits = 1 << max(10, (BITS_PER_KEY * len(hashes) - 1).bit_length())
    bitmap = np.zeros(bits // 8, np.uint8)
    at = _places(hashes, bits).ravel()
    np.bitwise_or.at(bitmap, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return bitmap.tobytes()


def _in_filter(bitmap: bytes, hashes: np.ndarray) -> np.ndarray:
    body = np.frombuffer(bitmap, np.uint8)
    at = _places(hashes, 8 * len(body))
    return (body[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(axis=0)


@dataclass
class SeenKeys:
    """The keys of the dated table at ``table``, kept in ``folder``; ``key`` is a string column of both."""

    spark: SparkSession
    table: str
    key: str
    folder: str
    parts: int = PARTS

    def __post_init__(self):
        stored = self.filters()
        if stored is not None:  # the number the index was made with holds
            self.parts = stored.select("parts").first()["parts"]
        elif (rows := table_or_none(self.spark, self.table)) is not None:
            self.add(rows)

    def filters(self) -> DataFrame | None:
        return table_or_none(self.spark, f"{self.folder}/filters", FILTER_SCHEMA)

    def keys(self) -> DataFrame:
        return self.spark.read.schema(f"`{self.key}` string, {PARTITION} date, part int").parquet(f"{self.folder}/keys")

    def _hashed(self, rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("hash", F.xxhash64(self.key))
        return rows.withColumn("part", F.pmod("hash", F.lit(self.parts)).cast("int"))

    def _made(self, keys: DataFrame) -> DataFrame:
        """Filters of keys that lie together by part: one per part and task, more where keys are many."""

        def run(batches):
            held: dict[int, list[np.ndarray]] = {}

            def close(part):
                hashes = np.concatenate(held.pop(part))
                return pa.RecordBatch.from_pydict({"keys": [len(hashes)], "bits": [_filter(hashes)], "part": pa.array([part], pa.int32())})

            for batch in batches:
                part, hashes = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                for p in np.unique(part).tolist():
                    held.setdefault(p, []).append(hashes[part == p].astype(np.int64))
                    if sum(map(len, held[p])) >= KEYS_PER_FILTER:
                        yield close(p)
            for p in list(held):
                yield close(p)

        made = keys.select("part", "hash").mapInArrow(run, "keys long, bits binary, part int")
        return made.withColumn("parts", F.lit(self.parts))

    def add(self, rows: DataFrame) -> None:
        """Note the keys of rows (with the date column) that are about to be stored."""
        with working(self.spark, "keys") as path:
            keys = written(self._hashed(rows.select(self.key, PARTITION)).hint("rebalance", "part"), path)
            keys.select(self.key, PARTITION, "part").write.mode("append").partitionBy("part").parquet(f"{self.folder}/keys")
            self._made(keys).coalesce(8).write.mode("append").partitionBy("part").parquet(f"{self.folder}/filters")

    def maybe(self, asked: DataFrame, rows: int) -> DataFrame:
        """(part, hash) of the keys asked that some filter may hold; ``rows`` says how many are asked."""
        stored = self.filters()
        if stored is None:
            return self._hashed(asked).select("part", "hash").limit(0)
        salts = rows // (self.parts * KEYS_PER_GROUP) + 1
        asked = self._hashed(asked).select("part", "hash", F.pmod(F.shiftright("hash", 32), F.lit(salts)).alias("salt"))
        concerned = [r["part"] for r in asked.select("part").distinct().collect()]  # at most ``parts`` numbers
        told = stored.filter(F.col("part").isin(concerned)).select("part", "bits", F.explode(F.expr(f"sequence(0L, {salts - 1}L)")).alias("salt"))
        fields = pa.schema([("part", pa.int32()), ("hash", pa.int64())])

        def held_against(keys: pa.Table, filters: pa.Table) -> pa.Table:
            hashes = np.unique(keys["hash"].to_numpy())
            found = np.zeros(len(hashes), bool)
            for bits in filters["bits"] if len(hashes) else ():
                found |= _in_filter(bits.as_py(), hashes)
            part = keys["part"][0].as_py() if len(hashes) else 0
            return pa.table([pa.array([part] * int(found.sum()), pa.int32()), pa.array(hashes[found])], schema=fields)

        groups = asked.groupBy("part", "salt").cogroup(told.groupBy("part", "salt"))
        return groups.applyInArrow(held_against, "part int, hash long")

    def named(self, maybe: DataFrame) -> DataFrame | None:
        """Keys and dates behind the alarms, from the parts concerned (at most ``parts`` numbers); None without any."""
        parts = [r["part"] for r in maybe.select("part").distinct().collect()]
        if not parts:
            return None
        keys = self.keys().filter(F.col("part").isin(parts))
        return keys.withColumn("hash", F.xxhash64(self.key)).join(maybe.select("hash"), "hash", "left_semi").select(self.key, PARTITION)

    def stored(self, named: DataFrame) -> DataFrame | None:
        """Those of the named keys that the table has, from the dates concerned (one number a date); None without any."""
        dates = [r[0] for r in named.select(PARTITION).distinct().collect()]
        table = table_or_none(self.spark, self.table)
        if not dates or table is None:
            return None
        concerned = F.col(PARTITION).isin([d for d in dates if d is not None])
        concerned = (concerned | F.col(PARTITION).isNull()) if None in dates else concerned
        return table.filter(concerned).select(self.key).join(named.select(self.key), self.key, "left_semi").distinct()

    def unseen(self, rows: DataFrame, path: str) -> DataFrame:
        """The rows whose key the table doesn't hold; working tables go below ``path``."""
        maybe = written(self.maybe(rows.select(self.key), rows.count()), f"{path}/maybe")
        named = self.named(maybe)
        if named is None:
            return rows
        known = self.stored(written(named, f"{path}/named"))
        return rows if known is None else rows.join(written(known, f"{path}/known"), self.key, "left_anti")

    def merge(self, at_least: int = MERGE_AT) -> list[int]:
        """Make the files and filters anew of parts with many, or of all when more parts are needed; returns these parts.

        If it breaks off while files are swapped, delete the folder: the next load makes it from the table.
        """
        stored = self.filters()
        counts = stored.groupBy("part").agg(F.count("*").alias("n"), F.sum("keys").alias("keys")).collect() if stored is not None else []
        total, parts = sum(r["keys"] for r in counts), sorted(r["part"] for r in counts if r["n"] >= at_least)
        keys = self.keys() if counts else None
        mode = "dynamic"
        if total > self.parts * KEYS_PER_PART:
            self.parts, mode = self.parts << (4 * total // (self.parts * KEYS_PER_PART)).bit_length(), "static"
        elif parts:
            keys = keys.filter(F.col("part").isin(parts))
        else:
            return []
        with working(self.spark, "merged-keys") as path:
            keys = written(self._hashed(keys.drop("part").distinct()).hint("rebalance", "part"), f"{path}/keys")
            made = written(self._made(keys), f"{path}/filters")
            for name, rows in (("keys", keys.drop("hash")), ("filters", made)):
                rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("part").parquet(f"{self.folder}/{name}")
        return parts if mode == "dynamic" else list(range(self.parts))
