"""What the text operators share: rows as (doc_id, text), Arrow maps, working tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from telemill.session import scratch

# Characters that separate words for the whitespace-based operators (fixed values).
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# Words of lower-cased text: everything but ASCII characters other than 0-9 and a-z.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PLAIN_BYTES = rb"[0-9a-z\x80-\xff]+"  # the same words in lower-cased UTF-8

BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so that no other name can clash.

    Texts go to Python in batches of a few MB, unless the session sets its own size: a batch is
    held several times over, as Arrow on both sides and as strings.
    """
    name, size = BATCH_BYTES
    if name not in docs.sparkSession.conf.getAll:
        docs.sparkSession.conf.set(name, size)
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, document): whole rows in one column beside their id and the hash of their text, so
    that helper columns can't clash with any of theirs; ``select("document.*")`` unpacks them."""
    return docs.select(docs[id_col].alias("id"), F.xxhash64(docs[text_col].cast("string")).alias("text"), F.struct("*").alias("document"))


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from one batch to dicts of columns (lists or arrays)."""
    fields = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in work(batch):
                yield as_batch(columns, fields)

    return df.mapInArrow(run, schema)


def as_batch(columns: dict, fields: pa.Schema) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in fields)]
    return pa.RecordBatch.from_arrays(arrays, schema=fields)


def arrow_schema(schema: str) -> pa.Schema:
    return to_arrow_schema(_parse_datatype_string(schema))


def spark_schema(schema: str) -> StructType:
    return _parse_datatype_string(schema)


def strings(column) -> Iterator[str]:
    """The texts of an Arrow column one by one; null reads as empty."""
    for value in column:
        yield value.as_py() or ""


_TOOLS: dict = {}


def per_worker(key, make: Callable):
    """What an operator keeps in a Python worker between tasks: one operator's at a time, so that
    the caches of a pipeline's stages don't add up."""
    if key not in _TOOLS:
        _TOOLS.clear()
        _TOOLS[key] = make()
    return _TOOLS[key]


class Memo(dict):
    """Results by key while there is room; what belongs to a long key is worked out each time, so
    that the memory held is bounded by entries times the bytes of a short key's result."""

    LONGEST = 64

    def __init__(self, work: Callable, entries: int, fixed: dict | None = None):
        super().__init__(fixed or {})
        self.work, self.entries, self.fixed = work, entries, fixed or {}

    def __missing__(self, key):
        value = self.work(key)
        if len(key) <= self.LONGEST:
            if len(self) >= self.entries + len(self.fixed):
                self.clear()
                self.update(self.fixed)
            self[key] = value
        return value


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a working table into the shared folder and read it back.

    Cuts the lineage: what is read later no longer depends on any executor.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def spread_join(big: DataFrame, small: DataFrame, on: list[str], deal: Column, how: str = "left", salts: int = 16) -> DataFrame:
    """Equi-join whose large side may hold a third of its rows under one key: dealt over salts by ``deal``.

    The repeated side grows with the data, so it is never broadcast, however small its files are.
    """
    each = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return big.withColumn("__salt", F.pmod(F.xxhash64(deal), F.lit(salts)).cast("int")).join(each, [*on, "__salt"], how).drop("__salt")


def bloom_slots(hashes, bits: int) -> list:
    """Three slots of a Bloom filter per 64-bit hash."""
    u = hashes.view(np.uint64)
    return [((u >> np.uint64(s)) % np.uint64(bits)).astype(np.int64) for s in (0, 13, 31)]


def bloom(hashes: DataFrame, bits: int) -> bytes:
    """A Bloom filter over a DataFrame of one column of 64-bit hashes; ``bits`` bounds what reaches the driver."""

    def work(batch):
        bitmap = np.zeros(bits // 8, np.uint8)
        for slots in bloom_slots(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), bits):
            np.bitwise_or.at(bitmap, slots >> 3, (1 << (slots & 7)).astype(np.uint8))
        used = np.flatnonzero(bitmap)
        yield {"byte": used, "value": bitmap[used].astype(np.int32)}

    # One row per 256 bytes of the filter, so that few rows travel to the driver.
    parts = arrow_map(hashes, work, "byte long, value int").groupBy("byte").agg(F.bit_or("value").alias("value"))
    pages = parts.groupBy(F.expr("byte div 256").alias("page")).agg(F.collect_list(F.struct("byte", "value")).alias("bytes"))
    bitmap = np.zeros(bits // 8, np.uint8)
    for r in pages.collect():
        for b in r["bytes"]:
            bitmap[b["byte"]] = b["value"]
    return bitmap.tobytes()


def in_bloom(bitmap: bytes, hashes, bits: int):
    bytes_, found = np.frombuffer(bitmap, np.uint8), np.ones(len(hashes), bool)
    for slots in bloom_slots(hashes, bits):
        found &= (bytes_[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)
    return found


def logistic_weights(x, p, n, ridge: float, steps: int = 50):
    """Weights of a ridge logistic regression on soft labels ``p`` with counts ``n``.

    Newton steps, halved until the penalised loss falls: full steps diverge where labels are
    (nearly) separable.
    """

    def loss(w):
        z = x @ w
        return float(n @ (np.logaddexp(0, z) - p * z)) + ridge / 2 * float(w @ w)

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (n * q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (n * (p - q)) - ridge * w)
        while (then := loss(w + step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if then >= now:
            break
        w, now = w + step, then
    return w
