"""Operators that depend on a total row order, without a single-task sort.

Rows are cut into order-preserving buckets of bounded size. The cut points come
from a small sample of the order columns, compared as tuples, so a timestamp
that a third of all rows share is cut by the tie-break column. What an earlier
bucket owes to a later one (the last rows of a rolling window, the last known
value of a fill, the running total) travels as a few carry rows per bucket.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemill.session import checkpointed

ROWS_PER_BUCKET = 200_000
MAX_BUCKETS = 100_000
BUCKETS_PER_PARTITION = 16
LEAST_ROWS = 25_000
SAMPLE_PER_BUCKET = 20
_LAST = sys.float_info.max
_BEFORE_LAST = 1.0e308


def micros(df: DataFrame, name: str) -> Column:
    """Epoch microseconds of a timestamp column of either kind."""
    return F.unix_micros(F.col(name).cast("timestamp"))


TEXT_BYTES = 6  # bytes of a string per number: exact in a double
TEXT_PARTS = 8  # numbers per string; longer strings are cut by their first 48 bytes only


def _numbers(df: DataFrame, order: Sequence[str]) -> tuple[list[Column], bool]:
    """The order columns as doubles whose lexicographic order is that of the columns; NULLs come last.

    Long integers become two numbers, strings as many as their bytes need. The flag tells whether
    the numbers hold all of every column; where they stop early, later columns are left out, so
    that the order is never inverted.
    """
    kinds = {c: df.schema[c].dataType for c in order}
    texts = [c for c in order if isinstance(kinds[c], T.StringType)]
    longest = df.agg(*[F.max(F.octet_length(c)).alias(c) for c in texts]).first() if texts else {}
    out: list[Column] = []
    for c in order:
        kind, value, whole = kinds[c], F.col(c), True
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            parts = [micros(df, c).cast("double")]
        elif isinstance(kind, T.LongType):
            parts = [F.shiftright(value, 26).cast("double"), F.pmod(value, F.lit(1 << 26)).cast("double")]
        elif isinstance(kind, T.StringType):
            needed = -(-(longest[c] or 0) // TEXT_BYTES)
            whole = needed <= TEXT_PARTS
            code = F.hex(F.encode(value, "UTF-8"))
            cut = [F.rpad(F.substring(code, 2 * TEXT_BYTES * k + 1, 2 * TEXT_BYTES), 2 * TEXT_BYTES, "0") for k in range(min(needed, TEXT_PARTS))]
            parts = [F.conv(x, 16, 10).cast("double") for x in cut] + [F.octet_length(value).cast("double")] * whole
        elif isinstance(kind, (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType)):
            # Adding zero turns -0.0 into 0.0, so that equal values share a bucket.
            parts = [F.least(value.cast("double") + F.lit(0.0), F.lit(_BEFORE_LAST))]
        elif isinstance(kind, T.DateType):
            parts = [F.unix_date(c).cast("double")]
        elif isinstance(kind, T.NumericType):
            parts, whole = [F.least(value.cast("double"), F.lit(_BEFORE_LAST))], False
        else:
            raise TypeError(f"rows can't be ordered by {c}: {kind.simpleString()}")
        out += [F.when(value.isNull(), F.lit(_LAST)).otherwise(x) for x in parts]
        if not whole:
            return out, False
    return out, True


def _slot(df: DataFrame, source: str, cuts: list[float], out: str) -> DataFrame:
    """Add the index of the cut interval a value falls in (binary search in the JVM)."""
    splits = [-float("inf"), *cuts, float("inf")]
    slotted = Bucketizer(splits=splits, inputCol=source, outputCol=out, handleInvalid="keep").transform(df)
    return slotted.withColumn(out, F.col(out).cast("long"))


def _bucket(df: DataFrame, numbers: list[str], bounds: list[tuple]) -> tuple[DataFrame, Column, int]:
    """(frame, bucket expression, number of buckets) for lexicographic ``bounds``.

    A first value that occurs in several bounds is hot: its rows are cut by the
    next column. Other rows of that interval come after it, so they take the
    number behind all its sub-buckets.
    """
    seen = Counter(b[0] for b in bounds)
    df = _slot(df, numbers[0], sorted(seen), f"_slot{len(numbers)}")
    coarse = F.col(f"_slot{len(numbers)}")
    hot = [value for value, n in seen.items() if n > 1]
    if not hot or len(numbers) == 1:
        return df, coarse, len(seen) + 1
    df, inner, size = _bucket(df, numbers[1:], sorted({b[1:] for b in bounds if seen[b[0]] > 1}))
    if (len(seen) + 1) * (size + 1) >= 2**62:
        return df, coarse, len(seen) + 1
    sub = F.when(F.col(numbers[0]).isin(hot), inner).otherwise(size)
    return df, coarse * (size + 1) + sub, (len(seen) + 1) * (size + 1)


def bucketed(
    df: DataFrame, order: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET, out: str = "_bucket"
) -> tuple[DataFrame, list[str], int]:
    """Add an order-preserving bucket number.

    Returns the frame, the columns that order it totally and the bucket count.
    Only the sampled cut points reach the driver (at most
    ``MAX_BUCKETS * SAMPLE_PER_BUCKET`` tuples, whatever the table's size).
    """
    order = list(order)
    total = df.count()
    wanted = -(-total // rows_per_bucket)
    if wanted <= 1:
        return df.withColumn(out, F.lit(0).cast("long")), order, 1
    # Buckets are hashed to shuffle partitions: several per partition even out.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MAX_BUCKETS, max(wanted, min(BUCKETS_PER_PARTITION * parts, total // LEAST_ROWS)))
    values, whole = _numbers(df, order)
    numbers = [f"_o{i}" for i in range(len(values))]
    fraction = min(1.0, SAMPLE_PER_BUCKET * wanted / total)
    sample = df.select([v.alias(n) for v, n in zip(values, numbers)]).sample(fraction, seed=11)
    points = sorted(tuple(r) for r in sample.collect())
    step = max(1, len(points) // wanted)
    bounds = points[step::step]
    if len(set(bounds)) < len(bounds) and whole:
        # Copies share all order columns: give each row its own number, fixed by
        # a checkpoint so that a recomputed task sees the same numbers.
        order.append("_seq")
        df = checkpointed(df.withColumn("_seq", F.monotonically_increasing_id()))
        return bucketed(df, order, rows_per_bucket, out)
    df = df.withColumns(dict(zip(numbers, values)))
    df, number, size = _bucket(df, numbers, sorted(set(bounds)))
    helpers = [c for c in df.columns if c in numbers or c.startswith("_slot")]
    return df.withColumn(out, number).drop(*helpers), order, size


def _ascending(order: Sequence[str]) -> list[Column]:
    return [F.asc_nulls_last(c) for c in order]


def _descending(order: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_first(c) for c in order]


def over_preceding(
    df: DataFrame, outputs: dict, needs: Sequence[str], window: int, order: Sequence[str],
    keys: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Evaluate ``outputs`` over the last ``window`` rows of the order, per key.

    ``outputs`` maps a name to a function of the window specification. One
    shuffle of the rows; the ``window - 1`` rows before each bucket come along
    as carry rows and are dropped afterwards.
    """
    keys, columns = list(keys), list(df.columns)
    df, order, buckets = bucketed(df, order, rows_per_bucket)
    ahead = window - 1
    if buckets > 1 and ahead > 0:
        held = list(dict.fromkeys([*keys, "_bucket", *order, *needs]))
        backwards = Window.partitionBy(*keys, "_bucket").orderBy(*_descending(order))
        # Row-number limits reach the map side, so only the tails are shuffled.
        tails = (
            df.select(*held).withColumn("_rn", F.row_number().over(backwards))
            .filter(F.col("_rn") <= ahead).drop("_rn")
        )
        # At most ``ahead`` rows per (key, bucket): small enough for one task per key.
        along = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*_ascending(order))
        tails = tails.withColumn("_at", F.row_number().over(along)).withColumn(
            "_first", ~F.col("_bucket").eqNullSafe(F.lag("_bucket").over(along))
        )
        # A bucket takes the ``ahead`` tail rows before its first: rows and buckets meet by stretch of the numbering.
        stretch = F.floor(F.col("_at") / ahead)
        firsts = tails.filter("_first").select(
            *[F.col(k).alias(f"_to_{k}") for k in keys], F.col("_bucket").alias("_to"), F.col("_at").alias("_to_at"), stretch.alias("_to_stretch")
        )
        same = F.col("_stretch") == F.col("_to_stretch")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_to_{k}"))
        carried = (
            tails.withColumn("_stretch", F.explode(F.array(stretch, stretch + 1))).join(firsts, same)
            .filter((F.col("_at") < F.col("_to_at")) & (F.col("_at") >= F.col("_to_at") - ahead))
            .select(F.col("_to").alias("_bucket"), *[c for c in held if c != "_bucket"], F.lit(True).alias("_carry"))
        )
        df = df.withColumn("_carry", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    spec = Window.partitionBy(*keys, "_bucket").orderBy(*_ascending(order)).rowsBetween(-ahead, 0)
    df = df.select("*", *[make(spec).alias(name) for name, make in outputs.items()])
    if "_carry" in df.columns:
        df = df.filter(~F.col("_carry"))
    return df.select(*columns, *[name for name in outputs if name not in columns])


def forward_fill(
    df: DataFrame, cols: Sequence[str] | None = None, order: Sequence[str] = ("timestamp", "event_id"),
    keys: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Replace NULLs by the last known value in row order, per key."""
    keys, columns = list(keys), list(df.columns)
    cols = [c for c in (cols or columns) if c not in keys and c not in order]
    df, order, buckets = bucketed(df, order, rows_per_bucket)
    if buckets > 1:
        at = F.struct(*order)
        last = df.groupBy(*keys, "_bucket").agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in cols]
        )
        before = (
            Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_bucket")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        carried = last.select(
            *keys, "_bucket", *[F.last(c, ignorenulls=True).over(before).alias(c) for c in cols],
            F.lit(0).alias("_rank"),
        )
        df = df.withColumn("_rank", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    else:
        df = df.withColumn("_rank", F.lit(1))
    spec = (
        Window.partitionBy(*keys, "_bucket").orderBy("_rank", *_ascending(order))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = set(cols)
    out = [F.last(c, ignorenulls=True).over(spec).alias(c) if c in filled else F.col(c) for c in columns]
    return df.select(*out, "_rank").filter(F.col("_rank") == 1).drop("_rank")


def running_totals(
    df: DataFrame, sums: Sequence[str], order: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Add ``<name>_before``: the total of the rows that precede this one."""
    columns = list(df.columns)
    df, order, buckets = bucketed(df, order, rows_per_bucket)
    spec = (
        Window.partitionBy("_bucket").orderBy(*_ascending(order)).rowsBetween(Window.unboundedPreceding, -1)
    )
    within = {s: F.coalesce(F.sum(s).over(spec), F.lit(0)) for s in sums}
    if buckets == 1:
        return df.select(*columns, *[within[s].alias(f"{s}_before") for s in sums])
    ahead = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy("_bucket").agg(*[F.sum(s).alias(s) for s in sums])
        .select("_bucket", *[F.coalesce(F.sum(s).over(ahead), F.lit(0)).alias(f"_off_{s}") for s in sums])
    )
    # One row per bucket, never more than a few times MAX_BUCKETS.
    return (
        df.select("*", *[within[s].alias(f"_in_{s}") for s in sums])
        .join(F.broadcast(offsets), "_bucket")
        .select(*columns, *[(F.col(f"_in_{s}") + F.col(f"_off_{s}")).alias(f"{s}_before") for s in sums])
    )


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], direct_rows: int = 1_000_000) -> list[float | None]:
    """Linear-interpolated quantiles of one numeric column, exact at any size."""
    return quantiles_of(df, [col], probs, direct_rows)[col]


def quantiles_of(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], direct_rows: int = 1_000_000
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of numeric columns, exact at any size, all columns and shares together.

    Tables of up to ``direct_rows`` use the built-in exact aggregate. Beyond, one pass brackets every
    wanted rank by approximate quantiles, one counts what lies below and inside the brackets, and, when
    all hold ``direct_rows`` rows or fewer, one ranks their distinct values; larger brackets are
    narrowed once more first. Three passes do for thousands of times ``direct_rows``. Only edges and
    counts reach the driver.
    """
    names = list(dict.fromkeys(cols))
    number = [F.col(c).cast("double") for c in names]
    values = df.select(*[F.when(~F.isnan(v), v).alias(f"v{k}") for k, v in enumerate(number)])
    counts = values.agg(*[F.count(v).alias(v) for v in values.columns]).first()
    totals = {v: counts[v] for v in values.columns}
    if not totals:
        return {}
    if max(totals.values()) <= direct_rows:
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        row = values.agg(*[F.percentile(v, wanted).alias(v) for v in values.columns]).first()
        return {c: [None] * len(probs) if not totals[v] else list(row[v]) for c, v in zip(names, values.columns)}

    brackets = [_Bracket(v, int(p * (n - 1)), p * (n - 1), n) for v, n in totals.items() if n for p in probs]
    while wide := [b for b in brackets if b.inside > direct_rows and b.shrinks]:
        _narrow(values, wide)
    found = iter(_ranked(values, brackets, direct_rows))
    return {c: [next(found) if totals[v] else None for _ in probs] for c, v in zip(names, values.columns)}


@dataclass
class _Bracket:
    """A range of a column's values that holds the rank wanted and the next one."""

    column: str
    rank: int
    position: float
    inside: int
    under: int = 0
    low: float | None = None  # None: open
    high: float | None = None
    shrinks: bool = True

    @property
    def last(self) -> int:
        return self.rank + (self.position > self.rank)

    def holds(self) -> Column:
        v = F.col(self.column)
        return v.isNotNull() if self.low is None else v.between(self.low, self.high)


REACH, ACCURACY = 3e-4, 10_000  # half a bracket's share of the rows, and the sketch's: one in so many


def _narrow(values: DataFrame, brackets: list[_Bracket]) -> None:
    """Smaller brackets for all, in two passes over the values."""
    def share(b: _Bracket, rank: int, by: float) -> Column:
        return F.lit(min(1.0, max(0.0, (rank - b.under) / b.inside + by)))

    edges = values.agg(*[
        F.percentile_approx(F.when(b.holds(), F.col(b.column)), F.array(share(b, b.rank, -REACH), share(b, b.last, REACH)), ACCURACY).alias(f"e{k}")
        for k, b in enumerate(brackets)
    ]).first()
    counts = values.agg(*[
        x for k, b in enumerate(brackets)
        for x in (F.count_if(F.col(b.column) < edges[k][0]).alias(f"u{k}"), F.count_if(F.col(b.column).between(*edges[k])).alias(f"n{k}"))
    ]).first()
    for k, b in enumerate(brackets):
        under, inside = counts[f"u{k}"], counts[f"n{k}"]
        if under <= b.rank and b.last < under + inside and inside < b.inside:
            b.low, b.high, b.under, b.inside = *edges[k], under, inside
            b.shrinks = b.low < b.high
        else:
            b.shrinks = False  # ties or a sketch off its mark: ranked as it is


def _ranked(values: DataFrame, brackets: list[_Bracket], direct_rows: int) -> list[float]:
    """The quantile of each bracket from its distinct values and their counts."""
    single = {k: b.low for k, b in enumerate(brackets) if b.low is not None and b.low == b.high}
    small = [k for k, b in enumerate(brackets) if k not in single and b.inside <= direct_rows]
    found = {k: (v, v) for k, v in single.items()}
    if small:
        own = F.array(*[F.struct(F.lit(k).alias("k"), F.when(brackets[k].holds(), F.col(brackets[k].column)).alias("v")) for k in small])
        rows = values.select(F.explode(F.filter(own, lambda x: x.v.isNotNull())).alias("x"))
        counted = rows.groupBy("x.k", "x.v").agg(F.count("*").alias("n"))
        # At most ``direct_rows`` values a bracket.
        upto = F.sum("n").over(Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ends = counted.withColumn("upto", upto)
        rank, last = (
            F.element_at(F.create_map(*[F.lit(x) for k in small for x in (k, r(brackets[k]))]), F.col("k"))
            for r in (lambda b: b.rank - b.under, lambda b: b.last - b.under)
        )
        at = lambda r: F.min(F.when(F.col("upto") > r, F.col("v")))
        found |= {r["k"]: (r["a"], r["b"]) for r in ends.groupBy("k").agg(at(rank).alias("a"), at(last).alias("b")).collect()}
    for k, b in enumerate(brackets):
        if k not in found:  # many ties in a large bracket: a distributed running total over its distinct values
            counted = values.filter(b.holds()).groupBy(F.col(b.column).alias("v")).agg(F.count("*").alias("n"))
            totals = running_totals(counted, ["n"], ["v"], direct_rows)
            at = [totals.filter((F.col("n_before") <= r) & (F.col("n_before") + F.col("n") > r)).first()["v"] for r in (b.rank - b.under, b.last - b.under)]
            found[k] = tuple(at)
    return [a + (b - a) * (x.position - x.rank) for (a, b), x in zip((found[k] for k in range(len(brackets))), brackets)]
