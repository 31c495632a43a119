"""Joining predictions to the readings within a few seconds of them.

Two forms. ``interval_join`` returns the pairs, which is what a view of the
joined rows needs. ``nearby_sums`` returns, for each row, sums over the other
side's rows in range, by running totals; the dashboard aggregates use it, so they
never build pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemill.session import checkpointed
from telemill.operators.ordered import micros

SECOND = 1_000_000
TOLERANCE_S = 5
HOT_ROWS = 200_000
ROWS_PER_SALT = 50_000
MAX_BROADCAST_BUCKETS = 100_000  # hot buckets, some 40 bytes each
LOOKUP_COPIES = 16


def _hot_buckets(left: DataFrame, right: DataFrame, key: str, hot_rows: int, rows_per_salt: int) -> DataFrame:
    """(_hk, _hb, _a, _b): the buckets with ``hot_rows`` rows or more on a side, and both sides' salts.

    Counts are exact and summed up before the shuffle; the table stays distributed.
    """
    sides = [
        rows.groupBy(F.col(k).alias("_hk"), F.col(b).alias("_hb")).agg(F.count("*").alias("n")).filter(F.col("n") >= hot_rows)
        .select("_hk", "_hb", *[(F.ceil(F.col("n") / rows_per_salt) if c == own else F.lit(1)).cast("int").alias(c) for c in ("_a", "_b")])
        for rows, k, b, own in ((left, key, "_bk", "_a"), (right, "_rk", "_rbk", "_b"))
    ]
    return sides[0].unionByName(sides[1]).groupBy("_hk", "_hb").agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))


def _with_salts(rows: DataFrame, salts: DataFrame, count: int, key: str, bucket: str) -> DataFrame:
    """Every row with its bucket's salts, NULL in cold ones. Few buckets are broadcast; of more, each is
    repeated a few times and the rows, which may be a third under one key, are dealt over the copies."""
    if count <= MAX_BROADCAST_BUCKETS:
        return rows.join(F.broadcast(salts), (F.col(key) == F.col("_hk")) & (F.col(bucket) == F.col("_hb")), "left").drop("_hk", "_hb")
    rows = checkpointed(rows.withColumn("_deal", (F.monotonically_increasing_id() % LOOKUP_COPIES).cast("int")))
    copies = salts.withColumn("_copy", F.explode(F.expr(f"sequence(0, {LOOKUP_COPIES - 1})")))
    same = (F.col(key) == F.col("_hk")) & (F.col(bucket) == F.col("_hb")) & (F.col("_deal") == F.col("_copy"))
    return rows.join(copies.hint("merge"), same, "left").drop("_hk", "_hb", "_deal", "_copy")


def interval_join(
    left: DataFrame, right: DataFrame, right_cols: Sequence[str], key: str = "machine_id",
    ts: str = "timestamp", tolerance_s: int = TOLERANCE_S, hot_rows: int = HOT_ROWS, rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Left rows with every right row of the same key within the tolerance.

    Both ends are inclusive; a left row without a match appears once with NULLs.
    Time buckets of twice the tolerance keep the equi-join groups small: a left
    row sits in its own bucket, a right row in the one or two buckets it can
    reach, so each pair meets exactly once.
    """
    tol, width = tolerance_s * SECOND, 2 * tolerance_s * SECOND
    left_cols = list(left.columns)
    lt = left.withColumn("_us", micros(left, ts)).withColumn("_bk", F.floor(F.col("_us") / width))
    reach = F.array_distinct(F.array(F.floor((F.col("_rus") - tol) / width), F.floor((F.col("_rus") + tol) / width)))
    rt = (
        right.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .select(F.col(key).alias("_rk"), micros(right, ts).alias("_rus"), *[F.col(c).alias(f"_r_{c}") for c in right_cols])
        .withColumn("_rbk", F.explode(reach))
    )
    near = F.col("_us").between(F.col("_rus") - tol, F.col("_rus") + tol)
    equal = (F.col(key) == F.col("_rk")) & (F.col("_bk") == F.col("_rbk"))

    salts = checkpointed(_hot_buckets(lt, rt, key, hot_rows, rows_per_salt))
    count = salts.count()
    joined = _salted(lt, rt, key, equal, near, salts, count, tolerance_s) if count else lt.join(rt, equal & near, "left")
    return joined.select(*left_cols, *[F.col(f"_r_{c}").alias(c) for c in right_cols])


def _salted(
    lt: DataFrame, rt: DataFrame, key: str, equal: Column, near: Column, salts: DataFrame, count: int, tolerance_s: int
) -> DataFrame:
    """The same join with hot buckets cut into a grid of salts.

    Within a hot bucket the left rows are dealt to ``a`` salts and the right rows
    to ``b``; each side is repeated over the other's salts, so every pair meets
    in exactly one of the ``a * b`` cells. Which left times have no right row in range
    follows from running totals over distinct times, which copies cannot inflate.
    """
    lt, rt = _with_salts(lt, salts, count, key, "_bk"), _with_salts(rt, salts, count, "_rk", "_rbk")
    is_hot = F.col("_a").isNotNull()
    cold = lt.filter(~is_hot).drop("_a", "_b").join(rt.filter(~is_hot).drop("_a", "_b"), equal & near, "left")
    # Salts come from row numbers that a checkpoint of the hot rows fixes: a repeated task deals alike.
    deal = F.abs(F.xxhash64("_n") % 1_000_003)
    hot_l, hot_r = (checkpointed(t.filter(is_hot).withColumn("_n", F.monotonically_increasing_id())) for t in (lt, rt))
    grid_l = (
        hot_l
        .withColumn("_sa", (deal % F.col("_a")).cast("int"))
        .withColumn("_sb", F.explode(F.expr("sequence(0, _b - 1)")))
        .drop("_a", "_b", "_n")
    )
    grid_r = (
        hot_r
        .withColumn("_rsb", (deal % F.col("_b")).cast("int"))
        .withColumn("_rsa", F.explode(F.expr("sequence(0, _a - 1)")))
        .drop("_a", "_b", "_n")
    )
    matched = grid_l.join(
        grid_r, equal & near & (F.col("_sa") == F.col("_rsa")) & (F.col("_sb") == F.col("_rsb")), "inner"
    ).drop("_sa", "_sb", "_rsa", "_rsb")
    met = hot_l.select(F.col(key).alias("_tk"), F.col("_us").alias("us"), F.lit(0).alias("seen")).union(hot_r.select("_rk", "_rus", F.lit(1)))
    # A right row stands in every bucket it reaches, so a left time of a hot bucket finds all of its range here.
    totals = nearby_sums(met.groupBy("_tk", "us").agg(F.max("seen").alias("seen")), ["seen"], "_tk", "us", tolerance_s)
    alone = totals.filter("near_seen = 0").select("_tk", F.col("us").alias("_tu"))
    lonely = hot_l.drop("_a", "_b", "_n").join(alone, (F.col(key) == F.col("_tk")) & (F.col("_us") == F.col("_tu")), "left_semi")
    return cold.unionByName(matched).unionByName(lonely, allowMissingColumns=True)


def nearest_join(
    left: DataFrame, right: DataFrame, right_cols: Sequence[str], tie: str, key: str = "machine_id",
    ts: str = "timestamp", tolerance_s: int = TOLERANCE_S, block_s: int = 60,
) -> DataFrame:
    """Left rows with the closest right row in range, or NULLs (ties: smallest ``tie``).

    No pairs are built. Both sides shrink to distinct times; within a time block
    the last right row at or before, and the first at or after, come from two
    running windows over the same shuffle.
    """
    tol, width = tolerance_s * SECOND, block_s * SECOND
    own = F.floor(F.col("_us") / width)
    timed = left.withColumns({"_us": micros(left, ts), "_key": F.col(key)})
    asked = timed.filter("_us IS NOT NULL AND _key IS NOT NULL").select("_key", "_us").distinct()
    reach = F.array_distinct(F.array(own, F.floor((F.col("_us") - tol) / width), F.floor((F.col("_us") + tol) / width)))
    answer = F.struct(F.col("_us").alias("us"), F.col(tie).alias("tie"), F.struct(*right_cols).alias("row"))
    offered = (
        right.withColumns({"_us": micros(right, ts), "_key": F.col(key)})
        .filter("_us IS NOT NULL AND _key IS NOT NULL")
        .groupBy("_key", "_us").agg(F.min(answer).alias("_right"))
        .withColumn("_blk", F.explode(reach))
    )
    both = asked.withColumn("_blk", own).unionByName(offered, allowMissingColumns=True)
    spec = Window.partitionBy("_key", "_blk").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        both.withColumn("_before", F.last("_right", ignorenulls=True).over(spec.orderBy("_us")))
        .withColumn("_after", F.last("_right", ignorenulls=True).over(spec.orderBy(F.desc("_us"))))
        .filter("_right IS NULL")
    )

    def candidate(name: str) -> Column:
        gap = F.abs(F.col("_us") - F.col(f"{name}.us"))
        ranked = F.struct(gap.alias("gap"), F.col(f"{name}.tie").alias("tie"), F.col(f"{name}.row").alias("row"))
        return F.when(gap <= tol, ranked)

    best = found.select(F.col("_key").alias("_k"), F.col("_us").alias("_u"), F.least(candidate("_before"), candidate("_after")).alias("_best"))
    matched = timed.join(best, (F.col("_key") == F.col("_k")) & (F.col("_us") == F.col("_u")), "left")
    return matched.select(*left.columns, *[F.col(f"_best.row.{c}").alias(c) for c in right_cols])


def nearby_sums(
    rows: DataFrame, sums: Sequence[str], key: str = "machine_id", us: str = "us",
    tolerance_s: int = TOLERANCE_S, block_s: int = 60,
) -> DataFrame:
    """Add ``near_<name>``: the column's total over rows of the key in range.

    ``rows`` holds both sides, already grouped by time, each with zeros in the
    other side's measures. Inside a time block the total in [t - tol, t + tol] is
    the difference of two running totals, so the cost is linear however dense the
    block is. Rows near a block's edge are copied to the neighbour they reach.
    """
    tol, width = tolerance_s * SECOND, block_s * SECOND
    own = F.floor(F.col(us) / width)
    reach = F.array_distinct(F.array(own, F.floor((F.col(us) - tol) / width), F.floor((F.col(us) + tol) / width)))
    spread = rows.withColumn("_blk", F.explode(reach))
    spec = Window.partitionBy(key, "_blk").orderBy(us)
    upto = spec.rangeBetween(Window.unboundedPreceding, tol)
    before = spec.rangeBetween(Window.unboundedPreceding, -tol - 1)
    totals = [
        (F.coalesce(F.sum(s).over(upto), F.lit(0)) - F.coalesce(F.sum(s).over(before), F.lit(0))).alias(f"near_{s}")
        for s in sums
    ]
    return spread.select("*", *totals).filter(F.col("_blk") == own).drop("_blk")
