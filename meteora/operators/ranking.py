"""Global rank without funnelling all rows through one task.

Spark's ``rank().over(Window.orderBy(...))`` moves every row into a single
partition. ``global_rank`` counts the rows of each distinct value first, so
ties collapse in the map tasks, and ranks the values:

* buckets of about ``VALUES`` distinct values: quantiles of all distinct
  values cut up to ``BUCKETS`` coarse ranges, and where these would hold
  more, quantiles inside each coarse range (one grouped aggregation) cut it
  finer, so the number of buckets follows the distinct values. The bounds
  stand in the plan as one literal array, searched by halving, so the
  expression's size and the shuffle width don't matter;
* running counts inside a bucket (a window over its values), plus the counts
  of all earlier buckets (one row a bucket, so broadcasting it is bounded);
* the rank returns to the rows by a join on the value. Values that more than
  one row in ``HOT`` bears (there are fewer than HOT) are salted: their rows
  are dealt to ``SALTS`` tasks and their rank goes to each.

Rows with NULL, or NaN, are one distinct value each and have buckets of
their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 256
VALUES = 1_000_000
HOT = 1000
SALTS = 64


def value_bounds(values: DataFrame, buckets: int = BUCKETS, each: int = VALUES) -> tuple[list[float], list, int]:
    """Increasing bounds of the column ``v``, the hot values among those of
    ``values`` (v, n), and the total of ``n``."""
    v = F.col("v").cast("double")
    number = F.when(~F.isnan(v), v)
    share = lambda k: F.array(*[F.lit(i / k) for i in range(1, k)])
    r = values.agg(F.count(number).alias("distinct"), F.sum("n").alias("total"), F.max("n").alias("most"),
                   *([F.percentile_approx(number, share(buckets), 4 * buckets).alias("q")] if buckets > 1 else [])).first()
    bounds = sorted(set(r["q"] or [])) if buckets > 1 else []
    fine = -(-r["distinct"] // (buckets * each))
    if fine > 1:
        inside = (values.select(number.alias("v")).where("v IS NOT NULL").groupBy(bucket_of(F.col("v"), bounds).alias("b"))
                  .agg(F.percentile_approx("v", share(fine), 4 * fine).alias("q")).select(F.explode("q").alias("q")))
        bounds = sorted({*bounds, *(x["q"] for x in inside.collect())})
    hot = []
    if (r["most"] or 0) * HOT > r["total"]:
        hot = [x["v"] for x in values.where(F.col("n") * HOT > r["total"]).select("v").collect()]
    return bounds, hot, r["total"] or 0


def bucket_of(v: Column, bounds: list[float]) -> Column:
    """How many bounds lie below ``v``, found by halving."""
    if not bounds:
        return F.lit(0)
    table = F.lit(bounds)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def halve(at: Column, step: Column) -> Column:
        fits = (at + step <= len(bounds)) & (F.get(table, at + step - 1) < v)
        return F.when(fits, at + step).otherwise(at)

    return F.aggregate(F.lit(steps), F.lit(0), halve)


def global_rank(df: DataFrame, order_col: str, out: str = "rank",
                descending: bool = True, buckets: int = BUCKETS, each: int = VALUES) -> DataFrame:
    """Rank by ``order_col`` (gaps on ties; NULLs last when descending,
    first when ascending; NaN above every number, as Spark orders)."""
    v = F.col("v")
    values = df.groupBy(F.col(order_col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    bounds, hot, total = value_bounds(values, buckets, each)
    number = v.cast("double")
    above = (F.when(v.isNull(), -1).when(F.isnan(number), len(bounds) + 1)
             .otherwise(bucket_of(number, bounds)))
    values = values.withColumn("bucket", -above if descending else above)
    order = v.desc_nulls_last() if descending else v.asc_nulls_first()
    inside = Window.partitionBy("bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sizes = values.groupBy("bucket").agg(F.sum("n").alias("in_bucket"))
    offsets = sizes.select("bucket", (F.sum("in_bucket").over(before) - F.col("in_bucket")).alias("offset"))
    ranks = (values.withColumn("upto", F.sum("n").over(inside) - F.col("n"))
             .join(F.broadcast(offsets), "bucket")
             .select(v.alias("_v"), "n", (F.col("offset") + F.col("upto") + 1).cast("int").alias(out)))
    if not hot:
        return df.join(ranks.drop("n"), df[order_col].eqNullSafe(ranks["_v"])).drop("_v")
    x = F.col(order_col)
    is_hot = F.lit(False)
    for value in hot:
        is_hot = is_hot | x.eqNullSafe(F.lit(value).cast(df.schema[order_col].dataType))
    salted = df.withColumn("_salt", F.when(is_hot, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
                           .otherwise(0).cast("int"))
    spread = F.when(F.col("n") * HOT > total, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    ranks = ranks.select("_v", out, F.explode(spread).alias("_at"))
    same = salted[order_col].eqNullSafe(ranks["_v"]) & (salted["_salt"] == ranks["_at"])
    return salted.join(ranks, same).drop("_v", "_salt", "_at")
