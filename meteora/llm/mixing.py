"""Mixing sources to target weights by Pareto order sampling.

Sources in code-point order (null last) weigh 3, 1, 2, 3, 1, 2, ... and share
``share`` times the words of the corpus by weight; a source's target stops at
``most`` times its own words and the excess is reshared by weight among the
others until none is above (one pass over the sources sorted by cap/weight
finds that fixed point).

A source with target T and S words takes every document floor(T/S) times for
certain. The rest R = T - floor(T/S) * S is sampled with inclusion
probabilities in proportion to size, p = min(1, rate * size), the rate being
such that the expected words are R: the largest sizes are certain (p = 1) as
long as the rate of what is left would put them at 1 or more. Each document
draws a uniform u from a hash of its id and ranks by the Pareto key
q = (u/(1-u)) / (p/(1-p)); certain documents have q = 0. The sample is the
head of that order with a fixed size in words: a document is in as long as
its midpoint in the running sum of words is at most R, so a source misses its
target by half a document at most.

No source is sorted. Words are summed by cells of log q, and the first cell in
which the running sum passes R is the only one that isn't in or out as a
whole; it is cut into finer cells the same way, and only the documents of one
fine cell (about one in four million of a source) are put in order. Rates need
one row for each size that a source has, at most the square root of twice its
words. Sources with many rows are joined by broadcast, the others by a
shuffle.

Cases: null or wordless text has size 0, takes no part in the draw and takes
0; the null source is a source of its own, last; a null id draws u from its
text, so such rows don't meet in one cell; equal keys are ordered by id and
size; repeated rows are documents of their own; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteora.llm.common import drop, join_spread, scratch, words

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix-1"
#: Cells of log2 q for each unit, coarse and then fine.
CELLS = (1 << 10, 1 << 20)
#: The cell of certain documents, below all others.
CERTAIN = -(1 << 40)


def source_targets(totals: DataFrame, share: float = SHARE, most: int = MOST,
                   weights: tuple = WEIGHTS) -> DataFrame:
    """(source, s long) -> (source, s, target double). One row per source
    passes through the windows."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    k = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.lit(weights[-1])
    for i, w in enumerate(weights[:-1]):
        weight = F.when(F.col("k") == i, w).otherwise(weight)
    t = (totals.withColumn("k", k).withColumn("w", weight.cast("long"))
         .withColumn("cap", most * F.col("s"))
         .withColumn("total", F.sum("s").over(everything)))
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    t = (t.withColumn("r", F.row_number().over(order))
         .withColumn("cap_before", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
         .withColumn("w_left", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", (F.lit(share) * F.col("total") - F.col("cap_before")) / F.col("w_left")))
    t = t.withColumn("first", F.min(F.when(F.col("cap") / F.col("w") >= F.col("level"), F.col("r"))).over(everything))
    t = t.withColumn("flat", F.max(F.when(F.col("r") == F.col("first"), F.col("level"))).over(everything))
    target = F.when(F.col("first").isNull() | (F.col("r") < F.col("first")), F.col("cap").cast("double")) \
        .otherwise(F.col("flat") * F.col("w"))
    return t.select("source", "s", F.least(target, F.col("cap").cast("double")).alias("target"))


def uniform(doc_id, text, seed: str = SEED):
    """A number in (0, 1) from the id, or the text where it is null: 52 bits of an md5."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), F.coalesce(text, F.lit(""))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), name)), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def sampling_rates(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``sizes`` (source, size, n) and ``targets`` (source, s, target) ->
    (source, s, target, whole, rest, rate, top): sizes above ``top`` are
    certain, the others have the probability rate * size. A source without a
    rest has neither."""
    whole = F.when(F.col("s") > 0, F.floor(F.col("target") / F.col("s"))).otherwise(0)
    t = targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("s"))
    rests = t.where("rest > 0").select(F.col("source").alias("of"), "rest")
    words_of = F.col("n") * F.col("size")
    squares = words_of.cast("decimal(19,0)") * F.col("size").cast("decimal(19,0)")
    source = Window.partitionBy("source")
    larger = source.orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    smaller = source.orderBy(F.col("size").desc()).rowsBetween(0, Window.unboundedFollowing)
    step = (sizes.where("size > 0")
            .withColumn("above", F.coalesce(F.sum(words_of).over(larger), F.lit(0)))
            .withColumn("below", F.sum(squares).over(smaller).cast("double")))
    step = (step.join(rests, F.col("source").eqNullSafe(F.col("of")))
            .withColumn("rate", (F.col("rest") - F.col("above")) / F.col("below"))
            .where("rate * size < 1").groupBy("source")
            .agg(F.max(F.struct("size", "rate")).alias("best"))
            .select(F.col("source").alias("of"), F.col("best.rate").alias("rate"), F.col("best.size").alias("top")))
    return t.join(step, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")


def _keyed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source and the Pareto key ``q``;
    null where nothing is drawn."""
    p = F.col("rate") * F.col("size")
    key = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    return (join_spread(rows, sources, "source", "n").withColumn("p", p)
            .withColumn("q", F.when((F.col("size") > 0) & (F.col("rest") > 0),
                                    F.when(F.col("size") > F.col("top"), 0.0).otherwise(key))))


def _cell(per_unit: int):
    return F.when(F.col("q") > 0, F.floor(F.log2("q") * per_unit)).when(F.col("q") == 0, CERTAIN)


def _passed(keyed: DataFrame, sources: DataFrame, per_unit: int, cut: str, before: str) -> DataFrame:
    """``sources`` with the cell ``cut`` in which the running sum of words
    passes the rest, and ``before`` with the sum up to it."""
    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = (keyed.withColumn("cell", _cell(per_unit)).where("cell IS NOT NULL")
             .groupBy("source", "cell").agg(F.sum("size").alias("inside"), F.first("rest").alias("rest"),
                                            F.first("base").alias("base"))
             .withColumn("upto", F.col("base") + F.sum("inside").over(upto)))
    first = (cells.where("upto > rest").groupBy(F.col("source").alias("of"))
             .agg(F.min(F.struct("cell", (F.col("upto") - F.col("inside")).alias("before"))).alias("f"))
             .select("of", F.col("f.cell").alias(cut), F.col("f.before").alias(before)))
    return scratch(sources.join(first, F.col("source").eqNullSafe(F.col("of")), "left").drop("of"), "cuts")


def mix(docs: DataFrame, share: float = SHARE, most: int = MOST, weights: tuple = WEIGHTS,
        seed: str = SEED, carry: tuple = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies; ``carry`` names further
    columns of ``docs`` to keep (under the prefix ``in_``)."""
    coarse, fine = CELLS
    sized = scratch(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.size(words(F.col("text"))).cast("long").alias("size"), uniform(F.col("doc_id"), F.col("text"), seed).alias("u"),
        *[F.col(c).alias(f"in_{c}") for c in carry]), "sizes")
    sizes = scratch(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    sums = scratch(sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("s"), F.sum("n").alias("n")),
                   "sums")
    targets = source_targets(sums.select("source", "s"), share, most, weights)
    rows_of = sums.select(F.col("source").alias("of"), "n")
    sources = scratch(sampling_rates(sizes, targets).join(rows_of, F.col("source").eqNullSafe(F.col("of"))).drop("of"),
                      "rates")
    drop(sizes, sums)
    small = sized.select("source", "size", "u")
    first = _passed(_keyed(small, sources).withColumn("base", F.lit(0)), sources, coarse, "cut", "base")
    drop(sources)
    cuts = _passed(_keyed(small, first).where(_cell(coarse) == F.col("cut")), first, fine, "fine_cut", "before")
    drop(first)
    inside = (Window.partitionBy("source").orderBy("q", F.col("doc_id").asc_nulls_last(), "size")
              .rowsBetween(Window.unboundedPreceding, 0))
    # both counts of cells are powers of two, so a fine cell lies in one coarse cell
    place = F.signum(_cell(fine) - F.col("fine_cut")).cast("int")
    keyed = _keyed(sized, cuts).withColumn("place", F.coalesce(place, F.lit(1)))
    apart = keyed.where("place <> 0").withColumn("drawn", F.col("place") < 0)
    middle = F.col("before") + F.sum("size").over(inside) - F.col("size") / 2
    ranked = keyed.where("place = 0").withColumn("drawn", middle <= F.col("rest"))
    copies = (F.col("whole") + F.col("drawn").cast("long"))
    return apart.unionByName(ranked).select(
        "doc_id", "size", F.col("s").alias("source_size"), "target",
        (copies * F.col("size")).cast("long").alias("taken"), copies.cast("int").alias("copies"),
        *[F.col(f"in_{c}") for c in carry])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null:' || coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496.0::DOUBLE AS u
  FROM documents),
sums AS (
  SELECT source, sum(size)::BIGINT AS s, 2 * sum(size)::BIGINT AS cap,
         [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::BIGINT AS w
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, row_number() OVER o AS r, (sum(cap) OVER o)::BIGINT - cap AS cap_before,
         (sum(w) OVER ())::BIGINT - (sum(w) OVER o)::BIGINT + w AS w_left, (sum(s) OVER ())::BIGINT AS total
  FROM sums
  WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
levels AS (SELECT *, (1.5::DOUBLE * total - cap_before) / w_left AS level FROM ordered),
firsts AS (SELECT *, min(CASE WHEN cap::DOUBLE / w >= level THEN r END) OVER () AS f FROM levels),
flats AS (SELECT *, max(CASE WHEN r = f THEN level END) OVER () AS flat FROM firsts),
targets AS (
  SELECT source, s, least(CASE WHEN f IS NULL OR r < f THEN cap::DOUBLE ELSE flat * w END, cap::DOUBLE) AS target
  FROM flats),
rests AS (
  SELECT source, s, target, whole, target - whole * s AS rest
  FROM (SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS whole FROM targets)),
steps AS (
  SELECT h.source, size, rest,
         coalesce((sum(n * size) OVER (PARTITION BY h.source ORDER BY size DESC
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT, 0) AS above,
         (sum(n::HUGEINT * size * size) OVER (PARTITION BY h.source ORDER BY size DESC
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS below
  FROM (SELECT source, size, count(*) AS n FROM sized WHERE size > 0 GROUP BY source, size) h
  JOIN rests t ON h.source IS NOT DISTINCT FROM t.source WHERE rest > 0),
rates AS (
  SELECT source, max(size) AS top, arg_max((rest - above) / below, size) AS rate
  FROM steps WHERE (rest - above) / below * size < 1 GROUP BY source),
probable AS (
  SELECT d.*, t.s, t.target, t.whole, t.rest, r.top, r.rate * d.size AS p
  FROM sized d JOIN rests t ON d.source IS NOT DISTINCT FROM t.source
  LEFT JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
keyed AS (
  SELECT *, CASE WHEN size > 0 AND rest > 0 THEN
              CASE WHEN size > top THEN 0.0::DOUBLE ELSE (u / (1 - u)) / (p / (1 - p)) END END AS q
  FROM probable),
ran AS (
  SELECT *, (sum(CASE WHEN q IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source
             ORDER BY q NULLS LAST, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING))::BIGINT
            - size / 2.0::DOUBLE AS middle
  FROM keyed),
drawn AS (SELECT *, q IS NOT NULL AND middle <= rest AS d FROM ran)
SELECT doc_id, size, s AS source_size, target, ((whole + d::INT) * size)::BIGINT AS taken,
       (whole + d::INT)::INT AS copies
FROM drawn
"""
