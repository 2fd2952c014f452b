"""Quality rules: counts per document and a hashed n-gram log-likelihood
ratio between a trusted target and the raw corpus. Spark expressions only.

The n-grams are lower-cased words and pairs of neighbouring ones, each kind
hashed into half of ``BUCKETS`` counters. The raw multinomial counts every document. The trusted one counts
documents that ``labels`` calls good; labelled documents are split by a hash
of their id: all of one half are counted and all of the other set the
threshold, which must come from documents that the counts have not seen. With r and g the counts of a bucket, R and G
their totals, a bucket weighs log((g R / G + ALPHA) / (r + ALPHA)): what the
corpus has and the trusted side hasn't counts against a document; weights have
three decimals. The score
is the mean over a document's n-grams. A document is kept if it passes the
base rules and its score reaches that which ``KEPT`` of the held-out good
documents reach. Without trusted or held-out documents every score passes.

Cases: null, empty and wordless texts have no words, fail the base rules and
have score 0; repeated rows are judged alike and counted each; several labels
of one id count once, and it is good if one says so; an empty table gives no
rows; other columns are not read (``keep_good`` keeps them under their names).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteora.llm.common import SPACE_CLASS, drop, let, scratch, words

BUCKETS = 1 << 16
#: The most labelled documents of each half; None: all.
TRUSTED = None
HELD_OUT = None
#: Numbers of 64 bits by which labelled ids are looked for at first.
HASH_WORDS = 1 << 18
ALPHA = 0.1
KEPT = 0.99
WINDOW = 5
SYMBOLS = "[^#*$%&|<>]+"
#: Fixed by contract: documents with fewer words fail.
LEAST_WORDS = 10


def _bucket(x: Column, kind: int) -> Column:
    half = BUCKETS // 2
    return (F.pmod(x, F.lit(half)) + kind * half).cast("int")


def word_hashes(text: Column) -> Column:
    """Hashes of a text's words."""
    return F.transform(words(F.lower(F.coalesce(text, F.lit("")))), lambda w: F.xxhash64(w))


def ngram_buckets(hashes: Column) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    return let(hashes, lambda hs: F.concat(
        F.transform(hs, lambda h: _bucket(h, 0)),
        F.transform(F.slice(hs, 2, F.greatest(F.size(hs) - 1, F.lit(0))),
                    lambda h, i: _bucket(F.xxhash64(h, F.get(hs, i)), 1))))


def _windows(words_: Column) -> Column:
    """A hash for every window of WINDOW neighbouring words."""
    return let(F.transform(words_, lambda w: F.xxhash64(w)), lambda hashes: F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)])))


def _covered(windows: Column) -> Column:
    """Words inside windows that occur twice or more, each counted once."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = let(placed, lambda p: F.filter(p, lambda x, i: F.coalesce(
        x["h"] == F.when(i > 0, F.get(p, i - 1)["h"]), F.lit(False)) | F.coalesce(
        x["h"] == F.get(p, i + 1)["h"], F.lit(False))))
    at = F.sort_array(F.transform(twice, lambda x: x["i"]))
    return F.aggregate(at, F.expr("struct(0L AS n, -1 AS upto)"), lambda acc, p: F.struct(
        (acc["n"] + p + WINDOW - F.greatest(p, acc["upto"])).cast("long").alias("n"),
        (p + WINDOW).alias("upto")))["n"]


def base_counts(docs: DataFrame, text: str = "text", keep: tuple = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` with n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words and base_failed."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.rlike(x, F.lit(f"[^{SPACE_CLASS}]")))
    d = docs.select(*keep, t.alias("_t"), words(t).alias("_w"), lines.alias("_l"))
    d = d.select(*keep, F.size("_w").cast("long").alias("n_words"),
                 F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                 F.length(F.regexp_replace("_t", SYMBOLS, "")).cast("long").alias("n_symbols"),
                 (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                 _windows(F.col("_w")).alias("_r"))
    d = d.withColumn("n_repeat_words", F.when(F.size("_r") == F.size(F.array_distinct("_r")), F.lit(0).cast("long"))
                     .otherwise(_covered(F.col("_r")))).drop("_r")
    return d.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                        | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def labelled(labels: DataFrame, half: int, most: int | None = None) -> DataFrame:
    """doc_id of the documents labelled good in one half, of at most ``most``
    if that is given."""
    h = F.xxhash64("doc_id")
    judged = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        (F.max("quality") >= 1).alias("good"))
    found = judged.where(F.col("good") & (F.pmod(h, F.lit(2)) == half)).select("doc_id")
    return found if most is None else found.orderBy(h, "doc_id").limit(most)


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and half of the rows of ``docs`` labelled good, a scratch table.
    Rows whose id's hash has no bit among those of these labels go by a
    broadcast of at most ``HASH_WORDS`` numbers of 64 bits, so few texts but
    the labelled ones are shuffled; ids themselves are compared then, by a
    shuffled join at every size."""
    ids = scratch(labelled(labels, 0, TRUSTED).withColumn("half", F.lit(0)).union(
        labelled(labels, 1, HELD_OUT).withColumn("half", F.lit(1))), "labelled")
    h = F.xxhash64("doc_id")
    word = F.pmod(h, F.lit(HASH_WORDS)).alias("_word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 58).cast("int"))
    bits = ids.select(word, bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    near = (docs.select("doc_id", "text", word, bit.alias("_bit")).join(F.broadcast(bits), "_word")
            .where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select("doc_id", "text"))
    out = scratch(near.join(ids.hint("shuffle_hash"), "doc_id").select("text", "half"), "trusted", "zstd")
    drop(ids)
    return out


def fit(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """A scratch table of one row, the weights of all buckets, and the
    threshold; three numbers reach the driver."""
    good = trusted_texts(docs, labels)
    grams = (docs.select("text", F.lit(False).alias("good"))
             .union(good.where("half = 0").select("text", F.lit(True)))
             .select("good", F.explode(ngram_buckets(word_hashes(F.col("text")))).alias("bucket")))
    counts = scratch(grams.groupBy("bucket").agg(F.count_if(~F.col("good")).alias("raw"),
                                                 F.count_if("good").alias("good")), "counts")
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).first()
    none = F.lit(0).cast("long")
    r, g = (F.coalesce(c, none) for c in ("raw", "good"))
    weight = F.round(F.log((g * float(total["raw"]) / float(total["good"]) + ALPHA) / (r + ALPHA)), 3) \
        if total["good"] else F.lit(0.0)
    weights = scratch(docs.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket").join(counts, "bucket", "left")
                      .select("bucket", weight.alias("w")).groupBy()
                      .agg(F.array_sort(F.collect_list(F.struct("bucket", "w")))["w"].alias("weights")), "weights")
    low = None
    if total["good"]:
        enough = F.size(words(F.col("text"))) >= LEAST_WORDS
        held = good.where("half = 1").where(enough).select("text", weights.scalar().alias("weights"))
        low = held.select(score(F.col("text"), F.col("weights")).alias("s")).agg(
            F.percentile("s", F.lit(1 - KEPT)).alias("low")).first()["low"]
    drop(counts, good)
    return weights, -math.inf if low is None else low


def score(text: Column, weights: Column) -> Column:
    """Mean weight of a text's n-grams, 0 without any. ``weights`` comes from
    a subquery in a select before (``fit(...)[0].scalar()``): plans name it,
    and don't hold the weights."""
    hashes = word_hashes(text)

    def mean(table):
        total = F.aggregate(hashes, F.expr("struct(0D AS s, 0 AS n, 0L AS last)"), lambda acc, h: F.struct(
            (acc["s"] + F.get(table, _bucket(h, 0)) + F.when(acc["n"] > 0, F.get(table, _bucket(F.xxhash64(h, acc["last"]), 1)))
             .otherwise(0.0)).alias("s"),
            (acc["n"] + 1).alias("n"), h.alias("last")))
        return F.transform(F.array(total), lambda t: F.when(t["n"] > 0, t["s"] / (2 * t["n"] - 1)).otherwise(0.0))[0]

    return let(weights, mean)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, llr."""
    weights, low = fit(docs, labels)
    scored = docs.select("doc_id", "text", weights.scalar().alias("weights")).select(
        "doc_id", "text", score(F.col("text"), F.col("weights")).alias("llr"))
    out = base_counts(scored, keep=("doc_id", "llr"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & (F.col("llr") >= low)).alias("kept"), "llr")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    weights, low = fit(docs, labels)
    scored = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text"),
                         weights.scalar().alias("_weights")).select(
        "_row", "_text", score(F.col("_text"), F.col("_weights")).alias("_llr"))
    judged = base_counts(scored, text="_text", keep=("_row", "_llr"))
    return judged.where(~F.col("base_failed") & (F.col("_llr") >= low)).select("_row.*")
