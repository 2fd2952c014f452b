"""Language identification of web pages by Bayesian evidence fusion.

The posterior of a language is the product of four kinds of evidence:

* the text's likelihood: byte trigrams of the page's visible text under a
  multinomial for each language, trained on at most ``PER_LANGUAGE`` labelled
  documents a language (those with the least hash of their id; a documented
  bound) for the ``LANGUAGES`` most frequent languages, and tempered to
  ``TEMPER`` effective trigrams so that one long text can't drown the rest;
* the declared markup language (``<html lang>``), given the language;
* the address suffix (the host's last label), given the language;
* the host's prior: its pages' counts of languages smoothed towards those of
  its domain (the last two labels), which are smoothed towards all pages'.

The last three come from grouped aggregation over every page, with the most
likely language by text as the label. Models that reach executors by
broadcast have LANGUAGES * BUCKETS numbers at most; host statistics are
joined, and a host with a third of all pages is aggregated in the map tasks
and its pages are dealt over ``SALT`` copies of its row.

Cases: null or empty html, url or markup give no evidence of their kind;
with no labelled documents the language is null; ties go to the language
first in code-point order; repeated rows are judged alike and counted each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html as html_entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.llm.common import drop, scratch

PER_LANGUAGE = 2000
#: Tasks that a language's labelled documents are dealt to before its sample is drawn.
DEAL = 64
BUCKETS = 1 << 13
TEMPER = 40.0
SMOOTH = 5.0
SALT = 32

_HIDDEN = re.compile(r"(?is)<!--.*?-->|<(script|style|nav|head)\b.*?</\1\s*>|<[^>]*>")


def visible_text(page: str | None) -> str:
    return html_entities.unescape(_HIDDEN.sub(" ", page or ""))


def trigrams(text: str) -> np.ndarray:
    b = np.frombuffer(" ".join(text.lower().split()).encode(), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    code = b[:-2] * np.uint32(65599 * 65599 % (1 << 32)) + b[1:-1] * np.uint32(65599) + b[2:]
    code ^= code >> np.uint32(15)
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - 13)).astype(np.int64)


def _gram_pass(batches):
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            counts[lang] += np.bincount(trigrams(text or ""), minlength=BUCKETS)
    for lang, c in counts.items():
        some = np.flatnonzero(c)
        yield pa.record_batch({"lang": pa.array([lang] * len(some), pa.string()), "bucket": pa.array(some, pa.int32()),
                               "n": pa.array(c[some], pa.int64())})


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE):
    """(languages, log probabilities [language, bucket])."""
    from pyspark.sql import Window
    named = labelled.where("lang IS NOT NULL AND doc_id IS NOT NULL")
    names = sorted((r["lang"] for r in named.select("lang").distinct().collect()), key=lambda x: x.encode())
    h = F.xxhash64("doc_id")
    near = Window.partitionBy("lang", F.pmod(h, F.lit(DEAL))).orderBy(h, "doc_id")
    order = Window.partitionBy("lang").orderBy(h, "doc_id")
    picked = (named.select("doc_id", "lang").withColumn("k", F.row_number().over(near)).where(F.col("k") <= per_language)
              .withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language)
              .select("doc_id", "lang").distinct())
    grams = (named.join(F.broadcast(picked), ["doc_id", "lang"]).select("lang", "text")
             .mapInArrow(_gram_pass, "lang string, bucket int, n long"))
    table = np.ones((len(names), BUCKETS))
    for r in grams.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
        table[names.index(r["lang"]), r["bucket"]] += r["n"]
    return names, np.log(table / table.sum(1, keepdims=True))


def _text_pass(model):
    def run(batches):
        names, logs = model.value
        for batch in batches:
            out, best = [], []
            for page in batch.column(1).to_pylist():
                g = trigrams(visible_text(page))
                if not len(g) or not names:
                    out.append([0.0] * len(names))
                    best.append(None)
                    continue
                score = logs[:, g].mean(1) * min(len(g), TEMPER)
                out.append((score - score.max()).tolist())
                best.append(names[int(score.argmax())])
            yield pa.record_batch({
                "page_id": batch.column(0), "url": batch.column(2), "declared": batch.column(3),
                "text_scores": pa.array(out, pa.list_(pa.float64())), "text_lang": pa.array(best, pa.string())})

    return run


def _array(names, of):
    """Array column with one element a language."""
    return F.array(*[of(i, x) for i, x in enumerate(names)])


def identify(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """page_id, host, declared, text_lang, lang, probability."""
    spark = pages.sparkSession
    names, logs = fit(labelled)
    if not names:
        return pages.selectExpr("page_id", "CAST(NULL AS string) AS host", "CAST(NULL AS string) AS declared",
                                "CAST(NULL AS string) AS text_lang", "CAST(NULL AS string) AS lang",
                                "CAST(NULL AS double) AS probability")
    model = spark.sparkContext.broadcast((names, logs))
    declared = F.lower(F.nullif(F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([a-zA-Z]+)", 1), F.lit("")))
    host = F.lower(F.nullif(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))
    seen = scratch(
        pages.select("page_id", "html", "url", declared.alias("declared"))
        .mapInArrow(_text_pass(model), "page_id long, url string, declared string, text_scores array<double>, text_lang string")
        .withColumn("host", host).drop("url")
        .withColumn("suffix", F.substring_index("host", ".", -1))
        .withColumn("domain", F.substring_index("host", ".", -2)), "pages")
    tally = [F.count(F.when(F.col("text_lang") == x, 1)).alias(f"n{i}") for i, x in enumerate(names)]
    by_host = seen.where("host IS NOT NULL").groupBy("host", "domain").agg(*tally)
    total = seen.agg(*tally).first()
    world = np.array([total[i] for i in range(len(names))], float) + 1
    world /= world.sum()
    every = lambda: sum((F.col(f"n{i}") for i in range(len(names))), F.lit(0))
    by_domain = by_host.groupBy("domain").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(names))]).select(
        "domain", _array(names, lambda i, _: (F.col(f"n{i}") + SMOOTH * float(world[i])) / (every() + SMOOTH))
        .alias("domain_prior"))
    prior = by_host.join(by_domain, "domain").select(
        "host", _array(names, lambda i, _: (F.col(f"n{i}") + SMOOTH * F.get("domain_prior", F.lit(i))) / (every() + SMOOTH))
        .alias("prior"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))

    def given(column: str):
        """P(value | language) of each value, for the languages in order."""
        t = seen.where(F.col(column).isNotNull()).groupBy(column).agg(*tally)
        sums = t.agg(F.count(F.lit(1)), *[F.sum(f"n{i}") for i in range(len(names))]).first()
        kinds = sums[0] or 1
        return t.select(column, _array(names, lambda i, _: (F.col(f"n{i}") + 1.0) / float((sums[i + 1] or 0) + kinds))
                        .alias(f"{column}_given"),
                        F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))

    d = seen.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALT)).cast("int"))
    d = d.join(prior, ["host", "salt"], "left").join(given("declared"), ["declared", "salt"], "left") \
        .join(given("suffix"), ["suffix", "salt"], "left")
    log = lambda c, i, other: F.coalesce(F.log(F.get(F.col(c), F.lit(i))), F.lit(other))
    score = _array(names, lambda i, _: F.get("text_scores", F.lit(i)) + log("prior", i, float(np.log(world[i])))
                   + log("declared_given", i, 0.0) + log("suffix_given", i, 0.0))
    d = d.withColumn("score", score).withColumn("top", F.array_max("score"))
    weight = F.aggregate("score", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("top")))
    name = F.get(F.array(*[F.lit(x) for x in names]), F.array_position("score", F.col("top")).cast("int") - 1)
    return d.select("page_id", "host", "declared", "text_lang", name.alias("lang"),
                    F.round(1 / weight, 9).alias("probability"))
