"""Corpus pipeline over ``documents``: quality rules, line dedup, near-copy
removal, mixing to target weights, packing.

Cases: null and empty texts and those without enough words fail the quality
rules and go; ids may be null or repeated and rows may repeat, each is judged
as it stands; an empty table gives no rows; further columns, whatever their
names, are kept by all stages but the last, which returns pieces."""

from __future__ import annotations

from pyspark.sql import functions as F

from meteora.llm import line_dedup, mixing, ngram_join, packing, quality
from meteora.llm.common import drop, scratch, table
from meteora.llm.queries import tokenizer_path


def rules(spark, docs, sf_dir):
    """Documents that fail the quality rules go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark, docs, sf_dir):
    """Repeated chunks of lines go from the texts; a document goes only when
    that took every word it had."""
    return line_dedup.dedup(docs)


def near_copies(spark, docs, sf_dir):
    """One document of each group linked by five-word shingles at a
    similarity of 0.8 stays: the one with the least id. Texts are compared as
    they were read too: what line dedup left of a near copy is no longer like
    its original."""
    return ngram_join.one_of_each(docs, k=5, num=80, den=100, read=table(spark, sf_dir, "documents"))


def mixed(spark, docs, sf_dir):
    """Documents stand as often as the mix takes them."""
    out = mixing.mix(docs, carry=tuple(docs.columns)).where("copies > 0")
    row = F.struct(*[F.col(f"in_{c}").alias(c) for c in docs.columns])
    return out.select(F.explode(F.array_repeat(row, F.col("copies").cast("int"))).alias("row")).select("row.*")


def packed(spark, docs, sf_dir):
    """Token pieces with their place in a sequence."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality rules", rules), ("line dedup", lines), ("n-gram jaccard join", near_copies),
          ("mixing to target weights", mixed), ("best-fit packing", packed)]

#: Tokenization and the packing's search can't be put in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Each stage's result is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), "stage")
        if before is not None:
            drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
