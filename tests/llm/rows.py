"""Small tables with the awkward rows that every operator must bear."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 1
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 50) + ("\n" if i % 9 == 8 else ""))
    return " ".join(out)


def awkward() -> list[tuple]:
    """Nulls in every column, empty, blank, short, very long, tied and
    repeated rows, other scripts."""
    base = prose(1, 120)
    near = base.replace("alpha", "ALPHA").split(" ")
    near[50] = "changed"
    texts = [base, base, " ".join(near), None, "", " \n\t ", "one", "two words", "a b c", prose(2, 3000),
             "日本語 テキスト ñandú " * 20, prose(3, 60) + "\n" + base[:400], base[:400], "x" * 700, "x" * 199, "x" * 200]
    rows = [(i, t, "en", ["a", "b", None][i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    rows.append((None, prose(4, 80), None, None, None))
    return rows


def docs(spark, rows=None, extra=True):
    df = spark.createDataFrame(awkward() if rows is None else rows, DOCS)
    if extra:  # columns whose names clash with inner ones
        for name in ("key", "n", "node", "shard", "size", "_hash", "h", "r", "label"):
            df = df.selectExpr("*", f"1 AS {name}")
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)
