"""Vector code compression: eight-part product codes over integers, with
value dictionaries per dimension.

Components become integers floor(4096 x). Rows are laid down once in blocks
of at most ``BLOCK`` vectors; a block keeps, for each dimension, the distinct
integers (its dictionary) and a two-byte code per vector. A pass tabulates
the squared differences of every dictionary value to all codebook entries
and gets part distances by gathering the tables' rows by code and adding
them; the sums of an entry's vectors are a histogram over (entry, code)
times the dictionary. Only codebooks and their sums, whose size is that of
16 vectors, go through the driver.

All arithmetic is exact: values, distances and sums that don't fit 64 bits
are computed with Python's integers and added up in 30-bit limbs.

Cases: null vectors and those with a null or non-finite component are
dropped; vectors of different lengths are coded apart, each length with its
own codebooks; a length that 8 doesn't divide is cut at i * length / 8,
rounded down; empty vectors have parts of no components and error 0; with
fewer than 16 vectors there are fewer entries; first entries go by vec_id
(nulls last, repeated ids by their vectors), repeated rows count each; a
null vec_id is kept; an error above the range of a long is given as the
largest long; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteora.llm.common import drop, join_spread, scratch

#: Fixed by contract.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors of a block; codes have two bytes.
BLOCK = 1 << 13
LIMB = 30
LONG = (1 << 63) - 1


def bounds(dim: int) -> list[int]:
    return [p * dim // PARTS for p in range(PARTS + 1)]


def as_integers(x: np.ndarray) -> np.ndarray:
    """floor(4096 x), as int64 where all squares surely fit."""
    small = not x.size or float(np.abs(x).max()) < 2 ** 13
    if small:
        return np.floor(x * SCALE).astype(np.int64)
    whole = np.where(np.abs(x) < 2.0 ** 40, np.floor(np.where(np.abs(x) < 2.0 ** 40, x, 0) * SCALE), 0)
    return np.array([int(w) if abs(v) < 2.0 ** 40 else int(v) * SCALE
                     for v, w in zip(x.ravel().tolist(), whole.ravel().tolist(), strict=True)], object).reshape(x.shape)


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(vector).isNotNull()).select("vec_id", "label", v.alias("v")).where(
        F.coalesce(finite, F.lit(False))).withColumn("dim", F.size("v"))


def _block_pass(label_type):
    """Blocks of vectors of one length with dictionaries and codes."""
    def block(dim, ids, labels, rows):
        m = np.concatenate(rows).reshape(-1, dim) if dim else np.zeros((sum(map(len, labels)), 0))
        values, codes, sizes = [], [], []
        for d in range(dim):
            v, c = np.unique(np.where(np.abs(m[:, d]) < 2.0 ** 40, np.floor(m[:, d] * SCALE) / SCALE, m[:, d]),
                             return_inverse=True)
            values.append(v)
            sizes.append(len(v))
            codes.append(c.astype(np.uint16))
        flat = lambda x, t: np.concatenate([np.zeros(0, t), *x]).astype(t).tobytes()
        lists = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.record_batch({
            "dim": pa.array([dim], pa.int32()), "ids": lists(pa.concat_arrays(ids)),
            "labels": lists(pa.concat_arrays(labels).cast(label_type)), "sizes": pa.array([sizes], pa.list_(pa.int32())),
            "dictionary": pa.array([flat(values, np.float64)], pa.binary()),
            "codes": pa.array([flat(codes, np.uint16)], pa.binary())})

    def run(batches):
        held = {}  # length -> ids, labels, components
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                for lo in range(0, len(at), BLOCK):
                    part = batch.take(pa.array(at[lo:lo + BLOCK]))
                    have = held.setdefault(dim, ([], [], []))
                    if sum(map(len, have[0])) + part.num_rows > BLOCK:
                        yield block(dim, *have)
                        have = held[dim] = ([], [], [])
                    for column, x in zip(have, (part.column(0), part.column(1), part.column(2).flatten().to_numpy()),
                                         strict=True):
                        column.append(x)
        for dim, have in held.items():
            yield block(dim, *have)

    return run


def assign(values: list[np.ndarray], codes: np.ndarray, book: np.ndarray, n: int):
    """Nearest entry of every part and the squared distances to them."""
    dim = len(values)
    cuts = bounds(dim)
    nearest, error = np.zeros((PARTS, n), np.int64), 0
    for p in range(PARTS):
        lo, hi = cuts[p:p + 2]
        far = np.zeros((n, book.shape[0]), np.int64)
        for d in range(lo, hi):
            v, b = values[d], book[:, d]
            if v.dtype != b.dtype:
                v, b = v.astype(object), b.astype(object)
            table = (v[:, None] - b) ** 2
            far = far + table[codes[d]]
        nearest[p] = far.argmin(1)
        error = error + np.take_along_axis(far, nearest[p][:, None], 1)[:, 0]
    return nearest, error


def _open(batch, i):
    dim = batch.column(0)[i].as_py()
    sizes = batch.column(3)[i].as_py()
    cuts = np.cumsum([0, *sizes])
    values = as_integers(np.frombuffer(batch.column(4)[i].as_py(), np.float64))
    ids = batch.column(1)[i].values
    codes = np.frombuffer(batch.column(5)[i].as_py(), np.uint16).reshape(dim, len(ids))
    return dim, ids, batch.column(2)[i].values, [values[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], codes


def _limbs(x: int):
    at, sign, x = 0, (1 if x >= 0 else -1), abs(x)
    while x:
        yield at, sign * (x & ((1 << LIMB) - 1))
        x >>= LIMB
        at += 1


def _sum_pass(books):
    """Counts and component sums of the vectors nearest to each entry."""
    def run(batches):
        total = {}
        for batch in batches:
            for i in range(batch.num_rows):
                dim, ids, _, values, codes = _open(batch, i)
                book = books.value[dim]
                k = len(book)
                nearest, _ = assign(values, codes, book, len(ids))
                counts, sums = total.setdefault(dim, (np.zeros((PARTS, k), np.int64), np.zeros((k, dim), object)))
                cuts = bounds(dim)
                for p in range(PARTS):
                    counts[p] += np.bincount(nearest[p], minlength=k)
                    for d in range(cuts[p], cuts[p + 1]):
                        size = len(values[d])
                        seen = np.bincount(nearest[p] * size + codes[d], minlength=k * size).reshape(k, size)
                        sums[:, d] += (seen.astype(values[d].dtype) @ values[d]).astype(object)
        rows = []
        for dim, (counts, sums) in total.items():
            cuts = bounds(dim)
            rows += [(dim, p, e, -1, 0, int(counts[p, e])) for p in range(PARTS) for e in range(counts.shape[1])
                     if counts[p, e]]
            rows += [(dim, p, e, d, at, x) for p in range(PARTS) for d in range(cuts[p], cuts[p + 1])
                     for e in range(counts.shape[1]) for at, x in _limbs(int(sums[e, d]))]
        names = "dim", "part", "entry", "d", "limb", "x"
        cols = list(zip(*rows, strict=True)) or [[]] * 6
        yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=list(names))

    return run


def _code_pass(books, label_type):
    hexes = np.array([f"{i:02x}" for i in range(256)], object)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                dim, ids, labels, values, codes = _open(batch, i)
                nearest, error = assign(values, codes, books.value[dim], len(ids))
                code = hexes[nearest].sum(0)
                error = [min(int(x), LONG) for x in np.broadcast_to(error, len(ids))]
                yield pa.record_batch({
                    "vec_id": ids, "label": labels.cast(label_type), "dim": pa.array([dim] * len(ids), pa.int32()),
                    "code": pa.array(code.tolist(), pa.string()), "error": pa.array(error, pa.int64())})

    return run


def _updated(books: dict, rows: list) -> dict:
    """Codebooks with every used entry replaced by its floored mean."""
    counts, sums = {}, {}
    for r in rows:
        if r["d"] < 0:
            counts[r["dim"], r["part"], r["entry"]] = r["x"]
        else:
            at = r["dim"], r["entry"], r["d"]
            sums[at] = sums.get(at, 0) + (r["x"] << (LIMB * r["limb"]))
    out = {}
    for dim, book in books.items():
        cuts, new = bounds(dim), book.astype(object)
        for p in range(PARTS):
            for e in range(len(book)):
                if n := counts.get((dim, p, e)):
                    for d in range(cuts[p], cuts[p + 1]):
                        new[e, d] = sums.get((dim, e, d), 0) // n
        out[dim] = _narrow(new)
    return out


def _narrow(book: np.ndarray) -> np.ndarray:
    small = all(abs(int(x)) < 1 << 25 for x in book.ravel())
    return book.astype(np.int64) if small else book.astype(object)


def digest(book: np.ndarray) -> str:
    """SHA-256 of a codebook's integers by part, entry, position."""
    cuts = bounds(book.shape[1])
    flat = [str(int(x)) for p in range(PARTS) for e in book for x in e[cuts[p]:cuts[p + 1]]]
    return hashlib.sha256(",".join(flat).encode()).hexdigest()


def train(blocks: DataFrame, first: dict, rounds: int = ROUNDS) -> dict:
    """Codebooks by length after ``rounds`` rounds."""
    books = {dim: _narrow(as_integers(b)) for dim, b in first.items()}
    sc = blocks.sparkSession.sparkContext
    for _ in range(rounds):
        sent = sc.broadcast(books)
        sums = blocks.mapInArrow(_sum_pass(sent), "dim long, part long, entry long, d long, limb long, x long")
        rows = sums.groupBy("dim", "part", "entry", "d", "limb").agg(F.sum("x").alias("x")).collect()
        books = _updated(books, rows)
        sent.destroy()
    return books


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256, label of every
    kept row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    good = usable(vectors)
    ids, label = good.schema["vec_id"].dataType.simpleString(), good.schema["label"].dataType.simpleString()
    import pyspark.sql.pandas.types as arrow
    label_type = arrow.to_arrow_type(good.schema["label"].dataType)
    order = Window.partitionBy("dim").orderBy(F.col("vec_id").asc_nulls_last(), "v")
    lead = (good.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= ENTRIES)
            .orderBy("dim", "_nth").select("dim", "v").collect())
    first = {}
    for r in lead:
        first.setdefault(r["dim"], []).append(r["v"])
    first = {dim: np.array(v, float).reshape(len(v), dim) for dim, v in first.items()}
    blocks = scratch(good.select("vec_id", "label", "v", "dim").mapInArrow(
        _block_pass(label_type), f"dim int, ids array<{ids}>, labels array<{label}>, sizes array<int>, "
        "dictionary binary, codes binary"), "blocks")
    books = train(blocks, first, rounds)
    coded = scratch(blocks.mapInArrow(_code_pass(spark.sparkContext.broadcast(books), label_type),
                                      f"vec_id {ids}, label {label}, dim int, code string, error long"), "codes")
    drop(blocks)
    totals = scratch(coded.groupBy("label").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG)).cast("long").alias("label_error"),
        F.count(F.lit(1)).alias("_rows")), "totals")
    names = F.create_map(*[F.lit(x) for dim, b in books.items() for x in (dim, digest(b))]) if books else F.lit(None)
    sha = F.get(F.map_values(names), F.lit(0)) if len(books) == 1 else \
        F.element_at(names, F.col("dim")) if books else F.lit(None).cast("string")
    return join_spread(coded, totals, "label", "_rows").select(
        "vec_id", "code", "error", "label_error", sha.alias("codebooks_sha256"), "label")


def _oracle() -> str:
    def nearest(n):
        return f"""
d{n} AS (SELECT x.rid, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v)) AS far
  FROM x JOIN b{n} b USING (part, pos) GROUP BY ALL),
a{n} AS (SELECT rid, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM d{n} GROUP BY ALL),"""

    def update(n):
        return f"""
s{n} AS (SELECT a.part, a.entry, x.pos, sum(x.v) AS s, count(*) AS c
  FROM a{n} a JOIN x USING (rid, part) GROUP BY ALL),
b{n + 1} AS (SELECT part, entry, pos, coalesce((s - ((s % c) + c) % c) // c, b.v)::HUGEINT AS v
  FROM b{n} b LEFT JOIN s{n} USING (part, entry, pos)),"""
    rounds = "".join(nearest(n) + update(n) for n in range(ROUNDS))
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, embedding::DOUBLE[] AS e
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c AS (SELECT rid, len(e) // {PARTS} AS w, unnest(range(len(e))) AS i, unnest(e) AS v FROM kept),
x AS (SELECT rid, i // w AS part, i % w AS pos, floor({SCALE} * v)::HUGEINT AS v FROM c),
b0 AS (SELECT part, rid - 1 AS entry, pos, v FROM x WHERE rid <= {ENTRIES}),{rounds}{nearest(ROUNDS)}
codes AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error
  FROM a{ROUNDS} GROUP BY rid),
book AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256, label
FROM kept JOIN codes USING (rid), book
"""


ORACLE = _oracle()
