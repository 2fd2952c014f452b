"""Nearest neighbours by inner product with a block matrix join.

Vectors are cut into blocks by a hash of their id. Queries travel in
tiles to every block; a task holds one block at a time and streams the queries past
it. Block and queries are quantised to int8 with a scale per vector, one
matrix product of the int8 values gives approximate scores, and the norms of
the rounding errors bound how far each can be off:

    |x.y - sx sy (qx.qy)| <= |ex| |sy qy| + |sx qx| |ey| + |ex| |ey|

Pairs whose upper bound reaches the k-th best lower bound of their query are
recomputed in double precision on the original components, summed in their
order; a query's best k of each block then meet and are merged by a heap. No
neighbour is lost, so recall is 1.

Cases: where a product or bound is beyond a double, the pair is computed
exactly (an inner product without a value is ranked last); null, empty and
zero vectors and those with a null or non-finite
component take no part; vectors only meet vectors of their own length; a
query doesn't meet rows with its own vec_id; rows with equal vec_id and
vector count once; ties go to the smaller vec_id; with fewer than k
candidates all are returned; null ids take no part; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteora.llm.common import drop, scratch

#: Components of a block, and pairs recomputed at once.
BLOCK = 1 << 18
PAIRS = 1 << 15
TILE = 256


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("v").isNotNull() & (F.size("v") > 0) & finite
                   & F.exists("v", lambda x: x != 0)).distinct())


def quantise(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values (as floats that hold their products exactly), scales,
    norms of the quantised vectors and norms of the errors. Norms are taken
    in units of the scale, so no square leaves the range of a double."""
    scale = np.abs(m).max(1) / 127
    scale[scale < np.finfo(float).tiny] = np.finfo(float).tiny
    parts = m / scale[:, None]
    q = np.rint(parts)
    exact = np.float32 if m.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return q.astype(exact), scale, np.sqrt((q ** 2).sum(1)) * scale, np.sqrt(((parts - q) ** 2).sum(1)) * scale * (1 + 1e-9)


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise inner products, components added in order."""
    total = np.zeros(len(x))
    with np.errstate(over="ignore", invalid="ignore"):
        for d in range(x.shape[1]):
            total += x[:, d] * y[:, d]
    return np.where(np.isnan(total), -np.inf, total)


def block_best(queries, qids, block, ids, quantised, k):
    """(query row, vec_id, score) of the best k of a block for each query."""
    out = []
    cq, cs, cn, ce = quantised
    for lo in range(0, len(qids), TILE):
        x, own = queries[lo:lo + TILE], qids[lo:lo + TILE]
        q, s, n, e = quantise(x)
        with np.errstate(over="ignore", invalid="ignore"):
            near = (q @ cq.T).astype(np.float64) * s[:, None] * cs
            slack = (e[:, None] * cn + n[:, None] * ce + e[:, None] * ce) * (1 + 1e-9) + 1e-12 * np.abs(near)
        slack += 1e-300  # products below the smallest normal number
        wild = ~(np.isfinite(near) & np.isfinite(slack))  # bounds that say nothing: to the exact path
        near[wild], slack[wild] = 0.0, np.inf
        same = own[:, None] == ids
        low = np.where(same, -np.inf, near - slack)
        high = np.where(same, -np.inf, near + slack)
        bar = np.partition(low, -k, 1)[:, -k] if len(ids) > k else np.full(len(x), -np.inf)
        r, c = np.nonzero((high >= bar[:, None]) & ~same)
        score = np.concatenate([dots(x[r[i:i + PAIRS]], block[c[i:i + PAIRS]]) for i in range(0, len(r), PAIRS)]
                               or [np.zeros(0)])
        order = np.lexsort((ids[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        nth = np.arange(len(r)) - np.searchsorted(r, r)
        top = nth < k
        out.append((own[r[top]], ids[c[top]], score[top]))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def _tile_pass(k: int):
    def run(batches):
        at, ids, block, quantised = None, None, None, None
        for batch in batches:
            key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], 1)
            role = batch.column(2).to_numpy()
            i = 0
            while i < len(key):
                if role[i] == 0:
                    at = tuple(key[i])
                    ids = batch.column(3)[i].values.to_numpy()
                    block = batch.column(4)[i].values.to_numpy().reshape(len(ids), at[0])
                    quantised = quantise(block)
                    i += 1
                    continue
                j = i
                while j < len(key) and role[j] == 1 and tuple(key[j]) == tuple(key[i]):
                    j += 1
                if tuple(key[i]) == at:
                    part = batch.slice(i, j - i)
                    qids = part.column(3).flatten().to_numpy()
                    queries = part.column(4).flatten().to_numpy().reshape(len(qids), at[0])
                    q, c, s = block_best(queries, qids, block, ids, quantised, k)
                    yield pa.record_batch({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(c, pa.int64()),
                                           "score": pa.array(s, pa.float64())})
                i = j

    return run


def _merge(k: int):
    def run(pdf):
        import pandas as pd
        best = heapq.nsmallest(k, zip(-pdf["score"], pdf["vec_id"], strict=True))
        return pd.DataFrame({"query_id": pdf["query_id"].iloc[0], "rank": np.arange(1, len(best) + 1, dtype=np.int32),
                             "vec_id": [b[1] for b in best], "score": [-b[0] for b in best]})

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 20, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each row of
    ``vectors`` (vec_id, embedding) for which ``is_query`` holds."""
    good = scratch(usable(vectors).withColumn("dim", F.size("v")), "vectors")
    n, dim = good.agg(F.count(F.lit(1)), F.max("dim")).first()
    if not n:
        drop(good)
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks = -(-n * dim // block)
    dealt = good.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    kept = (dealt.groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
            .select("dim", "block", F.lit(0).alias("role"), F.col("rows.vec_id").alias("ids"),
                    F.flatten("rows.v").alias("vs")))
    tiles = -(-n // TILE)
    tile = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(tiles))
    asked = good.where(is_query).groupBy("dim", tile.alias("tile")).agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
    sent = (asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(int(blocks - 1)))))
            .select("dim", "block", F.lit(1).alias("role"), F.col("rows.vec_id").alias("ids"),
                    F.flatten("rows.v").alias("vs")))
    best = scratch(kept.union(sent).repartition("dim", "block").sortWithinPartitions("dim", "block", "role")
                   .mapInArrow(_tile_pass(k), "query_id long, vec_id long, score double"), "best")
    drop(good)
    return best.groupBy("query_id").applyInPandas(_merge(k), "query_id long, rank int, vec_id long, score double")


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
