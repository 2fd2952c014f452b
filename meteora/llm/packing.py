"""Best-fit packing of tokenized documents by a grouping genetic algorithm.

Documents are tokenized once, as an untouched tokenizer of the file does it
(the strings of its added tokens are those tokens), cut into pieces of at most ``CAPACITY`` tokens
(the first takes the remainder) and dealt by hash to shards of about
``SHARD`` pieces. Every shard is packed by ``ISLANDS`` populations. A
chromosome is a packing, its genes are whole bins. Crossover injects the
well-filled bins of one parent into the other, drops the bins there that
hold a piece twice, and best-fits the displaced pieces, longest first;
mutation dissolves the emptiest bins. After every round each island sends
its elite to the next one of its shard. The best packing of a shard keeps its
well-filled bins; the pieces of the others are dealt anew and meet in the next
level's fewer shards, until one shard is left. When a level places less than
``LITTLE`` of its pieces (pieces over half a sequence can't share a bin, so
many may fill none well), the next level closes every bin that is half full,
and after that all bins. So no task ever holds more than a shard, and the
count of shards, not their size, grows with the corpus. Pieces with one id,
number and checksum are the exception: they share a shard.

A shard whose best packing reaches a lower bound of its number of bins
(``least_bins``) stops searching: no packing has fewer. Random choices are seeded by (shard, island, round): reruns agree.

Cases: null and empty texts have the closing id 0 alone, length 1; repeated
rows are pieces of their own; equal lengths are ordered by id, piece and
checksum; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.llm import bpe
from meteora.llm.common import drop, scratch

CAPACITY = 2048
SHARD = 2048
ISLANDS = 2
POPULATION = 10
ROUNDS = 2
#: Children of an island in a round, unless it proves a packing the least.
GENERATIONS = 60
#: Bins filled less than this go on to the next level.
GOOD_FILL = 0.985
#: The fills that close a bin: the next one holds after a level that placed
#: less than LITTLE of its pieces.
CLOSES = (GOOD_FILL, 0.5, 0.0)
LITTLE = 0.1
LEVELS = 100

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _tokenize_pass(path: str, capacity: int):
    def run(batches):
        for batch in batches:
            rows = ([], [], [], [], [])
            ids_of = bpe.encode(batch.column(1), path, plain=False)
            for doc, ids in zip(batch.column(0).to_pylist(), ids_of, strict=True):
                ids = np.append(ids, np.uint32(0)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k in range(len(cuts) - 1):
                    for column, v in zip(rows, (doc, k, cuts[k], cuts[k + 1] - cuts[k],
                                                zlib.crc32(ids[cuts[k]:cuts[k + 1]].tobytes())), strict=True):
                        column.append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, types, strict=True)],
                                  ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    return docs.select("doc_id", "text").mapInArrow(_tokenize_pass(path, capacity), PIECES)


class Packing:
    """A packing: the bin of every piece, the fill of every bin, and numbers
    in whose order the pieces of a bin came into it."""

    def __init__(self, at: np.ndarray, fill: np.ndarray, came: np.ndarray, capacity: int):
        self.at, self.fill, self.came = at, fill, came
        #: Fewer bins first, then fuller full ones.
        self.fitness = (-len(fill), sum([(f / capacity) ** 2 for f in fill.tolist()]))


def _best_fit(at: np.ndarray, fill: np.ndarray, came: np.ndarray, items: np.ndarray, lengths, capacity) -> Packing:
    """``items`` put into bins of ``fill`` by best fit, in their order. Bins
    are kept by their open space, and bits mark the spaces that some bin has,
    so the tightest fit is found by one bit scan."""
    space = (capacity - fill).tolist()
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    for b, s in enumerate(space):
        by_space[s].append(b)
    mask = sum(1 << s for s in set(space))
    where = []
    for n in lengths[items].tolist():
        fit = mask >> n
        if fit:
            s = n + (fit & -fit).bit_length() - 1
            same = by_space[s]
            b = same.pop()
            if not same:
                mask ^= 1 << s
            s -= n
            space[b] = s
        else:
            b, s = len(space), capacity - n
            space.append(s)
        by_space[s].append(b)
        mask |= 1 << s
        where.append(b)
    at[items] = where
    came[items] = came.max(initial=0) + 1 + np.arange(len(items))
    return Packing(at, capacity - np.array(space, np.int64), came, capacity)


def _pack(lengths: np.ndarray, order: np.ndarray, capacity: int) -> Packing:
    n = len(lengths)
    return _best_fit(np.empty(n, np.int32), np.zeros(0, np.int64), np.zeros(n, np.int64), order, lengths, capacity)


def _longest_first(items: np.ndarray, turn: np.ndarray, x: Packing, lengths: np.ndarray) -> np.ndarray:
    """Pieces by length, then by their bin's turn, then as they came."""
    return items[np.lexsort((x.came[items], turn[x.at[items]], -lengths[items]))]


def _fill(at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.bincount(at, lengths).astype(np.int64)


def least_bins(lengths, capacity) -> int:
    """A lower bound of the bins: that of all tokens, and for every k that of
    the pieces from k on, where those over half a bin have one each and what
    these leave takes no more than its space (Martello and Toth's L2)."""
    if not len(lengths):
        return 0
    x = np.sort(np.asarray(lengths, np.int64))
    total = np.r_[0, np.cumsum(x)]
    half = int(np.searchsorted(x, capacity // 2, "right"))
    k = np.unique(np.r_[0, x[:half]])
    low = np.searchsorted(x, k)
    high = np.maximum(np.searchsorted(x, capacity - k, "right"), half)
    space = (high - half) * capacity - (total[high] - total[half])
    more = np.maximum(0, -((space - (total[half] - total[low])) // capacity))
    return int(np.max(len(x) - half + more))


def crossover(a: Packing, b: Packing, lengths, capacity, rng) -> Packing:
    """Well-filled bins of ``a`` injected into ``b``."""
    share = int(len(a.fill) * rng.uniform(0.2, 0.7))
    given = np.argsort(-a.fill, kind="stable")[:share]
    place = np.full(len(a.fill), -1, np.int32)
    place[given] = np.arange(share, dtype=np.int32)
    at = place[a.at]
    inside = at >= 0
    whole = np.ones(len(b.fill), bool)
    whole[b.at[inside]] = False
    kept = np.flatnonzero(whole)
    place = np.full(len(b.fill), -1, np.int32)
    place[kept] = np.arange(share, share + len(kept), dtype=np.int32)
    at = np.where(inside, at, place[b.at])
    displaced = _longest_first(np.flatnonzero(at < 0), np.arange(len(b.fill)), b, lengths)
    return _best_fit(at, np.r_[a.fill[given], b.fill[kept]], np.where(inside, a.came, b.came), displaced, lengths, capacity)


def mutate(x: Packing, lengths, capacity, rng) -> Packing:
    n = max(2, len(x.fill) // 20)
    out = list(set(np.argsort(x.fill, kind="stable")[:n].tolist()) | set(rng.integers(0, len(x.fill), n).tolist()))
    stays, turn = np.ones(len(x.fill), bool), np.zeros(len(x.fill), np.int64)
    stays[out] = False
    turn[out] = np.arange(len(out))
    place = np.where(stays, np.cumsum(stays) - 1, -1).astype(np.int32)
    at = place[x.at]
    displaced = _longest_first(np.flatnonzero(at < 0), turn, x, lengths)
    return _best_fit(at, x.fill[stays], x.came.copy(), displaced, lengths, capacity)


def _evolve_pass(step: int, capacity: int, population: int, generations: int):
    def one(shard, island, lengths, packings, guest):
        rng = np.random.default_rng([shard, island, step])
        lengths = np.asarray(lengths, np.int64)
        n = len(lengths)
        least = least_bins(lengths, capacity)
        if packings:
            group = [np.frombuffer(x, np.int32) for x in [*packings, *([] if guest is None else [guest])]]
            group = [Packing(at, _fill(at, lengths), np.arange(n), capacity) for at in group]
        else:
            group = []
            for k in range(population):
                if group and len(group[0].fill) == least:
                    break
                noise = lengths * (1 + (0 if k == 0 and island == 0 else 0.15) * rng.random(n))
                group.append(_pack(lengths, np.argsort(-noise, kind="stable"), capacity))
        ranked = sorted(group, key=lambda x: x.fitness, reverse=True)
        for _ in range(generations):
            if len(ranked[0].fill) == least or len(ranked) < 2:
                break
            a, b = rng.choice(len(ranked), 2, replace=False)
            child = crossover(ranked[min(a, b)], ranked[max(a, b)], lengths, capacity, rng)
            ranked.append(mutate(child, lengths, capacity, rng))
            ranked = sorted(ranked, key=lambda x: x.fitness, reverse=True)[:population]
        ranked = ranked[:population]
        return [x.at.tobytes() for x in ranked], ranked[0].fitness

    def run(batches):
        for batch in batches:
            out = {"shard": [], "island": [], "lengths": [], "packings": [], "elite": [], "bins": [], "quality": []}
            for row in batch.to_pylist():
                packings, (bins, quality) = one(
                    row["shard"], row["island"], row["lengths"], row["packings"], row["guest"])
                for c, v in zip(out, (row["shard"], row["island"], row["lengths"], packings, packings[0], -bins,
                                      quality), strict=True):
                    out[c].append(v)
            yield pa.record_batch({
                "shard": pa.array(out["shard"], pa.int64()), "island": pa.array(out["island"], pa.int32()),
                "lengths": pa.array(out["lengths"], pa.list_(pa.int64())),
                "packings": pa.array(out["packings"], pa.list_(pa.binary())),
                "elite": pa.array(out["elite"], pa.binary()), "bins": pa.array(out["bins"], pa.int64()),
                "quality": pa.array(out["quality"], pa.float64())})

    return run


_STATE = ("shard long, island int, lengths array<long>, packings array<binary>, elite binary, bins long, "
          "quality double")


def _assign(capacity: int, good: float, level: int):
    def run(key, items, best):
        import pandas as pd
        items = items.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True],
                                  kind="stable", na_position="first")
        at = np.frombuffer(best["elite"].iloc[0], np.int32)
        lengths = items["length"].to_numpy()
        fill = np.bincount(at, lengths, minlength=1)
        order = np.argsort(at, kind="stable")
        run_ = np.cumsum(lengths[order])
        firsts = np.r_[True, np.diff(at[order]) != 0]
        base = (run_ - lengths[order])[firsts]
        offset = np.empty(len(at), np.int64)
        offset[order] = run_ - lengths[order] - base[np.cumsum(firsts) - 1]
        out = items[["doc_id", "piece", "start", "length", "ids_crc32"]].copy()
        done = fill[at] >= good * capacity
        out["sequence_id"] = (np.int64(level) << 56) | (np.int64(key[0]) << 20) | at.astype(np.int64)
        out["offset"] = offset
        out["done"] = done
        return pd.DataFrame(out)

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, islands: int = ISLANDS,
         rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    left = scratch(pieces, "pieces")
    n = left.count()
    done = None
    closes = 0
    for level in range(LEVELS):
        shards = max(1, -(-n // shard))
        if shards == 1 or level == LEVELS - 1:
            closes = len(CLOSES) - 1
        # by the level too: what met in one shard is dealt apart
        dealt = left.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(level)), F.lit(shards)))
        state = (dealt.groupBy("shard")
                 .agg(F.sort_array(F.collect_list("length"), asc=False).alias("lengths"))
                 .withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
                 .repartition(max(1, min(shards * islands, 4096)), "shard", "island")
                 .selectExpr("shard", "island", "lengths", "CAST(NULL AS array<binary>) AS packings",
                             "CAST(NULL AS binary) AS guest"))
        for step in range(rounds):
            now = scratch(state.mapInArrow(_evolve_pass(step, capacity, POPULATION, GENERATIONS), _STATE), "islands")
            if step:
                drop(was)  # noqa: F821
            was = now
            guests = now.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.col("elite").alias("guest"))
            state = now.select("shard", "island", "lengths", "packings").join(guests, ["shard", "island"])
        best = now.groupBy("shard").agg(F.max_by("elite", F.struct(-F.col("bins"), "quality", "island")).alias("elite"))
        placed = scratch(dealt.groupBy("shard").cogroup(best.groupBy("shard")).applyInPandas(
            _assign(capacity, CLOSES[closes], level),
            PIECES + ", sequence_id long, offset long, done boolean"), "placed")
        drop(now, left)
        part = placed.where("done").drop("done")
        done = part if done is None else done.union(part)
        if CLOSES[closes] == 0:
            return done
        left = scratch(placed.where("NOT done").select("doc_id", "piece", "start", "length", "ids_crc32"), "left")
        m = left.count()
        if not m:
            drop(left)
            return done
        if n - m < LITTLE * n:
            closes += 1
        n = m
    raise RuntimeError("packing did not end")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(token_pieces(docs, path, capacity), capacity)
