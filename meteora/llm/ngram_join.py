"""N-gram Jaccard join with token-combination prefixes.

A document is its set of distinct k-word shingles (lower-cased A-Z, words
parted by the six ASCII white-space characters). Documents link when
``den * |x & y| >= num * |x | y|``; the result is each document's component
under those links.

1. Documents with one set are one class, known by a key of the set.
2. Tokens (shingles) are counted over all documents. Tokens in more than
   ``RARE`` documents are frequent; their list is broadcast, at most
   ``FREQUENT`` of them (8 MB), the most frequent ones. The others count as
   rare: any division into classes gives the same result.
3. Signatures. x can miss at most t = floor(|x| (den - num) / den) of its
   tokens in a partner. A document with more than t rare tokens indexes its
   first t + 1 rare tokens in hash order: a partner has one of them among its
   own. A document with r <= t rare tokens indexes them all and extends its
   prefix into the frequent class, where it indexes combinations of k tokens
   that follow each other in hash order. With u tokens of x missing in y and
   v of y missing in x, at most b = (u - r) + v tokens break the sequence, so
   the first (u - r) + (k - 1)(b + 1) + 1 frequent tokens hold a common run
   of k, for the largest that the threshold allows. k is 2 for sets of under
   ``LARGE`` tokens and 3 or 4 for larger ones, which would share many pairs
   by chance; sets that may have partners on the other side index both.
4. Classes that share a rare token are candidates when their sizes allow a
   link. Where more than ``RARE`` classes share one signature, be it a
   combination or a token that the list had no room for, every member is
   paired with one lead first, and after the links of that round only members
   of different components are paired, so a group of many near copies isn't
   expanded into all of its pairs. Pairs in common combinations need their
   rare tokens to be missing on the other side, which rules out most of them.
   Such pairs share hundreds of signatures and are made in the first of them,
   not in each.
5. Candidates whose parity sketches (a bit for each token, about) differ in
   more bits than a link allows are dropped; the others are verified on
   their whole sets.

Cases: null, empty and wordless texts have the empty set and link with
nothing, not with each other either; fewer than k words make one shingle;
repeated rows are one class; a null doc_id is a document like others and
never names a component that has another id; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meteora.llm.common import components, drop, scratch
from meteora.llm.shingles import pair_hash, set_key, shingle_sets

RARE = 20
FREQUENT = 1 << 20
#: Tokens for one range of their hashes, and those held by a task.
RANGE_TOKENS = 1 << 20
HELD = 4_000_000
#: Longs of the sketch that combinations carry.
SKETCH = 8
#: Signatures of a class that are looked back on for one its partner shares.
BEFORE = 16
#: Sets from this size on index longer combinations.
LARGE = 64


def range_bits(total: int, each: int) -> int:
    """Leading bits of a hash that make ranges of about ``each`` of ``total``,
    64 ranges at least."""
    return max(6, (-(-total // each) - 1).bit_length())


def misses(n: int, num: int, den: int) -> int:
    """Most tokens of a set of n that a partner can lack."""
    return n * (den - num) // den


def prefix_length(n: int, r: int, num: int, den: int, k: int) -> int:
    """Frequent tokens needed when all r rare ones are missing; 0 if only
    an equal set can be a partner."""
    t = misses(n, num, den)
    if t == 0 and den * n // num == n:
        return 0
    return 1 + max(u - r + (k - 1) * (u - r + den * (n - u) // num - n + 1) for u in range(max(r, t - den // num - 2), t + 1))


def combination_lengths(n: int, num: int, den: int) -> list[int]:
    """The k of a set of n tokens: that of its partners' sizes as well."""
    long = 3 if 100 * num < 85 * den else 4
    sizes = n * num // den, -(-n * den // num)
    return [k for k, fits in ((2, sizes[0] < LARGE), (long, sizes[1] >= LARGE)) if fits]


def runs(tokens: np.ndarray, k: int) -> np.ndarray:
    """A hash for every k neighbouring tokens."""
    if len(tokens) < k:
        return tokens[:0]
    h = tokens[: len(tokens) - k + 1]
    for i in range(1, k):
        h = pair_hash(h, tokens[i: len(tokens) - k + 1 + i])
    return h


def parity(s: np.ndarray) -> bytes:
    """Parities of the counts of a set's tokens in buckets, one bit each, as
    many as the next power of two from its size on. The bits in which two
    such sketches differ are at most the tokens that only one set has."""
    bits = max(64, 1 << (len(s) - 1).bit_length())
    counts = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def parity_words(s: np.ndarray) -> list[int]:
    """The same with 64 * SKETCH bits for every set, as longs."""
    counts = np.bincount((s & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64).tolist()


def _fold(sketch: np.ndarray, size: int) -> np.ndarray:
    while len(sketch) > size:
        sketch = sketch[:len(sketch) // 2] ^ sketch[len(sketch) // 2:]
    return sketch


def _docs_pass(k: int):
    def run(batches):
        for batch in batches:
            keys, ns, sketches, words = [], [], [], []
            for s in shingle_sets(batch.column(1), k):
                keys.append(set_key(s) if len(s) else None)
                ns.append(len(s))
                sketches.append(parity(s) if len(s) else None)
                words.append(parity_words(s) if len(s) else None)
            yield pa.record_batch({
                "doc_id": batch.column(0), "text_hash": batch.column(2), "n": pa.array(ns, pa.int64()),
                "key": pa.array(keys, pa.int64()), "sketch": pa.array(sketches, pa.binary()),
                "bits": pa.array(words, pa.list_(pa.int64()))})

    return run


def _tokens_pass(k: int, bits: int):
    """Tokens of a task by range of hashes: 24 bits behind the range's own,
    as 256 counts and two bytes each, and how often each occurs."""
    def run(batches):
        held, size = [], 0

        def blobs():
            tokens, counts = np.unique(np.concatenate(held) >> np.uint64(40 - bits), return_counts=True)
            cuts = np.searchsorted(tokens >> np.uint64(24), np.arange((1 << bits) + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(cuts))
            counts = np.minimum(counts, 255).astype(np.uint8)
            high = ((tokens >> np.uint64(16)) & np.uint64(255)).astype(np.int64)
            low = tokens.astype(np.uint16)
            part = lambda x: pa.array([x[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary())
            return pa.record_batch({
                "r": pa.array(some, pa.int32()),
                "high": pa.array([np.bincount(high[cuts[i]:cuts[i + 1]], minlength=256).astype(np.uint32).tobytes()
                                  for i in some], pa.binary()),
                "low": part(low), "counts": part(counts)})

        for batch in batches:
            for s in shingle_sets(batch.column(0), k):
                held.append(s)
                size += len(s)
            if size > HELD:
                yield blobs()
                held, size = [], 0
        if size:
            yield blobs()

    return run


def _count_range(least: int):
    def run(pdf):
        import pandas as pd
        tokens = np.concatenate([
            (np.repeat(np.arange(256, dtype=np.uint32), np.frombuffer(h, np.uint32)) << np.uint32(16))
            | np.frombuffer(x, np.uint16) for h, x in zip(pdf["high"], pdf["low"], strict=True)])
        counts = np.concatenate([np.frombuffer(x, np.uint8) for x in pdf["counts"]]).astype(np.int64)
        order = np.argsort(tokens, kind="stable")
        tokens, counts = tokens[order], counts[order]
        first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        total = np.add.reduceat(counts, first)
        often = total > least
        token = (np.int64(pdf["r"].iloc[0]) << 24) | tokens[first[often]].astype(np.int64)
        return pd.DataFrame({"token": token, "df": total[often]})

    return run


def frequent_tokens(counted: DataFrame, least: int = RARE, most: int = FREQUENT) -> np.ndarray:
    """Sorted ids (leading bits of the hash) of the frequent tokens, at most
    ``most``; the driver gets these and a 64-row histogram."""
    often = scratch(counted.groupBy("r").applyInPandas(_count_range(least), "token long, df long"), "often")
    power = F.floor(F.log2("df")).cast("int")
    sizes = {r["p"]: r["n"] for r in often.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    floor_power, total = 64, 0
    for p in sorted(sizes, reverse=True):
        if total + sizes[p] > most:
            break
        total, floor_power = total + sizes[p], p
    rows = often.where(power >= floor_power).select("token").toPandas()
    drop(often)
    return np.sort(rows["token"].to_numpy(np.int64))


def _signed(batches, k, bits, num, den, often):
    """(key, size, its rare tokens, its combinations or None) of each class
    of a task that can have another one as a partner."""
    seen: set[int] = set()
    for batch in batches:
        for s in shingle_sets(batch.column(0), k):
            if not len(s) or (key := set_key(s)) in seen:
                continue
            seen.add(key)
            token = (s >> np.uint64(40 - bits)).view(np.int64)
            at = np.searchsorted(often, token)
            common = often[np.minimum(at, len(often) - 1)] == token if len(often) else np.zeros(len(s), bool)
            rare, t = s[~common], misses(len(s), num, den)
            if t == 0 and den * len(s) // num == len(s):
                continue
            found = None
            if len(rare) <= t:
                found = [runs(s[common][:prefix_length(len(s), len(rare), num, den, c)], c)
                         for c in combination_lengths(len(s), num, den)]
            yield key, len(s), rare, found


def _rare_pass(k: int, bits: int, num: int, den: int, frequent):
    def run(batches):
        sigs, keys, ns, size = [], [], [], 0

        def blobs():
            lens = [len(s) for s in sigs]
            sig = np.concatenate(sigs)
            key = np.repeat(np.array(keys, np.int64), lens)
            n = np.repeat(np.array(ns, np.int32), lens)
            order = np.argsort(sig)
            sig, key, n = sig[order], key[order], n[order]
            cuts = np.searchsorted(sig >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(cuts))
            part = lambda x: pa.array([x[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary())
            return pa.record_batch({"r": pa.array(some, pa.int32()), "sig": part(sig), "key": part(key), "n": part(n)})

        for key, n, rare, _ in _signed(batches, k, bits, num, den, frequent.value):
            if len(rare):
                sigs.append(rare[:misses(n, num, den) + 1])
                keys.append(key)
                ns.append(n)
                size += len(sigs[-1])
            if size > HELD:
                yield blobs()
                sigs, keys, ns, size = [], [], [], 0
        if size:
            yield blobs()

    return run


def _combination_pass(k: int, bits: int, num: int, den: int, frequent):
    def run(batches):
        rows = [], [], [], []

        def out():
            types = pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())
            return pa.record_batch([pa.array(c, t) for c, t in zip(rows, types, strict=True)],
                                   ["key", "size", "rare", "sigs"])

        for key, n, rare, found in _signed(batches, k, bits, num, den, frequent.value):
            if found is None:
                continue
            for column, v in zip(rows, (key, n, len(rare), np.concatenate(found).view(np.int64)), strict=True):
                column.append(v)
            if len(rows[0]) == 1000:
                yield out()
                rows = [], [], [], []
        if rows[0]:
            yield out()

    return run


def _rare_pairs(num: int, den: int, most: int):
    """Pairs (a, b) of classes that share a token; a token that more than
    ``most`` share gives a row (a, null, token) for each of them instead."""
    def run(pdf):
        import pandas as pd
        col = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in pdf[c]])
        sig, key, n = col("sig", np.uint64), col("key", np.int64), col("n", np.int32).astype(np.int64)
        order = np.argsort(sig, kind="stable")
        sig = sig[order]
        same = sig[1:] == sig[:-1]
        shared = order[np.r_[False, same] | np.r_[same, False]]
        sig, key, n = col("sig", np.uint64)[shared], key[shared], n[shared]
        order = np.lexsort((key, n, sig))
        sig, key, n = sig[order], key[order], n[order]
        first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, int)
        many = np.repeat(np.diff(np.r_[first, len(sig)]) > most, np.diff(np.r_[first, len(sig)])) if len(sig) else \
            np.zeros(0, bool)
        open_ = pd.DataFrame({"a": key[many], "b": pd.NA, "sig": sig[many].view(np.int64)})
        sig, key, n = sig[~many], key[~many], n[~many]
        found = []
        live = np.arange(len(sig))
        step = 1
        while len(live):
            live = live[live + step < len(sig)]
            live = live[(sig[live] == sig[live + step]) & (den * n[live] >= num * n[live + step])]
            if len(live):
                a, b = key[live], key[live + step]
                ok = a != b
                found.append(np.unique(np.stack([np.minimum(a, b)[ok], np.maximum(a, b)[ok]], 1), axis=0))
            step += 1
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        out = pd.concat([pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "sig": 0}), open_])
        return out.astype({"a": "Int64", "b": "Int64", "sig": "Int64"})

    return run


def _may_link(x: str, y: str, num: int, den: int) -> str:
    """Pairs that can link though no rare token of x is in y, nor the other
    way round, and whose sketches are near enough."""
    both = f"({num} * ({x}.size + {y}.size) + {num + den - 1}) div {num + den}"
    apart = " + ".join(f"bit_count({x}.s{i} ^ {y}.s{i})" for i in range(SKETCH))
    return (f"{den} * ({x}.size - {x}.rare) >= {num} * ({x}.size + {y}.rare) AND "
            f"{den} * ({y}.size - {y}.rare) >= {num} * ({y}.size + {x}.rare) AND "
            f"{den} * {x}.size >= {num} * {y}.size AND {den} * {y}.size >= {num} * {x}.size AND "
            f"{apart} <= {x}.size + {y}.size - 2 * ({both})")


def _near_pass(num: int, den: int):
    """Keeps pairs whose sketches differ in no more bits than a link allows."""
    def run(batches):
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                size = min(len(p), len(q))
                apart = int(np.bitwise_count(_fold(p, size) ^ _fold(q, size)).sum())
                both = -(-num * (n + m) // (num + den))
                keep.append(apart <= n + m - 2 * both)
            rows = batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            if rows.num_rows:
                yield rows

    return run


def near(classes: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """The rows (a, b) of ``pairs`` that their sketches don't rule out."""
    side = lambda name, n, sketch: classes.select(
        F.col("key").alias(name), F.col("n").alias(n), F.col("sketch").alias(sketch))
    both = pairs.join(side("a", "n", "x"), "a").join(side("b", "m", "y"), "b")
    return both.select("a", "b", "n", "m", "x", "y").mapInArrow(_near_pass(num, den), "a long, b long")


def _sets_pass(k: int):
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            keys, sets = [], []
            for s in shingle_sets(batch.column(0), k):
                if (key := set_key(s)) not in seen:
                    seen.add(key)
                    keys.append(key)
                    sets.append(s.tobytes())
            yield pa.record_batch({"key": pa.array(keys, pa.int64()), "tokens": pa.array(sets, pa.binary())})

    return run


def token_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(key, tokens) of the classes ``wanted``, from one document of each.
    Repeated rows of a document are in one partition and read once."""
    ids = wanted.join(classes, "key").select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"))
    rows = docs.withColumn("text_hash", F.xxhash64("text"))
    texts = rows.join(ids.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(ids["_doc"])
                      & (rows["text_hash"] == ids["_hash"])).select("text")
    return scratch(texts.mapInArrow(_sets_pass(k), "key long, tokens binary"), "sets")


def _verify_pass(num: int, den: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                z = np.sort(np.concatenate([p, q]), kind="stable")
                both = int(np.count_nonzero(z[1:] == z[:-1]))
                keep.append(den * both >= num * (len(p) + len(q) - both))
            rows = batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            if rows.num_rows:
                yield rows

    return run


def verify(sets: DataFrame, pairs: DataFrame, num: int, den: int) -> DataFrame:
    """The rows (a, b) of ``pairs`` that link, checked on whole sets."""
    one = pairs.join(sets.select(F.col("key").alias("a"), F.col("tokens").alias("x")), "a")
    two = one.join(sets.select(F.col("key").alias("b"), F.col("tokens").alias("y")), "b")
    return scratch(two.select("a", "b", "x", "y").mapInArrow(_verify_pass(num, den), "a long, b long"), "links")


def _cross(placed: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of classes with different labels that share a signature
    and may link. The members of a signature's largest label aren't paired
    with each other. A pair is left out where the BEFORE signatures before
    this one, by value, have one that both bear: it is made there or before,
    at the latest in the first that both bear."""
    about = ["rare", "key", "size", *[f"s{i}" for i in range(SKETCH)], "label", "before"]
    largest = (placed.groupBy("sig", "label").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("sig").agg(F.max(F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("parts"))
               .where("parts > 1").select("sig", F.col("top.label").alias("top")))
    back = Window.partitionBy("key").orderBy("sig").rowsBetween(-BEFORE, -1)
    open_ = placed.join(largest, "sig").withColumn("before", F.collect_list("sig").over(back))
    few = open_.where("label <> top").select("sig", F.struct(*about).alias("x"))
    all_ = open_.select("sig", F.struct(*about, "top").alias("y"))
    return (few.join(all_, "sig")
            .where("x.label <> y.label AND (y.label = y.top OR x.key < y.key) AND " + _may_link("x", "y", num, den)
                   + " AND NOT arrays_overlap(x.before, y.before)")
            .select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")))


def ngram_join(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, rare: int = RARE,
               most: int = FREQUENT) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash (xxhash64 of the text)."""
    if 4 * num < 3 * den or num > den:
        raise ValueError("the threshold must lie between 0.75 and 1")
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    rows = scratch(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _docs_pass(k), "doc_id long, text_hash long, n long, key long, sketch binary, bits array<long>"), "docs")
    sets = rows.select("doc_id", "text_hash", "n", "key")
    bits = range_bits(sets.agg(F.sum("n")).first()[0] or 0, RANGE_TOKENS)
    first = F.struct(F.col("doc_id").alias("doc"), "text_hash", "n")
    classes = scratch(rows.where("key IS NOT NULL").groupBy("key").agg(
        F.min(first).alias("first"), F.any_value("sketch").alias("sketch"),
        F.any_value("bits").alias("bits")).select("key", "first.*", "sketch", "bits"), "classes")
    texts = docs.select("text")
    counted = texts.mapInArrow(_tokens_pass(k, bits), "r int, high binary, low binary, counts binary")
    frequent = spark.sparkContext.broadcast(frequent_tokens(counted, rare, most))
    how = k, bits, num, den, frequent

    single = scratch(texts.mapInArrow(_rare_pass(*how), "r int, sig binary, key binary, n binary").groupBy("r")
                     .applyInPandas(_rare_pairs(num, den, rare), "a long, b long, sig long"), "single")
    by_rare = single.where("b IS NOT NULL").select("a", "b")
    combined = (texts.mapInArrow(_combination_pass(*how), "key long, size long, rare long, sigs array<long>")
                .select("key", "size", "rare", F.explode_outer("sigs").alias("sig")).where("sig IS NOT NULL").distinct())
    words = [F.get("bits", F.lit(i)).alias(f"s{i}") for i in range(SKETCH)]
    # of a token that many share, rare tokens may be common: they rule out nothing
    crowded = (single.where("b IS NULL").select(F.col("a").alias("key"), "sig").distinct()
               .join(classes.select("key", F.col("n").alias("size")), "key")
               .select("key", "size", F.lit(0).cast("long").alias("rare"), "sig"))
    often = combined.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("sig")
    heavy = (combined.join(often, "sig", "left_semi").select("key", "size", "rare", "sig").unionByName(crowded)
             .join(classes.select("key", *words), "key"))
    about = ["rare", "key", "size", *[f"s{i}" for i in range(SKETCH)]]
    least = F.min(F.struct(*about))
    leads = heavy.groupBy("sig").agg(least.alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    heavy = scratch(heavy.join(leads.select("sig", "lead"), "sig"), "heavy")
    star = (heavy.select(F.struct(*about).alias("x"), F.col("lead").alias("y"))
            .where("x.key <> y.key AND " + _may_link("x", "y", num, den))
            .select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")))
    pairs = scratch(near(classes, by_rare.union(star).distinct(), num, den), "pairs")
    wanted = (pairs.select(F.col("a").alias("key")).union(pairs.select("b")).union(heavy.select("key")).distinct())
    tokens = token_sets(docs, classes, wanted, k)
    links = verify(tokens, pairs, num, den)

    labels = components(links)
    placed = scratch(heavy.select("sig", *about)
                     .join(labels.withColumnRenamed("node", "key"), "key", "left")
                     .withColumn("label", F.coalesce("label", "key")), "placed")
    drop(heavy)
    cross = _cross(placed, num, den).distinct()
    more = scratch(near(classes, cross.join(pairs, ["a", "b"], "left_anti"), num, den), "cross")
    drop(pairs, placed, single)
    links2 = verify(tokens, more, num, den)
    drop(more, tokens)
    linked = components(links.union(links2))
    drop(links, links2)

    ids = classes.join(linked.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "doc", F.coalesce("label", "key").alias("label"))
    named = ids.groupBy("label").agg(F.min("doc").alias("component_id"))
    ids = scratch(ids.join(named, "label").select("key", "component_id"), "named")
    out = sets.join(ids, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "text_hash")
    drop(labels, linked)
    return out


def _as_read(docs: DataFrame, read: DataFrame) -> DataFrame:
    """(doc_id, text) of ``read`` for the ids in ``docs`` whose text differs
    there. An id with several texts has no row: which was whose is not known."""
    one = (read.where("doc_id IS NOT NULL").groupBy("doc_id")
           .agg(F.min(F.xxhash64("text")).alias("h"), F.max(F.xxhash64("text")).alias("h2")).where("h = h2"))
    # shuffled joins at every size: the plan must not change with the input
    changed = (docs.select("doc_id", F.xxhash64("text").alias("now")).join(one.hint("shuffle_hash"), "doc_id")
               .where("now <> h").select("doc_id").distinct())
    return (read.select("doc_id", "text").join(changed.hint("shuffle_hash"), "doc_id", "left_semi")
            .dropDuplicates(["doc_id"]))


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, read: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component; documents
    without words all stay. Rows with the same id and text become one. With
    ``read``, the texts before they were cut, a document goes also when its
    text there is in the component of a lower id."""
    judged = docs.select("doc_id", "text")
    if read is not None:
        before = scratch(_as_read(docs, read), "read")
        judged = judged.union(before)
    every = ngram_join(judged, k, num, den)
    lead = "(n_shingles = 0 OR doc_id <=> component_id)"
    found = (every.where(lead)
             .select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct())
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    if read is not None:
        lost = (every.where(f"NOT {lead} AND doc_id IS NOT NULL").select("doc_id", "text_hash")
                .join(before.select("doc_id", F.xxhash64("text").alias("text_hash")).hint("shuffle_hash"),
                      ["doc_id", "text_hash"], "left_semi").select("doc_id").distinct())
        rows = rows.join(lost.hint("shuffle_hash"), "doc_id", "left_anti").select("row", "doc_id", "text_hash")
    return (rows.join(found.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(found["kept_id"])
                      & (rows["text_hash"] == found["kept_hash"]))
            .dropDuplicates(["kept_id", "kept_hash"]).select("row.*"))
