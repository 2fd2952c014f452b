"""Exact removal of repeated byte strings of ``LENGTH`` bytes or more.

A byte goes if a ``LENGTH``-byte string that covers it starts anywhere else
too, in another document or in the same one.

1. Equal texts are one text; if one of at least ``LENGTH`` bytes stands in
   two rows, all its bytes go.
2. Every window of ``LENGTH`` bytes has an anchor: its ``GRAM``-byte string
   with the least hash, the leftmost on ties. Equal windows have equal
   anchors at equal places, so a window whose anchor string is found once in
   the corpus is unique. Occurrences of one anchor string in one task are
   told apart there; one row for each string and task goes on to be counted.
3. Texts with repeated anchors are read again and each repeated anchor gives
   a strip: the bytes that windows around it can cover. Strips with one
   anchor string are a collection whose suffixes are sorted column by
   column: every round puts one symbol before the suffix of each strip,
   reorders them by a stable sort on that symbol, as the collection's
   Burrows-Wheeler transform does, and carries the common prefixes of
   neighbours along. A window with a common prefix of ``LENGTH`` with a
   neighbour is repeated. The bytes themselves are compared; hashes only
   bring strips together.
4. Runs of repeated windows return to their texts.

The method's rounds over whole documents would take as many passes over all
data as the longest document has bytes; rounds over strips are
2 * LENGTH - GRAM. The shuffle's partitions take the place of the method's
sequential files: a task holds the strips of one range of anchor hashes.

Cases: null text has 0 bytes like an empty one; texts shorter than
``LENGTH`` lose nothing; repeated rows are equal texts; texts are told apart
by the whole SHA-256 (a text goes by ``NODE_BITS`` of it, and by a number of
its own where another text has the same bits); an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.llm.common import drop, release, scratch
from meteora.llm.ngram_join import range_bits
from meteora.llm.shingles import _BACK, _BASE, CHUNK, _powers, mix

LENGTH = 200
GRAM = 32
#: Bytes of text for one range of anchor hashes.
RANGE_BYTES = 2 << 20
#: Anchors or strip bytes held by a task before they go out.
HELD_ANCHORS = 500_000
HELD_BYTES = 12 << 20
#: Strips sorted together.
COLLECTION = 5_000
#: Bits of the digest that name a text, 60 at most.
NODE_BITS = 60

_BYTES = mix(np.arange(1000, 1256, dtype=np.uint64)) | np.uint64(1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _powers(_BASE, len(data)), out=sums[1:])
    n = len(data) - gram + 1
    return mix((sums[gram:] - sums[:-gram]) * _powers(_BACK, len(data))[:n])


def anchors(data: np.ndarray, cuts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the anchors of texts laid end to end, and their hashes."""
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) < length:
        return none
    h = gram_hashes(data, gram)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    w = length - gram + 1
    pad = np.full(-len(key) % w, np.iinfo(np.uint64).max, np.uint64)
    blocks = np.concatenate([key, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    windows = len(data) - length + 1
    least = np.minimum(back[:windows], ahead[w - 1:w - 1 + windows])
    inside = np.zeros(len(data) + 1, np.int32)
    room = np.diff(cuts) >= length
    np.add.at(inside, cuts[:-1][room], 1)
    np.add.at(inside, cuts[1:][room] - length + 1, -1)
    at = least[np.cumsum(inside[:windows]) > 0] & np.uint64(0xFFFFFFFF)
    at = np.unique(at.astype(np.int64)) if len(at) else none[0]
    return at, h[at]


def _anchor_pass(bits: int, length: int, gram: int, local: bool):
    """``local``: the anchors that a task finds more than once; otherwise one
    row of packed columns for each range of hashes."""
    def run(batches):
        seen: set[int] = set()
        held, size = [], 0

        def out():
            h, node, pos = (np.concatenate([x[i] for x in held]) for i in range(3))
            order = np.argsort(h, kind="stable")
            h, node, pos = h[order], node[order], pos[order]
            first = np.r_[True, h[1:] != h[:-1]]
            count = np.diff(np.r_[np.flatnonzero(first), len(h)])
            many = np.repeat(count > 1, count)
            if local:
                return _by_node(node[many], pos[many])
            fh, fn, fp, fm = h[first], node[first], pos[first], (count > 1).astype(np.uint8)
            cuts = np.searchsorted(fh >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(cuts))
            part = lambda x: pa.array([x[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary())
            return pa.record_batch({"r": pa.array(some, pa.int32()), "h": part(fh), "node_of": part(fn),
                                    "pos_of": part(fp), "many": part(fm)})

        for batch in batches:
            nodes = batch.column(0).to_numpy()
            new = []
            for i, x in enumerate(nodes.tolist()):
                if x not in seen:
                    seen.add(x)
                    new.append(i)
            texts = batch.column(1).take(pa.array(new, pa.int32()))
            nodes = nodes[new]
            for lo, hi, data, cuts in _chunks(texts):
                at, h = anchors(data, cuts, length, gram)
                d = np.searchsorted(cuts, at, "right") - 1
                held.append((h, nodes[lo:hi][d], (at - cuts[d]).astype(np.int32)))
                size += len(at)
            if size > HELD_ANCHORS:
                yield out()
                held, size = [], 0
        if size:
            yield out()
        held = None
        release()

    return run


def _by_node(node, pos):
    order = np.lexsort((pos, node))
    node, pos = node[order], pos[order]
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
    offsets = np.r_[first, len(node)].astype(np.int32)
    return pa.record_batch({"node": pa.array(node[first], pa.int64()),
                            "at": pa.ListArray.from_arrays(pa.array(offsets), pa.array(pos, pa.int32()))})


def _chunks(texts: pa.Array):
    """(first, end, bytes, cuts) of stretches of a binary column."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64) \
        if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        yield at, to, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def _repeated_anchors(pdf):
    import pandas as pd
    col = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in pdf[c]])
    h, node, pos, many = col("h", np.uint64), col("node_of", np.int64), col("pos_of", np.int32), col("many", np.uint8)
    order = np.lexsort((pos, node, h))
    h, node, pos, many = h[order], node[order], pos[order], many[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (node[1:] != node[:-1]) | (pos[1:] != pos[:-1])]
    h, node, pos, many = h[new], node[new], pos[new], many[new]
    first = np.r_[True, h[1:] != h[:-1]]
    count = np.diff(np.r_[np.flatnonzero(first), len(h)])
    ok = (np.repeat(count, count) > 1) & (many == 0)
    return pd.DataFrame({"node": node[ok], "pos": pos[ok]})


def _first_rows(batches):
    """One row for each text; repeated rows of one are in one partition."""
    seen: set[int] = set()
    for batch in batches:
        keep = []
        for node in batch.column(0).to_pylist():
            keep.append(node not in seen)
            seen.add(node)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _strip_pass(bits: int, length: int, gram: int):
    """Strips as (r, hash, node, position, twice, bytes, cover) in packed
    columns, a row for each range of hashes."""
    wide = 2 * length - gram

    def run(batches):
        held = {"h": [], "node": [], "pos": [], "twice": [], "strip": [], "cover": []}
        size = 0

        def out():
            h = np.concatenate(held["h"])
            order = np.argsort(h, kind="stable")
            cuts = np.searchsorted((h[order] >> np.uint64(64 - bits)), np.arange((1 << bits) + 1, dtype=np.uint64))
            cols = {c: np.concatenate(held[c])[order] for c in held}
            some = np.flatnonzero(np.diff(cuts))
            part = lambda x: pa.array([x[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary())
            return pa.record_batch({"r": pa.array(some, pa.int32()), **{c: part(v) for c, v in cols.items()}})

        for batch in batches:
            for node, at, twice, text in zip(*(batch.column(i) for i in range(4)), strict=True):
                node = node.as_py()
                data = np.frombuffer(text.as_buffer(), np.uint8)
                pos = np.unique(at.values.to_numpy()).astype(np.int64)
                h = np.concatenate([gram_hashes(data[p:p + gram], gram) for p in pos])
                lo = pos - (length - gram)
                cover = np.stack([np.maximum(0, -lo), np.minimum(wide, len(data) - lo)], 1).astype(np.int32)
                index = lo[:, None] + np.arange(wide)
                strip = data[np.clip(index, 0, len(data) - 1)]
                held["h"].append(h)
                held["node"].append(np.full(len(pos), node, np.int64))
                held["pos"].append(pos.astype(np.int32))
                held["twice"].append(np.full(len(pos), bool(twice.as_py()), np.uint8))
                held["strip"].append(strip)
                held["cover"].append(cover)
                size += strip.nbytes
                if size > HELD_BYTES:
                    yield out()
                    for c in held:
                        held[c] = []
                    size = 0
        if size:
            yield out()
        held = None
        release()

    return run


def repeated_windows(strips: np.ndarray, cover: np.ndarray, group: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Which windows of each strip equal one of another strip of its group:
    rows are strips, columns the window's start in the strip. Bytes outside
    of ``cover`` belong to no document. ``group`` is sorted."""
    m, wide = strips.shape
    found = np.zeros((m, length - gram + 1), bool)
    order = np.arange(m)
    common = np.zeros(m + 1, np.int32)  # with the suffix before, in the order
    for c in range(wide - 1, -1, -1):
        symbol = strips[order, c].astype(np.int64)
        outside = (c < cover[order, 0]) | (c >= cover[order, 1])
        symbol[outside] = 256
        key = group[order] * 257 + symbol
        new = np.argsort(key, kind="stable")
        key = key[new]
        same = np.flatnonzero((key[1:] == key[:-1]) & (symbol[new[1:]] < 256)) + 1
        after = np.zeros(m + 1, np.int32)
        if len(same):
            ends = np.stack([new[same - 1] + 1, new[same] + 1], 1)
            after[same] = 1 + np.minimum.reduceat(common, ends.ravel())[::2]
        order, common = order[new], after
        if c <= length - gram:
            hit = np.maximum(common[:-1], common[1:]) >= length
            found[order[hit], c] = True
    return found


def _sort_strips(length: int, gram: int):
    wide = 2 * length - gram

    def run(pdf):
        import pandas as pd
        col = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in pdf[c]])
        h, node, pos, twice = col("h", np.uint64), col("node", np.int64), col("pos", np.int32), col("twice", np.uint8)
        strip, cover = col("strip", np.uint8).reshape(-1, wide), col("cover", np.int32).reshape(-1, 2)
        order = np.argsort(h, kind="stable")
        h = h[order]
        group = np.cumsum(np.r_[True, h[1:] != h[:-1]]) - 1
        sizes = np.bincount(group)
        alone = (sizes[group] == 1) & (twice[order] == 0)
        order, group = order[~alone], group[~alone]
        runs = []
        at = 0
        while at < len(order):
            to = min(len(order), at + COLLECTION)
            if to < len(order):  # groups stay whole
                to = int(np.searchsorted(group, group[to - 1], "right"))
            pick = order[at:to]
            found = repeated_windows(strip[pick], cover[pick].astype(np.int64), group[at:to], length, gram)
            starts = np.arange(length - gram + 1)
            whole = (starts >= cover[pick, :1]) & (starts + length <= cover[pick, 1:])
            found = (found | (twice[pick] > 0)[:, None]) & whole
            edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            row, lo = np.nonzero(edge == 1)
            _, hi = np.nonzero(edge == -1)
            base = pos[pick][row].astype(np.int64) - (length - gram)
            runs.append((node[pick][row], base + lo, base + hi - 1 + length))
            at = to
        if not runs:
            return pd.DataFrame({"node": [], "lo": [], "hi": []}).astype("int64")
        node, lo, hi = (np.concatenate([x[i] for x in runs]) for i in range(3))
        del strip, cover, h, pos, twice, runs
        release()
        return pd.DataFrame({"node": node, "lo": lo, "hi": hi})

    return run


def _cut_pass(batches):
    for batch in batches:
        rows = {"node": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        for node, text, spans in zip(*(batch.column(i) for i in range(3)), strict=True):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            edge = np.zeros(len(data) + 1, np.int64)
            lo, hi = spans.values.field(0).to_numpy(), spans.values.field(1).to_numpy()
            np.add.at(edge, lo, 1)
            np.add.at(edge, hi, -1)
            gone = np.cumsum(edge)[:-1] > 0
            rows["node"].append(node.as_py())
            rows["n_removed"].append(int(gone.sum()))
            rows["n_spans"].append(int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)))
            rows["kept_sha256"].append(hashlib.sha256(data[~gone].tobytes()).hexdigest())
        yield pa.record_batch({"node": pa.array(rows["node"], pa.int64()),
                               "n_removed": pa.array(rows["n_removed"], pa.int64()),
                               "n_spans": pa.array(rows["n_spans"], pa.int64()),
                               "kept_sha256": pa.array(rows["kept_sha256"], pa.string())})


def _clashes(texts: DataFrame, short) -> DataFrame:
    """(_sha, _node): numbers below 0 for the texts whose bits another text has too."""
    nodes = texts.groupBy(short.alias("node")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("node")
    return scratch(texts.withColumn("node", short).join(nodes, "node")
                   .select(F.col("sha").alias("_sha"), (-1 - F.monotonically_increasing_id()).alias("_node")), "clashes")


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, node_bits: int = NODE_BITS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    if not 1 <= gram <= length:
        raise ValueError("an anchor must fit into a window")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = docs.select("doc_id", raw.alias("text"), F.sha2(raw, 256).alias("sha"))
    short = F.shiftright(F.conv(F.substring("sha", 2, 15), 16, 10).cast("long"), 60 - node_bits)
    rows = scratch(docs.select("doc_id", "sha", F.octet_length("text").cast("long").alias("n_bytes")), "rows")
    bits = range_bits(rows.agg(F.sum("n_bytes")).first()[0] or 0, RANGE_BYTES)
    texts = (rows.where(F.col("n_bytes") >= length).groupBy("sha")
             .agg(F.min_by("doc_id", F.coalesce("doc_id", F.lit(-1 << 63))).alias("rep"),
                  (F.count(F.lit(1)) > 1).alias("twice"), F.max("n_bytes").alias("n_bytes")))
    stored = scratch(texts, "texts")
    clashes = _clashes(stored, short)

    def noded(df):
        return (df.join(clashes, df["sha"] == clashes["_sha"], "left")
                .withColumn("node", F.coalesce("_node", short)).drop("_sha", "_node"))

    texts = noded(stored)
    long_ = noded(docs.where(F.octet_length("text") >= length))
    texts_in = long_.select("node", "text")
    singles = (texts_in.mapInArrow(_anchor_pass(bits, length, gram, False),
                                   "r int, h binary, node_of binary, pos_of binary, many binary")
               .groupBy("r").applyInPandas(_repeated_anchors, "node long, pos int")
               .groupBy("node").agg(F.collect_list("pos").alias("at")))
    local = texts_in.mapInArrow(_anchor_pass(bits, length, gram, True), "node long, at array<int>")
    at = local.union(singles).groupBy("node").agg(F.flatten(F.collect_list("at")).alias("at"))
    wanted = scratch(at.join(texts, "node").select(F.col("node").alias("of"), "rep", "twice", "at"), "wanted")
    read = (long_.join(wanted.hint("shuffle_hash"), (long_["node"] == wanted["of"])
                       & long_["doc_id"].eqNullSafe(wanted["rep"]))
            .select("node", "at", "twice", "text"))
    read = scratch(read.mapInArrow(_first_rows, "node long, at array<int>, twice boolean, text binary"), "read")
    drop(wanted)
    strips = read.mapInArrow(_strip_pass(bits, length, gram),
                             "r int, h binary, node binary, pos binary, twice binary, strip binary, cover binary")
    spans = strips.groupBy("r").applyInPandas(_sort_strips(length, gram), "node long, lo long, hi long")
    once = texts.where("NOT twice").select("node")
    spans = scratch(spans.groupBy("node").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
                    .join(once, "node"), "spans")
    cut = (read.select("node", "text").join(spans.hint("shuffle_hash"), "node").select("node", "text", "spans")
           .mapInArrow(_cut_pass, "node long, n_removed long, n_spans long, kept_sha256 string"))
    whole = texts.where("twice").select("node", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                                        F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"))
    cut = scratch(cut.union(whole), "cut")
    drop(read, spans, stored)
    none = F.lit(0).cast("long")
    return noded(rows).join(cut, "node", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
