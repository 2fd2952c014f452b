"""Token counts that follow edits.

A document's pre-tokens are the leaves of a segment tree (some dozens to a
leaf node) whose nodes hold sums of characters and tokens. An edit is found by
descending on the character sums. Re-encoding starts at the first pre-token
whose end lies less than two characters before the edit (the pattern looks no
further ahead than that) and stops at the first old boundary behind the edit
that is a boundary again: from a common boundary on, equal text is cut
equally. Only the pre-tokens in between are encoded, and only the sums above
the touched leaves change.

Trees are rows of a table (``trees``, ``store``): a text is encoded once, and
batches of edits (``edited``, ``edit_table``) read the trees of the buckets
they touch and write them back.

Cases: null text is empty and has 0 tokens, and stays null when nothing is
put in; no edits, or a null list, leave the count; edits are in code points of
the given text, must not overlap and may touch, be empty or insert; repeated
rows are counted alike; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.llm import bpe
from meteora.llm.common import drop, scratch

LEAF = 64
LOOK_AHEAD = 2

#: What the query's edits replace: mail and network addresses.
ADDRESSES = re.compile(r"(?P<mail>[\w.+-]+@[\w-]+(?:\.[\w-]+)+)|(?P<ip>\b\d{1,3}(?:\.\d{1,3}){3}\b)")


class Encoder:
    """Cuts texts into pre-tokens and counts their tokens; remembers counts."""

    def __init__(self, path: str):
        self.classes, _, self.encode, _ = bpe._worker_state(path)
        self.known: dict[str, int] = {}
        self.encoded = 0

    def cut(self, text: str) -> list[str]:
        if not text:
            return []
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = bpe.pretoken_starts(points, np.zeros(1, np.int64), self.classes).tolist()
        return [text[a:b] for a, b in zip(at, [*at[1:], len(text)], strict=True)]

    def count(self, pieces: list[str]) -> list[int]:
        self.encoded += len(pieces)
        new = list({p for p in pieces if p not in self.known})
        if len(self.known) + len(new) > bpe.REMEMBERED // 4:
            self.known.clear()
            new = list(set(pieces))
        if new:
            for p, ids in zip(new, self.encode(new, self.classes), strict=True):
                self.known[p] = len(ids)
        return [self.known[p] for p in pieces]


def sums(leaves: np.ndarray) -> np.ndarray:
    """The nodes of a segment tree: node ``n`` is the sum of ``2n`` and ``2n + 1``."""
    n = 1 << (max(len(leaves), 1) - 1).bit_length()
    out = np.zeros(2 * n, np.int64)
    out[n:n + len(leaves)] = leaves
    while n > 1:
        out[n // 2:n] = out[n:2 * n:2] + out[n + 1:2 * n:2]
        n //= 2
    return out


def grown(lens: np.ndarray, counts: np.ndarray) -> tuple:
    """(pre-tokens of each leaf, character sums, token sums) of a new tree."""
    at = np.arange(0, len(lens), LEAF)
    sizes = np.diff(np.append(at, len(lens))) if len(at) else np.zeros(1, np.int64)
    chars, tokens = (np.add.reduceat(x.astype(np.int64), at) if len(at) else sizes for x in (lens, counts))
    return sizes, sums(chars), sums(tokens)


class TokenTree:
    """Segment tree over the pre-tokens of one text. ``kept`` is a row of a
    tree table (``PARTS``); nothing is cut or encoded then, and only leaves
    that an edit touches are unpacked."""

    def __init__(self, text: str, encoder: Encoder, kept: tuple | None = None):
        self.encoder = encoder
        if kept is None:
            pieces = encoder.cut(text)
            lens, counts = np.array([*map(len, pieces)], np.int64), np.array(encoder.count(pieces), np.int64)
            kept = lens, counts, *grown(lens, counts)
        self.given = text
        self.lens, self.counts, self.sizes = (np.asarray(x, np.int64) for x in kept[:3])
        self.chars, self.tokens = (np.asarray(x, np.int64).tolist() for x in kept[3:])
        self.width, self.n = len(self.chars) // 2, len(self.sizes)
        self.piece = np.concatenate([[0], np.cumsum(self.sizes)])
        self.place = np.concatenate([[0], np.cumsum(self.chars[self.width:self.width + self.n])])
        self.open: dict[int, tuple[list[str], list[int]]] = {}

    def leaf(self, i: int) -> tuple[list[str], list[int]]:
        if i not in self.open:
            a, b = self.piece[i], self.piece[i + 1]
            ends = (self.place[i] + np.cumsum(self.lens[a:b])).tolist()
            self.open[i] = ([self.given[x:y] for x, y in zip([int(self.place[i]), *ends], ends)],
                            self.counts[a:b].tolist())
        return self.open[i]

    def _weigh(self, i: int) -> None:
        pieces, counts = self.leaf(i)
        self.chars[self.width + i] = sum(map(len, pieces))
        self.tokens[self.width + i] = sum(counts)

    def _sum(self, n: int) -> None:
        self.chars[n] = self.chars[2 * n] + self.chars[2 * n + 1]
        self.tokens[n] = self.tokens[2 * n] + self.tokens[2 * n + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join("".join(self.open[i][0]) if i in self.open else self.given[self.place[i]:self.place[i + 1]]
                       for i in range(self.n))

    def kept(self) -> tuple:
        """The tree as the columns ``PARTS``."""
        lens, counts, sizes = [], [], self.sizes.copy()
        for i in range(self.n):
            pieces, own = self.open.get(i, (None, None))
            cut = slice(self.piece[i], self.piece[i + 1])
            lens.append(self.lens[cut] if own is None else np.array([*map(len, pieces)], np.int64))
            counts.append(self.counts[cut] if own is None else np.array(own, np.int64))
            sizes[i] = len(lens[-1])
        return np.concatenate(lens), np.concatenate(counts), sizes, self.chars, self.tokens

    def find(self, at: int) -> tuple[int, int]:
        """(leaf, its first character) of the character ``at``."""
        n, before = 1, 0
        while n < self.width:
            n *= 2
            if at >= before + self.chars[n] and self.chars[n + 1]:
                before += self.chars[n]
                n += 1
        return n - self.width, before

    def replace(self, start: int, stop: int, new: str) -> None:
        leaf, before = self.find(max(0, start - LOOK_AHEAD))
        pieces, counts = self.leaf(leaf)
        keep, at = 0, before
        while keep < len(pieces) and at + len(pieces[keep]) + LOOK_AHEAD <= start:
            at += len(pieces[keep])
            keep += 1
        old, last = list(pieces[keep:]), leaf
        end = at + sum(map(len, old))
        while True:
            while last + 1 < self.n and end < stop + 1:
                last += 1
                old += self.leaf(last)[0]
                end += self.chars[self.width + last]
            ahead, k = "", last + 1
            while len(ahead) < LOOK_AHEAD and k < self.n:
                ahead += "".join(self.leaf(k)[0])[:LOOK_AHEAD]
                k += 1
            whole = "".join(old)
            fresh = whole[:start - at] + new + whole[stop - at:]
            cut = self.encoder.cut(fresh + ahead)
            found = self._meet(cut, old, stop - at, len(fresh) - len(whole), at_end=not ahead)
            if found is not None:
                break
            if last + 1 >= self.n:
                raise AssertionError("the end of a text is a boundary")
            last += 1
            old += self.leaf(last)[0]
            end += self.chars[self.width + last]
        changed, rest = found
        tail = old[rest:]
        all_counts = [c for i in range(leaf, last + 1) for c in self.leaf(i)[1]][keep + rest:]
        self.open[leaf] = (pieces[:keep] + cut[:changed] + tail, counts[:keep] + self.encoder.count(cut[:changed])
                             + all_counts)
        for i in range(leaf + 1, last + 1):
            self.open[i] = ([], [])
        touched = {(self.width + i) for i in range(leaf, last + 1)}
        for i in range(leaf, last + 1):
            self._weigh(i)
        while touched != {1} and touched:
            touched = {n // 2 for n in touched if n > 1}
            for n in touched:
                self._sum(n)

    @staticmethod
    def _meet(cut, old, stop, shift, at_end):
        """(new pre-tokens, old ones) before the first common boundary at or
        behind ``stop``."""
        bounds, at = {}, 0
        for i, p in enumerate(cut):
            bounds[at] = i
            at += len(p)
        bounds[at] = len(cut)
        at = 0
        for j, p in enumerate([*old, ""]):
            if at >= stop and at + shift in bounds and (j < len(old) or at_end or bounds[at + shift] < len(cut)):
                return bounds[at + shift], j
            at += len(p)
        return None


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits of a cleaning step: lines equal to an earlier line go, and mail
    and network addresses become marks."""
    edits, seen, at = [], set(), 0
    for line in text.split("\n"):
        if line.strip() and line in seen:
            edits.append((at, min(len(text), at + len(line) + 1), ""))
        else:
            seen.add(line)
            edits.extend((at + m.start(), at + m.end(), "[mail]" if m["mail"] else "[address]")
                         for m in ADDRESSES.finditer(line))
        at += len(line) + 1
    return edits


#: The columns of a tree: characters and tokens of every pre-token, how many
#: pre-tokens each leaf has, and the nodes' sums of characters and of tokens.
PARTS = ("lens", "counts", "leaves", "chars", "tokens")
EDITS = "array<struct<start:long,stop:long,text:string>>"


def _lists(rows: list, kind) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat).cast(kind))


def _part_columns(kept: list[tuple]) -> list[pa.Array]:
    return [_lists([k[j] for k in kept], pa.int32() if j < 3 else pa.int64()) for j in range(len(PARTS))]


def _tree_schema(docs: DataFrame) -> str:
    """Spark's names of the columns that a tree row has."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return f"doc_id {kind}, text string, " + ", ".join(
        f"{c} array<{'int' if j < 3 else 'long'}>" for j, c in enumerate(PARTS))


def _grow_pass(path: str):
    def run(batches):
        for batch in batches:
            kept = [(lens, counts, *grown(lens, counts)) for lens, counts in bpe.encode(batch.column(1), path, counts=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), *_part_columns(kept)], ["doc_id", "text", *PARTS])

    return run


def trees(docs: DataFrame, path: str) -> DataFrame:
    """One tree row for each row of ``docs``: doc_id, text, text_hash and
    ``PARTS``. Every text is encoded here, once."""
    return docs.select("doc_id", "text").mapInArrow(_grow_pass(path), _tree_schema(docs)).withColumn(
        "text_hash", F.xxhash64("text"))


COUNTS = ("n_tokens", "n_edits", "n_tokens_after", "n_reencoded")


def _edit_pass(path: str, edits_of, keep: bool):
    def run(batches):
        encoder = Encoder(path)
        for batch in batches:
            texts, counted, kept = [], [], []
            parts = [batch.column(2 + j) for j in range(len(PARTS))]
            for i, (text, given) in enumerate(zip(batch.column(1).to_pylist(), batch.column(7).to_pylist(), strict=True)):
                edits = edits_of(text or "") if edits_of else [(e["start"], e["stop"], e["text"] or "") for e in given or ()]
                own = tuple(p[i].values.to_numpy() for p in parts) if edits or keep else None
                before = after = parts[4][i].values[1].as_py()
                cost = 0
                if edits:
                    tree = TokenTree(text or "", encoder, own)
                    encoder.encoded = 0
                    for start, stop, new in sorted(edits, reverse=True):
                        tree.replace(start, stop, new)
                    after, cost = tree.total, encoder.encoded
                    if keep:
                        text, own = tree.text(), tree.kept()
                if keep:
                    texts.append(text)
                    kept.append(own)
                counted.append((before, len(edits), after, cost))
            out = [pa.array([c[j] for c in counted], pa.int64()) for j in range(len(COUNTS))]
            whole = [pa.array(texts, pa.string()), *_part_columns(kept)] if keep else []
            yield pa.record_batch([batch.column(0), *whole, *out],
                                  ["doc_id", *(("text", *PARTS) if keep else ()), *COUNTS])

    return run


def edited(rows: DataFrame, path: str, edits: str | None = None, keep: bool = True) -> DataFrame:
    """Tree rows after edits, with ``COUNTS``; without ``keep`` the counts
    alone. ``edits`` names a column of type ``EDITS``; without it the edits
    are ``redactions`` of each text. Only what edits touch is encoded."""
    numbers = ", ".join(f"{c} long" for c in COUNTS)
    schema = f"{_tree_schema(rows)}, {numbers}" if keep else f"{_tree_schema(rows).split(',')[0]}, {numbers}"
    out = rows.selectExpr("doc_id", "text", *PARTS, f"CAST({edits or 'NULL'} AS {EDITS}) AS edits").mapInArrow(
        _edit_pass(path, None if edits else redactions, keep), schema)
    return out.withColumn("text_hash", F.xxhash64("text")) if keep else out


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int").alias("bucket")


def store(rows: DataFrame, folder: str, buckets: int = 256) -> None:
    """Write trees as a table in buckets of ids; buckets that ``rows`` has
    take the place of those there. Rows of an id are spread over eight files."""
    (rows.select("doc_id", "text", "text_hash", *PARTS, _bucket(buckets))
     .repartition("bucket", F.pmod(F.col("text_hash"), F.lit(8)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(folder, compression="zstd"))


def edit_table(edits: DataFrame, folder: str, path: str, buckets: int = 256) -> DataFrame:
    """Apply a table of edits (doc_id, text_hash, start, stop, text) to the
    trees in ``folder`` and return doc_id and ``COUNTS`` of the edited rows.
    Only the buckets of edited ids are read and written, and only touched
    pre-tokens encoded. ``text_hash`` tells texts of one id apart and says
    which text the edits mean: a batch that comes again finds no such text
    and changes nothing. Repeated rows of ``edits`` are one edit."""
    spark = edits.sparkSession
    lists = scratch(edits.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "stop", "text")).alias("edits"))
                    .select(F.col("doc_id").alias("edit_id"), F.col("text_hash").alias("edit_hash"), "edits",
                            F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int").alias("edit_bucket")), "edits")
    touched = [r.edit_bucket for r in lists.select("edit_bucket").distinct().collect()]  # as many as there are buckets
    rows = spark.read.parquet(folder).where(F.col("bucket").isin(touched))
    both = rows.join(lists.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(lists["edit_id"])
                     & (rows["text_hash"].eqNullSafe(lists["edit_hash"])), "left")
    after = scratch(edited(both, path, "edits"), "trees", "zstd")
    store(after, folder, buckets)
    out = scratch(after.where("n_edits > 0").select("doc_id", *COUNTS), "counts")
    drop(lists, after)
    return out


def count_edits(docs: DataFrame, path: str) -> DataFrame:
    """Token counts before and after the ``redactions`` of each text. The
    trees are written first and the edits applied to what was written."""
    kept = scratch(trees(docs, path), "trees", "zstd")
    out = scratch(edited(kept, path, keep=False), "counts")
    drop(kept)
    return out
