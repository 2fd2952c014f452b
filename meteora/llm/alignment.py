"""Cross-tokenizer alignment with an associative fragment monoid.

A text is encoded twice, as ids of A (byte-level BPE of blank + text) and of
B (a piece model that puts the blank in front itself). Byte offsets where
tokens of both end cut them into groups.

A fragment describes a byte range of a text: the tokens that end in it up to
the first common end (open prefix), the groups closed inside, and the tokens
behind the last common end (open suffix). Fragments of neighbouring ranges
compose: the left one's suffix and the right one's prefix close a group.
Composition is associative and the empty fragment is its identity, so a text
of more than ``RANGE`` bytes is cut into ranges that different tasks encode,
and a tree of joins by ``FAN`` fragments puts it together. A range's task
gets the text from the last safe cut before the range to the first one
behind it, where no token of either side can reach across: a blank after
something that isn't white space. Ranges without a safe cut are merged.

An id pair's count is over all texts. Pairs counted often, at most ``HEAD``
of them, are broadcast; the others are joined by pair, so both ways together
cover every pair.

Cases: null and empty texts and those whose tokens don't spell blank + text
(U+2581 in the text, which B reads as a blank) have zeros and no hash;
strings of special tokens are plain text; repeated rows and null ids are rows
of their own and count each; ties for a B id's highest count are all best; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.llm import bpe
from meteora.llm.common import drop, scratch

#: Bytes of a range of a long text, and fragments composed by one call.
RANGE = 1 << 16
FAN = 16
#: Id pairs broadcast at most (13 MB).
HEAD = 1 << 20
#: Pairs a task holds before it gives their counts on, and units of text a
#: worker remembers for each tokenizer.
HELD = 2_000_000
REMEMBERED = 300_000

FRAGMENT = ("row long, doc_id long, k long, ok boolean, n_a long, n_b long, n_groups long, cut boolean, "
            "prefix_a binary, prefix_b binary, suffix_a binary, suffix_b binary, closed binary, links binary")
DONE = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs binary, times binary")
NONE = np.zeros(0, np.uint32)


class Vocabularies:
    """Byte lengths of both sides' tokens, and their decimal ids with the
    separator that follows."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.len_a = np.zeros(max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1, np.int64)
        for token, i in vocab.items():
            self.len_a[i] = len(token)  # byte-level: a letter is a byte
        pieces = bpe.model_bytes(sentencepiece.SentencePieceProcessor(model_file=b_path))
        self.len_b = np.array([len(p) for p in pieces], np.int64)
        n, m = len(self.len_a), len(self.len_b)
        self.text = [f"{i}{s}" for count, marks in ((n, ",|"), (m, ",;")) for s in marks for i in range(count)]


def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    holder = sys.modules.setdefault("_meteora_align", types.ModuleType("_meteora_align"))
    key = f"{a_path} {b_path}"
    if key not in holder.__dict__:
        holder.__dict__[key] = Vocabularies(a_path, b_path)
    return holder.__dict__[key]


@dataclass
class Fragment:
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0  # closed inside
    cut: bool = False  # holds a common end
    prefix_a: np.ndarray = field(default_factory=lambda: NONE)
    prefix_b: np.ndarray = field(default_factory=lambda: NONE)
    suffix_a: np.ndarray = field(default_factory=lambda: NONE)
    suffix_b: np.ndarray = field(default_factory=lambda: NONE)
    closed: list = field(default_factory=list)  # bytes, each group followed by ;
    links: list = field(default_factory=list)  # arrays of a * |B| + b


def groups_text(a, b, group_a, group_b, vocab: Vocabularies) -> bytes:
    """``a1,a2|b1;...;`` of tokens whose groups are numbered from 0."""
    count = int(group_b[-1]) + 1
    upto_a, upto_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=count))]) for g in (group_a, group_b))
    n, m = len(vocab.len_a), len(vocab.len_b)
    code = np.empty(len(a) + len(b), np.int64)
    last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
    code[np.arange(len(a)) + upto_b[group_a]] = a + n * last_a
    code[np.arange(len(b)) + upto_a[group_b + 1]] = 2 * n + b + m * last_b
    return "".join(map(vocab.text.__getitem__, code.tolist())).encode()


def fragment(a, end_a, b, end_b, vocab: Vocabularies) -> Fragment:
    """The fragment of tokens with their end offsets."""
    both = np.intersect1d(end_a, end_b, assume_unique=True)
    if not len(both):
        return Fragment(len(a), len(b), prefix_a=a, prefix_b=b)
    in_a, in_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
    one_a, one_b = np.searchsorted(in_a, 1), np.searchsorted(in_b, 1)
    all_a, all_b = np.searchsorted(in_a, len(both)), np.searchsorted(in_b, len(both))
    out = Fragment(len(a), len(b), len(both) - 1, True, a[:one_a], b[:one_b], a[all_a:], b[all_b:])
    if len(both) > 1:
        x, y, gx, gy = a[one_a:all_a], b[one_b:all_b], in_a[one_a:all_a] - 1, in_b[one_b:all_b] - 1
        out.closed = [groups_text(x, y, gx, gy, vocab)]
        out.links = [_link(x[np.append(gx[1:] != gx[:-1], True)], y[np.append(gy[1:] != gy[:-1], True)], vocab)]
    return out


def _link(a, b, vocab):
    return a.astype(np.int64) * len(vocab.len_b) + b


def _close(a, b, vocab) -> tuple[bytes, np.ndarray]:
    text = f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))};"
    return text.encode(), _link(a[-1:], b[-1:], vocab)


def compose(left: Fragment, right: Fragment, vocab: Vocabularies) -> Fragment:
    n = left.n_a + right.n_a, left.n_b + right.n_b, left.n_groups + right.n_groups
    join = lambda x, y: np.concatenate([x, y])
    if not left.cut:
        return Fragment(*n, right.cut, join(left.prefix_a, right.prefix_a), join(left.prefix_b, right.prefix_b),
                        right.suffix_a, right.suffix_b, right.closed, right.links)
    middle_a, middle_b = join(left.suffix_a, right.prefix_a), join(left.suffix_b, right.prefix_b)
    if not right.cut:
        return Fragment(*n, True, left.prefix_a, left.prefix_b, middle_a, middle_b, left.closed, left.links)
    text, link = _close(middle_a, middle_b, vocab)
    return Fragment(n[0], n[1], n[2] + 1, True, left.prefix_a, left.prefix_b, right.suffix_a, right.suffix_b,
                    [*left.closed, text, *right.closed], [*left.links, link, *right.links])


def finish(whole: Fragment, vocab: Vocabularies):
    """(groups without the last ;, links) of a whole text's fragment: its
    ends are common ends."""
    text, link = _close(whole.prefix_a, whole.prefix_b, vocab)
    return b"".join([text, *whole.closed])[:-1], np.concatenate([link, *whole.links])


def _done_row(row, doc, ok, whole, vocab):
    if not ok or not whole.cut:
        return row, doc, 0, 0, 0, 0, "", b"", b""
    groups, links = finish(whole, vocab)
    pairs, times = np.unique(links, return_counts=True)
    return (row, doc, whole.n_a, whole.n_b, whole.n_groups + 1, len(links), hashlib.sha256(groups).hexdigest(),
            pairs.astype(np.uint32).tobytes(), times.astype(np.uint32).tobytes())


def _table(rows, schema):
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.record_batch([pa.array(c, kinds[t]) for c, (_, t) in zip(cols, fields, strict=True)],
                           [n for n, _ in fields])


def _encoded(texts: list, a_path, b_path):
    """Pairs of id arrays; None where the tokens don't spell the text."""
    vocab = vocabularies(a_path, b_path)
    sides = (bpe.encode(texts, p, remembered=REMEMBERED) for p in (a_path, b_path))
    for text, a, b in zip(texts, *sides, strict=True):
        size = len(text.encode())
        right = not (b == bpe.BAD).any() and int(vocab.len_a[a].sum()) == size == int(vocab.len_b[b].sum())
        yield (a, b) if right else None


def _short_pass(a_path: str, b_path: str):
    """Texts of one range, finished where they are read."""
    def run(batches):
        vocab = vocabularies(a_path, b_path)
        for batch in batches:
            rows, texts = [], [" " + (t or "") for t in batch.column(2).to_pylist()]
            for i, found in enumerate(_encoded(texts, a_path, b_path)):
                whole = Fragment()
                if found and len(texts[i]) > 1:
                    a, b = found
                    whole = fragment(a, np.cumsum(vocab.len_a[a]), b, np.cumsum(vocab.len_b[b]), vocab)
                rows.append(_done_row(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), True, whole, vocab))
            yield _table(rows, DONE)

    return run


def safe_cuts(text: str) -> np.ndarray:
    """Byte offsets of blanks that follow something that isn't white space."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((points[1:] == 32) & (bpe.char_classes()[points[:-1]] != bpe.SPACE)) + 1
    size = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF).astype(np.int64)
    return np.concatenate([[0], np.cumsum(size)])[at]


def ranges(total: int, cuts: np.ndarray, each: int):
    """(lo, hi, from, to): tokens that end in (lo, hi] are those of the text
    from ``from`` to ``to``. A range with no cut inside goes on to the next."""
    lo = 0
    while lo < total:
        inside = np.searchsorted(cuts, lo + each, "right")
        behind = int(cuts[inside]) if inside < len(cuts) else total
        hi = lo + each
        if inside == 0 or cuts[inside - 1] <= lo:  # one stretch covers the range
            hi = max(hi, behind)
        hi = min(hi, total)
        first = np.searchsorted(cuts, lo, "right")
        start = int(cuts[first - 1]) if first else 0
        stop = np.searchsorted(cuts, hi)
        yield lo, hi, start, int(cuts[stop]) if stop < len(cuts) else total
        lo = hi


def _range_pass(each: int):
    def run(batches):
        for batch in batches:
            for row, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                full = " " + text
                data = full.encode()
                found = [(row, doc, k, lo - start, hi - start, data[start:stop].decode())
                         for k, (lo, hi, start, stop) in enumerate(ranges(len(data), safe_cuts(full), each))]
                for lo in range(0, len(found), 64):
                    yield _table(found[lo:lo + 64], "row long, doc_id long, k long, lo long, hi long, text string")

    return run


def _fragment_row(row, doc, k, ok, f: Fragment):
    arrays = [x.astype(np.uint32).tobytes() for x in (f.prefix_a, f.prefix_b, f.suffix_a, f.suffix_b)]
    links = np.concatenate([np.zeros(0, np.int64), *f.links]).astype(np.uint32).tobytes()
    return row, doc, k, ok, f.n_a, f.n_b, f.n_groups, f.cut, *arrays, b"".join(f.closed), links


def _read(r) -> Fragment:
    arrays = [np.frombuffer(r[c], np.uint32) for c in ("prefix_a", "prefix_b", "suffix_a", "suffix_b")]
    return Fragment(r["n_a"], r["n_b"], r["n_groups"], r["cut"], *arrays,
                    [r["closed"]], [np.frombuffer(r["links"], np.uint32).astype(np.int64)])


def _fragment_pass(a_path: str, b_path: str):
    def run(batches):
        vocab = vocabularies(a_path, b_path)
        for batch in batches:
            row, doc, k, lo, hi = (batch.column(i).to_pylist() for i in range(5))
            out = []
            for i, found in enumerate(_encoded(batch.column(5).to_pylist(), a_path, b_path)):
                f = Fragment()
                if found:
                    sides = []
                    for ids, lens in zip(found, (vocab.len_a, vocab.len_b), strict=True):
                        end = np.cumsum(lens[ids])
                        mine = slice(*np.searchsorted(end, [lo[i], hi[i]], "right"))
                        sides += [ids[mine], end[mine]]
                    f = fragment(*sides, vocab)
                out.append(_fragment_row(row[i], doc[i], k[i], found is not None, f))
            yield _table(out, FRAGMENT)

    return run


def _compose_pass(a_path: str, b_path: str, last: bool):
    def run(table):
        vocab = vocabularies(a_path, b_path)
        rows = sorted(table.to_pylist(), key=lambda r: r["k"])
        ok, whole = all(r["ok"] for r in rows), Fragment()
        for r in rows:
            whole = compose(whole, _read(r), vocab)
        one = rows[0]
        if last:
            out = _table([_done_row(one["row"], one["doc_id"], ok, whole, vocab)], DONE)
        else:
            out = _table([_fragment_row(one["row"], one["doc_id"], one["k"] // FAN, ok, whole if ok else Fragment())],
                         FRAGMENT)
        return pa.Table.from_batches([out])

    return run


def _long_texts(docs: DataFrame, a_path: str, b_path: str, each: int) -> DataFrame:
    spark = docs.sparkSession
    parts = scratch(docs.mapInArrow(_range_pass(each), "row long, doc_id long, k long, lo long, hi long, text string"),
                    "ranges")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    level = scratch(parts.repartition(tasks, "row", "k").mapInArrow(_fragment_pass(a_path, b_path), FRAGMENT),
                    "fragments")
    drop(parts)
    most = level.agg(F.max("k")).first()[0] or 0
    while most >= FAN:
        up = scratch(level.groupBy("row", F.floor(F.col("k") / FAN).alias("up"))
                     .applyInArrow(_compose_pass(a_path, b_path, False), FRAGMENT), "fragments")
        drop(level)
        level, most = up, most // FAN
    done = scratch(level.groupBy("row").applyInArrow(_compose_pass(a_path, b_path, True), DONE), "long")
    drop(level)
    return done


def alignments(docs: DataFrame, a_path: str, b_path: str, each: int = RANGE) -> DataFrame:
    """row (a number of the row), doc_id, the counts and hash of its groups,
    and its distinct id pairs (a * |B| + b as 32-bit numbers) with how often
    it holds them; a scratch table."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    long = F.coalesce(F.octet_length("text") >= each, F.lit(False))
    short = (rows.where(~long).withColumn("row", -1 - F.col("row"))
             .mapInArrow(_short_pass(a_path, b_path), DONE))
    done = _long_texts(rows.where(long), a_path, b_path, each)
    out = scratch(short.unionByName(done), "aligned")
    drop(done)
    return out


def _pair_pass(batches):
    """Id pairs of a task with their counts."""
    held, times, size = [], [], 0

    def counted():
        pairs, at = np.unique(np.concatenate(held), return_inverse=True)
        n = np.bincount(at, np.concatenate(times), len(pairs)).astype(np.int64)
        return pa.record_batch({"pair": pa.array(pairs.astype(np.int64)), "n": pa.array(n)})

    for batch in batches:
        for pairs, n in zip(*batch.columns, strict=True):
            held.append(np.frombuffer(pairs.as_buffer(), np.uint32))
            times.append(np.frombuffer(n.as_buffer(), np.uint32))
            size += len(held[-1])
        if size > HELD:
            yield counted()
            held, times, size = [], [], 0
    if size:
        yield counted()


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """pair, n, best (n is the highest of its B id); a scratch table."""
    counts = scratch(aligned.select("pairs", "times").mapInArrow(_pair_pass, "pair long, n long")
                     .groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.pmod("pair", F.lit(n_b)).alias("b")
    top = counts.groupBy(b).agg(F.max("n").alias("top"))  # a row for each id of B's vocabulary at most
    out = scratch(counts.withColumn("b", F.pmod("pair", F.lit(n_b))).join(F.broadcast(top), "b")
                  .select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "counts")
    drop(counts)
    return out


def _score_pass(head):
    def run(batches):
        pair, n, best = head.value
        for batch in batches:
            n_best, total, rest, rest_times = [], [], [], []
            for pairs, times in zip(batch.column(1), batch.column(2), strict=True):
                p = np.frombuffer(pairs.as_buffer(), np.uint32).astype(np.int64)
                t = np.frombuffer(times.as_buffer(), np.uint32).astype(np.int64)
                at = np.minimum(np.searchsorted(pair, p), max(len(pair) - 1, 0))
                here = pair[at] == p if len(pair) else np.zeros(len(p), bool)
                n_best.append(int(t[here][best[at[here]]].sum()))
                total.append(int((n[at[here]] * t[here]).sum()))
                rest.append(p[~here])
                rest_times.append(t[~here])
            yield pa.record_batch([batch.column(0), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()),
                                   pa.array(rest, pa.list_(pa.int64())), pa.array(rest_times, pa.list_(pa.int64()))],
                                  ["row", "n_best", "count_sum", "rest", "times"])

    return run


def align(docs: DataFrame, a_path: str, b_path: str, each: int = RANGE, most: int = HEAD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256
    of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    n_b = len(vocabularies(a_path, b_path).len_b)
    aligned = alignments(docs, a_path, b_path, each)
    counts = pair_counts(aligned, n_b)
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["p"]: r["c"] for r in counts.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}
    least, total = 64, 0
    for p in sorted(sizes, reverse=True):
        total += sizes[p]
        if total > most:
            break
        least = p
    often = counts.where(power >= least).orderBy("pair").toPandas()
    head = spark.sparkContext.broadcast((often["pair"].to_numpy(np.int64), often["n"].to_numpy(np.int64),
                                         often["best"].to_numpy(bool)))
    scored = scratch(aligned.select("row", "pairs", "times").mapInArrow(
        _score_pass(head), "row long, n_best long, count_sum long, rest array<long>, times array<long>"), "scored")
    rest = (scored.where(F.size("rest") > 0)
            .select("row", F.explode(F.arrays_zip(F.col("rest").alias("pair"), F.col("times").alias("t"))).alias("x"))
            .select("row", "x.pair", "x.t"))
    more = (rest.join(counts.where(power < least).hint("shuffle_hash"), "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("t")).otherwise(0)).alias("more_best"),
                 F.sum(F.col("n") * F.col("t")).alias("more_sum")))
    score = (scored.select("row", "n_best", "count_sum").join(more.hint("shuffle_hash"), "row", "left")
             .select("row", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                     (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum")))
    return aligned.drop("pairs", "times").join(score.hint("shuffle_hash"), "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
