"""Line dedup by content-defined chunks of lines. Spark expressions only.

A text is split at ``\\n`` and cut into chunks at several levels. At the
coarse levels a cyclic rolling hash over the hashes of the last ``ROLL`` lines
sets the boundaries: a chunk ends behind a line whose rolling hash is
divisible by the level's mean length (``MEANS``), so boundaries move with the
lines when text is put in before them. Chunks of three lines or more count.
The finest level has a boundary at every line: its chunks are all pairs of
neighbouring lines, and the single lines of ``LONG`` characters or more or
that are the whole text. So every line of a repeated passage of two lines or
more is in a repeated chunk, and passages are found to their first and last
line.

The hashes of chunks are counted over the whole corpus (two occurrences in one
text count too). Chunks with a hash seen twice are compared by their bytes:
rows are grouped by the chunk's text itself, the first by (doc_id, line
number) stays and the lines of the others are marked. The coarse levels go
first. What lies inside a chunk marked there is not compared again at the
finest level: the chunk's first place holds the same pairs at an earlier
place, so they are later places in any case, and the result is that of the
finest level alone. A copy of a long text thus sends its text once, not every
line twice.

Marked lines that follow each other are a passage; it is removed if it has
``LEAST`` words or is the whole text, so blank lines, brackets and closing
tags that texts have in common stay. The first place of a line never goes, as
no chunk there can have an earlier one.

Only hashes travel for all chunks; the texts of chunks travel when their hash
was seen twice. Groups of equal chunks are aggregated in the map tasks
before they meet; hashes and chunks that over a thousandth of the rows bear
are not joined by their own value, so none fills a task. What returns to the
documents is one list of line numbers each.

Cases: null text stays null and an empty one empty, both have no chunk; rows
with one doc_id and one text are repeated rows and treated alike, of rows
with one doc_id and different texts each is treated by itself; a text of one
blank line has no chunk; ties on the first place cannot occur between
different (doc_id, text, number); an empty table gives no rows; further
columns, whatever their names, are kept by ``dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meteora.llm.common import HOT, SPACE_CLASS, drop, join_spread, let, scratch, words

#: Characters from which a line counts as a passage by itself.
LONG = 200
#: Words of a passage that is removed from a longer text.
LEAST = 20
#: Lines under the rolling hash.
ROLL = 3
#: Mean lines of a chunk at the coarse levels.
MEANS = (4, 16)


def _code(at: Column, n) -> Column:
    """A chunk's place as one long: its first line and its lines."""
    return F.shiftleft(at.cast("long"), 32).bitwiseOR(n.cast("long") if isinstance(n, Column) else F.lit(n).cast("long"))


def _rolling(hashes: Column, roll: int) -> Column:
    """At every line the exclusive or of the last ``roll`` hashes, the hash
    ``k`` lines back turned by ``k`` bits."""
    def at(h: Column, i: Column) -> Column:
        out = h
        for k in range(1, roll):
            back = F.coalesce(F.get(hashes, i - k), F.lit(0).cast("long"))
            out = out.bitwiseXOR(F.shiftleft(back, k).bitwiseOR(F.shiftrightunsigned(back, 64 - k)))
        return out

    return F.transform(hashes, at)


def coarse(lines: Column, means: tuple = MEANS, roll: int = ROLL) -> Column:
    """(code, h) of the chunks between boundaries of the rolling hash."""
    def level(v: Column, mean: int) -> Column:
        last = F.size(v["roll"]) - 1
        ends = F.filter(F.transform(v["roll"], lambda r, i: F.when((i == last) | (F.pmod(r, F.lit(mean)) == 0), i)),
                        lambda i: i.isNotNull())
        cuts = F.concat(F.array(F.lit(-1)), ends)
        return let(F.struct(v["h"].alias("h"), cuts.alias("cuts")), lambda w: F.filter(F.transform(
            w["cuts"], lambda e, k: F.when((k > 0) & (e - F.get(w["cuts"], k - 1) > 2), F.struct(
                _code(F.get(w["cuts"], k - 1) + 1, e - F.get(w["cuts"], k - 1)).alias("code"),
                F.xxhash64(F.slice(w["h"], F.get(w["cuts"], k - 1) + 2, e - F.get(w["cuts"], k - 1))).alias("h")))),
            lambda c: c.isNotNull()))

    hashed = F.transform(lines, lambda x: F.xxhash64(x))
    rolled = let(hashed, lambda h: F.struct(h.alias("h"), _rolling(h, roll).alias("roll")))
    # a chunk of two levels is one
    return let(rolled, lambda v: F.array_distinct(F.concat(*[level(v, m) for m in means])))


def finest(lines: Column, long: int = LONG) -> Column:
    """(code, h) of the pairs of neighbouring lines and the long single ones."""
    def every(v: Column) -> Column:
        pairs = F.transform(v, lambda x, i: F.when(i + 1 < F.size(v), F.struct(
            _code(i, 2).alias("code"), F.xxhash64(x, F.get(v, i + 1)).alias("h"))))
        lone = F.transform(v, lambda x, i: F.when(
            (F.length(x) >= long) | ((F.size(v) == 1) & x.rlike(f"[^{SPACE_CLASS}]")),
            F.struct(_code(i, 1).alias("code"), F.xxhash64(x).alias("h"))))
        return F.filter(F.concat(pairs, lone), lambda c: c.isNotNull())

    return let(lines, every)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").where("text <> ''").select("doc_id", "text", F.xxhash64("text").alias("text_hash"))


def _repeated(docs: DataFrame, chunks) -> DataFrame:
    """(doc_id, text_hash, found array<code>): the chunks with a hash seen twice."""
    # outer: Spark puts a filter with the whole array expression before a plain explode
    each = (_texts(docs)
            .select("doc_id", "text_hash", F.explode_outer(chunks(F.split("text", "\n", -1))).alias("c"))
            .where("c IS NOT NULL").select("doc_id", "text_hash", "c.*"))
    often = scratch(each.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "often")
    # fewer than HOT hashes; rows that bear one need no partner and go anywhere
    total = often.agg(F.sum("n")).first()[0] or 0
    hot = F.col("h").isin([r.h for r in often.where(f"n * {HOT} > {total}").select("h").collect()])
    spread = each.withColumn("often_h", F.when(hot, F.xxhash64("doc_id", "text_hash", "code")).otherwise(F.col("h")))
    partner = often.select(F.col("h").alias("often_h"), F.lit(True).alias("twice"))
    # shuffled joins at every size: the plan must not change with the input
    found = scratch(spread.join(partner.hint("shuffle_hash"), "often_h", "left").where(F.col("twice") | hot)
                    .groupBy("doc_id", "text_hash").agg(F.collect_set("code").alias("found")), "found")
    drop(often)
    return found


def _later(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, gone array<code>): the chunks of ``found`` whose
    text has an earlier place."""
    hits = found.select(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"), "found")
    texts = _texts(docs)
    cut = texts.join(hits.hint("shuffle_hash"), texts["doc_id"].eqNullSafe(hits["found_id"])
                     & (texts["text_hash"] == hits["found_hash"]))
    chunks = let(F.struct(F.split("text", "\n", -1).alias("lines"), "found"), lambda v: F.transform(
        v["found"], lambda c: F.struct(c.alias("code"), F.array_join(F.slice(
            v["lines"], F.shiftright(c, 32).cast("int") + 1, c.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")), "\n")
            .alias("chunk"))))
    twice = scratch(cut.select("doc_id", "text_hash", F.explode_outer(chunks).alias("c"))
                    .select("doc_id", "text_hash", "c.*", F.sha2("c.chunk", 256).alias("digest")), "chunks")
    place = F.struct("doc_id", "text_hash", "code")
    # grouped by their bytes; the whole digest then stands for them
    first = scratch(twice.groupBy("digest", "chunk").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
                    .where("times > 1").select("digest", "first", "times"), "first")
    out = scratch(join_spread(twice.select("doc_id", "text_hash", "code", "digest"), first, "digest", "times")
                  .where(~place.eqNullSafe(F.col("first")))
                  .groupBy("doc_id", "text_hash").agg(F.collect_set("code").alias("gone")), "gone")
    drop(twice, first)
    return out


def _inside(codes: Column) -> Column:
    """Codes of the pairs and single lines inside chunks."""
    return F.flatten(F.transform(codes, lambda c: let(
        F.struct(F.shiftright(c, 32).alias("at"), c.bitwiseAND(F.lit(0xFFFFFFFF)).alias("n")), lambda v: F.concat(
            F.transform(F.sequence(v["at"], v["at"] + v["n"] - 2), lambda i: _code(i, 2)),
            F.transform(F.sequence(v["at"], v["at"] + v["n"] - 1), lambda i: _code(i, 1))))))


def removals(docs: DataFrame, long: int = LONG, means: tuple = MEANS) -> DataFrame:
    """(doc_id, text_hash, drop array<int>): the line numbers to remove, in order."""
    found = _repeated(docs, lambda v: coarse(v, means))
    large = _later(docs, found)
    drop(found)
    found = _repeated(docs, lambda v: finest(v, long))
    known = large.select(F.col("doc_id").alias("known_id"), F.col("text_hash").alias("known_hash"),
                         F.col("gone").alias("known"))
    left = scratch(found.join(known.hint("shuffle_hash"), found["doc_id"].eqNullSafe(known["known_id"])
                              & (found["text_hash"] == known["known_hash"]), "left")
                   .select("doc_id", "text_hash", F.when(F.col("known").isNull(), F.col("found")).otherwise(
                       F.array_except("found", _inside(F.col("known")))).alias("found"))
                   .where("size(found) > 0"), "left")
    drop(found)
    small = _later(docs, left)
    drop(left)
    out = scratch(large.unionByName(small).groupBy("doc_id", "text_hash")
                  .agg(F.array_sort(F.array_distinct(F.flatten(F.transform(
                      F.flatten(F.collect_list("gone")), lambda c: F.sequence(
                          F.shiftright(c, 32).cast("int"),
                          F.shiftright(c, 32).cast("int") + c.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int") - 1)))))
                       .alias("drop")), "removals")
    drop(large, small)
    return out


def _without(lines: Column, gone: Column) -> Column:
    """``lines`` without the numbers of ``gone`` (in order): the runs between them."""
    def runs(v: Column) -> Column:
        return F.flatten(F.transform(v["stops"], lambda e, k: F.slice(
            v["lines"], F.get(v["starts"], k) + 2, e - F.get(v["starts"], k) - 1)))

    return let(F.struct(lines.alias("lines"), F.concat(F.array(F.lit(-1)), gone).alias("starts"),
                        F.concat(gone, F.array(F.size(lines))).alias("stops")), runs)


def passages(lines: Column, marked: Column, least: int) -> Column:
    """The numbers of ``marked`` (in order) that lie in a passage of at least
    ``least`` words, or all if every line is marked."""
    def whole(v: Column) -> Column:
        g = v["marked"]
        first = F.filter(g, lambda x, k: (k == 0) | (x - F.get(g, k - 1) > 1))
        last = F.filter(g, lambda x, k: (k == F.size(g) - 1) | (F.get(g, k + 1) - x > 1))
        runs = F.filter(F.arrays_zip(first.alias("a"), last.alias("b")), lambda r: F.size(words(F.array_join(
            F.slice(v["lines"], r["a"] + 1, r["b"] - r["a"] + 1), "\n"))) >= least)
        return F.when(F.size(g) == F.size(v["lines"]), g).otherwise(
            F.flatten(F.transform(runs, lambda r: F.sequence(r["a"], r["b"]))))

    return let(F.struct(lines.alias("lines"), marked.alias("marked")), whole)


def judged(docs: DataFrame, long: int = LONG, least: int = LEAST) -> DataFrame:
    """``row`` (a row of ``docs``), the ``text`` left, and how many ``lines``
    the text had and how many are ``gone``."""
    marked = removals(docs, long).select(
        F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "drop")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", F.xxhash64("text").alias("hash"))
    # shuffled at every size, as above
    d = rows.join(marked.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(marked["gone_id"])
                  & (rows["hash"] == marked["gone_hash"]), "left")
    d = d.select("row", "text", "drop", F.split("text", "\n", -1).alias("cut"))
    d = d.withColumn("gone", F.when(F.col("drop").isNotNull(), passages(F.col("cut"), F.col("drop"), least)))
    some = F.coalesce(F.size("gone") > 0, F.lit(False))
    left = F.when(some, F.array_join(_without(F.col("cut"), F.col("gone")), "\n")).otherwise(F.col("text"))
    return d.select("row", left.alias("text"), F.when(F.col("text").isNotNull(), F.size("cut")).otherwise(0).alias("lines"),
                    F.when(some, F.size("gone")).otherwise(0).alias("gone"))


def dedup(docs: DataFrame, long: int = LONG, least: int = LEAST) -> DataFrame:
    """``docs`` with the repeated passages taken out of ``text``; a document
    goes only when that took every word it had."""
    d = judged(docs, long, least).where(f"gone = 0 OR text RLIKE '[^{SPACE_CLASS}]'")
    return d.select(*[(F.col("text") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    return judged(docs.select("doc_id", "text")).select(
        F.col("row")["doc_id"].alias("doc_id"), F.col("lines").cast("long").alias("n_lines"),
        F.col("gone").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
