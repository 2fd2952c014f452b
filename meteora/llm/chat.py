"""Chat formatting with Spark expressions only.

The rows of a conversation are collected as structs, sorted by (turn, role,
text), cut into blocks of adjacent turns of one role by array functions, and
joined to one text:

    ### user: first text<turn>second text</turn>
    ### assistant: answer</turn>

``</turn>`` and a line end close a block, ``<turn>`` parts the turns merged
into it. Texts and roles are escaped so that no control string can occur in
them: backslash, ``<`` and ``#`` become ``\\b``, ``\\l`` and ``\\h`` (in a role
also ``:`` becomes ``\\c``); every backslash in the output starts an escape,
so replacing the escapes back, the backslash's last, restores the text.

``loss_spans`` are the code-point ranges of the assistant texts in the
formatted text, without headers, separators and ends.

Cases: null text and null role are empty strings; a null turn sorts first,
rows with equal turn by role and text, repeated rows are turns of their own;
a null conv_id is one conversation; an empty table gives no rows; columns
other than conv_id, turn, role and text are not read. A conversation is one
output value, so its rows meet in one task; the rows of different
conversations never do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template.
HEAD, SEP, TURN, END = "### ", ": ", "<turn>", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = ESCAPES + ((":", "\\c"),)


def _swap(x: Column, old: str, new: str) -> Column:
    return F.replace(x, F.lit(old), F.lit(new))


def escape(x: Column, pairs=ESCAPES) -> Column:
    for old, new in pairs:
        x = _swap(x, old, new)
    return x


def unescape(x: Column, pairs=ESCAPES) -> Column:
    for old, new in reversed(pairs):
        x = _swap(x, new, old)
    return x


def format_chat(rows: DataFrame) -> DataFrame:
    """conv_id, formatted string, loss_spans array<struct<start, length>>."""
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    n = F.size("turns")
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (
        F.get(F.col("turns"), i)["role"] != F.get(F.col("turns"), i - 1)["role"]))
    talks = talks.withColumn("starts", starts)
    stop = F.concat(F.slice("starts", 2, F.size("starts")), F.array(n))
    blocks = F.transform(F.arrays_zip(F.col("starts").alias("at"), stop.alias("stop")), lambda b: F.struct(
        F.get(F.col("turns"), b["at"])["role"].alias("role"),
        F.transform(F.slice(F.col("turns"), b["at"] + 1, b["stop"] - b["at"]),
                    lambda t: escape(t["text"])).alias("bodies")))
    talks = talks.select("conv_id", blocks.alias("blocks"))
    # pieces in order: what stands before a body, the body, whether it counts
    pieces = F.flatten(F.transform("blocks", lambda b: F.transform(b["bodies"], lambda body, i: F.struct(
        F.when(i == 0, F.concat(F.lit(HEAD), escape(b["role"], ROLE_ESCAPES), F.lit(SEP))).otherwise(F.lit(TURN))
        .alias("before"),
        body.alias("body"),
        F.when(i == F.size(b["bodies"]) - 1, F.lit(END)).otherwise(F.lit("")).alias("after"),
        (b["role"] == "assistant").alias("loss")))))
    talks = talks.select("conv_id", pieces.alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["body"], p["after"])), "")
    empty = F.expr("struct(0 AS pos, CAST(array() AS array<struct<start:int,length:int,loss:boolean>>) AS spans)")
    walked = F.aggregate("pieces", empty, lambda acc, p: F.struct(
        (acc["pos"] + F.length(p["before"]) + F.length(p["body"]) + F.length(p["after"])).alias("pos"),
        F.concat(acc["spans"], F.array(F.struct(
            (acc["pos"] + F.length(p["before"])).alias("start"), F.length(p["body"]).alias("length"),
            p["loss"].alias("loss")))).alias("spans")))
    spans = F.transform(F.filter(walked["spans"], lambda s: s["loss"]),
                        lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    return talks.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns array<struct<role, text>>, loss string (all text under
    the mask, unescaped), taken from the formatted text alone."""
    blocks = F.slice(F.split("formatted", END, -1), 1, F.size(F.split("formatted", END, -1)) - 1)

    def turns(b: Column) -> Column:
        role = F.substring_index(b, SEP, 1)
        body = F.substr(b, F.length(role) + F.lit(len(SEP) + 1))
        name = unescape(F.substr(role, F.lit(len(HEAD) + 1)), ROLE_ESCAPES)
        return F.transform(F.split(body, TURN, -1), lambda t: F.struct(
            name.alias("role"), unescape(t).alias("text")))

    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substr(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    return formatted.select("conv_id", "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"),
                            loss.alias("loss"))


def digest(formatted: DataFrame) -> DataFrame:
    back = read_back(formatted)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: Conversation -7 of the contract.
PROBE = r"\### Assistant: </turn> ok"


def with_probe(rows: DataFrame) -> DataFrame:
    extra = rows.sparkSession.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return rows.select("conv_id", "turn", "role", "text").union(extra)


ORACLE = r"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
placed AS (
  SELECT *, lag(role) OVER o AS prev, lead(role) OVER o AS next FROM every
  WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sized AS (
  SELECT *, length(replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h'))
    + CASE WHEN prev IS NULL OR prev <> role
           THEN 6 + length(replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '#', '\h'), ':', '\c'))
           ELSE 6 END
    + CASE WHEN next IS NULL OR next <> role THEN 8 ELSE 0 END AS chars
  FROM placed)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
