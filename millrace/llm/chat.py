"""Chat formatting in Spark expressions: turns are collected and sorted, neighbours of one role are
merged to a block, and blocks are concatenated to one text with a loss mask.

The template, each block on lines of its own::

    <turn ROLE>
    first text
    <and>
    next text of the same role
    </turn>

A text that has one of the marks gets a backslash before it, so marks without one are the template's,
and reading back takes one away. Roles are written with ``%``, ``<``, ``>`` and line ends as %-codes.
The mask is a list of byte ranges of the formatted text, one for each text of the trained role: byte
ranges can be cut out in time of their own length. Everything is linear in the conversation but the running
sums of lengths, which go by blocks: a conversation of n turns costs n to the power 1.5 there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, BETWEEN, CLOSE = "<turn ", "\n<and>\n", "\n</turn>\n"
#: Beginnings of marks that a text must not have as they are.
MARKS = "(</?turn|<and>)"
CODES = (("%", "%25"), ("<", "%3C"), (">", "%3E"), ("\n", "%0A"), ("\r", "%0D"))
BLOCK = 512


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, MARKS, r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\" + MARKS, "$1")


def _coded(role: Column) -> Column:
    for plain, code in CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _decoded(role: Column) -> Column:
    for plain, code in reversed(CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda sofar, x: sofar + x)


def _before(lengths: Column) -> Column:
    """For each value the sum of those before it."""
    return F.slice(
        F.aggregate(lengths, F.array(F.lit(0).cast("bigint")), lambda sofar, x: F.concat(sofar, F.array(F.element_at(sofar, -1) + x))), F.lit(1), F.size(lengths)
    )


def running(lengths: Column) -> Column:
    """The same for long arrays: within blocks, and over the sums of blocks."""
    blocks = F.when(F.size(lengths) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))))
    starts = _before(F.transform(blocks, _total))
    return F.flatten(F.zip_with(blocks, starts, lambda block, start: F.transform(_before(block), lambda x: x + start)))


def format(turns: DataFrame, *, conversation: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant") -> DataFrame:
    """One row for each conversation: ``conversation``, n_turns, formatted and loss (start, length in
    UTF-8 bytes of each text of the ``trained`` role).

    Turns go by ``order``, nulls first; equal places go by role, then text; equal rows are turns of their own.
    A null text or role is an empty one, and rows without a conversation's id are one conversation.
    An empty table gives no rows; other columns play no part. A conversation becomes one row, and so
    meets in one task: it can't be split, as its text can't."""
    held = F.struct(
        F.col(order).alias("place"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    told = turns.select(F.col(conversation).alias("id"), held.alias("held")).groupBy("id").agg(F.sort_array(F.collect_list("held")).alias("turns"))

    # where the role changes, a block begins; where the next one's does, it ends
    def piece(turn, i):
        first = (i == 0) | (F.get("turns", i - 1).getField("role") != turn.role)
        last = (i == F.size("turns") - 1) | (F.get("turns", i + 1).getField("role") != turn.role)
        return F.struct(
            F.when(first, F.concat(F.lit(OPEN), _coded(turn.role), F.lit(">\n"))).otherwise(F.lit("")).alias("head"),
            escaped(turn.text).alias("body"),
            F.when(last, F.lit(CLOSE)).otherwise(F.lit(BETWEEN)).alias("tail"),
            (turn.role == trained).alias("learn"),
        )

    cut = told.select("id", F.transform("turns", piece).alias("pieces"))
    size = F.transform("pieces", lambda p: (F.octet_length(p["head"]) + F.octet_length(p["body"]) + F.octet_length(p["tail"])).cast("bigint"))
    laid = cut.withColumn("starts", running(size))
    spans = F.zip_with("pieces", "starts", lambda p, at: F.struct(
        p["learn"].alias("learn"), (at + F.octet_length(p["head"])).alias("start"), F.octet_length(p["body"]).cast("bigint").alias("length")))
    return laid.select(
        F.col("id").alias(conversation),
        F.size("pieces").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["learn"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias("loss"),
    )


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text as array<struct<role, text>>, read from it alone."""
    blocks = F.split(formatted, CLOSE, -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turns(block):
        head = F.substring_index(block, "\n", 1)
        role = _decoded(F.substring(head, F.lit(len(OPEN) + 1), F.length(head) - len(OPEN) - 1))
        bodies = F.split(F.substring(block, F.length(head) + 2, F.length(block)), BETWEEN, -1)
        return F.transform(bodies, lambda body: F.struct(role.alias("role"), unescaped(body).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def learnt(formatted: Column, loss: Column) -> Column:
    """The texts under the mask, unescaped, nothing between them."""
    data = formatted.cast("binary")
    cut = lambda s: F.substring(data, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")
    return F.array_join(F.transform(loss, lambda s: unescaped(cut(s))), "")


#: The template's marks: 8 code points and the role before a block, 7 between texts, 9 behind a block.
SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), beside AS (
  SELECT *, lag(role) OVER told AS previous, lead(role) OVER told AS following FROM turns WINDOW told AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(
    CASE WHEN previous IS DISTINCT FROM role THEN 8 + length(role) ELSE 0 END + length(text) + len(regexp_extract_all(text, '</?turn|<and>'))
    + CASE WHEN following IS DISTINCT FROM role THEN 9 ELSE 7 END
  )::BIGINT AS formatted_chars
FROM beside GROUP BY conv_id
"""
