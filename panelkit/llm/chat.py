"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context, and only that reply is trainable. A conversation whose last turns are
not an assistant's (or that has no assistant) gets one more example without a
trainable part, so no turn is lost.

A turn is written ``<turn>role\\ntext</turn>\\n``. Inside roles and texts
``\\`` becomes ``\\b``, ``<`` becomes ``\\l`` and ``#`` becomes ``\\h`` (in roles
also a line break ``\\e``), so no control string can occur in them; the escape
is undone exactly by reading ``\\l``, ``\\h``, ``\\e`` and then ``\\b`` back. The loss mask is a span of code points
[loss_start, loss_end) of the formatted example.

Inputs: turns are ordered by (turn, role, text), nulls first; a null role or
text is empty; rows that repeat are turns of their own; a null conv_id is a
conversation of its own. Extra columns are ignored. An empty table gives an
empty result.

Scale: one shuffle of the turns by conversation. The examples are made after
it, row by row, and are never shuffled; their text grows with the square of a
conversation's length, which is what the expansion asks for. An example holds
its conversation so far, so a conversation has to fit a row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.tables import read

OPEN, CLOSE = "<turn>", "</turn>\n"
ASSISTANT = "assistant"


def escape(c: Column) -> Column:
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(c, F.lit("<"), F.lit("\\l")), F.lit("#"), F.lit("\\h"))


def unescape(c: Column) -> Column:
    c = F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\h"), F.lit("#"))
    return F.replace(F.replace(c, F.lit("\\e"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def expand(turns: DataFrame) -> DataFrame:
    """(conv_id, example, last, formatted, loss_start, loss_end), an example per row."""
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\e"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    part = F.struct("turn", "role", "text", F.concat(head, escape(F.col("text")), F.lit(CLOSE)).alias("seg"),
                    F.length(head).alias("head"))
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("t"))
    n = F.size("t")
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: (
        F.element_at("t", i)["role"].eqNullSafe(F.lit(ASSISTANT))) | (i == n))
    convs = convs.select("conv_id", "t", F.posexplode(ends).alias("example", "upto"))
    own = F.element_at("t", F.col("upto"))
    text = F.array_join(F.transform(F.slice("t", F.lit(1), F.col("upto")), lambda x: x["seg"]), "")
    out = convs.select("conv_id", "example", (F.col("upto") == n).alias("last"), text.alias("formatted"),
                       own["role"].eqNullSafe(F.lit(ASSISTANT)).alias("_train"), own["head"].alias("_head"),
                       F.length(own["seg"]).alias("_seg"))
    size = F.length("formatted")
    start = F.when(F.col("_train"), size - F.col("_seg") + F.col("_head")).otherwise(size)
    end = F.when(F.col("_train"), size - len(CLOSE)).otherwise(size)
    return out.select("conv_id", "example", "last", "formatted", start.alias("loss_start"), end.alias("loss_end"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example: an array of (role, text)."""
    parts = F.filter(F.split(formatted, CLOSE), lambda x: x != "")

    def turn(x: Column) -> Column:
        body = F.substr(x, F.lit(len(OPEN) + 1))
        cut = F.instr(body, "\n")
        return F.struct(unescape(F.substr(body, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substr(body, cut + 1)).alias("text"))

    return F.transform(parts, turn)


def masked(example: DataFrame) -> Column:
    """What is under the loss mask, unescaped."""
    return unescape(F.substr("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))


def op4_chat(spark, sf_dir: str) -> DataFrame:
    """All conversations and the planted one, formatted and read back."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
                                    F.lit(hard).alias("text"))
    made = expand(turns.unionByName(planted))
    said = F.when(F.col("last"), read_turns(F.col("formatted")))
    back = made.select("conv_id", "example", F.length("formatted").cast("long").alias("chars"),
                       masked(made).alias("reply"), said.alias("turns"))
    digest = F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(
        x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256)
    rows = back.select("conv_id", "chars", F.struct("example", "reply").alias("reply"),
                       F.size("turns").cast("long").alias("n"), F.when(F.col("turns").isNotNull(), digest).alias("sha"))
    out = rows.groupBy("conv_id").agg(F.max("n").alias("n_turns"), F.max("sha").alias("turns_sha256"),
                                      F.sort_array(F.collect_list("reply")).alias("replies"),
                                      F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_examples"))
    whole = F.array_join(F.transform("replies", lambda x: x["reply"]), "")
    out = out.withColumn("loss", whole)
    return out.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_examples")


OP4_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, text AS raw FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok', '\### Assistant: </turn> ok'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, raw NULLS FIRST) AS k,
        {len(OPEN) + 1 + len(CLOSE)}
          + 2 * length(text) - length(replace(replace(replace(text, chr(92), ''), '<', ''), '#', ''))
          + 2 * length(coalesce(role, '')) - length(replace(replace(replace(coalesce(role, ''), chr(92), ''), '<', ''), '#', '')) AS chars
      FROM t),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto,
             max(k) OVER (PARTITION BY conv_id) AS n FROM o)
SELECT conv_id, CAST(max(n) AS BIGINT) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars,
  CAST(count(*) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS n_examples
FROM p GROUP BY conv_id
"""
