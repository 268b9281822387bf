"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context and it alone is trainable. An example is one string of marked turns and
a span of code points (loss_start, loss_end) that covers the reply's text, not
its marks. A conversation that does not end in an assistant turn gives one more
example with an empty span, so that the output holds every turn.

A turn is written as ``### Name: text</turn>`` and a newline. Inside texts a
backslash is doubled, and one is put into every ``</turn>`` and ``###``, so
neither mark can occur in a text; dropping the backslash of each pair restores
the text. Roles other than the three named ones are written in hexadecimal.

A conversation is one group: its longest example is a row of the same size, by
the method. No other grouping is made, and examples are built row by row.

Defined cases: null text, and null role, count as empty; turns are ordered by
(turn, role, text), nulls first, and repeated rows are turns of their own; rows
without a conversation id form one conversation; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm.common import Workspace

NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
TRAINABLE = "assistant"
HEAD, AFTER_NAME, END = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    """``text`` without the template's marks."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    ends = F.replace(doubled, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.regexp_replace(ends, "#(?=##)", "#\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _name(role: Column) -> Column:
    name = F.concat(F.lit("="), F.hex(F.encode(role, "UTF-8")))
    for known, shown in NAMES.items():
        name = F.when(role == known, shown).otherwise(name)
    return name


def _role(name: Column) -> Column:
    role = F.decode(F.unhex(F.substr(name, F.lit(2))), "UTF-8")
    for known, shown in NAMES.items():
        role = F.when(name == shown, known).otherwise(role)
    return role


def format_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, target, text, loss_start, loss_end, complete): the examples.
    target counts an example's turns; complete marks a conversation's longest."""
    raw = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                       F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("said"))
    head = F.concat(F.lit(HEAD), _name(F.col("role")), F.lit(AFTER_NAME))
    marked = raw.select(
        "conv_id", F.struct("turn", "role", "said", head.alias("head"),
                            escape(F.col("said")).alias("body")).alias("t"))
    talks = marked.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    pieces = F.transform("t", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    talks = talks.select("conv_id", "t", pieces.alias("piece"), F.size("t").alias("n"))
    one = talks.select("conv_id", "t", "piece", "n",
                       F.explode(F.sequence(F.lit(1), F.col("n"))).alias("target"))
    last = F.col("target") == F.col("n")
    chosen = F.element_at("t", F.col("target"))
    reply = chosen["role"] == TRAINABLE
    one = one.where(reply | last).select(
        "conv_id", "target", last.alias("complete"), reply.alias("reply"),
        F.char_length(chosen["body"]).alias("size"),
        F.array_join(F.slice("piece", F.lit(1), F.col("target")), "").alias("text"))
    end = F.char_length("text") - F.when(F.col("reply"), len(END)).otherwise(0)
    start = end - F.when(F.col("reply"), F.col("size")).otherwise(0)
    return one.select("conv_id", "target", "text", start.cast("long").alias("loss_start"),
                      end.cast("long").alias("loss_end"), "complete")


def parse_turns(text: Column) -> Column:
    """The turns, as an array of (role, text), of an example's string."""
    marked = F.split(text, END)
    whole = F.slice(marked, F.lit(1), F.size(marked) - 1)

    def turn(piece: Column) -> Column:
        name = F.regexp_extract(piece, f"^{HEAD}([^:]*){AFTER_NAME}", 1)
        after = F.char_length(name) + len(HEAD) + len(AFTER_NAME) + 1
        return F.struct(_role(name).alias("role"),
                        unescape(F.substr(piece, after)).alias("text"))

    return F.transform(whole, turn)


def trained_text(text: Column, start: Column, end: Column) -> Column:
    """The unescaped text under an example's loss span."""
    return unescape(F.substr(text, (start + 1).cast("int"), (end - start).cast("int")))


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, from its examples alone: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars and n_examples."""
    said = F.transform(parse_turns(F.col("text")),
                       lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    full = F.when(F.col("complete"), F.struct(
        F.size(said).cast("long").alias("n"),
        F.sha2(F.encode(F.array_join(said, ""), "UTF-8"), 256).alias("sha")))
    rows = examples.select(
        "conv_id", F.col("target"), full.alias("turns"),
        trained_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss"),
        F.char_length("text").cast("long").alias("chars"))
    found = rows.groupBy("conv_id").agg(
        F.max("turns").alias("turns"), F.sum("chars").alias("formatted_chars"),
        F.count("*").alias("n_examples"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("target", "loss"))),
                                 lambda x: x["loss"]), "").alias("loss"))
    return found.select(
        "conv_id", F.col("turns.n").alias("n_turns"), F.col("turns.sha").alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"), "formatted_chars")


# A conversation that is made of the template's own marks.
MARKS_ID, MARKS_TEXT = -7, "\\### Assistant: </turn> ok"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: all conversations and one made of marks, written and read back."""
    work = Workspace(spark, "chat")
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")
    marks = spark.createDataFrame([(MARKS_ID, 0, "user", MARKS_TEXT),
                                   (MARKS_ID, 1, "assistant", MARKS_TEXT)], turns.schema)
    return digests(work.keep(format_examples(turns.unionByName(marks)), "examples"))


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
p AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(4 + CASE role WHEN 'user' THEN 4 WHEN 'system' THEN 6 WHEN 'assistant' THEN 9
              ELSE 1 + 2 * strlen(role) END + 2 + length(text) + 8
        + length(text) - length(replace(text, '\', ''))
        + (length(text) - length(replace(text, '</turn>', ''))) // 7
        + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{3,}'),
                                           lambda x: length(x) - 2)), 0)) OVER w AS upto
  FROM c
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS turns,
    coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS loss,
    sum(upto) FILTER (role = 'assistant' OR i = n) AS chars
  FROM p GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256,
  CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(chars AS BIGINT) AS formatted_chars
FROM g
"""
