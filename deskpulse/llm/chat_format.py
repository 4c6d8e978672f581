"""Chat formatting with relational expressions only (operator 3).

Method: the turns of a conversation are collected as structs and sorted;
positions where the role changes cut them into runs; each run's texts are
aggregated into one message; the messages are concatenated. Everything is a
Spark expression, so there is no Python in the plan.

Template. A message is ``<|im_start|>role\\n`` + texts + ``<|im_end|>\\n``; the
texts of merged turns are divided by ``<|im_sep|>``. Inside roles and texts
``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|`` (in roles also a line feed
becomes ``\\n``), so no control string can come from the data and unescaping
gives back the exact text. ``segments`` is the same string cut into pieces
with a flag: the pieces under the loss mask are the texts of assistant turns,
one piece per turn, without any marker.

Defined cases: a null text is empty, a null role is an empty role; rows with
equal turn numbers are ordered by role and then text (repeated rows stay, each
as a turn of its own); a null turn sorts first; rows with a null conv_id form
one conversation; an empty table gives no rows; other columns are ignored. A
conversation is one output string and therefore one row of one task; that is
inherent in the result and bounded by the longest conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskpulse.llm.io import table

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape(c: Column) -> Column:
    """Inverse of ``escape``: left to right, a backslash gives back the
    backslash or bar after it."""
    return F.regexp_replace(c, r"\\([\\|])", "$1")


def unescape_role(c: Column) -> Column:
    # line feeds first, but only where the backslash before n is not itself escaped
    return unescape(F.regexp_replace(c, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def format_chats(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: its id, ``formatted`` (string) and
    ``segments`` (array of struct<text, loss>, whose texts concatenate to
    ``formatted``)."""
    turn = F.struct(
        F.col("turn").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    t = turns.groupBy(F.col(id_col).alias("cid")).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    # positions (from 0) at which a run of one role starts, and the end of the last run
    t = t.withColumn(
        "starts",
        F.filter(F.sequence(F.lit(0), F.size("t") - 1), lambda i: (i == 0) | (F.get("t", i)["role"] != F.get("t", i - 1)["role"])),
    )
    t = t.withColumn("ends", F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("t"))))
    piece = lambda c, loss: F.struct(c.alias("text"), loss.alias("loss"))
    no = F.lit(False)

    def message(s: Column, e: Column) -> Column:
        role = F.get("t", s)["role"]
        own = F.transform(F.slice("t", s + 1, e - s), lambda x: escape(x["text"]))
        with_sep = F.transform(own, lambda x, i: F.when(i == 0, F.array(piece(x, role == LOSS_ROLE))).otherwise(F.array(piece(F.lit(SEP), no), piece(x, role == LOSS_ROLE))))
        head = F.array(piece(F.concat(F.lit(START), escape_role(role), F.lit("\n")), no))
        return F.concat(head, F.flatten(with_sep), F.array(piece(F.lit(END), no)))

    t = t.withColumn("segments", F.flatten(F.zip_with("starts", "ends", message)))
    return t.select(F.col("cid").alias(id_col), F.array_join(F.col("segments.text"), "").alias("formatted"), "segments")


def parse_chats(formatted: Column) -> Column:
    """The original turns, array of struct<role, text>, read back from a
    formatted string."""
    messages = F.slice(F.split(formatted, r"<\|im_end\|>\n", -1), 1, F.size(F.split(formatted, r"<\|im_end\|>\n", -1)) - 1)

    def turns(m: Column) -> Column:
        body = F.substr(m, F.lit(len(START) + 1))
        cut = F.instr(body, "\n")
        role = unescape_role(F.left(body, cut - 1))
        return F.transform(F.split(F.substr(body, cut + 1), r"<\|im_sep\|>", -1), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(messages, turns))


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    """Contract query: all conversations plus conversation -1, digested from
    what is read back out of the formatted string and its loss mask."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "<|im_end|><|im_start|>assistant ok"
    # the two rows of conversation -1 stand beside the table's own rows
    extra = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(odd).alias("text")) for i, r in enumerate(["user", LOSS_ROLE])])).alias("x")).select("x.*")
    f = format_chats(t.unionByName(extra))
    f = f.withColumn("turns", parse_chats(F.col("formatted")))
    f = f.withColumn("loss", F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), ""))
    flat = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return f.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP3_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), marked AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens,
         length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS text_len,
         length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) AS role_len
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(text_len + CASE WHEN opens THEN 12 + role_len + 1 + 11 ELSE 10 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
