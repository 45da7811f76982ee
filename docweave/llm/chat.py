"""Chat formatting with typed content parts, in SQL expressions only.

A turn's content is an array of parts (type, text, ref, n_tokens). A visitor
walks the parts in order: text is escaped, an image, audio or document part
becomes a placeholder such as <image:3>, numbered from 1 through the whole
conversation; under that number its reference and the tokens that the
placeholder expands to are recorded.

The rendered form of a conversation is

    <|role>content<!>

for every turn, joined by nothing. Inside contents a backslash is written
``\\b`` and ``<`` is written ``\\l``, so ``<`` occurs only in marks and every
text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import table, text_or_empty

PARTS = "array<struct<type:string,text:string,ref:string,n_tokens:int>>"
#: Attached types, and the tokens that one expands to where the part doesn't say.
ATTACHMENTS = {"image": 256, "audio": 128, "document": 512}
OPEN, CLOSE, END = "<|", "<!>", ">"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Undoes escape(). In an escaped text each backslash is followed by b or l, so the order of the two steps is free of clashes."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """Roles also hide '>', which ends the role's mark."""
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\g"), F.lit(">")), F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A text as an array of one part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("n_tokens"))).cast(PARTS)


def visit(part: Column) -> Column:
    """What a part looks like in the rendered text, its number still left out. Unknown types count as text; a null text is empty."""
    out = escape(F.coalesce(part["text"], F.lit("")))
    for kind in ATTACHMENTS:
        out = F.when(part["type"] == kind, F.lit(f"<{kind}:{END}")).otherwise(out)
    return out


def number(rendered: Column) -> Column:
    """A rendered text with its placeholders numbered from 1. Contents are escaped, so nothing else looks like one."""
    pieces = F.split(rendered, f"(?<=<(?:{'|'.join(ATTACHMENTS)}):)(?={END})")
    return F.array_join(F.transform(pieces, lambda s, i: F.when(i > 0, F.concat(i.cast("string"), s)).otherwise(s)), "")


def render_turn(role: Column, parts: Column) -> Column:
    """<|role>content<!>; null roles and null parts are empty."""
    content = F.array_join(F.transform(F.coalesce(parts, F.array().cast(PARTS)), visit), "")
    return F.concat(F.lit(OPEN), escape_role(F.coalesce(role, F.lit(""))), F.lit(END), content, F.lit(CLOSE))


def attachments(parts: Column) -> Column:
    """(type, ref, n_tokens) of the attached parts, in order."""
    kept = F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: F.coalesce(p["type"].isin(*ATTACHMENTS), F.lit(False)))
    usual = F.create_map(*[F.lit(x) for item in ATTACHMENTS.items() for x in item])
    return F.transform(kept, lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), F.coalesce(p["n_tokens"], usual[p["type"]]).alias("n_tokens")))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, attachments (number, type, ref, n_tokens), n_attachment_tokens.

    Turns stand in the order of (turn, role, text of the parts, rendered
    text); null turns come first, null roles count as empty, repeated turns
    all stay. The rows whose conversation is null are one conversation.
    Further columns of the input are ignored. An empty table gives an empty
    one. A conversation is one text, so its turns meet in one row; nothing
    else is gathered.
    """
    some = F.coalesce(F.col(parts), F.array().cast(PARTS))
    one = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.array_join(F.transform(some, lambda p: F.coalesce(p["text"], F.lit(""))), "").alias("raw"),
            render_turn(F.col(role), F.col(parts)).alias("text"),
            attachments(F.col(parts)).alias("attached"),
        ).alias("t"),
    )
    grouped = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    attached = F.transform(F.flatten(F.col("ts.attached")), lambda x, i: F.struct((i + 1).alias("number"), x["type"].alias("type"), x["ref"].alias("ref"), x["n_tokens"].alias("n_tokens")))
    return grouped.select(
        "conv_id",
        F.size("ts").cast("long").alias("n_turns"),
        number(F.array_join(F.col("ts.text"), "")).alias("formatted"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda a, x: a + x["n_tokens"]).alias("n_attachment_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a rendered conversation as array<struct<role, text>>, text still escaped."""
    pieces = F.filter(F.split(formatted, "<!>"), lambda s: s != "")
    return F.transform(
        pieces,
        lambda s: F.struct(
            unescape_role(F.substring_index(F.substr(s, F.lit(len(OPEN) + 1)), END, 1)).alias("role"),
            F.substr(s, F.instr(s, END) + 1).alias("text"),
        ),
    )


def loss_runs(formatted: Column, speaker: str = "assistant") -> Column:
    """The loss mask of a rendered text as runs: array<struct<on, text>> that together are the text; on for the speaker's contents, one run each."""
    head = f"{OPEN}{speaker}{END}"
    run = lambda on, text: F.struct(F.lit(on).alias("on"), text.alias("text"))
    pieces = F.filter(F.split(formatted, CLOSE), lambda s: s != "")
    mine = lambda s: F.array(run(False, F.lit(head)), run(True, F.substr(s, F.lit(len(head) + 1))), run(False, F.lit(CLOSE)))
    return F.flatten(F.transform(pieces, lambda s: F.when(s.startswith(head), mine(s)).otherwise(F.array(run(False, F.concat(s, F.lit(CLOSE)))))))


CANARY = (-7, "\\### Assistant: </turn> ok")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, rendered and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(CANARY[0]).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CANARY[1]).alias("text"),
    )
    turns = rows.unionByName(extra).withColumn("parts", text_part(text_or_empty("text")))
    done = format_conversations(turns)
    back = done.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), loss_runs(F.col("formatted")).alias("runs"))
    learnt = F.array_join(F.transform(F.filter("runs", lambda x: x["on"]), lambda x: unescape(x["text"])), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), unescape(t["text"]), F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, 2 + length(replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g')) + 1
            + length(replace(replace(text, '\', '\b'), '<', '\l')) + 3 AS n
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
