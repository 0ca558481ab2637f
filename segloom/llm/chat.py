r"""Chat formatting with typed content parts.

A turn's content is a list of parts. Text parts become escaped text; image,
audio and document parts become a placeholder in their place, and the turn
records, in order, the attachment's kind, reference and expanded token count.

Template: `<|turn|>` role `<|text|>` content `<|end|>` for each turn, in order.
Control strings inside roles and texts get a backslash after their first
character (`<|` -> `<\|`, `[INST]` -> `[\INST]`; those that have backslashes
there already get one more), so that none can be met inside a text and
reading back takes exactly one backslash away.

Cases: null text is empty text; null role is an empty role; a null or unknown
part type counts as text; turns with equal numbers go by role and text,
null numbers first; repeated rows are turns of their own; null conv_id is a
conversation; an empty table gives no conversation but the added one. Other columns
are ignored.

A conversation is one output string, so its turns meet in one row; everything
else (flattening, escaping, counting) is done per turn before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import let, query, table, words

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
_PLAIN = r"([<\[])(\\*)(\||/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"
#: Placeholders of attachments; they are control strings too (`<|`).
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Expanded tokens: image patches of a square of pixels, audio frames a second, tokens a page.
PATCH, FRAMES, PAGE = 14, 25.0, 512

PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$2$3")


def text_part(text: Column) -> Column:
    """A content list with one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).cast("array<struct<type:string,text:string>>")


def visit(part: Column, typed: bool) -> Column:
    """What a part becomes: struct(shown, attachment, tokens)."""
    plain = F.coalesce(part["text"], F.lit(""))
    nothing = F.lit(None).cast("struct<kind:string,ref:string,tokens:long>")
    as_text = F.struct(escape(plain).alias("shown"), nothing.alias("attachment"), F.size(words(plain)).cast("long").alias("tokens"))
    if not typed:
        return as_text
    tokens = {
        "image": F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH),
        "audio": F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * FRAMES),
        "document": F.coalesce(part["pages"], F.lit(0)) * PAGE,
    }
    out = as_text
    for kind, count in tokens.items():
        count = count.cast("long")
        attachment = F.struct(F.lit(kind).alias("kind"), part["ref"].alias("ref"), count.alias("tokens"))
        seen = F.struct(F.lit(PLACEHOLDER[kind]).alias("shown"), attachment.alias("attachment"), count.alias("tokens"))
        out = F.when(part["type"] == kind, seen).otherwise(out)
    return out


def format_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "content") -> DataFrame:
    """One row per conversation: conv_id, formatted, attachments (in order), tokens (expanded).

    `content` is a list of parts (see PARTS; a list of struct(type, text) will do).
    """
    fields = df.schema[content].dataType.elementType.names
    flat = F.transform(F.coalesce(F.col(content), F.array().cast(df.schema[content].dataType)), lambda p: visit(p, "ref" in fields))
    each = df.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("_role"),
        flat.alias("_parts"),
    ).select(
        "conv_id",
        F.struct(
            "_turn",
            "_role",
            F.array_join(F.transform("_parts", lambda p: p["shown"]), "").alias("shown"),
            F.filter(F.transform("_parts", lambda p: p["attachment"]), lambda a: a.isNotNull()).alias("attachments"),
            F.aggregate(F.transform("_parts", lambda p: p["tokens"]), F.lit(0).cast("long"), lambda a, x: a + x).alias("tokens"),
        ).alias("_t"),
    )
    joined = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("_t")).alias("_ts"))
    line = lambda t: F.concat(F.lit(TURN), escape(t["_role"]), F.lit(TEXT), t["shown"], F.lit(END))
    return joined.select(
        "conv_id",
        F.array_join(F.transform("_ts", line), "").alias("formatted"),
        F.flatten(F.transform("_ts", lambda t: t["attachments"])).alias("attachments"),
        F.aggregate("_ts", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct(role, text), unescaped."""

    def turn(piece: Column) -> Column:
        return let(
            F.split(piece, r"<\|text\|>", 2),
            lambda x: F.struct(unescape(F.substring(x[0], len(TURN) + 1, 2**31 - 1)).alias("role"), unescape(x[1]).alias("text")),
        )

    pieces = F.split(formatted, r"<\|end\|>", -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(regexp_replace(role || '<|text|>', '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')) - 1
    + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')) + 15)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


@query("op6_chat_formatting", _SQL)
def op6_chat_formatting(spark, sf_dir):
    """Digest of every formatted conversation, read back from the formatted text."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    turns = turns.unionByName(spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string"))
    done = format_turns(turns.withColumn("content", text_part(F.col("text"))))
    back = done.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("_turns"))
    every = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform(F.filter("_turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    back = back.select("conv_id", F.size("_turns").cast("long").alias("n_turns"), every.alias("_every"), learnt.alias("_loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return back.select(
        "conv_id",
        "n_turns",
        F.sha2("_every", 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
