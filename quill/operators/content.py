"""Conversations whose content is a string or a list of typed parts, in any turn.

``read_parts_jsonl`` reads the two shapes as VARIANT and gives one form: a row per turn
with ``parts`` (type, text) and ``is_simple`` (the content was a string). ``render_parts``
turns that form into the segments of a rendering in one scan and one shuffle, whose groups hold
two rows at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quill.functions.text import strip_ws
from quill.session import written

PARTS = "array<struct<type:string,text:string>>"


def as_parts(content: Column) -> Column:
    """A VARIANT string or list of parts as ``PARTS``; anything else is null."""
    text = F.try_variant_get(content, "$", "string")
    simple = F.schema_of_variant(content) == "STRING"
    return F.when(simple, F.array(F.struct(F.lit("text").alias("type"), text.alias("text")))).when(
        F.schema_of_variant(content).startswith("ARRAY"), F.try_variant_get(content, "$", PARTS))


def read_parts_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A5 with either content: ``(conv, turn, role, parts, is_simple)`` of a JSON array of
    messages per line; blank lines are skipped. ``conv`` numbers the lines."""
    lines = spark.read.text(path).select(strip_ws("value").alias("value")).where(F.col("value") != "")
    base = written(lines.withColumn("conv", F.monotonically_increasing_id()), "lines")()
    messages = F.from_json(F.col("value"), "array<struct<role:string,content:variant>>")
    turns = base.select("conv", F.posexplode(messages).alias("turn", "m"))
    return turns.select("conv", "turn", F.col("m.role").alias("role"), as_parts(F.col("m.content")).alias("parts"),
                        (F.schema_of_variant(F.col("m.content")) == "STRING").alias("is_simple"))


def parts_of_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Turns with string content in the common form."""
    one = F.array(F.struct(F.lit("text").alias("type"), F.col(text).alias("text")))
    return df.withColumn("parts", one).withColumn("is_simple", F.lit(True)).drop(text)


def _segment(kind: str, value: Column, mask: int) -> Column:
    return F.struct(F.lit(kind).alias("kind"), value.alias("value"), F.lit(mask).alias("mask"))


def _special(name: str, mask: int) -> Column:
    return _segment("special", F.lit(f"<|{name}|>"), mask)


def render_parts(turns: DataFrame, key: str = "conv", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """C5 for parts in any turn: ``(key, seg_no, kind, value, mask)``, ``seg_no`` ascending.

    Turns count from 0. A system message in turn 0 is put before the text of turn 1, which must
    be a user's. A user's parts are joined; of an assistant's, text and tool calls (with their marks)
    and the end are supervised, tool output is not. Other roles, other part
    types and missing content are errors: they must not become supervised text.
    """
    def bad(what, value):
        return F.raise_error(F.concat(F.lit(f"cannot render {what} "), F.coalesce(value, F.lit("NULL"))))
    # turn 1 only looks back at turn 0: groups of two rows, whatever the conversation
    two = Window.partitionBy(key, F.floor(F.col(turn) / 2)).orderBy(turn)
    text = F.when(F.col(parts).isNotNull(), F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), ""))
    d = turns.select(key, turn, role, parts, text.alias("__text"))
    d = d.withColumn("__sys", F.when((F.lag(role).over(two) == "system") & (F.col(turn) == 1), F.lag("__text").over(two)))
    d = d.where(~((F.col(turn) == 0) & (F.coalesce(F.col(role), F.lit("")) == "system")))
    whole = F.coalesce(F.col("__text"), bad("content of turn", F.col(turn).cast("string")))
    merged = F.when(F.col("__sys").isNull(), whole).when(F.col(role) == "user", F.concat(F.col("__sys"), F.lit("\n\n"), whole)).otherwise(bad("a system message before", F.col(role)))

    def part(p):
        def called(name, mask):
            return F.array(_special(f"{name}_start", mask), _segment("text", p["text"], mask), _special(f"{name}_end", mask))
        return (F.when(p["type"] == "text", F.array(_segment("text", p["text"], 1))).when(p["type"] == "python", called("python", 1))
                .when(p["type"] == "python_output", called("output", 0)).otherwise(F.array(_segment("text", bad("part", p["type"]), 0))))
    user = F.array(_special("user_start", 0), _segment("text", merged, 0), _special("user_end", 0))
    own = F.coalesce(F.col(parts), F.array(F.struct(F.lit(None).cast("string").alias("type"), F.lit("").alias("text"))))
    assistant = F.concat(F.array(_special("assistant_start", 0)), F.flatten(F.transform(own, part)), F.array(_special("assistant_end", 1)))
    body = F.when(F.col(role) == "user", user).when((F.col(role) == "assistant") & F.col("__sys").isNull(), assistant).otherwise(
        F.array(_segment("text", F.when(F.col("__sys").isNotNull(), merged).otherwise(bad("role", F.col(role))), 0)))
    leads = (F.col(turn) == 0) | F.col("__sys").isNotNull()
    segments = F.when(leads, F.concat(F.array(_special("bos", 0)), body)).otherwise(body)
    x = d.select(key, turn, F.posexplode(segments).alias("k", "s"))
    return x.select(key, (F.col(turn).cast("bigint") * (1 << 32) + F.col("k")).alias("seg_no"), "s.kind", "s.value", "s.mask")


def completion_prompt(turns: DataFrame, key: str = "conv", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """C6 for parts in any turn: the rendering without the last message, which must be an
    assistant's (other conversations are left out), and the assistant's start mark after it."""
    last = (turns.groupBy(key).agg(F.max(turn).alias("__last"), F.max_by(role, turn).alias("__role"))
            .where((F.col("__role") == "assistant") & (F.col("__last") > 0)).drop("__role"))
    # one row a conversation: a long conversation's turns may be split on their side
    body = render_parts(turns.join(last, key).where(F.col(turn) != F.col("__last")), key, turn, role, parts)
    start = _special("assistant_start", 0)
    tail = last.select(key, (F.col("__last").cast("bigint") * (1 << 32)).alias("seg_no"), start.alias("s")).select(key, "seg_no", "s.kind", "s.value", "s.mask")
    return body.unionByName(tail)
