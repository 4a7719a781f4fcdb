"""Prompt rendering, tool-call parsing and program assembly."""

from __future__ import annotations

import ast
import operator
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.functions.text import MC_FOOTER, MC_HEADER, extract_program, strip_ws
from quill.plans.order import seeded_int

PART = T.StructType([T.StructField("type", T.StringType()), T.StructField("text", T.StringType())])


def render_mc(question: Column, letters: Column, choices: Column) -> Column:
    """Multiple-choice user message, ``- choice=LETTER`` per line."""
    lines = F.zip_with(letters, choices, lambda l, c: F.concat(F.lit("- "), c, F.lit("="), l, F.lit("\n")))
    return F.concat(F.lit(MC_HEADER), question, F.lit("\n"), F.array_join(lines, ""), F.lit(MC_FOOTER))


def _shot_block(items: DataFrame, shots: DataFrame, key: str, block: Column) -> DataFrame:
    """Few-shot prefix per item: shot blocks ordered by ``j`` (≤ k rows per item)."""
    s = shots.join(items.select(F.col(key).alias("shot_" + key), block.alias("__blk")), "shot_" + key)
    return (s.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("j", "__blk"))).alias("__s"))
            .select(key, F.array_join(F.transform("__s", lambda x: x["__blk"]), "").alias("fewshot")))


def render_fewshot_mc(items: DataFrame, shots: DataFrame | None, delim: str = " ",
                      key: str = "idx") -> DataFrame:
    """One prompt per choice; shots show their gold choice.

    ``items``: (idx, query, choices, gold); ``shots``: (idx, j, shot_idx).
    """
    d = F.lit(delim)
    blk = F.concat(F.col("query"), d, F.element_at("choices", F.col("gold") + 1), F.lit("\n\n"))
    pre = _shot_block(items, shots, key, blk) if shots is not None else None
    it = items if pre is None else items.join(pre, key, "left")
    few = F.coalesce(F.col("fewshot"), F.lit("")) if pre is not None else F.lit("")
    x = it.select(key, few.alias("few"), "query", F.posexplode("choices").alias("choice_idx", "choice"))
    return x.select(key, "choice_idx", F.concat("few", "query", d, "choice").alias("prompt"))


def render_fewshot_schema(items: DataFrame, shots: DataFrame | None, delim: str = " ",
                          key: str = "idx") -> DataFrame:
    """One prompt per context option with the shared continuation."""
    d = F.lit(delim)
    blk = F.concat(F.element_at("context_options", F.col("gold") + 1), d, F.col("continuation"), F.lit("\n\n"))
    pre = _shot_block(items, shots, key, blk) if shots is not None else None
    it = items if pre is None else items.join(pre, key, "left")
    few = F.coalesce(F.col("fewshot"), F.lit("")) if pre is not None else F.lit("")
    x = it.select(key, few.alias("few"), "continuation",
                  F.posexplode("context_options").alias("option_idx", "context"))
    return x.select(key, "option_idx", F.concat("few", "context", d, "continuation").alias("prompt"))


def render_fewshot_lm(items: DataFrame, shots: DataFrame | None, delim: str = " ",
                      key: str = "idx") -> DataFrame:
    """Prompts without / with the continuation; contexts trimmed, "without" stripped."""
    d = F.lit(delim)
    blk = F.concat(strip_ws("context"), d, F.col("continuation"), F.lit("\n\n"))
    pre = _shot_block(items, shots, key, blk) if shots is not None else None
    it = items if pre is None else items.join(pre, key, "left")
    few = F.coalesce(F.col("fewshot"), F.lit("")) if pre is not None else F.lit("")
    base = F.concat(few, strip_ws("context"), d)
    return it.select(key, strip_ws(base).alias("prompt_without"),
                     F.concat(base, F.col("continuation")).alias("prompt_with"))


def parse_tool_calls(answer: Column) -> Column:
    """Split on ``<<expr=result>>`` into text / python / python_output parts.

    The split is on the *last* '='; a call without '=' has an empty result.
    Mirrors a capturing ``re.split``: text parts (possibly empty) alternate
    with calls.
    """
    marked = F.regexp_replace(answer, r"(<<[^>]+>>)", "\u0000$1\u0000")
    pieces = F.split(marked, "\u0000", -1)

    def to_parts(p):
        is_call = p.startswith("<<") & p.endswith(">>")
        inner = F.substring(p, 3, F.length(p) - 4)
        has_eq = inner.contains("=")
        expr = F.when(has_eq, F.regexp_extract(inner, r"(?s)^(.*)=([^=]*)$", 1)).otherwise(inner)
        res = F.when(has_eq, F.regexp_extract(inner, r"(?s)^(.*)=([^=]*)$", 2)).otherwise(F.lit(""))
        call = F.array(F.struct(F.lit("python").alias("type"), expr.alias("text")),
                       F.struct(F.lit("python_output").alias("type"), res.alias("text")))
        text = F.array(F.struct(F.lit("text").alias("type"), p.alias("text")))
        return F.when(is_call, call).otherwise(text)
    return F.flatten(F.transform(pieces, to_parts))


def extract_imports(prompt: Column) -> Column:
    """Leading ``import``/``from`` lines (stripped); stop at the first
    other non-blank, non-comment line."""
    lines = F.split(prompt, "\n", -1)
    init = F.struct(F.lit(False).alias("stop"), F.array().cast("array<string>").alias("acc"))

    def step(acc, line):
        s = strip_ws(line)
        is_imp = s.startswith("import ") | s.startswith("from ")
        other = (s != "") & ~s.startswith("#")
        stop = acc["stop"] | (~is_imp & other)
        add = ~acc["stop"] & is_imp
        return F.struct(stop.alias("stop"),
                        F.when(add, F.concat(acc["acc"], F.array(s))).otherwise(acc["acc"]).alias("acc"))
    return F.array_join(F.aggregate(lines, init, step)["acc"], "\n")


def assemble_program(prompt: Column, completion: Column, test: Column, entry_point: Column) -> Column:
    """Imports + code + tests + ``check(entry)`` (text only; never executed)."""
    return F.concat(extract_imports(prompt), F.lit("\n\n"), extract_program(completion), F.lit("\n\n"),
                    test, F.lit("\n"), F.lit("check("), entry_point, F.lit(")"))


def build_prompt_batch(indices: DataFrame, starters: DataFrame, template: str, k: int = 5,
                       idx: str = "idx", placeholder: str = "%USER_FIRST_PROMPTS%") -> DataFrame:
    """Per index, ``k`` seeded picks with replacement from the starters
    (equi-join on the drawn position), joined by newlines into the template.

    ``starters``: (starter_idx 0..n−1, text).
    """
    n = starters.select(F.max("starter_idx")).scalar() + 1
    picks = indices.select(idx, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("j"))
    picks = picks.withColumn("starter_idx", seeded_int("starter", n, idx, "j"))
    j = picks.join(starters, "starter_idx")
    agg = j.groupBy(idx).agg(F.array_sort(F.collect_list(F.struct("j", "text"))).alias("__p"))
    body = F.array_join(F.transform("__p", lambda x: x["text"]), "\n")
    return agg.select(idx, F.replace(F.lit(template), F.lit(placeholder), body).alias("prompt"))


_REPLY = T.StructType([T.StructField("messages", T.ArrayType(T.StructType([
    T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])))])


def parse_structured_reply(replies: DataFrame, content: str = "content") -> DataFrame:
    """JSON reply → messages; ``valid`` = parsed and alternating from user."""
    p = replies.withColumn("__r", F.from_json(content, _REPLY, {"mode": "PERMISSIVE"}))
    msgs = F.col("__r.messages")
    alt = F.forall(F.transform(msgs, lambda m, i: F.struct(m["role"].alias("r"), i.alias("i"))),
                   lambda x: x["r"] == F.when(x["i"] % 2 == 0, "user").otherwise("assistant"))
    ok = msgs.isNotNull() & (F.size(msgs) > 0) & alt
    return p.withColumn("messages", msgs).withColumn("valid", F.coalesce(ok, F.lit(False))).drop("__r")


# ---------------------------------------------------------------------------
# B23 calculator audit: evaluate recorded tool expressions with an AST
# whitelist (never ``eval``) and compare with the recorded output.

# The calculator's character sets and rejected substrings.
MATH_CHARS = "0123456789*+-/.() "
STRING_OP_CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789'\"()._ "
DANGEROUS = ['__', 'import', 'exec', 'eval', 'compile', 'open', 'file',
             'input', 'raw_input', 'globals', 'locals', 'vars', 'dir',
             'getattr', 'setattr', 'delattr', 'hasattr']

_BIN = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv,
        ast.FloorDiv: operator.floordiv, ast.Mod: operator.mod}
_UN = {ast.UAdd: operator.pos, ast.USub: operator.neg}


def _eval_node(node):
    if isinstance(node, ast.Expression):
        return _eval_node(node.body)
    if isinstance(node, ast.Constant) and isinstance(node.value, (int, float, str)) \
            and not isinstance(node.value, bool):
        return node.value
    if isinstance(node, ast.BinOp) and type(node.op) in _BIN:
        a, b = _eval_node(node.left), _eval_node(node.right)
        if isinstance(a, str) or isinstance(b, str):
            raise ValueError("no string arithmetic")
        return _BIN[type(node.op)](a, b)
    if isinstance(node, ast.UnaryOp) and type(node.op) in _UN:
        v = _eval_node(node.operand)
        if isinstance(v, str):
            raise ValueError("no string arithmetic")
        return _UN[type(node.op)](v)
    if (isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr == "count"
            and len(node.args) == 1 and not node.keywords):
        target, arg = _eval_node(node.func.value), _eval_node(node.args[0])
        if isinstance(target, str) and isinstance(arg, str):
            return target.count(arg)
    raise ValueError("not allowed")


def _pattern(chars: str, *conditions: str) -> str:
    """Whole strings of these characters that meet the conditions; reads alike in Java and Python."""
    return "(?s)^" + "".join(conditions) + f"[{re.escape(chars)}]*(?!.)"


# What the calculator takes, commas apart: one pattern for each kind of expression.
EXPRESSIONS = {
    "arithmetic": _pattern(MATH_CHARS, r"(?!.*\*\*)"),
    "count": _pattern(STRING_OP_CHARS, r"(?=.*\.count\()", rf"(?!(?i:.*(?:{'|'.join(map(re.escape, DANGEROUS))})))"),
}


def expression_kind(expr: Column) -> Column:
    """'arithmetic' or 'count'; null for what the calculator rejects."""
    plain = F.replace(expr, F.lit(","), F.lit(""))
    return F.coalesce(*(F.when(plain.rlike(pattern), F.lit(kind)) for kind, pattern in EXPRESSIONS.items()))


def _value(plain: str):
    """Value of an accepted expression; None where it has none."""
    try:
        return _eval_node(ast.parse(plain, mode="eval"))
    except Exception:  # noqa: BLE001 - any failure is a rejected call
        return None


def calculate(expr: str | None):
    """One expression outside Spark, by the same patterns."""
    plain = (expr or "").replace(",", "")
    return _value(plain) if any(re.search(p, plain) for p in EXPRESSIONS.values()) else None


@F.pandas_udf(T.StringType())
def calculator(exprs: pd.Series) -> pd.Series:
    values = [None if e is None else _value(e.replace(",", "")) for e in exprs]
    return pd.Series([None if v is None else str(v) for v in values], dtype=object)


def audit_tool_results(parts: DataFrame, key: list[str], parts_col: str = "parts") -> DataFrame:
    """Each python part with the python_output part after it: recorded vs
    recomputed result (``ok`` NULL when the expression is rejected)."""
    pairs = F.filter(F.transform(F.col(parts_col), lambda p, i: F.struct(
        i.alias("i"), p["type"].alias("type"), p["text"].alias("expr"),
        F.try_element_at(F.col(parts_col), i + 2)["text"].alias("recorded"))), lambda x: x["type"] == "python")
    x = parts.select(*key, F.explode(pairs).alias("c"))
    x = x.select(*key, F.col("c.i").alias("part_idx"), F.col("c.expr").alias("expr"),
                 F.col("c.recorded").alias("recorded"))
    x = x.withColumn("computed", calculator(F.when(expression_kind(F.col("expr")).isNotNull(), F.col("expr"))))
    return x.withColumn("ok", F.when(F.col("computed").isNotNull(), F.col("computed") == F.col("recorded")))
