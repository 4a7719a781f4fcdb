"""Column-level text functions (all JVM-side built-ins unless noted)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Pre-tokenizer split patterns (GPT-4 style; the training variant uses
# \p{N}{1,2} for numbers, the generic default \p{N}{1,3}).
SPLIT_PATTERN = (r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}|"""
                 r""" ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+""")
GPT4_SPLIT_PATTERN = (r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}|"""
                      r""" ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+""")
# Special tokens of the chat tokenizer, in id order after the merged ranks;
# the first is the beginning-of-sequence token.
SPECIAL_TOKENS = [
    "<|bos|>",
    "<|user_start|>",
    "<|user_end|>",
    "<|assistant_start|>",
    "<|assistant_end|>",
    "<|python_start|>",
    "<|python_end|>",
    "<|output_start|>",
    "<|output_end|>",
]
# Answer marker of grade-school math style completions.
ANSWER_PATTERN = r"#### (\-?[0-9\.\,]+)"
# Fenced code block in a completion.
CODE_BLOCK_PATTERN = r"```(?:python)?\s*\n(.*?)\n```"
# Multiple-choice rendering text.
MC_HEADER = "Multiple Choice question: "
MC_FOOTER = "\nRespond only with the letter of the correct answer."
# ---------------------------------------------------------------------------

# Spark's trim() strips spaces only; strip_ws() below follows str.strip().


def java_pattern(pattern: str) -> str:
    """Wrap a pre-tokenizer pattern for Java regex: Unicode classes + one group."""
    return "(?U)(" + pattern + ")"


# Characters Python's str.isspace() accepts (what str.strip() removes).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")


def strip_ws(col) -> Column:
    """Python ``str.strip()`` semantics (``btrim`` over the whitespace set, no regex)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(c, F.lit(PY_WHITESPACE))


def rstrip_chars(col, chars: str) -> Column:
    """``str.rstrip(chars)``."""
    c = F.col(col) if isinstance(col, str) else col
    cls = "".join("\\" + ch for ch in chars)
    return F.regexp_replace(c, "[" + cls + "]+$", "")


def crop(col, n: int) -> Column:
    """First ``n`` code points (Spark strings index by code point)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c, 1, n)


def looks_like_question(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    low = F.lower(c)
    return (c.contains("?") | low.startswith("to ask ") | low.contains(" asked ")
            | low.startswith("asked "))


def speaker_regex(names_alt: str) -> str:
    """Anchored, case-insensitive speaker label ending in a colon."""
    return r"(?i)^(?:" + names_alt + r")\s*:"


def match_speaker(col, pattern: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(pattern)


def extract_answer(col) -> Column:
    """Number after the first ``#### `` marker, commas removed; NULL if none."""
    c = F.col(col) if isinstance(col, str) else col
    m = F.regexp_extract(c, ANSWER_PATTERN, 1)
    return F.when(c.rlike(ANSWER_PATTERN), F.regexp_replace(strip_ws(m), ",", ""))


def extract_program(col) -> Column:
    """First fenced code block stripped, else the whole completion stripped."""
    c = F.col(col) if isinstance(col, str) else col
    pat = "(?s)" + CODE_BLOCK_PATTERN
    return F.when(c.rlike(pat), strip_ws(F.regexp_extract(c, pat, 1))).otherwise(strip_ws(c))


def nfkc(col) -> Column:
    """B1: NFKC normalization. Rows that are pure ASCII (already NFKC) skip
    Python entirely; the rest go through an Arrow-batched UDF."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.rlike(r"[^\x00-\x7F]"), _nfkc_udf(c)).otherwise(c)


def _nfkc_impl(s):
    import unicodedata
    import pandas as pd
    return pd.Series([None if x is None else unicodedata.normalize("NFKC", x) for x in s], dtype=object)


from pyspark.sql import types as _T  # noqa: E402

_nfkc_udf = F.pandas_udf(_nfkc_impl, _T.StringType())
