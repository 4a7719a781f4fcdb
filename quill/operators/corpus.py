"""Corpus jobs: budgets, sentences, paragraphs, question/answer mining, slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quill.functions.text import (crop, looks_like_question, rstrip_chars, strip_ws)
from quill.plans.order import dense_index, prefix_sum, seeded_key


def crop_text(df: DataFrame, text: str = "text", doc_cap: int = 10_000) -> DataFrame:
    """B2: first ``doc_cap`` code points."""
    return df.withColumn(text, crop(text, doc_cap))


def take_char_budget(df: DataFrame, order: Sequence[str], max_chars: int, text: str = "text",
                     doc_cap: int | None = 10_000) -> DataFrame:
    """Keep a document iff the chars *before* it (after cropping) are ≤ max_chars.

    The document that crosses the budget is kept. Prefix sums are two-level
    (range buckets + broadcast bases), never a single-partition window.
    """
    if doc_cap is not None:
        df = crop_text(df, text, doc_cap)
    with_prefix = prefix_sum(df, order, F.length(text).cast("long"), out="chars_before", inclusive=False,
                             stop_above=max_chars)
    return with_prefix.where(F.col("chars_before") <= max_chars)


def sentences(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Split on '.', strip, drop blanks; '.' re-added except on a final
    fragment of a text that does not end in '.'."""
    # split once and keep only a flag, so exploded rows never carry the text
    d = df.select(key, F.split(F.col(text), r"\.", -1).alias("__parts"),
                  F.col(text).endswith(".").alias("__ends"))
    x = d.select(key, "__ends", F.size("__parts").alias("n"),
                 F.posexplode("__parts").alias("pos", "frag"))
    s = strip_ws(F.col("frag"))
    add_dot = (F.col("pos") < F.col("n") - 1) | F.col("__ends")
    return (x.select(key, "pos", s.alias("s"), add_dot.alias("dot"))
            .where(F.col("s") != "")
            .select(key, "pos", F.when(F.col("dot"), F.concat(F.col("s"), F.lit("."))).otherwise(F.col("s"))
                    .alias("sentence")))


def shuffle(df: DataFrame, key: str, seed: int = 42, out: str = "shuffle_key") -> DataFrame:
    """Whole-dataset seeded order (a sort key; sorting is left to the consumer)."""
    return df.withColumn(out, seeded_key(seed, key))


def paragraphs(df: DataFrame, text: str = "text", key: str = "doc_id",
               sep: str = r"\n\s*\n") -> DataFrame:
    """Split on blank lines, strip, drop empties; ``pos`` counts kept paragraphs."""
    parts = F.split(F.col(text), "(?U)" + sep, -1)
    kept = F.filter(F.transform(parts, lambda p: strip_ws(p)), lambda p: p != "")
    return df.select(key, F.posexplode(kept).alias("pos", "paragraph"))


def paragraph_arrays(df: DataFrame, text: str = "text", key: str = "doc_id",
                     sep: str = r"\n\s*\n") -> DataFrame:
    parts = F.split(F.col(text), "(?U)" + sep, -1)
    kept = F.filter(F.transform(parts, lambda p: strip_ws(p)), lambda p: p != "")
    return df.select(key, kept.alias("paras"))


def extract_qa_pairs(df: DataFrame, speaker_pattern: str, text: str = "text",
                     key: str = "doc_id", sep: str = r"\n\s*\n") -> DataFrame:
    """question/answer pairs for paragraphs spoken by a speaker.

    Stays inside each document's paragraph array (``transform`` with index):
    no shuffle at all. A match in paragraph 0 is a match but never a pair;
    the question is the previous paragraph when it looks like a question,
    else the heading (paragraph 0 with trailing ``.?!`` stripped, plus ``?``).
    Output: ``(doc_id, pos, question, answer)``.
    """
    arr = paragraph_arrays(df, text, key, sep)
    heading = F.concat(rstrip_chars(F.element_at("paras", 1), ".?!"), F.lit("?"))
    pairs = F.transform(
        F.col("paras"),
        lambda p, i: F.struct(
            i.alias("pos"),
            p.rlike(speaker_pattern).alias("is_match"),
            F.when(i > 0, F.when(looks_like_question(F.col("paras")[i - 1]), F.col("paras")[i - 1])
                   .otherwise(heading)).alias("question"),
            p.alias("answer")))
    kept = F.filter(pairs, lambda q: q["is_match"] & (q["pos"] > 0))   # only pairs become rows
    return (arr.select(key, F.explode(kept).alias("q"))
            .select(key, F.col("q.pos").alias("pos"), F.col("q.question").alias("question"),
                    F.col("q.answer").alias("answer")))


def speaker_match_counts(df: DataFrame, speaker_pattern: str, text: str = "text",
                         key: str = "doc_id", sep: str = r"\n\s*\n") -> DataFrame:
    """Counts printed alongside B10: matched paragraphs and emitted pairs."""
    arr = paragraph_arrays(df, text, key, sep)
    m = F.transform(F.col("paras"), lambda p, i: F.when(p.rlike(speaker_pattern), i))
    matched = F.size(F.filter(m, lambda x: x.isNotNull()))
    paired = F.size(F.filter(m, lambda x: x > 0))
    return arr.agg(F.sum(matched).alias("matches"), F.sum(paired).alias("pairs"))


def slice_view(df: DataFrame, idx: str, start: int = 0, stop: int | None = None,
               step: int = 1) -> DataFrame:
    """Logical slice over a dense 0-based index column (stop clamped to the data)."""
    cond = (F.col(idx) >= start) & (((F.col(idx) - start) % step) == 0)
    if stop is not None:
        cond = cond & (F.col(idx) < stop)
    return df.where(cond)


def with_index(df: DataFrame, order: Sequence[str], out: str = "idx") -> DataFrame:
    return dense_index(df, order, out=out)


def stride(df: DataFrame, rank: int, world: int, group_size: int = 1024,
           row_in_shard: str = "row_in_shard") -> DataFrame:
    """A3: every ``world``-th row group of each shard, starting at ``rank``."""
    g = F.floor(F.col(row_in_shard) / group_size)
    return df.where(F.pmod(g, F.lit(world)) == rank)


def shuffle_buffered(sents: DataFrame, n: int = 50_000, seed: int = 42, max_sentences: int | None = None,
                     key: str = "doc_id", pos: str = "pos") -> DataFrame:
    """Shuffle within document-aligned buffers of ≥ ``n`` sentences.

    A buffer closes after the document that brings it to ``n`` sentences
    (greedy segmentation over per-document counts, no sequential pass); the
    final partial buffer is flushed too. Output order = (buffer, seeded key);
    ``rank`` is the global position and ``max_sentences`` keeps the first ones.
    """
    from quill.plans.segment import greedy_segments
    per_doc = sents.groupBy(key).agg(F.count(F.lit(1)).cast("long").alias("__n"))
    buf = greedy_segments(per_doc, key, "__n", n, out="buffer").select(key, "buffer")
    s = sents.join(buf, key).withColumn("shuffle_key", seeded_key(seed, key, pos))
    return dense_index(s, ["buffer", "shuffle_key"], out="rank", below=max_sentences)
