"""Quality rules from tokeniser fertility.

Two kinds of rules over each whole text:

* plain counts (words, symbols, repeated lines, repeated five-word windows) with
  fixed limits, and
* how a public vocabulary takes the text: characters per token, share of tokens
  that fell back to bytes, and entropy of the token distribution. Text unlike the
  rest of its language — shouting, symbol noise, wrong script, machine junk — is
  cut into shorter pieces, falls back more, or repeats few tokens.

The rejection bands come from the table itself, per language: quartiles over all
documents of that language (an approximate quantile sketch of fixed size). The
bands widen for short texts, whose measures vary more. The median is always that of
the document's own language. Its quartile distance is averaged with the mean distance
within all languages, as if ``prior_docs`` further documents had that one: a language
of few documents leans on the others for its spread, and the weight fades smoothly.
A language of one document has that document as its median, so only the plain
counts can reject it.

Null or empty texts have no words and fail the word count. A null language is a
group of its own. Repeated rows are judged each for itself.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.llm.tables import map_arrow, skew_join, stored
from quill.llm.words import windows, word_hashes

VOCAB = "piece_bpe_32k.model"
MARK = "\u2581"
SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
SYMBOLS = tuple(bytes([c]) for c in b"#*$%&|<>")

# A rate is rejected beyond median +- k quartile distances (or ``floor``, if that is
# more). The width grows as sqrt(1 + short / tokens): a measure over few tokens
# varies as the inverse root of their number.
BANDS = {
    "chars_per_token": {"k": 2.5, "floor": 0.10, "short": 800.0},
    "byte_share": {"k": 10.0, "floor": 0.10, "short": 800.0, "upper_only": True},
    "token_entropy_rate": {"k": 3.0, "floor": 0.20, "short": 100.0, "lower_only": True},
}


class _Pieces:
    """A vocabulary whose pieces hold the word mark only in front, so the pieces of a text of
    words joined by single spaces are those of its words, one after another."""

    def __init__(self, path):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.sp.get_piece_size()
        self.is_byte = np.fromiter((self.sp.is_byte(i) for i in range(size)), bool, size)
        self.joins = all(MARK not in self.sp.id_to_piece(i).lstrip(MARK) for i in range(size))

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Ids of all words. A word that ends with the mark itself could melt with the next one's."""
        text = b" ".join(words).decode("utf-8", "replace")
        if self.joins and MARK not in text:
            return np.array(self.sp.encode(text), np.int32)
        return np.concatenate([np.array(self.sp.encode(w.decode("utf-8", "replace")), np.int32) for w in words])


@lru_cache(maxsize=1)
def _vocab(vocab: str) -> _Pieces:
    import os

    import public_tokenizers
    return _Pieces(vocab if os.path.sep in vocab else public_tokenizers.path(vocab))


def base_counts(t: bytes) -> tuple[int, int, int, int, int, list[bytes]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words."""
    words = t.split()
    n = len(words)
    if not n:
        return 0, 0, sum(map(t.count, SYMBOLS)), 0, 0, words
    chars = len(t.decode("utf-8", "replace")) - sum(map(t.count, SPACES))
    lines = [x for x in t.split(b"\n") if x and not x.isspace()]
    repeat = 0
    w = windows(word_hashes(t, fold=False), 5)
    if len(w) > 1:
        order = np.argsort(w, kind="stable")
        s = w[order]
        same = s[1:] == s[:-1]
        if same.any():
            twice = np.zeros(len(w), bool)
            twice[1:] |= same
            twice[:-1] |= same
            step = np.zeros(n + 1, np.int64)
            at = order[twice]
            step[at] += 1               # window starts are distinct
            np.add.at(step, at + 5, -1)
            repeat = int((np.cumsum(step[:-1]) > 0).sum())
    return n, chars, sum(map(t.count, SYMBOLS)), len(lines) - len(set(lines)), repeat, words


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens", "token_entropy")
_KINDS = [pa.int64()] * 7 + [pa.float64()]


def measures(df: DataFrame, text: str = "text", vocab: str = VOCAB, out: str = "__fertility") -> DataFrame:
    """``df`` with a struct of base counts and token measures of each whole text."""
    names, at = df.columns, df.columns.index(text)

    def run(batches):
        v = _vocab(vocab)
        for b in batches:
            cols = [[] for _ in MEASURES]
            for t in b.column(at).cast(pa.binary()).to_pylist():
                *base, words = base_counts(t or b"")
                n = fell = 0
                entropy = 0.0
                if words:
                    ids = v.ids(words)
                    n = len(ids)
                    fell = int(v.is_byte[ids].sum())
                    c = np.bincount(ids) if n > 4000 else np.unique(ids, return_counts=True)[1]
                    c = c[c > 0]
                    entropy = float(np.log2(n) - (c * np.log2(c)).sum() / n)
                for col, x in zip(cols, (*base, n, fell, entropy), strict=True):
                    col.append(x)
            found = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS, strict=True)], names=list(MEASURES))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), found], names=[*names, out])
    fields = ", ".join(f"{m}: {'double' if m == 'token_entropy' else 'bigint'}" for m in MEASURES)
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + f", {out} struct<{fields}>"
    return map_arrow(df, run, schema)


def _name(col: str) -> Column:
    """A language as a join key; null is a language of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(col)), F.lit("null"))


def _judge(measured: DataFrame, lang: str, out: str, prior_docs: int, min_words: int, max_repeat_percent: int) -> DataFrame:
    """``measured`` (a written table) with the rates, ``base_failed`` and ``kept`` in the struct ``out``."""
    def m(name):
        return F.col(f"{out}.{name}")
    tokens = F.greatest(m("n_tokens"), F.lit(1))
    language = F.col(lang).cast("string") if lang in measured.columns else F.lit(None).cast("string")
    rate = {"chars_per_token": m("word_chars") / tokens, "byte_share": m("n_byte_tokens") / tokens,
            # of the entropy that so many draws could have at most
            "token_entropy_rate": m("token_entropy") / F.log2(F.greatest(tokens, F.lit(2)))}
    judged_rows = measured.where(m("n_words") >= min_words).select(language.alias("lang"), *(c.alias(n) for n, c in rate.items()))
    quartiles = [F.percentile_approx(c, [0.25, 0.5, 0.75], 1000).alias(c) for c in rate]
    by_lang = judged_rows.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), *quartiles)
    # a written table of known size: Spark broadcasts it if it is small, and only then
    # do the texts stay where they are
    bands = stored(by_lang.select(_name("lang").alias("__lang"), F.struct("docs", *rate).alias("__bands")), "bands")

    def distance(name):
        return F.col(f"__bands.{name}")[2] - F.col(f"__bands.{name}")[0]
    more = F.col("__bands.docs") - 1        # one document has no spread
    # one row: mean quartile distances within the languages
    within = bands.agg(*(F.try_divide(F.sum(more * distance(c)), F.sum(more)).alias(c) for c in rate)).collect()[0]
    d = measured.withColumn("__language", language)
    d = skew_join(d.withColumn("__lang", _name("__language")), bands, "__lang", "left")
    ok = F.lit(True)
    for name, rule in BANDS.items():
        median, docs = F.col(f"__bands.{name}")[1], F.col("__bands.docs")
        spread = (docs * distance(name) + F.lit(prior_docs * (within[name] or 0.0))) / (docs + prior_docs)
        width = F.greatest(rule["k"] * spread, F.lit(rule["floor"])) * F.sqrt(1 + rule["short"] / tokens)
        if not rule.get("upper_only"):
            ok = ok & (rate[name] >= median - width)
        if not rule.get("lower_only"):
            ok = ok & (rate[name] <= median + width)
    failed = (m("n_words") < min_words) | (100 * m("n_repeat_words") > max_repeat_percent * m("n_words"))
    verdict = F.struct(f"{out}.*", *(c.alias(n) for n, c in rate.items()), failed.alias("base_failed"), (~failed & F.coalesce(ok, F.lit(False))).alias("kept"))
    return d.withColumn(out, verdict).drop("__language", "__lang", "__bands")


def judged(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", vocab: str = VOCAB, prior_docs: int = 20,
           min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """Key, measures, rates, ``base_failed`` and ``kept`` of each row."""
    language = F.col(lang).cast("string") if lang in df.columns else F.lit(None).cast("string")
    narrow = measures(df.select(F.col(key).alias("__id"), language.alias("__lang0"), F.col(text).alias("__text")), "__text", vocab).drop("__text")
    d = _judge(stored(narrow, "fertility"), "__lang0", "__fertility", prior_docs, min_words, max_repeat_percent)
    return d.select(F.col("__id").alias(key), "__fertility.*")


def keep_good(df: DataFrame, text: str = "text", lang: str = "lang", vocab: str = VOCAB, prior_docs: int = 20,
              min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """Rows of ``df`` that the rules keep. The rows are written once with their
    measures, so the verdict meets its row without a join of texts."""
    d = _judge(stored(measures(df, text, vocab), "fertility"), lang, "__fertility", prior_docs, min_words, max_repeat_percent)
    return d.where("__fertility.kept").select(*df.columns)
