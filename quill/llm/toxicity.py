"""Toxic passages as maximum-scoring segments of token log-odds.

Weights: for each word the log-odds between toxic and other labelled documents
under an informative Dirichlet prior (the word's own share of all training
documents), lowered by ``margin`` standard deviations, so that chance finds weigh
nothing. Distinct texts count once and a word once per text, so copies and
repetition do not invent vocabulary. Every other word costs ``drift``.

Passages: one linear scan finds all maximal scoring segments of a whole text: no
segment can be extended or cut to score more.

Calibration: segments of the non-toxic training texts give the rate at which
scores arise by chance, K * exp(-lambda * s) per word, the extreme-value law of
segment scores. A passage in a text of n words is expected K * n * exp(-lambda * s)
times; those below ``significant`` are reported. The best passage's evidence and
the sum over significant passages go through a logistic curve fitted on the
training texts.

A key or a text with several labels counts as toxic if one of them says so. Learning
uses a bounded sample: ``max_docs`` labelled rows with the lowest hash of
their id. Scoring covers every whole text. Null and empty texts have no passage
and score like a clean text. Without both classes among the labels, no word has
weight and all scores are the smoothed share of toxic labels. Repeated rows score
equally.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.tables import crc32_mod, map_arrow, stored, text_bytes

#: A-Z to a-z; ASCII punctuation and white space to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a text whose words at ``hits`` (position,
    weight > 0) score and whose other words cost ``drift``: (start, end, score).

    Candidates are kept as (sum before, sum after, start, end, nearest earlier
    candidate that starts lower). A new one joins an earlier one when it lifts
    that one's end; each join removes candidates, so the scan is linear.
    """
    open_: list[tuple[float, float, int, int, int]] = []
    total, at = 0.0, 0
    for pos, weight in hits:
        low = total - drift * (pos - at)
        total = high = low + weight
        at = end = pos + 1
        start = pos
        while True:
            j = len(open_) - 1
            while j >= 0 and open_[j][0] >= low:
                j = open_[j][4]
            if j < 0 or open_[j][1] >= high:
                open_.append((low, high, start, end, j))
                break
            low, start = open_[j][0], open_[j][2]
            del open_[j:]
    return [(s, e, high - low) for low, high, s, e, _ in open_]


def passages(text: bytes, model: dict) -> tuple[list[tuple[int, int, float]], int]:
    lex = model["lexicon"]
    ws = words(text)
    if not lex:
        return [], len(ws)
    return segments([(i, lex[w]) for i, w in enumerate(ws) if w in lex], model["drift"]), len(ws)


def evidence(found: list[tuple[int, int, float]], n: int, model: dict) -> tuple[float, float, int]:
    """-log10 of the expected chance count of the best passage, the sum of that over
    significant passages, and their number."""
    if not found:
        return -math.log10(max(n, 1) * model["K"] + 1e-9) if n else 0.0, 0.0, 0
    base = math.log(model["K"] * n)
    e = [(model["lambda"] * s - base) / math.log(10) for _, _, s in found]
    good = [x for x in e if x > -math.log10(model["significant"])]
    return max(e), sum(good), len(good)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column is the constant."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def features(best: float, total: float, passages_: int) -> list[float]:
    return [max(-6.0, min(best, 6.0)), math.log1p(max(total, 0.0)), 1.0]


def probability(text: bytes, model: dict) -> tuple[float, list[tuple[int, int, float]], int]:
    found, n = passages(text, model)
    best, total, k = evidence(found, n, model)
    z = float(np.dot(features(best, total, k), model["curve"]))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), found, k


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", key: str = "doc_id", text: str = "text", folds: int = 5, held_out: int = 0,
        max_docs: int = 20_000, prior: float = 50.0, margin: float = 2.5, drift: float = 0.3, significant: float = 0.05) -> dict:
    """Learn lexicon, chance law and curve from the labelled rows outside the held-out fold."""
    rows = (labels.where(F.col(target).isNotNull() & F.col(key).isNotNull() & (crc32_mod(key, folds) != held_out))
            .groupBy(F.col(key).alias("__key")).agg(F.max((F.col(target) > 0).cast("int")).alias("__label"))
            .orderBy(F.xxhash64("__key"), "__key").limit(max_docs))
    sample = stored(docs.select(key, text_bytes(text).alias("text")).join(F.broadcast(rows), F.col(key) == F.col("__key"))
                    .groupBy("text").agg(F.max("__label").alias("__label")), "toxicity-sample")
    sizes = dict(sample.groupBy("__label").count().collect())
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    model = {"lexicon": {}, "drift": drift, "significant": significant, "lambda": 1.0, "K": 1e-3,
             "curve": [0.0, 0.0, math.log((n1 + 1) / (n0 + 1))]}
    if not n1 or not n0:
        return model

    def count(batches):
        for b in batches:
            c = (Counter(), Counter())
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                c[y].update(set(words(t)))
            every = list(c[0] | c[1])
            yield pa.RecordBatch.from_arrays([pa.array(every, pa.binary()), pa.array([c[1][w] for w in every], pa.int64()),
                                              pa.array([c[0][w] for w in every], pa.int64())], names=["word", "toxic", "other"])
    # words of a bounded sample; only those that lean to the toxic side can weigh
    table = (map_arrow(sample, count, "word binary, toxic bigint, other bigint").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
             .where((F.col("toxic") >= 2) & (F.col("toxic") * n0 > F.col("other") * n1)).collect())
    for word, a, b in table:
        own = prior * (a + b) / (n1 + n0)
        p1, p0 = (a + own) / (n1 + prior), (b + own + 0.5) / (n0 + prior)
        odds = math.log(p1 / (1 - p1)) - math.log(p0 / (1 - p0))
        sd = math.sqrt(1 / (a + own) + 1 / (b + own + 0.5))
        if odds - margin * sd > 0:
            model["lexicon"][bytes(word)] = odds - margin * sd
    lex = model

    def scan(batches):
        for b in batches:
            out = [passages(t, lex) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([n for _, n in out], pa.int64()),
                                              pa.array([[s for *_, s in f] for f, _ in out], pa.list_(pa.float64()))], names=["label", "n", "scores"])
    seen = map_arrow(sample, scan, "label int, n bigint, scores array<double>").collect()
    chance = [s for r in seen if not r.label for s in r.scores]
    n_words = sum(r.n for r in seen if not r.label)
    model["lambda"] = (len(chance) + 1) / (sum(chance) + 1)
    model["K"] = (len(chance) + 1) / (n_words + 1)
    x = np.array([features(*evidence([(0, 0, s) for s in r.scores], r.n, model)) for r in seen])
    model["curve"] = _logistic(x, np.array([float(r.label) for r in seen])).tolist()
    return model


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, n_passages, passages): passages as (first word, end word, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # bounded by the training sample

    def run(batches):
        m = shared.value
        for b in batches:
            out = [probability(t, m) for t in b.column(1).to_pylist()]
            limit = -math.log10(m["significant"])
            spans = []
            for (_, found, _), t in zip(out, b.column(1).to_pylist(), strict=True):
                n = len(words(t)) if found else 0
                spans.append([{"start": s, "end": e, "score": v} for s, e, v in found
                              if (m["lambda"] * v - math.log(m["K"] * n)) / math.log(10) > limit])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([p for p, _, _ in out], pa.float64()), pa.array([k for *_, k in out], pa.int32()),
                                              pa.array(spans, kind)], names=[key, "score", "n_passages", "passages"])
    return map_arrow(docs.select(key, text_bytes(text).alias("text")), run,
                     f"`{key}` {dict(docs.dtypes)[key]}, score double, n_passages int, passages array<struct<start: int, end: int, score: double>>")
