"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks of ``CHUNK`` bytes that cover it to the last
byte. Learned byte embeddings and filters (``2 * STEP`` bytes wide, one every
``STEP`` bytes) run over each chunk; each filter's largest response is the chunk's
feature. One more feature is the share of the chunk's byte windows seen earlier in
the same chunk. A document is the mean and the maximum of its chunks' features,
and a logistic layer turns them into one probability.

Training is plain back-propagation (Adam) on a bounded sample of labelled rows:
``max_docs`` documents with the lowest hash of their id, or as many of these as have
``max_bytes`` together. Training and scoring cover every byte of a document; both go
over its chunks in slabs, so a text of any length needs bounded memory.

Null and empty texts are one chunk of padding and get a score like any other.
Without labelled rows every score is 0.5; with one class only, the score follows
its smoothed share. Rows that repeat get equal scores. Null labels and null ids are
not learned from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.tables import crc32_mod, map_arrow, stored, text_bytes

CHUNK, STRIDE, STEP, DIM, FILTERS = 512, 448, 4, 8, 24
PAD = 256
WINDOW = 6          # bytes of the windows whose repeats are counted


def chunk_starts(n: int) -> np.ndarray:
    """Starts of chunks that cover n bytes (at least one chunk)."""
    return np.arange(0, max(1, n - CHUNK + STRIDE), STRIDE) if n > CHUNK else np.zeros(1, np.int64)


def chunks_of(text: bytes, at: np.ndarray) -> np.ndarray:
    buf = np.full(int(at[-1]) + CHUNK, PAD, np.int16)
    have = np.frombuffer(text, np.uint8)[: len(buf)]
    buf[: len(have)] = have
    return buf[at[:, None] + np.arange(CHUNK)]


def repeats(x: np.ndarray) -> np.ndarray:
    """Share of the byte windows of each chunk that occur earlier in it."""
    h = np.zeros((len(x), CHUNK - WINDOW + 1), np.uint64)
    real = np.ones(h.shape, bool)
    for k in range(WINDOW):
        part = x[:, k:k + h.shape[1]]
        h = h * np.uint64(263) + part.astype(np.uint64)
        real &= part != PAD
    pads = ~real
    h[pads] = (np.uint64(1) << np.uint64(63)) + np.broadcast_to(np.arange(h.shape[1], dtype=np.uint64), h.shape)[pads]
    h.sort(axis=1)
    return ((h[:, 1:] == h[:, :-1]).sum(axis=1) / np.maximum(real.sum(axis=1), 1)).astype(np.float32)


def respond(x: np.ndarray, w: dict) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of each filter over each chunk, and where it is."""
    blocks = w["emb"][x].reshape(len(x), CHUNK // STEP, STEP * DIM)
    both = blocks @ w["filt"]                                   # first and second half of every window
    r = both[:, :-1, :FILTERS] + both[:, 1:, FILTERS:] + w["fb"]
    at = r.argmax(axis=1)
    top = np.take_along_axis(r, at[:, None, :], axis=1)[:, 0]
    return np.maximum(top, 0), at


def slabs(sizes: list[int], part, slab: int = 512):
    """``part(i, lo, hi)`` of all chunks of documents with so many chunks each, in
    order, as (chunks, the document each belongs to)."""
    held, owners, size = [], [], 0
    for i, n in enumerate(sizes):
        for lo in range(0, n, slab):
            hi = min(n, lo + slab)
            held.append(part(i, lo, hi))
            owners.append(np.full(hi - lo, i))
            size += hi - lo
            if size >= slab:
                yield np.concatenate(held), np.concatenate(owners)
                held, owners, size = [], [], 0
    if size:
        yield np.concatenate(held), np.concatenate(owners)


def _pool(f: np.ndarray, owner: np.ndarray, total: np.ndarray, most: np.ndarray, count: np.ndarray):
    """Adds a slab's features (owners ascend) to the sums, maxima and counts of its texts."""
    who, first = np.unique(owner, return_index=True)
    total[who] += np.add.reduceat(f, first)
    most[who] = np.maximum(most[who], np.maximum.reduceat(f, first))
    count[who] += np.diff(np.append(first, len(owner)))


def train(docs: list[tuple[bytes, int]], steps: int = 400, batch: int = 32, rate: float = 4e-3, seed: int = 7) -> dict:
    """Weights from (chunk bytes as int16 arrays joined, label) pairs."""
    rng = np.random.default_rng(seed)
    ones = sum(y for _, y in docs)
    prior = (ones + 1) / (len(docs) + 2)
    w = {"emb": rng.normal(0, 0.5, (PAD + 1, DIM)), "filt": rng.normal(0, 0.25, (STEP * DIM, 2 * FILTERS)),
         "fb": np.zeros(FILTERS), "out": np.zeros(2 * (FILTERS + 1)), "b": np.array([np.log(prior / (1 - prior))])}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    if not docs or ones in (0, len(docs)):
        return w
    chunks = [np.frombuffer(t, np.int16).reshape(-1, CHUNK) for t, _ in docs]
    again = [np.concatenate([repeats(c[lo:lo + 512]) for lo in range(0, len(c), 512)]) for c in chunks]
    y_all = np.array([y for _, y in docs], np.float32)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v2 = {k: np.zeros_like(v) for k, v in w.items()}
    order: list[int] = []
    for step in range(1, steps + 1):
        while len(order) < batch:
            order += rng.permutation(len(docs)).tolist()
        pick, order = order[:batch], order[batch:]
        k = FILTERS + 1
        sizes = [len(chunks[i]) for i in pick]

        def part(i, lo, hi, pick=pick):
            return chunks[pick[i]][lo:hi]
        share = np.concatenate([again[i] for i in pick])
        total, most, count = np.zeros((batch, k), np.float32), np.full((batch, k), -np.inf, np.float32), np.zeros(batch)
        seen, lo = [], 0            # of each chunk only its responses and their places are kept
        for x, owner in slabs(sizes, part):
            top, at = respond(x, w)
            f = np.column_stack([top, share[lo:lo + len(x)]])
            _pool(f, owner, total, most, count)
            seen.append((f, at.astype(np.int16)))
            lo += len(x)
        d = np.column_stack([total / count[:, None], most])
        p = 1 / (1 + np.exp(-(d @ w["out"] + w["b"][0])))
        e = ((p - y_all[pick]) / len(pick)).astype(np.float32)
        g = {"out": d.T @ e + 1e-4 * w["out"], "b": np.array([e.sum()], np.float32)}
        g |= {name: np.zeros_like(w[name]) for name in ("fb", "filt", "emb")}
        for (x, owner), (f, at) in zip(slabs(sizes, part), seen, strict=True):
            gf = e[owner, None] * w["out"][:k] / count[owner, None]
            gf = gf + e[owner, None] * w["out"][k:] * (f == most[owner])
            gf = (gf[:, :FILTERS] * (f[:, :FILTERS] > 0)).astype(np.float32)
            g["fb"] += gf.sum(axis=0)
            blocks = w["emb"][x].reshape(len(x), CHUNK // STEP, STEP * DIM)
            rows = np.arange(len(x))[:, None]
            left, right = blocks[rows, at], blocks[rows, at + 1]     # chunk x filter x (STEP * DIM)
            g["filt"] += np.concatenate([np.einsum("cf,cfd->df", gf, left), np.einsum("cf,cfd->df", gf, right)], axis=1)
            bytes_ = x.reshape(len(x), CHUNK // STEP, STEP)
            for where, half in ((at, w["filt"][:, :FILTERS]), (at + 1, w["filt"][:, FILTERS:])):
                back = gf[:, :, None] * half.T[None]                 # chunk x filter x (STEP * DIM)
                np.add.at(g["emb"], bytes_[rows, where].reshape(-1), back.reshape(-1, DIM))
        for name, grad in g.items():
            m[name] = 0.9 * m[name] + 0.1 * grad
            v2[name] = 0.999 * v2[name] + 0.001 * grad * grad
            lr = rate * min(1.0, 3 * (1 - step / (steps + 1)))
            w[name] = (w[name] - lr * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v2[name] / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)
    return w


def probabilities(texts: list[bytes], w: dict, slab: int = 512) -> np.ndarray:
    """One probability per whole text; work goes in slabs of chunks, so a text of
    any length needs bounded memory."""
    if not texts:
        return np.empty(0)
    k = FILTERS + 1
    total, most, count = np.zeros((len(texts), k)), np.full((len(texts), k), -np.inf), np.zeros(len(texts))
    starts = [chunk_starts(len(t)) for t in texts]

    def part(i, lo, hi):
        at = starts[i][lo:hi]
        return chunks_of(texts[i][at[0]:at[-1] + CHUNK], at - at[0])
    for x, owner in slabs(list(map(len, starts)), part, slab):
        _pool(np.column_stack([respond(x, w)[0], repeats(x)]), owner, total, most, count)
    d = np.column_stack([total / count[:, None], most])
    return 1 / (1 + np.exp(-np.clip(d @ w["out"] + w["b"][0], -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", key: str = "doc_id", text: str = "text", folds: int = 4,
        held_out: int = 2, max_docs: int = 3000, max_bytes: int = 1 << 26, **kw) -> dict:
    """Weights learned from the labelled rows outside the held-out fold. A key with several
    labels is good only if all say so; of several texts of a key the smallest counts."""
    rows = (labels.where(F.col(target).isNotNull() & F.col(key).isNotNull() & (crc32_mod(key, folds) != held_out))
            .groupBy(F.col(key).alias("__key")).agg(F.min((F.col(target) > 0).cast("int")).alias("__label"))
            .orderBy(F.xxhash64("__key"), "__key").limit(max_docs))
    few = docs.select(key, text_bytes(text).alias("text")).join(F.broadcast(rows), F.col(key) == F.col("__key")).select("__key", "text", "__label")
    few = stored(few, "cnn-sample")
    # whole rows until they have max_bytes together, in the order of the sample; what is
    # asked first are lengths, at most max_docs of them
    sizes = few.groupBy("__key").agg(F.max(F.octet_length("text")).alias("n")).orderBy(F.xxhash64("__key"), "__key").collect()
    before = np.cumsum([0, *(r.n for r in sizes)])[:-1]
    fits = int(np.searchsorted(before, max_bytes))
    if fits < len(sizes):
        last = sizes[fits]["__key"]
        few = few.where(F.xxhash64("__key") < F.xxhash64(F.lit(last).cast(dict(rows.dtypes)["__key"])))
    sample = few.groupBy("__key").agg(F.min(F.struct("text", "__label")).alias("s")).select("__key", "s.text", "s.__label").collect()
    sample = sorted(sample, key=lambda r: (str(r[0]), r[2]))
    return train([(chunks_of(r[1], chunk_starts(len(r[1]))).tobytes(), int(r[2])) for r in sample], **kw)


def score(docs: DataFrame, weights: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score): probability of label 1 for each row, from its whole text only."""
    def run(batches):
        for b in batches:
            p = probabilities(b.column(1).to_pylist(), weights)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64())], names=[key, "score"])
    return map_arrow(docs.select(key, text_bytes(text).alias("text")), run, f"`{key}` {dict(docs.dtypes)[key]}, score double")


def keep_good(docs: DataFrame, weights: dict, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Rows of ``docs`` that score at least ``threshold``; the text goes to Python and
    the verdict comes back beside its row, so no join is needed."""
    at = docs.columns.index(text)

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column(at).cast(pa.binary()).to_pylist()]
            keep = pa.array(probabilities(texts, weights) >= threshold)
            del texts
            yield b.filter(keep)
    return map_arrow(docs, run, ", ".join(f"`{c}` {t}" for c, t in docs.dtypes))
