"""Alignment of two tokenisers' outputs by divide and conquer at shared cuts.

Both tokenisers cover the same bytes (a space and the text). A byte offset where a
token of A and a token of B both end is a shared cut. To find all of them, an
interval of A's tokens is split at the common end nearest its middle, found by
bisecting B's ends; both halves are treated alike, and an interval without a common
end inside is a leaf: one group of A tokens that stand for one group of B tokens. All
intervals of a slab of texts are probed at once, one numpy step for a level.

The last tokens of a group end together and are linked. Links are counted over
the whole corpus per pair of ids. Texts are tokenised and aligned once, into a
table with a row number and the links of each text; Spark counts the pairs from it.
The counts of the ``hot`` most frequent pairs (a bound) go to the tasks as sorted
arrays; links of rarer pairs, which no key can dominate, are joined with the table of
counts. Results do not depend on the bound.

Null and empty texts, and texts that one of the tokenisers does not give back byte
by byte (such as those with U+2581), have no tokens: zeros, and an empty digest.
Repeated rows are answered each and count each. An empty table gives no rows. Texts
of any length are aligned whole.
"""

from __future__ import annotations

import base64
import hashlib
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.tables import map_arrow, slabs, stored, text_bytes

VOCAB_A, VOCAB_B = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
HOT_PAIRS = 1 << 20
SLAB = 1 << 20          # bytes of text aligned together
STEPS = 16              # probes of a level before an interval is searched alone


class _Vocabulary:
    """Token bytes by id as one blob, and the ids' decimal forms."""

    def __init__(self, tokens: list[bytes], end: str):
        self.n = len(tokens)
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.text = np.array([f"{i}{mark}".encode() for mark in (",", end) for i in range(self.n)], object)

    def joined(self, ids: np.ndarray) -> bytes:
        n = self.length[ids]
        at = np.repeat(self.offset[ids] - (np.cumsum(n) - n), n)
        at += np.arange(len(at))
        return self.blob[at].tobytes()


class Aligner:
    def __init__(self, a_path: str, b_path: str, pattern: str):
        import sentencepiece
        import tiktoken
        with open(a_path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.encode_a = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        tokens = [b""] * (1 + max(ranks.values()))
        for t, r in ranks.items():
            tokens[r] = t
        self.a = _Vocabulary(tokens, "|")
        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b = _Vocabulary([bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else
                              sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())], ";")

    def tokenised(self, texts: list[bytes]):
        """Ids of A and of B of all texts, and how many each text has; texts that do
        not come back byte by byte have none."""
        plain = [t.decode("utf-8", "replace") for t in texts]
        ids_a = [np.array(self.encode_a(" " + t) if t else [], np.int64) for t in plain]
        ids_b = [np.array(x, np.int64) for x in self.model.encode(plain, num_threads=1)]
        kept = []
        for side, ids in ((self.a, ids_a), (self.b, ids_b)):
            n = np.array([len(x) for x in ids], np.int64)
            flat = np.concatenate([np.empty(0, np.int64), *ids])
            back = side.joined(flat)
            ends = np.concatenate(([0], np.cumsum(side.length[flat])))[np.concatenate(([0], np.cumsum(n)))].tolist()
            good = [bool(t) and back[s:e] == b" " + t for t, s, e in zip(texts, ends, ends[1:])]
            kept.append((n, flat, np.array(good, bool)))
        both = kept[0][2] & kept[1][2]
        return [(flat[np.repeat(both, n)], np.where(both, n, 0)) for n, flat, _ in kept]

    def aligned(self, texts: list[bytes]):
        """(ids, counts per text) of A and of B, and the ends of the groups as token
        counts in A, in B and in texts."""
        (a, n_a), (b, n_b) = self.tokenised(texts)
        ends_a, ends_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
        inner = shared_cuts(ends_a, ends_b, last_a - n_a, last_a, last_b - n_b, last_b)
        cut_a = np.sort(np.concatenate((inner, last_a[n_a > 0])))
        cut_b = np.searchsorted(ends_b, ends_a[cut_a - 1]) + 1
        return (a, n_a), (b, n_b), (cut_a, cut_b, np.searchsorted(cut_a, last_a, side="right"))

    def digests(self, texts: list[bytes]):
        """Per text: number of A and B tokens, end of its groups, digest of its groups;
        and the linked pair of every group as ``a * size of B + b``."""
        (a, n_a), (b, n_b), (cut_a, cut_b, groups) = self.aligned(texts)
        before_a, before_b = np.concatenate(([0], cut_a)), np.concatenate(([0], cut_b))
        in_a = np.repeat(np.arange(len(cut_a)), np.diff(before_a))
        in_b = np.repeat(np.arange(len(cut_b)), np.diff(before_b))
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[cut_a - 1] = ends_b[cut_b - 1] = 1
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + before_b[in_a]] = self.a.text[a + self.a.n * ends_a]
        out[np.arange(len(b)) + before_a[in_b + 1]] = self.b.text[b + self.b.n * ends_b]
        stop = np.cumsum(n_a + n_b).tolist()
        digest = [hashlib.sha256(b"".join(out[s:e].tolist())[:-1]).hexdigest() if e > s else "" for s, e in zip([0, *stop], stop)]
        return n_a, n_b, groups, digest, a[cut_a - 1] * self.b.n + b[cut_b - 1]


def _common(ends_a, ends_b, at):
    """Where the ends before the boundaries ``at`` are ends of B too, and B's boundary."""
    x = ends_a[at - 1]
    j = np.minimum(np.searchsorted(ends_b, x), len(ends_b) - 1)
    return ends_b[j] == x, j + 1


def _nearest(ends_a, ends_b, lo: int, hi: int) -> tuple[int, int] | None:
    """The common end nearest the middle of one interval, looking ever wider."""
    mid, reach = (lo + hi) // 2, STEPS
    while True:
        left, right = max(lo + 1, mid - reach), min(hi, mid + reach + 1)
        at = np.arange(left, right)
        same, j = _common(ends_a, ends_b, at)
        if same.any():
            i = int(np.abs(at[same] - mid).argmin())
            return int(at[same][i]), int(j[same][i])
        if left == lo + 1 and right == hi:
            return None
        reach *= 4


def shared_cuts(ends_a, ends_b, a_lo, a_hi, b_lo, b_hi) -> np.ndarray:
    """Boundaries inside the intervals [a_lo, a_hi) of A's tokens (covering the same bytes
    as [b_lo, b_hi) of B's) where both have a token end, in no order.

    ``step`` numbers an interval's probes: the middle, then one to the right, one
    to the left and so on."""
    found = []
    now = np.stack([a_lo, a_hi, b_lo, b_hi, np.zeros_like(a_lo)]).astype(np.int64)
    while True:
        now = now[:, (now[1] - now[0] > 1) & (now[3] - now[2] > 1)]     # others have no cut inside
        if not now.shape[1]:
            return np.concatenate(found) if found else np.empty(0, np.int64)
        lo, hi, blo, bhi, step = now
        at = (lo + hi) // 2 + np.where(step % 2 == 1, (step + 1) // 2, -(step // 2))
        same, j = _common(ends_a, ends_b, at)
        late = np.flatnonzero(~same & (step == STEPS) & (step + 2 < hi - lo))
        go_on = ~same & (step + 2 < hi - lo) & (step < STEPS)
        alone = []
        for i in late.tolist():
            got = _nearest(ends_a, ends_b, int(lo[i]), int(hi[i]))
            if got:
                found.append(np.array(got[:1]))
                alone += [(lo[i], got[0], blo[i], got[1], 0), (got[0], hi[i], got[1], bhi[i], 0)]
        cut, bcut, none = at[same], j[same], np.zeros(int(same.sum()), np.int64)
        found.append(cut)
        now = np.concatenate([np.stack([lo[same], cut, blo[same], bcut, none]), np.stack([cut, hi[same], bcut, bhi[same], none]),
                              now[:, go_on] + np.array([[0], [0], [0], [0], [1]]),
                              np.array(alone, np.int64).reshape(-1, 5).T], axis=1)


@lru_cache(maxsize=1)
def aligner(vocab_a: str = VOCAB_A, vocab_b: str = VOCAB_B) -> Aligner:
    """The worker's aligner; vocabularies are paths, or names of the installed files."""
    import public_tokenizers
    place = [v if os.path.sep in v else public_tokenizers.path(v) for v in (vocab_a, vocab_b)]
    return Aligner(*place, public_tokenizers.PATTERN)


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", vocab_a: str = VOCAB_A, vocab_b: str = VOCAB_B) -> DataFrame:
    """(key, groups): every text's groups in order, each with its A ids and B ids."""
    ids = pa.list_(pa.int32())
    kind = pa.struct([("a", ids), ("b", ids)])

    def run(batches):
        al = aligner(vocab_a, vocab_b)
        for batch in batches:
            for part in slabs(batch, 1, SLAB):
                (a, _), (b, _), (cut_a, cut_b, stop) = al.aligned(part.column(1).to_pylist())
                sides = [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], c)), pa.int32()), pa.array(x, pa.int32())) for c, x in ((cut_a, a), (cut_b, b))]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], stop)), pa.int32()), pa.StructArray.from_arrays(sides, fields=list(kind)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[key, "groups"])
    return map_arrow(df.select(key, text_bytes(text).alias("text")), run, f"`{key}` {dict(df.dtypes)[key]}, groups array<struct<a:array<int>,b:array<int>>>")


def linked(df: DataFrame, key: str = "doc_id", text: str = "text", vocab_a: str = VOCAB_A, vocab_b: str = VOCAB_B) -> tuple[DataFrame, int]:
    """A written table (row, id, n_a, n_b, groups_sha256, links) and B's number of ids;
    ``links`` holds ``a * that number + b`` for each group."""
    al = aligner(vocab_a, vocab_b)
    small = al.a.n * al.b.n < 1 << 31
    link = pa.int32() if small else pa.int64()

    def run(batches):
        al = aligner(vocab_a, vocab_b)
        for batch in batches:
            for part in slabs(batch, 2, SLAB):
                n_a, n_b, stop, digest, pairs = al.digests(part.column(2).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], stop)), pa.int32()), pa.array(pairs, link))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n_a), pa.array(n_b), pa.array(digest), lists],
                                                 names=["row", "id", "n_a", "n_b", "groups_sha256", "links"])
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), text_bytes(text).alias("text"))
    return stored(map_arrow(rows, run, f"row bigint, id {dict(df.dtypes)[key]}, n_a bigint, n_b bigint, groups_sha256 string, "
                                       f"links array<{'int' if small else 'bigint'}>"), "links"), al.b.n


def pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """Written table (pair, n, best): links of each pair in the corpus; ``best`` where
    no pair of the same B id has more."""
    counts = stored(rows.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    most = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("most"))
    return stored(counts.withColumn("b", F.col("pair") % n_b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs-best")


def alignment(df: DataFrame, key: str = "doc_id", text: str = "text", vocab_a: str = VOCAB_A, vocab_b: str = VOCAB_B, hot: int = HOT_PAIRS) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    rows, size_b = linked(df, key, text, vocab_a, vocab_b)
    counts = pair_counts(rows, size_b)
    top = counts.orderBy(F.desc("n"), "pair").limit(hot).orderBy("pair").toArrow()      # at most ``hot`` rows
    pair, n, best = (top.column(c).to_numpy() for c in ("pair", "n", "best"))
    all_hot = counts.count() <= hot
    shared = df.sparkSession.sparkContext.broadcast((pair, n, best.astype(np.int64)))
    link = rows.schema["links"].dataType.simpleString()

    def run(batches):
        pair, n, best = shared.value
        for batch in batches:
            for part in slabs(batch, 5, 4 * SLAB):
                links = part.column(5).flatten().to_numpy(zero_copy_only=False)
                stop = np.cumsum(part.column(5).value_lengths().to_numpy(zero_copy_only=False))
                i = np.minimum(np.searchsorted(pair, links), max(len(pair) - 1, 0))
                known = pair[i] == links if len(pair) else np.zeros(len(links), bool)
                sums = []
                for values in (best, n, None):
                    each = ~known if values is None else np.where(known, values[i], 0) if len(pair) else np.zeros(len(links), np.int64)
                    sums.append(np.concatenate(([0], np.cumsum(each, dtype=np.int64)))[np.concatenate(([0], stop))])
                rare = pa.ListArray.from_arrays(pa.array(sums[2], pa.int32()), pa.array(links[~known]))
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(np.diff(stop, prepend=0).astype(np.int64)), pa.array(np.diff(sums[0])), pa.array(np.diff(sums[1])),
                                                  part.column(4), rare], names=names)
    names = ["row", "id", "n_a", "n_b", "n_links", "n_best", "count_sum", "groups_sha256", "rare"]
    scored = map_arrow(rows, run, f"row bigint, id {dict(df.dtypes)[key]}, n_a bigint, n_b bigint, n_links bigint, n_best bigint, "
                                  f"count_sum bigint, groups_sha256 string, rare {link}")
    if not all_hot:
        scored = stored(scored, "scored")
        rest = (scored.select("row", F.explode("rare").alias("pair")).join(counts, "pair").groupBy("row")
                .agg(F.sum(F.col("best").cast("bigint")).alias("more_best"), F.sum("n").alias("more")))
        scored = (scored.join(rest, "row", "left").withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
                  .withColumn("count_sum", F.col("count_sum") + F.coalesce("more", F.lit(0))))
    return scored.select(F.col("id").alias(key), "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256")
