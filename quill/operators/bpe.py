"""Byte-pair-encoding jobs: pre-tokenize, count, train, encode, report.

Plan shapes:

* Pre-tokenization is a native ``regexp_extract_all`` with ``(?U)`` so Java's
  ``\\s``/``\\p{L}`` follow Unicode, no Python.
* Training works on the *distinct* chunk table (chunk, count). Each round is
  one Spark job: pair counts (partial + final hash aggregate) and, from the
  same shuffle, the top candidates plus per-token neighbourhood maxima. The
  driver only sees result-sized rows (bounded by ``max_candidates`` and the
  vocabulary size) and decides an *exact* batch of merges: a pair is accepted
  after the leader while it shares no joint token with an accepted pair and
  its count strictly beats every pair next to an accepted pair (new pairs are
  bounded by those). Words travel in blocks of many thousands, as one array of ids with
  a mark after each word; a task merges a block, and finds what that does to the
  pair counts, in a few array operations.
* Encoding is map-only: Arrow batches of chunks are encoded in array operations, each
  distinct chunk of a run once, and workers keep the ids of many chunks (a bound).
  Decoding takes the token bytes of a whole batch at once. Counting tokens multiplies
  chunk counts by the token length of each distinct chunk, so token arrays are never built.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.functions.text import SPECIAL_TOKENS, SPLIT_PATTERN, java_pattern
from quill.plans.spread import spread
from quill.session import ensure_checkpoint_dir, reliable_checkpoint, ship_package

# ---------------------------------------------------------------------------
# D1 / D2 / D3


def pretokenize_col(col, pattern: str = SPLIT_PATTERN) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit(java_pattern(pattern)), 1)


def pretokenize(df: DataFrame, text: str = "text", pattern: str = SPLIT_PATTERN,
                out: str = "chunks") -> DataFrame:
    """Add ``chunks ARRAY<STRING>``."""
    return df.withColumn(out, pretokenize_col(text, pattern))


def chunk_counts(df: DataFrame, text: str = "text", pattern: str = SPLIT_PATTERN) -> DataFrame:
    """``(chunk, cnt)`` over all texts (partial + final hash aggregate)."""
    return (spread(df.select(text)).select(F.explode(pretokenize_col(text, pattern)).alias("chunk"))
            .groupBy("chunk").agg(F.count(F.lit(1)).alias("cnt")))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _utf8_ids(text: pa.Array) -> pa.Array:
    data, ends, _ = _utf8(text)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(data.astype(np.int32)), mask=text.is_null())


def _utf8(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings, where each starts (and the last ends), and their sizes."""
    raw = pc.fill_null(text.cast(pa.large_binary()), b"")
    _, ends, data = raw.buffers()
    ends = np.frombuffer(ends, np.int64)[raw.offset:raw.offset + len(raw) + 1] if len(raw) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data else np.zeros(0, np.uint8)
    return data, ends - ends[0], np.diff(ends)


def byte_ids(col) -> Column:
    """UTF-8 bytes of a string as ``ARRAY<INT>``."""
    return _utf8_ids(F.col(col) if isinstance(col, str) else col)


def words_from_chunks(counts: DataFrame) -> DataFrame:
    """``(chunk, cnt)`` → ``(chunk, ids ARRAY<INT>, cnt)``."""
    return counts.select("chunk", byte_ids("chunk").alias("ids"), F.col("cnt").cast("long").alias("cnt"))


def pair_counts(words: DataFrame, ids: str = "ids", cnt: str = "cnt") -> DataFrame:
    """D3: weighted adjacent pair counts, overlaps included. Each batch of words is added up
    before rows leave it."""
    def count(batches):
        for b in batches:
            values, first, many = _lists(b.column(0))
            x = np.full(len(values) + len(many), _END, np.int32)
            x[np.arange(len(values)) + np.repeat(np.arange(len(many)), many)] = values.to_numpy(zero_copy_only=False)
            pairs, n = _summed(*_pairs(x, b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(pairs >> 32, pa.int32()), pa.array(pairs & 0xFFFFFFFF, pa.int32()), pa.array(n)], names=["left", "right", "cnt"])
    ship_package(words.sparkSession)
    rows = words.where(F.size(ids) >= 2).select(F.col(ids).cast("array<int>"), F.coalesce(F.col(cnt).cast("long"), F.lit(0)))
    return rows.mapInArrow(count, "left int, right int, cnt bigint").groupBy("left", "right").agg(F.sum("cnt").alias("cnt"))


# ---------------------------------------------------------------------------
# D4 training

TRAIN_STATS: dict[str, int] = {}

# Merge tables and vocabularies are result-sized (bounded by the vocabulary
# size); they are collected or shipped only after this bound is checked.
MAX_VOCAB_ROWS = 1 << 21


def _bounded_collect(df: DataFrame, what: str):
    rows = df.limit(MAX_VOCAB_ROWS + 1).collect()
    if len(rows) > MAX_VOCAB_ROWS:
        raise ValueError(f"{what} exceeds {MAX_VOCAB_ROWS} rows; not a vocabulary-sized table")
    return rows

def _to_tokstr(arr: Column) -> Column:
    """Token ids as ``<97><98><99>``: every token owns its delimiters, so a
    literal left-to-right replace of ``<a><b>`` is exactly one BPE merge
    (non-overlapping, runs like ``aaaa`` included)."""
    return F.concat(F.lit("<"), F.array_join(arr, "><"), F.lit(">"))


def _tokstr_ids(s: Column) -> Column:
    return F.transform(F.regexp_extract_all(s, F.lit("<([0-9]+)>"), 1), lambda x: x.cast("int"))


def select_batch(top: list[tuple[int, int, int]], truncated: bool,
                 max_merges: int) -> list[tuple[int, int, int]]:
    """Exact batch of merges from the top candidates sorted by (-count, left, right).

    After the leader, a pair is accepted while it shares no joint token with
    an accepted pair (so its count is untouched by their merges) and its count
    strictly beats ``ub``: every pair next to an accepted pair (ending in its
    left token or starting with its right token) — any pair a merge creates
    is bounded by such a pair. Neighbours come from the candidate list; when
    the list was cut at K pairs, unseen pairs are bounded by the K-th count.
    """
    max_right: dict[int, int] = {}
    max_left: dict[int, int] = {}
    for left, right, cnt in top:
        max_right[right] = max(max_right.get(right, -1), cnt)
        max_left[left] = max(max_left.get(left, -1), cnt)
    floor = top[-1][2] if truncated and top else -1
    accepted: list[tuple[int, int, int]] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    ub = -1
    for left, right, cnt in top:
        if len(accepted) >= max_merges:
            break
        if accepted:
            if right in lefts or left in rights or cnt <= ub:
                break
        accepted.append((left, right, cnt))
        lefts.add(left)
        rights.add(right)
        ub = max(ub, max_right.get(left, -1), max_left.get(right, -1), floor)
    return accepted


_END = -1               # follows each word of a block
BLOCK_IDS = 1 << 20     # ids of a block, and a batch of words
_BLOCK = "ids binary, cnt binary, pairs array<bigint>, moves array<bigint>"


def _pairs(x: np.ndarray, cnt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours in the words of a block as ``left << 32 | right``, and their words' counts."""
    at = np.flatnonzero((x[:-1] != _END) & (x[1:] != _END))
    word = np.cumsum(x == _END)[at]
    return x[at].astype(np.int64) << 32 | x[at + 1].astype(np.int64), cnt[word]


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, ascending, and the exact sums of their values. Pairs of few tokens add up in a
    table of all their pairs, others are sorted."""
    rights = int((keys & 0xFFFFFFFF).max()) + 1 if len(keys) else 0
    cells = (int(keys.max() >> 32) + 1) * rights if len(keys) else 0
    if 0 < cells <= max(4 * len(keys), 1 << 16) and keys.min() >= 0:
        code = (keys >> 32) * rights + (keys & 0xFFFFFFFF)
        total, seen = np.zeros(cells, np.int64), np.zeros(cells, bool)
        np.add.at(total, code, values)
        seen[code] = True
        at = np.flatnonzero(seen)
        return at // rights << 32 | at % rights, total[at]
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values, first) if len(first) else values


def _merge_block(x: np.ndarray, left: int, right: int, new_id: int) -> tuple[np.ndarray, np.ndarray]:
    """One merge in all words of a block, left to right, and where it took place in ``x``."""
    at = np.flatnonzero((x[:-1] == left) & (x[1:] == right))
    if left == right and len(at):       # of a run, every second one
        start = np.append(True, np.diff(at) != 1)
        at = at[(np.arange(len(at)) - np.flatnonzero(start)[np.cumsum(start) - 1]) % 2 == 0]
    if not len(at):
        return x, at
    out = x.copy()
    out[at] = new_id
    keep = np.ones(len(x), bool)
    keep[at + 1] = False
    return out[keep], at


def _block(x: np.ndarray, cnt: np.ndarray, pairs: np.ndarray, moves: np.ndarray) -> pa.RecordBatch:
    """A block without its words of one token, which can never pair again."""
    end = np.flatnonzero(x == _END)
    size = np.diff(end, prepend=-1)
    more = size > 2
    x = x[np.repeat(more, size)].astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([cnt[more].tobytes()], pa.binary()),
                                       pa.array([pairs], pa.list_(pa.int64())), pa.array([moves], pa.list_(pa.int64()))], names=["ids", "cnt", "pairs", "moves"])


def _blocks(counts: DataFrame) -> DataFrame:
    """``(chunk, cnt)`` as blocks of words of bytes, with the counts of their pairs."""
    def build(batches):
        xs, cnts, held = [], [], 0

        def flush():
            x, cnt = np.concatenate(xs), np.concatenate(cnts)
            return _block(x, cnt, *_summed(*_pairs(x, cnt)))
        for b in batches:
            data, _, size = _utf8(b.column(0))
            x = np.full(len(data) + len(size), _END, np.int32)
            x[np.arange(len(data)) + np.repeat(np.arange(len(size)), size)] = data
            xs.append(x)
            cnts.append(b.column(1).to_numpy(zero_copy_only=False).astype(np.int64))
            held += len(x)
            if held >= BLOCK_IDS:
                yield flush()
                xs, cnts, held = [], [], 0
        if xs:
            yield flush()
    ship_package(counts.sparkSession)
    return counts.select("chunk", F.col("cnt").cast("long")).mapInArrow(build, _BLOCK)


def _merged_blocks(blocks: DataFrame, merges: list[tuple[int, int, int]]) -> DataFrame:
    """Blocks after these merges in order, and how the pair counts of their words moved."""
    def step(batches):
        for b in batches:
            for ids, weight in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x, cnt = np.frombuffer(ids, np.int32), np.frombuffer(weight, np.int64)
                old, changed = x, np.zeros(len(cnt), bool)
                for merge in merges:
                    after, at = _merge_block(x, *merge)
                    if len(at):
                        changed[np.searchsorted(np.flatnonzero(x == _END), at)] = True
                    x = after
                moved = [_pairs(_words_of(y, changed), cnt[changed]) for y in (old, x)]
                keys, moves = _summed(np.concatenate((moved[0][0], moved[1][0])), np.concatenate((-moved[0][1], moved[1][1])))
                yield _block(x, cnt, keys[moves != 0], moves[moves != 0])
    return blocks.select("ids", "cnt").mapInArrow(step, _BLOCK)


def _words_of(x: np.ndarray, keep: np.ndarray) -> np.ndarray:
    return x[np.repeat(keep, np.diff(np.flatnonzero(x == _END), prepend=-1))]


def _moves(blocks: DataFrame) -> DataFrame:
    return blocks.select(F.explode(F.arrays_zip("pairs", "moves")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.moves").alias("cnt"))


def _top_pairs(pairs: DataFrame, limit: int) -> DataFrame:
    each = pairs.select(F.shiftright("pair", 32).cast("int").alias("left"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("right"), "cnt")
    return each.orderBy(F.desc("cnt"), "left", "right").limit(limit)


def train_bpe(texts: DataFrame, vocab_size: int, text: str = "text",
              pattern: str = SPLIT_PATTERN, special_tokens: list[str] | None = None,
              max_candidates: int = 4096, checkpoint_every: int = 6,
              counts: DataFrame | None = None) -> DataFrame:
    """D4 (*action*): greedy BPE merges → ``(rank, left, right, new_id, cnt)``.

    ``vocab_size`` includes the special tokens; ``vocab_size - len(specials)``
    must be ≥ 256. Stops early when no pair is left (vocabulary shrinks).
    The distinct-word table, in blocks, is the only data-sized state; it is cached per
    round and cut from its lineage with a reliable checkpoint (in the
    cluster's ``spark.checkpoint.dir``) every ``checkpoint_every`` rounds, so
    a lost executor recomputes at most that many cheap map-only rounds.
    """
    spark = texts.sparkSession
    specials = SPECIAL_TOKENS if special_tokens is None else special_tokens
    n_merges = vocab_size - len(specials) - 256
    if n_merges < 0:
        raise ValueError("vocab_size minus specials must be at least 256")
    ensure_checkpoint_dir(spark)
    if counts is None:
        counts = chunk_counts(texts, text, pattern)
    # spread the distinct words over every core: AQE would otherwise coalesce a small
    # table to one task
    n_parts = max(spark.sparkContext.defaultParallelism,
                  int(spark.conf.get("spark.sql.shuffle.partitions")))
    words = reliable_checkpoint(_blocks(counts.where(F.octet_length("chunk") >= 2).repartition(n_parts)))
    pairs = reliable_checkpoint(_moves(words).groupBy("pair").agg(F.sum("cnt").alias("cnt")))
    merges: list[tuple[int, int, int, int, int]] = []
    rnd = 0
    TRAIN_STATS.clear()
    spent: list[DataFrame] = []         # cached inputs of the tables of this round
    while len(merges) < n_merges:
        rows = _top_pairs(pairs, max_candidates).collect()   # ≤ max_candidates rows
        for old in spent:               # both tables are cached now
            old.unpersist()
        spent = []
        cand = sorted(((r.left, r.right, r.cnt) for r in rows), key=lambda t: (-t[2], t[0], t[1]))
        if not cand:
            break
        batch = select_batch(cand, len(cand) >= max_candidates, n_merges - len(merges))
        for left, right, cnt in batch:
            merges.append((len(merges), left, right, 256 + len(merges), cnt))
        rnd += 1
        if len(merges) >= n_merges:
            break
        # only words that a merge changes move the pair counts
        stepped = _merged_blocks(words, [m[1:4] for m in merges[-len(batch):]]).persist()
        counted = pairs.unionByName(_moves(stepped)).groupBy("pair").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") > 0)
        if rnd % checkpoint_every == 0:
            counted = reliable_checkpoint(counted)
            left_over = reliable_checkpoint(stepped)
            for old in (words, pairs, stepped):
                old.unpersist()
            words, pairs = left_over, counted
        else:
            spent = [words, pairs]
            words, pairs = stepped, counted.persist()
    for old in (*spent, words, pairs):
        old.unpersist()
    TRAIN_STATS.update(rounds=rnd, merges=len(merges))
    schema = "rank INT, left INT, right INT, new_id INT, cnt LONG"
    return spark.createDataFrame(merges, schema)


# ---------------------------------------------------------------------------
# D5 / D6 / D7 vocabulary tables


def apply_merges_col(ids: Column, merges: list[tuple[int, int, int]]) -> Column:
    """Apply ``(left, right, new_id)`` merges in order, left-to-right, non-overlapping.

    One fold over a literal array of steps: the expression's depth does not grow
    with the number of merges."""
    if not merges:
        return _tokstr_ids(_to_tokstr(ids))
    steps = F.from_json(F.lit(json.dumps([[f"<{a}><{b}>", f"<{c}>"] for a, b, c in merges])), "array<array<string>>")
    return _tokstr_ids(F.aggregate(steps, _to_tokstr(ids), lambda s, m: F.replace(s, m[0], m[1])))


def mergeable_ranks(merges: DataFrame) -> DataFrame:
    """``(token_id, token_bytes BINARY)`` for the 256 bytes plus each merge.

    The merge table is result-sized (≤ vocabulary); bytes are built low → high.
    """
    rows = sorted(_bounded_collect(merges.select("new_id", "left", "right"), "merge table"))
    table: dict[int, bytes] = {i: bytes([i]) for i in range(256)}
    for new_id, left, right in rows:
        table[new_id] = table[left] + table[right]
    spark = merges.sparkSession
    return spark.createDataFrame(sorted(table.items()), "token_id INT, token_bytes BINARY")


def add_special_tokens(ranks: DataFrame, specials: list[str] | None = None) -> DataFrame:
    """Vocabulary ``(token_id, token_bytes, special)``; specials follow the ranks."""
    specials = SPECIAL_TOKENS if specials is None else specials
    spark = ranks.sparkSession
    sp = spark.createDataFrame([(i, s) for i, s in enumerate(specials)], "i INT, special STRING")
    offset = ranks.agg(F.count(F.lit(1))).scalar()
    sp = sp.select(
        (offset + F.col("i")).cast("int").alias("token_id"),
        F.encode("special", "UTF-8").alias("token_bytes"), "special")
    return ranks.withColumn("special", F.lit(None).cast("string")).unionByName(sp)


def special_id(vocab: DataFrame, name: str) -> int | None:
    """Lookup by exact text, None if absent (a one-row action)."""
    r = vocab.where(F.col("special") == name).select("token_id").take(1)
    return r[0][0] if r else None


# ---------------------------------------------------------------------------
# D8 encode / D9 decode


CHUNK_CACHE = 1 << 18   # chunks whose ids a worker keeps
SHORT_BYTES = 64        # longer chunks are encoded one by one
RUN_CHUNKS = 1 << 20    # chunks encoded at once
RUN_WORDS = 1 << 17     # distinct chunks encoded at once


def _ranks_dict(merges_rows) -> dict[tuple[int, int], int]:
    return {(int(l), int(r)): int(n) for l, r, n in merges_rows}


def _encode_chunk(chunk: str, merged: dict[tuple[int, int], int]) -> list[int]:
    """Ids of one chunk: the bytes form a linked list, every mergeable neighbour
    pair waits in a heap by (merged id, place), and a merge adds the at most two
    pairs it creates. O(n log n) in the bytes of the chunk."""
    token = list(chunk.encode("utf-8"))
    n = len(token)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    waiting = [(m, i, token[i], token[i + 1]) for i in range(n - 1)
               if (m := merged.get((token[i], token[i + 1]))) is not None]
    heapq.heapify(waiting)
    while waiting:
        m, i, left, right = heapq.heappop(waiting)
        j = after[i]
        if token[i] != left or j >= n or token[j] != right:
            continue            # an earlier merge took one of the two
        token[i], token[j] = m, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (x := merged.get((token[a], token[b]))) is not None:
                heapq.heappush(waiting, (x, a, token[a], token[b]))
    return [t for t in token if t >= 0]


def _encode_block(x: np.ndarray, keys: np.ndarray, new: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All words of a block (ids with ``_END`` after each) by as many passes as its longest
    chain of merges: each does, in every word, the word's merge of lowest id, left to
    right. ``keys`` are the pairs as in ``_pairs``, ascending. Gives (word, ids, number of ids) in parts."""
    none = np.iinfo(np.int32).max
    word = np.arange(np.count_nonzero(x == _END))
    done = []
    while len(word):
        pair = x[:-1].astype(np.int64) << 32 | x[1:].astype(np.int64)
        k = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        rank = np.append(np.where(keys[k] == pair, new[k], none) if len(keys) else np.full(len(pair), none), none).astype(np.int32)
        end = np.flatnonzero(x == _END)
        first = np.append(0, end[:-1] + 1)
        low, size = np.minimum.reduceat(rank, first), end - first + 1
        more = low != none
        keep = np.repeat(more, size)
        over = x[~keep]
        done.append((word[~more], over[over != _END], size[~more] - 1))
        word, x, rank = word[more], x[keep], rank[keep]
        at = np.flatnonzero(rank == np.repeat(low[more], size[more]))
        if len(at):     # of a run of one token, every second pair
            start = np.append(True, np.diff(at) != 1)
            at = at[(np.arange(len(at)) - np.flatnonzero(start)[np.cumsum(start) - 1]) % 2 == 0]
            x[at] = rank[at]
            x = np.delete(x, at + 1)
    return done


class _Encoder:
    """Ids of chunks in a Python worker. Those of chunks met before are kept up to a bound."""

    def __init__(self, table, keep: int):
        self.ranks, self.keep = _ranks_dict(table), keep
        pairs = np.array(sorted((left << 32 | right, new) for (left, right), new in self.ranks.items()), np.int64).reshape(-1, 2)
        self.keys, self.new = pairs[:, 0].copy(), pairs[:, 1].copy()
        self.forget()

    def forget(self) -> None:
        self.known, self.ids = pa.array([], pa.string()), np.zeros(0, np.int32)
        self.start = self.size = np.zeros(0, np.int64)

    def learn(self, words: pa.Array) -> None:
        """Words, each once and none of them known."""
        data, start, size = _utf8(words)
        n, parts = len(words), []
        short = np.flatnonzero(size <= SHORT_BYTES)
        many = size[short]
        x = np.full(many.sum() + len(short), _END, np.int32)
        x[np.arange(many.sum()) + np.repeat(np.arange(len(short)), many)] = data[_ragged(start[short], many)]
        for word, ids, count in _encode_block(x, self.keys, self.new):
            parts.append((short[word], ids, count))
        for w in np.flatnonzero(size > SHORT_BYTES):
            ids = _encode_chunk(words[int(w)].as_py(), self.ranks)
            parts.append((np.array([w]), np.array(ids, np.int32), np.array([len(ids)])))
        if not parts:
            return
        word, ids, count = (np.concatenate(p) for p in zip(*parts))
        begin, length = np.zeros(n, np.int64), np.zeros(n, np.int64)
        begin[word], length[word] = np.cumsum(count) - count + len(self.ids), count
        self.known = pa.concat_arrays([self.known, words])
        self.ids = np.concatenate((self.ids, ids))
        self.start, self.size = np.append(self.start, begin), np.append(self.size, length)

    def __call__(self, rows: pa.Array) -> pa.Array:
        """Lists of chunks -> lists of ids, by runs of rows with few chunks."""
        chunks, first, many = _lists(rows)
        ends = first + many
        parts, counts, row = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
        while row < len(rows):
            stop = max(row + 1, int(np.searchsorted(ends, first[row] + RUN_CHUNKS, side="right")))
            run = chunks.slice(first[row], ends[stop - 1] - first[row])
            code = pc.index_in(run, self.known)
            if code.null_count:
                self.learn(pc.unique(run.filter(code.is_null())))
                code = pc.index_in(run, self.known)
            code = code.to_numpy(zero_copy_only=False)
            parts.append(self.ids[_ragged(self.start[code], self.size[code])])
            total = np.concatenate(([0], np.cumsum(self.size[code])))
            counts.append(total[ends[row:stop] - first[row]] - total[first[row:stop] - first[row]])
            row = stop
            if len(self.known) > self.keep:
                self.forget()           # costs time only
        return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(counts)), pa.int32()), pa.array(np.concatenate(parts)))


_WORKER_CACHE: dict = {}


def _cached_encoder(key, table) -> _Encoder:
    """Per-Python-worker encoder of one merge table."""
    st = _WORKER_CACHE.get(key)
    if st is None:
        _WORKER_CACHE.clear()   # one table at a time per worker
        st = _WORKER_CACHE[key] = _Encoder(table, key[1])
    return st


def _merge_table(merges: DataFrame) -> tuple[list[tuple[int, int, int]], int]:
    """Merges (bounded by the vocabulary) as (left, right, new id), and their hash."""
    table = [(int(r.left), int(r.right), int(r.new_id))
             for r in _bounded_collect(merges.select("left", "right", "new_id").orderBy("new_id"), "merge table")]
    return table, hash(tuple(table))


def make_encoder(merges: DataFrame, keep: int = CHUNK_CACHE):
    """Arrow UDF ``ARRAY<STRING> chunks → ARRAY<INT> ids``; a null array has no ids.

    The merge table (bounded by the vocabulary) is collected and broadcast once;
    each Python worker keeps the ids of at most about ``keep`` chunks (0: of none, for
    chunks that come once).
    """
    table, key = _merge_table(merges)
    key = (key, keep)
    ship_package(merges.sparkSession)
    shared = merges.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode_chunks(chunks: pa.Array) -> pa.Array:
        return _cached_encoder(key, shared.value)(chunks)

    return encode_chunks


def encode_inline(df: DataFrame, merges: DataFrame, text: str = "text", out: str = "ids", pattern: str = SPLIT_PATTERN) -> DataFrame:
    """D8 for small inputs: lazy and map-only, with a chunk cache in each worker."""
    return df.withColumn(out, make_encoder(merges)(pretokenize_col(text, pattern)))


def chunk_dictionary(chunks: DataFrame, merges: DataFrame) -> DataFrame:
    """``(chunk, cnt, ids)`` of the distinct values of column ``chunk``, each encoded once."""
    counts = chunks.groupBy("chunk").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.withColumn("ids", make_encoder(merges, 0)(F.array("chunk")))


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions start[i] .. start[i] + size[i] - 1 of all i, one after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _lists(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items of a list array, and where each list starts and how long it is."""
    size = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return values.flatten(), np.cumsum(size) - size, size


def encode(df: DataFrame, merges: DataFrame, text: str = "text", out: str = "ids",
           pattern: str = SPLIT_PATTERN, prepend: int | None = None, append: int | None = None,
           hot_chunks: int = CHUNK_CACHE) -> DataFrame:
    """Ordinary-text encoding (special tokens are never produced from text).

    Lazy and map-only: no text or token is shuffled or written. Workers keep the ids of about
    ``hot_chunks`` chunks; ids do not depend on that bound. A null text has no ids.
    """
    names = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c != out]
    ids = make_encoder(merges, hot_chunks)(pretokenize_col(text, pattern))
    if prepend is not None:
        ids = F.concat(F.array(F.lit(prepend)), ids)
    if append is not None:
        ids = F.concat(ids, F.array(F.lit(append)))
    return spread(df).select(*names, ids.alias(out))


def decode_bytes(df: DataFrame, vocab: DataFrame, ids: str = "ids", out: str = "text") -> DataFrame:
    """Ids → text; invalid UTF-8 becomes U+FFFD.

    The vocabulary (bounded) is broadcast; token bytes are joined in
    position order inside each row — no shuffle of tokens. An id outside the
    vocabulary gives one U+FFFD.
    """
    rows = sorted({int(r.token_id): bytes(r.token_bytes) for r in _bounded_collect(vocab.select("token_id", "token_bytes"), "vocabulary")}.items())
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(rows)

    @F.arrow_udf(T.StringType())
    def dec(col: pa.Array) -> pa.Array:
        known = np.array([i for i, _ in shared.value], np.int64)
        tokens = pa.array([*(t for _, t in shared.value), b"\xff"], pa.large_binary())
        values, first, many = _lists(col)
        wanted = pc.fill_null(values.cast(pa.int64()), -1).to_numpy(zero_copy_only=False)
        code = np.searchsorted(known, wanted)
        code[np.append(known, -1)[code] != wanted] = len(known)
        _, ends, data = tokens.take(pa.array(code)).buffers()
        ends = np.frombuffer(ends, np.int64)[np.append(first, len(code))] if len(code) else np.zeros(len(col) + 1, np.int64)
        text = pa.Array.from_buffers(pa.large_binary(), len(col), [None, pa.py_buffer(ends), data or pa.py_buffer(b"")])
        try:
            text = text.cast(pa.string())
        except pa.ArrowInvalid:     # some row is no UTF-8
            text = pa.array([t.decode("utf-8", "replace") for t in text.to_pylist()], pa.string())
        return pc.if_else(col.is_valid(), text, pa.scalar(None, pa.string()))

    return df.withColumn(out, dec(F.col(ids)))


# ---------------------------------------------------------------------------
# D11 / D12 / D14


@F.pandas_udf(T.IntegerType())
def _replaced_utf8_len(b: pd.Series) -> pd.Series:
    """UTF-8 length after decoding with U+FFFD replacement (vocabulary-sized input)."""
    return pd.Series([len(bytes(x).decode("utf-8", "replace").encode("utf-8")) for x in b], dtype="int32")


def token_byte_lengths(vocab: DataFrame, exact: bool = False) -> DataFrame:
    """``(token_id, n_bytes)``; specials 0.

    Default follows the reference: UTF-8 length of the *decoded string*, so a
    lone byte ≥ 0x80 counts 3 (U+FFFD). ``exact=True`` gives the raw length.
    """
    raw = F.octet_length("token_bytes")
    if exact:
        nb = raw
    else:
        nb = _replaced_utf8_len(F.col("token_bytes"))
    return vocab.select("token_id", F.when(F.col("special").isNotNull(), 0).otherwise(nb).cast("int").alias("n_bytes"))


def cap_docs_by_groups(df: DataFrame, order: str, max_docs: int, group_size: int = 1024) -> DataFrame:
    """Q27: ``max_docs`` is tested after each whole row group, so the cap
    overshoots to the end of the group that reaches it."""
    from quill.plans.order import dense_index
    d = dense_index(df, [order], out="__p")
    return d.where(F.floor(F.col("__p") / group_size) * group_size < max_docs).drop("__p")


def count_tokens(df: DataFrame, merges: DataFrame, text: str = "text",
                 pattern: str = SPLIT_PATTERN, bos: bool = True) -> DataFrame:
    """Docs, chars, tokens (+1 BOS per doc), chars/token, tokens/doc.

    Tokens = Σ chunk count × token length of the distinct chunk: the distinct
    chunk table is encoded once; no per-document token array is built, and only sums
    of many chunks leave Python.
    """
    table, _ = _merge_table(merges)
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(table)

    def add_up(batches):
        encoder, held, n = _Encoder(shared.value, 0), [], 0

        def total():
            encoder.forget()
            encoder.learn(pa.concat_arrays([b.column(0) for b in held]))
            cnt = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in held])
            return pa.RecordBatch.from_arrays([pa.array([int((encoder.size * cnt).sum())], pa.int64())], names=["t"])
        for b in batches:
            held.append(b)
            n += len(b)
            if n >= RUN_WORDS:
                yield total()
                held, n = [], 0
        if n:
            yield total()
    docs = df.agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length(text)).alias("chars"))
    chunk_tokens = chunk_counts(df, text, pattern).mapInArrow(add_up, "t bigint").agg(F.sum("t")).scalar()
    j = docs
    tokens = F.coalesce(chunk_tokens, F.lit(0)) + (F.col("docs") if bos else F.lit(0))
    return j.select("docs", "chars", tokens.alias("tokens"),
                    F.round(F.col("chars") / tokens, 6).alias("chars_per_token"),
                    F.round(tokens / F.col("docs"), 6).alias("tokens_per_doc"))


def vocab_stats(token_bytes: DataFrame) -> DataFrame:
    """min/max/mean/sample std of non-zero n_bytes, special count."""
    nz = F.when(F.col("n_bytes") > 0, F.col("n_bytes"))
    return token_bytes.agg(F.min(nz).alias("min_bytes"), F.max(nz).alias("max_bytes"),
                           F.round(F.avg(nz), 6).alias("mean_bytes"),
                           F.round(F.stddev_samp(nz), 6).alias("std_bytes"),
                           F.sum(F.when(F.col("n_bytes") == 0, 1).otherwise(0)).alias("num_special"))


def compression_report(df: DataFrame, tokenizers: dict[str, DataFrame], by: str = "category",
                       text: str = "text", pattern: str = SPLIT_PATTERN) -> DataFrame:
    """Bytes, tokens and bytes/token per category and tokenizer, plus
    the relative difference to the first tokenizer and the winner (ties allowed).

    Per tokenizer: distinct (category, chunk) counts × encoded chunk length.
    """
    counts = (spread(df.select(by, text)).select(by, F.explode(pretokenize_col(text, pattern)).alias("chunk"))
              .groupBy(by, "chunk").agg(F.count(F.lit(1)).alias("cnt")))
    nbytes = df.groupBy(by).agg(F.sum(F.octet_length(text)).alias("bytes"))
    per = None
    for name, merges in tokenizers.items():
        enc = make_encoder(merges, 0)
        t = (counts.select(by, (F.col("cnt") * F.size(enc(F.array("chunk")))).alias("t"))
             .groupBy(by).agg(F.sum("t").alias("tokens")).withColumn("tokenizer", F.lit(name)))
        per = t if per is None else per.unionByName(t)
    r = per.join(nbytes, by).withColumn("ratio", F.round(F.col("bytes") / F.col("tokens"), 6))
    first = next(iter(tokenizers))
    base = r.where(F.col("tokenizer") == first).select(by, F.col("tokens").alias("base_tokens"))
    best = r.groupBy(by).agg(F.max("ratio").alias("best_ratio"))
    return (r.join(base, by).join(best, by)
            .withColumn("relative_pct", F.round((F.col("base_tokens") - F.col("tokens")) / F.col("base_tokens") * 100, 6))
            .withColumn("is_best", F.col("ratio") == F.col("best_ratio"))
            .drop("base_tokens", "best_ratio"))


def roundtrip_check(df: DataFrame, merges: DataFrame, vocab: DataFrame, text: str = "text",
                    letters: list[str] | None = None) -> DataFrame:
    """Count of texts where decode(encode(x)) ≠ x, and letters that do not
    encode to exactly one token (both must be 0)."""
    e = encode(df.select(text), merges, text=text)
    d = decode_bytes(e, vocab, out="__dec")
    bad = d.agg(F.sum((F.col("__dec") != F.col(text)).cast("long")).alias("roundtrip_mismatches"))
    if letters:
        spark = df.sparkSession
        ls = encode_inline(spark.createDataFrame([(x,) for x in letters], "text STRING"), merges)
        nl = ls.where(F.size("ids") != 1).count()
        bad = bad.withColumn("multi_token_letters", F.lit(nl))
    return bad
