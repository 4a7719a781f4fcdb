"""Best-fit packing by exact complements.

Documents become token pieces of at most ``capacity``; pieces fill sequences of
``capacity`` tokens. Only counts per length matter for a good packing, and there
are at most ``capacity`` lengths, so the plan is made on the histogram (one
count per length, whatever the size of the data):

1. Longest lengths first. For the gap that a length leaves, look for one, two or
   three available lengths that add up to exactly the gap (sums of singles, pairs
   and triples under the available counts), and consume the combination as often
   as the counts allow.
2. What finds no exact complement goes by best fit, still in whole groups of
   equal sequences.

The plan is a list of (lengths of a sequence, how many such sequences); every
entry of it exhausts a length or a group, so its size depends on ``capacity``,
not on the data. Each piece gets its rank within its length from a two-level
count (hash buckets per length, as many as its own count needs, then a window within
one bucket), and the rank finds its sequence and offset in the plan by binary search. No sequence, length
or copy group has to fit one task.

A null text is empty and still has its end token. Repeated rows are packed as
often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quill.llm.bpe_codec import library_codec
from quill.llm.tables import map_arrow, stored, text_bytes

MOST_BUCKETS = 1 << 16      # about; a bucket holds at least LEAST_ROWS and at most this part of all rows
LEAST_ROWS = 1 << 10


def pieces(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 2,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, piece, start, length, ids_crc32): whole text to ids plus ``end_id``; a
    document over ``capacity`` is cut so that its first piece is the shorter one."""
    kinds = dict(df.dtypes)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        c = library_codec()
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                ids = memoryview(c.encode(t.decode("utf-8", "replace")) + end)
                n = len(ids) // 4
                first = (n - 1) % capacity + 1
                at, size, k = 0, first, 0
                while at < n:
                    row.append(i), piece.append(k), start.append(at), length.append(size)
                    crc.append(zlib.crc32(ids[4 * at:4 * (at + size)]))
                    at, size, k = at + size, capacity, k + 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[key, "piece", "start", "length", "ids_crc32"])
    return map_arrow(df.select(key, text_bytes(text).alias("text")), run, f"{key} {kinds[key]}, piece int, start bigint, length bigint, ids_crc32 bigint")


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences for ``counts[length]`` pieces of each length: (lengths, how many)."""
    n = counts.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def consume(combo: tuple[int, ...]) -> bool:
        need = Counter(combo)
        times = min(int(n[x]) // m for x, m in need.items())
        if times == 0:
            return False
        for x, m in need.items():
            n[x] -= m * times
        out.append((combo, times))
        return True

    def complement(first: int, gap: int) -> bool:
        n[first] -= 1           # the piece being placed: what is found can then be consumed
        rest = fill(gap)
        n[first] += 1
        return rest is not None and consume((first, *rest))

    def fill(gap: int) -> tuple[int, ...] | None:
        if n[gap]:
            return (gap,)
        a = np.arange((gap + 1) // 2, gap)
        have = np.where(a == gap - a, n[a] // 2, np.minimum(n[a], n[gap - a]))
        if have.any():
            i = have.argmax()
            return int(a[i]), int(gap - a[i])
        small = np.flatnonzero(n[:gap - 1])
        if not len(small):
            return None
        x, y = np.meshgrid(small, small, indexing="ij")
        z = gap - x - y
        ok = (x >= y) & (y >= z) & (z > 0)
        x, y, z = x[ok], y[ok], z[ok]
        have = np.minimum(np.minimum(n[x], n[y]), n[z])
        have = np.where((x == y), np.minimum(n[x] // 2, n[z]), have)
        have = np.where((y == z), np.minimum(n[y] // 2, n[x]), have)
        have = np.where((x == y) & (y == z), n[x] // 3, have)
        if not have.any():
            return None
        i = have.argmax()
        return int(x[i]), int(y[i]), int(z[i])

    if n[capacity]:
        consume((capacity,))
    for first in range(capacity - 1, 0, -1):
        while n[first] and complement(first, capacity - first):
            pass
    # best fit for the rest: groups of equal open sequences by their gap
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for size in range(capacity, 0, -1):
        while n[size]:
            gap = min((g for g in open_ if g >= size), default=None)
            if gap is None:
                fits = capacity // size
                times = int(n[size]) // fits
                combo = (size,) * fits
                if not times:
                    times, combo = 1, (size,) * int(n[size])
                n[size] -= times * len(combo)
                left = capacity - sum(combo)
            else:
                was, times = open_[gap].pop()
                if times > n[size]:
                    open_[gap].append((was, times - int(n[size])))
                    times = int(n[size])
                if not open_[gap]:
                    del open_[gap]
                n[size] -= times
                combo, left = (*was, size), gap - size
            if left:
                open_.setdefault(left, []).append((combo, times))
            else:
                out.append((combo, times))
    out += [g for groups in open_.values() for g in groups]
    return out


def places(layout: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """Arrays sorted by (length, first rank): key, first sequence, offset."""
    used = np.zeros(capacity + 1, np.int64)
    key, seq, off, base = [], [], [], 0
    for combo, times in layout:
        at = 0
        for size in combo:
            key.append((size << 44) + int(used[size]))
            seq.append(base)
            off.append(at)
            used[size] += times
            at += size
        base += times
    o = np.argsort(np.array(key, np.int64), kind="stable")
    return tuple(np.array(x, np.int64)[o] for x in (key, seq, off))


def pack(df: DataFrame, capacity: int = 1024, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows that carry a length in 1..capacity."""
    rows = stored(df, "pieces")
    n = np.zeros(capacity + 1, np.int64)
    for size, c in rows.groupBy(length).count().collect():      # at most capacity rows
        n[size] = c
    per_bucket = max(LEAST_ROWS, int(n.sum()) // MOST_BUCKETS)
    buckets = np.maximum(1, -(-n // per_bucket))                # of each length, by its own count
    many = F.get(F.from_json(F.lit(json.dumps(buckets.tolist())), "array<int>"), F.col(length).cast("int"))
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64(*order), many).cast("int"))
    first = np.cumsum(buckets) - buckets                        # place of a length's buckets
    counts = np.zeros(int(buckets.sum()), np.int64)
    for size, b, c in rows.groupBy(length, "__bucket").count().collect():   # at most MOST_BUCKETS + 2 * capacity rows
        counts[first[size] + b] = c
    bases = np.cumsum(counts) - counts
    bases -= np.repeat(bases[first], buckets)                   # ranks start anew in each length
    key, seq, off = places(plan(n, capacity), capacity)
    shared = df.sparkSession.sparkContext.broadcast((bases, first, key, seq, off))
    w = Window.partitionBy(length, "__bucket").orderBy(*order)
    ranked = rows.withColumn("__rank", F.row_number().over(w).cast("long") - 1)
    at, bk, rk = (ranked.columns.index(c) for c in (length, "__bucket", "__rank"))
    names = [c for c in rows.columns if c != "__bucket"]
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "__bucket") + ", sequence_id bigint, offset bigint"

    def place(batches):
        bases, first, key, seq, off = shared.value
        for b in batches:
            size = b.column(at).to_numpy(zero_copy_only=False)
            rank = bases[first[size] + b.column(bk).to_numpy(zero_copy_only=False)] + b.column(rk).to_numpy(zero_copy_only=False)
            i = np.searchsorted(key, (size << 44) + rank, side="right") - 1
            s = seq[i] + (rank - (key[i] - (size << 44)))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(s), pa.array(off[i])],
                                             names=[*names, "sequence_id", "offset"])
    return map_arrow(ranked, place, schema)


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 1024) -> DataFrame:
    """Documents to packed pieces: key, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(df, key, text, capacity), capacity, order=(key, "piece", "ids_crc32"))
