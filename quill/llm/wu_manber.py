"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts and benchmark items are brought to one form: A-Z lower-cased, words (runs of
letters, digits and non-ASCII characters) joined by single spaces with a space at
both ends, so that a byte occurrence is an occurrence of whole words. A window is
ten consecutive words of an item; an item of fewer words, but not none, is one
window.

Search: windows are sorted into classes of similar length. In a class with shortest
window m, each text position is judged by the block of B bytes that ends m bytes
after it. The shift table says how far the nearest window with that block could
start; impossible positions are skipped. At shift zero, the hash of that suffix block
and of the first block selects a bucket of windows, and each is compared byte by
byte. Many stretches of a slab of text advance at once, one numpy step for all.

Distribution: the windows are made by Spark, dealt by hash over blocks of about
``block_bytes`` (so a window shared by many items is spread too) and broadcast one
block at a time; one block is the rule, and then the search is map-only. With more
blocks the texts are written once with a row number, searched once per block, and
only rows with hits are shuffled and united. Both ways give the same rows.

Null and empty texts have no words and no hits. Null and empty items have no window.
Items with equal ids are one item; a null id is an item whose name is the empty
string. Repeated rows are answered each. An empty benchmark hits nothing, an empty
table gives no rows. Texts of any length are searched whole.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.llm.tables import map_arrow, slabs, stored, text_bytes

WINDOW = 10
BLOCK_BYTES = 8 << 20       # of windows searched for at once
SLAB = 4 << 20              # bytes of text in one search
LANE = 4096                 # positions that one stretch of a slab covers
CLASSES = (0, 8, 16, 32, 48, 64, 96, 1 << 62)

_U = np.uint64
_ODD, _ODD2 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
_WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"


def canonical(text: bytes) -> tuple[bytes, int]:
    """The text's words joined and enclosed by single spaces, and their number."""
    w = text.translate(_FOLD).split()
    return (b" %b " % b" ".join(w) if w else b""), len(w)


def _words64(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position of a buffer that ends with eight spare bytes."""
    return np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))


class _Class:
    """Tables for the windows ``ids`` of similar length."""

    def __init__(self, ids, starts, lengths, view):
        self.m = m = int(lengths[ids].min())
        self.block = b = min(8, max(m // 2, min(m, 3)))
        self.mask = _MASK[b]
        bits = min(22, max(12, (len(ids) * (m - b + 1)).bit_length()))
        self.drop = _U(64 - bits)
        self.shift = np.full(1 << bits, m - b + 1, np.int32)
        for j in range(m - b + 1):
            np.minimum.at(self.shift, self.slot(view[starts[ids] + j]), m - b - j)
        key = self.key(view, starts[ids])
        order = np.argsort(key, kind="stable")
        self.keys, first = np.unique(key[order], return_index=True)
        self.ids = ids[order]
        self.first = np.append(first, len(ids))

    def slot(self, eight):
        return ((eight & self.mask) * _ODD) >> self.drop

    def key(self, view, at):
        """Hash of the suffix block and the first block of the m bytes at ``at``."""
        h = (view[at + (self.m - self.block)] & self.mask) * _ODD ^ (view[at] & self.mask) * _ODD2
        return h ^ h >> _U(29)


class Searcher:
    """Finds every occurrence of (window, item) pairs' windows."""

    def __init__(self, pairs: list[tuple[bytes, str]]):
        names = sorted({item for _, item in pairs})
        number = {item: i for i, item in enumerate(names)}
        by_window: dict[bytes, set[int]] = {}
        for w, item in pairs:
            by_window.setdefault(w, set()).add(number[item])
        windows = sorted(by_window)
        self.names = np.array(names, object)
        self.items = np.array([i for w in windows for i in sorted(by_window[w])], np.int64)
        self.item_at = np.cumsum([0, *(len(by_window[w]) for w in windows)])
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.n_words = np.array([w.count(b" ") - 1 for w in windows], np.int64)
        self.blob = np.frombuffer(b"".join(windows) + bytes(8), np.uint8)
        view = _words64(self.blob)
        self.classes = []
        for low, high in zip(CLASSES, CLASSES[1:]):
            ids = np.flatnonzero((self.lengths >= low) & (self.lengths < high))
            if len(ids):
                self.classes.append(_Class(ids, self.starts, self.lengths, view))

    def find(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(positions, windows) of all occurrences in a canonical text."""
        end = len(text)
        buf = np.frombuffer(text + bytes(8), np.uint8)
        view = _words64(buf)
        at, which = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for c in self.classes:
            for a, w in self._confirmed(c, view, end, self._possible(c, view, end)):
                at.append(a)
                which.append(w)
        return np.concatenate(at), np.concatenate(which)

    @staticmethod
    def _possible(c: _Class, view: np.ndarray, end: int) -> np.ndarray:
        """Positions that the shift table cannot rule out."""
        pos = np.arange(0, end - c.m + 1, LANE)
        stop = np.minimum(pos + LANE, end - c.m + 1)
        ahead, found = c.m - c.block, []
        while len(pos):
            step = c.shift[c.slot(view[pos + ahead])]
            zero = step == 0
            if zero.any():
                found.append(pos[zero])
            pos = pos + np.maximum(step, 1)
            live = pos < stop
            if not live.all():
                pos, stop = pos[live], stop[live]
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def _confirmed(self, c: _Class, view: np.ndarray, end: int, at: np.ndarray, most: int = 1 << 20):
        """Of those positions, the ones where a window of the bucket really stands."""
        if not len(at):
            return
        key = c.key(view, at)
        i = np.minimum(np.searchsorted(c.keys, key), len(c.keys) - 1)
        known = c.keys[i] == key
        at, i = at[known], i[known]
        size = c.first[i + 1] - c.first[i]
        own = _words64(self.blob)
        upto, lo = np.cumsum(size), 0
        while lo < len(at):         # pairs of position and window, a bounded number at a time
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, side="right")))
            n = size[lo:hi]
            a = np.repeat(at[lo:hi], n)
            w = c.ids[np.repeat(c.first[i[lo:hi]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            fits = a + self.lengths[w] <= end
            a, w = a[fits], w[fits]
            done, off = [], 0
            while len(a):
                rest = self.lengths[w] - off
                same = (view[a + off] ^ own[self.starts[w] + off]) & _MASK[np.minimum(rest, 8)] == 0
                done.append((a[same & (rest <= 8)], w[same & (rest <= 8)]))
                more = same & (rest > 8)
                a, w, off = a[more], w[more], off + 8
            yield from done
            lo = hi

    def hits(self, texts: list[bytes]):
        """For each text its number of words, the runs of hit words (first, one after
        the last) and the items found, the last two as flat arrays with offsets."""
        forms = [canonical(t) for t in texts]
        n = np.array([k for _, k in forms], np.int64)
        gaps = np.where(n > 0, n + 1, 0)            # a text of n words holds n + 1 spaces
        first = np.cumsum(gaps) - gaps
        joined = b"".join(f for f, _ in forms)
        at, which = self.find(joined)
        space = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        slot = np.searchsorted(space, at)           # word after the space where the window starts
        edge = np.zeros(len(space) + 2, np.int64)
        np.add.at(edge, slot, 1)
        np.add.at(edge, slot + self.n_words[which], -1)
        cover = np.concatenate(([False], np.cumsum(edge) > 0))
        begin, stop = np.flatnonzero(cover[1:] & ~cover[:-1]), np.flatnonzero(~cover[1:] & cover[:-1])
        doc = np.searchsorted(first, begin, side="right") - 1
        found = np.unique((np.searchsorted(first, slot, side="right") - 1) * len(self.n_words) + which) if len(at) else np.empty(0, np.int64)
        in_doc, w = np.divmod(found, max(len(self.n_words), 1))
        many = self.item_at[w + 1] - self.item_at[w]
        item = self.items[np.repeat(self.item_at[w], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
        pair = np.unique(np.repeat(in_doc, many) * max(len(self.names), 1) + item)
        item_doc, item = np.divmod(pair, max(len(self.names), 1))
        ends = np.arange(len(texts) + 1)
        return n, (begin - first[doc], stop - first[doc], np.searchsorted(doc, ends)), (self.names[item], np.searchsorted(item_doc, ends))


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct (window, item) of all items, in canonical form."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = F.regexp_extract_all(F.translate(F.col(text), upper, lower), F.lit(_WORD), 1)
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), words.alias("w")).where(F.size("w") > 0)
    k = F.least(F.size("w"), F.lit(size))
    at = rows.select("item", "w", k.alias("k"), F.explode(F.sequence(F.lit(1), F.size("w") - k + 1)).alias("i"))
    return at.select(F.concat(F.lit(" "), F.array_join(F.slice("w", F.col("i"), F.col("k")), " "), F.lit(" ")).alias("window"), "item").distinct()


def _search(df: DataFrame, key: str, pairs: DataFrame) -> DataFrame:
    """(key, n_words, runs, items) of rows (key, text bytes) for one block of windows."""
    found = Searcher([(bytes(r.window, "utf-8"), r.item) for r in pairs.collect()])     # bounded by block_bytes
    shared = df.sparkSession.sparkContext.broadcast(found)
    run_type = pa.struct([("first", pa.int64()), ("last", pa.int64())])

    def run(batches):
        for batch in batches:
            for b in slabs(batch, 1, SLAB):
                n, (first, last, r_at), (items, i_at) = shared.value.hits(b.column(1).to_pylist())
                runs = pa.StructArray.from_arrays([pa.array(first), pa.array(last)], fields=list(run_type))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n), pa.ListArray.from_arrays(pa.array(r_at, pa.int32()), runs),
                     pa.ListArray.from_arrays(pa.array(i_at, pa.int32()), pa.array(items, pa.string()))],
                    names=[key, "n_words", "runs", "items"])
    kind = dict(df.dtypes)[key]
    return map_arrow(df, run, f"`{key}` {kind}, n_words bigint, runs array<struct<first:bigint,last:bigint>>, items array<string>")


def _united(runs: Column) -> Column:
    """Overlapping and touching runs as one."""
    def add(done, r):
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["first"].alias("first"), F.greatest(last["last"], r["last"]).alias("last"))
        return F.when(last["last"] >= r["first"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(r)))
    return F.aggregate(F.array_sort(runs), F.array().cast("array<struct<first:bigint,last:bigint>>"), add)


def overlaps(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
             item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, n_words, runs, items) for every row: ``runs`` are the stretches of hit words
    (first word, one after the last), ``items`` the benchmark items found, in no order."""
    pairs = stored(windows(benchmark, item, item_text, size), "windows")
    total = pairs.agg(F.sum(F.octet_length("window"))).collect()[0][0] or 0
    blocks = max(1, -(-total // block_bytes))
    if blocks == 1:
        return _search(df.select(key, text_bytes(text).alias("text")), key, pairs)
    rows = stored(df.select(F.col(key).alias("id"), text_bytes(text).alias("text"), F.monotonically_increasing_id().alias("row")), "texts")
    block = F.pmod(F.xxhash64("window", "item"), F.lit(blocks))
    parts = [_search(rows.select("row", "text"), "row", pairs.where(block == i)) for i in range(blocks)]
    every = reduce(DataFrame.unionByName, [parts[0], *(p.where(F.size("items") > 0) for p in parts[1:])])
    whole = every.groupBy("row").agg(F.max("n_words").alias("n_words"), _united(F.flatten(F.collect_list("runs"))).alias("runs"),
                                     F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return rows.select("row", "id").join(whole, "row").select(F.col("id").alias(key), "n_words", "runs", "items")


def report(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) of every row."""
    found = overlaps(df, benchmark, key, **options)
    n_hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"])
    return found.select(key, "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("runs") > 0).alias("contaminated"))
