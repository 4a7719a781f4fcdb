"""Language-model scores by prediction by partial matching over bytes.

A text is its A-Z folded words, each followed by one space, and an end symbol. The
model is a trie of byte contexts up to ``order`` symbols with the counts of the
symbols that followed them in the training texts; below the longest contexts a
symbol counts once for each longer context it was new in (update exclusion). The
probability of a symbol comes from the longest known context. Escape probabilities
are estimated from the training counts themselves: by total and number of kinds of
a context, how often an occurrence left out would have escaped. After an escape
the symbols of the longer context are excluded from the shorter one, down to a
uniform choice among symbols no context has seen. A text's score is its log10
probability.

The counts are gathered from every training text: symbol runs of ``order + 1`` are
counted in each task and summed by Spark; shorter contexts follow by counting. The
order is the same at every size. At most ``max_entries`` runs go to the tasks as one
trie. More are cut into shards by the two newest symbols of the context: a run meets
the contexts of two symbols and more in one shard only, and the shorter ones, at most
SYMBOLS ** 2 runs, are broadcast. A shard's trie is a file in the shared folder. A task
keeps the runs of about ``HELD`` symbols of its texts by number, and looks the distinct
ones up shard after shard. No run of a text is written or shuffled, what a task holds has
a bound but for a context pair with very many runs, and the scores are the same either way.

``base_score`` is the unigram word model of the same training texts with add-one
smoothing. Words that make up at least 1 / ``HEAVY`` of all tokens (at most that
many) are broadcast with their counts; the other words are looked up as the runs are,
in files of word counts.

Null and empty texts consist of the end symbol alone. Without training texts the
models are uniform. Repeated rows are scored each; a null id belongs to fold 0.
"""

from __future__ import annotations

import pickle
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.llm.tables import crc32_mod, discard, discard_folders, map_arrow, open_uri, shared_folder, shuffles_go, stored, text_bytes
from quill.llm.words import word_hashes

ORDER = 5
SYMBOLS = 257           # 256 bytes and the end
END, SHIFT = 256, 9
HEAVY = 1 << 18
MAX_ENTRIES = 4_000_000
SLAB = 1_000_000        # symbols or words counted at once
SCORED = 400_000        # symbols scored at once, beside the trie
HELD = 8_000_000        # symbols whose runs a task keeps by number, to look them up together
FILE_WORDS = 1 << 20    # words in a file of word counts


def events(text: bytes) -> bytes:
    w = text.lower().split()
    return b" ".join(w) + b" " if w else b""


def runs(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all (order + 1)-symbol runs, one per symbol of each text, and the
    text each belongs to. Before a text stand end symbols."""
    size = sum(len(t) + 1 + order for t in texts)
    sym = np.full(size, END, np.int64)
    own = np.empty(size, np.int32)
    real = np.zeros(size, bool)
    at = 0
    for i, t in enumerate(texts):
        n = len(t)
        sym[at + order:at + order + n] = np.frombuffer(t, np.uint8)
        real[at + order:at + order + n + 1] = True
        own[at:at + order + n + 1] = i
        at += order + n + 1
    code = sym.copy()
    for k in range(1, order + 1):
        code[k:] |= sym[:-k] << (SHIFT * k)
    return code[real], own[real]


def _counted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(parts), return_counts=True)


def counts(df: DataFrame, train: str, text: str, order: int) -> DataFrame:
    """(kind, code, train, total): kind 0 are words (hash), kind 1 symbol runs of training texts."""
    def run(batches):
        def rows(kind, code, n, total):
            for at in range(0, len(code), 50_000):
                s = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code[s]), kind, np.int8)), pa.array(code[s].view(np.int64)), pa.array(n[s]), pa.array(total[s])],
                                                 names=["kind", "code", "train", "total"])

        def flush():
            if words[0] or words[1]:
                code = np.concatenate([*words[0], *words[1]])
                trained = np.concatenate([np.zeros(sum(map(len, words[0])), np.int64), np.ones(sum(map(len, words[1])), np.int64)])
                o = np.argsort(code, kind="stable")
                code, trained = code[o], trained[o]
                first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
                total = np.diff(np.append(first, len(code)))
                yield from rows(0, code[first], np.add.reduceat(trained, first), total)
            if texts:
                code, n = _counted([runs(texts, order)[0]])
                grams.append((code, n))

        def merged():
            code, at = np.unique(np.concatenate([c for c, _ in grams]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n for _, n in grams])).astype(np.int64)
            return code, n
        words: tuple[list, list] = ([], [])
        texts: list[bytes] = []
        grams: list = []
        size = 0
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = word_hashes(t)
                if len(h):
                    words[int(y)].append(h)
                if y:
                    texts.append(events(t))
                size += len(t) + 1
                if size >= SLAB * 2:
                    yield from flush()
                    words, texts, size = ([], []), [], 0
                    if sum(len(c) for c, _ in grams) > SLAB * 2:
                        grams = [merged()]
                        if len(grams[0][0]) > SLAB:
                            yield from rows(1, *grams[0], grams[0][1])
                            grams = []
        yield from flush()
        if grams:
            code, n = merged()
            yield from rows(1, code, n, n)
    parts = map_arrow(df.select(text_bytes(text).alias("text"), F.col(train).alias("train")), run, "kind tinyint, code bigint, train bigint, total bigint")
    return parts.groupBy("kind", "code").agg(F.sum("train").alias("train"), F.sum("total").alias("total"))


BUCKETS = 24


def bucket(x: np.ndarray) -> np.ndarray:
    """0, 1, 2, 3, then two buckets for each doubling."""
    x = np.maximum(x, 0).astype(np.float64)
    return np.where(x < 4, x, np.minimum(np.floor(2 * np.log2(np.maximum(x, 4))), BUCKETS - 1)).astype(np.int64)


def escapes(esc: np.ndarray, stay: np.ndarray) -> np.ndarray:
    """Escape probabilities by the cells of ``_left_out``."""
    hits = ((esc + 0.5) / (esc + stay + 1)).reshape(BUCKETS, BUCKETS)
    return np.clip(hits, 1e-6, 1 - 1e-6)


def _left_out(n: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each counted occurrence of runs seen ``n`` times is left out in turn and looked
    up in what remains of its context, as cells of (total, kinds): how many escape,
    being their symbol's only one, and how many stay."""
    c, d = total - 1, kinds - (n == 1)
    ok = c > 0
    once, more = ok & (n == 1), ok & (n > 1)
    cell = bucket(c) * BUCKETS + bucket(d)
    size = BUCKETS * BUCKETS
    return np.bincount(cell[once], minlength=size), np.bincount(cell[more], n[more], size)


def _points(escape: np.ndarray, known: np.ndarray, hit: np.ndarray, n: np.ndarray, c_all: np.ndarray, c_kinds: np.ndarray) -> np.ndarray:
    """What one level adds to the log10 probability of each run."""
    out = np.zeros(len(known))
    p = escape[bucket(c_all), bucket(c_kinds)]
    # what an escape leaves goes to the seen symbols, each discounted alike
    out[hit] = np.log10((1 - p[hit]) * (n[hit] - 0.5) / (c_all[hit] - 0.5 * c_kinds[hit]))
    open_ = known & ~hit & (c_kinds > 0)
    out[open_] = np.log10(p[open_])
    return out


class Trie:
    """Counts of every context order as sorted arrays."""

    def __init__(self, code: np.ndarray, n: np.ndarray, order: int):
        self.order = order
        self.levels: list = [None] * (order + 1)
        for k in range(order, -1, -1):
            o = np.argsort(code, kind="stable")
            code, n = code[o], n[o]
            first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.empty(0, np.int64)
            if len(code):
                n = np.add.reduceat(n, first)
                code = code[first]
            ctx = code >> SHIFT
            at = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1]))) if len(code) else np.empty(0, np.int64)
            total = np.add.reduceat(n, at) if len(at) else np.empty(0, np.int64)
            kinds = np.diff(np.append(at, len(code))).astype(np.int64) if len(at) else np.empty(0, np.int64)
            self.levels[k] = [code, n, ctx[at], total, kinds, at, np.zeros(len(at), np.int64)]
            # drop the oldest symbol: runs of k symbols, each counted once for every
            # longer run that ends in it
            code, n = code & ((1 << (SHIFT * k)) - 1), np.ones(len(code), np.int64)
        for k in range(1, order + 1):                   # counts that a context's symbols have one order below
            code, _, _, _, _, at, _ = self.levels[k]
            if len(code):
                low = self.levels[k - 1]
                below = low[1][np.searchsorted(low[0], code & ((1 << (SHIFT * k)) - 1))]
                self.levels[k][6] = np.add.reduceat(below, at)

        self.escape = [self._escapes(k) for k in range(order + 1)]

    def cells(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``_left_out`` of a level."""
        _, n, ctxs, total, kinds, _, _ = self.levels[k]
        own = np.repeat(np.arange(len(ctxs)), kinds)
        return _left_out(n, total[own], kinds[own])

    def _escapes(self, k: int) -> np.ndarray:
        """Escape probability by (total, kinds) of a context, as buckets."""
        return escapes(*self.cells(k)) if len(self.levels[k][0]) else np.full((BUCKETS, BUCKETS), 0.5)

    def log10(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each run given those before it."""
        out = np.zeros(len(code))
        left = np.arange(len(code))
        gone_n, gone_kinds = np.zeros(len(code)), np.zeros(len(code))       # excluded by the longer context
        for k in range(self.order, -1, -1):
            grams, n, ctxs, total, kinds, _, below = self.levels[k]
            if not len(left) or not len(grams):
                continue
            run = code[left] & ((1 << (SHIFT * (k + 1))) - 1)
            c = np.minimum(np.searchsorted(ctxs, run >> SHIFT), len(ctxs) - 1)
            known = ctxs[c] == run >> SHIFT
            g = np.minimum(np.searchsorted(grams, run), len(grams) - 1)
            hit = known & (grams[g] == run)
            c_all, c_kinds = total[c] - gone_n[left], kinds[c] - gone_kinds[left]
            out[left] += _points(self.escape[k], known, hit, n[g], c_all, c_kinds)
            esc = known & ~hit
            gone_n[left[esc]], gone_kinds[left[esc]] = below[c[esc]], kinds[c[esc]]
            left = left[~hit]
        if len(left):
            seen = len(self.levels[0][0])
            out[left] -= np.log10(max(1, SYMBOLS - seen))
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text."""
        code, own = runs(texts, self.order)
        every, at = np.unique(code, return_inverse=True)
        return np.bincount(own, self.log10(every)[at], len(texts))


def _last(code: str, symbols: int) -> Column:
    return F.col(code).bitwiseAND(F.lit((1 << (SHIFT * symbols)) - 1))


NEWEST = 2              # context symbols that a shard is named by


def _shard(code, shards: int):
    """Shard of a run, of an array or a column."""
    newest = (1 << (SHIFT * NEWEST)) - 1
    if isinstance(code, np.ndarray):
        return ((code >> SHIFT & newest) * 2654435761 >> 15) % shards
    return F.pmod(F.shiftright(F.shiftright(code, SHIFT).bitwiseAND(F.lit(newest)) * F.lit(2654435761), 15), F.lit(shards)).cast("int")


def _files(rows: DataFrame, folder: str, build, schema: str) -> dict[int, tuple]:
    """``rows`` start with a column ``part``. Each part's arrays go through ``build(part, *arrays)``,
    which gives what is pickled to the part's file and a note; returns path and note by part.
    File names are unique to the task attempt."""
    def run(batches):
        fs, base = open_uri(folder)
        current, held = None, []

        def out():
            keep, note = build(current, *(np.concatenate(c) for c in zip(*held, strict=True)))
            raw = pickle.dumps(keep, protocol=5)
            path = f"{current}-{uuid.uuid4().hex}"
            with fs.open_output_stream(f"{base}/{path}") as f:
                f.write(pa.compress(raw, codec="zstd", asbytes=True))
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([path]), pa.array([len(raw)], pa.int64()), pa.array([pickle.dumps(note)], pa.binary())], names=["part", "path", "size", "note"])
        for b in batches:
            part = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo < hi:
                    if part[lo] != current and held:
                        yield out()
                        held = []
                    current = int(part[lo])
                    held.append([c.slice(lo, hi - lo).to_numpy() for c in b.columns[1:]])
        if held:
            yield out()
    with shuffles_go(rows.sparkSession):        # a row for each part
        found = map_arrow(rows.repartition("part").sortWithinPartitions("part"), run, schema).collect()
    return {r.part: (r.path, r.size, pickle.loads(r.note)) for r in found}


_FILE = "part int, path string, size bigint, note binary"


def _read(folder: str, path: str, size: int):
    fs, base = open_uri(folder)
    with fs.open_input_stream(f"{base}/{path}") as f:
        return pickle.loads(pa.decompress(f.read(), size, codec="zstd", asbytes=True))


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int32) if len(x) == 0 or x.max() < 2**31 else x


class Shards:
    """The trie in files: levels of NEWEST context symbols and more by shard, the others at hand."""

    def __init__(self, runs: DataFrame, order: int, shards: int):
        spark = runs.sparkSession
        self.order, self.shards, self.folder = order, shards, shared_folder(spark, "ppm-shards")
        pairs = runs.groupBy(_last("code", NEWEST + 1).alias("code")).agg(F.count(F.lit(1)).alias("n"))
        with shuffles_go(spark):        # at most SYMBOLS ** 2 rows
            low = pairs.groupBy(_last("code", NEWEST).alias("code")).agg(F.count(F.lit(1)).alias("n")).toArrow()
        low = Trie(low.column("code").to_numpy(), low.column("n").to_numpy(), NEWEST - 1)
        self.low, self.escape = low.levels, low.escape
        given = spark.sparkContext.broadcast(low.levels)

        def build(part, code, n):
            t = Trie(code, n, order)
            code, _, _, _, _, at, _ = t.levels[NEWEST]
            below = given.value[-1]     # symbols of a context one order below lie in other shards too
            t.levels[NEWEST][6] = np.add.reduceat(below[1][np.searchsorted(below[0], code & ((1 << (SHIFT * NEWEST)) - 1))], at)
            levels = [[x[0], _narrow(x[1]), x[2], _narrow(x[3]), _narrow(x[4]), None, _narrow(x[6])] for x in t.levels[NEWEST:]]
            return levels, [t.cells(k) for k in range(NEWEST, order + 1)]
        files = _files(runs.select(_shard(F.col("code"), shards).alias("part"), "code", "n"), self.folder, build, _FILE)
        self.files = {p: (path, size) for p, (path, size, _) in files.items()}
        for k in range(order + 1 - NEWEST):
            self.escape = [*self.escape, escapes(*(sum(note[k][i] for _, _, note in files.values()) for i in (0, 1)))]

    def log10(self, code: np.ndarray) -> np.ndarray:
        out, shard = np.zeros(len(code)), _shard(code, self.shards)
        for p in np.unique(shard).tolist():
            pick = np.flatnonzero(shard == p)
            t = Trie.__new__(Trie)
            empty = [np.empty(0, np.int64)] * 7
            t.order, t.escape = self.order, self.escape
            t.levels = [*self.low, *(_read(self.folder, *self.files[p]) if p in self.files else [empty] * (self.order + 1 - NEWEST))]
            out[pick] = t.log10(code[pick])
        return out


class Words:
    """Counts of the words that aren't broadcast, in files."""

    def __init__(self, words: DataFrame):
        spark = words.sparkSession
        self.folder = shared_folder(spark, "ppm-words")
        self.parts = 1 << (words.count() // FILE_WORDS).bit_length()

        def build(part, code, n):
            o = np.argsort(code)
            return (code[o], _narrow(n[o])), None
        files = _files(words.select(F.col("code").bitwiseAND(F.lit(self.parts - 1)).cast("int").alias("part"), "code", F.col("train").alias("n")), self.folder, build, _FILE)
        self.files = {p: (path, size) for p, (path, size, _) in files.items()}

    def __call__(self, code: np.ndarray) -> np.ndarray:
        """Count of each word, 0 for others."""
        out, part = np.zeros(len(code), np.int64), code & (self.parts - 1)
        for p in np.unique(part).tolist():
            if p in self.files:
                pick = np.flatnonzero(part == p)
                known, n = _read(self.folder, *self.files[p])
                at = np.minimum(np.searchsorted(known, code[pick]), len(known) - 1)
                out[pick] = np.where(known[at] == code[pick], n[at], 0)
        return out


def _numbered(parts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct values of all arrays, and the numbers of each array's values among them."""
    every, at = np.unique(np.concatenate(parts), return_inverse=True)
    return every, np.split(at, np.cumsum([len(p) for p in parts])[:-1])


class _Held:
    """Texts of a task whose runs and rarer words are looked up together."""

    def __init__(self, order: int):
        self.order, self.size = order, 0
        self.rows: list = []        # keys, flags, words, logs, known, points of the trie
        self.runs: list = []        # distinct runs of some texts, the number of each symbol's run, symbols of each text
        self.words: list = []       # words of some texts, their texts and times in them, texts

    def add_runs(self, texts: list[bytes]) -> None:
        code, own = runs(texts, self.order)
        every, at = np.unique(code, return_inverse=True)
        self.runs.append((every, at.astype(np.int32), np.bincount(own, minlength=len(texts))))

    def run_points(self, shards: Shards) -> np.ndarray:
        every, numbers = _numbered([r[0] for r in self.runs])
        points = shards.log10(every)
        return np.concatenate([np.add.reduceat(points[i][at], np.concatenate(([0], np.cumsum(size)[:-1]))) for i, (_, at, size) in zip(numbers, self.runs)])

    def word_points(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """What the rarer words add to each text's sum of logs and known words."""
        every, numbers = _numbered([w[0] for w in self.words])
        n = words(every)
        logs, known = [], []
        for i, (_, own, times, m) in zip(numbers, self.words):
            c = n[i]
            logs.append(np.bincount(own, times * np.log10(c + 1), m))
            known.append(np.bincount(own, times * (c > 0), m).astype(np.int64))
        return np.concatenate(logs), np.concatenate(known)


def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text."""
        code, own = runs(texts, self.order)
        every, at = np.unique(code, return_inverse=True)
        return np.bincount(own, self.log10(every)[at], len(texts))


def trie_of(run_counts: DataFrame, order: int, max_entries: int) -> tuple[Trie, list[DataFrame]]:
    """The trie of the longest contexts that fit ``max_entries``, and the tables (code, n)
    of the levels above it, the longest first, with the trie's own level at the end."""
    level = run_counts.select("code", F.col("train").alias("n"))
    tables = [level]
    while order > 1 and level.count() > max_entries:
        # as in the trie: a run counts once for every longer run that ends in it
        level = stored(level.groupBy(_last("code", order).alias("code")).agg(F.count(F.lit(1)).alias("n")), "ppm-level")
        tables.append(level)
        order -= 1
    got = level.toArrow()           # at most max_entries rows of 16 bytes
    return Trie(got.column("code").to_numpy(), got.column("n").to_numpy(), order), tables


def _last(code: str, symbols: int) -> Column:
    return F.col(code).bitwiseAND(F.lit((1 << (SHIFT * symbols)) - 1))


def _cells(levels: DataFrame) -> np.ndarray:
    """Escape probabilities from rows (n, total, kinds) of all runs of a level."""
    def run(batches):
        esc, stay = np.zeros(BUCKETS * BUCKETS), np.zeros(BUCKETS * BUCKETS)
        for b in batches:
            more = _left_out(*(c.to_numpy() for c in b.columns))
            esc, stay = esc + more[0], stay + more[1]
        at = np.flatnonzero(esc + stay)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(esc[at].astype(np.int64)), pa.array(stay[at].astype(np.int64))], names=["cell", "esc", "stay"])
    esc, stay = np.zeros(BUCKETS * BUCKETS), np.zeros(BUCKETS * BUCKETS)
    for cell, e, s in map_arrow(levels, run, "cell bigint, esc bigint, stay bigint").groupBy("cell").agg(F.sum("esc"), F.sum("stay")).collect():
        esc[cell], stay[cell] = e, s
    return escapes(esc, stay)


def log10_of(codes: DataFrame, trie, tables: list[DataFrame], order: int) -> DataFrame:
    """(code, points): log10 probability of distinct runs ``codes``, over the written
    levels (at most SYMBOLS runs share a context) and then the broadcast ``trie``."""
    left = codes.select("code", F.lit(0.0).alias("points"), F.lit(0.0).alias("gone_n"), F.lit(0.0).alias("gone_kinds"))
    done = []
    for k, (level, low) in zip(range(order, -1, -1), zip(tables, tables[1:])):
        below = level.withColumn("low", _last("code", k)).join(low.select(F.col("code").alias("low"), F.col("n").alias("below")), "low")
        contexts = stored(below.groupBy(F.shiftright("code", SHIFT).alias("ctx")).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.sum("below").alias("below")), "ppm-contexts")
        escape = _cells(level.withColumn("ctx", F.shiftright("code", SHIFT)).join(contexts, "ctx").select("n", "total", "kinds"))
        asked = left.withColumn("run", _last("code", k + 1)).withColumn("ctx", F.shiftright("run", SHIFT))
        asked = skew_join(asked, contexts, "ctx", "left")
        asked = skew_join(asked, level.withColumnRenamed("code", "run"), "run", "left").select("code", "points", "gone_n", "gone_kinds", "n", "total", "kinds", "below")

        def step(batches, escape=escape):
            for b in batches:
                code, points, gone_n, gone_kinds, n, total, kinds, below = (c.fill_null(0).to_numpy(zero_copy_only=False) for c in b.columns)
                known, hit = kinds > 0, n > 0
                points = points + _points(escape, known, hit, n, total - gone_n, kinds - gone_kinds)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(points), pa.array(np.where(known, below, gone_n).astype(np.float64)),
                                                  pa.array(np.where(known, kinds, gone_kinds).astype(np.float64)), pa.array(hit)],
                                                 names=["code", "points", "gone_n", "gone_kinds", "hit"])
        both = stored(map_arrow(asked, step, "code bigint, points double, gone_n double, gone_kinds double, hit boolean"), "ppm-asked")
        done.append(both.where("hit").select("code", "points"))
        left = both.where("not hit").drop("hit")

    def rest(batches):
        for b in batches:
            code, points, gone_n, gone_kinds = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(points + trie.value[0].log10(code, gone_n, gone_kinds))], names=["code", "points"])
    out = map_arrow(left, rest, "code bigint, points double")
    for d in done:
        out = out.unionAll(d)
    return out


def score(df: DataFrame, train: str, key: str = "doc_id", text: str = "text", order: int = ORDER, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """(key, train, n_tokens, n_known, train_tokens, base_score, score) of each row;
    ``train`` names a boolean column: the rows to learn from."""
    spark = df.sparkSession
    kind = dict(df.dtypes)[key]
    docs = df.select(F.col(key).alias("key"), text_bytes(text).alias("text"), F.col(train).alias("train"))
    table = stored(counts(docs, "train", "text", order), "ppm-counts")
    words = table.where("kind = 0").select("code", "train", "total")
    n_train = docs.where("train").count()
    sums = words.agg(F.coalesce(F.sum("train"), F.lit(0)), F.sum((F.col("train") > 0).cast("int")), F.coalesce(F.sum("total"), F.lit(0))).collect()[0]
    tokens, vocab = sums[0] + n_train, (sums[1] or 0) + (1 if n_train else 0)
    least = max(1, sums[2] // HEAVY)
    # words of at least 1 / HEAVY of all words: HEAVY at most
    heavy = words.where(F.col("total") > least).select("code", "train").toArrow()
    code = heavy.column("code").to_numpy().view(np.uint64)
    o = np.argsort(code)
    n_runs = table.where("kind = 1").count()
    level = table.where("kind = 1").select("code", F.col("train").alias("n"))
    in_files = order >= NEWEST and n_runs > max_entries
    if in_files:
        trie = Shards(level, order, -(-4 * n_runs // max_entries))
    else:
        got = level.toArrow()           # at most max_entries rows of 16 bytes
        trie = Trie(got.column("code").to_numpy(), got.column("n").to_numpy(), order)
    light = Words(words.where((F.col("total") <= least) & (F.col("train") > 0)))
    discard(table)
    shared = spark.sparkContext.broadcast((trie, light, code[o], heavy.column("train").to_numpy()[o]))

    def run(batches):
        trie, light, code, n = shared.value
        held = _Held(order)

        def out():
            keys, flags, n_words, logs, known, points = zip(*held.rows, strict=True)
            more, more_known = held.word_points(light)
            points = held.run_points(trie) if in_files else np.concatenate(points)
            logs, known, n_words = np.concatenate(logs) + more, np.concatenate(known) + more_known, np.concatenate(n_words)
            at = 0
            for k, f in zip(keys, flags, strict=True):
                s = slice(at, at + len(k))
                at += len(k)
                yield pa.RecordBatch.from_arrays([k, f, pa.array(n_words[s], pa.int64()), pa.array(logs[s]), pa.array(known[s], pa.int64()), pa.array(points[s])],
                                                 names=["key", "train", "n_words", "logs", "known", "score"])
        for b in batches:
            keys, flags = b.column(0), b.column(2)
            texts = b.column(1).to_pylist()
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SCORED):
                    size += len(texts[hi])
                    hi += 1
                part = texts[lo:hi]
                if in_files:
                    points = None
                    held.add_runs([events(t) for t in part])
                else:
                    points = trie.score([events(t) for t in part])
                n_words, logs, known, rest = [], [], [], []
                for t in part:
                    h = word_hashes(t)
                    n_words.append(len(h))
                    if len(code) and len(h):
                        at = np.minimum(np.searchsorted(code, h), len(code) - 1)
                        hit = code[at] == h
                        c = n[at[hit]]
                        logs.append(float(np.log10(c + 1).sum()))
                        known.append(int((c > 0).sum()))
                        h = h[~hit]
                    else:
                        logs.append(0.0)
                        known.append(0)
                    rest.append(h.view(np.int64))
                m = hi - lo
                w, at = np.unique(np.concatenate(rest), return_inverse=True)
                pair, times = np.unique(np.repeat(np.arange(m), [len(x) for x in rest]) * max(1, len(w)) + at, return_counts=True)
                own, at = pair // max(1, len(w)), pair % max(1, len(w))
                held.words.append((w[at], own.astype(np.int32), times.astype(np.int32), m))
                held.rows.append((keys.slice(lo, m), flags.slice(lo, m), np.array(n_words, np.int64), np.array(logs), np.array(known, np.int64), points))
                held.size += size + m
                if held.size >= HELD:
                    yield from out()
                    held = _Held(order)
                lo = hi
        if held.rows:
            yield from out()
    scored = stored(map_arrow(docs, run, f"key {kind}, train boolean, n_words bigint, logs double, known bigint, score double"), "ppm-scored")
    discard_folders(spark, light.folder, *([trie.folder] if in_files else []))
    n_tokens = F.col("n_words") + 1
    end = float(np.log10(n_train + 1))
    base_score = F.col("logs") + F.lit(end) - n_tokens * F.lit(float(np.log10(tokens + vocab + 1)))
    return scored.select(F.col("key").alias(key), "train", n_tokens.alias("n_tokens"), (F.col("known") + (1 if n_train else 0)).alias("n_known"),
                    F.lit(tokens).cast("long").alias("train_tokens"), base_score.alias("base_score"), "score")


def score_held_out(df: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, held_out: int = 2, **kw) -> DataFrame:
    """``score`` with the rows of one fold kept out of training, flagged ``held_out``."""
    flagged = df.withColumn("__train", crc32_mod(key, folds) != held_out)
    return score(flagged, "__train", key, text, **kw).withColumn("held_out", ~F.col("train")).drop("train")
