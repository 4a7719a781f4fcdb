"""Near-duplicate vectors by randomised-rotation binary codes.

Vectors of one label whose cosine is at least ``threshold`` link. Each distinct
vector x (unit length) is rotated by a fixed random rotation R and stored as the
signs of R x, packed to bits, with its correction factor c = <code, R x> (the
code scaled to unit length). For another rotated unit vector q, <code, q> / c is an
unbiased estimate of <x, q> over rotations, and the error is bounded: what q has
orthogonal to x meets only the part of the code orthogonal to x, so

    <code, q>  >=  c * t - sqrt(1 - c^2) * sqrt(1 - t^2)    whenever <x, q> >= t.

Pairs below this bound cannot link and are dismissed; the others are recomputed in
double precision from the full vectors. The bound is certain, so no link is lost.

Distribution: equal vectors of a label are one class and enter once, however many
copies there are. A label's classes are dealt to blocks of about ``BLOCK`` rows by
hash, and each pair of blocks is one task, so no label meets in one task whole and
every pair of classes is looked at once, by its code. A task returns no pairs: only
how many rows each vector links to, and a spanning set of links for the components.

Null vectors, zero vectors, null labels and vectors with null or non-finite
components link with nothing, and neither do vectors of unequal length. Rows with a
null id count as copies but never name a component. Repeated rows are each a row
and a link to their copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.components import components
from quill.llm.tables import map_arrow, skew_join, stored

BLOCK = 2000            # classes of one block


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed + dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated rows, packed sign bits, correction factors."""
    turned = unit @ rotation(unit.shape[1]).T
    bits = turned >= 0
    return turned, np.packbits(bits, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])


def matches(a: np.ndarray, b: np.ndarray, threshold: float, slab: int = 512):
    """Yields index pairs (i of a, j of b) of unit rows with cosine >= threshold."""
    _, code, c = encode(a)
    turned = (b @ rotation(b.shape[1]).T).astype(np.float32)
    dim = a.shape[1]
    # a hair below the bound: single precision must not dismiss
    bound = (c * threshold - np.sqrt(np.maximum(0, 1 - c * c)) * np.sqrt(1 - threshold * threshold) - 1e-4).astype(np.float32)
    for lo in range(0, len(a), slab):
        signs = np.unpackbits(code[lo:lo + slab], axis=1, count=dim).astype(np.float32) * np.float32(2 / np.sqrt(dim)) - np.float32(1 / np.sqrt(dim))
        i, j = np.nonzero(signs @ turned.T >= bound[lo:lo + slab, None])
        for at in range(0, len(i), 200_000):
            x, y = i[at:at + 200_000] + lo, j[at:at + 200_000]
            ok = np.einsum("ij,ij->i", a[x], b[y]) >= threshold
            yield x[ok], y[ok]


def join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Lower the labels of connected rows to a common one."""
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new[label]]
        if (new == label).all():
            return label
        label = new
        keep = label[i] != label[j]
        i, j = i[keep], j[keep]
    return label


def usable(df: DataFrame, key: str, vec: str, label: str) -> DataFrame:
    """(key, label, v array<double>) of the rows that can link."""
    v = F.col(vec).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.select(F.col(key).alias("id"), F.col(label).alias("label"), v.alias("v"))
            .where(F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
            .where(F.forall("v", lambda x: x.isNotNull())).where(finite & F.exists("v", lambda x: x != 0)))


def _units(col) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in col])
    x = x / np.abs(x).max(axis=1, keepdims=True)          # no overflow or underflow in the norm
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def near_duplicates(df: DataFrame, key: str = "vec_id", vec: str = "embedding", label: str = "label", threshold: float = 0.93) -> DataFrame:
    """(key, n_links, component_id, kept) of each row of ``df``."""
    rows = usable(df, key, vec, label)
    # adding 0.0 makes -0.0 and 0.0 one value
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).withColumn("cls", F.sha2(F.to_json(F.struct("label", "v")).cast("binary"), 256))
    rows = stored(rows, "vectors")
    # all rows of a class hold the same vector
    classes = stored(rows.groupBy("cls").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
                     .withColumn("node", F.xxhash64("cls")), "classes")
    group = F.to_json(F.struct(F.col("label"), F.size("v").alias("dim")))
    vectors = classes.select(group.alias("grp"), "node", "copies", "v")
    blocks = vectors.groupBy("grp").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / BLOCK)).cast("int").alias("blocks"))
    dealt = skew_join(vectors, blocks, "grp").withColumn("block", F.pmod("node", F.col("blocks")).cast("int"))
    placed = dealt.select("grp", "node", "copies", "v", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    keys = ["grp", "lo", "hi"]
    placed = (placed.select("grp", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "copies", "v")
              .repartition(*keys).sortWithinPartitions(*keys))

    def solve(batches):
        """Groups arrive sorted; one is held at a time (two blocks at most)."""
        current, held = None, []

        def out():
            _, lo, hi = current
            block = np.array([r[0] for r in held])
            node = np.array([r[1] for r in held], np.int64)
            copies = np.array([r[2] for r in held], np.float64)
            x = _units([r[3] for r in held])
            a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
            links, label = np.zeros(len(held)), np.arange(len(held))
            for i, j in matches(x[a], x[b], threshold):
                i, j = a[i], b[j]
                if lo == hi:
                    once = i < j
                    i, j = i[once], j[once]
                links += np.bincount(i, copies[j], len(held)) + np.bincount(j, copies[i], len(held))
                label = join(label, i, j)
            n, e = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(held)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([node[n], node[e]])), pa.array([None] * len(n) + node[label[e]].tolist(), pa.int64()),
                 pa.array(links[n].astype(np.int64).tolist() + [None] * len(e), pa.int64())], names=["node", "to", "links"])
        for b in batches:
            cols = [c.to_pylist() for c in b.columns[:6]]
            flat, at = b.column(6).values.to_numpy(zero_copy_only=False), b.column(6).offsets.to_numpy()
            for r, (g, lo, hi, block, node, copies) in enumerate(zip(*cols, strict=True)):
                if (g, lo, hi) != current:
                    if held:
                        yield from out()
                    current, held = (g, lo, hi), []
                held.append((block, node, copies, flat[at[r]:at[r + 1]].copy()))
        if held:
            yield from out()
    solved = stored(map_arrow(placed, solve, "node bigint, to bigint, links bigint"), "links")
    found = components(solved.where(F.col("to").isNotNull()), "node", "to")
    others = solved.where(F.col("to").isNull()).groupBy("node").agg(F.sum("links").alias("others"))
    named = classes.join(found, "node", "left").withColumn("root", F.coalesce("component", "node")).join(others, "node", "left")
    lowest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = skew_join(named, lowest, "root").select("cls", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    linked = rows.select(F.col("id").alias(key), "cls").join(named, "cls").select(key, "n_links", F.coalesce("component_id", key).alias("component_id"))
    v = F.col(vec).cast("array<double>")
    finite = F.col(label).isNotNull() & F.col(vec).isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull())
    finite = F.coalesce(finite & F.forall(v, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    alone = df.where(~finite).select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col(key) == F.col("component_id"))
