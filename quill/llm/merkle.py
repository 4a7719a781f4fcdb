"""Merkle manifest of a dataset by sibling-shift self-joins.

Every row is a leaf: the SHA-256 of its columns, each written as ``-`` if null, else
as its number of UTF-8 bytes, a colon and its value. Leaves of one group (``source``)
are numbered by key in a forest of trees of ``arity``. At each level a node's siblings
have computed indices: the slot-zero rows ask for the indices at slot offsets
0 .. arity-1 (for arity 2: index XOR 0 and 1) in one equijoin of the level with itself,
put the answers in slot order and emit the parent. Groups whose tree has come down to
one node wait; their subroots, ordered by group (null first, UTF-8 bytewise), are the
leaves of one last tree of the same kind.

A proof is the list of a leaf's siblings from its level to the root, left to right.
Going down again, each level takes its siblings from its run and the rest from its
parent by an equijoin on (tree, parent), which has at most ``arity`` rows a key. Folding
starts from any leaf and hashes run by run with the own place replaced.

Every join key is a unique node or a parent of at most ``arity`` nodes, so no group, however large,
meets in one task. The number of levels is the logarithm of the largest group. Only digests
travel; whole texts are hashed where they are read. Written tables cut the lineage of
each level.

Rows with equal keys are ordered by their digest; a null key comes first and counts as
never tampered. Null columns have their mark, null and empty differ. Empty tables give
no rows. A single leaf is its own subroot; with one group the subroot is the root; a
proof without siblings is the digest of nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.llm.tables import skew_join, stored
from quill.plans.order import dense_index

ARITY = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*values: Column) -> Column:
    """SHA-256 of the joined strings, as raw bytes (32 of them travel, not 64)."""
    return F.unhex(F.sha2(F.concat(*values).cast("binary"), 256))


def hexed(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(df: DataFrame, key: str, group: str, columns: tuple[str, ...], altered: dict[str, Column], when: Column) -> DataFrame:
    """Written table (tree, idx, width, id, node, other): the leaf of every row, its place
    in its group's tree of ``width`` leaves, and the leaf that the row would have with the
    ``altered`` columns, null unless ``when``."""
    plain = digest(*(encoded(F.col(c)) for c in columns))
    other = digest(*(encoded(altered.get(c, F.col(c))) for c in columns))
    rows = stored(df.select(F.col(key).alias("id"), F.col(group).cast("string").alias("grp"), encoded(F.col(group)).alias("mark"),
                            plain.alias("node"), F.when(when, other).alias("other")), "leaves")
    sizes = rows.groupBy("mark", "grp").agg(F.count("*").alias("width"))
    trees = stored(dense_index(sizes, ["grp"], out="tree"), "trees")
    placed = dense_index(rows, ["id", "node"], out="idx", partition_by=["mark"])
    return stored(skew_join(placed, trees.select("mark", "tree", "width"), "mark").select("tree", "idx", "width", "id", "node", "other"), "placed")


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, hexed), "")


def _emit_parents(nodes: DataFrame, arity: int) -> DataFrame:
    """Written table (tree, parent, width, run, node) of a level's trees of several nodes:
    each run's digests in slot order, and the digest of the run."""
    nodes = nodes.where("width > 1")
    zero = nodes.where(F.col("idx") % arity == 0).select("tree", "width", F.col("idx").alias("zero"))
    wanted = zero.withColumn("slot", F.explode(F.sequence(F.lit(0), F.least(F.lit(arity), F.col("width") - F.col("zero")).cast("int") - 1)))
    sibling = F.col("zero").bitwiseXOR(F.col("slot").cast("bigint")) if arity == 2 else F.col("zero") + F.col("slot")
    met = wanted.withColumn("idx", sibling).join(nodes.select("tree", "idx", "node"), ["tree", "idx"])
    run = F.transform(F.array_sort(F.collect_list(F.struct("slot", "node"))), lambda x: x["node"])     # at most ``arity``
    runs = met.groupBy("tree", "zero", "width").agg(run.alias("run"))
    return stored(runs.select("tree", F.floor(F.col("zero") / arity).alias("parent"), "width", "run", digest(_joined(F.col("run"))).alias("node")), "runs")


def _levels(nodes: DataFrame, arity: int, widest: int) -> list[tuple[DataFrame, DataFrame | None]]:
    """(nodes, runs) of each level; the last one has only trees of one node, and no runs."""
    out = []
    while widest > 1:
        runs = _emit_parents(nodes, arity)
        out.append((nodes, runs))
        nodes = runs.select("tree", F.col("parent").alias("idx"), F.ceil(F.col("width") / arity).alias("width"), "node")
        widest = -(-widest // arity)
    return [*out, (nodes, None)]


def _descend(nodes: DataFrame, runs: DataFrame, above: DataFrame, arity: int) -> DataFrame:
    """Nodes of trees of several nodes with their steps to the root: their own siblings,
    then the steps of their parent (``above``: tree, idx, steps, subroot)."""
    up = runs.select("tree", "parent", "run").join(above.withColumnRenamed("idx", "parent"), ["tree", "parent"])
    met = nodes.where("width > 1").withColumn("parent", F.floor(F.col("idx") / arity)).join(up, ["tree", "parent"])
    slot = (F.col("idx") % arity).cast("int")
    own = F.struct(_joined(F.slice("run", F.lit(1), slot)).alias("left"), _joined(F.slice("run", slot + 2, F.lit(arity))).alias("right"))
    return met.withColumn("steps", F.concat(F.array(own), F.col("steps"))).drop("parent", "run")


def proofs(df: DataFrame, key: str = "doc_id", group: str = "source", columns: tuple[str, ...] = COLUMNS, altered: dict[str, Column] | None = None,
           when: Column | None = None, arity: int = ARITY) -> tuple[DataFrame, str | None]:
    """(id, node, other, subroot, steps) of every row, and the root in hex (None without
    rows). ``steps`` lists the level's siblings left and right of the own place, leaf first."""
    placed = leaves(df, key, group, columns, altered or {}, F.lit(False) if when is None else when)
    widest, n_trees = placed.agg(F.max("width"), F.max("tree")).collect()[0]
    forest = _levels(placed, arity, widest or 0)
    subroots = reduce(DataFrame.unionByName, [n.where("width = 1").select("tree", "node") for n, _ in forest])
    tops = stored(subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.lit((n_trees or 0) + 1).cast("bigint").alias("width"), "node"), "subroots")
    crown = _levels(tops, arity, (n_trees or 0) + 1)
    root = crown[-1][0].select(hexed(F.col("node"))).collect()
    none = F.array().cast("array<struct<left:string,right:string>>")
    steps = crown[-1][0].select("tree", "idx", none.alias("steps"))
    for nodes, runs in reversed(crown[:-1]):
        steps = _descend(nodes, runs, steps, arity).select("tree", "idx", "steps")
    top = steps.select(F.col("idx").alias("tree"), "steps").join(tops.select(F.col("idx").alias("tree"), F.col("node").alias("subroot")), "tree")
    top, above = stored(top, "steps"), None
    for level, (nodes, runs) in reversed(list(enumerate(forest))):
        here = nodes.where("width = 1").join(top, "tree")
        if above is not None:
            here = here.unionByName(_descend(nodes, runs, above, arity))
        if level:       # a written table again: the plan stays small, a lost executor costs one level
            above = stored(here.select("tree", "idx", "steps", "subroot"), "steps")
    return here.select("id", "node", "other", "subroot", "steps"), root[0][0] if root else None


def audit(df: DataFrame, key: str = "doc_id", group: str = "source", columns: tuple[str, ...] = COLUMNS, text: str = "text", every: int = 5, arity: int = ARITY) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row. Rows whose
    crc32 of the key is divisible by ``every`` are folded from a tampered leaf: A-Z of ``text`` lower-cased."""
    hit = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % every == 0, F.lit(False))
    rows, root = proofs(df, key, group, columns, {text: F.translate(text, _UPPER, _LOWER)}, hit, arity)
    proof = F.sha2(F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)
    folded = F.aggregate("steps", hexed(F.coalesce("other", "node")), lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]).cast("binary"), 256))
    return rows.select(F.col("id").alias(key), hexed(F.col("node")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), F.lit(root).cast("string").alias("root"),
                       proof.alias("proof_sha256"), folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
