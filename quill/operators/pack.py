"""Packing and batching jobs over token-id arrays.

The stream of documents (each ``ids ARRAY<INT>``, BOS already prepended) is
cut into blocks of ``B*T+1`` tokens with no overlap. Each document emits only
the fragments of the blocks it spans (from its two-level prefix-sum offset);
blocks are assembled by ``groupBy(block)`` whose groups are bounded by the
block size, so no task ever holds more than one block per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quill.plans.order import prefix_sum
from quill.session import reliable_checkpoint


def token_offsets(df: DataFrame, order: Sequence[str], ids: str = "ids",
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """Start offset of each document in its stream (exclusive prefix of lengths)."""
    return prefix_sum(df, order, F.size(ids).cast("long"), out="offset", inclusive=False,
                      partition_by=partition_by)


def pack(df: DataFrame, B: int, T: int, order: Sequence[str] = ("doc_id",), ids: str = "ids",
         epochs: int = 1) -> DataFrame:
    """``(block, row, inputs, targets)``; targets are inputs shifted by one.

    ``B*T+1`` tokens are consumed per block; the final incomplete block is
    dropped. With ``epochs > 1`` the stream repeats in the same order.
    """
    L = B * T + 1
    order = list(order)
    d = df.select(*order, ids)
    d = token_offsets(d, order, ids)
    if epochs > 1:
        # every epoch is the same stream, moved by the tokens of those before it
        total = d.agg(F.max(F.col("offset") + F.size(ids))).scalar()
        d = (d.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
             .withColumn("offset", F.col("offset") + F.col("epoch") * F.coalesce(total, F.lit(0))))
    n_tok = F.size(ids).cast("long")
    first = F.floor(F.col("offset") / L)
    last = F.floor((F.col("offset") + n_tok - 1) / L)
    off = F.col("offset")

    def fragment(b):
        start = F.greatest(off, b * L)
        end = F.least(off + n_tok, (b + 1) * L)
        return F.struct(b.alias("block"), start.alias("s"),
                        F.slice(ids, (start - off + 1).cast("int"), (end - start).cast("int")).alias("frag"))
    # slices are cut inside the row, so each exploded row holds only its own
    # fragment (linear in the document, however many blocks it spans)
    frags = (d.where(n_tok > 0)
             .select(F.explode(F.transform(F.sequence(first, last), fragment)).alias("f"))
             .select("f.block", "f.s", "f.frag"))
    blocks = (frags.groupBy("block")
              .agg(F.array_sort(F.collect_list(F.struct("s", "frag"))).alias("fr"))
              .select("block", F.flatten(F.transform("fr", lambda x: x["frag"])).alias("tokens"))
              .where(F.size("tokens") == L))
    rows = blocks.select("block", "tokens", F.explode(F.sequence(F.lit(0), F.lit(B - 1))).alias("row"))
    return rows.select("block", "row",
                       F.slice("tokens", F.col("row") * T + 1, T).alias("inputs"),
                       F.slice("tokens", F.col("row") * T + 2, T).alias("targets"))


def pad_array(arr: Column, width: Column, pad: Column) -> Column:
    return F.concat(arr, F.array_repeat(pad, F.greatest(width - F.size(arr), F.lit(0)).cast("int")))


def collate_sft(df: DataFrame, batch_size: int, pad_id: int, idx: str = "idx", ids: str = "ids",
                mask: str = "mask", skip_short: bool = True, drop_partial: bool = True) -> DataFrame:
    """E5: batches of ``batch_size`` sequences in ``idx`` order.

    Width = longest sequence − 1; inputs padded with ``pad_id``; targets are
    ids[1:] with −1 where mask[1:] = 0 and on padding. Sequences shorter than
    2 tokens are skipped (``skip_short``); the final partial batch is dropped
    (``drop_partial``) or kept.
    """
    d = df
    if skip_short:
        d = d.where(F.size(ids) >= 2)
        from quill.plans.order import dense_index
        d = dense_index(d.withColumnRenamed(idx, "__orig"), ["__orig"], out=idx).drop("__orig")
    d = d.withColumn("batch", F.floor(F.col(idx) / batch_size))
    sizes = d.groupBy("batch").agg(F.count(F.lit(1)).alias("__n"), (F.max(F.size(ids)) - 1).alias("width"))
    if drop_partial:
        sizes = sizes.where(F.col("__n") == batch_size)
    d = d.join(sizes, "batch")
    n1 = F.size(ids) - 1
    inputs = pad_array(F.slice(ids, 1, n1), F.col("width"), F.lit(pad_id))
    tgt = F.zip_with(F.slice(ids, 2, n1), F.slice(mask, 2, n1), lambda t, m: F.when(m == 0, F.lit(-1)).otherwise(t))
    targets = pad_array(tgt, F.col("width"), F.lit(-1))
    return d.select("batch", (F.col(idx) % batch_size).alias("row"), F.col(idx),
                    inputs.alias("inputs"), targets.alias("targets"))


def pad_prompts(df: DataFrame, batch_size: int, bos_id: int, idx: str = "idx",
                ids: str = "ids") -> DataFrame:
    """Right-pad prompts with BOS to the batch maximum; answer position = len − 1."""
    d = df.withColumn("batch", F.floor(F.col(idx) / batch_size))
    mx = d.groupBy("batch").agg(F.max(F.size(ids)).alias("width"))
    d = d.join(mx, "batch")
    return d.select("batch", idx, pad_array(F.col(ids), F.col("width"), F.lit(bos_id)).alias("padded"),
                    (F.size(ids) - 1).alias("answer_pos"))


def pad_rollouts(df: DataFrame, pad_id: int, prompt: str = "prompt", ids: str = "ids",
                 mask: str = "mask") -> DataFrame:
    """Pad the samples of a prompt to equal length (pad token, mask 0);
    inputs = ids[:-1], targets = ids[1:] with −1 where mask[1:] = 0."""
    mx = df.groupBy(prompt).agg(F.max(F.size(ids)).alias("width"))
    d = df.join(mx, prompt)
    pid = pad_array(F.col(ids), F.col("width"), F.lit(pad_id))
    pm = pad_array(F.col(mask), F.col("width"), F.lit(0))
    d = d.withColumn("__ids", pid).withColumn("__m", pm)
    w1 = F.col("width") - 1
    targets = F.zip_with(F.slice("__ids", 2, w1), F.slice("__m", 2, w1),
                         lambda t, m: F.when(m == 0, F.lit(-1)).otherwise(t))
    return d.select(*[c for c in df.columns if c not in (ids, mask)],
                    F.slice("__ids", 1, w1).alias("inputs"), targets.alias("targets"))


def common_prefix_len(a: Column, b: Column) -> Column:
    n = F.least(F.size(a), F.size(b))
    diff = F.array_position(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                        lambda i: F.when(i <= n, a[i - 1] != b[i - 1]).otherwise(F.lit(False))),
                            True)
    return F.when(diff == 0, n).otherwise(diff - 1).cast("int")


def option_spans(df: DataFrame, kind: str, item: str = "item", option: str = "option",
                 ids: str = "ids") -> DataFrame:
    """``(item, option, start, end)`` continuation spans.

    ``mc``: start = common prefix of all options of the item; ``schema``:
    start = end − common suffix. Each option is compared with the item's
    first option by an equi-join (≤ options per item), then a min per item.
    """
    if kind not in ("mc", "schema"):
        raise ValueError("kind must be mc or schema (lm: see lm_spans)")
    first = (df.groupBy(item).agg(F.min_by(ids, F.col(option)).alias("__ref")))
    j = df.join(first, item)
    if kind == "mc":
        c = common_prefix_len(F.col(ids), F.col("__ref"))
    else:
        c = common_prefix_len(F.reverse(F.col(ids)), F.reverse(F.col("__ref")))
    per = j.select(item, option, F.size(ids).alias("end"), c.alias("__c"))
    m = per.groupBy(item).agg(F.min("__c").alias("__common"))
    out = per.join(m, item)
    start = F.col("__common") if kind == "mc" else F.col("end") - F.col("__common")
    return out.select(item, option, start.cast("int").alias("start"), F.col("end").cast("int").alias("end"))


def lm_spans(df: DataFrame, without: str = "ids_without", with_: str = "ids_with") -> DataFrame:
    """E8 (lm): start = len(without), end = len(with); flags when not a strict prefix."""
    ok = (F.size(without) < F.size(with_)) & (F.slice(with_, 1, F.size(without)) == F.col(without))
    return df.withColumn("start", F.size(without)).withColumn("end", F.size(with_)).withColumn("is_prefix", ok)


def crop_left(df: DataFrame, max_tokens: int, ids: str = "ids", start: str = "start",
              end: str = "end") -> DataFrame:
    """Keep the last ``max_tokens`` tokens and shift the span; flag negative spans."""
    over = F.greatest(F.size(ids) - max_tokens, F.lit(0))
    return (df.withColumn("__over", over)
            .withColumn(ids, F.when(F.col("__over") > 0, F.slice(ids, -max_tokens, max_tokens)).otherwise(F.col(ids)))
            .withColumn(start, F.col(start) - F.col("__over"))
            .withColumn(end, F.col(end) - F.col("__over"))
            .withColumn("span_ok", (F.col(start) >= 0) & (F.col(end) >= 0))
            .drop("__over"))


def training_budget(counts: DataFrame, total_batch_size: int, num_params: int,
                    chars_per_shard: int = 250_000_000, num_iterations: int | None = None,
                    target_flops: float | None = None, flops_per_token: float | None = None,
                    param_data_ratio: float | None = None) -> DataFrame:
    """Iterations, tokens:params ratio and shards needed for 20 tokens/param at
    the measured chars/token.

    Iterations are, in this order: those given; those that spend ``target_flops`` at
    ``flops_per_token``; those of ``param_data_ratio`` tokens per parameter; else one
    pass over the data, max(1, max(1, tokens − 1) div batch)."""
    sup = F.greatest(F.col("tokens") - 1, F.lit(1))
    iters = F.greatest(F.floor(sup / total_batch_size), F.lit(1))
    if num_iterations:
        iters = F.lit(int(num_iterations))
    elif target_flops:
        if not flops_per_token:
            raise ValueError("target_flops needs flops_per_token")
        iters = F.lit(round(target_flops / (flops_per_token * total_batch_size)))
    elif param_data_ratio:
        iters = F.lit(int(param_data_ratio * num_params // total_batch_size))
    chars_needed = F.lit(20 * num_params) * F.col("chars_per_token")
    return counts.select(
        "tokens", iters.cast("long").alias("num_iterations"),
        F.round(F.lit(float(total_batch_size)) * iters / F.lit(num_params), 6).alias("tokens_per_param"),
        F.ceil(chars_needed / chars_per_shard).cast("long").alias("shards_needed"))


def pack_conversations(rendered: DataFrame, B: int, T: int, rank: int, world: int,
                       idx: str = "idx", ids: str = "ids") -> DataFrame:
    """Rendered conversations (dense ``idx``) strided by rank, then packed.

    Adds ``progress`` = fraction of this rank's conversations consumed up to
    the end of each block.
    """
    # rendered once: its rows feed the offsets, the blocks and the counts
    mine = reliable_checkpoint(rendered.where(F.pmod(F.col(idx), F.lit(world)) == rank))
    total = mine.count()
    p = token_offsets(mine, [idx], ids)
    blocks = pack(mine, B, T, [idx], ids)
    L = B * T + 1
    # conversations that end in each block; blocks in which none ends still count
    # those before them
    ends = p.select(F.floor((F.col("offset") + F.size(ids) - 1) / L).alias("block"), F.lit(1).alias("__done"))
    every = blocks.select("block", F.lit(0).alias("__done")).distinct()
    per = ends.unionByName(every).groupBy("block").agg(F.sum("__done").alias("__done"))
    cum = prefix_sum(per, ["block"], "__done", out="__cum")
    return blocks.join(cum.select("block", "__cum"), "block", "left").withColumn(
        "progress", F.round(F.col("__cum") / F.lit(max(total, 1)), 6)).drop("__cum")


def sft_steps(n_examples: int, examples_per_step: int, epochs: int = 1, mode: str = "floor") -> int:
    """Q25: optimizer steps for SFT — floor division (chat SFT) or at least one
    ceil step (the parliamentary SFT). Scalar planning arithmetic on a count."""
    if mode == "floor":
        return (n_examples // examples_per_step) * epochs
    return max(1, -(-n_examples // examples_per_step) * epochs)
