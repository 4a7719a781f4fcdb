"""Conversation jobs over the long form ``(conv_id, turn, role, text)``.

``turn`` is the 0-based message position. Everything per conversation is a
row-level expression plus a partial/final aggregate or an equi-join of at
most two rows per conversation, so a huge conversation never lands whole in
one task or one array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.plans.order import dense_index, seeded_key

# ---------------------------------------------------------------------------
# Request limits of the chat service.
MAX_MESSAGES_PER_REQUEST = 500
MAX_MESSAGE_LENGTH = 8000
MAX_TOTAL_CONVERSATION_LENGTH = 32000
# ---------------------------------------------------------------------------


def _expected(pos: Column) -> Column:
    return F.when(pos % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))


def validate_conversations(df: DataFrame, ruleset: str = "chat", key: str = "conv_id",
                           turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Reject reasons per conversation (``reasons`` joined by ';', '' when valid).

    Rulesets: ``chat`` optional leading system, ≥2 after it, alternating from
    user; ``jsonl`` ≥2, alternating from user at position 0 (no system);
    ``render`` a leading system must be followed by a user turn, ≥1 after the
    merge, alternating.
    """
    t, r = F.col(turn), F.col(role)
    sys0 = (t == 0) & (r == "system")
    agg = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.max(sys0.cast("int")).alias("has_system"),
        # null-safe: an absent role is a wrong one
        F.sum((~r.eqNullSafe(_expected(t))).cast("int")).alias("viol0"),
        F.sum(((t >= 1) & ~r.eqNullSafe(_expected(t - 1))).cast("int")).alias("viol1"),
        F.sum(F.col(text).isNull().cast("int")).alias("n_null") if text in df.columns else F.lit(0).alias("n_null"),
        F.max(F.when(t == 1, r)).alias("role1"),
    )
    n, hs = F.col("n_messages"), F.col("has_system") == 1
    if ruleset == "chat":
        rest = F.when(hs, n - 1).otherwise(n)
        viol = F.when(hs, F.col("viol1")).otherwise(F.col("viol0"))
        checks = [(rest < 2, "too_few_messages"), (viol > 0, "bad_alternation")]
    elif ruleset == "jsonl":
        checks = [(n < 2, "too_few_messages"), (F.col("viol0") > 0, "bad_alternation")]
    elif ruleset == "render":
        merged_n = F.when(hs, n - 1).otherwise(n)
        sys_bad = hs & (F.coalesce(F.col("role1"), F.lit("")) != "user")
        viol = F.when(hs, F.col("viol1")).otherwise(F.col("viol0"))
        checks = [(sys_bad, "system_not_followed_by_user"), (merged_n < 1, "empty"),
                  (viol > 0, "bad_alternation")]
    else:
        raise ValueError(f"unknown ruleset {ruleset}")
    checks.append((F.col("n_null") > 0, "missing_content"))
    reasons = F.concat_ws(";", *[F.when(c, F.lit(name)) for c, name in checks])
    return agg.select(key, "n_messages", reasons.alias("reasons"), (reasons == "").alias("valid"))


def audit_request_limits(df: DataFrame, key: str = "conv_id", role: str = "role",
                         text: str = "text") -> DataFrame:
    """Chat-service request limits as reasons per conversation."""
    ln = F.coalesce(F.length(text), F.lit(0))
    agg = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.sum((ln == 0).cast("int")).alias("n_empty"),
        F.max(ln).alias("max_len"),
        F.sum(ln).alias("total_len"),
        F.sum((~F.coalesce(F.col(role).isin("user", "assistant"), F.lit(False))).cast("int")).alias("n_bad_role"))
    checks = [(F.col("n_messages") > MAX_MESSAGES_PER_REQUEST, "too_many_messages"),
              (F.col("n_empty") > 0, "empty_message"),
              (F.col("max_len") > MAX_MESSAGE_LENGTH, "message_too_long"),
              (F.col("total_len") > MAX_TOTAL_CONVERSATION_LENGTH, "conversation_too_long"),
              (F.col("n_bad_role") > 0, "invalid_role")]
    reasons = F.concat_ws(";", *[F.when(c, F.lit(n)) for c, n in checks])
    return agg.select(key, "n_messages", "total_len", reasons.alias("reasons"), (reasons == "").alias("valid"))


def merge_system(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """Fold a leading system message into the next (user) turn with a blank line.

    Equi-join of the system row onto turn 1 (≤ one row per side per
    conversation); turns are renumbered so position 0 is the first kept turn.
    """
    sys = df.where((F.col(turn) == 0) & (F.col(role) == "system")).select(
        F.col(key), F.col(text).alias("__sys"))
    rest = df.where(~((F.col(turn) == 0) & (F.col(role) == "system")))
    j = rest.join(sys, key, "left")
    has = F.col("__sys").isNotNull()
    new_text = F.when(has & (F.col(turn) == 1), F.concat(F.col("__sys"), F.lit("\n\n"), F.col(text))) \
        .otherwise(F.col(text))
    new_turn = F.when(has, F.col(turn) - 1).otherwise(F.col(turn))
    return j.select(key, new_turn.alias(turn), role, new_text.alias(text))


def render_segments(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text", merged: bool = False) -> DataFrame:
    """Ordered ``(conv_id, seg_no, kind, value, mask)`` segments of a rendering.

    BOS (mask 0); user: user_start, text, user_end (all 0); assistant:
    assistant_start (0), text (1), assistant_end (1). ``kind`` is
    'special' or 'text'. Any other role, or none, is an error: it must not
    become supervised text. String content only (parts go through
    ``render_part_segments``).
    """
    m = df if merged else merge_system(df, key, turn, role, text)
    is_user = (F.when(F.col(role) == "user", True).when(F.col(role) == "assistant", False)
               .otherwise(F.raise_error(F.concat(F.lit("cannot render role "), F.coalesce(F.col(role), F.lit("NULL"))))))
    segs = F.array(
        F.struct(F.lit(0).alias("k"), F.lit("special").alias("kind"),
                 F.when(is_user, "<|user_start|>").otherwise("<|assistant_start|>").alias("value"),
                 F.lit(0).alias("mask")),
        F.struct(F.lit(1).alias("k"), F.lit("text").alias("kind"), F.col(text).alias("value"),
                 F.when(is_user, 0).otherwise(1).alias("mask")),
        F.struct(F.lit(2).alias("k"), F.lit("special").alias("kind"),
                 F.when(is_user, "<|user_end|>").otherwise("<|assistant_end|>").alias("value"),
                 F.when(is_user, 0).otherwise(1).alias("mask")))
    body = m.select(key, turn, F.explode(segs).alias("s")).select(
        key, (F.col(turn) * 3 + F.col("s.k") + 1).alias("seg_no"),
        F.col("s.kind").alias("kind"), F.col("s.value").alias("value"), F.col("s.mask").alias("mask"))
    bos = m.select(key).distinct().select(key, F.lit(0).cast("long").alias("seg_no"),
                                           F.lit("special").alias("kind"), F.lit("<|bos|>").alias("value"),
                                           F.lit(0).alias("mask"))
    return bos.unionByName(body.withColumn("seg_no", F.col("seg_no").cast("long")))


def render_for_completion_segments(df: DataFrame, key: str = "conv_id", turn: str = "turn",
                                   role: str = "role", text: str = "text") -> DataFrame:
    """C6 (segments): render without the final assistant turn, then assistant_start."""
    last = df.groupBy(key).agg(F.max(turn).alias("__last"),
                               F.max_by(role, turn).alias("__last_role"))
    kept = df.join(last.where(F.col("__last_role") == "assistant"), key)
    body = render_segments(kept.where(F.col(turn) != F.col("__last")).drop("__last", "__last_role"),
                           key, turn, role, text)
    n = body.groupBy(key).agg(F.max("seg_no").alias("seg_no"))
    tail = n.select(key, (F.col("seg_no") + 1).alias("seg_no"), F.lit("special").alias("kind"),
                    F.lit("<|assistant_start|>").alias("value"), F.lit(0).alias("mask"))
    return body.unionByName(tail)


def mix(tasks: Sequence[DataFrame], seed: int = 42, local_idx: str = "local_idx") -> DataFrame:
    """UNION ALL of tasks (a task listed twice is oversampled) + seeded global order.

    Each input carries a 0-based ``local_idx``. Output adds ``task_idx``,
    ``copy``, ``shuffle_key`` and dense ``idx`` (two-level prefix count).
    """
    seen: dict[int, int] = {}
    parts = []
    for ti, t in enumerate(tasks):
        copy = seen.get(id(t), 0)
        seen[id(t)] = copy + 1
        parts.append(t.withColumn("task_idx", F.lit(ti)).withColumn("copy", F.lit(copy)))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    u = u.withColumn("shuffle_key", seeded_key(seed, "task_idx", "copy", local_idx))
    return dense_index(u, ["shuffle_key"], out="idx")


def sequence(tasks: Sequence[DataFrame], local_idx: str = "local_idx") -> DataFrame:
    """Ordered concatenation; ``idx`` = running size of earlier tasks + local index."""
    u = None
    for ti, t in enumerate(tasks):
        p = t.withColumn("task_idx", F.lit(ti))
        u = p if u is None else u.unionByName(p)
    sizes = u.groupBy("task_idx").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    # one row per task: a tiny window
    offs = sizes.select("task_idx", F.coalesce(F.sum("n").over(
        Window.orderBy("task_idx").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    return u.join(F.broadcast(offs), "task_idx").withColumn("idx", F.col("offset") + F.col(local_idx)).drop("offset")


def ratio_split(df: DataFrame, key: str, val_ratio: float = 0.05, seed: int = 42) -> DataFrame:
    """C11: seeded shuffle; the last ``max(1, int(n·r))`` rows (at most n−1) are val.

    Needs n ≥ 2. Sizes are exact (not ``randomSplit``).
    """
    k = df.withColumn("shuffle_key", seeded_key(seed, key))
    k = dense_index(k, ["shuffle_key"], out="rank")
    n = df.agg(F.count(F.lit(1))).scalar()   # scalar subquery
    n_val = F.least(F.greatest(F.lit(1), F.floor(n * F.lit(val_ratio))), n - 1)
    return k.withColumn("split", F.when(F.col("rank") >= n - n_val, "val").otherwise("train"))


def render_conversation(df: DataFrame, merges: DataFrame, max_tokens: int = 2048,
                        key: str = "conv_id", turn: str = "turn", role: str = "role",
                        text: str = "text", segments: DataFrame | None = None,
                        special_tokens: list[str] | None = None) -> DataFrame:
    """C4: ``(conv_id, ids, mask)`` with truncation to ``max_tokens`` (Q12-Q15).

    Segments are encoded map-side (text through the BPE encoder, specials by
    a fixed id map after the merged ranks); token offsets are per-conversation
    prefix sums; only the kept part (≤ max_tokens per conversation) is
    collected, so no group is unbounded.
    """
    from quill.functions.text import SPECIAL_TOKENS
    from quill.operators.bpe import make_encoder, pretokenize_col
    from quill.plans.order import prefix_sum

    segs = segments if segments is not None else render_segments(df, key, turn, role, text)
    specials = SPECIAL_TOKENS if special_tokens is None else special_tokens
    # a vocabulary without the python/output specials renders bare text with
    # the same masks (Q14): their special segments are simply dropped
    segs = segs.where((F.col("kind") != "special") | F.col("value").isin(*specials))
    n_ranks = 256 + merges.count()
    spec = F.create_map(*[x for i, s in enumerate(specials) for x in (F.lit(s), F.lit(n_ranks + i))])
    enc = make_encoder(merges)
    toks = F.when(F.col("kind") == "special", F.array(spec[F.col("value")])) \
        .otherwise(enc(F.when(F.col("kind") == "special", None).otherwise(pretokenize_col(F.col("value")))))
    s = segs.withColumn("toks", toks).withColumn("n", F.size("toks").cast("long"))
    s = prefix_sum(s, ["seg_no"], "n", out="start", inclusive=False, partition_by=[key])
    s = s.where(F.col("start") < max_tokens)
    keep = F.least(F.col("n"), F.lit(max_tokens) - F.col("start")).cast("int")
    s = s.select(key, "seg_no", F.slice("toks", 1, keep).alias("toks"),
                 F.array_repeat(F.col("mask"), keep).alias("m"))
    g = s.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("seg_no", "toks", "m"))).alias("__s"))
    return g.select(key, F.flatten(F.transform("__s", lambda x: x["toks"])).alias("ids"),
                    F.flatten(F.transform("__s", lambda x: x["m"])).alias("mask"))


def supervised_tokens(rendered: DataFrame, mask: str = "mask") -> Column:
    """C7 (per row): Σ mask[1:] — the BOS position is never a target."""
    return F.aggregate(F.slice(mask, 2, F.greatest(F.size(mask) - 1, F.lit(0))), F.lit(0).cast("long"),
                       lambda a, m: a + m)


# The named mixtures as (source, first rows kept or None for all).
RECIPES = {
    "mid-train": [("smoltalk", None), ("mmlu-auxiliary", None), ("gsm8k", None), ("identity", None), ("identity", None),
                  ("simple-spelling", 200_000), ("spelling-bee", 80_000)],
    "mid-val": [("smoltalk-test", None), ("mmlu-test", 5_200), ("gsm8k-test", 420)],
    "sft": [("arc-easy", None), ("arc-challenge", None), ("gsm8k", None), ("smoltalk", 10_000), ("identity", None),
            ("simple-spelling", 300), ("spelling-bee", 300)],
}


def named_recipe(name: str, sources: dict[str, DataFrame], seed: int = 42, local_idx: str = "local_idx") -> DataFrame:
    """One of ``RECIPES`` over task tables with a dense ``local_idx``; a source that
    is listed twice is oversampled, a missing one is an error."""
    missing = sorted({s for s, _ in RECIPES[name]} - sources.keys())
    if missing:
        raise ValueError(f"recipe {name} needs {', '.join(missing)}")
    views = {(s, stop): (sources[s] if stop is None else sources[s].where(F.col(local_idx) < stop)).select(local_idx) for s, stop in RECIPES[name]}
    return mix([views[view] for view in RECIPES[name]], seed, local_idx)      # one view listed twice counts its copies


def render_part_segments(df: DataFrame, key: str = "conv_id", user: str = "user",
                         parts: str = "assistant_parts") -> DataFrame:
    """C5 for a user string + assistant parts (text / python / python_output).

    Masks: BOS, user block, assistant_start and tool output (with its
    specials) 0; assistant text, python call with its specials, assistant_end 1.
    Output rows ``(conv_id, seg_no, kind, value, mask)``.
    """
    def seg(k, kind, value, mask):
        return F.struct(F.lit(k).alias("k"), F.lit(kind).alias("kind"), value.alias("value"),
                        F.lit(mask).alias("mask"))

    def part_segs(p):
        t = p["type"]
        return (F.when(t == "python", F.array(seg(0, "special", F.lit("<|python_start|>"), 1),
                                              seg(1, "text", p["text"], 1),
                                              seg(2, "special", F.lit("<|python_end|>"), 1)))
                .when(t == "python_output", F.array(seg(0, "special", F.lit("<|output_start|>"), 0),
                                                    seg(1, "text", p["text"], 0),
                                                    seg(2, "special", F.lit("<|output_end|>"), 0)))
                .otherwise(F.array(seg(1, "text", p["text"], 1))))

    head = F.array(seg(0, "special", F.lit("<|bos|>"), 0), seg(0, "special", F.lit("<|user_start|>"), 0),
                   seg(0, "text", F.col(user), 0), seg(0, "special", F.lit("<|user_end|>"), 0),
                   seg(0, "special", F.lit("<|assistant_start|>"), 0))
    body = F.flatten(F.transform(F.col(parts), part_segs))
    tail = F.array(seg(0, "special", F.lit("<|assistant_end|>"), 1))
    allsegs = F.concat(head, body, tail)
    x = df.select(key, F.posexplode(allsegs).alias("seg_no", "s"))
    return x.select(key, F.col("seg_no").cast("long").alias("seg_no"), F.col("s.kind").alias("kind"),
                    F.col("s.value").alias("value"), F.col("s.mask").alias("mask"))
