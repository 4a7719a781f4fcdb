"""Evaluation and run analytics over tables of model outputs.

Dimension tables that are bounded by a parameter (token byte lengths by
the vocabulary, baselines by the task list, rates by a fixed list) are
broadcast only after their row count is checked; larger ones fall back to a
shuffle join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quill.functions.text import extract_answer
from quill.plans.order import dense_index, prefix_aggregates, seeded_int, seeded_key

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# Chat evaluation tasks and their random-guess accuracies (fractions).
CHAT_BASELINES = {
    "ARC-Easy": 0.25,
    "ARC-Challenge": 0.25,
    "MMLU": 0.25,
    "GSM8K": 0.0,
    "HumanEval": 0.0,
    "SpellingBee": 0.0,
}
# Hourly device rates by name substring, first match wins; default rate.
DEVICE_RATES = [("H100", 3.00), ("A100", 1.79), ("V100", 0.55)]
DEFAULT_RATE = 2.0
# Report stages and the chat metrics extracted from evaluation sections.
STAGES = ["base", "mid", "sft", "rl"]
CHAT_METRICS = ["ARC-Easy", "ARC-Challenge", "MMLU", "GSM8K", "HumanEval", "ChatCORE"]
# Report sections in their order.
REPORT_SECTIONS = [
    "tokenizer-training", "tokenizer-evaluation", "base-model-training", "base-model-loss", "base-model-evaluation", "midtraining",
    "chat-evaluation-mid", "chat-sft", "chat-evaluation-sft", "chat-rl", "chat-evaluation-rl",
]
STAGE_METRICS = {"base": ["CORE"], "mid": CHAT_METRICS, "sft": CHAT_METRICS, "rl": ["GSM8K"]}
# ---------------------------------------------------------------------------

BROADCAST_ROW_LIMIT = 1 << 20


def checked_broadcast(dim: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast a dimension only when its row count is within ``limit``."""
    n = dim.count()
    return F.broadcast(dim) if n <= limit else dim


def bits_per_byte(losses: DataFrame, token_bytes: DataFrame, by: list[str] | None = None,
                  target: str = "target_id", loss: str = "loss") -> DataFrame:
    """Σ loss over targets with n_bytes > 0 (ignored targets < 0 count 0
    bytes) over ln2·Σ n_bytes; ``inf`` when no bytes."""
    by = by or []
    tb = checked_broadcast(token_bytes.select(F.col("token_id").alias(target), "n_bytes"))
    j = losses.join(tb, target, "left")
    nb = F.when(F.col(target) >= 0, F.coalesce(F.col("n_bytes"), F.lit(0))).otherwise(F.lit(0))
    agg = j.groupBy(*by).agg(F.sum(F.when(nb > 0, F.col(loss)).otherwise(F.lit(0.0))).alias("nats"),
                             F.sum(nb).cast("long").alias("bytes"))
    bpb = F.when(F.col("bytes") == 0, F.lit(float("inf"))).otherwise(
        F.col("nats") / (F.lit(math.log(2)) * F.col("bytes")))
    return agg.select(*by, F.round("nats", 6).alias("nats"), "bytes", F.round(bpb, 6).alias("bpb"))


def distinct_picks(seed: int, k: int, n: Column, *cols) -> Column:
    """``k`` distinct, independently drawn integers below ``n`` (k <= n) as an array.

    Draw i is below n - k + i + 1; a number that was drawn before gives way to the
    largest one allowed, which cannot have been. Every k-subset is equally likely."""
    def draw(done, i):
        top = n - F.lit(k) + i
        t = seeded_int(seed, top + 1, *cols, i)
        return F.concat(done, F.array(F.when(F.array_contains(done, t), top).otherwise(t)))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")), F.array().cast("array<bigint>"), draw)


def fewshot_examples(items: DataFrame, k: int, seed: int = 1234, key: str = "idx") -> DataFrame:
    """``k`` distinct other items per item, drawn independently per item; needs k < n.

    Items get dense positions; an item's picks are positions among the n - 1 others.
    One equi-join by position brings the picked items (no n² theta join).
    """
    pos = dense_index(items.select(key), [key], out="pos")
    n = items.select(key).count()
    if k >= n:
        raise ValueError("need k < number of items")
    picks = pos.select(key, "pos", F.posexplode(distinct_picks(seed, k, F.lit(n - 1), key)).alias("j", "r"))
    shots = picks.select(key, "j", (F.col("r") + (F.col("r") >= F.col("pos")).cast("int")).alias("shot_pos"))
    back = pos.select(F.col("pos").alias("shot_pos"), F.col(key).alias("shot_" + key))
    return shots.join(back, "shot_pos").select(key, "j", "shot_" + key)


def score_options(losses: DataFrame, gold: DataFrame | None = None, item: str = "item",
                  option: str = "option", loss: str = "loss", spans: DataFrame | None = None,
                  pos: str = "pos") -> DataFrame:
    """mean loss per option over ``[start−1, end−1)``, argmin (ties → first option).

    ``spans`` (item, option, start, end) restrict positions by an equi-join on
    (item, option) plus a range filter; ``gold`` (item, gold) adds ``is_correct``.
    """
    ls = losses
    if spans is not None:
        ls = ls.join(spans, [item, option]).where(
            (F.col(pos) >= F.col("start") - 1) & (F.col(pos) < F.col("end") - 1))
    means = ls.groupBy(item, option).agg(F.avg(loss).alias("mean_loss"))
    pred = means.groupBy(item).agg(F.min_by(option, F.struct("mean_loss", option)).alias("pred"))
    if gold is not None:
        pred = pred.join(gold, item).withColumn("is_correct", F.col("pred") == F.col("gold"))
    return pred


def score_lm(preds: DataFrame, item: str = "item", pred: str = "pred", actual: str = "actual",
             spans: DataFrame | None = None, pos: str = "pos") -> DataFrame:
    """correct iff every predicted token in the span equals the actual one. The prediction at
    ``pos`` is of the token after it, so ``spans`` (item, start, end) keep positions
    [start - 1, end - 1); without them all rows count. An item without a row in its span is
    correct, as nothing differs."""
    if spans is None:
        return preds.groupBy(item).agg(F.bool_and(F.col(pred) == F.col(actual)).alias("is_correct"))
    inside = (F.col(pos) >= F.col("start") - 1) & (F.col(pos) < F.col("end") - 1)
    met = spans.join(preds, item, "left").withColumn("__ok", ~F.coalesce(inside, F.lit(False)) | F.col(pred).eqNullSafe(F.col(actual)))
    return met.groupBy(item).agg(F.bool_and("__ok").alias("is_correct"))


def task_accuracy(outcomes: DataFrame, by: str = "task", key: str = "idx", correct: str = "is_correct",
                  cap: int | None = None, seed: int = 1337) -> DataFrame:
    """mean correctness per task, each item once; optional seeded cap per task."""
    o = outcomes
    if cap is not None:
        o = o.withColumn("__k", seeded_key(seed, key))
        o = dense_index(o, ["__k"], out="__r", partition_by=[by], below=cap)
    return o.groupBy(by).agg(F.count(F.lit(1)).alias("n"),
                             F.round(F.avg(F.col(correct).cast("double")), 6).alias("accuracy"))


def centered_score(acc: DataFrame, baselines: DataFrame, by: str = "task", percent: bool = True) -> DataFrame:
    """(acc − b)/(1 − b); ``percent`` baselines are divided by 100 first."""
    b = F.col("baseline") * (0.01 if percent else 1.0)
    j = acc.join(checked_broadcast(baselines), by)
    return j.withColumn("centered", F.round((F.col("accuracy") - b) / (F.lit(1.0) - b), 6))


def core_metric(centered: DataFrame, by: str = "task", label: str = "CORE") -> DataFrame:
    """per-task centered rows plus a total row (mean of centered)."""
    total = centered.agg(F.round(F.avg("centered"), 6).alias("centered")).withColumn(by, F.lit(label))
    return centered.select(by, "centered").unionByName(total.select(by, "centered"))


def categorical_eval(logits: DataFrame, letters: DataFrame, gold: DataFrame, item: str = "item",
                     letter: str = "letter", logit: str = "logit", max_problems: int | None = None) -> DataFrame:
    """F8: argmax over the item's own letters (semi join), first letter on ties.

    ``letters``: (item, letter, letter_idx). ``max_problems`` keeps the first
    problems in item order.
    """
    if max_problems is not None:
        gold = dense_index(gold, [item], out="__p", below=max_problems).drop("__p")
    valid = logits.join(letters, [item, letter], "inner")
    pred = valid.groupBy(item).agg(
        F.max_by(letter, F.struct(F.col(logit), -F.col("letter_idx"))).alias("pred"))
    return pred.join(gold, item).withColumn("is_correct", F.col("pred") == F.col("gold"))


def generative_eval(outcomes: DataFrame, key: str = "idx", correct: str = "is_correct", max_problems: int | None = None) -> DataFrame:
    """a problem passes if any sample is correct; accuracy over problems, or over
    the first ``max_problems`` of them in key order."""
    per = outcomes.groupBy(key).agg(F.bool_or(correct).alias("passed"))
    if max_problems is not None:
        per = dense_index(per, [key], out="__p", below=max_problems).drop("__p")
    return per.agg(F.count(F.lit(1)).alias("n"),
                   F.round(F.avg(F.col("passed").cast("double")), 6).alias("accuracy"))


def grade_numeric(ref: Column, completion: Column) -> Column:
    """extracted reference answer equals extracted prediction (two missing = equal)."""
    return extract_answer(ref).eqNullSafe(extract_answer(completion))


def grade_letter(ref: Column, answer: Column, letters: Column) -> Column:
    """answer must be one of the letters and equal the reference."""
    return F.array_contains(letters, answer) & (answer == ref)


def pass_at_k(outcomes: DataFrame, K: int, key: str = "idx", sample: str = "sample_no",
              correct: str = "is_correct") -> DataFrame:
    """for k = 1..K, share of records with a correct sample among their first k.

    Sample positions are ranks within a record (a window bounded by the
    number of samples per record); then one aggregate per k.
    """
    # a record holds at most num_samples rows (a parameter), so this window is bounded
    w = Window.partitionBy(key).orderBy(sample)
    r = outcomes.withColumn("__r", F.row_number().over(w))
    first = r.groupBy(key).agg(F.min(F.when(F.col(correct), F.col("__r"))).alias("first_ok"))
    ks = first.select("first_ok", F.explode(F.sequence(F.lit(1), F.lit(K))).alias("k"))
    return ks.groupBy("k").agg(F.round(F.avg((F.coalesce(F.col("first_ok") <= F.col("k"), F.lit(False)))
                                              .cast("double")), 6).alias("pass_at_k"))


def chat_core(accs: DataFrame, task: str = "task", acc: str = "accuracy") -> DataFrame:
    """mean centered accuracy over the six chat tasks, only when all six are present."""
    spark = accs.sparkSession
    base = spark.createDataFrame(list(CHAT_BASELINES.items()), f"{task} STRING, baseline DOUBLE")
    j = accs.join(F.broadcast(base), task)   # fixed six-row table
    centered = (F.col(acc) - F.col("baseline")) / (F.lit(1.0) - F.col("baseline"))
    return (j.agg(F.count(F.lit(1)).alias("n_tasks"), F.avg(centered).alias("chatcore"))
            .where(F.col("n_tasks") == len(CHAT_BASELINES))
            .select(F.round("chatcore", 6).alias("chatcore")))


def group_advantage(rewards: DataFrame, prompt: str = "prompt", reward: str = "reward") -> DataFrame:
    """reward minus the mean reward of its prompt (no std scaling)."""
    mu = rewards.groupBy(prompt).agg(F.avg(reward).alias("__mu"))
    return rewards.join(mu, prompt).withColumn("advantage", F.col(reward) - F.col("__mu")).drop("__mu")


def policy_objective(logp: DataFrame, adv: DataFrame, by: list[str], keys: list[str],
                     target: str = "target", passes: int = 1, examples: int = 1) -> DataFrame:
    """Σ logp·adv over valid tokens / (max(valid, 1) × passes × examples)."""
    j = logp.join(adv, keys)
    valid = F.col(target) >= 0
    agg = j.groupBy(*by).agg(F.sum(F.when(valid, F.col("logp") * F.col("advantage")).otherwise(0.0)).alias("num"),
                             F.sum(valid.cast("long")).alias("n_valid"))
    obj = F.round(F.col("num") / (F.greatest(F.col("n_valid"), F.lit(1)) * passes * examples), 6) + F.lit(0.0)
    return agg.select(*by, "n_valid", obj.alias("pg_obj"))  # + 0.0 folds −0.0 into 0.0


def rollout_stats(samples: DataFrame, step: str = "step", prompt: str = "prompt",
                  reward: str = "reward", seq_len: str = "seq_len") -> DataFrame:
    """F16: mean reward (mean of prompt means) and mean sequence length per step."""
    per = samples.groupBy(step, prompt).agg(F.avg(reward).alias("pm"), F.sum(seq_len).alias("sl"),
                                            F.count(F.lit(1)).alias("n"))
    return per.groupBy(step).agg(F.round(F.avg("pm"), 6).alias("mean_reward"),
                                 F.round(F.sum("sl") / F.sum("n"), 6).alias("mean_seq_len"))


def masked_token_mean(losses: DataFrame, by: list[str], target: str = "target_id",
                      loss: str = "loss") -> DataFrame:
    """mean loss over targets ≠ −1 and the count of active tokens."""
    act = F.col(target) != -1
    return losses.groupBy(*by).agg(F.round(F.avg(F.when(act, F.col(loss))), 6).alias("mean_loss"),
                                   F.sum(act.cast("long")).alias("active_tokens"))


# Fixed value: promised bf16 peak FLOP/s of one H100 SXM (MFU denominator).
PEAK_FLOPS_PER_DEVICE = 989e12
EMA_BETA = 0.9
EMA_BLOCK = 1024   # 0.9**1024 ≈ 1e-47: a block's carry beyond its predecessor is below double precision


def run_metrics(metrics: DataFrame, run: str = "run", step: str = "step", loss: str = "loss",
                dt: str = "dt", val: str | None = None, warmup: int = 10,
                total_batch_size: int | None = None, flops_per_token: float | None = None,
                world_size: int = 1) -> DataFrame:
    """debiased EMA(0.9) of loss, running min of ``val``, time after warm-up.

    The step's position in its run, the running min and the time after warm-up (steps
    numbered above ``warmup``) come from one pass of running aggregates, so a
    huge run is split by step ranges. The EMA
    0.1·Σ 0.9^(t−i)·loss_i is computed per block of ``EMA_BLOCK`` positions
    as a scaled running sum (a window partitioned by run and block, ≤ 1024
    rows each) plus the carry of the previous block's final value; terms two
    blocks back weigh < 1e-47. Debias: ÷ (1 − 0.9^(t+1)). tok/s and MFU are
    per-row projections.
    """
    counted = F.when(F.col(step) > warmup, F.col(dt)).otherwise(F.lit(0.0))
    running = {"__t": (F.lit(1), "sum", False), "__S": (counted, "sum", True)} | ({"min_val": (val, "min", True)} if val is not None else {})
    d = prefix_aggregates(metrics, [step], running, partition_by=[run])
    d = d.withColumn("__b", F.floor(F.col("__t") / EMA_BLOCK)).withColumn("__o", F.col("__t") % EMA_BLOCK)
    d = d.withColumn("__y", F.col(loss) * F.pow(F.lit(EMA_BETA), -F.col("__o")))
    wb = Window.partitionBy(run, "__b").orderBy("__t").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("__local", F.sum("__y").over(wb) * F.pow(F.lit(EMA_BETA), F.col("__o")))
    ends = d.groupBy(run, "__b").agg((F.sum("__y") * F.pow(F.lit(EMA_BETA), F.max("__o"))).alias("__end"))
    ends = ends.select(run, (F.col("__b") + 1).alias("__b"), "__end")
    ends = ends.withColumnsRenamed({run: "__run", "__b": "__next"})
    d = d.join(ends, F.col(run).eqNullSafe(F.col("__run")) & (F.col("__b") == F.col("__next")), "left").drop("__run", "__next")
    ema = F.lit(1 - EMA_BETA) * (F.col("__local") + F.coalesce(F.col("__end"), F.lit(0.0))
                                 * F.pow(F.lit(EMA_BETA), F.col("__o") + 1))
    out = d.withColumn("ema_loss", F.round(ema / (F.lit(1.0) - F.pow(F.lit(EMA_BETA), F.col("__t") + 1)), 6))
    out = out.withColumn("time_after_warmup", F.round("__S", 6))
    if total_batch_size is not None:
        out = out.withColumn("tok_per_sec", F.floor(F.lit(total_batch_size) / F.col(dt)).cast("long"))
        if flops_per_token is not None:
            fps = F.lit(flops_per_token * total_batch_size) / F.col(dt)
            out = out.withColumn("mfu", F.round(F.lit(100.0) * fps / F.lit(PEAK_FLOPS_PER_DEVICE * world_size), 6))
    return out.drop("__t", "__b", "__o", "__y", "__local", "__end", "__S")


def best_checkpoint(metrics: DataFrame, run: str = "run", step: str = "step", loss: str = "val_loss") -> DataFrame:
    """step with the lowest validation loss, earliest on ties."""
    return metrics.groupBy(run).agg(F.min_by(step, F.struct(loss, step)).alias("best_step"),
                                    F.min(loss).alias("best_loss"))


def report_summary(kv: DataFrame, run: str = "run", stage: str = "stage", metric: str = "metric",
                   value: str = "value", line: str = "line_no") -> DataFrame:
    """metric × stage pivot, '-' for missing; CORE first, ChatCORE last.

    A stage reports its own metrics only, found by containment in the logged key;
    of several matches the last line counts. Other keys stay out."""
    own = F.array().cast("array<string>")
    for s, ms in STAGE_METRICS.items():
        found = F.array_compact(F.array(*(F.when(F.col(metric).contains(m), F.lit(m)) for m in ms)))
        own = F.when(F.col(stage) == s, found).otherwise(own)
    order = F.col(line) if line in kv.columns else F.col(value)
    kv = kv.select(run, stage, F.explode(own).alias(metric), value, order.alias("__line"))
    p = kv.groupBy(run, metric).pivot(stage, STAGES).agg(F.max_by(value, F.struct("__line", value)))
    for s in STAGES:
        p = p.withColumn(s, F.coalesce(F.col(s).cast("string"), F.lit("-")))
    sort_key = F.when(F.col(metric) == "CORE", 0).when(F.col(metric) == "ChatCORE", 2).otherwise(1)
    return p.withColumn("sort_key", sort_key)


def wall_clock(sections: DataFrame, run: str = "run", section: str = "section", ts: str = "ts",
               start: str = "start_ts") -> DataFrame:
    """last non-RL section timestamp − run start, as hours and minutes."""
    end = sections.where(~F.col(section).contains("rl") & F.col("section_no").isNotNull()).groupBy(run).agg(
        F.max_by(ts, F.col("section_no")).alias("end_ts"), F.first(start).alias("start_ts"))
    # whole seconds of the (microsecond) difference, truncated like int(total_seconds())
    secs = F.floor(F.col("end_ts").cast("timestamp").cast("double")
                   - F.col("start_ts").cast("timestamp").cast("double")).cast("long")
    return end.select(run, secs.alias("seconds"), F.floor(secs / 3600).alias("hours"),
                      F.floor((secs % 3600) / 60).alias("minutes"))


def device_rate(name: Column, count: Column) -> Column:
    """hourly rate from the first matching device substring, else the default."""
    rate = F.lit(DEFAULT_RATE)
    for sub, r in reversed(DEVICE_RATES):
        rate = F.when(name.contains(sub), F.lit(r)).otherwise(rate)
    return rate * count


def cost_estimate(runs: DataFrame, name: str = "device", count: str = "n_devices",
                  hours: str = "hours") -> DataFrame:
    r = device_rate(F.col(name), F.col(count))
    return runs.withColumn("hourly_rate", F.round(r, 6)).withColumn(
        "estimated_total", F.round(r * F.col(hours), 6))


def parse_reports(spark, path: str) -> DataFrame:
    """report sections (one Markdown file each, many runs keyed by folder)
    → ``(run, section, key, value)`` from ``- key: value`` lines plus the
    section ``timestamp`` as ``ts``."""
    raw = (spark.read.option("wholetext", True).option("recursiveFileLookup", True)
           .option("pathGlobFilter", "*.md").text(path)
           .select(F.col("value"), F.col("_metadata.file_path").alias("p")))
    parts = F.split("p", "/")
    lines = raw.select(F.element_at(parts, -2).alias("run"),
                       F.regexp_replace(F.element_at(parts, -1), r"\.md$", "").alias("section"),
                       F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    kv = lines.select("run", "section", "line_no",
                      F.regexp_extract("line", r"^-?\s*([^:]+?)\s*:\s*(.*)$", 1).alias("key"),
                      F.regexp_extract("line", r"^-?\s*([^:]+?)\s*:\s*(.*)$", 2).alias("value"))
    kv = kv.where(F.col("key") != "")
    ts = (kv.where(F.col("key") == "timestamp")
          .groupBy("run", "section").agg(F.min_by("value", "line_no").alias("ts_text")))
    # when the run began stands in its header; sections count in their fixed order
    start = (kv.where((F.col("section") == "header") & (F.col("key") == "Run started"))
             .groupBy("run").agg(F.min_by("value", "line_no").alias("start_text")))
    stamp = F.lit("yyyy-MM-dd HH:mm:ss")
    number = F.array_position(F.array(*(F.lit(x) for x in REPORT_SECTIONS)), F.col("section")).cast("int")
    return (kv.join(ts, ["run", "section"], "left").join(start, "run", "left")
            .withColumn("ts", F.try_to_timestamp("ts_text", stamp)).withColumn("start_ts", F.try_to_timestamp("start_text", stamp))
            .withColumn("section_no", F.when(number > 0, number)).drop("ts_text", "start_text"))
