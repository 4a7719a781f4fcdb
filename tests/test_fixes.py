"""Inputs that the given tables do not hold: odd keys, roles, files and merges."""

import json

import pytest
from pyspark.sql import functions as F

from quill.operators import bpe, chat, corpus, evals, pack, prompts
from quill.plans.order import dense_index, prefix_sum
from quill.plans.segment import greedy_segments
from quill.sources import files, sinks


def test_any_string_key_is_ordered(spark):
    keys = ["zeta", "alpha", "beta", "f00", "shard_1", "cafe", "doc_1", "e1", "é", ""]
    rows = dense_index(spark.createDataFrame([(k,) for k in keys], "k string"), ["k"]).collect()
    assert {r.k: r.idx for r in rows} == {k: i for i, k in enumerate(sorted(keys))}


def test_null_keys_come_first(spark):
    df = spark.createDataFrame([(None, "ab"), ("b", "cde"), ("a", "fghi"), (None, "x")], "k string, text string")
    rows = prefix_sum(df, ["k", "text"], F.length("text"), out="p").collect()
    assert {(r.k, r.text): r.p for r in rows} == {(None, "ab"): 2, (None, "x"): 3, ("a", "fghi"): 7, ("b", "cde"): 10}
    df = spark.createDataFrame([(None, "ab"), (3, "cde"), (-5, "fghi")], "k bigint, text string")
    assert {r.text: r.idx for r in dense_index(df, ["k"]).collect()} == {"ab": 0, "fghi": 1, "cde": 2}
    assert corpus.take_char_budget(df, ["k"], 100).count() == 3


def test_epochs_repeat_the_stream_for_any_key(spark):
    df = spark.createDataFrame([(-5, [1, 1, 1]), (0, [2])], "k int, ids array<int>")
    rows = pack.pack(df, 1, 6, ["k"], epochs=2).collect()
    assert [r.inputs for r in rows] == [[1, 1, 1, 2, 1, 1]] and rows[0].targets == [1, 1, 2, 1, 1, 1]


def test_progress_counts_all_finished_conversations(spark):
    df = spark.createDataFrame([(0, [1] * 3), (1, [2] * 20), (2, [3] * 4)], "idx bigint, ids array<int>")
    rows = sorted(pack.pack_conversations(df, 1, 4, 0, 1).collect(), key=lambda r: r.block)
    assert [round(r.progress, 3) for r in rows] == [0.333, 0.333, 0.333, 0.333, 0.667]


def test_absent_and_unknown_roles(spark):
    df = spark.createDataFrame([(1, 0, None, "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", None),
                                (3, 0, "user", "a"), (3, 1, "assistant", "b")], "conv_id int, turn int, role string, text string")
    v = {r.conv_id: r.reasons for r in chat.validate_conversations(df).collect()}
    assert v == {1: "bad_alternation", 2: "missing_content", 3: ""}
    assert {r.conv_id: r.reasons for r in chat.audit_request_limits(df).collect()}[1] == "invalid_role"
    tool = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "tool", "b")], df.schema)
    with pytest.raises(Exception, match="cannot render role tool"):
        chat.render_segments(tool).collect()


def test_leftover_files_are_not_read(spark, tmp_path):
    spark.createDataFrame([("a",)], "text string").coalesce(1).write.parquet(str(tmp_path / "w"))
    part = next((tmp_path / "w").glob("part-*.parquet"))
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "shard_00000.parquet").write_bytes(part.read_bytes())
    (tmp_path / "c" / "shard_00001.parquet.tmp").write_bytes(part.read_bytes())
    assert files.read_corpus(spark, str(tmp_path / "c")).count() == 1


def test_floor_division():
    assert prompts.calculate("7//2") == 3 and prompts.calculate("1,000//3") == 333


def test_many_merges_apply_without_deep_expressions(spark):
    merges = [(97, 98, 256)] + [(256 + i, 99, 257 + i) for i in range(2000)]
    df = spark.createDataFrame([("ab" + "c" * 2100,)], "chunk string").select(bpe.byte_ids("chunk").alias("ids"))
    got = df.select(bpe.apply_merges_col(F.col("ids"), merges).alias("x")).collect()[0].x
    assert got == [256 + 2000] + [99] * 100


def naive_encode(chunk, ranks):
    ids = list(chunk.encode())
    for (a, b), m in sorted(ranks.items(), key=lambda x: x[1]):
        out = []
        for t in ids:
            if out and out[-1] == a and t == b:
                out[-1] = m
            else:
                out.append(t)
        ids = out
    return ids


def test_chunk_encoder_equals_merging_in_rank_order():
    import random
    rng = random.Random(2)
    for _ in range(200):
        ranks, tokens = {}, [97, 98, 99]
        while len(ranks) < 8:
            pair = rng.choice(tokens), rng.choice(tokens)
            if pair not in ranks:
                ranks[pair] = 256 + len(ranks)
                tokens.append(ranks[pair])
        chunk = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
        assert bpe._encode_chunk(chunk, ranks) == naive_encode(chunk, ranks)


def test_report_finds_logged_names(spark):
    kv = spark.createDataFrame([("r", "base", "CORE metric", "0.1", 1), ("r", "mid", "ChatCORE metric", "0.2", 1), ("r", "mid", "total time", "9", 2),
                                ("r", "rl", "ARC-Easy", "0.3", 1), ("r", "rl", "GSM8K", "0.4", 2)], "run string, stage string, metric string, value string, line_no int")
    got = {r.metric: (r.base, r.mid, r.sft, r.rl, r.sort_key) for r in evals.report_summary(kv).collect()}
    assert got == {"CORE": ("0.1", "-", "-", "-", 0), "ChatCORE": ("-", "0.2", "-", "-", 2), "GSM8K": ("-", "-", "-", "0.4", 1)}


def test_segments_against_the_sequential_rule(spark):
    import random
    rng = random.Random(1)
    for threshold in (1, 7, 50, 10_000):
        w = [rng.randint(0, 9) for _ in range(120)]
        seg, total, want = 0, 0, []
        for x in w:
            want.append(seg)
            total += x
            if total >= threshold:
                seg, total = seg + 1, 0
        rows = greedy_segments(spark.createDataFrame(list(enumerate(w)), "i bigint, w bigint"), "i", "w", threshold).collect()
        assert [r.segment for r in sorted(rows, key=lambda r: r.i)] == want


def test_messages_reach_the_conversation_operators(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text(json.dumps([{"role": "user", "content": "hi"}, {"role": "assistant", "content": "ho"}]) + "\n\n")
    conv = files.read_conversations_jsonl(spark, str(tmp_path / "c.jsonl")).withColumn("conv_id", F.lit(1))
    turns = files.messages_to_turns(conv)
    assert chat.validate_conversations(turns).collect()[0].valid
    assert chat.render_segments(turns.select("conv_id", "turn", "role", "text")).count() == 7


def test_publish_replaces_whole_outputs(spark, tmp_path):
    def write(n):
        return lambda p: spark.range(n).coalesce(1).write.parquet(p)
    path = str(tmp_path / "out")
    assert sinks.publish(spark, write(3), path) and not sinks.publish(spark, write(5), path)
    assert sinks.publish(spark, write(7), path, skip_if_complete=False)
    assert spark.read.parquet(path).count() == 7 and not (tmp_path / "out.old").exists()


def test_problem_caps(spark):
    outcomes = spark.createDataFrame([(i, i < 2) for i in range(6)], "idx bigint, is_correct boolean")
    r = evals.generative_eval(outcomes, max_problems=4).collect()[0]
    assert (r.n, r.accuracy) == (4, 0.5)
    logits = spark.createDataFrame([(i, x, v) for i in range(3) for x, v in (("A", 0.1), ("B", 0.9))], "item bigint, letter string, logit double")
    letters = spark.createDataFrame([(i, x, k) for i in range(3) for k, x in enumerate("AB")], "item bigint, letter string, letter_idx int")
    gold = spark.createDataFrame([(0, "B"), (1, "A"), (2, "B")], "item bigint, gold string")
    assert sorted((r.item, r.is_correct) for r in evals.categorical_eval(logits, letters, gold, max_problems=2).collect()) == [(0, True), (1, False)]


def test_iteration_rules_in_order(spark):
    c = spark.createDataFrame([(10_001, 4.0)], "tokens bigint, chars_per_token double")

    def n(**kw):
        return pack.training_budget(c, 100, 1_000, **kw).collect()[0].num_iterations
    assert n() == 100 and n(param_data_ratio=20) == 200
    assert n(target_flops=6e6, flops_per_token=600, param_data_ratio=20) == 100
    assert n(num_iterations=7, target_flops=6e6, flops_per_token=600) == 7


def test_named_recipes(spark):
    def table(n):
        return spark.range(n).select(F.col("id").alias("local_idx"))
    names = ["arc-easy", "arc-challenge", "gsm8k", "smoltalk", "identity", "simple-spelling", "spelling-bee"]
    m = chat.named_recipe("sft", {x: table(400) for x in names})
    assert m.count() == 5 * 400 + 2 * 300
    with pytest.raises(ValueError, match="smoltalk-test"):
        chat.named_recipe("mid-val", {})
