"""Content of both shapes, tasks as data, independent picks, and the streaming shuffle."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quill.operators import chat, content, corpus, evals
from quill.operators.task import Task, evaluate, examples, graded
from quill.plans.order import prefix_aggregates
from quill.streaming.shuffle import BufferedShuffle


def _turns(spark, tmp_path, conversations, name="lines"):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n\n".join(json.dumps(c, ensure_ascii=False) for c in conversations) + "\n", encoding="utf-8")
    return content.read_parts_jsonl(spark, str(folder))


def _segments(df):
    return [(r.kind, r.value, r["mask"]) for r in df.orderBy("conv", "seg_no").collect()]


def test_parts_in_any_turn(spark, tmp_path):
    talk = [{"role": "system", "content": [{"type": "text", "text": "Be"}, {"type": "text", "text": " kind"}]}, {"role": "user", "content": "hé"},
            {"role": "assistant", "content": [{"type": "text", "text": "a"}, {"type": "python", "text": "1+1"}, {"type": "python_output", "text": "2"}, {"type": "text", "text": "b"}]},
            {"role": "user", "content": [{"type": "text", "text": "x"}, {"type": "text", "text": "y"}]}, {"role": "assistant", "content": []},
            {"role": "user", "content": ""}, {"role": "assistant", "content": "end"}]
    t = _turns(spark, tmp_path, [talk])
    assert [r.is_simple for r in t.orderBy("turn").collect()] == [False, True, False, False, False, True, True]
    assert _segments(content.render_parts(t)) == [
        ("special", "<|bos|>", 0), ("special", "<|user_start|>", 0), ("text", "Be kind\n\nhé", 0), ("special", "<|user_end|>", 0),
        ("special", "<|assistant_start|>", 0), ("text", "a", 1), ("special", "<|python_start|>", 1), ("text", "1+1", 1), ("special", "<|python_end|>", 1),
        ("special", "<|output_start|>", 0), ("text", "2", 0), ("special", "<|output_end|>", 0), ("text", "b", 1), ("special", "<|assistant_end|>", 1),
        ("special", "<|user_start|>", 0), ("text", "xy", 0), ("special", "<|user_end|>", 0), ("special", "<|assistant_start|>", 0), ("special", "<|assistant_end|>", 1),
        ("special", "<|user_start|>", 0), ("text", "", 0), ("special", "<|user_end|>", 0), ("special", "<|assistant_start|>", 0), ("text", "end", 1), ("special", "<|assistant_end|>", 1)]


def test_string_content_renders_like_the_plain_segments(spark):
    rows = [(c, t, r, x) for c in (1, 2) for t, (r, x) in enumerate([("system", "s"), ("user", "u"), ("assistant", "a")][c % 2:])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    old = [(r.conv_id, r.kind, r.value, r["mask"]) for r in chat.render_segments(df).orderBy("conv_id", "seg_no").collect()]
    new = content.render_parts(content.parts_of_text(df), key="conv_id").orderBy("conv_id", "seg_no").collect()
    assert [(r.conv_id, r.kind, r.value, r["mask"]) for r in new] == old


@pytest.mark.parametrize("talk,message", [
    ([{"role": "tool", "content": "x"}], "cannot render role tool"),
    ([{"role": "user", "content": 5}], "cannot render content of turn"),
    ([{"role": "user", "content": "u"}, {"role": "assistant", "content": [{"type": "image", "text": "x"}]}], "cannot render part image"),
    ([{"role": "user", "content": "u"}, {"role": "assistant", "content": {"a": 1}}], "cannot render part NULL"),
    ([{"role": "system", "content": "s"}, {"role": "assistant", "content": "x"}], "cannot render a system message before assistant"),
])
def test_what_must_not_become_supervised_text(spark, tmp_path, talk, message):
    with pytest.raises(Exception, match=message):
        content.render_parts(_turns(spark, tmp_path, [talk])).collect()


def test_completion_prompt(spark, tmp_path):
    talks = [[{"role": "system", "content": "s"}, {"role": "user", "content": "u"}, {"role": "assistant", "content": [{"type": "text", "text": "a"}]},
              {"role": "user", "content": "v"}, {"role": "assistant", "content": "gone"}],
             [{"role": "user", "content": "no answer"}], [{"role": "assistant", "content": "alone"}]]
    got = [(k, v, m) for k, v, m in _segments(content.completion_prompt(_turns(spark, tmp_path, talks)))]
    assert [v for _, v, _ in got] == ["<|bos|>", "<|user_start|>", "s\n\nu", "<|user_end|>", "<|assistant_start|>", "a", "<|assistant_end|>",
                                      "<|user_start|>", "v", "<|user_end|>", "<|assistant_start|>"]
    assert [m for *_, m in got] == [0, 0, 0, 0, 0, 1, 1, 0, 0, 0, 0]


def test_render_shuffles_once_and_scans_once(spark, tmp_path):
    plan = content.render_parts(_turns(spark, tmp_path, [[{"role": "user", "content": "u"}]]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1


def test_tasks(spark):
    letters = F.array(*[F.lit(x) for x in "AB"])
    src = spark.createDataFrame([(i, f"q{i}", "AB"[i % 2]) for i in range(10)], "id long, q string, key string")
    mc = Task("mc", src, "id", {"prompt": F.col("q"), "reference": F.col("key"), "letters": letters}, evals.grade_letter, start=2, stop=9, step=3)
    num = Task("num", spark.createDataFrame([(1, "x", "#### 5"), (2, "y", "none")], "id long, q string, key string"), "id",
               {"prompt": F.col("q"), "reference": F.col("key")}, lambda ref, done, _: evals.grade_numeric(ref, done))
    ex = {(r.task, r.idx): (r.prompt, r.reference) for r in examples([mc, num]).collect()}
    assert ex == {("mc", 0): ("q2", "A"), ("mc", 1): ("q5", "B"), ("mc", 2): ("q8", "A"), ("num", 0): ("x", "#### 5"), ("num", 1): ("y", "none")}
    done = spark.createDataFrame([("mc", 0, 0, "A"), ("mc", 0, 1, "B"), ("mc", 1, 0, "C"), ("mc", 1, 1, None), ("num", 0, 0, "so #### 5"), ("num", 1, 0, "nothing"),
                                  ("num", 7, 0, "#### 1"), ("else", 0, 0, "A")], "task string, idx long, sample_no int, completion string")
    assert {(r.task, r.idx, r.sample_no): r.is_correct for r in graded([mc, num], done).collect()} == {
        ("mc", 0, 0): True, ("mc", 0, 1): False, ("mc", 1, 0): False, ("mc", 1, 1): False, ("num", 0, 0): True, ("num", 1, 0): True}
    assert sorted(map(tuple, evaluate([mc, num], done).collect())) == [("mc", 2, 0.25, 0.5), ("num", 2, 1.0, 1.0)]
    with pytest.raises(ValueError, match="different names"):
        examples([mc, mc])


def test_picks_are_distinct_and_independent(spark):
    items = spark.range(60).selectExpr("id * 3 AS idx")
    got = evals.fewshot_examples(items, 4, seed=9).collect()
    by = {}
    for r in got:
        by.setdefault(r.idx, []).append(r.shot_idx)
    assert all(len(set(s)) == 4 and i not in s for i, s in by.items()) and len(by) == 60
    steps = Counter(abs(a - b) for s in by.values() for a, b in zip(sorted(s), sorted(s)[1:]))
    assert steps[3] < 60            # neighbours in the order are rarely picked together
    every = evals.fewshot_examples(spark.range(5).selectExpr("id AS idx"), 4).collect()
    assert sorted((r.idx, r.shot_idx) for r in every) == [(i, j) for i in range(5) for j in range(5) if i != j]
    with pytest.raises(ValueError):
        evals.fewshot_examples(items, 60)


def test_aggregates_from_one_pass(spark):
    rows = [(i * 7 % 501, "ab"[i % 2] if i % 5 else None, float((i * 13) % 17) if i % 3 else None) for i in range(501)]
    df = spark.createDataFrame(rows, "k int, g string, v double")
    got = {r.k: (r.n, r.low, r.total) for r in prefix_aggregates(df, ["k"], {"n": (F.lit(1), "sum", False), "low": ("v", "min", True), "total": ("v", "sum", True)},
                                                                 n_buckets=9, partition_by=["g"]).collect()}
    seen = {}
    for k, g, v in sorted(rows):
        n, low, total = seen.get(g, (0, None, 0.0))
        low = v if low is None else low if v is None else min(low, v)
        total += v or 0.0
        assert got[k] == (n, low, total)
        seen[g] = (n + 1, low, total)


def test_stream_shuffle_equals_batch_and_survives_repeats(spark, tmp_path):
    docs = [(i, " ".join(f"s{j}." for j in range((i * 5) % 9))) for i in range(60)]
    schema = "doc_id long, text string"
    mixer = BufferedShuffle(str(tmp_path / "s"), corpus.sentences, n=20, seed=3)
    for b, at in enumerate((0, 1, 30, 31)):
        part = spark.createDataFrame(docs[at:[1, 30, 31, 60][b]], schema)
        mixer(part, b)
        if b in (0, 2):
            mixer(part, b)          # a batch that is run again
    got = sorted((r["rank"], r.buffer, r.doc_id, r.pos) for r in mixer.finish(spark, 4).collect())
    want = corpus.shuffle_buffered(corpus.sentences(spark.createDataFrame(docs, schema)), n=20, seed=3)
    assert got == sorted((r["rank"], r.buffer, r.doc_id, r.pos) for r in want.collect())
