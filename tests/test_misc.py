import os
import tempfile
import unicodedata

from pyspark.sql import functions as F

from quill.functions.text import nfkc
from quill.operators import evals
from quill.sources import files, tasks


def test_nfkc(spark):
    texts = ["plain ascii", "ﬁ ligature — dash ①", "Ⅻ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = [r[0] for r in df.select(nfkc("t")).collect()]
    assert got == [None if t is None else unicodedata.normalize("NFKC", t) for t in texts]


def test_task_readers(spark):
    mmlu = spark.createDataFrame([("Q?", ["a", "b", "c", "d"], 2, "bio")],
                                 "question STRING, choices ARRAY<STRING>, answer INT, subject STRING")
    r = tasks.task_mmlu(mmlu).collect()[0]
    assert r.messages[1].content == "C" and r.valid and r.subject == "bio"
    aux = mmlu.select(F.struct("question", "choices", "answer", "subject").alias("train"))
    assert tasks.task_mmlu(aux, "auxiliary_train").collect()[0].messages[1].content == "C"
    arc = spark.createDataFrame([("Q?", (["t1", "t2"], ["1", "2"]), "2")],
                                "question STRING, choices STRUCT<text: ARRAY<STRING>, label: ARRAY<STRING>>, answerKey STRING")
    a = tasks.task_arc(arc).collect()[0]
    assert a.valid and a.messages[0].content.endswith("- t2=2\n\nRespond only with the letter of the correct answer.")
    g = spark.createDataFrame([("q", "a <<2*3=6>> b\n#### 6")], "question STRING, answer STRING")
    parts = tasks.task_gsm8k(g).collect()[0].assistant_parts
    assert [p.type for p in parts] == ["text", "python", "python_output", "text"]
    h = spark.createDataFrame([("def f():", "  return 1", "f", "t")],
                              "prompt STRING, canonical_solution STRING, entry_point STRING, test STRING")
    assert tasks.task_humaneval(h).collect()[0].messages[1].content == "def f():\n  return 1"


def test_icl_bundle(spark):
    d = tempfile.mkdtemp(prefix="quill-icl-", dir="/tmp")
    os.makedirs(os.path.join(d, "eval_data"))
    with open(os.path.join(d, "core.yaml"), "w") as f:
        f.write("icl_tasks:\n  - label: t1\n    icl_task_type: multiple_choice\n    dataset_uri: t1.jsonl\n    num_fewshot: [3, 5]\n")
    with open(os.path.join(d, "eval_meta_data.csv"), "w") as f:
        f.write("Eval Task,Random baseline\nt1,25.0\n")
    with open(os.path.join(d, "eval_data", "t1.jsonl"), "w") as f:
        f.write('{"query": "q", "choices": ["a", "b"], "gold": 1}\n')
    cfg, base, items = tasks.read_icl_bundle(spark, d)
    assert cfg[0]["num_fewshot"] == 3 and cfg[0]["continuation_delimiter"] == " "
    assert base.collect()[0].baseline == 25.0 and items["t1"].count() == 1


def test_parse_reports_and_summary(spark):
    d = tempfile.mkdtemp(prefix="quill-rep-", dir="/tmp")
    run = os.path.join(d, "run1")
    os.makedirs(run)
    with open(os.path.join(run, "base-model-evaluation.md"), "w") as f:
        f.write("## Base\ntimestamp: 2025-01-01 10:00:00\n\n- CORE: 0.2219\n")
    with open(os.path.join(run, "chat-evaluation-sft.md"), "w") as f:
        f.write("## SFT\ntimestamp: 2025-01-01 13:51:00\n\n- MMLU: 0.3151\n- ChatCORE: 0.0884\n")
    kv = evals.parse_reports(spark, d)
    got = {(r.section, r.key): r.value for r in kv.collect()}
    assert got[("base-model-evaluation", "CORE")] == "0.2219"
    assert got[("chat-evaluation-sft", "ChatCORE")] == "0.0884"
    sec = (kv.where("key = 'timestamp'").select("run", "section", "ts")
           .withColumn("section_no", F.when(F.col("section").startswith("base"), 0).otherwise(1)))
    st = sec.groupBy("run").agg(F.min("ts").alias("start_ts"))
    w = evals.wall_clock(sec.join(st, "run")).collect()[0]
    assert (w.hours, w.minutes) == (3, 51)
    stage = F.when(F.col("section").startswith("base"), "base").otherwise("sft")
    metrics = kv.where("key != 'timestamp'").select("run", stage.alias("stage"), F.col("key").alias("metric"), "value")
    s = {r.metric: (r.base, r.sft, r.sort_key) for r in evals.report_summary(metrics).collect()}
    assert s["CORE"] == ("0.2219", "-", 0) and s["ChatCORE"] == ("-", "0.0884", 2)


def test_artifact_catalog(spark):
    listing = spark.createDataFrame([("d12", "model_000100.pt", 1), ("d12", "model_000250.pt", 2),
                                     ("d20", "model_000050.pt", 0), ("x", "model_000900.pt", 9)],
                                    "tag STRING, file_name STRING, mtime LONG")
    got = {r.tag: (r.last_step, r.is_default) for r in files.artifact_catalog(listing).collect()}
    assert got["d12"] == (250, False) and got["d20"] == (50, True) and got["x"][1] is False


def test_run_metrics_ema_across_blocks(spark):
    import random
    rng = random.Random(1)
    rows = [("r1" if i % 3 else "r2", i * 2, rng.uniform(0.5, 5.0), 1.0, rng.uniform(1, 3)) for i in range(3000)]
    # through Parquet like real inputs
    path = os.path.join(tempfile.mkdtemp(prefix="quill-rm-", dir="/tmp"), "m.parquet")
    spark.createDataFrame(rows, "run STRING, step LONG, loss DOUBLE, dt DOUBLE, val DOUBLE").write.parquet(path)
    df = spark.read.parquet(path)
    got = {(r.run, r.step): (r.ema_loss, r.min_val, r.time_after_warmup)
           for r in evals.run_metrics(df, val="val", warmup=10).collect()}
    for run in ("r1", "r2"):
        ema, mn, tw = 0.0, None, 0.0
        for t, (rr, step, loss, dt, val) in enumerate(r for r in rows if r[0] == run):
            ema = 0.9 * ema + 0.1 * loss
            mn = val if mn is None else min(mn, val)
            tw += dt if step > 10 else 0.0
            e, m, w = got[(run, step)]
            assert abs(e - round(ema / (1 - 0.9 ** (t + 1)), 6)) < 2e-6
            assert m == mn and abs(w - round(tw, 6)) < 1e-6
