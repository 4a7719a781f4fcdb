from pyspark.sql import functions as F

from quill.operators import chat, corpus
from quill.plans.order import dense_index, prefix_sum
from quill.sources import files


def _df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_sentences_edges(spark):
    texts = ["", ".", "a", "a.", "a. b", "a.."]
    df = _df(spark, [(i, t) for i, t in enumerate(texts)], "doc_id INT, text STRING")
    got = {}
    for r in corpus.sentences(df).orderBy("doc_id", "pos").collect():
        got.setdefault(r.doc_id, []).append(r.sentence)

    def ref(text):
        out = []
        parts = text.split(".")
        for i, s in enumerate(parts):
            s = s.strip()
            if s:
                out.append(s + "." if i < len(parts) - 1 or text.endswith(".") else s)
        return out
    for i, t in enumerate(texts):
        assert got.get(i, []) == ref(t), t


def test_char_budget_keeps_crossing_document(spark):
    df = _df(spark, [(1, "aaaa"), (2, "bbbb"), (3, "cc"), (4, "d")], "doc_id LONG, text STRING")
    kept = [r.doc_id for r in corpus.take_char_budget(df, ["doc_id"], 8, doc_cap=None).orderBy("doc_id").collect()]
    assert kept == [1, 2, 3]          # exclusive prefix of 3 is 8 ≤ 8
    kept = [r.doc_id for r in corpus.take_char_budget(df, ["doc_id"], 3, doc_cap=None).collect()]
    assert kept == [1]                # the document crossing the budget is the last one kept
    kept = [r.doc_id for r in corpus.take_char_budget(df, ["doc_id"], 3, doc_cap=2).orderBy("doc_id").collect()]
    assert kept == [1, 2]             # cropped lengths 2, 2 → doc 3 starts at 4 > 3


def test_prefix_sum_equals_global_window(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    got = {r.k: r.prefix for r in prefix_sum(df, ["k"], "v", n_buckets=13).collect()}
    run = 0
    for k in range(5000):
        run += k % 7
        assert got[k] == run


def test_dense_index_partition_invariant(spark):
    base = spark.range(0, 777).select(F.col("id").alias("k"))
    for n in (1, 4, 17):
        got = [r.idx for r in dense_index(base.repartition(n), ["k"]).orderBy("k").collect()]
        assert got == list(range(777))


def test_qa_pairs_rules(spark):
    pat = r"(?i)^(?:(?:Mr\.?\s+)?Smith|.*\((?:Mr\.?\s+)?Smith\))\s*:"
    docs = [
        (0, "Smith: first paragraph match\n\nNext para"),
        (1, "Heading about trade.\n\nThe minister spoke\n\nMR SMITH: answer one"),
        (2, "Title!\n\nWhy is this?\n\nsmith : answer two"),
        (3, "Title\n\nHe asked about it\n\nThe member (Mr Smith): answer three"),
        (4, ""),
    ]
    df = _df(spark, docs, "doc_id INT, text STRING")
    got = {r.doc_id: (r.question, r.answer) for r in corpus.extract_qa_pairs(df, pat).collect()}
    assert 0 not in got
    assert got[1] == ("Heading about trade?", "MR SMITH: answer one")
    assert got[2] == ("Why is this?", "smith : answer two")
    assert got[3][0] == "He asked about it"
    counts = corpus.speaker_match_counts(df, pat).collect()[0]
    assert (counts.matches, counts.pairs) == (4, 3)


def test_ratio_split_sizes(spark):
    for n, want in [(2, 1), (19, 1), (20, 1), (1000, 50)]:
        df = spark.range(n).select(F.col("id").alias("k"))
        s = chat.ratio_split(df, "k", 0.05, 42)
        assert s.where("split = 'val'").count() == want
        assert s.count() == n


def test_split_paths_quirk():
    assert files.split_paths(["b", "a"], "val") == ["b"]
    assert files.split_paths(["only"], "train") == []      # one shard: train is empty
    assert files.split_paths([], "val") == []


def test_validate_and_merge_system(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "user", "U"), (1, 2, "assistant", "A"),
            (2, 0, "system", "S"),
            (3, 0, "user", "U"), (3, 1, "user", "U2")]
    df = _df(spark, rows, "conv_id INT, turn INT, role STRING, text STRING")
    v = {r.conv_id: r.reasons for r in chat.validate_conversations(df, "render").collect()}
    assert v[1] == "" and "system_not_followed_by_user" in v[2] and v[3] == "bad_alternation"
    m = {(r.conv_id, r.turn): r.text for r in chat.merge_system(df).collect()}
    assert m[(1, 0)] == "S\n\nU"


def test_mix_oversamples_and_is_a_permutation(spark):
    a = spark.range(5).select(F.col("id").alias("local_idx"))
    b = spark.range(3).select(F.col("id").alias("local_idx"))
    m = chat.mix([a, b, b], seed=42).collect()
    assert sorted(r.idx for r in m) == list(range(11))
    assert sum(1 for r in m if r.task_idx == 2 and r.copy == 1) == 3


def test_char_budget_stop_above_matches_sequential(spark):
    rows = [(i, "x" * ((i * 37) % 11)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    for budget in (0, 5, 97, 1000, 10**6):
        kept = sorted(r.doc_id for r in corpus.take_char_budget(df, ["doc_id"], budget, doc_cap=None).collect())
        want, n = [], 0
        for i, t in rows:
            want.append(i)
            n += len(t)
            if n > budget:
                break
        assert kept == want, budget
