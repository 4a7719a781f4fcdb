import random
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from naive import _merge, naive_chunk_counts, naive_encode, naive_train
from quill.functions.text import SPLIT_PATTERN
from quill.operators import bpe

EDGE = [
    "I'M here, you're THERE. It's 12345 and 9",
    "no break　ideographic  double   spaces  ",
    "line\r\nbreaks\u0085next​zero﻿bom",
    "ctrl\x1c\x1dseps é long ſt emoji 🙃🌍 digits ٣٤٥",
    "trailing spaces   ",
    "",
]


def test_pretokenize_matches_python_regex(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGE)], "id INT, text STRING")
    got = {r.id: list(r.chunks) for r in bpe.pretokenize(df).collect()}
    pat = regex.compile(SPLIT_PATTERN)
    for i, t in enumerate(EDGE):
        assert got[i] == pat.findall(t), t
        assert "".join(got[i]) == t


def test_chunk_counts_sum(spark):
    df = spark.createDataFrame([(t,) for t in EDGE], "text STRING")
    got = {r.chunk: r.cnt for r in bpe.chunk_counts(df).collect()}
    assert Counter(got) == naive_chunk_counts(EDGE)


def _train(spark, texts, n_merges, **kw):
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    return [(r.left, r.right, r.new_id, r.cnt) for r in bpe.train_bpe(df, 9 + 256 + n_merges, **kw).collect()]


def test_train_matches_naive_on_ties(spark):
    rng = random.Random(7)
    for trial in range(3):
        words = ["".join(rng.choice("ab c") for _ in range(rng.randint(1, 9))) for _ in range(60)]
        texts = [" ".join(words[i:i + 5]) for i in range(0, 60, 5)] + ["aaaa aaa aa", "abab abab"]
        ours = _train(spark, texts, 40, max_candidates=16)
        assert ours == naive_train(naive_chunk_counts(texts), 40), trial


def test_train_runs_out_of_pairs(spark):
    texts = ["ab ab", "a"]
    ours = _train(spark, texts, 50)
    assert ours == naive_train(naive_chunk_counts(texts), 50)
    assert len(ours) < 50


def test_select_batch_stops_on_shared_joint():
    cand = [(1, 2, 10), (2, 3, 9), (4, 5, 8)]
    assert bpe.select_batch(cand, False, 10) == [(1, 2, 10)]
    cand = [(1, 2, 10), (4, 5, 9), (6, 7, 8)]
    assert len(bpe.select_batch(cand, False, 10)) == 3
    # a == b ends the batch: (a, a) is its own neighbour
    assert bpe.select_batch([(1, 1, 10), (4, 5, 9)], False, 10) == [(1, 1, 10)]


def test_encode_decode_roundtrip_and_counts(spark):
    texts = ["Hello world! How are you? 🙃", "Numbers: 123, 4567, 89\nI'm here", "<|bos|> is text"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id INT, text STRING")
    merges = bpe.train_bpe(df, 9 + 256 + 30)
    mrows = [(r.left, r.right, r.new_id) for r in merges.orderBy("new_id").collect()]
    enc = {r.doc_id: list(r.ids) for r in bpe.encode(df, merges).collect()}
    for i, t in enumerate(texts):
        assert enc[i] == naive_encode(t, mrows)
    vocab = bpe.add_special_tokens(bpe.mergeable_ranks(merges))
    dec = {r.doc_id: r.out for r in bpe.decode_bytes(bpe.encode(df, merges), vocab, out="out").collect()}
    assert dec == dict(enumerate(texts))
    # special tokens are never produced from text
    n_ranks = 256 + len(mrows)
    assert all(x < n_ranks for ids in enc.values() for x in ids)
    c = bpe.count_tokens(df, merges).collect()[0]
    assert c.docs == 3 and c.tokens == sum(len(v) for v in enc.values()) + 3
    assert c.chars == sum(len(t) for t in texts)


def test_token_byte_lengths_replacement(spark):
    df = spark.createDataFrame([("é",)], "text STRING")
    vocab = bpe.add_special_tokens(bpe.mergeable_ranks(bpe.train_bpe(df, 9 + 256 + 1)))
    nb = {r.token_id: r.n_bytes for r in bpe.token_byte_lengths(vocab).collect()}
    assert nb[ord("a")] == 1
    assert nb[0xC3] == 3          # lone byte decodes to U+FFFD
    assert nb[256] == 2           # 'é' merged
    assert nb[257] == 0 and nb[257 + 8] == 0   # specials
    exact = {r.token_id: r.n_bytes for r in bpe.token_byte_lengths(vocab, exact=True).collect()}
    assert exact[0xC3] == 1


def test_apply_merges_left_to_right(spark):
    df = spark.createDataFrame([([97, 97, 97, 97],), ([97, 97, 97],)], "ids ARRAY<INT>")
    out = [list(r[0]) for r in df.select(bpe.apply_merges_col(df.ids, [(97, 97, 256)])).collect()]
    assert out == [_merge([97] * 4, (97, 97), 256), _merge([97] * 3, (97, 97), 256)]


@pytest.mark.parametrize("hot", [0, 3, 1 << 18])
def test_encode_by_dictionary(spark, hot):
    texts = [(1, "the cat the hat the bat"), (1, "the cat the hat the bat"), (2, None), (3, ""), (4, "x" * 300 + " the " + "x" * 300), (5, "é\U0001f642 漢 the"), (None, "the")]
    df = spark.createDataFrame(texts, "doc_id int, text string").withColumn("ids", F.lit("old")).withColumn("more", F.lit(7)).repartition(3)
    merges = bpe.train_bpe(df, 256 + 9 + 12)
    want = sorted((str(r.doc_id), str(r.text), tuple(r.ids)) for r in bpe.encode_inline(df, merges).collect())
    got = bpe.encode(df, merges, hot_chunks=hot)
    assert got.columns == ["doc_id", "text", "more", "ids"]
    assert sorted((str(r.doc_id), str(r.text), tuple(r.ids)) for r in got.collect()) == want
    both = bpe.encode(df, merges, prepend=900, append=901, hot_chunks=hot).where("doc_id = 3").collect()[0]
    assert list(both.ids) == [900, 901]
    assert bpe.encode(df.limit(0), merges, hot_chunks=hot).count() == 0


def test_each_distinct_chunk_is_encoded_once(spark):
    df = spark.createDataFrame([(i, "alpha beta alpha " * (1 + i % 3)) for i in range(50)], "doc_id int, text string")
    merges = bpe.train_bpe(df, 256 + 9 + 5)
    words = bpe.chunk_dictionary(bpe.pretokenize(df).selectExpr("explode(chunks) AS chunk"), merges)
    assert words.count() == words.select("chunk").distinct().count() == len({c for r in bpe.pretokenize(df).collect() for c in r.chunks})


def test_decode_unknown_id(spark):
    vocab = bpe.add_special_tokens(bpe.mergeable_ranks(spark.createDataFrame([], "rank INT, left INT, right INT, new_id INT, cnt LONG")), ["<s>"])
    df = spark.createDataFrame([([104, 99999, 105],)], "ids array<int>")
    assert bpe.decode_bytes(df, vocab, out="t").collect()[0].t == "h�i"


def test_blocks_of_words_merge_and_count_like_single_words():
    """Array steps over a whole block against one word at a time; runs and overlaps included."""
    import numpy as np
    rng = random.Random(11)
    words = [[rng.choice((1, 2, 3)) for _ in range(rng.randint(1, 9))] for _ in range(300)]
    weights = np.array([rng.randint(1, 1 << 40) for _ in words], np.int64)
    x = np.array([t for w in words for t in (*w, bpe._END)], np.int32)
    for merge in ((1, 1), (1, 2), (2, 2), (9, 9)):
        out = bpe._merge_block(x, *merge, 7)[0]
        assert out.tolist() == [t for w in words for t in (*_merge(w, merge, 7), bpe._END)]
    want = Counter()
    for w, n in zip(words, weights.tolist()):
        for a, b in zip(w, w[1:]):
            want[a << 32 | b] += n
    keys, sums = bpe._summed(*bpe._pairs(x, weights))
    assert dict(zip(keys.tolist(), sums.tolist())) == want


def test_pair_counts_add_up_before_the_shuffle(spark):
    words = spark.createDataFrame([([1, 2, 1, 2], 3)] * 500 + [([5], 9), ([], 1)], "ids array<int>, cnt bigint").coalesce(1)
    got = bpe.pair_counts(words)
    assert {(r.left, r.right): r.cnt for r in got.collect()} == {(1, 2): 3000, (2, 1): 1500}
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()


def test_encoder_of_batches_equals_one_chunk_at_a_time():
    """F8: chunks in runs, with and without kept ids; runs of one token, long chunks, nulls."""
    import pyarrow as pa
    rng = random.Random(5)
    words = ["".join(rng.choice("aab \u00e9\U0001f642") for _ in range(rng.choice((1, 2, 3, 5, 9, 80)))) for _ in range(400)]
    table = [(97, 97, 256), (256, 97, 257), (0xC3, 0xA9, 258), (97, 98, 259), (256, 256, 260), (260, 260, 261), (258, 32, 262)]
    ranks = {(left, right): new for left, right, new in table}
    rows = [rng.choices(words, k=rng.randint(0, 30)) for _ in range(200)] + [None, [], [""]]
    for keep in (0, 50, 1 << 18):
        encoder = bpe._Encoder(table, keep)
        for part in (rows[:90], rows[90:], rows[:50], []):
            got = encoder(pa.array(part, pa.list_(pa.string()))).to_pylist()
            assert got == [[i for c in r or [] for i in bpe._encode_chunk(c, ranks)] for r in part]
    assert bpe._Encoder([], 9)(pa.array([["ab"]], pa.list_(pa.string()))).to_pylist() == [[97, 98]]


def test_encode_and_decode_shuffle_no_rows(spark):
    """F8: one pass over the texts. Before, chunks were written, shuffled and joined back."""
    df = spark.createDataFrame([(i, f"word{i} the word") for i in range(40)], "doc_id int, text string").repartition(3).localCheckpoint()
    merges = bpe.train_bpe(df, 256 + 9 + 5)
    vocab = bpe.add_special_tokens(bpe.mergeable_ranks(merges))
    out = bpe.decode_bytes(bpe.encode(df, merges, hot_chunks=4).drop("text"), vocab, out="text")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and "Relation" not in plan
    assert {r.doc_id: r.text for r in out.collect()} == {r.doc_id: r.text for r in df.collect()}


def test_decode_broken_utf8_null_and_empty(spark):
    vocab = bpe.add_special_tokens(bpe.mergeable_ranks(spark.createDataFrame([], "rank INT, left INT, right INT, new_id INT, cnt LONG")), ["<s>"])
    df = spark.createDataFrame([(0, [0xC3, 0xA9, 65]), (1, [0xC3]), (2, []), (3, None), (4, [256, -7, 0xE2, 0x82, 66])], "k int, ids array<int>").coalesce(1)
    got = {r.k: r.t for r in bpe.decode_bytes(df, vocab, out="t").collect()}
    assert got == {0: "\u00e9A", 1: "\ufffd", 2: "", 3: None, 4: "<s>\ufffd\ufffdB"}


def test_count_tokens_adds_up_before_rows_leave_python(spark):
    """before, the ids of every distinct chunk went back to the JVM to be counted there."""
    texts = ["the cat the hat \u00e9" * 3, None, "", "a" * 200 + " the", "the cat"] * 4
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    merges = bpe.train_bpe(df, 256 + 9 + 12)
    ids = bpe.encode(df, merges).collect()
    c = bpe.count_tokens(df, merges)
    assert "ArrowEvalPython" not in c._jdf.queryExecution().executedPlan().toString()
    got = c.collect()[0]
    assert (got.docs, got.tokens) == (20, sum(len(r.ids) for r in ids) + 20)


def test_pairs_of_few_tokens_add_up_without_a_sort(monkeypatch):
    """every round of the training sorted all pairs of the changed words."""
    import numpy as np
    rng = np.random.default_rng(3)
    left, right = rng.integers(0, 200, 5000), rng.integers(0, 200, 5000)
    values = rng.integers(-(1 << 40), 1 << 40, 5000)

    def summed(a, b):
        keys, sums = bpe._summed(a.astype(np.int64) << 32 | b, values)
        assert (np.diff(keys) > 0).all()
        return dict(zip(keys.tolist(), sums.tolist()))
    want = Counter()
    for a, b, v in zip(left.tolist(), right.tolist(), values.tolist()):
        want[a, b] += v
    assert summed(left * 1000, right) == {a * 1000 << 32 | b: n for (a, b), n in want.items()}      # many tokens: sorted
    monkeypatch.setattr(np, "argsort", None)
    assert summed(left, right) == {a << 32 | b: n for (a, b), n in want.items()}
    monkeypatch.undo()
    assert [len(x) for x in bpe._summed(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0]
