from naive import naive_encode
from quill.functions.text import SPECIAL_TOKENS
from quill.operators import bpe, chat


def _naive_render(msgs, merges, n_ranks, max_tokens):
    sp = {s: n_ranks + i for i, s in enumerate(SPECIAL_TOKENS)}
    if msgs[0][0] == "system":
        msgs = [("user", msgs[0][1] + "\n\n" + msgs[1][1])] + msgs[2:]
    ids, mask = [sp["<|bos|>"]], [0]
    for role, text in msgs:
        e = naive_encode(text, merges)
        if role == "user":
            ids += [sp["<|user_start|>"]] + e + [sp["<|user_end|>"]]
            mask += [0] * (len(e) + 2)
        else:
            ids += [sp["<|assistant_start|>"]] + e + [sp["<|assistant_end|>"]]
            mask += [0] + [1] * len(e) + [1]
    return ids[:max_tokens], mask[:max_tokens]


def test_render_conversation_matches_naive(spark):
    convs = {
        1: [("system", "Be brief."), ("user", "Hi there"), ("assistant", "Hello! How are you?")],
        2: [("user", "Count: 1 2 3"), ("assistant", "Sure, one two three."), ("user", "again")],
        3: [("user", "x" * 50), ("assistant", "y y y y y y y y y y")],
    }
    rows = [(c, t, r, x) for c, msgs in convs.items() for t, (r, x) in enumerate(msgs)]
    df = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")
    merges = bpe.train_bpe(df.select("text"), 9 + 256 + 20)
    mrows = [(r.left, r.right, r.new_id) for r in merges.orderBy("new_id").collect()]
    for max_tokens in (2048, 12):
        got = {r.conv_id: (list(r.ids), list(r.mask))
               for r in chat.render_conversation(df, merges, max_tokens=max_tokens).collect()}
        for c, msgs in convs.items():
            assert got[c] == _naive_render(msgs, mrows, 256 + len(mrows), max_tokens), (c, max_tokens)


def test_render_parts_mask(spark):
    df = spark.createDataFrame([(1, "How many r in strawberry?",
                                 [("text", "Let me check "), ("python", "'strawberry'.count('r')"),
                                  ("python_output", "3"), ("text", "#### 3")])],
                               "conv_id LONG, user STRING, assistant_parts ARRAY<STRUCT<type: STRING, text: STRING>>")
    segs = chat.render_part_segments(df)
    merges = bpe.train_bpe(spark.createDataFrame([("strawberry count",)], "text STRING"), 9 + 256 + 5)
    mrows = [(r.left, r.right, r.new_id) for r in merges.orderBy("new_id").collect()]
    n_ranks = 256 + len(mrows)
    sp = {s: n_ranks + i for i, s in enumerate(SPECIAL_TOKENS)}
    want_ids, want_mask = [sp["<|bos|>"], sp["<|user_start|>"]], [0, 0]
    e = naive_encode("How many r in strawberry?", mrows)
    want_ids += e + [sp["<|user_end|>"], sp["<|assistant_start|>"]]
    want_mask += [0] * len(e) + [0, 0]
    for kind, text in [("text", "Let me check "), ("python", "'strawberry'.count('r')"),
                       ("python_output", "3"), ("text", "#### 3")]:
        e = naive_encode(text, mrows)
        if kind == "python":
            want_ids += [sp["<|python_start|>"]] + e + [sp["<|python_end|>"]]
            want_mask += [1] * (len(e) + 2)
        elif kind == "python_output":
            want_ids += [sp["<|output_start|>"]] + e + [sp["<|output_end|>"]]
            want_mask += [0] * (len(e) + 2)
        else:
            want_ids += e
            want_mask += [1] * len(e)
    want_ids.append(sp["<|assistant_end|>"])
    want_mask.append(1)
    r = chat.render_conversation(None, merges, segments=segs).collect()[0]
    assert list(r.ids) == want_ids and list(r.mask) == want_mask


def test_render_without_python_specials_falls_back(spark):
    df = spark.createDataFrame([(1, "q", [("python", "1+1"), ("python_output", "2"), ("text", "ok")])],
                               "conv_id LONG, user STRING, assistant_parts ARRAY<STRUCT<type: STRING, text: STRING>>")
    merges = bpe.train_bpe(spark.createDataFrame([("ok",)], "text STRING"), 5 + 256 + 1,
                           special_tokens=SPECIAL_TOKENS[:5])
    r = chat.render_conversation(None, merges, segments=chat.render_part_segments(df),
                                 special_tokens=SPECIAL_TOKENS[:5]).collect()[0]
    n_ranks = 257
    mrows = [(r_.left, r_.right, r_.new_id) for r_ in merges.collect()]
    body = naive_encode("1+1", mrows) + naive_encode("2", mrows) + naive_encode("ok", mrows)
    want_mask = [0, 0] + [0] * len(naive_encode("q", mrows)) + [0, 0] + \
        [1] * len(naive_encode("1+1", mrows)) + [0] * len(naive_encode("2", mrows)) + [1] * len(naive_encode("ok", mrows)) + [1]
    assert list(r.mask) == want_mask
    assert list(r.ids)[-1] == n_ranks + 4 and all(i < n_ranks for i in list(r.ids)[-1 - len(body):-1])
