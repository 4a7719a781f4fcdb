from pyspark.sql import functions as F

from quill.operators import pack


def _stream(docs):
    return [t for d in docs for t in d]


def _ref_pack(docs, B, T):
    s = _stream(docs)
    L = B * T + 1
    out = []
    for b in range(len(s) // L):
        blk = s[b * L:(b + 1) * L]
        for r in range(B):
            out.append((b, r, blk[r * T:r * T + T], blk[r * T + 1:r * T + T + 1]))
    return out


def _run(spark, docs, B, T):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc_id LONG, ids ARRAY<INT>")
    got = pack.pack(df, B, T).orderBy("block", "row").collect()
    return [(r.block, r.row, list(r.inputs), list(r.targets)) for r in got]


def test_pack_edges(spark):
    B, T = 2, 3
    L = B * T + 1
    for total in (B * T, B * T + 1, 2 * L - 1, 2 * L, 3 * L + 2):
        docs = [[0] + list(range(1, total))]          # one document longer than a block
        assert _run(spark, docs, B, T) == _ref_pack(docs, B, T), total
    docs = [[0], [0, 5, 6], [0], [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12], [0, 9]]
    assert _run(spark, docs, B, T) == _ref_pack(docs, B, T)


def test_collate_sft_masks_and_pads(spark):
    rows = [(0, [1, 2, 3, 4], [0, 0, 1, 1]), (1, [1, 5], [0, 1]), (2, [1], [0])]
    df = spark.createDataFrame(rows, "idx LONG, ids ARRAY<INT>, mask ARRAY<INT>")
    got = pack.collate_sft(df, 2, pad_id=99).orderBy("row").collect()
    assert [list(r.inputs) for r in got] == [[1, 2, 3], [1, 99, 99]]
    assert [list(r.targets) for r in got] == [[-1, 3, 4], [5, -1, -1]]


def test_option_spans_and_crop(spark):
    rows = [(0, 0, [1, 2, 3, 4]), (0, 1, [1, 2, 5]), (1, 0, [7, 8, 9]), (1, 1, [6, 8, 9])]
    df = spark.createDataFrame(rows, "item INT, option INT, ids ARRAY<INT>")
    mc = {(r.item, r.option): (r.start, r.end) for r in pack.option_spans(df, "mc").collect()}
    assert mc[(0, 0)] == (2, 4) and mc[(0, 1)] == (2, 3)
    sc = {(r.item, r.option): (r.start, r.end) for r in pack.option_spans(df, "schema").collect()}
    assert sc[(1, 0)] == (1, 3)
    c = pack.crop_left(df.withColumn("start", F.lit(2)).withColumn("end", F.size("ids")), 3)
    r = c.where("item = 0 AND option = 0").collect()[0]
    assert list(r.ids) == [2, 3, 4] and (r.start, r.end) == (1, 3) and r.span_ok


def test_sft_steps_floor_and_ceil():
    assert pack.sft_steps(23, 8, 2, "floor") == 4
    assert pack.sft_steps(23, 8, 2, "ceil") == 6
    assert pack.sft_steps(3, 8, 1, "floor") == 0 and pack.sft_steps(3, 8, 1, "ceil") == 1


def test_max_docs_overshoots_to_group_end(spark):
    from quill.operators.bpe import cap_docs_by_groups
    df = spark.range(3000).withColumnRenamed("id", "doc_id")
    assert cap_docs_by_groups(df, "doc_id", 1500).count() == 2048
    assert cap_docs_by_groups(df, "doc_id", 1024).count() == 1024
