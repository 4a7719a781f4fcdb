"""The operators on Spark: odd rows (nulls, empty and very long texts, repeats, ties,
clashing columns), empty tables, and the given tables against brute force."""

import glob
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quill.llm import bpe_codec, components, embedding_dedup, fertility, html_wrapper, ngram_join, packing, ppm, quality_cnn, queries, tables, toxicity, warc_zip

LONG = " ".join(f"w{i % 5003}x{i % 7}" for i in range(60_000))
ODD = [
    (1, "one two three four five six seven eight nine ten", "en"), (2, "one two three four five six seven eight nine ten", "en"),
    (2, "one two three four five six seven eight nine ten", "en"),      # a repeated row
    (3, None, "en"), (4, "", None), (5, "  \n\t ", "de"), (None, "one two three four five six seven eight nine ten", "en"), (None, None, None),
    (6, LONG, "en"), (7, LONG + " tail", "fr"), (8, "A b", None), (9, "a  B", "xx"), (10, "<|endoftext|> don't  stop", "en"),
    (11, "é\U0001f642漢 " * 30, "zh"),
]
SCHEMA = "doc_id bigint, text string, lang string"


@pytest.fixture(scope="module")
def odd(spark):
    """Odd documents with extra columns named like results."""
    return (spark.createDataFrame(ODD, SCHEMA).withColumn("score", F.lit("x")).withColumn("n", F.lit(1)).withColumn("node", F.lit("y"))
            .withColumn("key", F.lit(None).cast("string")).withColumn("length", F.lit(0.5)).withColumn("kept", F.lit("z")).withColumn("row", F.lit(1)).withColumn("ids", F.lit(2)))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def folded(t):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(t)]


def in_fold(doc_id, m, r):
    return (0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % m) == r


def test_bpe_digests(odd, none, tokenizer):
    rows = bpe_codec.encoding_digests(odd).collect()
    want = Counter()
    for i, t, _ in ODD:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
        assert back == (t or "")
    assert Counter(map(tuple, rows)) == want
    ids = bpe_codec.encode_texts(odd.where("doc_id = 10")).collect()[0]
    assert ids.decoded == "<|endoftext|> don't  stop" and 50256 in ids.ids
    assert bpe_codec.encoding_digests(none).count() == 0


def test_packing(odd, none, tokenizer):
    rows = packing.pack_documents(odd).collect()
    by_doc = defaultdict(list)
    filled = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        filled[r.sequence_id].append((r.offset, r.length))
    for spans in filled.values():       # gapless from 0, at most the capacity
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    texts = defaultdict(list)
    for i, t, _ in ODD:
        texts[i].append(t)
    assert by_doc.keys() == texts.keys()
    for i, ts in texts.items():
        want = Counter()
        for t in ts:
            ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
            first = (len(ids) - 1) % 1024 + 1
            cuts = [0, *range(first, len(ids) + 1, 1024)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                want[k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
        assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == want
    total = sum(r.length for r in rows)
    assert len(filled) <= math.ceil(total / 1024) + 2
    assert packing.pack_documents(none).count() == 0


def test_fertility(odd, none):
    rows = fertility.judged(odd).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        texts = [t for i, t, _ in ODD if i == r.doc_id]
        assert r.n_words in [len(words(t)) for t in texts]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = fertility.keep_good(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.kept)
    assert fertility.judged(none).count() == 0 and fertility.keep_good(none).count() == 0


def test_fertility_bands_reject_the_odd_one_out(spark):
    rng = np.random.default_rng(0)
    plain = [(i, " ".join(rng.choice(["the", "house", "water", "people", "small", "great"], 80)) + f" {i}", "en") for i in range(300)]
    noise = [(1000 + i, " ".join("".join(rng.choice(list("ЖЩЫЮ漢字猫"), 9)) for _ in range(80)), "en") for i in range(5)]
    v = {r.doc_id: r.kept or r.base_failed for r in fertility.judged(spark.createDataFrame(plain + noise, SCHEMA)).collect()}
    assert all(v[i] for i, *_ in plain) and not any(v[i] for i, *_ in noise)


def test_fertility_bands_are_those_of_the_own_language_at_any_size(spark):
    rng = np.random.default_rng(0)

    def table(docs):
        plain = [(i, " ".join(rng.choice(["the", "house", "water", "people", "small", "great"], 80)) + f" {i}", "en") for i in range(docs)]
        other = [(10_000 + i, " ".join("".join(rng.choice(list("ЖЩЫЮ漢字猫"), 9)) for _ in range(80)), "xx") for i in range(docs)]
        odd = [(20_000, other[0][1], "en"), (20_001, plain[0][1], "xx")]      # each in the other's language
        return spark.createDataFrame(plain + other + odd, SCHEMA)
    for docs in (20, 300):
        v = {r.doc_id: r.kept or r.base_failed for r in fertility.judged(table(docs)).collect()}
        assert {i for i, ok in v.items() if not ok} == {20_000, 20_001}


def test_near_duplicates(odd, none, spark):
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(odd).collect()}
    assert {(1, 6, 1), (2, 6, 1), (None, 6, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (None, 0, None), (8, 1, 8), (9, 1, 8)} <= rows
    assert {c for i, _, c in rows if i in (6, 7)} == {6}
    lead = ngram_join.one_of_each(odd)
    assert lead.columns == odd.columns
    assert Counter(r.doc_id for r in lead.collect()) == Counter([1, 3, 4, 5, 6, 8, 10, 11, None, None])
    assert ngram_join.near_duplicates(none).count() == 0


def test_near_duplicates_of_many_copies(spark, monkeypatch):
    """Large groups (chained, thinned in the task, cut into blocks) against all pairs."""
    for name, value in (("GROUP", 8), ("BLOCK_LOW", 20), ("BLOCK_HIGH", 60), ("BLOCKS", 3)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = np.random.default_rng(1)
    base = [[f"b{k}w{i}" for i in range(70)] for k in range(3)]
    rows = []
    for i in range(150):
        w = list(base[i % 3])[: int(rng.integers(40, 70))]
        for _ in range(int(rng.integers(0, 5))):
            w[int(rng.integers(0, len(w)))] = f"m{rng.integers(0, 40)}"
        rows.append((i, " ".join(w), "en"))
    sets = [{tuple(t.split()[j:j + 5]) for j in range(len(t.split()) - 4)} for _, t, _ in rows]
    low = list(range(len(rows)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                low[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in range(len(rows))}


def _sent(spark, monkeypatch, run):
    """Rows that enter the prefix groups, and names of written tables left when ``run`` is over."""
    seen, made, edges, stored = [], [], ngram_join.candidate_edges, tables.stored

    def counted(rows, percent):
        seen.append(rows.count())
        return edges(rows, percent)

    def kept(df, name):
        made.append((name, stored(df, name)))
        return made[-1][1]
    monkeypatch.setattr(ngram_join, "candidate_edges", counted)
    for module in (ngram_join, components):
        monkeypatch.setattr(module, "stored", kept)
    out = run()
    left = Counter(name for name, df in made if glob.glob(df.stored_at.removeprefix("file:") + "/*"))
    return out, seen[0], left


def test_near_duplicates_move_repeats_only(spark, monkeypatch):
    """Copies and n-grams that meet nobody are not shuffled, and tables that were read go."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 10**9, 60)), "en") for i in range(200)]
    rows += [(1000 + 200 * c + i, rows[i][1], "en") for c in range(5) for i in range(200)]
    near = rows[7][1].split()
    rows.append((9000, " ".join(near[:-1] + ["other"]), "en"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(8, F.col("doc_id"))
    got, sent, left = _sent(spark, monkeypatch, lambda: {r.doc_id: r.component_id for r in ngram_join.near_duplicates(df).collect()})
    assert got == {i: 7 if i == 9000 else i if i < 200 else (i - 1000) % 200 for i, _, _ in rows}
    assert sent < 2000          # of some 20,000 prefix n-grams, and 24,000 with the copies
    assert set(left) == {"sets", "classes", "edges"} and left["edges"] <= 1


def test_near_duplicates_with_full_bit_tables(spark, odd, monkeypatch):
    """What the tables let through by chance changes nothing."""
    want = sorted(map(str, ngram_join.near_duplicates(odd).collect()))
    kept = sorted(str(r.doc_id) for r in ngram_join.one_of_each(odd).collect())
    for name, value in (("BITS", 64), ("REPEATS", 1 << 12)):
        monkeypatch.setattr(ngram_join, name, value)
    assert sorted(map(str, ngram_join.near_duplicates(odd).collect())) == want
    assert sorted(str(r.doc_id) for r in ngram_join.one_of_each(odd).collect()) == kept


def test_one_of_each_moves_few_rows(spark):
    """Rows are only joined where their key may be one that goes."""
    rows = [(i, f"alpha beta gamma delta epsilon zeta eta theta iota {i} " * 3, "en") for i in range(50)] + [(100 + i, f"alpha beta gamma delta epsilon zeta eta theta iota {i} " * 3, "en") for i in range(5)]
    out = ngram_join.one_of_each(spark.createDataFrame(rows, SCHEMA))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "LeftAnti" in plan and "LeftSemi" not in plan
    assert not {r.doc_id for r in out.collect()} & {100, 101, 102, 103, 104}


def brute_components(rows, threshold=0.93):
    low = list(range(len(rows)))
    links = [0] * len(rows)

    def unit(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, np.float64) / max(abs(x) for x in v)
        return a / np.linalg.norm(a)

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    units = [unit(v) for _, v, _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) \
                    and (rows[i][1] == rows[j][1] or units[i] @ units[j] >= threshold):
                links[i] += 1
                links[j] += 1
                low[max(find(i), find(j))] = min(find(i), find(j))
    lowest = {}
    for i, (key, *_) in enumerate(rows):
        if key is not None:
            lowest[find(i)] = min(lowest.get(find(i), key), key)
    return Counter((key, links[i], lowest.get(find(i), key)) for i, (key, *_) in enumerate(rows))


def test_embedding_dedup(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        center = rng.normal(size=16)
        for _ in range(15):
            rows.append((len(rows), (center + rng.normal(size=16) * rng.uniform(0.05, 0.45)).astype(np.float32).tolist(), int(c % 2)))
    one = rows[0][1]
    rows += [(200, one, 0), (200, one, 0), (201, [2 * x for x in one], 0), (202, one, 1), (203, one, None), (204, None, 0), (205, [0.0] * 16, 0), (None, one, 0),
             (206, [None] + one[1:], 0), (207, [float("nan")] + one[1:], 0), (208, [float("inf")] + one[1:], 0), (209, [], 0), (210, one[:3], 0), (211, [1e-30 * x for x in one], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("node", F.lit(1)).withColumn("kept", F.lit(2))
    out = embedding_dedup.near_duplicates(df).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in out) == brute_components(rows)
    assert all(r.kept == (None if r.vec_id is None else r.vec_id == r.component_id) for r in out)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_ppm(odd, none):
    rows = ppm.score_held_out(odd).collect()
    assert len(rows) == len(ODD)
    train = [folded(t) + [None] for i, t, _ in ODD if not in_fold(i, 7, 2)]
    c = Counter(w for t in train for w in t)
    total, vocab = sum(c.values()), len(c)
    want = defaultdict(list)
    for i, t, _ in ODD:
        tokens = folded(t) + [None]
        want[i].append((len(tokens), sum(c[w] > 0 for w in tokens), round(sum(math.log10((c[w] + 1) / (total + vocab + 1)) for w in tokens), 4)))
    for r in rows:
        assert (r.n_tokens, r.n_known, round(r.base_score, 4)) in want[r.doc_id]
        assert r.train_tokens == total and r.held_out == in_fold(r.doc_id, 7, 2) and r.score < 0
    assert ppm.score_held_out(none).count() == 0


def test_ppm_shorter_contexts_when_the_trie_is_too_large(odd):
    small = ppm.score_held_out(odd, max_entries=2000).collect()
    assert len(small) == len(ODD) and all(r.score < 0 for r in small)


def test_ppm_scores_do_not_depend_on_the_size_of_the_trie(odd):
    want = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in ppm.score_held_out(odd).collect())
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in ppm.score_held_out(odd, max_entries=200).collect())
    for a, b in zip(want, got, strict=True):
        assert a[:3] == b[:3] and b[3:] == pytest.approx(a[3:], rel=1e-9)


def test_ppm_moves_no_runs_of_texts(odd, monkeypatch):
    """Where the trie is in files, too, a text is one row of sums, and what was read goes."""
    want = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in ppm.score_held_out(odd).collect())
    made, stored = [], tables.stored

    def kept(df, name):
        out = stored(df, name)
        made.append((name, out.count(), out))
        return out
    monkeypatch.setattr(ppm, "stored", kept)
    monkeypatch.setattr(ppm, "HELD", 50)        # looked up after every few texts
    monkeypatch.setattr(ppm, "SCORED", 50)
    monkeypatch.setattr(ppm, "FILE_WORDS", 10)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in ppm.score_held_out(odd, max_entries=2000).collect())
    for a, b in zip(want, got, strict=True):
        assert a[:3] == b[:3] and b[3:] == pytest.approx(a[3:], rel=1e-9)
    assert [name for name, _, _ in made] == ["ppm-counts", "ppm-scored"] and made[1][1] == len(ODD)
    assert not glob.glob(made[0][2].stored_at.removeprefix("file:") + "/*")


def test_classifiers_on_odd_and_empty_tables(odd, none, spark):
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(1, 12)] + [(None, 1, 1), (6, None, None)], "doc_id bigint, quality int, toxic int")
    w = quality_cnn.fit(odd, labels, steps=5)
    rows = quality_cnn.score(odd, w).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    kept = quality_cnn.keep_good(odd, w)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.score >= 0.7)
    model = toxicity.fit(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    w = quality_cnn.fit(none, labels.limit(0))
    assert [r.score for r in quality_cnn.score(odd.limit(1), w).collect()] == [0.5]
    model = toxicity.fit(none, labels.limit(0))
    assert [r.score for r in toxicity.score(odd.limit(1), model).collect()] == [0.5]
    assert quality_cnn.score(none, w).count() == 0 and toxicity.score(none, model).count() == 0


def test_toxic_passages_are_found_whole(spark):
    rng = np.random.default_rng(5)
    plain = [f"word{i}" for i in range(40)]
    rows, labels = [], []
    for i in range(240):
        w = rng.choice(plain, 60).tolist()
        if i % 4 == 0:
            at = int(rng.integers(0, 50))
            w[at:at + 6] = rng.choice(["vilex", "nastyx", "foulx"], 6).tolist()
        rows.append((i, " ".join(w) + f" u{i}", "en"))
        labels.append((i, int(i % 4 == 0)))
    df = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert set(model["lexicon"]) == {b"vilex", b"nastyx", b"foulx"}
    for r in toxicity.score(df, model).collect():
        assert (r.score >= 0.5) == (r.doc_id % 4 == 0)
        if r.doc_id % 4 == 0:
            w = rows[r.doc_id][1].split()
            assert len(r.passages) == 1 and all(x.endswith("lex") or x.endswith("tyx") or x.endswith("lx") for x in w[r.passages[0].start:r.passages[0].end])


PAGES = [(1, "http://a.example/1", "<p>" + "same page text " * 20), (2, "http://a.example/2", "<p>" + "same page text " * 20), (3, None, "<p>" + "same page text " * 20),
         (4, "x", "short"), (5, "y", "short"), (6, "z", None), (7, "u\r\nv", ""), (None, None, "<p>" + "same page text " * 20), (8, "w", "é\r\n\r\n" * 100),
         (9, "http://b.example", "<article>" + "<p>long text</p>" * 20_000 + "</article>"), (1, "http://a.example/1", "<p>" + "same page text " * 20)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("payload", F.lit(1)).withColumn("digest", F.lit(1)).withColumn("host", F.lit(1))


def test_archives(pages, monkeypatch):
    monkeypatch.setattr(warc_zip, "TARGET_BYTES", 400)      # several archives
    monkeypatch.setattr(warc_zip, "READ_AHEAD", 300)        # several ranges
    rows = warc_zip.archive(pages).collect()
    want = Counter()
    first = {}
    for i, _, h in PAGES:
        b = (h or "").encode()
        if i is not None and len(b) >= 100:
            first[b] = min(first.get(b, i), i)
    for i, _, h in PAGES:
        b = (h or "").encode()
        f = first.get(b)
        revisit = f is not None and i != f
        want[i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", f if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == want
    texts = {i: (h or "").encode() for i, _, h in PAGES}
    assert all(bytes(r.payload) == texts[r.page_id] for r in rows if r.record_type == "response")
    assert warc_zip.archive(pages.limit(0)).count() == 0


def test_pages_to_text(pages):
    rows = html_wrapper.extract(pages).collect()
    assert len(rows) == len(PAGES)
    got = {r.page_id: r.text for r in rows}
    assert got[9] == "\n\n".join(["long text"] * 20_000)
    assert got[6] == "" and got[7] == "" and got[1] == ("same page text " * 20).strip()
    assert html_wrapper.extract(pages.limit(0)).count() == 0


def test_pipeline_keeps_what_each_stage_says(spark):
    docs = queries.named(spark, SF_SMALL, "documents")
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    kept = {r.doc_id for r in fertility.judged(docs).where("kept").collect()}
    good = {r.doc_id for r in queries.op8_quality_cnn(spark, SF_SMALL).where("predicted = 1").collect()}
    left = docs.where(F.col("doc_id").isin(sorted(kept & good)))
    lead = {r.doc_id for r in ngram_join.near_duplicates(left).where("doc_id = component_id").collect()}
    assert {r.doc_id for r in rows} == lead
    assert len(corpus_pipeline.STAGES) == 4
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF_SMALL)
    assert empty.count() == 0


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r for r in queries.named(spark, "/root/testdata/sf0.01", "labels").collect()}
    rows = [r for r in queries.op8_quality_cnn(spark, "/root/testdata/sf0.01").where("held_out").collect() if r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id].quality for r in rows]) >= 0.93
    rows = [r for r in queries.op1_toxic_segments(spark, "/root/testdata/sf0.01").where("held_out").collect() if r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id].toxic for r in rows]) >= 0.93


def test_classifier_learns_from_all_chunks_of_long_documents(spark):
    """Held-out accuracy on documents of more than six chunks whose mark lies in one chunk."""
    rng = np.random.default_rng(6)
    plain = [f"word{i}" for i in range(50)]
    rows, labels = [], []
    for i in range(300):
        w = rng.choice(plain, 1500).tolist()            # some 20 chunks
        if i % 2 == 0:
            at = int(rng.integers(0, 1450))
            w[at:at + 30] = ["##|##|##"] * 30
        rows.append((i, " ".join(w), "en"))
        labels.append((i, i % 2))
    df = spark.createDataFrame(rows, SCHEMA)
    w = quality_cnn.fit(df, spark.createDataFrame(labels, "doc_id bigint, quality int"), steps=150)
    out = [r for r in quality_cnn.score(df, w).collect() if in_fold(r.doc_id, 4, 2)]
    assert len(out) > 40 and np.mean([(r.score >= 0.5) == (r.doc_id % 2 == 1) for r in out]) >= 0.95


def test_classifier_samples_whole_rows(spark, monkeypatch):
    got = []
    monkeypatch.setattr(quality_cnn, "train", lambda docs, **kw: got.append([len(t) // 2 // quality_cnn.CHUNK for t, _ in docs]))
    df = spark.createDataFrame([(i, "ab " * 3000, "en") for i in range(40)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    quality_cnn.fit(df, labels)
    quality_cnn.fit(df, labels, max_bytes=40_000)
    n = len(quality_cnn.chunk_starts(9000))
    assert len(got[0]) > 20 and set(got[0]) == {n} and got[1] == [n] * 5


def test_pipeline_keeps_one_stage_table(spark, odd, monkeypatch):
    """The table of a stage goes when the next stage is written; the input stays."""
    made, stored = [], tables.stored
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, name: made.append(stored(df, name)) or made[-1])
    monkeypatch.setattr(corpus_pipeline, "named", lambda *a: odd)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(str(i), lambda spark, docs, sf: made.append(stored(docs, "own")) or made[-1]) for i in range(3)])
    assert corpus_pipeline.run(spark, "unused").count() == len(ODD)
    assert [bool(glob.glob(df.stored_at.removeprefix("file:") + "/*")) for df in made] == [False] * 5 + [True]
