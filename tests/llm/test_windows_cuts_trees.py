"""Wu-Manber search, token alignment and the Merkle manifest against brute force, on the
given tables and on odd rows (nulls, empty and very long texts, ties, repeated rows,
clashing columns, empty tables)."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quill.llm import merkle, oracles, queries, token_alignment, wu_manber

LONG = " ".join(f"w{i % 5003}x{i % 7}" for i in range(30_000))


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# --- Wu-Manber -----------------------------------------------------------------

def item_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))


def brute_overlaps(docs, items, size=10):
    windows = defaultdict(set)
    for item, t in items:
        w = item_words(t)
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[i:i + k])].add("" if item is None else str(item))
    out = []
    for key, t in docs:
        w, cover, found = item_words(t), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                got = windows.get(tuple(w[i:i + k]))
                if got:
                    cover.update(range(i, i + k))
                    found |= got
        out.append((key, len(w), len(cover), len(found), sha(",".join(sorted(found))), bool(cover)))
    return sorted(out, key=str)


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "Short one"), (10, "x"), (3, None), (4, ""), (5, " .,; "),
         (None, "nameless item here"), (6, "ünï cödé 漢字 \U0001f642 ok"), (7, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
         (7, "another row of seven"), (8, "a a a a a a a a a a a a"), (9, LONG[:400])]
DOCS = [(1, "so ALPHA, beta-gamma delta epsilon zeta eta theta iota kappa lambda mu!"), (2, "short-ONE short one"), (3, None), (4, ""), (5, "...  \n"),
        (None, "nameless item here"), (6, "ÜNÏ CÖDÉ ünï cödé 漢字 \U0001f642 ok"), (7, "a " * 300), (8, LONG), (8, LONG), (9, "xx x x1"), (10, "é x é"),
        (11, "alpha beta gamma delta epsilon zeta eta theta iota kappalambda mu"), (12, "short\x00one\x7fx")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_overlaps_on_odd_rows(spark, block_bytes):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").withColumn("row", F.lit("r")).withColumn("runs", F.lit(1)).withColumn("item", F.lit(2)).repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("window", F.lit(0))
    got = sorted((tuple(r) for r in wu_manber.report(docs, items, block_bytes=block_bytes).collect()), key=str)
    assert got == brute_overlaps(DOCS, ITEMS)
    assert wu_manber.report(docs.limit(0), items, block_bytes=block_bytes).count() == 0
    assert not any(r.n_hit or r.n_items or r.contaminated for r in wu_manber.report(docs, items.limit(0)).collect())


def test_overlap_spans(spark):
    docs = spark.createDataFrame([(1, "p q r short one t x u")], "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    row = wu_manber.overlaps(docs, items).collect()[0]
    assert [tuple(r) for r in row.runs] == [(3, 5), (6, 7)] and sorted(row["items"]) == ["10", "2"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab é", max_size=40), max_size=6), st.lists(st.text("ab é", max_size=60), max_size=6))
def test_searcher_against_find(items, texts):
    windows = sorted({wu_manber.canonical(i.encode())[0] for i in items} - {b""})
    s = wu_manber.Searcher([(w, str(i)) for i, w in enumerate(windows)])
    text = b"".join(wu_manber.canonical(t.encode())[0] for t in texts)
    want = {(i, j) for j, w in enumerate(windows) for i in range(len(text)) if text.startswith(w, i)}
    at, which = s.find(text)
    assert sorted(zip(at.tolist(), which.tolist())) == sorted(want)


def test_searcher_across_lanes_and_buckets():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)]
    text = " " + " ".join(rng.choice(words, 20_000)) + " "
    windows = {" " + " ".join(text.split()[i:i + k]) + " " for i in range(0, 19_000, 37) for k in (1, 2, 5, 10, 11)}
    windows |= {w[:-3] + "zz " for w in windows}
    s = wu_manber.Searcher([(w.encode(), "i") for w in windows])
    want = set()
    for w in windows:
        at = text.find(w)
        while at >= 0:
            want.add((at, w))
            at = text.find(w, at + 1)
    order = sorted(w.encode() for w in windows)
    at, which = s.find(text.encode())
    assert {(a, order[w].decode()) for a, w in zip(at.tolist(), which.tolist())} == want and len(at) == len(want)


# --- token alignment -------------------------------------------------------------

@pytest.fixture(scope="module")
def tools():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    t.no_truncation()
    t.no_padding()
    return t, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute_groups(tools, text):
    t, sp = tools
    if not text:
        return [], [], []
    whole = (" " + text).encode()
    a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    alphabet = {c: x for x, c in enumerate(_byte_chars())}
    bytes_a = [bytes(alphabet[c] for c in t.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(sp.id_to_piece, b)]
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], [], []
    groups, i, j, x, y, at = [], 0, 0, 0, 0, (0, 0)
    while i < len(a) or j < len(b):
        if x <= y:
            x += len(bytes_a[i])
            i += 1
        else:
            y += len(bytes_b[j])
            j += 1
        if x == y:
            groups.append((a[at[0]:i], b[at[1]:j]))
            at = (i, j)
    return a, b, groups


def _byte_chars():
    from quill.llm.bpe_codec import byte_alphabet
    return byte_alphabet()


def brute_alignment(tools, docs):
    each = [(k, *brute_groups(tools, t)) for k, t in docs]
    count = Counter((g[0][-1], g[1][-1]) for *_, groups in each for g in groups)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for k, a, b, groups in each:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((k, len(a), len(b), len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), sha(text) if text else ""))
    return sorted(out, key=str)


TEXTS = [(1, "plain words, and more"), (1, "plain words, and more"), (2, None), (3, ""), (4, " "), (5, "  two  spaces\n\n\ttabs "), (6, "has ▁ inside"), (7, "<|endoftext|> <s> </s> <unk> <0x41>"),
         (8, "漢字 \U0001f642\U0001f642 ́combining  x\x00y"), (9, "a" * 5000), (10, LONG), (None, "nobody's"), (11, "zq" * 700 + "\U0001f9ff" * 300), (12, "﻿bom  nbsp"), (13, " lead")]


@pytest.mark.parametrize("hot", [1 << 20, 5, 0])
def test_alignment_on_odd_rows(spark, tools, hot):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string").withColumn("row", F.lit("r")).withColumn("links", F.lit(1)).withColumn("id", F.lit(2)).repartition(3)
    got = sorted((tuple(r) for r in token_alignment.alignment(docs, hot=hot).collect()), key=str)
    assert got == brute_alignment(tools, TEXTS)
    assert token_alignment.alignment(docs.limit(0), hot=hot).count() == 0


def test_alignment_of_the_given_table(spark, tools):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.op12_token_alignment(spark, SF_SMALL).collect()), key=str)
    assert got == brute_alignment(tools, docs)


def test_groups_hold_all_ids(spark, tools):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    got = {r.doc_id: [(list(g.a), list(g.b)) for g in r.groups] for r in token_alignment.groups(docs).collect()}
    assert got == {k: brute_groups(tools, t)[2] for k, t in TEXTS}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=120), st.lists(st.integers(1, 60), min_size=1, max_size=40))
def test_shared_cuts(a, b):
    total = max(sum(a), sum(b))
    ends = [np.array(sorted({*np.cumsum(x).tolist(), total})) for x in (a, b)]
    got = token_alignment.shared_cuts(*ends, *(np.array([v]) for v in (0, len(ends[0]), 0, len(ends[1]))))
    assert sorted(ends[0][got - 1].tolist()) == sorted((set(ends[0].tolist()) & set(ends[1].tolist())) - {total})


def test_long_stretch_without_cuts():
    a, b = np.arange(2, 200_001, 2), np.append(np.arange(1, 200_000, 2), 200_000)
    a, b = np.concatenate(([1], a[:-1], [200_000])), np.concatenate(([1], b[1:]))
    got = token_alignment.shared_cuts(a, b, *(np.array([v]) for v in (0, len(a), 0, len(b))))
    assert a[got - 1].tolist() == [1]


# --- Merkle manifest ---------------------------------------------------------------

def brute_audit(rows, arity=16):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def h(*parts):
        return sha("".join(parts))

    def climb(nodes):
        steps, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(at):
                run = nodes[p // arity * arity:(p // arity + 1) * arity]
                steps[i].append(("".join(run[:p % arity]), "".join(run[p % arity + 1:])))
                at[i] = p // arity
            nodes = [h(*nodes[i:i + arity]) for i in range(0, len(nodes), arity)]
        return nodes[0], steps

    leaf = [h(*map(field, r)) for r in rows]
    by = defaultdict(list)
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf[i])):
        by[rows[i][1]].append(i)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [climb([leaf[i] for i in by[s]]) for s in order]
    root, crown = climb([t[0] for t in trees]) if trees else (None, [])
    out = []
    for s, (subroot, steps), top in zip(order, trees, crown):
        for i, own in zip(by[s], steps):
            r = rows[i]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            at = h(*map(field, (*r[:4], lower(r[4]) if hit else r[4])))
            for left, right in own + top:
                at = h(left, at, right)
            out.append((r[0], leaf[i], subroot, root, h(*(x + y for x, y in own + top)), at, at == root))
    return sorted(out, key=str)


MERKLE = "doc_id bigint, source string, lang string, n_chars bigint, text string"
ROWS = [(None, None, None, None, None), (None, None, None, None, None), (3, None, "en", 3, "ABC"), (0, "", "en", None, ""), (1, "é", "x", 1, "Aé"), (2, "a", "x", 1, "Aé"),
        (2, "a", "x", 1, "Aé"), (2, "a", "x", 1, "B"), (4, "Z", "-", 0, LONG), *((i, "hot", "en", i, f"Text {i} É") for i in range(100, 400)), *((i, "seventeen", None, 1, "T") for i in range(17))]


@pytest.mark.parametrize("arity", [16, 2, 3])
def test_audit_on_odd_rows(spark, arity):
    df = spark.createDataFrame(ROWS, MERKLE).withColumn("node", F.lit(1)).withColumn("tree", F.lit("x")).withColumn("idx", F.lit(2.5)).repartition(5)
    got = sorted((tuple(r) for r in merkle.audit(df, arity=arity).collect()), key=str)
    assert got == brute_audit(ROWS, arity)


def test_audit_small_cases(spark):
    df = spark.createDataFrame(ROWS, MERKLE)
    assert merkle.audit(df.limit(0)).collect() == []
    for rows in (ROWS[2:3], ROWS[5:6] * 2, ROWS[-17:], ROWS[-16:]):     # one leaf, one group, 17 and 16 leaves
        assert sorted((tuple(r) for r in merkle.audit(spark.createDataFrame(rows, MERKLE)).collect()), key=str) == brute_audit(rows)
    alone = merkle.audit(df.where("doc_id = 3 and source is null")).collect()[0]
    assert alone.leaf == alone.subroot == alone.root and alone.proof_sha256 == sha("")


def test_audit_plan_has_no_cross_join(spark):
    plan = queries.op13_merkle_manifest(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = con.execute(oracles.SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF_SMALL).select(*columns)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_archives_are_read_by_a_task_each(spark, tmp_path):
    from quill.llm import warc_zip
    for i in range(9):
        (tmp_path / "m").mkdir(exist_ok=True)
    spark.range(9).selectExpr("concat('pages-', uuid(), '.zip') AS path", "1L AS records").repartition(4).write.parquet(str(tmp_path / "m" / "t"))
    plan = warc_zip.read(spark.read.parquet(str(tmp_path / "m" / "t")), str(tmp_path), "page_id", "bigint")
    assert plan.rdd.getNumPartitions() == 9


@pytest.mark.parametrize("rows", [1, 1 << 10])
def test_packing_ranks_at_any_number_of_buckets(spark, rows, monkeypatch):
    from quill.llm import packing
    monkeypatch.setattr(packing, "LEAST_ROWS", rows)
    df = spark.range(600).selectExpr("id AS doc_id", "0 AS piece", "CASE WHEN id % 3 = 0 THEN 100L ELSE id % 90 + 1 END AS length").repartition(4)
    got = packing.pack(df, 100, order=("doc_id", "piece")).collect()
    assert sorted(r.doc_id for r in got) == list(range(600))
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 100


def test_long_sets_cut_a_cluster_into_blocks(spark, monkeypatch):
    from quill.llm import ngram_join
    base = [f"w{i}" for i in range(400)]
    texts = [(i, " ".join([*base[:390], f"x{i}", *base[391:]])) for i in range(40)] + [(100, "other words entirely here now")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    want = sorted(map(tuple, ngram_join.near_duplicates(df).collect()))
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 1000)
    assert sorted(map(tuple, ngram_join.near_duplicates(df).collect())) == want
    assert {c for _, _, c in want} == {0, 100}


def test_conflicting_labels_have_a_rule(spark):
    """Rows in any order and dealing give one model."""
    from quill.llm import quality_cnn, toxicity
    docs = spark.createDataFrame([(i, ("vile scum rot " if i % 2 else "calm field day ") * 6 + f"w{i}") for i in range(80)] + [(4, "another text"), (5, "a third one")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(80)] + [(i, 1 - i % 2, 1 - i % 2) for i in range(0, 80, 7)], "doc_id bigint, toxic int, quality int")
    models = []
    for n, seed in ((1, 1), (7, 2)):
        d, y = (x.orderBy(F.xxhash64("doc_id", F.lit(seed))).repartition(n) for x in (docs, labels))
        models.append((toxicity.fit(d, y), quality_cnn.fit(d, y, steps=3)))
    (a, b), (c, d) = models
    assert a["curve"] == pytest.approx(c["curve"]) and a["lexicon"] == pytest.approx(c["lexicon"]) and a["lexicon"]
    assert all(np.array_equal(b[k], d[k]) for k in b)


def test_band_verdicts_by_brute_force(spark):
    """The verdicts of the fertility rules recomputed from the measures with exact quantiles."""
    from quill.llm import fertility
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in fertility.judged(docs).collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}

    def rates(r):
        n = max(r.n_tokens, 1)
        return {"chars_per_token": r.word_chars / n, "byte_share": r.n_byte_tokens / n, "token_entropy_rate": r.token_entropy / np.log2(max(n, 2))}
    judged = defaultdict(list)
    for k, r in rows.items():
        if r.n_words >= 10:
            judged[lang[k]].append(rates(r))

    def quartiles(values):          # of ranks, as percentile_approx gives them on few rows
        v = sorted(values)
        return [v[max(0, int(np.ceil(q * len(v))) - 1)] for q in (0.25, 0.5, 0.75)]
    q = {g: {m: quartiles([x[m] for x in v]) for m in v[0]} for g, v in judged.items()}
    more = {g: len(v) - 1 for g, v in judged.items()}
    within = {m: sum(more[g] * (q[g][m][2] - q[g][m][0]) for g in q) / max(sum(more.values()), 1) for m in fertility.BANDS}
    for k, r in rows.items():
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        ok = lang[k] in q
        for m, rule in fertility.BANDS.items():
            if not ok:
                break
            low, mid, high = q[lang[k]][m]
            n = len(judged[lang[k]])
            width = max(rule["k"] * (n * (high - low) + 20 * within[m]) / (n + 20), rule["floor"]) * np.sqrt(1 + rule["short"] / max(r.n_tokens, 1))
            x = rates(r)[m]
            ok = (rule.get("upper_only") or x >= mid - width) and (rule.get("lower_only") or x <= mid + width)
        assert (r.base_failed, r.kept) == (failed, bool(ok) and not failed), k


def test_network_output_by_loops():
    """The convolution, pooling and output of one text, position by position."""
    from quill.llm import quality_cnn as q
    rng = np.random.default_rng(1)
    w = {"emb": rng.normal(0, 0.5, (q.PAD + 1, q.DIM)).astype(np.float32), "filt": rng.normal(0, 0.3, (q.STEP * q.DIM, 2 * q.FILTERS)).astype(np.float32),
         "fb": rng.normal(0, 0.2, q.FILTERS).astype(np.float32), "out": rng.normal(0, 0.5, 2 * (q.FILTERS + 1)).astype(np.float32), "b": np.array([0.1], np.float32)}
    text = ("A text of some length, with é and more. " * 31).encode()
    features = []
    for at in q.chunk_starts(len(text)):
        chunk = [*text[at:at + q.CHUNK]] + [q.PAD] * max(0, q.CHUNK - len(text[at:at + q.CHUNK]))
        best = np.full(q.FILTERS, -np.inf)
        for i in range(0, q.CHUNK - q.STEP, q.STEP):
            left, right = (np.concatenate([w["emb"][c] for c in chunk[j:j + q.STEP]]) for j in (i, i + q.STEP))
            best = np.maximum(best, left @ w["filt"][:, :q.FILTERS] + right @ w["filt"][:, q.FILTERS:] + w["fb"])
        seen, again, real = set(), 0, 0
        for i in range(q.CHUNK - q.WINDOW + 1):
            part = tuple(chunk[i:i + q.WINDOW])
            if q.PAD not in part:
                real += 1
                again += part in seen
                seen.add(part)
        features.append([*np.maximum(best, 0), again / max(real, 1)])
    f = np.array(features)
    z = np.concatenate([f.mean(axis=0), f.max(axis=0)]) @ w["out"] + w["b"][0]
    assert q.probabilities([text], w)[0] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)
