"""The operators' kernels against independent brute-force versions, without Spark."""

import io
import random
import re
import zipfile

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quill.llm import embedding_dedup, fertility, html_wrapper, ngram_join, packing, ppm, quality_cnn, toxicity, warc_zip
from quill.llm.bpe_codec import codec, library_codec
from quill.llm.words import shingle_set, word_hashes

TEXTS = st.text(alphabet=st.sampled_from(list("abcTH'st 12!#.\n\t\r\x1c\x85 　é漢\U0001f642")) | st.characters(exclude_categories=["Cs"]), max_size=60)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_bpe_ids_equal_the_library(text):
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not hasattr(test_bpe_ids_equal_the_library, "tk") else test_bpe_ids_equal_the_library.tk
    test_bpe_ids_equal_the_library.tk = tk
    want = tk.encode(text, add_special_tokens=False).ids
    got = np.frombuffer(codec().encode(text), "<u4")
    assert got.tolist() == want
    assert np.frombuffer(library_codec().encode(text), "<u4").tolist() == want
    assert codec().decode(got) == tk.decode(want, skip_special_tokens=False)


def test_bpe_edges(library):
    for text in ["", " ", "<|endoftext|>", "a<|endoftext|>  b <|endoftext|>", "a" * 5000, "ab " * 3000, "x  \n  y", "don't we'll 's", " " * 40, "\n\n \n x"]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(codec().encode(text), "<u4").tolist() == want
        assert np.frombuffer(library_codec().encode(text), "<u4").tolist() == want


def py_words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_word_hashes_follow_words(text):
    words = py_words(text)
    h = word_hashes(text.encode())
    assert len(h) == len(words)
    assert [h.tolist().index(x) for x in h.tolist()] == [words.index(w) for w in words]


def test_word_hashes_do_not_depend_on_blocks():
    text = ("The cat  sat\n" * 400).encode()
    assert (word_hashes(text) == word_hashes(text, block=64)).all()


def py_shingles(text):
    w = py_words(text)
    return set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_tree_links_against_all_pairs():
    rng = random.Random(3)
    base = [[rng.choice("abcdefgh") + str(rng.randint(0, 30)) for _ in range(60)] for _ in range(4)]
    texts = []
    for _ in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
            w[rng.randrange(len(w))] = "z" + str(rng.randint(0, 9))
        texts.append(" ".join(w[:rng.randint(45, 60)]))
    sets = [shingle_set(t.encode()) for t in texts]
    true = [py_shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in true]

    def groups(links):
        p = list(range(len(texts)))

        def find(x):
            while p[x] != x:
                x = p[x]
            return x
        for a, b in links:
            p[find(a)] = find(b)
        return {frozenset(j for j in range(len(texts)) if find(j) == find(i)) for i in range(len(texts))}
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(true[i] & true[j]) >= 75 * len(true[i] | true[j])]
    got = ngram_join.tree_links(sets)
    assert set(map(frozenset, got)) <= set(map(frozenset, pairs))
    assert groups(got) == groups(pairs)
    side = [i % 2 for i in range(len(texts))]
    assert groups(ngram_join.tree_links(sets, 75, side)) == groups([(i, j) for i, j in pairs if side[i] != side[j]])


def test_packing_plan_uses_each_piece_once_and_is_tight():
    rng = np.random.default_rng(5)
    for n in (1, 7, 300, 20_000):
        counts = np.bincount(rng.integers(1, 257, n), minlength=257)
        layout = packing.plan(counts, 256)
        used = np.zeros(257, int)
        for combo, times in layout:
            assert sum(combo) <= 256 and times > 0
            for x in combo:
                used[x] += times
        assert (used == counts).all()
        if n >= 300:
            least = -(-int((counts * np.arange(257)).sum()) // 256)
            assert sum(t for _, t in layout) <= 1.1 * least + 2


def test_packing_finds_a_triple_with_a_single_third_piece():
    counts = np.zeros(101, np.int64)
    counts[[50, 27, 10]] = 1
    counts[20] = 2
    assert ((50, 20, 20, 10), 1) in packing.plan(counts, 100)


def test_packing_finds_exact_triples():
    counts = np.zeros(101, int)
    counts[[52, 20, 16, 12]] = 10
    assert sum(t for _, t in packing.plan(counts, 100)) == 10


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(1, 5)), max_size=40))
def test_segments_are_the_maximal_ones(items):
    """Against the definition: all proper sub-segments score less, no super-segment does."""
    drift = 1.3
    hits = [(i, float(w)) for i, (hit, w) in enumerate(items) if hit]
    score = [float(w) if hit else -drift for hit, w in items]

    def best_parts(lo, hi):
        spans = [(sum(score[i:j]), -(j - i), i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)]
        good = [s for s in spans if s[0] > 1e-9]
        if not good:
            return []
        top = max(g[0] for g in good)
        s = min((g for g in good if abs(g[0] - top) < 1e-9), key=lambda g: (g[2], -g[1]))
        return best_parts(lo, s[2]) + [(s[2], s[3])] + best_parts(s[3], hi)
    got = [(s, e) for s, e, _ in toxicity.segments(hits, drift)]
    want = best_parts(0, len(items))
    assert sum(e - s for s, e in got) == sum(e - s for s, e in want) or got == want
    for s, e, v in toxicity.segments(hits, drift):
        assert abs(v - sum(score[s:e])) < 1e-9 and v > 0


def test_ppm_probabilities_sum_to_one_and_prefer_seen_text():
    texts = [ppm.events(b"the cat sat on the mat"), ppm.events(b"the dog sat on the log"), ppm.events(b"")]
    code, n = np.unique(ppm.runs(texts, 3)[0], return_counts=True)
    trie = ppm.Trie(code, n, 3)
    rng = random.Random(1)
    for context in ["the", " on", "zzz", " th", "t o", *("".join(rng.choice("athe ") for _ in range(3)) for _ in range(20))]:
        runs = 0
        for c in context:
            runs = runs << ppm.SHIFT | ord(c)
        every = (runs << ppm.SHIFT) | np.arange(ppm.SYMBOLS)
        assert abs((10 ** trie.log10(every)).sum() - 1) < 1e-9
    assert trie.score([ppm.events(b"the cat")])[0] > trie.score([ppm.events(b"qzx vkj")])[0]
    empty = ppm.Trie(np.empty(0, np.int64), np.empty(0, np.int64), 3)
    assert abs(empty.score([b""])[0] + np.log10(ppm.SYMBOLS)) < 1e-9


def test_cnn_learns_and_covers_whole_texts():
    rng = np.random.default_rng(0)
    good = [(" ".join("".join(rng.choice(list("abcdefghijkl"), 6)) for _ in range(60))).encode() for _ in range(60)]
    junk = [t.replace(b" ", b"### ") for t in good[:30]]
    data = [(t, 1) for t in good[30:]] + [(t, 0) for t in junk]

    def chunks(t):
        return quality_cnn.chunks_of(t, quality_cnn.chunk_starts(len(t))).tobytes()
    w = quality_cnn.train([(chunks(t), y) for t, y in data], steps=120)
    assert (quality_cnn.probabilities([t for t, _ in data], w).round() == [y for _, y in data]).mean() > 0.95
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        at = quality_cnn.chunk_starts(n)
        assert at[-1] + quality_cnn.CHUNK >= n and (len(at) == 1 or at[-2] + quality_cnn.CHUNK < n)
    long = good[0] * 40 + junk[0] * 3
    assert abs(quality_cnn.probabilities([long], w, slab=7)[0] - quality_cnn.probabilities([long], w)[0]) < 1e-6
    assert quality_cnn.train([], steps=1)["b"][0] == 0


def test_rotation_codes_lose_no_link():
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(30, 32))
    x = np.repeat(centers, 10, axis=0) + rng.normal(size=(300, 32)) * rng.uniform(0.1, 0.5, (300, 1))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {(i, j) for a, b in embedding_dedup.matches(x, x, 0.93, slab=64) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    want = {(i, j) for i in range(300) for j in range(300) if x[i] @ x[j] >= 0.93}
    assert len(want) > 600 and got == want
    label = embedding_dedup.join(np.arange(6), np.array([0, 2, 4]), np.array([1, 1, 5]))
    assert label.tolist() == [0, 0, 0, 3, 4, 4]


def test_zip_reader_reads_zip64_and_rejects_compressed(tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as z:
        with z.open(zipfile.ZipInfo("a"), "w", force_zip64=True) as f:
            f.write(b"hello" * 100)
        z.writestr("b", b"")
        z.writestr("c", b"squeezed" * 50, zipfile.ZIP_DEFLATED)
    data = bytearray(buffer.getvalue())

    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())
    r = warc_zip.ZipReader(File(bytes(data)))
    assert r.read("a") == b"hello" * 100 and r.read("b") == b""
    with pytest.raises(ValueError):
        r.read("c")
    # the same directory behind a ZIP64 end record and locator
    import struct
    end = data.rfind(b"PK\x05\x06")
    n, length, start = struct.unpack("<HII", data[end + 10:end + 20])
    big = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, length, start)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, end, 1)
    tail = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    assert warc_zip.ZipReader(File(bytes(data[:end]) + big + locator + tail)).read("a") == b"hello" * 100
    with pytest.raises(ValueError):
        warc_zip.ZipReader(File(b"nothing"))


def test_wrapper_forms_and_main_text():
    def page(i, extra="", n=3):
        rows = "".join(f"<div class='row'><p>Paragraph {i} {k} with &amp; many words of its own.</p></div>" for k in range(n))
        return (f"<html><body><div class=top>Welcome to Site</div><ul class='menu'><li><a href=/>Home</a><li><a href=/x>About</a></ul>"
                f"<div id=c><h2>Title {i}</h2>{extra}{rows}</div><div class='sidebar'>Side {i}</div><div class=foot>All rights reserved</div></body></html>")
    pages = [page(1), page(2, "<h3>Sub 2</h3>"), page(3, n=6), page(4)]
    w = None
    for p in pages:
        s = html_wrapper.skeleton(html_wrapper.parse(p))
        w = s if w is None else html_wrapper.align(w, s)
    text = html_wrapper.expression(w)
    assert "<div.row>" in text and ")+" in text and "(<h3>" in text and ")?" in text and "#slot" in text
    rule = html_wrapper.decide(w, 3)
    got = html_wrapper.main_text(pages[1], rule)
    assert got.startswith("Title 2\n\nSub 2\n\nParagraph 2 0 with & many words") and "Side" not in got and "Welcome" not in got and "Home" not in got and "rights" not in got
    assert got.count("\n\n") == 4
    article = "<nav>menu</nav><article><h1>A  b</h1><p>x &lt;p&gt;<br>y<p><b>z<aside>no</aside><form>no</form><div class=comments>no</div></article><footer>f</footer>"
    assert html_wrapper.main_text(article) == "A b\n\nx <p> y\n\nz"
    for odd in ["", "plain words", "<p>", "<", "<div" * 50, "<div>" * 5000 + "deep" + "</div>" * 5000, "<script>var a='<p>no</p>';</script>", "<!-- open"]:
        html_wrapper.main_text(odd)
    assert html_wrapper.main_text("<main>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>on</main>") == "deep\n\non"


def host_rule(pages):
    w = None
    for p in pages:
        new = (html_wrapper.skeleton(html_wrapper.parse(p)), [html_wrapper._hash(p)])
        w = new if w is None else html_wrapper._merge(w, new)
    return html_wrapper.decide(w[0], len(w[1]))


def test_wrapper_drops_template_text_of_marked_pages():
    pages = [f"<body><div>Site</div><article><h1>Title {i}</h1><div class=box>Read it in our app</div><p>{'text of it ' * 20}{i}</article>"
             f"<section><article>Other {i}</article></section>" for i in range(4)]
    rule = host_rule(pages)
    assert html_wrapper.main_text(pages[1], rule) == "Title 1\n\n" + "text of it " * 20 + "1"
    role = [p.replace("<article>", "<div role=main>", 1).replace("</article>", "</div>", 1) for p in pages]
    assert html_wrapper.main_text(role[1], host_rule(role)) == "Title 1\n\n" + "text of it " * 20 + "1"


def test_wrapper_aligns_pages_however_large():
    def page(i, rows):
        table = "".join(f"<tr class=r{i}x{k}><td>=</td></tr>" for k in range(rows))
        return f"<body><div>Site name</div><div class=box><b>own {i}</b><p>{'some words ' * 2000}{i}</p><table>{table}</table></div><p>end</p></body>"
    pages = [page(0, 3000), page(1, 2), page(2, 2500), page(3, 1)]
    for order in (pages, pages[::-1], pages[1:] + pages[:1]):
        rule = host_rule(order)
        for i, p in enumerate(pages):
            got = html_wrapper.main_text(p, rule)
            assert f"own {i}" in got and f"some words {i}" in got and "Site name" not in got
            assert got.count("=") == p.count("<td>")
    w = html_wrapper.skeleton(html_wrapper.parse("".join(f"<x{i}><y{i}>" for i in range(3000))))
    for p in pages:
        w = html_wrapper._merge((w, []), (html_wrapper.skeleton(html_wrapper.parse(p)), []))[0]
        assert html_wrapper.size(w) <= html_wrapper.MAX_ITEMS


def test_fertility_counts_by_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        t = "".join(rng.choice(["a", "b", "é", " ", " ", "\n", "a b c d e ", "#", "|x "]) for _ in range(rng.randint(0, 60)))
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        seen, marked = {}, set()
        for i in range(len(words) - 4):
            seen.setdefault(tuple(words[i:i + 5]), []).append(i)
        for at in seen.values():
            if len(at) > 1:
                marked |= {k for i in at for k in range(i, i + 5)}
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(marked))
        assert fertility.base_counts(t.encode())[:5] == want


@pytest.mark.parametrize("name,out", [("related-work", False), ("social-history", False), ("ad-hoc", False), ("comment-on-method", False), ("cookie-banner", True),
                                      ("site-footer", True), ("navMain", True), ("ad", True), ("ad-slot-3", True), ("article-comments", True), ("share_buttons", True)])
def test_names_of_furniture(name, out):
    assert bool(html_wrapper.furniture(f"x {name}")) is out
    page = f"<article><h1>T</h1><p>one</p><div class='{name}'><p>two</p></div></article>"
    assert html_wrapper.main_text(page) == ("T\n\none" if out else "T\n\none\n\ntwo")


def test_deep_furniture():
    deep = "<div>" * 200
    page = f"<article><p>start</p>{deep}<p>in</p><nav>MENU <b>x</b><nav>more</nav></nav><span>text</span><div class=ad>AD</div> end{'</div>' * 200}<p>after</p></article>"
    got = html_wrapper.main_text(page)
    assert "MENU" not in got and "more" not in got and "AD" not in got
    assert got.startswith("start") and "text" in got and "end" in got and got.endswith("after")
