"""Corpus operators against brute force, round trips, held-out accuracy, and odd rows."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import compare, connect
from tidewheel.llm import chat, components, html, mixing, neardup, packing, quality, queries, tokens, topk, toxicity, urls

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, size string, kept string, score string, m int"
LONG = " ".join(f"w{i % 9000}" for i in range(60_000))
ODD = [(1, None, None, None, "a", "b", "c", 1), (2, "", "en", "s", None, None, None, None), (3, " \t\n", "xx", "s", "a", "b", "c", 1), (None, "one two", "en", "t", "a", "b", "c", 1),
       (4, "A b C d E f", "en", "t", "a", "b", "c", 1), (4, "A b C d E f", "en", "t", "a", "b", "c", 1), (5, "a B c D e F", "en", None, "a", "b", "c", 1), (6, LONG, "de", "s", "a", "b", "c", 1),
       (7, LONG + " tail", "de", "s", "a", "b", "c", 1), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    msg, _ = compare(spark, connect(SF), queries.QUERIES[name], queries.ORACLE[name], SF)
    assert msg is None, msg


# ------------------------------------------------------------------ 1 near-duplicates

def word_shingles(text, width=5):
    """Shingles as tuples of words, without any hash."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}


def brute_components(rows, percent):
    sets = [word_shingles(t) for _, t in rows]
    par = list(range(len(rows)))

    def find(i):
        while par[i] != i:
            i = par[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
                par[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, (d, _) in enumerate(rows)}


def family(n, seed=1):
    """Copies with chains of edits around the threshold, beside unrelated texts."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(n):
        w = list(base) if i % 5 else [f"x{rng.randrange(900)}" for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 4)):
            if w:
                w[rng.randrange(len(w))] = f"y{rng.randrange(90)}"
        rows.append((i + 10, " ".join(w)))
    return rows


@pytest.mark.parametrize("block", [8, 512])
def test_neardup_equals_brute_force(spark, block):
    rows = family(90)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(d, percent=85, block=block).collect()}
    assert got == brute_components(rows, 85)


def test_neardup_on_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op1_odd_sketch_neardup"](spark, SF).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components([tuple(r) for r in rows], 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_neardup_odd_rows(odd, none):
    got = neardup.near_duplicates(odd, percent=80).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[4].component_id == by[5].component_id == 4 and by[5].kept is False
    assert by[6].component_id == by[7].component_id == 6 and by[1].n_shingles == 0 and by[1].kept
    assert all(r.n_shingles == len(word_shingles(t)) for r, t in ((by[d], t) for d, t, *_ in ODD if d))
    left = neardup.drop_near_duplicates(odd.withColumns({"row": F.lit("r"), "_doc": F.lit(1)}))
    assert left.columns == [*odd.columns, "row", "_doc"] and left.where("row <> 'r'").count() == 0
    left = neardup.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 2, 3, 4, 6]
    assert neardup.near_duplicates(none).count() == 0


def test_equal_and_missing_ids_stay_apart(spark):
    """Rows without an id, or all with the same one, are told apart by their texts."""
    rng = random.Random(8)
    texts = [" ".join(f"t{rng.randrange(400)}" for _ in range(30)) for _ in range(60)]
    for key in (None, 7):
        d = spark.createDataFrame([(key, t) for t in texts + texts[:20]], "doc_id long, text string")
        got = neardup.near_duplicates(d).collect()
        assert len(got) == 80 and sum(r.first for r in got) == 60


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    common, k = rng.integers(0, 1 << 63, 900, dtype=np.uint64), 128
    for own in (20, 50, 90):
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, own, dtype=np.uint64)])) for _ in range(2))
        x, y = (np.frombuffer(neardup.odd_sketch(neardup.min_hashes(s, k)), np.uint64) for s in (a, b))
        assert abs(neardup.similarity(int(np.bitwise_count(x ^ y).sum()), k) - 900 / (900 + 2 * own)) < 0.12


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(5, 5)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


# ------------------------------------------------------------------ 2 and 6 packing

@pytest.mark.parametrize("place", [packing.sum_of_squares, packing.best_fit_decreasing])
def test_packing_is_gapless_and_tight(place):
    rng = np.random.default_rng(3)
    lengths = np.concatenate([rng.integers(1, 65, 400), [64] * 5])
    bins, offsets = place(lengths, 64)
    for b in range(bins.max() + 1):
        at = np.flatnonzero(bins == b)
        at = at[np.argsort(offsets[at])]
        assert (offsets[at] == np.concatenate([[0], np.cumsum(lengths[at])[:-1]])).all() and lengths[at].sum() <= 64
    assert bins.max() + 1 <= 1.03 * -(-lengths.sum() // 64) + 1


def test_best_fit_matches_a_plain_search():
    rng = np.random.default_rng(4)
    lengths, gaps = rng.integers(1, 40, 300), []
    for s in sorted(lengths.tolist(), reverse=True):
        fit = [i for i, g in enumerate(gaps) if g >= s]
        if fit:
            i = min(fit, key=lambda i: gaps[i])
            gaps[i] -= s
        else:
            gaps.append(40 - s)
    assert packing.best_fit_decreasing(lengths, 40)[0].max() + 1 == len(gaps)


def test_packed_pieces_hold_the_ids(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.default_vocabulary())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: tok.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    got, seen = queries.QUERIES["op2_sum_of_squares_packing"](spark, SF).collect(), {}
    for r in got:
        part = want[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes()) and len(part) == r.length and r.start == 2048 * r.piece
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    assert seen == {k: len(v) for k, v in want.items()}
    places = sorted((r.sequence_id, r.offset, r.length) for r in got)
    for a, b in zip(places, places[1:]):
        assert b[1] == (a[1] + a[2] if a[0] == b[0] else 0) and b[1] + b[2] <= 2048


@pytest.mark.parametrize("narrow", [False, True])
def test_matrix_round_trip(spark, odd, tmp_path, narrow):
    vocab = tokens.default_vocabulary()
    assert tokens.narrow_ids(vocab)
    alone, shared = packing.pack_parts(odd, vocab, place=packing.best_fit_decreasing, size=256, narrow=narrow)
    assert alone.where("length <> 256 OR offset <> 0").count() == 0 and alone.count() > 100
    packing.write_matrix(packing.id_matrix(shared, 256, narrow=narrow, alone=alone), str(tmp_path / "m"))
    back, n = {}, 0
    for r in spark.read.parquet(str(tmp_path / "m")).collect():
        ids = np.frombuffer(r.input_ids, "<u4")
        assert len(ids) == len(r.position_ids) == 256 and r.cu_seqlens[-1] == r.n_tokens and not ids[r.n_tokens:].any()
        for doc, piece, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:]):
            assert r.position_ids[a:b] == list(range(b - a))
            back.setdefault((doc, piece), []).append(ids[a:b].tolist())
            n += b - a
    enc = tokens.Encoder(vocab)
    sizes = sorted(len(enc.encode([t or ""])[0]) // 4 + 1 for _, t, *_ in ODD)
    assert n == sum(sizes)
    whole = sum((back[6, p][0] for p in range(sum(d == 6 for d, _ in back))), [])
    assert np.array(whole[:-1], "<u4").tobytes() == enc.encode([LONG])[0] and len(back[4, 0]) == 2


def test_encoder_equals_whole_text_encoding():
    vocab = tokens.default_vocabulary()
    texts = ["Don't stop, it's 3.14!! <|endoftext|> ÉÀ naïve… a\u00a0b ''t x.y, z), 中文 e\u0301. İ", "", "   ", "THE,!! | $$$ 'RE we're"]
    assert tokens.Encoder(vocab).encode(texts) == tokens.Encoder(vocab, by_chunk=False).encode(texts)


def test_packing_empty_table(none):
    assert packing.pack_documents(none, tokens.default_vocabulary()).count() == 0


# ------------------------------------------------------------------ 3 toxicity

def test_machine_learns_a_pair(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1500):
        w = [f"n{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(12)] + [x for x in ("insult", "grouping") if rng.random() < 0.5]
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int("insult" in w and "grouping" in w)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    m = toxicity.train(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score(d, m).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    right = [(r.score >= 0.5) == bool(labels[r.doc_id][1]) for r in got if r.held]
    assert {r.doc_id for r in got if r.held} == {i for i in range(1500) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(right) / len(right) > 0.98


def test_machine_learns_what_only_a_pair_shows(spark):
    """Exactly one of two words: neither depends on the label alone."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(3000):
        w = [f"n{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(12)] + [x for x in ("harbour", "violet") if rng.random() < 0.5]
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(("harbour" in w) != ("violet" in w))))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    m = toxicity.train(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert 0 < len(m.slots) < 60
    got = [r for r in toxicity.score(d, m).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect() if r.held]
    assert sum((r.score >= 0.5) == bool(labels[r.doc_id][1]) for r in got) > 0.95 * len(got)


def test_score_is_the_brute_force_sum():
    rng = np.random.default_rng(1)
    m = toxicity.Machine(np.arange(6), rng.normal(size=6), rng.normal(size=(6, 3)), -0.4)
    x = [0, 2, 5]
    z = -0.4 + m.w[x].sum() + sum(float(m.v[i] @ m.v[j]) for a, i in enumerate(x) for j in x[:a])
    assert abs(m.score({0, 2, 5, 99}) - 1 / (1 + np.exp(-z))) < 1e-12


def test_toxicity_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op3_toxicity_machine"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    bad, good = [r.score for r in got if r.toxic], [r.score for r in got if not r.toxic]
    assert sum((a > b) + 0.5 * (a == b) for a in bad for b in good) / (len(bad) * len(good)) > 0.85
    assert sum(r.predicted for r in got if not r.toxic) == 0


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (None, 1), (4, None), (6, 0), (6, 1), (7, 0), (2, 0)], "doc_id long, toxic int")
    m = toxicity.train(odd, labels)
    got = toxicity.score(odd, m, "_s").collect()
    assert len(got) == len(ODD) and all(0 <= r._s <= 1 for r in got) and got[0].score == "c"
    assert toxicity.score(none, toxicity.train(none, labels.limit(0))).count() == 0


# ------------------------------------------------------------------ 4 top-k

def brute_top(rows, k):
    out = []
    ok = {i: [int(np.floor(1024 * float(x))) for x in v] for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    for q in sorted(ok):
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))[:k]
            out += [(q, n + 1, i, max(-(1 << 63), min((1 << 63) - 1, -s))) for n, (s, i) in enumerate(best)]
    return out


@pytest.mark.parametrize("spread", [1.0, 1e-3, 1e6, 1e9])
def test_top_k_equals_brute_force(spark, spread):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=6) * spread).astype("float32").tolist()) for i in range(420)]
    rows[5:30] = [(i, rows[3][1]) for i in range(5, 30)]
    rows += [(500, None), (600, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (601, [float("nan")] * 6), (602, [float("inf")] * 6), (700, [1.0, 2.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(d, k=7, vectors=100, queries=2).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == brute_top(rows, 7)


def test_top_k_small_and_empty(spark):
    d = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(d).collect()] == [(0, 1, 1, 5 << 20)]
    assert topk.top_k(d.limit(0)).count() == 0


# ------------------------------------------------------------------ 5 urls

def test_url_rules_and_parts(spark):
    us = ["https://A.example.org/es/1", "http://example.org/en/12", "http://example.org/en/2", "x://b.com/fr/a?b", "x://b.com/de/", "http://com/fr/", "http://notcom/fr/", "http://org", "http://é.org?x", None, "", "nope", "http://q.net/a#b"]
    d = spark.createDataFrame(list(enumerate(us)), "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(d).collect()}
    assert [got[i].rule for i in range(len(us))] == ["example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", "com/fr/", None, None, None, None, None, None, None]
    assert got[0].host == "a.example.org" and got[0].path == "/es/1" and got[8].host == "é.org" and got[9].host == got[11].path == ""
    assert all(r.verdict in ("allow", "block") for r in got.values()) and got[0].verdict == got[4].verdict == "block" and got[2].verdict == got[3].verdict == "allow"
    assert urls.judge(d.limit(0)).count() == 0


def test_url_trees_learn_the_labels(spark):
    rng = random.Random(0)
    rows = []
    for i in range(400):
        bad = rng.random() < 0.5
        tail = "".join(rng.choice("0123456789abcdef") for _ in range(30)) if bad else "/".join(rng.choice(["news", "sport", "home"]) for _ in range(3))
        rows.append((i, f"http://{'bad' if bad else 'good'}.{'x' if i % 4 else 'y'}/{tail}"))
    d = spark.createDataFrame(rows, "page_id long, url string")
    got = urls.judge(d, rules=[("block", "bad.x/"), ("allow", "good.x/")]).where("rule IS NULL").collect()
    assert len(got) == 100 and sum((r.verdict == "block") == r.host.startswith("bad") for r in got) > 95


def test_url_entropy(spark):
    got = spark.createDataFrame([("aabb",), ("abcd",), ("aaaa",)], "u string").select(urls.entropy(F.col("u"))).collect()
    assert [round(r[0], 9) for r in got] == [1.0, 2.0, 0.0]


# ------------------------------------------------------------------ 7 chat

def test_chat_collapse(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "v", "b"), (2, 0, "u", "a"), (3, 0, "u", "a"), (3, 1, "v", "b"), (3, 2, "u", "c"), (4, 0, "u", "a"), (4, 1, "v", "b"), (4, 2, "u", "c"),
            (5, 3, "u", "z"), (5, 3, "u", "z"), (6, 0, None, None), (6, None, "u", ""), (None, 0, "u", "q")]
    got = {r.conv_id: r for r in chat.collapse_and_render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(got) == {3, 5, 6, None}
    assert got[3].text == "<|u|>\na<|end|>\n<|v|>\nb<|end|>\n<|u|>\nc<|end|>\n" and got[5].n_turns == 1 and got[6].text == "<|u|>\n<|end|>\n<|unknown|>\n<|end|>\n"


def test_chat_parts_and_chunks(spark):
    rows = [(1, i, "u", f"t{i}") for i in range(40)] + [(2, i, "u", f"t{i}") for i in range(17)] + [(3, i, "u", f"t{i + (i == 16)}") for i in range(17)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ks = chat.numbered(d, chunk=8).where("conv_id = 1").orderBy("turn").collect()
    assert [r.k for r in ks] == list(range(1, 41))
    assert {r.conv_id for r in chat.maximal(chat.numbered(d, chunk=8)).collect()} == {1, 3}
    parts = chat.collapse_and_render(d, part=10).where("conv_id = 1").orderBy("part").collect()
    assert [r.part for r in parts] == [0, 1, 2, 3] and "".join(r.text for r in parts).count("<|end|>") == 40
    assert chat.collapse_and_render(d.limit(0)).count() == 0


# ------------------------------------------------------------------ 8 quality

def brute_repeats(w):
    seen, cover = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            cover.update(x for i in at for x in (i, i + 1, i + 2))
    return len(cover)


def test_repeated_words(spark):
    rng = random.Random(9)
    rows = [([rng.choice("abcd") for _ in range(rng.randrange(0, 60))],) for _ in range(60)] + [(["a"] * 7,), ([],), (["a", "b", "c"],)]
    got = spark.createDataFrame(rows, "w array<string>").select("w", quality.repeated_words(F.col("w")).alias("n")).collect()
    assert all(r.n == brute_repeats(r.w) for r in got)


def test_quality_odd_rows(odd, none):
    got = quality.judge(odd.select("doc_id", "text", "lang", "size")).collect()
    assert len(got) == len(ODD) and all(r.kept is False for r in got if (r.n_words or 0) < 50)
    assert quality.judge(none).count() == 0


def test_quality_keeps_clean_and_drops_junk(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op8_quality_divergence"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("NOT base_failed").collect()
    clean, junk = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert sum(clean) == len(clean) and sum(junk) < 0.6 * len(junk)


# ------------------------------------------------------------------ 9 html

def test_blocks_of_a_page():
    page = """<html><head><title>T</title><style>p{}</style></head><body><nav><a>menu</a></nav><header>site</header><div id="cookie-notice">c</div>
    <article class="post"><header><h1>Head &amp; line</h1></header><p>One<br>two&nbsp;<b>three</b> <script>var t="</p>";</script>four<p>Five</p><aside>x</aside><form>f</form>
    <div class="comments"><p>no</p></div><!-- <p>gone</p> --><ul><li>six</li></ul></article><footer>f</footer></body>"""
    assert html.blocks(page) == (["Head & line", "One two three four", "Five", "six"], True)
    assert html.blocks(None) == ([], False) and html.blocks("a < b <p>c") == (["a < b", "c"], False)


def test_common_lines_are_a_longest_subsequence():
    rng = random.Random(5)

    def longest(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(0, 12))] for _ in range(2))
        got = sorted(html.common_lines(a, b))
        assert len(got) == longest(a, b)
        it = iter(b)
        assert all(a[i] in it for i in got)


def test_shared_lines_go(spark):
    rows = [(i, f"http://h.x/a/{i:02d}", f"<div>Home</div><p>Story {i} tells.</p><p>More {i}.</p><p>And {i} ends.</p><div>All rights</div>") for i in range(12)]
    rows += [(20, "http://o.x/1", "<article><p>Same.</p><p>Copy.</p></article>"), (21, "http://o.x/2", "<article><p>Same.</p><p>Copy.</p></article>"), (22, None, None), (23, "", "")]
    for chunk in (4, 512):
        got = {r.page_id: r for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), chunk=chunk).collect()}
        assert all(got[i].text == f"Story {i} tells.\n\nMore {i}.\n\nAnd {i} ends." for i in range(12))
        assert got[20].text == got[21].text == "Same.\n\nCopy." and got[22].text == "" and got[23].n_chars == 0 and len(got) == len(rows)
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ------------------------------------------------------------------ 10 mixing

def test_targets_equal_iterated_resharing(spark):
    rng = random.Random(3)
    for trial in range(4):
        sizes = {f"s{i:02d}": rng.choice([0, 5, 60, 900, 7000]) for i in range(9)} | {None: 40}
        got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        names = sorted(k for k in sizes if k) + [None]
        w = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}
        want, open_, left = {}, set(names), sum(sizes.values())
        while open_:
            level = left / sum(w[k] for k in open_)
            over = {k for k in open_ if level * w[k] > 3 * sizes[k]}
            if not over:
                want.update((k, level * w[k]) for k in open_)
                break
            want.update((k, 3 * sizes[k]) for k in over)
            left -= sum(3 * sizes[k] for k in over)
            open_ -= over
        assert all(abs(got[k] - want[k]) <= 1e-6 * max(1, want[k]) for k in names)


def test_mix_odd_rows(odd, none):
    got = mixing.mix(odd)
    assert got.columns == odd.columns and set(r.size for r in got.collect()) <= {"a", None}
    plan = mixing.mix_plan(odd.drop("size")).collect()
    assert len(plan) == len(ODD) and all(0 <= r.copies <= 3 for r in plan) and len({r.copies for r in plan if r.doc_id == 4}) == 1
    assert mixing.mix(none).count() == 0


def test_near_duplicate_filter_moves_candidates_only(spark):
    """A row whose key is wanted always passes, most others do not, and the kept documents are found without moving any."""
    rows = spark.range(20000).select(F.xxhash64("id").alias("key"), F.col("id").cast("string").alias("text"))
    keys = rows.where("text % 100 = 0").select("key")
    keys = keys.union(spark.createDataFrame([(0,), (-1,), (2 ** 63 - 1,), (-2 ** 63,)], "key long"))
    rows = rows.union(spark.createDataFrame([(0, "a"), (-1, "b"), (2 ** 63 - 1, "c"), (-2 ** 63, "d"), (None, "e")], "key long, text string"))
    got = {r.text for r in neardup.may_match(rows, "key", keys, 204).collect()}
    assert {"a", "b", "c", "d"} | {str(i) for i in range(0, 20000, 100)} <= got and len(got) < 1000 and "e" not in got
    # A full bitmap lets rows pass but loses none.
    assert neardup.may_match(rows, "key", rows.where("key IS NOT NULL").select("key"), 20004, most=1 << 10).count() == 20004


def test_kept_documents_are_not_shuffled(spark):
    same = "one two three four five six seven eight nine ten "
    docs = spark.createDataFrame([(i, same * 3 if i % 10 == 0 else f"{same}{i} {i + 1} {i + 2} other words {i * 7} end {i * 3}" * (i % 4 + 1), f"s{i}") for i in range(3000)], "doc_id long, text string, source string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # Less than the ids of all documents that stay, more than the few that go.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "6k")
    try:
        out = neardup.drop_near_duplicates(docs)
        ids = sorted(r.doc_id for r in out.collect())
        assert ids[:2] == [0, 1] and not any(i % 10 == 0 for i in ids[1:])
        assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
