"""Best-fit windows, periodic runs and fill-in-the-middle against plain versions, and odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.llm import bestfit, fim, queries, runs, tokens
from test_corpus_operators import DOCS, LONG, ODD

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# ------------------------------------------------------------------ 11 best-fit windows

def check_places(rows, size):
    """Sequences are gapless from 0 and hold ``size`` ids or a power of two."""
    load = collections.Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == load[r.sequence_id] and r.length > 0
        load[r.sequence_id] += r.length
    assert all(n == size or (n < size and n & (n - 1) == 0) for n in load.values())
    return load


def test_gaps_find_the_tightest():
    rng, open_ = random.Random(3), set()
    tree = bestfit.Gaps(5000)
    for _ in range(4000):
        g = rng.randrange(1, 5001)
        (tree.close if g in open_ else tree.open)(g)
        open_ ^= {g}
        need = rng.randrange(1, 5001)
        assert tree.tightest(need) == min((x for x in open_ if x >= need), default=-1)


@pytest.mark.parametrize("size", [40, 64])
def test_best_fit_places_like_a_plain_search(size):
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, size, 300)
    window, offset = bestfit.best_fit(lengths, size)
    gaps: list[int] = []
    for s in sorted(lengths.tolist(), reverse=True):
        fit = [i for i, g in enumerate(gaps) if g >= s]
        if fit:
            gaps[min(fit, key=lambda i: gaps[i])] -= s
        else:
            gaps.append(size - s)
    assert sorted(size - np.bincount(window, weights=lengths).astype(int)) == sorted(gaps)
    assert (offset + lengths <= size).all()


@pytest.mark.parametrize("lengths", [[], [64], [5], [33] * 50, [1] * 200, [63] * 9, [40, 40, 40], list(range(1, 64))])
def test_top_up_leaves_nothing_to_pad(lengths):
    lengths = np.array(lengths, np.int64)
    got = bestfit.top_up(lengths, *bestfit.best_fit(lengths, 64), 64)
    load, ends = collections.Counter(), collections.defaultdict(list)
    for item, start, n, w, at in sorted(got, key=lambda x: (x[3], x[4])):
        assert load[w] == at
        load[w] += n
        ends[item].append((start, n))
    assert all(n == 64 or n & (n - 1) == 0 for n in load.values())
    for item, parts in ends.items():
        parts.sort()
        assert [s for s, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) == lengths[item]
    assert len(ends) == len(lengths) and len(got) <= len(lengths) + len(load)


def test_window_pieces_hold_the_ids(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.default_vocabulary())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: tok.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs.collect()}
    got, seen = queries.QUERIES["op11_best_fit_windows"](spark, SF).collect(), collections.defaultdict(list)
    for r in got:
        part = want[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes()) and r.doc_tokens == len(want[r.doc_id])
        seen[r.doc_id] += range(r.start, r.start + r.length)
    assert all(sorted(v) == list(range(len(want[k]))) for k, v in seen.items()) and seen.keys() == want.keys()
    load = check_places(got, 2048)
    total = sum(map(len, want.values()))
    assert len(load) <= total // 2048 + 12


def test_windows_odd_rows(odd, none):
    vocab, enc = tokens.default_vocabulary(), tokens.Encoder(tokens.default_vocabulary())
    got = bestfit.pack(odd, vocab, size=256, shard=3).collect()
    check_places(got, 256)
    back = collections.defaultdict(dict)
    for r in got:
        back[r.doc_id].setdefault(r.start, []).append(r.ids)
    for d, text in ((1, None), (2, ""), (6, LONG), (5, "a B c D e F")):
        assert b"".join(bytes(x) for _, (x,) in sorted(back[d].items())) == enc.encode([text or ""])[0] + b"\1\0\0\0"
    assert sum(r.length for r in got if r.doc_id == 4) == 2 * (len(enc.encode(["A b C d E f"])[0]) // 4 + 1)
    assert sum(r.length for r in got if r.doc_id is None) == 1 + len(enc.encode(["one two"])[0]) // 4 + 1
    assert bestfit.pack(none, vocab).count() == 0


# ------------------------------------------------------------------ 12 periodic runs

def brute_runs(s, least, times):
    out = set()
    for p in range(1, len(s)):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            n = j + p - i
            if j > i and n >= max(least, times * p) and not any(s[i:i + n - q] == s[i + q:i + n] for q in range(1, p)):
                out.add((i, n, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(600):
        s = [rng.randrange(rng.choice([1, 2, 3])) + 1 for _ in range(rng.randrange(0, 50))]
        if rng.random() < 0.5 and s:
            s = (s[:rng.randrange(1, len(s) + 1)] * 9)[:70] + s[:5]
        for least, times in ((1, 2), (6, 3), (24, 3), (10, 4)):
            want = brute_runs(s, least, times)
            assert sorted(runs.all_runs(s, least, times), key=lambda r: (r[0], r[2])) == want
            assert runs.runs_of([b"%d" % x for x in s], least, times) == want


def test_extensions_equal_a_plain_search():
    rng = random.Random(2)
    s = [rng.randrange(2) + 1 for _ in range(300)] + [1] * 60
    tree = runs.SuffixTree(s)
    i, j = (np.array(x) for x in zip(*[(a, b) for a in range(0, 360, 7) for b in range(361) if a != b]))

    def plain(a, b):
        n = 0
        while max(a, b) + n < len(s) and s[a + n] == s[b + n]:
            n += 1
        return n
    assert tree.lce(i, j).tolist() == [plain(a, b) for a, b in zip(i.tolist(), j.tolist())]
    assert tree.order.tolist() == sorted(range(361), key=lambda a: s[a:]) and tree.flipped.tolist() == sorted(range(361), key=lambda a: [-x for x in s[a:]])


def planted(doc, text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    h, n = zlib.crc32(str(doc).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
    return w


def test_run_query_equals_brute_force(spark):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    docs = {r.doc_id: planted(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    small = {k: w for k, w in docs.items() if len(w) <= 600}
    got = {r.doc_id: r for r in queries.QUERIES["op12_suffix_tree_runs"](spark, SF).collect()}
    assert got.keys() == docs.keys() and len(small) > 100
    for k, w in small.items():
        want = brute_runs(w, 24, 3)
        out = {i for s, n, p in want for i in range(s + p, s + n)}
        r = got[k]
        assert r.n_runs == len(want) and r.runs_sha256 == sha("".join(f"{s},{n},{p}\n" for s, n, p in want))
        assert r.collapsed_sha256 == sha(" ".join(x for i, x in enumerate(w) if i not in out))
        top = min(want, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (r.start, r.length, r.period) == (top or (None, None, None)) and r.exponent_milli == (1000 * top[1] // top[2] if top else None)
    assert sum(r.n_runs > 0 for r in got.values()) > 5


def test_runs_odd_rows(spark, odd, none):
    got = {r.doc.doc_id: r for r in runs.detect_runs(odd).collect() if r.doc.doc_id}
    assert got[1].n_words == got[2].n_words == got[3].n_words == 0 and got[1].collapsed == "" and got[1].doc.size == "a"
    # LONG counts to 9000 six times and then on: one run over all of it.
    assert [tuple(r) for r in got[6].runs] == [(0, 60_000, 9000)] and got[6].collapsed.split() == [f"w{i}" for i in range(9000)]
    assert got[7].runs[0].length == 60_000 and got[7].collapsed.endswith("w8999 tail") and got[4].collapsed == "A b C d E f"
    assert len(runs.detect_runs(odd).collect()) == len(ODD) and runs.detect_runs(none).count() == 0
    same = runs.detect_runs(spark.createDataFrame([(1, "x " * 40), (1, "x " * 40)], "doc_id long, text string")).collect()
    assert same[0] == same[1] and same[0].collapsed == "x" and tuple(same[0].runs[0]) == (0, 40, 1)
    back = {r.doc_id: r.text for r in runs.plant_repeats(odd).collect()}
    assert back[1] is None and back[2] == "" and back[6].split() == planted(6, LONG)


# ------------------------------------------------------------------ 13 fill in the middle

TEXTS = ["", "a", "abc def", "é́ß中 a1b2", "x" * 500, "no <P> here", "<<S<M <P", "tail <", "\n\t  \n", "A-b_c" * 60]


def plain_middle(key, text, plain=10, spm=20, salt="1"):
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = [int(hashlib.sha256(f"{salt}:{key}".encode()).hexdigest()[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return len(u), "plain", None, None, text
    return (len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("block", [5, 1 << 20])
def test_middle_equals_a_plain_version(spark, monkeypatch, block):
    for text in TEXTS:
        for key in map(str, range(40)):
            got = fim.transform(text.encode(), key, 10, 20, "1")
            assert (*got[:4], got[4].decode()) == plain_middle(key, text) and fim.undo(got[4], got[1]).decode() == text
        counts = fim.scan(text.encode(), block)
        u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        assert [fim.byte_of(text.encode(), counts, k, block) for k in range(len(u) + 1)] == [len("".join(u[:k]).encode()) for k in range(len(u) + 1)]
    monkeypatch.setattr(fim, "BLOCK", block)
    buf = bytearray(range(200))
    fim.rotate(buf, 10, 50, 190)
    assert buf == bytes(range(10)) + bytes(range(50, 190)) + bytes(range(10, 50)) + bytes(range(190, 200))


def test_middle_odd_rows(odd, none):
    made = fim.fill_in_middle(odd.withColumns({"form": F.lit("x"), "output": F.lit("y"), "odd name": F.lit(1)}))
    rows = fim.restore(made).collect()
    assert len(rows) == len(ODD) and all(r.restored == (r.doc.text or "") and r.doc.form == "x" for r in rows)
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_middle("" if r.doc.doc_id is None else r.doc.doc_id, r.doc.text or "")
    assert {r.form for r in rows if not r.doc.text} == {"plain"}
    assert fim.restore(fim.fill_in_middle(none)).count() == 0
    assert fim.restore(fim.fill_in_middle(odd, plain=0, spm=100)).where("form = 'psm'").count() == 0
