"""Periodic runs of words: maximal stretches that repeat a period, by longest common extensions on suffix trees.

Every run has a Lyndon root that is the longest Lyndon word at some position, for the order of the words or for its
reverse.  So each position gives two candidate periods; a suffix tree of the words and one of their reversal answer,
in constant time each, how far a candidate extends either way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from tidewheel.llm.base import boxed, let, small_batches, words

RUN = "struct<start:bigint,length:bigint,period:bigint>"
#: Tour entries of a block of the minimum search.
STRIDE = 16


class SuffixTree:
    """Ukkonen's suffix tree of integers 1 .. k, ended by 0; ``lce`` answers many pairs at once.

    The Euler tour lists the string depth of each node met; the least depth between the first visits of two leaves is
    their longest common extension.  ``order`` and ``flipped`` are the suffixes (the empty one included) in lexicographic order of the
    symbols and of the reversed symbols, the end being least in both.
    """

    def __init__(self, symbols: list[int]):
        s = [*symbols, 0]
        self.n, self.width = len(s), max(s) + 1
        self._build(s)
        self._tour(s)

    def _build(self, s: list[int]) -> None:
        n, width = self.n, self.width
        start, end, link, suffix, go = [0], [0], [0], [-1], {}
        node = edge = length = rest = 0
        for i, c in enumerate(s):
            rest += 1
            last = 0
            while rest:
                if not length:
                    edge = i
                key = node * width + s[edge]
                nxt = go.get(key)
                if nxt is None:
                    go[key] = len(start)
                    start.append(i), end.append(n), link.append(0), suffix.append(i - rest + 1)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    a = start[nxt]
                    span = min(end[nxt], i + 1) - a
                    if length >= span:
                        edge += span
                        length -= span
                        node = nxt
                        continue
                    if s[a + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split = len(start)
                    start.append(a), end.append(a + length), link.append(0), suffix.append(-1)
                    go[key] = split
                    go[split * width + c] = split + 1
                    start.append(i), end.append(n), link.append(0), suffix.append(i - rest + 1)
                    start[nxt] = a + length
                    go[split * width + s[a + length]] = nxt
                    if last:
                        link[last] = split
                    last = split
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - rest + 1
        self.go, self.start, self.end, self.suffix = go, start, end, suffix

    def _tour(self, s: list[int]) -> None:
        size = len(self.start)
        keys = np.fromiter(self.go.keys(), np.int64, len(self.go))
        child = np.fromiter(self.go.values(), np.int64, len(self.go))
        by = np.argsort(keys)
        parent, child = keys[by] // self.width, child[by]
        first = np.searchsorted(parent, np.arange(size + 1)).tolist()
        kids, span = child.tolist(), (np.array(self.end) - np.array(self.start)).tolist()
        suffix, depth = self.suffix, [0] * size
        tour, stack, place = [], [0], [0] * self.n
        while stack:
            v = stack.pop()
            if v < 0:
                tour.append(depth[~v])
                continue
            d = depth[v]
            if suffix[v] >= 0:
                place[suffix[v]] = len(tour)
                tour.append(d)
                continue
            tour.append(d)
            for j in range(first[v + 1] - 1, first[v] - 1, -1):
                c = kids[j]
                depth[c] = d + span[c]
                stack += (~v, c)
        self.place = np.array(place, np.int64)
        self.order = np.argsort(self.place)
        # Reversed symbols: children from the last to the first, but an edge that begins with the end comes before all.
        stack, flipped = [0], []
        while stack:
            v = stack.pop()
            if suffix[v] >= 0:
                flipped.append(suffix[v])
                continue
            a, b = first[v], first[v + 1]
            ended = s[self.start[kids[a]]] == 0
            stack += kids[a + ended:b]
            if ended:
                stack.append(kids[a])
        self.flipped = np.array(flipped, np.int64)
        del self.go, self.start, self.end, self.suffix
        t = np.array(tour, np.int32)
        t = np.concatenate([t, np.full(-len(t) % STRIDE, np.iinfo(np.int32).max, np.int32)])
        blocks = t.reshape(-1, STRIDE)
        self.tour, self.ahead = t, np.minimum.accumulate(blocks, 1).ravel()
        self.behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        level = blocks.min(1)
        self.levels = [level]
        while len(level) > 1 << len(self.levels) - 1:
            h = 1 << len(self.levels) - 1
            if len(level) <= h:
                break
            level = np.minimum(level[:-h], level[h:])
            self.levels.append(level)

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes at ``i`` and ``j`` (arrays; different positions) share before they differ."""
        a, b = self.place[i], self.place[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        out = np.minimum(self.behind[lo], self.ahead[hi])
        l, h = lo // STRIDE + 1, hi // STRIDE
        for k, level in enumerate(self.levels):
            at = np.flatnonzero((h - l >= 1 << k) & (h - l < 2 << k))
            out[at] = np.minimum(out[at], np.minimum(level[l[at]], level[h[at] - (1 << k)]))
        same = np.flatnonzero(h < l)
        if len(same):
            x, y = lo[same], hi[same]
            least = self.tour[x]
            for k in range(1, STRIDE):
                least = np.minimum(least, self.tour[np.minimum(x + k, y)])
            out[same] = least
        return out.astype(np.int64)


def lyndon_ends(rank: list[int]) -> np.ndarray:
    """End of the longest Lyndon word at each position: the next suffix of lower rank (the empty one has the lowest)."""
    n = len(rank) - 1
    end, stack = [n] * n, [n]
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while rank[stack[-1]] > r:
            stack.pop()
        end[i] = stack[-1]
        stack.append(i)
    return np.array(end, np.int64)


def all_runs(symbols: list[int], least: int = 1, times: int = 2) -> list[tuple[int, int, int]]:
    """``start, length, period`` of the runs with ``length >= max(least, times * period)``, ``times`` being 2 at least, in order."""
    n = len(symbols)
    if n < max(least, times):
        return []
    tree, back = SuffixTree(symbols), SuffixTree(symbols[::-1])
    found = []
    for order in (tree.order, tree.flipped):
        rank = np.empty(n + 1, np.int64)
        rank[order] = np.arange(n + 1)
        i = np.arange(n)
        j = lyndon_ends(rank.tolist())
        right = tree.lce(i, j)
        left = back.lce(n - i, n - j)
        start, length, period = i - left, j - i + left + right, j - i
        good = length >= np.maximum(least, times * period)
        found.append(np.stack([start[good], length[good], period[good]]))
    return list(map(tuple, np.unique(np.concatenate(found, 1), axis=1).T.tolist()))


def window_for(least: int, times: int) -> int:
    """Words of a window that every wanted run repeats one period later, whatever its period."""
    q = least // times
    return max(1, min(least - q, (times - 1) * (q + 1)))


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)


def repeated_stretches(tokens: list[bytes], size: int) -> list[tuple[int, int]]:
    """Maximal stretches of words covered by ``size``-word windows that occur more than once.

    A run that repeats windows of that size lies in one stretch, and no word beside the stretch can extend it.  Hashes may
    only take in too much.
    """
    n = len(tokens)
    if n <= size:
        return []
    h = np.fromiter(map(hash, tokens), np.int64, n).view(np.uint64)
    # Windows of the powers of two double up; the size's binary digits put them together.
    whole, at, width, k = None, 0, 1, 0
    while True:
        if size & width:
            part = h[at:]
            whole = part if whole is None else whole[:len(part)] * _ODD[k % 6] + part[:len(whole)]
            at += width
        if 2 * width > size:
            break
        h = h[:-width] * _ODD[(k + 1) % 6] + h[width:]
        h ^= h >> np.uint64(29)
        width, k = 2 * width, k + 1
    whole = whole[:n - size + 1]
    s = np.sort(whole)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return []
    at = np.flatnonzero(np.isin(whole, twice))
    cut = np.flatnonzero(np.diff(at) > size) + 1
    return [(int(a[0]), int(a[-1]) + size) for a in np.split(at, cut)]


def runs_of(tokens: list[bytes], least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """Runs of a word list by start, then period."""
    out = []
    for a, b in repeated_stretches(tokens, window_for(least, times)):
        ids: dict[bytes, int] = {}
        out += [(a + s, n, p) for s, n, p in all_runs([ids.setdefault(w, len(ids) + 1) for w in tokens[a:b]], least, times)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(tokens: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that lie in the first period of every run that holds them."""
    if not runs:
        return tokens
    edge = np.zeros(len(tokens) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [tokens[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def detect_runs(docs: DataFrame, *, least: int = 24, times: int = 3) -> DataFrame:
    """``doc`` (the input row) beside ``n_words, runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are runs of anything but ASCII white space.  A run is a stretch with smallest period q, of ``max(least, times * q)``
    words or more, that no neighbouring word extends; ``collapsed`` joins by one space the words that no run holds after its
    first q words.  Null and empty texts have no words, no runs and an empty ``collapsed``.  Repeated rows give equal results;
    an empty table gives no rows; the row is boxed, so its columns cannot clash with the added ones.

    A text is one task's work.  Trees are only built over stretches in which windows of words repeat (no run is lost by that), one
    at a time, about a kilobyte a word of the longest such stretch.  Rows never move between tasks.
    """
    small_batches(docs.sparkSession)
    d = boxed(docs).select("_doc", F.coalesce(F.col("_doc.text").cast("binary"), F.lit(b"")).alias("text"))
    run_type = StructType().add("start", LongType()).add("length", LongType()).add("period", LongType())
    arrow_runs = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, found, left = [], [], []
            for text in b.column(1):
                tokens = text.as_py().split()
                got = runs_of(tokens, least, times)
                counts.append(len(tokens))
                found.append([dict(zip(("start", "length", "period"), r)) for r in got])
                left.append(b" ".join(collapse(tokens, got)).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(found, arrow_runs), pa.array(left, pa.string())], ["doc", "n_words", "runs", "collapsed"])

    return d.mapInArrow(run, StructType().add("doc", d.schema["_doc"].dataType).add("n_words", LongType()).add("runs", ArrayType(run_type)).add("collapsed", StringType()))


def strongest(runs: Column) -> Column:
    """The run of greatest exact length / period; ties to the smallest start, then period; null without runs."""
    def better(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return (left > right) | ((left == right) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))))

    return F.aggregate(runs, F.lit(None).cast(RUN), lambda a, b: F.when(a.isNull() | better(b, a), b).otherwise(a))


def plant_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the tail of every tenth text repeating, as the registered query wants it.

    By h = crc32(doc_id), g = floor(h / 10): where h % 10 = 0, each word i >= a becomes word a + (i - a) % p with a = g % n
    and p = 1 + floor((n - a) / (3 + g % 8)).  Other texts, texts without words and rows without an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeat(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        return F.when(n > 0, let(F.pmod(g, n), lambda a: let(1 + F.floor((n - a) / (3 + g % 8)), lambda p: F.array_join(
            F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(w, F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int"))), " "))))

    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(let(words(F.col("text")), repeat), F.col("text"))).otherwise(F.col("text")).alias("text"))
