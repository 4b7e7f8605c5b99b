"""Main text of web pages: structure first, then what neighbours by URL share.

Pages of a host are put in order of their URL path; a page's text lines are aligned with those of its nearest pages by
longest common subsequence.  Lines that are shared are page furniture and go.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.base import small_batches, written
from tidewheel.llm.urls import parts

#: Nearest pages to compare with, on either side, and pages of one task.
NEAR, CHUNK = 3, 512
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|select|object)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
                 r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S | re.I)
ATTR = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset("nav footer aside form button head title menu dialog fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
MARKS = frozenset("nav navbar navigation menu footer sidebar aside ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice "
                  "comment comments disqus replies newsletter subscribe signup login share sharing social related recommended breadcrumb breadcrumbs pagination pager popup modal overlay widget toolbar masthead topbar skip".split())
MAIN_MARKS = frozenset("articlebody".split())


def _kind(tag: str, attrs: str, in_main: bool) -> str:
    """``drop`` for page furniture, ``main`` for the article, else nothing."""
    if tag in FURNITURE or (tag == "header" and not in_main):
        return "drop"
    if "=" not in attrs and "hidden" not in attrs.lower():
        return "main" if tag in ("article", "main") else ""
    found: dict[str, str] = {}
    for m in ATTR.finditer(attrs):
        found.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    if tag not in ("html", "body", "main"):
        tokens = set(re.split(r"[^a-z0-9]+", found.get("class", "") + " " + found.get("id", "")))
        if tokens & MARKS or found.get("role") in ROLES or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
            return "drop"
    if tag in ("article", "main") or found.get("role") in ("main", "article") or found.get("itemprop") in MAIN_MARKS:
        return "main"
    return ""


def blocks(page: str | None) -> tuple[list[str], bool]:
    """Text lines of the page in order, and whether they come from a marked article.

    A line is one block's text: character references decoded, white space as single blanks.  Furniture, scripts, styles
    and comments are gone; if the page marks its article, only lines inside count.  Unclosed elements end with what holds them.
    """
    page = page or ""
    out: list[tuple[str, bool]] = []
    buffer: list[str] = []
    stack: list[tuple[str, str]] = []
    dropped = mains = 0
    at = 0

    def close() -> None:
        if buffer:
            line = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if line:
                out.append((line, mains > 0))

    for m in TAG.finditer(page):
        if not dropped and m.start() > at:
            buffer.append(page[at:m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            if m[1] and not dropped:
                buffer.append(" ")
            continue
        if tag not in INLINE and not dropped:
            close()
        elif tag == "br" and not dropped:
            buffer.append(" ")
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if not dropped:
                        close() if tag not in INLINE else None
                    for _, kind in stack[i:]:
                        dropped -= kind == "drop"
                        mains -= kind == "main"
                    del stack[i:]
                    break
        elif tag not in VOID and not m[4].endswith("/"):
            kind = _kind(tag, m[4], mains > 0)
            if kind == "drop" and not dropped and tag in INLINE:
                buffer.append(" ")
            if kind or tag not in ("p", "li", "b", "i", "em", "strong", "td", "tr", "th", "dt", "dd", "option"):
                stack.append((tag, kind))
                dropped += kind == "drop"
                mains += kind == "main"
    if not dropped and at < len(page):
        buffer.append(page[at:])
    close()
    marked = [x for x, inside in out if inside]
    return (marked, True) if marked else ([x for x, _ in out], False)


def common_lines(a: list[int], b: list[int]) -> set[int]:
    """Indices of ``a`` on a longest common subsequence of both (hashed) lines."""
    n, m, lo = len(a), len(b), 0
    while lo < n and lo < m and a[lo] == b[lo]:
        lo += 1
    end = 0
    while end < n - lo and end < m - lo and a[n - 1 - end] == b[m - 1 - end]:
        end += 1
    found = set(range(lo)) | set(range(n - end, n))
    # Lines the other page lacks cannot be on it.
    there = set(b[lo:m - end])
    x = [i for i in range(lo, n - end) if a[i] in there]
    if x:
        have = {a[i] for i in x}
        y = [v for v in b[lo:m - end] if v in have]
        table = np.zeros((len(x) + 1, len(y) + 1), np.int32)
        other = np.array(y)
        for i in range(len(x) - 1, -1, -1):
            row = np.maximum(table[i + 1, :-1], np.where(other == a[x[i]], table[i + 1, 1:] + 1, 0))
            table[i, :-1] = np.maximum.accumulate(row[::-1])[::-1]
        i = j = 0
        while i < len(x) and j < len(y):
            if a[x[i]] == y[j] and table[i, j] == table[i + 1, j + 1] + 1:
                found.add(x[i])
                i, j = i + 1, j + 1
            elif table[i + 1, j] >= table[i, j + 1]:
                i += 1
            else:
                j += 1
    return found


def furniture(lines: list[int], marked: bool, others: list[list[int]]) -> list[int]:
    """Indices of the lines that the nearest pages show to be page furniture.

    Pages that share most of their text are copies, no evidence of a layout.  On a page without a marked article, a line goes
    that any other neighbour aligns; inside a marked article, only what all of at least four neighbours align.
    """
    votes: dict[int, int] = {}
    asked = 0
    for o in others:
        got = common_lines(lines, o)
        if not o or 2 * len(got) > max(len(lines), len(o)):
            continue
        asked += 1
        for i in got:
            votes[i] = votes.get(i, 0) + 1
    need = max(asked, 4) if marked else 1
    return sorted(i for i, v in votes.items() if v >= need)


def _line_hash(x: str) -> int:
    return xxhash.xxh3_64_intdigest(x) >> 1


def main_text(pages: DataFrame, *, near: int = NEAR, chunk: int = CHUNK) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every page, blocks joined by two line breaks.

    Null html is empty; pages without a host are neighbours of each other.  Pages in path order (ties by id) are dealt into
    chunks with ``near`` rows of overlap, so a host of any size is many tasks' work.  Page texts never move: line hashes do, and the few
    pages that lose lines come back as a list, joined without a hint.
    """
    small_batches(pages.sparkSession)
    host, path = parts(F.col("url"))
    src = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [blocks(h) for h in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([[_line_hash(x) for x in g[0]] for g in got], pa.list_(pa.int64())), pa.array([g[1] for g in got], pa.bool_())],
                                             ["page_id", "host", "path", "lines", "marked"])

    d = src.select("page_id", host.alias("host"), path.alias("path"), "html").mapInArrow(lines, "page_id bigint, host string, path string, lines array<bigint>, marked boolean")
    ordered = written(written(d).repartitionByRange("host", "path", "page_id").sortWithinPartitions("host", "path", "page_id", "lines").withColumn("_at", F.monotonically_increasing_id()))
    place = ordered.withColumns({"_part": F.shiftright("_at", 33), "_i": F.col("_at").bitwiseAND((1 << 33) - 1)})
    counts = place.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).collect()  # one row a partition
    start, starts = 0, {}
    for r in sorted(counts):
        starts[r["_part"]], start = start, start + r["_n"]
    offset = F.create_map(*[F.lit(x) for kv in starts.items() for x in kv])[F.col("_part")] if starts else F.lit(0)
    place = place.withColumn("_g", (offset + F.col("_i")).cast("bigint"))
    spread = place.withColumn("_chunk", F.explode(F.sequence(F.floor((F.col("_g") - near) / chunk), F.floor((F.col("_g") + near) / chunk))))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_g", kind="stable")
        ids, hosts, marked, at = pdf["page_id"].tolist(), pdf["host"].tolist(), pdf["marked"].tolist(), pdf["_g"].tolist()
        ls, own, out = [list(map(int, x)) for x in pdf["lines"]], pdf["_chunk"].iloc[0], []
        for i in range(len(ids)):
            if at[i] // chunk != own or not ls[i]:
                continue
            others = [ls[j] for j in range(max(0, i - near), min(len(ids), i + near + 1)) if j != i and hosts[j] == hosts[i]]
            lost = furniture(ls[i], marked[i], others) if others else []
            if lost:
                out.append((ids[i], _line_hash(str(ls[i])), lost))
        return pd.DataFrame(out, columns=["page_id", "page_hash", "lost"])

    lost = written(spread.groupBy("_chunk").applyInPandas(compare, "page_id bigint, page_hash bigint, lost array<int>"))
    lost = lost.groupBy("page_id").agg(F.collect_list(F.struct("page_hash", "lost")).alias("_lost")).withColumnRenamed("page_id", "_id")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for page, gone in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x = blocks(page)[0]
                if gone:
                    mine = _line_hash(str([_line_hash(v) for v in x]))
                    drop = {i for g in gone if g["page_hash"] == mine for i in g["lost"]}
                    x = [v for i, v in enumerate(x) if i not in drop]
                out.append("\n\n".join(x))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])

    joined = src.join(lost, F.col("page_id") == F.col("_id"), "left").select("page_id", "url", "html", "_lost")
    return joined.mapInArrow(texts, "page_id bigint, url string, text string").withColumn("n_chars", F.length("text").cast("bigint"))
