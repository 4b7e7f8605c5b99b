"""Quality rules: base counts, and how far a document's histograms lie from its language's.

Everything is a column expression; per document the work is linear in its text but for one sort of its word windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.base import GAP, let, words, written

# Frequent function words per language.
COMMON = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "nicht", "ein"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "was", "on", "are", "as", "with", "by", "be"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "dans", "par", "pas"],
}
SYMBOLS = r"#*$%&|<>"
CLASSES = ["lower", "upper", "digit", "space", "symbol", "other"]
N_COMMON = 16


def _left(text: Column, pattern: str) -> Column:
    """Code points that stay when runs of ``pattern`` go."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("bigint")


def repeated_words(w: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the array ``w``, all occurrences counted once."""

    def covered(h: Column) -> Column:
        tagged = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda j, k: F.coalesce(F.get(s, j)["h"] == F.get(s, k)["h"], F.lit(False))
            hit = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: ((j > 0) & same(j, j - 1)) | same(j, j + 1))
            return F.sort_array(F.transform(hit, lambda j: s[j]["i"]))

        def union(p: Column) -> Column:
            steps = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda j: j > 0)
            return F.aggregate(steps, F.lit(3).cast("bigint"), lambda a, j: a + F.least(F.lit(3), p[j] - p[j - 1]))

        return let(let(tagged, places), union)

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
    some = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("bigint"))
    return F.when(F.size(w) < 4, F.lit(0).cast("bigint")).otherwise(let(windows, some))


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with ``m``: the base counts, the character-class counts and the common-word counts of the whole text."""
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def spaced(s: Column) -> Column:
        """Counts of the language's common words in ``s``, where each word stands between two blanks of its own."""
        count = lambda x: ((F.length(s) - F.length(F.replace(s, F.lit(f" {x} "), F.lit("")))) / (len(x) + 2)).cast("bigint")
        out = F.array(*[F.lit(0).cast("bigint")] * N_COMMON)
        for lang, xs in COMMON.items():
            out = F.when(F.col("lang") == lang, F.array(*[count(x) for x in xs])).otherwise(out)
        return out

    def lines(x: Column) -> Column:
        return (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("bigint").alias("n_words"), repeated_words(w).alias("n_repeat_words"))

    d = docs.withColumn("m", F.struct(
        let(words(t), of_words).alias("w"),
        F.length(t).cast("bigint").alias("n_chars"),
        _left(t, GAP).alias("word_chars"),
        _left(t, rf"[^{SYMBOLS}]+").alias("n_symbols"),
        let(F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lines).alias("n_dup_lines"),
        _left(t, r"[^\p{Ll}]+").alias("lower"), _left(t, r"[^\p{Lu}]+").alias("upper"), _left(t, r"[^0-9]+").alias("digit"),
        let(F.concat(F.lit(" "), F.regexp_replace(F.lower(t), r"[^\p{L}]+", "  "), F.lit(" ")), spaced).alias("common")))
    m = F.col("m")
    known = m["lower"] + m["upper"] + m["digit"] + m["n_symbols"] + (m["n_chars"] - m["word_chars"])
    return d.withColumn("m", F.struct(
        m["w"]["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"), m["n_dup_lines"].alias("n_dup_lines"),
        m["w"]["n_repeat_words"].alias("n_repeat_words"), m["n_chars"].alias("n_chars"),
        F.array(m["lower"], m["upper"], m["digit"], m["n_chars"] - m["word_chars"], m["n_symbols"], m["n_chars"] - known).alias("classes"),
        F.concat(m["common"], F.array(F.greatest(F.lit(0).cast("bigint"), m["w"]["n_words"] - F.aggregate(m["common"], F.lit(0).cast("bigint"), lambda a, x: a + x)))).alias("common")))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two count arrays; 0 where either is empty."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    def of(n: Column) -> Column:
        terms = F.zip_with(p, q, lambda a, b: part(a / n["p"], b / n["q"]) + part(b / n["q"], a / n["p"]))
        return F.when((n["p"] > 0) & (n["q"] > 0), F.sqrt(F.greatest(F.lit(0.0), total(terms) / 2))).otherwise(F.lit(0.0))

    return F.round(let(F.struct(total(p).alias("p"), total(q).alias("q")), of), 9)


def judge(docs: DataFrame, *, class_limit: float = 0.22, short_limit: float = 0.32, word_limit: float = 0.32,
          min_chars: int = 200, long_chars: int = 900, min_words: int = 150,
          keep_text: bool = True) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``class_distance``, ``word_distance`` and ``kept``.

    The reference of a language is the sum of the counts of all documents that name it (null is a language of its own);
    short texts stray by chance, so the class distance is judged by ``short_limit`` from ``min_chars`` characters and by
    ``class_limit`` from ``long_chars`` on, the word distance by ``word_limit`` from ``min_words`` words on.
    Languages without a list of common words have one bin, so their word distance is 0.  Null and empty texts fail the
    base rule of 50 words.  ``docs`` needs ``text`` and ``lang``; columns named like the added ones are replaced.
    The measures are written once, with what columns ``docs`` has (without ``text`` unless ``keep_text``): both the
    reference and the verdicts read them.
    """
    m = measures(docs)
    m = written(m if keep_text else m.drop("text"))
    sums = lambda name, n: F.array(*[F.coalesce(F.sum(F.col(f"m.{name}")[i]), F.lit(0)) for i in range(n)]).alias(f"_{name}")
    # One row per language, written: the planner knows its size, and documents only move if it is large.
    ref = written(m.groupBy(F.col("lang").alias("_lang")).agg(sums("classes", len(CLASSES)), sums("common", N_COMMON + 1)))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    failed = (F.col("m.n_words") < 50) | (100 * F.col("m.n_repeat_words") > 50 * F.col("m.n_words"))
    d = m.join(ref, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    d = d.withColumns({**{b: F.col(f"m.{b}") for b in base}, "base_failed": failed,
                       "class_distance": distance(F.col("m.classes"), F.col("_classes")), "word_distance": distance(F.col("m.common"), F.col("_common"))})
    far = (((F.col("m.n_chars") >= min_chars) & (F.col("class_distance") > F.when(F.col("m.n_chars") >= long_chars, class_limit).otherwise(short_limit)))
           | ((F.col("m.n_words") >= min_words) & (F.col("word_distance") > word_limit)))
    return d.withColumn("kept", ~F.col("base_failed") & ~far).drop("_lang", "_classes", "_common", "m")


def _sql() -> str:
    lists = " ".join(f"WHEN lang = '{g}' THEN [{', '.join(repr(x) for x in xs)}]" for g, xs in COMMON.items())
    jsd = lambda p, q: (f"(SELECT CASE WHEN {p}n > 0 AND {q}n > 0 THEN round(sqrt(greatest(0.0, sum(CASE WHEN a > 0 THEN a * log2(2 * a / (a + b)) ELSE 0.0 END "  # noqa: E731
                        f"+ CASE WHEN b > 0 THEN b * log2(2 * b / (a + b)) ELSE 0.0 END) / 2)), 9) ELSE 0.0 END "
                        f"FROM (SELECT unnest({p})::DOUBLE / {p}n AS a, unnest({q})::DOUBLE / {q}n AS b))")
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win), (SELECT unnest([0, 1, 2]) AS o) WHERE c > 1 GROUP BY doc_id),
lin AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
b AS (SELECT doc_id, lang, t, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(lin.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        length(t) AS n_chars, length(regexp_replace(t, '[^\p{{Ll}}]+', '', 'g')) AS lo, length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS up, length(regexp_replace(t, '[^0-9]+', '', 'g')) AS di,
        [x FOR x IN string_split(regexp_replace(lower(t), '[^\p{{L}}]+', ' ', 'g'), ' ') IF x <> ''] AS tok, CASE {lists} ELSE []::VARCHAR[] END AS voc
      FROM d LEFT JOIN lin USING (doc_id) LEFT JOIN rep USING (doc_id)),
h0 AS (SELECT *, [lo, up, di, n_chars - word_chars, n_symbols, n_chars - lo - up - di - (n_chars - word_chars) - n_symbols] AS p,
         [len([y FOR y IN tok IF y = voc[i]]) FOR i IN range(1, {N_COMMON + 1})] AS c FROM b),
h AS (SELECT *, c || [greatest(0, n_words - list_sum(c)::BIGINT)] AS g, list_sum(p) AS pn FROM h0),
h1 AS (SELECT *, list_sum(g) AS gn FROM h),
rp AS (SELECT lang, list(s ORDER BY i) AS q, sum(s) AS qn FROM (SELECT lang, i, sum(v) AS s FROM (SELECT lang, unnest(p) AS v, unnest(range(len(p))) AS i FROM h1) GROUP BY lang, i) GROUP BY lang),
rg AS (SELECT lang, list(s ORDER BY i) AS r, sum(s) AS rn FROM (SELECT lang, i, sum(v) AS s FROM (SELECT lang, unnest(g) AS v, unnest(range(len(g))) AS i FROM h1) GROUP BY lang, i) GROUP BY lang),
z AS (SELECT h1.*, q, qn, r, rn, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
      FROM h1 JOIN rp ON h1.lang IS NOT DISTINCT FROM rp.lang JOIN rg ON h1.lang IS NOT DISTINCT FROM rg.lang),
y AS (SELECT *, {jsd("p", "q")} AS class_distance, {jsd("g", "r")} AS word_distance FROM z)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_chars >= 200 AND class_distance > CASE WHEN n_chars >= 900 THEN 0.22 ELSE 0.32 END)
       AND NOT (n_words >= 150 AND word_distance > 0.32) AS kept
FROM y
"""


SQL = _sql()
