"""URL verdicts: list rules first, boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.base import let, unit_hash

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Labelled URLs the trees are grown on at most, the lowest by hash.
SAMPLE = 20_000
FEATURES = ["url_length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "n_params", "n_labels", "n_hyphens", "has_fragment", "https", "suffix_share", "ending_share"]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    u = F.coalesce(url, F.lit(""))
    take = lambda i: F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)([^?#]*)", i)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(take(1), upper, upper.lower()), take(2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest rule that fits, null without one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(f"/{p}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Shannon entropy (bits) of the characters."""
    n = F.length(text)
    one = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda a, c: a - F.when(c == "", 0.0).otherwise(let(one(c), lambda p: p * F.log2(p))))


def features(d: DataFrame) -> DataFrame:
    """Lexical features of ``url, host, path``; null urls count as empty.

    Suffix statistics are shares over all rows: of the host's last label, and of the path's ending.  Both tables have few
    rows as a rule and join without a hint.
    """
    u = F.coalesce(F.col("url"), F.lit(""))
    d = d.withColumn("_suffix", F.substring_index("host", ".", -1)).withColumn("_ending", F.regexp_extract("path", r"(\.[A-Za-z0-9]{1,5}|/)$", 1))
    share = lambda c: d.groupBy(F.col(c).alias(f"{c}_k")).agg(F.count(F.lit(1)).alias(f"{c}_n"))
    n = F.lit(float(max(1, d.count())))
    d = d.join(share("_suffix"), F.col("_suffix") == F.col("_suffix_k"), "left").join(share("_ending"), F.col("_ending") == F.col("_ending_k"), "left")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return d.withColumns({
        "url_length": F.length(u), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": F.regexp_count("path", F.lit("/[^/]+")), "digit_ratio": F.regexp_count(u, F.lit("[0-9]")) / F.greatest(F.length(u), F.lit(1)),
        "entropy": F.when(F.length(u) > 0, entropy(u)).otherwise(0.0), "n_params": F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("&")) + 1),
        "n_labels": F.regexp_count("host", F.lit(r"[^.]+")), "n_hyphens": F.regexp_count("host", F.lit("-")),
        "has_fragment": F.contains(u, F.lit("#")).cast("int"), "https": u.startswith("https://").cast("int"),
        "suffix_share": F.coalesce(F.col("_suffix_n") / n, F.lit(0.0)), "ending_share": F.coalesce(F.col("_ending_n") / n, F.lit(0.0)),
    }).withColumns({f: F.col(f).cast("double") for f in FEATURES})


def judge(pages: DataFrame, *, rules: Sequence[tuple[str, str]] = RULES, sample: int = SAMPLE, trees: int = 10, depth: int = 4, seed: int = 7) -> DataFrame:
    """``page_id, url, host, path, rule, verdict``: the longest rule's verdict, else that of boosted trees.

    The trees learn from the urls that rules decide, at most ``sample`` distinct ones, the lowest by hash.  Where these are all of one verdict, that is the
    verdict of the rest; where there are none, the rest is allowed.  Null urls have an empty host and path and are
    judged by the trees like others; repeated rows are judged alike.
    """
    host, path = parts(F.col("url"))
    d = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumn("host", host).withColumn("path", path)
    d = features(d.withColumn("_r", rule_of(F.col("host"), F.col("path"), rules)))
    known = (d.where("_r IS NOT NULL").select("url", (F.col("_r.verdict") == "block").cast("double").alias("label"), *FEATURES).dropDuplicates(["url"])
             .orderBy(unit_hash(F.col("url"), seed=seed), "url").limit(sample).cache())
    seen = sorted(r[0] for r in known.select("label").distinct().collect())
    if len(seen) < 2:
        model = F.lit("block" if seen == [1.0] else "allow")
        out = d.withColumn("_m", model)
    else:
        put = VectorAssembler(inputCols=FEATURES, outputCol="_features")
        fitted = GBTClassifier(featuresCol="_features", labelCol="label", predictionCol="_p",
                               maxIter=trees, maxDepth=depth, seed=seed, cacheNodeIds=False).fit(put.transform(known))
        out = fitted.transform(put.transform(d)).withColumn("_m", F.when(F.col("_p") == 1, "block").otherwise("allow"))
    known.unpersist()
    return out.select("page_id", "url", "host", "path", F.col("_r.rule").alias("rule"), F.coalesce(F.col("_r.verdict"), F.col("_m")).alias("verdict"))
