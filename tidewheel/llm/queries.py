"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import bestfit, chat, fim, html, mixing, neardup, packing, quality, runs, tokens, topk, toxicity, urls
from tidewheel.llm.base import table

QUERIES, ORACLE = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokens.default_vocabulary(), columns={"ids_crc32": F.crc32("ids")})


@query
def op6_packed_id_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.default_vocabulary()
    narrow = tokens.narrow_ids(path)
    alone, shared = packing.pack_parts(table(spark, sf_dir, "documents"), path, place=packing.best_fit_decreasing, narrow=narrow)
    m = packing.id_matrix(shared, narrow=narrow, alone=alone)
    return m.select("sequence_id", "n_tokens", "cu_seqlens", "doc_ids", "pieces", F.crc32("input_ids").alias("ids_crc32"),
                    F.size("position_ids").alias("n_positions"),
                    F.size(F.filter("position_ids", lambda p: p == 0)).alias("n_resets"))


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE["op10_mix_sources"] = mixing.SQL


@query
def op8_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(d, keep_text=False).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE["op8_quality_divergence"] = quality.SQL


@query
def op3_toxicity_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                                              (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op1_odd_sketch_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op4_vector_approximation_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


ORACLE["op4_vector_approximation_topk"] = topk.SQL


@query
def op5_url_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


@query
def op7_collapse_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_and_render(table(spark, sf_dir, "conversations"))


ORACLE["op7_collapse_conversations"] = chat.SQL


@query
def op9_url_neighbour_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


@query
def op11_best_fit_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(table(spark, sf_dir, "documents"), tokens.default_vocabulary(), columns={"ids_crc32": F.crc32("ids")}).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op12_suffix_tree_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = runs.detect_runs(runs.plant_repeats(table(spark, sf_dir, "documents"))).select("doc.doc_id", "runs", "collapsed", runs.strongest(F.col("runs")).alias("top"))
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n")))
    return d.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "top.start", "top.length", "top.period",
                    F.expr("1000 * top.length DIV top.period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_rotated_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc.doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    return fim.restore(made).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


ORACLE["op13_rotated_middle"] = fim.SQL
