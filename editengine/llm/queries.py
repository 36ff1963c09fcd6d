"""The named queries of the corpus operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editengine.session import prepare, shared_dir

from . import anngraph, decontam, hmm, jaccardjoin, langid, linededup, packing, quality, simhash, spelling, suffixdedup, tokenstore, whitening
from .common import crc_rest, table


def op1_subword_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_rest("doc_id", 3) == 1, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op2_line_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    store = linededup.LineStore(spark, shared_dir(spark, "lines"))
    store.insert(docs)
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return store.apply(docs).select("doc_id", "n_lines", "n_dropped", kept)


def op3_suffix_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    kept = suffixdedup.remove(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return anngraph.search(vectors, vectors.where("vec_id % 100 = 0"))


def op5_window_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_rest("doc_id", 5) == 0, F.lit(False))
    model = quality.fit(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out))
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = shared_dir(spark, "token-planes")
    tokenstore.write(table(spark, sf_dir, "documents"), path)
    return tokenstore.read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    held_out = F.coalesce(crc_rest("doc_id", 5) == 1, F.lit(False))
    scored = hmm.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op10_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.groups(table(spark, sf_dir, "documents"))


def op11_prefix_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccardjoin.groups(table(spark, sf_dir, "documents"))


def op12_bloom_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_polarised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_subword_language": op1_subword_language,
    "op2_line_store": op2_line_store,
    "op3_suffix_buckets": op3_suffix_buckets,
    "op4_pruned_graph": op4_pruned_graph,
    "op5_window_simhash": op5_window_simhash,
    "op6_rule_ensemble": op6_rule_ensemble,
    "op7_token_planes": op7_token_planes,
    "op8_hidden_markov": op8_hidden_markov,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_simhash_trie": op10_simhash_trie,
    "op11_prefix_orders": op11_prefix_orders,
    "op12_bloom_variants": op12_bloom_variants,
    "op13_polarised_whitening": op13_polarised_whitening,
}
