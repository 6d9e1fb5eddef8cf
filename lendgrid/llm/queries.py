"""The numbered queries over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers

from . import bpe, fim, hnsw, html_text, katz, langid, licences, lines, mixing, mtree, sharding, simhash, spelling

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licences(spark, sf_dir):
    return licences.scanned(table(spark, sf_dir, "documents"))


def op2_hnsw(spark, sf_dir):
    return hnsw.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_bpe(spark, sf_dir):
    return bpe.bpe_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op4_html(spark, sf_dir):
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op5_mtree(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    return mtree.top_inner_products(v, v.where("vec_id % 50 = 0"))


def op6_language(spark, sf_dir):
    return langid.language_digest(table(spark, sf_dir, "documents"))


def op7_lines(spark, sf_dir):
    return lines.line_components(table(spark, sf_dir, "documents"))


def op8_katz(spark, sf_dir):
    return katz.language_model_scores(table(spark, sf_dir, "documents"))


def op9_simhash(spark, sf_dir):
    return simhash.simhash_digest(table(spark, sf_dir, "documents"))


def op10_mix(spark, sf_dir):
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op11_shards(spark, sf_dir):
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


def op12_spelling(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_fim(spark, sf_dir):
    return fim.fim_digest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_licences, op2_hnsw, op3_bpe, op4_html, op5_mtree, op6_language, op7_lines, op8_katz, op9_simhash, op10_mix, op11_shards, op12_spelling, op13_fim)}
SQL = {"op10_mix": mixing.MIX_SQL, "op13_fim": fim.FIM_SQL}
