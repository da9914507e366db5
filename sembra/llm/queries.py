"""Registered queries of the numbered operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from sembra.catalog.registry import query
from sembra.llm.combination_join import Jaccard, jaccard_join, jaccard_sql
from sembra.llm.common import fold, table
from sembra.llm.html_regions import extract_pages
from sembra.llm.language_id import fit_language_model, predict_languages
from sembra.llm.line_quality import line_quality, quality_sql
from sembra.llm.partition_search import search
from sembra.llm.ptolemy_clusters import cluster_report, clusters_sql
from sembra.llm.quality_subwords import fit_quality, score_quality
from sembra.llm.rank_array_bpe import encode_digests, load_vocabulary
from sembra.llm.spelling_automata import spelling_variants, variants_sql
from sembra.llm.toxicity_fm import fit_toxicity, score_toxicity
from sembra.llm.trie_lm import score_texts
from sembra.llm.url_filter import filter_urls
from sembra.llm.window_packing import load_byte_vocabulary, pack_documents


@query("op1_line_quality", quality_sql())
def op1_line_quality(spark, sf_dir):
    return line_quality(table(spark, sf_dir, "documents"))


@query("op6_url_filter")
def op6_url_filter(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"))


@query("op7_language_id")
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit_language_model(docs.where(fold("doc_id", 4) != 2))
    found = predict_languages(docs, model)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2)
    found = score_toxicity(docs, fit_toxicity(labels, docs))
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query("op2_partition_search")
def op2_partition_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors.where(F.col("vec_id") % 20 == 0), vectors, k=20)


@query("op3_window_packing")
def op3_window_packing(spark, sf_dir):
    vocabulary = load_byte_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary)


@query("op5_rank_array_bpe")
def op5_rank_array_bpe(spark, sf_dir):
    vocabulary = load_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    return encode_digests(table(spark, sf_dir, "documents"), vocabulary)


@query("op10_html_regions")
def op10_html_regions(spark, sf_dir):
    return extract_pages(table(spark, sf_dir, "pages"))


@query("op4_combination_join", jaccard_sql(4, 85))
def op4_combination_join(spark, sf_dir):
    return jaccard_join(table(spark, sf_dir, "documents"), Jaccard(words=4, percent=85))


@query("op8_trie_lm")
def op8_trie_lm(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


@query("op11_subword_quality")
def op11_subword_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    found = score_quality(docs, fit_quality(labels, docs))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query("op12_ptolemy_clusters", clusters_sql())
def op12_ptolemy_clusters(spark, sf_dir):
    return cluster_report(table(spark, sf_dir, "embeddings"))


@query("op13_spelling_automata", variants_sql())
def op13_spelling_automata(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))
