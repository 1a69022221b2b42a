"""Registered queries of the text operators: each runs over the whole table it is meant for."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import (
    chosen_path, knn, langid, main_text, mixing, pieces, quality, runs, secrets, tool_calls,
    url_rules, variants, warc,
)
from tripmill.session import fresh_folder, prepare
from tripmill.sources.fixtures import table

Query = Callable[[SparkSession, str], DataFrame]

#: Folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("TOKENIZERS", "/opt/tokenizers")
PIECE_MODEL = "piece_bpe_32k.model"
QUERY_EVERY = 20


def piece_model() -> str:
    return os.path.join(TOKENIZERS, PIECE_MODEL)


def op1_url_filter(spark, sf_dir):
    return url_rules.url_filter(table(spark, sf_dir, "pages"))


def op2_voronoi_knn(spark, sf_dir):
    return knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


def op3_distribution_divergence(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op4_tool_call_linking(spark, sf_dir):
    messages = tool_calls.as_tool_messages(table(spark, sf_dir, "conversations"))
    return tool_calls.serialised(tool_calls.link_messages(messages)).drop("result", "arguments")


def op5_guess_cost(spark, sf_dir):
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op6_byte_network(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_gzip_normaliser(spark, sf_dir):
    read = warc.archived(table(spark, sf_dir, "pages"), fresh_folder(spark, "warc"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                       "intact")


def op8_fair_queueing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_offset_encoding(spark, sf_dir):
    return pieces.digests(table(spark, sf_dir, "documents"), piece_model())


def op10_chosen_path(spark, sf_dir):
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


def op11_tree_marginals(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.with_main_text(pages).drop("html")


def op12_multiscale_minimizers(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", runs.planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = runs.periodic_runs(texts)
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_search_schemes(spark, sf_dir):
    letters = variants.runs_of_letters(table(spark, sf_dir, "documents"))
    return variants.grouped(variants.counted(variants.misspelt(letters)))


REGISTERED = (
    op1_url_filter, op2_voronoi_knn, op3_distribution_divergence, op4_tool_call_linking,
    op5_guess_cost, op6_byte_network, op7_gzip_normaliser, op8_fair_queueing, op9_offset_encoding,
    op10_chosen_path, op11_tree_marginals, op12_multiscale_minimizers, op13_search_schemes,
)


def registered() -> dict[str, Query]:
    def with_session(query: Query) -> Query:
        return lambda spark, sf_dir: query(prepare(spark), sf_dir.rstrip("/"))
    return {query.__name__: with_session(query) for query in REGISTERED}
