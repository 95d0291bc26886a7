"""The registered queries of the corpus operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracles
from .centroids import cluster
from .chat import chat_digest
from .common import read_table
from .decontaminate import decontaminate
from .lines import line_dedup
from .mixing import mix_sources, temperature_targets
from .neardup import near_duplicates
from .pii import pii_digest
from .quality import quality_scores
from .repeats import remove_repeats
from .runs import periodic_run_table, planted
from .secrets import secret_scan
from .simhash import simhash_groups
from .topk import top_k


def op1_exact_topk(spark, sf_dir):
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op2_mix_sources(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    mixed = mix_sources(docs, temperature_targets(docs, 0.5))
    return mixed.select("doc_id", "source", "mix_block", "mix_release", "mix_deadline", "mix_slot", "in_mix")


def op3_pii(spark, sf_dir):
    return pii_digest(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark, sf_dir):
    return line_dedup(read_table(spark, sf_dir, "documents"), digest=True)


def op5_chat_format(spark, sf_dir):
    return chat_digest(read_table(spark, sf_dir, "conversations"))


def op6_decontaminate(spark, sf_dir):
    return decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark, sf_dir):
    return secret_scan(read_table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents"), words=4, percent=80)


def op9_remove_repeats(spark, sf_dir):
    return remove_repeats(read_table(spark, sf_dir, "documents"), digest=True)


def op10_quality(spark, sf_dir):
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_centroids(spark, sf_dir):
    return cluster(read_table(spark, sf_dir, "embeddings"), k=40, rounds=5, width=64)


def op12_periodic_runs(spark, sf_dir):
    return periodic_run_table(read_table(spark, sf_dir, "documents"), planted)


def op13_simhash(spark, sf_dir):
    return simhash_groups(read_table(spark, sf_dir, "documents"), words=4, errors=4)


QUERIES = {f.__name__: f for f in (op1_exact_topk, op2_mix_sources, op3_pii, op4_line_dedup, op5_chat_format, op6_decontaminate,
                                   op7_secret_scan, op8_near_duplicates, op9_remove_repeats, op10_quality, op11_centroids, op12_periodic_runs, op13_simhash)}
SQL = oracles.SQL
