"""A training corpus from raw documents, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the
last return the columns of ``documents``. Between stages the rows are written as Parquet.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.llm.common import materialise, read_table, restored
from tabloom.llm.decontaminate import uncontaminated
from tabloom.llm.lines import line_dedup
from tabloom.llm.mixing import mix_sources, temperature_targets
from tabloom.llm.neardup import near_duplicates
from tabloom.llm.quality import accepted

#: The stages hold operators that SQL cannot express.
ORACLE_SQL = None


def quality_filter(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go."""
    return accepted(docs, read_table(spark, sf_dir, "labels"))


def shared_lines(spark, docs, sf_dir):
    """Lines that many documents share go from all but one of them; n_chars follows the text."""
    out = restored(line_dedup(docs, carry=True), docs, "kept_text")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_copies(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays (five words, similarity of 0.8 or more)."""
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept")), "left_semi")


def benchmark_leaks(spark, docs, sf_dir):
    """Documents contaminated by the benchmark go."""
    return uncontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark, docs, sf_dir):
    """Every document with its place in a mixture of the sources."""
    return mix_sources(docs, temperature_targets(docs, 0.5))


STAGES = [("quality", quality_filter), ("lines", shared_lines), ("near_duplicates", near_copies), ("decontamination", benchmark_leaks), ("mixing", mixture)]


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
