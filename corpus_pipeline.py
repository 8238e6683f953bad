"""A training corpus from raw documents: repetitive documents go, one of each group of near-duplicates stays, strings
that occur twice are cut out, documents with benchmark passages go, and the sources are mixed to target weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run` writes as Parquet and reads again as the
next stage's documents. All but the last return the columns of documents. A stage judges all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkcorpus.llm import decontamination, quality_rules, simhash_dedup, suffix_dedup
from sparkcorpus.llm.common import bound_batches, save
from sparkcorpus.llm.queries import mixed, table

PASSAGE_BYTES, PASSAGE_SPAN = 200, 160


def drop_repetitive(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail them go."""
    bound_batches(spark)
    return quality_rules.reject_repetitive(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash: of each group of near-duplicates the document of the smallest id stays."""
    bound_batches(spark)
    return simhash_dedup.keep_one(docs, in_place=True)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of PASSAGE_BYTES that occur twice are cut out: of the passages of over 50 words that documents share, some
    are shorter than 400 bytes, hardly any is shorter than 200. A character cut in half goes too, as does a document of which
    nothing is left; `n_chars`, where there is such a column, is counted anew for texts that were cut."""
    bound_batches(spark)
    found = suffix_dedup.remove_repeats(docs, length=PASSAGE_BYTES, span=PASSAGE_SPAN, in_place=True, as_text=True)
    cut = F.col("kept").isNotNull()
    text = F.when(cut, F.col("kept")).otherwise(F.col("row.text"))
    columns = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("text", "n_chars")]
    chars = [F.when(cut, F.length("kept").cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars")] if "n_chars" in docs.columns else []
    kept = found.filter(~cut | (F.length("kept") > 0))
    return kept.select(*columns, text.alias("text"), *chars).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of the benchmark go."""
    bound_batches(spark)
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, with `mix_epoch` counted from 1."""
    taken = mixed(docs).filter("copies > 0")
    epoch = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("epoch")
    return taken.select("row", epoch).select("row.*", F.col("epoch").alias("mix_epoch"))


STAGES = [
    ("quality_rules", drop_repetitive),
    ("simhash_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
]

#: The first and the third stage have no practical SQL; tests hold every stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
