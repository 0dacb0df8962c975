"""A training corpus from raw documents: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the
columns of docs. Toxic documents go, then near duplicates (80 % of five-word shingles) but
for one of each group, then documents contaminated by the benchmark, and the benchmark's
passages from the others; personal data becomes pseudonyms; at the end each text is encoded
to pieces and decoded again. Clean documents are kept unchanged.

Nulls, empty and repeated rows, and an empty table are treated as each operator says;
columns whose names clash with a column that an operator adds come through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm import decontaminate, minhash, pieces, pseudonyms, toxicity
from airshed.llm.tables import drop, read_table, written

SIMILARITY = 80  # percent, of near duplicates


def _beside(docs: DataFrame, name: str, step) -> DataFrame:
    """step(docs) where it adds a column `name`: docs' own column of that name is kept."""
    if name not in docs.columns:
        return step(docs).drop(name)
    return step(docs.withColumnRenamed(name, f"own {name}")).drop(name).withColumnRenamed(f"own {name}", name).select(*docs.columns)


def _counted(docs: DataFrame, out: DataFrame) -> DataFrame:
    """n_chars as the text now has them, in the column's own type."""
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return _beside(docs, "score", lambda d: toxicity.score(d, model).filter(F.col("score") < toxicity.CUT))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.without_near_duplicates(docs, percent=SIMILARITY)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(docs, decontaminate.without_contamination(docs, read_table(spark, sf_dir, "benchmark")))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(docs, _beside(docs, "n_replaced", pseudonyms.pseudonymise))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs' columns, ids and round_trip (the ids decode to the text)."""
    out = pieces.both_ways(docs)
    same = F.col("decoded").eqNullSafe(F.replace(F.col("text").cast("string"), F.lit("▁"), F.lit(" ")))
    return out.withColumn("round_trip", same).drop("decoded")


STAGES = [
    ("toxicity", remove_toxic),
    ("minhash_near_dedup", remove_near_duplicates),
    ("benchmark_decontamination", remove_contaminated),
    ("pii_pseudonyms", replace_personal_data),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL = None  # no SQL for the classifier; tests/llm/test_corpus_pipeline.py compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            drop(before)
        before = docs
    return docs
