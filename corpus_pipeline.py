"""A corpus pipeline over ``documents``: language, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's docs. All
but the last return the columns of ``documents``; the last returns the pieces of the packed documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import language_id, minhash, packing, pii
from marketlens.llm.common import written
from marketlens.session import apply_job_conf

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text stays if the language that the model predicts for it is at least this probable.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents without a letter, of no language with a probability of LEAST_SCORE or more, or unlike the language go.

    The model learns from the labelled rows of ``docs`` that are not held out, and so does the least fit of each language, which all
    these rows have. A document whose language is certain and that fits it stays, whatever its own label says.
    """
    apply_job_conf(spark)
    docs = docs.select(*COLUMNS)
    rows = language_id.training_rows(docs)
    model = language_id.train(rows)
    least = F.lit(None).cast("double")
    for lang, fit in language_id.least_fits(rows, model).items():
        least = F.when(F.col("lang_pred") == lang, fit).otherwise(least)
    judged = language_id.predict(docs, model, with_fit=True)
    return judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE) & (F.col("fit") >= least)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each group of near-duplicates the row with the smallest id stays, a row without id only where the group has no id.

    Decisions are taken by row: of rows that share id and words one stays, and different texts under one id stay or go each for itself.
    """
    apply_job_conf(spark)
    return minhash.representatives(docs.select(*COLUMNS))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: personal data in the texts become pseudonyms; n_chars follows the new text, where it was known."""
    clean = pii.pseudonymize(docs.select(*COLUMNS), pii.key_of(spark))
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the documents' pieces, packed into sequences of at most 4096 tokens."""
    import public_tokenizers

    apply_job_conf(spark)
    pieces = packing.tokenized_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), added_tokens=True)
    return packing.pack(written(pieces, "pipeline-pieces"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("packing", pack_sequences),
]

#: Weighted MinHash groups, hashed pseudonyms and BPE ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each one's result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
