"""A training corpus from documents, in five stages, each on all that the one before it kept.

Documents whose text is unlike trusted text go; of near duplicates one stays; documents that hold benchmark text go; sources
are mixed to their target weights, so a document may then occur up to three times; what is left is written as token ids and
read back. Every stage is written as Parquet into the shared folder and read again, which also cuts its lineage; a stage's
table is removed when the next one is written. The token files stay.

Empty and null texts pass the quality stage, are one group of near duplicates, hold no benchmark text and have size 0, so the
mix takes them by whole rounds only. Of near duplicates the row of the smallest doc_id stays, of several the one whose text has
the smallest hash; of rows that tie in the mix the planned number is taken. A row that the mix takes several times is written as
often, each time with its doc_id. Texts of any length go through whole. Columns that are not of ``documents`` pass through all stages but the last. An
empty table gives an empty one.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scrubline.llm import decontaminate, kneser_ney, mixing, simhash, token_shards
from scrubline.llm.common import fresh_dir, remove, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kneser_ney.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, read back from the token files."""
    return token_shards.round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing_to_weights),
    ("token-ID output", token_output),
]

# The model, the fingerprints, the seeded draws and the tokenizer have no SQL form; tests hold the stages against
# brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    directory = fresh_dir(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{directory}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if i:
            remove(spark, f"{directory}/{i - 1}")
    tokens = STAGES[-1][1](spark, docs, sf_dir)  # the files are written here; reading them needs no stage's table
    remove(spark, directory)
    return tokens
