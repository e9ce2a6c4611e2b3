"""The corpus pipeline: documents -> packed token sequences.

Stages, each over all rows that the one before has kept:

1. language ID: rows whose text no learned language accepts go;
2. line dedup: runs of lines with 50 words or more that occur earlier are cut out of the texts;
3. SimHash near-dedup (three-word shingles, up to three bits): the document with the smallest id of each group stays;
4. PII: personal data is replaced by its kind, also where it was disguised;
5. packing into sequences of up to 4096 tokens.

All stages but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import language_id, line_dedup, packing, pii, simhash
from tidemark.llm.common import saved, table, tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted(docs, language_id.learn(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("pii", redact_pii),
    ("packing", pack),
]
# tokenizing, hashing and the language models are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
