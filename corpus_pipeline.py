"""Raw documents to token ids: each stage reads what the one before it kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the
columns of documents. Every result is written as Parquet in the shared folder and read
again, so a stage starts from a table and no lineage runs across stages. Tables such as
labels are read from ``sf_dir``. An empty table goes through all stages.
"""

from pyspark.sql import DataFrame, SparkSession

from subscope.llm import bpe, common, jaccard, mixing, quality_rules, secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the isolation forest reject go."""
    return quality_rules.kept_documents(docs, common.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, 0.8 or more."""
    return jaccard.without_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text."""
    return secrets.masked(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as the rates for the target weights say."""
    return mixing.taken(docs, common.table(spark, sf_dir, "labels"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text they decode to."""
    return bpe.digests(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", encoding),
]

# Forest, secret models and rates are fitted, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, on the documents table."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.checkpointed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
