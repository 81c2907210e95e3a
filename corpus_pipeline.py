"""A corpus pipeline over ``documents``: five stages, each written as Parquet and read by the next.

Language ID drops documents whose language is not known well enough; of near-duplicates one stays;
secrets are blacked out; sources are mixed to their target weights, so documents may repeat or go;
what is left is packed into sequences. All stages but the last return the columns of ``documents``.

The stages take any extra columns along. Null and empty texts have no language and go in the first
stage; a later stage that is run by itself treats them as its operator says.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import langid, mixing, neardup, packing, secrets
from tradewind.llm.queries import language_model, vocabulary
from tradewind.sinks.shared import shared_dir

# Language ID is a fitted model, so there is no SQL for the rows.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected, with the columns they came with."""
    name = "language"
    while name in docs.columns:
        name += "_"
    predicted = langid.predict(docs, language_model(docs), out=name)
    return predicted.filter(~F.col(name)["rejected"]).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return neardup.kept_documents(docs)


def black_out_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets replaced by their kind."""
    return secrets.redact(docs, secrets.find_secrets(docs.select("doc_id", "text")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate says, by one draw for each."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: its sequence and place there."""
    return packing.pack(docs.select("doc_id", "text"), vocabulary())


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", black_out_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        place = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
