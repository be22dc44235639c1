"""Training corpus from raw documents, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next stage's documents. All but the last return the columns
of ``docs``, extra ones included; the last returns the pieces of the packed sequences.
An empty table passes every stage and packs into nothing; what null and empty texts,
ties and repeated rows give is stated by the operator of each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.llm.bitsets import membership
from costlens.llm.mixing import sample_mixture
from costlens.llm.neardup import near_duplicates
from costlens.llm.packing import pack_documents
from costlens.llm.pii import mask_personal_data
from costlens.llm.toxicity import reject_toxic
from costlens.session import materialise, scratch_path



def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest ``doc_id``.

    Rows without ``doc_id`` are all kept. Of rows that repeat a kept ``doc_id`` one is
    kept for each text, null text included; texts of one id are not compared with each
    other, and an id linked to a smaller one goes with all its texts.
    """
    key = F.col("doc_id").cast("long")
    marked = near_duplicates(docs, width=5, percent=80).filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
    # Ids that go, and kept ones of several rows; documents of all other ids stay where they are.
    odd = materialise(marked.agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).filter("NOT kept OR n > 1"))
    repeated = odd.filter("kept").select("id")
    may_be_odd, may_repeat = (membership(ids.select(F.xxhash64("id").alias("key")))(F.xxhash64(key)) for ids in (odd, repeated))
    sure = docs.filter(key.isNull() | ~may_be_odd)
    single = docs.filter(key.isNotNull() & may_be_odd).join(odd, key == odd["id"], "left_anti")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    several = docs.filter(key.isNotNull() & may_repeat).select(row, key.alias("id"), F.col("text").cast("string").alias("text")).join(repeated, "id", "left_semi")
    first = several.groupBy("id", "text").agg(F.first("row").alias("row")).select("row.*")
    return sure.unionByName(single).unionByName(first)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; ``n_chars`` follows the text."""
    masked = mask_personal_data(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of nine tenths of all tokens, drawn towards the raked weights.

    So large a sample cannot meet them; see ``mix_sources`` and the README.
    """
    return sample_mixture(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near duplicates", near_duplicate_removal),
    ("personal data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

# A label model and a tokenizer are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
