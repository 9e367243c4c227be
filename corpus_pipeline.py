"""From raw documents to packed training sequences.

Every stage takes the documents that the one before it kept, from the table that was written of
them, and returns a table with the same columns; the last one returns the packed pieces.

| stage | what becomes of a document |
| --- | --- |
| toxicity | dropped if the grammar scores it 0.5 or more |
| near_dedup | dropped if its SimHash group holds a document with a smaller id |
| pii | personal data in its text is masked, and ``n_chars`` brought up to date |
| mixing | kept with the probability of its source, language and topic, ``MIXED`` of all tokens |
| packing | cut and packed into sequences of 2048 tokens |

Null texts, missing ids, repeated rows, empty tables and additional columns pass through as each
operator states. The toxicity stage also reads ``labels`` in the folder of the tables.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.llm import mixing, packing, pii, simhash
from noteloom.llm import toxicity as toxic
from noteloom.llm.common import configure, fresh_name, stored


# Pieces that a worker remembers while it tokenizes: fewer than by default, since the workers go on
# living beside the other stages.
MEMO = 200_000
MIXED = 0.75  # share of the clean tokens that mixing keeps


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxic.learn(docs, configure(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    name = fresh_name(docs, "toxicity")
    scored = docs.withColumn(name, toxic.score(model, F.col("text")))
    return scored.where(F.col(name) < 0.5).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return simhash.without_near_duplicates(docs, "doc_id", "text")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return pii.mask(docs, pii.learn(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return mixing.sample(docs, share=MIXED)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return packing.pack(docs, memo=MEMO)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("pii", personal_data),
    ("mixing", mix),
    ("packing", pack),
]

# Fingerprints, a learned grammar and packing are not expressible; the stages are tested against
# brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each writes its result before the next one reads it."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
