"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and all that the stage before kept, and
returns a DataFrame; ``run`` writes each as Parquet in the shared folder and
reads it again as the next one's documents. All stages but the last return the
columns of ``documents``. Null texts count as empty, and an empty table passes
through as one.

The rows depend on fitted models, so there is no SQL for them; ``tests/llm``
compares each stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import mixing, packing, quality, simhash
from tillroll.llm.common import materialize, table

# Clean text of a language is to have its size to this power, against the largest: at 1 all stays as
# it is, at 0 all are alike. Bad and toxic text has no share: no stage may bring it up to one.
LANGUAGE_POWER = 0.7
MOST_COPIES = 4.0   # of a document, where a language is so small that its share would ask for more


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier does not grade as good and clean go."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (four words, four bits)."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its fitted rate says: clean text of smaller
    languages up to their shares, bad and toxic text out, no clean document lost."""
    # Fitted to all documents: few of the bad and toxic ones are left here.
    all_docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    if "lang" not in docs.columns:
        docs_of, marked = docs.withColumn("lang", F.lit(None).cast("string")), labels.withColumn("lang", F.lit(None).cast("string"))
    else:
        langs = all_docs.groupBy("doc_id").agg(F.min("lang").alias("lang"))
        docs_of, marked = docs, labels.drop("lang").join(langs, "doc_id")
    shares, domain, anchor = mixing.clean_parts(docs_of, "lang", LANGUAGE_POWER)
    model = mixing.fit(all_docs, marked, domain=domain, n=len(shares))
    return mixing.mixed(docs, model, shares, anchor, most=MOST_COPIES, whole=tuple(shares)[2:])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    return packing.pack_documents(docs, "byte_bpe_50k.json", end_id=1, capacity=2048)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing_to_targets", mixing_to_targets),
    ("pack_sequences", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
