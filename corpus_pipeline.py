"""A training corpus from raw documents: five stages, each over all that the one before it kept.

1. toxicity: documents that score 0.5 or more go.
2. line dedup: lines that ten or more sources share stay only in the document of smallest ID; documents of which
   nothing is left go.
3. near dedup: one document of each group of near copies (equal five-word shingles, 0.8 or more) stays.
4. decontamination: passages that match benchmark windows of ten words are cut out; documents of which nothing is left go.
5. packing: the texts become token sequences of 2048 with lexically near documents beside each other.

All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm import toxicity as toxic_models
from fareline.llm.fm_index import remove_leaks
from fareline.llm.line_dedup import remove_boilerplate
from fareline.llm.minhash import near_duplicates
from fareline.llm.packing import pack
from fareline.session import new_path, pin


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Models learn from all labelled documents that are not held out (crc32 of the ID modulo 5 is 0)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learnt_from = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = toxic_models.train(docs, labels.where(learnt_from))
    return toxic_models.score(docs, model).where("score < 0.5").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_boilerplate(docs, keep_first=True, drop_empty=True).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an ID belong to no group and stay; of rows of equal ID and text one stays."""
    gone = near_duplicates(docs, percent=80).where(~F.col("kept")).select("doc_id").distinct()
    rest = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = pin(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return rest
    once = rest.join(repeated, "doc_id").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return rest.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end=1)


STAGES = [
    ("toxicity", toxicity), ("line_dedup", line_dedup), ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination), ("packing", packing),
]

#: The toxicity models, the links of near copies and the packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each keeps is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
