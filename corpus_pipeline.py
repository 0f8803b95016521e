"""Five stages from raw documents to packed sequences.

Each stage reads what its predecessor kept and drops documents, except the
last, which packs them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from traceloom.llm.decontaminate import drop_contaminated
from traceloom.llm.exact_dedup import keep_first_copies
from traceloom.llm.jaccard_join import keep_one_of_each
from traceloom.llm.packing import pack
from traceloom.llm.queries import tokenizer
from traceloom.llm.toxicity import drop_toxic
from traceloom.session import shared_folder, table

STAGES = [
    ("toxicity", lambda spark, docs, sf_dir: drop_toxic(docs, table(spark, sf_dir, "labels"))),
    ("exact_dedup", lambda spark, docs, sf_dir: keep_first_copies(docs)),
    ("jaccard_join", lambda spark, docs, sf_dir: keep_one_of_each(docs)),
    ("decontamination", lambda spark, docs, sf_dir: drop_contaminated(docs, table(spark, sf_dir, "benchmark"))),
    ("packing", lambda spark, docs, sf_dir: pack(docs, tokenizer("word_bpe_49k.json"), words=100_000)),  # executors still hold what earlier stages took
]

#: The toxicity stage trains a classifier and packing solves a linear program; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
