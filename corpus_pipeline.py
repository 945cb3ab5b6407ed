"""The corpus pipeline: STAGES over documents, each written and read again by run()."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carrel.llm import language, packing, quality, sentences, simhash
from carrel.llm.common import table, written


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: one row for each piece of each document, as packing.pack_documents() has it.

    A null text is one piece of one end mark; rows without an id or with equal ids are documents of their own;
    an empty table gives no pieces; columns other than doc_id and text are left out.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality.keep_good),
    ("language id", language.keep_identified),
    ("simhash near-dedup", simhash.keep_first),
    ("substring dedup", sentences.drop_repeats),
    ("best-fit packing", pack),
]

#: The stages use models, tokenizers and graph components that SQL doesn't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written and read again; their docstrings say what they do with odd rows.

    Empty and blank texts go with the first stage; an empty table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
