"""From raw documents to packed training sequences, in five stages.

1. ``quality_rules``: documents that the base rule or the learned decision list
   rejects go.
2. ``line_dedup``: of lines that are equal or within two edits of each other
   (one edit under 32 characters) the first stays; documents of which no word is left go.
3. ``near_duplicates``: of documents whose SimHashes are linked at two or fewer
   bits the one with the smallest id stays.
4. ``decontamination``: documents in which a window of a benchmark item occurs go.
5. ``packing``: the texts that are left become sequences of 1024 token ids.

Every stage takes ``(spark, docs, sf_dir)`` and reads all that the one before
has kept.  All but the last return the columns of ``documents``.  Stages are
written as Parquet in the shared checkpoint folder, so a lost executor costs
the tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from campanula.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from campanula.llm.common import read_table
from campanula.llm.queries import default_ranks, default_tokenizer
from campanula.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs, short_chars=line_dedup.SHORT_CHARS, min_share=0.0)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, shingle=3, budget=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), window=10)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, default_tokenizer(), window=1024, separator=0, ranks_file=default_ranks())


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: edit distance, learned rules and token ids have no counterpart in SQL; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all sequences, from the table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = materialize(docs)
    return docs
