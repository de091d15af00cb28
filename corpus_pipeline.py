"""From raw documents to token files in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from subsidia.llm import decontamination, mixing, near_duplicates, quality, token_files
from subsidia.llm.common import shared_dir, staged, table
from subsidia.llm.queries import tokenizer


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the compression classifier, learnt from the labels outside the held-out fifth, scores below 0.3.

    Null and empty texts are scored like others, by features of 0. Without labels of both classes nothing is rejected. Repeated rows
    fare alike.
    """
    return quality.keep_good(docs, quality.fit_held_in(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words, similarity from 0.8.

    The smallest id stays; a null id is larger than any other. Documents without words stay. Rows repeated as a whole become one.
    """
    return near_duplicates.keep_one(docs, n=5, percent=80)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with up to a tenth of its characters edited, go.

    Null and empty texts hold none and stay; blank items are left out.
    """
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), rate=0.1)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight 5, 2, 1 in turn, at most three copies of a document.

    A null source is a source, the last one. Documents without words come as often as the whole copies of their source. Equal rows
    share one decision.
    """
    return mixing.mix(docs, weights=(5, 2, 1), cap=3.0)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns their rows: doc_id, start, n_tokens, ids_crc32.

    Null and empty texts are the end id alone; copies of a document follow one another; null ids come first.
    """
    folder = shared_dir(spark, "token-files")
    token_files.write_token_files(docs, folder, tokenizer("word_bpe_49k.json"), end_id=1)
    return token_files.read_token_files(spark, folder)


STAGES = [
    ("quality classifier", good_quality),
    ("near-duplicates", without_near_duplicates),
    ("benchmark decontamination", without_benchmarks),
    ("source mixing", mixed),
    ("token files", token_ids),
]

#: The classifier, the MinHash bands and the tokenizer have no counterpart in SQL; tests/llm/test_pipeline.py compares
#: each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, name.replace(" ", "-"))
    return docs
