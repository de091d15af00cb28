"""Token counts by a map-side lookup in two tiers.

Tier 1 is a broadcast table of the most frequent pre-tokens with their lengths in tokens. Tier 2 is a cache in each
Python worker, filled by the tokenizers library on a miss. Documents are counted where they are read; the frequent words
are counted over all documents, so only counts of words are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsidia.llm.common import in_arrow, spread
from subsidia.llm.pretokens import MANY_ENTRIES, Pieces

#: Rows of the broadcast table: under 4 MB, whatever the size of the corpus.
FREQUENT = 65_536
#: Longer words stay out of it, which bounds the table in bytes too.
FREQUENT_CHARS = 32


def frequent_words(docs: DataFrame, text: str = "text", size: int = FREQUENT) -> list[str]:
    """The ``size`` most frequent space-separated words of all documents, of at most ``FREQUENT_CHARS`` characters, ties by word.

    They guide a cache and decide nothing else. ``size`` short words reach the driver.
    """
    words = docs.select(F.explode(F.split(text, " ", -1)).alias("w")).filter(F.length("w").between(1, FREQUENT_CHARS))
    counts = words.groupBy("w").agg(F.count("*").alias("n"))
    return [r["w"] for r in counts.orderBy(F.desc("n"), "w").limit(size).collect()]


def count_tokens(docs: DataFrame, tokenizer: str, keep: list[str] | None = None, text: str = "text", limit: int = 1024, frequent: int = FREQUENT) -> DataFrame:
    """``keep`` columns (default: doc_id) with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    Whole texts are counted as the library does it without added special tokens; special strings inside a text count
    as the library's default has it. A null or empty text has 0 bytes and 0 tokens. Rows are returned one for one,
    repeated rows and null keys included; an empty table gives an empty table; other columns are ignored.
    """
    keep = keep or ["doc_id"]
    pieces = Pieces.of(tokenizer)
    docs = spread(docs.select(*keep, text))
    words = [" " + w for w in frequent_words(docs, text, frequent)]
    first = docs.sparkSession.sparkContext.broadcast({w: len(pieces.ids(w)) for w in words if pieces.cut(w) == [w]})

    def count(batches):
        import pyarrow as pa

        pieces = Pieces.of(tokenizer)
        misses = pieces.cache("length", len, MANY_ENTRIES)
        tiers = _Tiers(first.value, misses)
        for batch in batches:
            pieces.cache("length", len, MANY_ENTRIES)  # keeps its bound
            out, sizes = [], []
            for t in batch.column(len(keep)).to_pylist():
                t = t or ""
                cut = pieces.cut(t)
                out.append(sum(map(tiers.__getitem__, cut)) if cut is not None else len(pieces.ids(t)))
                sizes.append(len(t.encode()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(sizes, pa.int64()), pa.array(out, pa.int64()), pa.array([n > limit for n in out], pa.bool_())], names=[*keep, "n_bytes", "n_tokens", "over_limit"])

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return in_arrow(docs, count, schema)


class _Tiers(dict):
    """The broadcast table in front of the worker's cache."""

    def __init__(self, first: dict, second: dict):
        super().__init__(first)
        self.second = second

    def __missing__(self, piece):
        return self.second[piece]


def total(counts: DataFrame, by: Column | str) -> DataFrame:
    """Documents, bytes and tokens for each value of ``by``."""
    return counts.groupBy(by).agg(F.count("*").alias("n_docs"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"))
