"""Token ids as flat binary files.

A written corpus is a folder of pairs of files, one pair for each range of document ids:

* ``*.bin``: the ids of all documents one after another, unsigned little-endian integers of 2 bytes if the
  vocabulary allows, else 4; nothing else, so that a reader can map the file and slice it.
* ``*.idx``: 64-bit little-endian integers: a format number, bytes per id, n documents, n + 1 offsets (in ids, from the
  start of this file), then n document ids (a null id is the smallest 64-bit integer).

Tasks write under names of their own, so a task that runs twice leaves a file that nobody refers to. What counts is the
manifest: one row a file, in ascending order of document id, with the prefix sums that turn local offsets into global ones.
"""

from __future__ import annotations

import itertools
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from subsidia.llm.common import in_arrow
from subsidia.llm.pretokens import CACHE_ENTRIES, Pieces

FORMAT = 1
NO_ID = -(2**63)
MANIFEST = T.StructType([T.StructField(n, T.StringType() if n == "file" else T.LongType()) for n in ("part", "file", "n_docs", "n_tokens", "doc_base", "token_base")])


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", entries: int = CACHE_ENTRIES) -> DataFrame:
    """Encode every whole text, append ``end_id`` to each, write the files and return the manifest.

    Documents go by range of ``doc_id`` (nulls first, equal ids by text, repeated rows kept), so each partition holds
    one interval and streams it into one file. Null and empty texts are documents of the end id alone. An empty table
    gives an empty manifest. Other columns are ignored. ``entries`` is the size of a generation of a worker's cache.
    """
    spark = docs.sparkSession
    width = 2 if max(Pieces.of(tokenizer).vocab_size, end_id + 1) <= 2**16 else 4

    def write(batches):
        import numpy as np
        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        pieces = Pieces.of(tokenizer)
        kind = f"<u{width}"
        packed = lambda ids: np.array(ids, kind).tobytes()
        end, store, at, out = packed([end_id]), None, None, None
        part, name = TaskContext.get().partitionId(), ""
        lengths, keys = [0], []
        for batch in batches:
            cache = pieces.cache(f"bytes{width}", packed, entries)
            if batch.num_rows and out is None:
                store, at = fs.FileSystem.from_uri(folder)
                store.create_dir(at, recursive=True)
                name = f"ids-{part:06d}-{uuid.uuid4().hex[:12]}"
                out = store.open_output_stream(f"{at}/{name}.bin")
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                cut = pieces.cut(t or "")
                data = (b"".join(map(cache.__getitem__, cut)) if cut is not None else packed(pieces.ids(t))) + end
                out.write(data)
                lengths.append(len(data) // width)
                keys.append(NO_ID if key is None else key)
        if out is None:
            return
        out.close()
        with store.open_output_stream(f"{at}/{name}.idx") as idx:
            idx.write(np.array([FORMAT, width, len(keys)], "<i8").tobytes())
            idx.write(np.cumsum(lengths, dtype="<i8").tobytes())
            idx.write(np.array(keys, "<i8").tobytes())
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_docs": [len(keys)], "n_tokens": [sum(lengths)]})

    dealt = docs.select(doc_id, text).repartitionByRange(doc_id).sortWithinPartitions(doc_id, text)
    # One row a file comes back, whatever the number of documents.
    parts = sorted(in_arrow(dealt, write, "part long, file string, n_docs long, n_tokens long").collect())
    doc_base = itertools.accumulate((p.n_docs for p in parts), initial=0)
    token_base = itertools.accumulate((p.n_tokens for p in parts), initial=0)
    rows = [(p.part, p.file, p.n_docs, p.n_tokens, d, t) for p, d, t in zip(parts, doc_base, token_base, strict=False)]
    manifest = spark.createDataFrame(rows, MANIFEST)
    manifest.coalesce(1).write.parquet(f"{folder.rstrip('/')}/manifest")
    return manifest


def mapped(store, path: str):
    """The bytes of a file: mapped where it is local, else read through its store."""
    import pyarrow as pa
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    with store.open_input_file(path) as f:
        return f.read_buffer()


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row a document, from the files: doc_id, start, n_tokens, ids_crc32 (of the ids as 32-bit integers)."""
    rows = [tuple(r) for r in spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest").orderBy("part").collect()]

    def read(batches):
        import numpy as np
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for i in batch.column(0).to_pylist():
                _, name, n, _, _, base = rows[i]
                store, at = fs.FileSystem.from_uri(folder)
                idx = np.frombuffer(mapped(store, f"{at}/{name}.idx"), "<i8")
                kind, offsets, keys = f"<u{idx[1]}", idx[3 : 4 + n], idx[4 + n :]
                ids = np.frombuffer(mapped(store, f"{at}/{name}.bin"), kind)
                for lo in range(0, n, 10_000):
                    hi = min(n, lo + 10_000)
                    crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in itertools.pairwise(offsets[lo : hi + 1])]
                    yield pa.RecordBatch.from_arrays([pa.array(keys[lo:hi], mask=keys[lo:hi] == NO_ID), pa.array(offsets[lo:hi] + base), pa.array(np.diff(offsets[lo : hi + 1])), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = spark.range(0, len(rows), 1, max(1, len(rows)))
    return in_arrow(files, read, "doc_id long, start long, n_tokens long, ids_crc32 long")
