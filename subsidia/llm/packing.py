"""Token sequences of one length, packed by sums of squares.

A document's ids, its end id included, form one piece; a longer document is cut into pieces of the full length, of which the
first may be shorter. A full piece is a sequence by itself. The others are dealt at random into groups of about
``GROUP_PIECES``, and each group is packed on its own, longest piece first: of the open sequences with room for it, a piece
goes where the sum of the squared numbers of open sequences per gap becomes smallest; a new sequence is opened where none has
room. Packing apart costs about one sequence in some thousands, and no task sees more than a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subsidia.llm.common import in_arrow, spread, staged
from subsidia.llm.pretokens import MANY_ENTRIES, Pieces

#: Pieces packed together, on average: some megabytes of ids.
GROUP_PIECES = 8_192
#: Bits of a sequence's number within its group; a group holds far fewer pieces.
SEQUENCE_BITS = 32


def id_bytes(tokenizer: str, end_id: int) -> int:
    """Bytes of an id in ``ids``: 2 if the vocabulary allows, else 4."""
    return 2 if max(Pieces.of(tokenizer).vocab_size, end_id + 1) <= 2**16 else 4


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: row (a number of its own), doc_id, piece, start, length, ids (little-endian, ``id_bytes`` each).

    Whole texts are encoded; a null or empty one is the end id alone. Repeated rows and null document ids are kept, an empty
    table gives none, and other columns are ignored.
    """
    width = id_bytes(tokenizer, end_id)

    def cut(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        known = Pieces.of(tokenizer)
        kind = f"<u{width}"
        packed = lambda ids: np.array(ids, kind).tobytes()
        end, row = packed([end_id]), TaskContext.get().partitionId() << 33
        for batch in batches:
            cache = known.cache(f"bytes{width}", packed, MANY_ENTRIES)
            out = {n: [] for n in ("row", "doc_id", "piece", "start", "length", "ids")}
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = known.cut(t or "")
                data = (b"".join(map(cache.__getitem__, words)) if words is not None else packed(known.ids(t))) + end
                n = len(data) // width
                ends = range((n - 1) % capacity + 1, n + 1, capacity)
                for piece, to in enumerate(ends):
                    start = max(0, to - capacity) if piece else 0
                    for name, v in zip(out, (row, key, piece, start, to - start, data[start * width : to * width]), strict=True):
                        out[name].append(v)
                    row += 1
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in out]))

    return in_arrow(spread(docs.select(F.col(doc_id).cast("long"), text)), cut, "row long, doc_id long, piece long, start long, length long, ids binary")


def sum_of_squares(lengths, capacity: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each length, taken in the order given: under ``capacity`` each, and best longest first.

    Of the gaps g that can take a piece s, the one with the least growth of the sum of squares, 2 (N(g - s) - N(g)) + 2, is chosen
    (2 - 1 - 2 N(g) where the sequence becomes full, as full ones aren't counted), the smallest of equals.
    """
    import numpy as np

    n_open = np.zeros(capacity + 1)
    n_open[0] = -0.5  # makes the one formula right for a sequence that becomes full
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    places, opened = [], 0
    for s in lengths:
        there = n_open[s:capacity]
        growth = np.where(there > 0, n_open[: capacity - s] - there, np.inf)
        left = int(growth.argmin())
        if growth[left] < np.inf:
            sequence = by_gap[left + s].pop()
            n_open[left + s] -= 1
        else:
            sequence, left = opened, capacity - s
            opened += 1
        if left:
            n_open[left] += 1
            by_gap[left].append(sequence)
        places.append((sequence, capacity - left - s))
    return places


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, group_pieces: int = GROUP_PIECES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents with sequence_id and offset: doc_id, piece, start, length, ids, sequence_id, offset.

    Each sequence is filled from 0 without gaps, up to ``capacity`` at most. Pieces are written to the shared folder first, so that a
    task that runs again finds the same numbers and deals the same groups. Nulls, empty texts, repeated rows and empty
    tables are as in ``pieces``.
    """
    spark = docs.sparkSession
    cut = staged(pieces(docs, tokenizer, capacity, end_id, doc_id, text).withColumn("full", F.col("length") == capacity), "pieces", by="full")
    short, full = cut.filter(~F.col("full")), cut.filter("full")
    groups = -(-short.count() // group_pieces) or 1

    def place(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        table = table.take(pc.sort_indices(table, [("length", "descending"), ("row", "ascending")]))
        got = sum_of_squares(table["length"].to_pylist(), capacity)
        group = table["group"][0].as_py() << SEQUENCE_BITS
        table = table.select(["doc_id", "piece", "start", "length", "ids"])
        table = table.append_column("sequence_id", pa.array([2 * (group | s) for s, _ in got], pa.int64()))
        return table.append_column("offset", pa.array([o for _, o in got], pa.int64()))

    fields = "doc_id long, piece long, start long, length long, ids binary, sequence_id long, offset long"
    placed = short.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups))).groupBy("group").applyInArrow(place, fields)
    alone = full.select("doc_id", "piece", "start", "length", "ids", (2 * F.col("row") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(alone)


def sequences(packed: DataFrame) -> DataFrame:
    """One row a sequence: sequence_id, length, ids, and its pieces (doc_id, piece, length) in order."""
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.expr("listagg(ids) WITHIN GROUP (ORDER BY offset)").alias("ids"),
        F.transform(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length"))), lambda p: F.struct(p["doc_id"], p["piece"], p["length"])).alias("pieces"),
    )


def ids_crc32(packed: DataFrame, width: int) -> DataFrame:
    """Adds ids_crc32: of the ids as little-endian unsigned 32-bit integers; drops ids."""
    names = [c for c in packed.columns if c != "ids"]

    def check(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            crc = [zlib.crc32(np.frombuffer(x.as_buffer(), f"<u{width}").astype("<u4")) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(crc, pa.int64())], names=[*names, "ids_crc32"])

    kinds = dict(packed.dtypes)
    return in_arrow(packed, check, ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", ids_crc32 long")
