"""Packing against a plain restatement, and rows that are hard to handle."""

import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from subsidia.llm import packing

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, length long, ids string, sequence_id string, full string, row string, piece string"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, 1, "i", "s", "f", "r", "p") for d, t in rows], SCHEMA)


def cut_plainly(rows, path, capacity, end):
    lib = Tokenizer.from_file(path)
    out = []
    for d, t in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, end]
        head, parts = len(ids) % capacity, []
        if head:
            parts.append(ids[:head])
        parts += [ids[i : i + capacity] for i in range(head, len(ids), capacity)]
        at = 0
        for k, p in enumerate(parts):
            out.append((d, k, at, len(p), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in p))))
            at += len(p)
    return out


def test_pieces_and_places(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["a", "bé", "longer", "naïve", "12", "🙂"], k=rng.choice([0, 1, 5, 15, 40, 300])))) for i in range(120)]
    rows += [(None, "no id"), (None, None), (7, ""), (7, ""), (8, "x" * 20_000), (9, "<|endoftext|> inside")]
    for path, capacity, end, group in ((BYTES, 16, 2, 40), (WORDS, 64, 1, 1000)):
        packed = packing.pack(documents(spark, rows), path, capacity=capacity, end_id=end, group_pieces=group)
        got = packing.ids_crc32(packed, packing.id_bytes(path, end)).collect()
        key = lambda r: tuple(-1 if x is None else x for x in r)
        assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=key) == sorted(cut_plainly(rows, path, capacity, end), key=key)
        by = {}
        for r in got:
            by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for placed in by.values():
            at = 0
            for offset, length in sorted(placed):
                assert offset == at
                at += length
            assert at <= capacity
        whole = packing.sequences(packed).collect()
        assert len(whole) == len(by) and sum(r["length"] for r in whole) == sum(r["length"] for r in got)
        assert all(len(r["ids"]) == r["length"] * packing.id_bytes(path, end) and sum(p["length"] for p in r["pieces"]) == r["length"] for r in whole)
    assert packing.pack(documents(spark, []), BYTES).count() == 0


def plain_sum_of_squares(lengths, capacity):
    """Every placement tried, the sum of squares counted anew for each."""
    gaps, out = [], []
    for s in lengths:
        best = None
        for b, g in enumerate(gaps):
            if g >= s:
                n = Counter(x for i, x in enumerate(gaps) if i != b and x)
                n[g - s] += g > s
                cost = sum(v * v for v in n.values()), g
                if best is None or cost < best[0]:
                    best = cost, g
        if best is None:
            gaps.append(capacity - s)
            out.append(capacity)
        else:
            gaps[gaps.index(best[1])] -= s
            out.append(best[1])
    return out, len(gaps)


@pytest.mark.parametrize("seed", range(4))
def test_rule_equals_trying_every_place(seed):
    rng = random.Random(seed)
    capacity = 24
    lengths = [rng.randint(1, 23) for _ in range(80)]
    if seed % 2:
        lengths.sort(reverse=True)
    gaps, n = plain_sum_of_squares(lengths, capacity)
    got = packing.sum_of_squares(lengths, capacity)
    assert [capacity - offset for _, offset in got] == gaps and len({s for s, _ in got}) == n


def test_few_sequences(spark):
    rng = random.Random(1)
    lengths = sorted((rng.randint(1, 1023) for _ in range(3000)), reverse=True)
    least = -(-sum(lengths) // 1024)
    assert len({s for s, _ in packing.sum_of_squares(lengths, 1024)}) <= least + 3
