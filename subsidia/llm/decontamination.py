"""Benchmark decontamination by pigeonhole edit matching.

An item may occur in a document with up to k edits, k being a share of its length. Cut into k + 1 pieces, at least one piece
then occurs unchanged. An Aho-Corasick automaton of all pieces finds these hits in whole texts. Around each hit Myers'
bit-parallel algorithm checks ever larger parts of the item, each with its share of the edits, and at last computes the least
edit distance of the item to any passage there. No hit, no work; no document moves.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsidia.llm.common import in_arrow, in_slices

#: Characters of items sent to the workers at once (about 100 bytes each as an automaton); more items go in blocks.
BLOCK_CHARS = 2_000_000
#: Items below so many characters that allow no edit count as whole words only.
WORD_CHARS = 10
#: Letters of scripts that don't put spaces between words: Thai, Lao, Burmese, Khmer, kana and Han.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u312f\u31a0-\ua4cf\uf900-\ufaff\U00020000-\U0003ffff]")


def folded(text: str) -> str:
    """Lower case and plain spaces, character by character, so that positions stay."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    for space in "\n\t\r\x0b\x0c\x85\xa0":
        low = low.replace(space, " ")
    return low


def piece_tree(a: int, b: int, k: int) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
    """The k + 1 pieces of the interval a .. b, each with the larger intervals around it as (start, end, budget), smallest first.

    An interval with at most k edits is split so that one of its halves keeps at most its own share of them, the two shares
    and one more making k. So a piece that is found counts only if each interval around it is found within its budget too.
    """
    if k == 0 or b - a < 2:
        return [(a, b, [])]
    left = (k - 1 + 1) // 2
    right = k - 1 - left
    middle = a + (b - a) * (left + 1) // (k + 1)
    return [(x, y, [*around, (a, b, k)]) for x, y, around in piece_tree(a, middle, left) + piece_tree(middle, b, right)]


def myers(pattern: str, text: str, k: int, masks: dict[str, int] | None = None) -> tuple[int, int] | None:
    """(distance, end) of the passage of ``text`` nearest to ``pattern``, first such end; None if beyond k edits."""
    m = len(pattern)
    masks = masks or letter_masks(pattern)
    all_bits, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = all_bits, 0, m, None
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | minus
        d = (((x & plus) + plus) ^ plus) | x
        hp, hm = minus | (all_bits & ~(d | plus)), plus & d
        if hp & top:
            score += 1
        elif hm & top:
            score -= 1
        hp, hm = (hp << 1) & all_bits, (hm << 1) & all_bits
        plus, minus = hm | (all_bits & ~(d | hp)), hp & d
        if score <= k and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


def occurs(masks: dict[str, int], m: int, text: str, k: int) -> bool:
    """Whether some passage of ``text`` is within k edits of the pattern of m letters; stops at the first."""
    all_bits, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = all_bits, 0, m
    left = len(text)
    for c in text:
        eq = masks.get(c, 0)
        d = ((((eq | minus) & plus) + plus) ^ plus) | eq | minus
        hp, hm = minus | (all_bits & ~(d | plus)), plus & d
        if hp & top:
            score += 1
        elif hm & top:
            score -= 1
            if score <= k:
                return True
        left -= 1
        if score - k > left:
            return False
        hp <<= 1
        plus, minus = (hm << 1 & all_bits) | (all_bits & ~(d | hp)), hp & d & all_bits
    return score <= k


def letter_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether start .. end neither begins nor ends inside a word. Scripts without spaces have no such places."""
    inside = lambda i: 0 < i < len(text) and all(c.isalnum() and not UNSPACED.match(c) for c in text[i - 1 : i + 1])
    return not inside(start) and not inside(end)


class Matcher:
    """Finds items in texts. ``items``: (id, folded text, k). Items without edits below ``word_chars`` characters must be whole words."""

    def __init__(self, items: list[tuple[int, str, int]], word_chars: int = 0):
        import ahocorasick

        self.word_chars = word_chars
        self.items = [(i, t, k, letter_masks(t), letter_masks(t[::-1])) for i, t, k in items]
        own: dict[str, list[tuple[int, int, list]]] = {}
        for n, (_, t, k, *_rest) in enumerate(self.items):
            for a, b, around in piece_tree(0, len(t), k):
                larger = [(x, y, e, letter_masks(t[x:y])) for x, y, e in around[:-1]]
                own.setdefault(t[a:b], []).append((n, a, larger))
        self.automaton = ahocorasick.Automaton()
        for piece, places in own.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end): the nearest passage for each item found, the first of equals."""
        text = folded(text)
        found: dict[int, tuple[int, int, int]] = {}
        seen: set[tuple[int, int]] = set()  # (item, number of a searched stretch)
        for last, (n, places) in self.automaton.iter(text):
            for item, offset, larger in places:
                start = last - n + 1 - offset
                _, t, k, masks, back = self.items[item]
                m = len(t)
                # Hits with their windows' beginnings in the same stretch share a search, which holds each of these windows whole.
                share = 2 * k + 1
                lo = (start - k) // share * share
                hi = min(len(text), lo + share + m + 2 * k)
                if min(len(text), start + m + k) - max(0, start - k) < m - k or found.get(item, (1,))[0] == 0 or (item, lo) in seen:
                    continue
                if k == 0 and m < self.word_chars and not whole_words(text, start, start + m):
                    continue
                if not all(occurs(w, y - x, text[max(0, start + x - e) : max(0, start + y + e)], e) for x, y, e, w in larger):
                    continue
                if text.startswith(t, start) and start >= 0:
                    found[item] = (0, start, start + m)
                    continue
                seen.add((item, lo))
                lo = max(0, lo)
                got = myers(t, text[lo:hi], k, masks)
                if got and (item not in found or (got[0], lo + got[1]) < (found[item][0], found[item][2])):
                    end = lo + got[1]
                    start = end - myers(t[::-1], text[max(lo, end - m - k) : end][::-1], k, back)[1]
                    found[item] = (got[0], start, end)
        return [(self.items[i][0], *x) for i, x in sorted(found.items())]


def item_blocks(benchmark: DataFrame, rate: float, least: int, block_chars: int):
    """Lists of (id, folded text, k). Null and blank items, and those below ``least`` characters, are left out."""
    items = benchmark.select("item_id", "text").filter(F.length("text") >= least).dropDuplicates()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        own = [(r["item_id"], folded(r["text"]).strip()) for r in rows]
        yield sorted(((i, t, int(rate * len(t))) for i, t in own if len(t) >= least), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def contaminations(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, least: int = 1, keep: str = "doc_id", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, start, end): for each document and item the nearest passage within the budget.

    Positions are code points of the original text. Texts are searched whole; null and empty texts hold nothing. Repeated
    documents are each reported, repeated items once. Empty tables give an empty table.
    """
    schema = T.StructType([docs.schema[keep], benchmark.schema["item_id"], *[T.StructField(c, T.IntegerType()) for c in ("distance", "start", "end")]])
    out = None
    for items in item_blocks(benchmark, rate, least, block_chars):
        one = in_arrow(docs.select(keep, "text"), _finder(docs.sparkSession.sparkContext.broadcast(items), keep), schema)
        out = one if out is None else out.unionByName(one)
    return out


def _finder(sent, keep):
    def run(batches):
        import pyarrow as pa

        matcher = Matcher(sent.value, WORD_CHARS) if sent.value else None
        for batch in in_slices(batches):
            rows = [(k, *hit) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if matcher and t for hit in matcher.find(t)]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [batch.schema.field(0).type, pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[keep, "item_id", "distance", "start", "end"])

    return run


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = 0.1, least: int = 1, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents, all columns, in which no item is found."""
    for items in item_blocks(benchmark, rate, least, block_chars):
        docs = in_arrow(docs, _keeper(docs.sparkSession.sparkContext.broadcast(items), docs.columns.index("text")), docs.schema)
    return docs


def _keeper(sent, at):
    def run(batches):
        import pyarrow as pa

        matcher = Matcher(sent.value, WORD_CHARS) if sent.value else None
        for batch in in_slices(batches):
            yield batch.filter(pa.array([not (matcher and t and matcher.find(t)) for t in batch.column(at).to_pylist()], pa.bool_()))

    return run
