"""MinHash near-duplicates against brute force over all pairs."""

import itertools
import random

import pytest

from subsidia.llm import near_duplicates as nd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bands string"


def brute(rows, n, percent):
    sets = []
    for _, text in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(None) if text else []
        k = min(n, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), float("inf")), d)
    return sorted((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed, groups, copies):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    rows = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.randint(1, 90))
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 6))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("large", "n", "groups", "copies"), [(24, 2, 40, 6), (2, 2, 6, 40), (3, 5, 5, 50)])
def test_equals_brute_force(spark, monkeypatch, large, n, groups, copies):
    monkeypatch.setattr(nd, "LARGE", large)
    rows = corpus(n + copies, groups, copies)
    rows += [(5_000, None), (5_001, ""), (5_002, " \n"), (5_003, "One"), (5_004, "oNE"), (5_005, "É x y"), (5_006, "é x y")]
    df = spark.createDataFrame([(d, t, None, None, None, "x") for d, t in rows], SCHEMA)
    got = sorted(tuple(r) for r in nd.near_duplicates(df, n, 80).collect())
    assert got == brute(rows, n, 80)


def test_repeated_rows_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, long), (1, long), (2, long + " end"), (None, long), (None, "other text here"), (3, "a b c"), (3, "d e f")]
    df = spark.createDataFrame([(d, t, None, None, None, "x") for d, t in rows], SCHEMA)
    got = nd.near_duplicates(df, 5, 80).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {(1, 1, True), (2, 1, False), (None, 1, False), (None, None, True), (3, 3, True)}
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in nd.keep_one(df, 5, 80).collect())
    assert (1, long) in kept and kept.count((1, long)) == 1 and (2, long + " end") not in kept
    assert (3, "a b c") in kept and (3, "d e f") in kept and (0, "other text here") in kept


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert nd.near_duplicates(df).count() == 0
    assert nd.keep_one(df).count() == 0


def test_a_very_long_text(spark):
    text = " ".join(f"v{i % 30011}" for i in range(200_000))
    df = spark.createDataFrame([(1, text, "", "", 1, ""), (2, text + " more", "", "", 1, "")], SCHEMA)
    assert [tuple(r) for r in nd.near_duplicates(df, 5).orderBy("doc_id").collect()] == [(1, 30011, 1, True), (2, 30012, 1, False)]
