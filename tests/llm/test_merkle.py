"""The Merkle manifest against a plain restatement."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from subsidia.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string, pos string, hash string, up string, n string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def levels(nodes):
    """All levels of a tree, each a list of digests."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted(by[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r[0], r[3], r[2], r[4], r[1])))
        trees[lang] = own, levels([leaf(d, s, g, n, t) for d, t, g, s, n in own])
    top = levels([trees[g][1][-1][0] for g in langs])
    root = top[-1][0]
    out = []
    for k, lang in enumerate(langs):
        own, own_levels = trees[lang]
        for i, (d, t, g, s, n) in enumerate(own):
            folded, proof, at = own_levels[0][i], [], i
            if d is not None and zlib.crc32(str(d).encode()) % 3 == 0 and t is not None:
                folded = leaf(d, s, g, n, "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
            for tower, start in ((own_levels, i), (top, k)):
                at = start
                for level in tower[:-1]:
                    run = level[at // 8 * 8 : at // 8 * 8 + 8]
                    proof += run[: at % 8] + run[at % 8 + 1 :]
                    folded = h(*run[: at % 8], folded, *run[at % 8 + 1 :])
                    at //= 8
            out.append((d, own_levels[0][i], own_levels[-1][0], root, h(*proof), folded, folded == root))
    return out


def run(spark, rows, **how):
    docs = spark.createDataFrame([(*r, *["x"] * 6) for r in rows], SCHEMA)
    manifest = merkle.build(merkle.document_leaves(docs), "lang", ["doc_id"], ["doc_id", "tampered"])
    got = merkle.climb(manifest, **how)
    return [tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.text_of(F.col("proof")), 256), "folded", F.col("folded") == F.col("root")).collect()]


KEY = lambda r: tuple("" if x is None else str(x) for x in r)


def rows_of(seed, n, langs):
    rng = random.Random(seed)
    rows = [(i * 3, rng.choice([None, "", "Ab", "abc", "ÀB é", "X" * 3000]) if i % 5 else f"Text {i}", rng.choices(langs, weights=[9, *[1] * (len(langs) - 1)])[0], rng.choice([None, "s", "t"]), rng.choice([None, i])) for i in range(n)]
    return rows + [rows[0], rows[0], (None, "No id", langs[0], "s", 1), (None, "No id", None, None, None)]


@pytest.mark.parametrize("n, langs, top", [(700, ["en", "de", "é", "Z", None], 4096), (700, ["en", "de", None], 12), (60, [f"l{i}" for i in range(70)], 3), (5, ["en"], 0)])
def test_equals_brute_force(spark, n, langs, top):
    rows = rows_of(n, n, langs)
    assert sorted(run(spark, rows, top_nodes=top), key=KEY) == sorted(brute(rows), key=KEY)


def test_one_group_one_row_and_none(spark):
    rows = [(1, "One Row", "en", "s", 7)]
    assert run(spark, rows) == brute(rows)
    rows = [(i, f"T{i}", "en", "s", 7) for i in range(65)]
    assert sorted(run(spark, rows), key=KEY) == sorted(brute(rows), key=KEY)
    assert run(spark, []) == []


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op12_merkle_manifest"](spark, sf)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = c.execute(queries.OP12_SQL).df()
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=KEY) == sorted(want.itertuples(index=False, name=None), key=KEY)
