"""The five stages of the corpus pipeline on a small corpus with hard rows, each against brute force."""

import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from subsidia.llm import mixing, quality
from tests.llm.test_corpus import HARD, SCHEMA, edit_distance

STAGES = [f for _, f in corpus_pipeline.STAGES]


def texts_of(rng):
    words = ["the", "and", "of", "reading", "nations", "thing", "was", "over"] + [f"w{i}" for i in range(300)]
    good = lambda n: " ".join(rng.choices(words, k=n))
    bad = lambda: " | ".join(f"{w.upper()}!!" for w in rng.choices(["the", "buy", "cheap", "click"], k=40))
    item = " ".join(rng.choices(words, k=12))
    rows = [(good(rng.randint(5, 60)), 1) for _ in range(160)] + [(bad(), 0) for _ in range(60)]
    base = good(50)
    for i in range(8):  # near copies: each with another word or two
        t = base.split()
        for _ in range(i % 3):
            t[rng.randrange(50)] = "changed"
        rows.append((" ".join(t), 1))
    rows += [(good(20) + " " + item + " " + good(5), 1), (good(5) + " " + item.replace("the", "tha").upper(), 1)]
    return rows, item


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(3)
    rows, item = texts_of(rng)
    docs = [(i, t, "en", f"s{i % 3}", len(t), 5, 6, "t", "r", "d", "x", "k") for i, (t, _) in enumerate(rows)]
    docs += [(1000 + i, t, "en", None if i % 2 else "s0", 0, 5, 6, "t", "r", "d", "x", "k") for i, t in enumerate(HARD)]
    docs += [docs[0], (None, rows[3][0] + " tail", "en", "s1", 0, 5, 6, "t", "r", "d", "x", "k")]
    base = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(i, y, 0) for i, (_, y) in enumerate(rows)], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item), (1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def rows_of(df):
    return sorted(((r["doc_id"], r["text"], r["source"]) for r in df.collect()), key=str)


def test_quality_keeps_what_the_score_keeps(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    kept = STAGES[0](spark, docs, corpus)
    assert kept.columns == docs.columns
    model = quality.fit_held_in(docs, spark.read.parquet(f"{corpus}/labels.parquet"))
    want = quality.score(docs, model, keep=["doc_id", "text", "source"]).filter("score >= 0.3")
    assert rows_of(kept) == rows_of(want)
    known = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{corpus}/labels.parquet").collect()}
    gone = {d for d in known if d not in {r["doc_id"] for r in kept.select("doc_id").collect()}}
    assert len(gone) >= 50 and sum(known[d] == 0 for d in gone) >= 0.9 * len(gone)


def test_near_duplicates_leave_one_of_each_group(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    rows = rows_of(docs)
    sets = []
    for _, t, _ in rows:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        n = min(5, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i])
    want = [min(g, key=lambda r: float("inf") if r[0] is None else r[0]) for g in groups.values()]
    kept = STAGES[1](spark, docs, corpus)
    assert kept.columns == docs.columns
    assert sorted(r[0] is None or r[0] for r in rows_of(kept)) == sorted(r[0] is None or r[0] for r in want)
    assert len(groups) < len(rows) - 5


def test_benchmarks_go(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    item = spark.read.parquet(f"{corpus}/benchmark.parquet").filter("item_id = 1").first()["text"].lower()
    kept = rows_of(STAGES[2](spark, docs, corpus))
    want = [r for r in rows_of(docs) if not r[1] or len(r[1]) > 4000 or edit_distance(item, re.sub(r"\s", " ", r[1].lower())) > len(item) // 10]
    assert kept == want and len(want) == docs.count() - 2


def test_mix_repeats_documents_as_planned(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    mixed = STAGES[3](spark, docs, corpus)
    assert mixed.columns == docs.columns
    plan = mixing.mixed_sizes(docs)
    assert mixed.count() == plan.agg(F.sum("copies")).first()[0]
    near = plan.groupBy("source").agg(F.sum(F.expr("copies * size")).alias("taken"), F.first("target").alias("target"), F.max("size").alias("most"))
    assert all(abs(r["taken"] - r["target"]) <= r["most"] for r in near.collect())


def test_token_files_hold_all_ids(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, t, _ in rows_of(docs):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((d, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
    got = STAGES[4](spark, docs, corpus).collect()
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)


def test_run_applies_the_stages_in_turn(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for stage in STAGES:
        path = str(tmp_path / stage.__name__)
        stage(spark, docs, corpus).write.parquet(path)
        docs = spark.read.parquet(path)
    key = lambda df: sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in df.collect()), key=str)
    assert key(corpus_pipeline.run(spark, corpus)) == key(docs) and docs.count() > 0


def test_empty_documents(spark, corpus, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{base}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{t}.parquet").write.parquet(f"{base}/{t}.parquet")
    assert corpus_pipeline.run(spark, base).count() == 0
