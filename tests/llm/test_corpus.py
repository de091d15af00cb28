"""The corpus operators on small fixtures: brute force, round trips, and rows that are hard to handle."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from subsidia.llm import chat, decontamination, fingerprints, mixing, personal_data, quality, token_counts, token_files, url_filters
from subsidia.llm.common import shared_dir

#: Documents with extra columns whose names the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, drawn long, target string, row string, doc string, dropped string, key string"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
HARD = [
    None, "", " ", "\n\t", "plain words here", "plain words here", "ÀÉ ß ÿ naïve", "İstanbul ǅ ﬁ", "tabs\tand\r\nlines  \n\n x", "a\u00a0b\u2003c\u200b", "emoji 😀👍🏽 e\u0301",
    "<|endoftext|> inside <|startoftext|>", "it's we'll 'S don''t !'s", "12345 ½ ² ٣", "中文字符 และ", "\x1c\x1d control \x00 chars", "x" * 5000, "  leading", "“quoted” – dash…",
]


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, 1, 5, 6, "t", "r", "d", "x", "k") for d, t, s in rows], SCHEMA)


def hard_documents(spark):
    return documents(spark, [(i, t, None if i % 3 == 0 else f"s{i % 2}") for i, t in enumerate(HARD)] + [(None, "no id", "s0"), (3, "\n\t", None), (3, "\n\t", None)])


def rows_of(spark):
    return [(r["doc_id"], r["text"] or "") for r in hard_documents(spark).collect()]


def test_token_counts_equal_the_library(spark):
    lib = Tokenizer.from_file(BYTES)
    got = token_counts.count_tokens(hard_documents(spark), BYTES, keep=["doc_id", "text"], limit=4).collect()
    assert len(got) == len(HARD) + 3
    for r in got:
        t = r["text"] or ""
        n = len(lib.encode(t, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 4), t
    assert token_counts.count_tokens(documents(spark, []), BYTES).count() == 0


def test_token_files_round_trip(spark):
    lib = Tokenizer.from_file(WORDS)
    folder = shared_dir(spark, "t")
    token_files.write_token_files(hard_documents(spark), folder, WORDS, end_id=1)
    got = token_files.read_token_files(spark, folder).orderBy("start").collect()
    rows = sorted(rows_of(spark), key=lambda r: (-1 if r[0] is None else r[0], r[1]))
    assert [r["doc_id"] for r in got] == [d for d, _ in rows]
    start = 0
    for r, (_, t) in zip(got, rows, strict=True):
        ids = [*lib.encode(t, add_special_tokens=False).ids, 1]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc), t
        start += len(ids)
    empty = shared_dir(spark, "t")
    token_files.write_token_files(documents(spark, []), empty, WORDS)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_url_filters(spark):
    rules = [url_filters.prefix_rule("block", "com", "/en/"), url_filters.prefix_rule("allow", "example.com", "/en/7"), url_filters.Rule("ads", "block", r"/ads?/", ()), url_filters.prefix_rule("block", "net", "/a.b/")]
    urls = [None, "", "nothing", "http://COM/en/x", "http://xcom/en/", "http://a.Example.com/en/745?q#f", "http://example.com/EN/7", "http://q.org/ad/", "http://n.net/a.b/", "http://n.net/aXb/", "s://h?x/y", "://", "http://é.com/en/", "http://a.com/en/" + "x/" * 50_000]
    pages = spark.createDataFrame([(i, u, "h", "mine", "mine") for i, u in enumerate([*urls, urls[3]])], "page_id long, url string, judged string, page string, host string")
    want = {}
    for i, u in enumerate([*urls, urls[3]]):
        rest = re.split(r"[?#]", u.split("://", 1)[1])[0] if u and "://" in u else ""
        host, path = re.match(r"([^/]*)(.*)", rest, re.S).groups()
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(len(r.name), r.name, r.verdict) for r in rules if re.search(r.pattern, host + path)]
        want[i] = (host, path, *(max(fits)[1:] if fits else (None, "allow")))
    for size in (1 << 20, 0):
        got = url_filters.judge_urls(pages, rules, broadcast_bytes=size)
        assert got.columns == ["page_id", "url", "judged", "page", "host", "path", "rule", "verdict"]
        assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()} == want
    assert url_filters.judge_urls(pages.limit(0), rules).count() == 0


def edit_distance(p, t):
    col = list(range(len(p) + 1))
    best = col[-1]
    for c in t:
        new = [0]
        for i, x in enumerate(p):
            new.append(min(col[i] + (x != c), col[i + 1] + 1, new[i] + 1))
        col, best = new, min(best, new[-1])
    return best


def test_matcher_equals_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        p = "".join(rng.choices("abcd ", k=rng.randint(3, 30)))
        k = rng.randint(0, len(p) // 4)
        q = list(p)
        for _ in range(rng.randint(0, k + 2)):
            q[rng.randrange(len(q))] = rng.choice(["", "a", "bc", "d"])
        t = "".join(rng.choices("xyzab ", k=30)) + "".join(q) + "".join(rng.choices("xyzab ", k=30))
        found, d = decontamination.Matcher([(1, p, k)]).find(t), edit_distance(p, t)
        assert (found[0][1] == d and edit_distance(p, t[found[0][2] : found[0][3]]) == d) if d <= k else not found


def test_matcher_finds_items_that_repeat_a_phrase():
    rng = random.Random(11)
    for _ in range(300):
        half = "".join(rng.choices("abcdefgh ", k=rng.randint(20, 35)))
        p = half + rng.choice(["", " ", "xy"]) + half
        k = len(p) // 10
        q = list(p)
        for _ in range(rng.randint(1, k + 1)):
            q[rng.randrange(len(half)) if rng.random() < 0.85 else rng.randrange(len(q))] = rng.choice(["", "z", "yz"])
        t = "".join(rng.choices("xyz ", k=60)) + "".join(q) + "".join(rng.choices("xyz ", k=60))
        found, d = decontamination.Matcher([(1, p, k)]).find(t), edit_distance(p, t)
        assert (found[0][1] == d and edit_distance(p, t[found[0][2] : found[0][3]]) == d) if d <= k else not found


def test_contaminations(spark):
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n))
    item, other = text(30), text(30)
    edited = item.replace(" ", "\n", 3).upper()
    edited = edited[:20] + "zz" + edited[25:]
    rows = [(1, text(50), "s"), (2, text(9) + " " + item + " " + text(9), "s"), (3, "😀 " + edited, "s"), (4, item[: len(item) // 2], "s"), (5, None, "s"), (6, "", "s"), (7, text(30000) + item, "s"), (None, item, "s"), (2, text(9) + item, None)]
    docs = documents(spark, rows)
    bench = spark.createDataFrame([(1, item, "x"), (1, item, "x"), (2, other, "x"), (3, "short", "x"), (4, None, "x"), (5, "", "x"), (None, None, "x")], "item_id long, text string, distance string")
    for block in (2_000_000, 300):
        got = decontamination.contaminations(docs, bench, block_chars=block).collect()
        assert sorted((r["doc_id"] or 0, r["item_id"]) for r in got) == [(0, 1), (2, 1), (2, 1), (3, 1), (7, 1)]
        (third,) = [r for r in got if r["doc_id"] == 3]
        assert 0 < third["distance"] <= 6 and third["start"] == 2
        kept = decontamination.clean(docs, bench, block_chars=block)
        assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5, 6]
    assert decontamination.contaminations(docs, bench.limit(0)).count() == 0
    assert decontamination.clean(docs.limit(0), bench).count() == 0


def test_contaminations_by_short_items(spark):
    texts = ["so, What is the\ncapital of France? Paris", "wat is the capital of france", "cat", "A cat.", "concatenate", "the catalog and a cat", "nothing", " ", "e = mc2!", "法国的首都是巴黎"]
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    bench = spark.createDataFrame([(1, "What is the capital of France?"), (2, " cat "), (3, "   "), (4, ""), (5, None), (6, "= mc2"), (7, "首都")], "item_id long, text string")
    got = sorted(tuple(r) for r in decontamination.contaminations(docs, bench).collect())
    assert got == [(0, 1, 0, 4, 34), (1, 1, 2, 0, 28), (2, 2, 0, 0, 3), (3, 2, 0, 2, 5), (5, 2, 0, 18, 21), (8, 6, 0, 2, 7), (9, 7, 0, 3, 5)]
    assert sorted(r["doc_id"] for r in decontamination.clean(docs, bench).collect()) == [4, 6, 7]


def test_fingerprints(spark):
    got = {}
    docs = hard_documents(spark)
    for r in fingerprints.edited_prints(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    rows = sorted(rows_of(spark), key=lambda r: (0, 0, r[1]) if r[0] is None else (-1, -r[0], r[1]))
    prints = {}
    for (d, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        k = len(t) // 3
        edited = t[: len(t) - k] + u[:k]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        assert any(r["edited_sha256"] == digest and r["n_chars"] == len(t) and r["fingerprint"] == fingerprints.fingerprint(fingerprints.spots(t)) for r in got[d]), (d, t)
        prints[t] = fingerprints.fingerprint(fingerprints.spots(t))
    assert sum(map(len, got.values())) == len(rows)
    one = fingerprints.edited_prints(documents(spark, [(1, "the only text", "s")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert fingerprints.edited_prints(documents(spark, [])).count() == 0


def own_signatures(text):
    """SpotSigs restated with tuples of words: an anchor and the next two content words; pairs of words where these are missing."""
    marks = ".,;:!?\"'()[]{}«»“”„‘’…|*#$%&"
    words = [w.lower().strip(marks) for w in (text or "").split()]
    content = [(i, w) for i, w in enumerate(words) if w not in fingerprints.ANCHORS]
    out = set()
    for i, w in enumerate(words):
        later = [c for j, c in content if j > i][:2]
        if w in fingerprints.ANCHORS and later:
            out.add((w, *later))
    return out or {(w, *words[i : i + 2]) for i, w in enumerate(words)}


def test_likeness_equals_jaccard_of_tuples(spark):
    rng = random.Random(14)
    words = ["the", "of", "and,", "und", "la"] * 4 + [f"w{i}" for i in range(40)] + ["Big.", "(x)"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(60)] + ["", "lone", "the of", "x y"]
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    jaccard = lambda a, b: len(a & b) / len(a | b) if a and b else float(len(a) == len(b))
    for r in fingerprints.edited_prints(docs).collect():
        i = r["doc_id"]
        t, u = texts[i], texts[i - 1]
        k = len(t) // 3
        own = own_signatures(t)
        assert r["near_next"] == pytest.approx(jaccard(own, own_signatures(u))), (t, u)
        assert r["near_edited"] == pytest.approx(jaccard(own, own_signatures(t[: len(t) - k] + u[:k])))


def test_other_vocabularies_go_to_the_library(spark, tmp_path):
    import json

    spec = json.load(open(BYTES))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "own.json").write_text(json.dumps(spec))
    model = public_tokenizers.path("piece_bpe_32k.model")
    import sentencepiece

    piece = sentencepiece.SentencePieceProcessor(model_file=model)
    for path, ids in ((str(tmp_path / "own.json"), lambda t: Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids), (model, piece.encode)):
        for r in token_counts.count_tokens(hard_documents(spark), path, keep=["text"]).collect():
            assert r["n_tokens"] == len(ids(r["text"] or "")), r["text"]


def test_similar_equals_brute_force(spark):
    rng = random.Random(9)
    words = ["the", "of", "and", "in"] * 10 + [f"w{i}" for i in range(60)]
    base = [rng.choices(words, k=60) for _ in range(6)]
    rows = []
    for i in range(60):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 5)):
            t[rng.randrange(60)] = rng.choice(words)
        rows.append((i, " ".join(t), "s"))
    members, links = fingerprints.similar(documents(spark, [*rows, (99, "", "s"), (98, None, "s")]), 0.7)
    cls = {r["doc_id"]: r["class"] for r in members.collect()}
    got = {(r["a"], r["b"]) for r in links.collect()}
    sets = {cls[d]: fingerprints.spots(t) for d, t, _ in rows}
    want = {(a, b) for a in sets for b in sets if a < b and fingerprints.likeness(sets[a], sets[b]) >= 0.7}
    assert got == want and cls[99] is None and cls[98] is None


def test_quality_learns_and_handles_hard_rows(spark):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choices(["the", "and", "of", "reading", "nations", "thing", "was", "over"], k=80))
    bad = lambda: " | ".join(f"{w.upper()}!!" for w in rng.choices(["the", "buy", "cheap", "click"], k=60))
    rows = [(i, (good if i % 2 else bad)(), "s") for i in range(400)]
    docs = documents(spark, [*rows, *[(1000 + i, t, None) for i, t in enumerate(HARD)], (None, "no id", "s"), (7, rows[7][1], "s")])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)] + [(None, 1, 0), (1001, None, 0), (3, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit_held_in(docs, labels)
    again = quality.fit_held_in(docs, labels)
    assert model == again
    scored = quality.score(docs, model).withColumn("held", quality.held_out()).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    held = [r for r in scored if r["held"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert {r["doc_id"] for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum((r["score"] >= 0.3) == r["doc_id"] % 2 for r in held) >= 0.97 * len(held)
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.fit(docs, labels.limit(0)) is None and quality.score(docs, None).filter("score <> 1").count() == 0
    assert quality.score(docs.limit(0), model).count() == 0


def test_mixing(spark):
    rng = random.Random(4)
    sizes = {None: 3, "": 40, "a": 300, "b": 5, "c": 120}
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), s) for s, n in sizes.items() for i in range(n)] + [(1, None, "a"), (None, "x y", "a"), (None, "x y", "a"), (7, " ", "only-empty")]
    docs = documents(spark, rows)
    got = mixing.mixed_sizes(docs).collect()
    assert got == mixing.mixed_sizes(docs.repartition(3)).orderBy("doc_id").collect() or sorted(map(str, got)) == sorted(map(str, mixing.mixed_sizes(docs.repartition(3)).collect()))
    total = {}
    for r in got:
        t = total.setdefault(r["source"], [0, 0, r["source_size"], r["target"]])
        t[0] += r["size"]
        t[1] += r["size"] * r["copies"]
        assert 0 <= r["copies"] <= 3
    order = sorted((s for s in total if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    words, capped = sum(t[2] for t in total.values()), set()
    while True:  # the excess is reshared until none is above
        free = [s for s in order if s not in capped]
        level = (words - sum(3 * total[s][2] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * total[s][2]}
        if not over:
            break
        capped |= over
    for s, (size, taken, source_size, target) in total.items():
        assert size == source_size
        assert target == pytest.approx(3 * size if s in capped else weight[s] * level)
        assert abs(taken - target) <= 20
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mixing.mixed_sizes(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_mixing_beyond_one_bin(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BIN", 16)
    rng = random.Random(6)
    docs = documents(spark, [(i, " ".join(["w"] * rng.randint(1, 9)), rng.choice("aaab")) for i in range(3000)])
    got = mixing.mixed_sizes(docs).groupBy("source").agg(F.sum(F.expr("size * copies")).alias("taken"), F.first("target").alias("target")).collect()
    assert len(got) == 2 and all(abs(r["taken"] - r["target"]) <= 1 for r in got)


def test_chat_round_trip(spark):
    texts = ["\\### Assistant: </turn> ok", "", None, "a\\l<b\\e\\\\", "<turn user>\nx</turn>\n", "😀\n\n", "plain"]
    rows = [(1, i, ["user", "assistant", "we>ird\n<role>", None][i % 4], t) for i, t in enumerate(texts * 3)] + [(2, None, "assistant", "only"), (2, 0, "assistant", "only"), (None, 0, "user", "x"), (3, 0, None, None)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, formatted string, turns string")
    many = df.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(40)))).select((F.col("conv_id") + 10 * F.col("k")).alias("conv_id"), "turn", "role", "text")
    both = [many, many.filter("turn < 2").select(F.col("conv_id") + 1000, "turn", F.element_at(F.array(F.lit("user"), F.lit("assistant")), F.col("turn").cast("int") + 1), "text")]
    varied = chat.canonical(chat.conversations_as_records(both[0].union(both[1]), vary=True))
    assert {r[0] for r in varied.select("layout").distinct().collect()} == {"messages", "messages_parts", "nested_messages", "conversations", "prompt"}
    plain = chat.canonical(chat.conversations_as_records(both[0].union(both[1]))).select("conv_id", "turns")
    assert varied.select("conv_id", "turns").exceptAll(plain).isEmpty() and varied.count() == plain.count()
    got = chat.formatted(chat.canonical(chat.conversations_as_records(df)))
    got = got.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(got) == 4
    for r in got:
        own = sorted(((-1 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == r["conv_id"]))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(role, text) for _, role, text in own]
        assert r["loss"] == "".join(text for _, role, text in own if role == "assistant")
    assert chat.conversations_as_records(df.limit(0)).count() == 0


def test_chat_layouts(spark):
    cases = {
        '{"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": null}]}': ("messages", [("system", "s"), ("user", "")]),
        '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}': ("conversations", [("user", "q"), ("assistant", "a")]),
        '{"prompt": "p", "completion": "c"}': ("prompt", [("user", "p"), ("assistant", "c")]),
        '{"output": "o", "instruction": "i", "input": null}': ("instruction_input", [("user", "i"), ("assistant", "o")]),
        '{"messages": []}': ("messages", []),
        '{"id": 7, "meta": {"a": [1, {"b": 2}]}, "prompt": "p", "completion": "c"}': ("prompt", [("user", "p"), ("assistant", "c")]),
        '{"messages": [{"role": "user", "name": "n", "content": "q"}], "z": [[]]}': ("messages", [("user", "q")]),
        '{"data": {"messages": [{"role": "user", "content": "q"}], "k": 1}}': ("nested_messages", [("user", "q")]),
        '{"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}': ("messages_parts", [("user", "ab")]),
        '{"messages": [{"role": "user", "content": "x"}], "prompt": "p"}': (None, None),
        '{"other": 1}': (None, None),
        "not json": (None, None),
        None: (None, None),
    }
    df = spark.createDataFrame([(k,) for k in cases], "j string").withColumn("record", F.try_parse_json("j"))
    for r in chat.canonical(df).collect():
        layout, turns = cases[r["j"]]
        assert r["layout"] == layout and (None if r["turns"] is None else [tuple(t) for t in r["turns"]]) == turns


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def holds(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]

    return [(k, *m.span()) for k, p in BASE.items() for m in re.finditer(p, text) if holds(k, m[0])]


def test_personal_data_base_equals_the_plain_patterns(spark):
    rng = random.Random(5)
    parts = ["a", "b@", "@", ".", "c.d", "1", "23.4", "255.1.1.1", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111111", "+1 (487) 555-7209", "+", "-", " ", "\n", "é", "x@y.z", "_q@e.f", "%", "00255.0.0.1", "😀", "(", "9" * 25]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 25))), "s") for i in range(1500)] + [(5000, None, "s"), (5001, "x " * 50_000 + "a@b.c", "s"), (5002, "1.2.3.4 " * 3000, "s"), (None, "a@b.c", "s"), (1, "a@b.c", "s")]
    docs = documents(spark, rows)
    got = sorted((str(r["doc_id"]), r["s"]) for r in personal_data.personal_data(docs).select("doc_id", personal_data.spelled(F.col("base")).alias("s")).collect())
    assert got == sorted((str(d), ",".join("%s:%d:%d" % s for s in base_spans(t or ""))) for d, t, _ in rows)
    assert personal_data.personal_data(docs.limit(0)).count() == 0


def test_personal_data_finds_unseen_identifiers_by_context(spark):
    rng = random.Random(8)
    rows = [(i, f"words {rng.random()} before. Customer contact: user{i}@mail{i % 3}.example.com and more", "s") for i in range(30)]
    rows += [(100, "Some text. Customer contact: AB-77-123, thanks", "s"), (101, "released in version 2.0 of 1999", "s")] + [(200 + i, f"in version 2.{i} here", "s") for i in range(20)]
    docs = documents(spark, rows)
    found = personal_data.personal_data(docs)
    got = {r["doc_id"]: [(s["kind"], s["value"]) for s in r["extra"]] for r in found.collect()}
    assert got[100] == [("id", "AB-77-123")]
    assert not any(v for k, v in got.items() if k != 100)
    clean = {r["doc_id"]: r["text"] for r in personal_data.redacted(docs, found).collect()}
    assert clean[100] == "Some text. Customer contact: [id], thanks" and "[email]" in clean[3] and clean[101] == rows[31][1]


def test_personal_data_context_reaches_the_whole_run_from_both_sides(spark):
    seeds = lambda i: f"user{i}@mail{i % 3}.example.com"
    rows = [(i, f"Customer contact: {seeds(i)} says. Hello {seeds(i)} (home address) now", "s") for i in range(30)]
    texts = {
        100: "Customer contact: DE89 3704 0044 0532 thanks",
        101: "see 17 words. Customer contact: 4711 / AB-77-123, thanks",
        102: "customer contact:" + " " * 90 + "X-1 " + "and 5 plain",
        103: "mine is QQ-1 22 (home address) too",
        104: "7 8 nothing before. Customer contact: - @ Z-9",
        105: "Customer contact: words between 33 here",
    }
    docs = documents(spark, rows + [(i, t, "s") for i, t in texts.items()])
    found = personal_data.personal_data(docs)
    got = {r["doc_id"]: [s["value"] for s in r["extra"]] for r in found.collect()}
    assert {k: v for k, v in got.items() if v} == {100: ["DE89", "3704", "0044", "0532"], 101: ["4711", "AB-77-123"], 102: ["X-1"], 103: ["QQ-1", "22"]}
    clean = {r["doc_id"]: r["text"] for r in personal_data.redacted(docs, found).collect()}
    assert clean[100] == "Customer contact: [id] [id] [id] [id] thanks" and clean[103] == "mine is [id] [id] (home address) too"


def test_personal_data_finds_keys_by_context_and_no_others(spark):
    rng = random.Random(12)
    digest = lambda: "".join(rng.choices("0123456789abcdef", k=40))
    rows = [(i, f"prose {rng.random()} with api token = \"{digest()}\" in it", "s") for i in range(20)]
    rows += [(50, 'no form: token = "K-77-secret" there', "s"), (51, "plain 2026 report of 12 pages", "s")]
    rows += [(60 + i, f"revision {'ab' * i}x{i} was built on day {i}", "s") for i in range(1, 30)]
    docs = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, text string, source string, _id string, spans string")
    found = personal_data.personal_data(docs)
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["extra"]] for r in found.collect()}
    texts = {d: t for d, t, _ in rows}
    for d in [*range(20), 50]:
        m = re.search(r'token = "([^"]*)"', texts[d])
        assert got[d] == [m.span(1)]
    assert not any(v for d, v in got.items() if d > 50)
    assert "[id]" in {r["doc_id"]: r["text"] for r in personal_data.redacted(docs, found).collect()}[50]
    few = personal_data.personal_data(docs, forms=()).filter("size(extra) > 0").count()
    known = tuple(re.search(r'token = "([^"]*)"', texts[d])[1] for d in range(18))
    assert few == 0 and personal_data.personal_data(docs, forms=(), examples=known).filter("size(extra) > 0").count() == 21


@pytest.mark.parametrize("every", [10, 5, 3])
def test_personal_data_finds_forms_that_are_held_out(spark, every):
    rng = random.Random(every)
    digest = lambda: "".join(rng.choices("0123456789abcdef", k=40))
    key = lambda i: f"Zq-{digest()[:8]}-k" if i % every == 0 else digest()
    keys = {i: key(i) for i in range(60)}
    rows = [(i, f"prose {rng.random()} and then token = \"{k}\" and part {rng.randint(1, 99)} of it", "s") for i, k in keys.items()]
    rows += [(100 + i, f"Pay by card {rng.randint(10**15, 10**16)} or order part-{i}-{digest()[:6]} in part {i} of {i + 7}", "s") for i in range(80)]
    got = {r["doc_id"]: [s["value"] for s in r["extra"]] for r in personal_data.personal_data(documents(spark, rows)).collect()}
    assert {d: v for d, v in got.items() if v} == {i: [k] for i, k in keys.items()}


def plain_scores(instances, rounds, confidence, support, lift):
    """The rounds of trust, with dictionaries."""
    sure = {v: any(x["seed"] for x in instances if x["value"] == v) for v in {x["value"] for x in instances}}
    plain = {x["value"]: x["plain"] for x in instances}
    known = [v for v in sure if sure[v] or plain[v]]
    share = sum(sure[v] for v in known) / len(known) if known else 0.0
    confidence = max(confidence, min(lift * share, (1 + 3 * confidence) / 4))
    best, scores = {}, {}
    for _ in range(rounds):
        trust = lambda x: 1.0 if x["seed"] else best.get(x["value"], 0.0)  # noqa: B023, E731
        scores = {}
        for p in {x["pattern"] for x in instances}:
            own = [x for x in instances if x["pattern"] == p]
            good = [x for x in own if trust(x) >= confidence]
            total = sum(map(trust, good))
            against = sum(1.0 if x["plain"] and not x["seed"] else 0.1 for x in own if trust(x) < confidence)
            score = total / (total + against + 0.5)
            if total >= support and sum(x["docs"] for x in good) >= support and score >= confidence:
                scores[p] = score
        best = {}
        for x in instances:
            if not x["plain"] and x["pattern"] in scores:
                best[x["value"]] = max(best.get(x["value"], 0.0), scores[x["pattern"]])
    return scores


@pytest.mark.parametrize("seed", range(3))
def test_pattern_scores_equal_a_plain_restatement(spark, seed):
    rng = random.Random(seed)
    kinds = {v: rng.choice(["seed", "seed", "plain", "unknown"]) for v in range(300)}
    by_kind = {k: [v for v in kinds if kinds[v] == k] for k in ("seed", "plain", "unknown")}
    rows = {}
    for p in range(40):
        mix = rng.choice([(30, 0, 5), (12, 1, 0), (10, 2, 30), (5, 5, 5), (0, 0, 20), (6, 0, 0), (0, 9, 0)])
        for k, n in zip(("seed", "plain", "unknown"), mix, strict=True):
            for v in rng.sample(by_kind[k], min(n, len(by_kind[k]))):
                rows[p, v] = {"pattern": p, "value": f"v{v}", "docs": rng.randint(1, 3), "seed": k == "seed", "plain": k == "plain"}
    instances = list(rows.values())
    df = spark.createDataFrame([(x["value"], x["pattern"], x["docs"], x["seed"], x["plain"]) for x in instances], "value string, pattern long, docs long, seed boolean, plain boolean")
    got = {r["pattern"]: r["score"] for r in personal_data.trusted_patterns(df).collect()}
    want = plain_scores(instances, personal_data.ROUNDS, personal_data.CONFIDENCE, personal_data.SUPPORT, personal_data.LIFT)
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in want) and want
