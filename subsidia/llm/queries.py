"""The registered queries of the corpus operators and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subsidia.llm import chat, decontamination, fingerprints, merkle, mixing, near_duplicates, packing, personal_data, quality, token_counts, token_files, url_filters, whitening
from subsidia.llm.common import shared_dir, staged, table
from subsidia.llm.pretokens import MANY_ENTRIES


def tokenizer(name: str) -> str:
    """Where a public vocabulary lies on this machine; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


URL_RULES = [
    url_filters.prefix_rule("block", "com", "/en/"),
    url_filters.prefix_rule("allow", "example.com", "/en/7"),
    url_filters.prefix_rule("allow", "net", "/de/"),
    url_filters.prefix_rule("block", "example.net", "/de/8"),
    url_filters.prefix_rule("block", "org", "/es/"),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


OP1_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^([^?#]*)', 1) ELSE '' END AS rest
  FROM pages
), keyed AS (
  SELECT page_id,
         translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(rest, length(split_part(rest, '/', 1)) + 1) AS path
  FROM cut
), rules(rhost, rpath, verdict) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
         ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), fits AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict
  FROM keyed JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
), best AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY ALL
)
SELECT k.page_id, k.host, k.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM keyed k LEFT JOIN best b ON k.page_id = b.page_id AND k.host = b.host AND k.path = b.path
"""


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer("word_bpe_49k.json"), end_id=1, entries=MANY_ENTRIES)
    return token_files.read_token_files(spark, folder)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), rate=0.1)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_prints(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), n=2, percent=80)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_held_in(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sizes(table(spark, sf_dir, "documents"), weights=(5, 2, 1), cap=3.0, seed=7)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws('|', '7', doc_id::VARCHAR, md5(coalesce(text, '')))) AS digest
  FROM documents
), numbered AS (
  SELECT *, list_reduce(list_transform(string_split(substr(digest, 1, 13), ''), lambda c: (strpos('0123456789abcdef', c) - 1)::BIGINT), lambda a, b: a * 16 + b) AS drawn
  FROM sized
), own AS (
  SELECT source, count(*) AS n_docs, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight, source_size * 3.0::DOUBLE AS most FROM own
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW f AS (ORDER BY most / weight, source NULLS LAST)
), targets AS (
  SELECT source, source_size, least(most, weight * max(level) OVER ())::DOUBLE AS target FROM levels
), shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS copies FROM targets
), budgets AS (
  SELECT source, source_size, target, floor(copies)::BIGINT AS whole, copies - floor(copies) AS share, target - floor(copies) * source_size AS budget FROM shares
), ranked AS (
  SELECT n.doc_id, n.size, n.drawn, b.*,
         CASE WHEN share > 0 THEN ((((drawn + 0.5) / 4503599627370496.0) / (1 - (drawn + 0.5) / 4503599627370496.0)) / (share / (1 - share)))::DOUBLE END AS rank
  FROM numbered n JOIN budgets b ON n.source IS NOT DISTINCT FROM b.source
), summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, drawn RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM ranked
), fitting AS (
  SELECT *, share > 0 AND upto <= budget AS fits FROM summed
), gaps AS (
  SELECT *, budget - coalesce(max(CASE WHEN fits THEN upto END) OVER (PARTITION BY source), 0) AS gap,
         sum(size) OVER (PARTITION BY source, drawn) AS together
  FROM fitting
), closings AS (
  SELECT source, arg_min(drawn, {'off': abs(gap - together), 'rank': rank, 'drawn': drawn}) AS closing
  FROM gaps WHERE share > 0 AND NOT fits AND abs(gap - together) < abs(gap) GROUP BY source
)
SELECT g.doc_id, g.size, g.source_size, g.target, (g.size * (g.whole + CASE WHEN g.fits OR coalesce(g.drawn = c.closing, FALSE) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM gaps g LEFT JOIN closings c ON g.source IS NOT DISTINCT FROM c.source
"""


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    written = chat.formatted(chat.canonical(chat.conversations_as_records(rows, vary=True)))
    written = staged(written.select("conv_id", "formatted", "loss_spans"), "chat")
    turns = chat.read_turns(F.col("formatted"))
    read = written.withColumn("turns", turns).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP8_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       sum(16 + length(replace(replace(replace(role, '\', '\e'), '<', '\l'), '>', '\g')) + length(replace(replace(text, '\', '\e'), '<', '\l')))::BIGINT AS formatted_chars
FROM given GROUP BY conv_id
"""


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), limit=1024)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[n(k) for k in personal_data.KINDS],
        F.sha2(personal_data.spelled(F.col("base")), 256).alias("base_sha256"),
        personal_data.spelled(F.concat("base", "extra")).alias("spans"),
        (F.size("base") + F.size("extra")).cast("long").alias("n_spans"),
    )


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    packed = packing.pack(table(spark, sf_dir, "documents"), path, capacity=1024, end_id=2)
    return packing.ids_crc32(packed, packing.id_bytes(path, 2)).withColumn("piece", F.col("piece").cast("int"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = merkle.document_leaves(table(spark, sf_dir, "documents"))
    manifest = merkle.build(leaves, "lang", ["doc_id"], ["doc_id", "tampered"])
    climbed = merkle.climb(manifest)
    proof = F.sha2(merkle.text_of(F.col("proof")), 256).alias("proof_sha256")
    return climbed.select("doc_id", "leaf", "subroot", "root", proof, F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


OP12_SQL = r"""
WITH RECURSIVE spelled AS (
  SELECT doc_id, lang, text,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
         -- crc32, bit by bit: a step takes in a byte (0 or more) or shifts (-1)
         xor(4294967295, list_reduce(
           [4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) % 3 = 0 AS chosen
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN chosen THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
  FROM spelled
), trees AS (
  SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, n FROM (SELECT lang, count(*) AS n FROM leaves GROUP BY lang)
), placed AS (
  SELECT l.doc_id, l.leaf, l.tampered, t.tree, t.n, row_number() OVER (PARTITION BY t.tree ORDER BY l.doc_id NULLS FIRST, l.leaf) - 1 AS pos
  FROM leaves l JOIN trees t ON l.lang IS NOT DISTINCT FROM t.lang
), nodes(tree, n, level, pos, hash) AS (
  SELECT tree, n, 0, pos, leaf FROM placed
  UNION ALL
  SELECT tree, n, level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)) FROM nodes WHERE n > 8 ** level GROUP BY tree, n, level, pos // 8
), subroots AS (
  SELECT tree, hash FROM nodes WHERE n <= 8 ** level
), tops(n, level, pos, hash) AS (
  SELECT (SELECT count(*) FROM trees), 0, tree, hash FROM subroots
  UNION ALL
  SELECT n, level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)) FROM tops WHERE n > 8 ** level GROUP BY n, level, pos // 8
), linked AS (
  SELECT tree, level, pos, hash, CASE WHEN n > 8 ** level THEN tree ELSE -1 END AS up_tree, CASE WHEN n > 8 ** level THEN level + 1 ELSE 1 END AS up_level,
         CASE WHEN n > 8 ** level THEN pos ELSE tree END AS place
  FROM nodes WHERE n > 8 ** level OR (SELECT count(*) FROM trees) > 1
  UNION ALL
  SELECT -1, level, pos, hash, -1, level + 1, pos FROM tops WHERE level > 0 AND n > 8 ** level
), runs AS (
  SELECT up_tree, up_level, place // 8 AS run, list(hash ORDER BY place) AS hashes FROM linked GROUP BY ALL
), climb(leaf_tree, leaf_pos, tree, level, pos, folded, proof) AS (
  SELECT tree, pos, tree, 0, pos, coalesce(tampered, leaf), '' FROM placed
  UNION ALL
  SELECT c.leaf_tree, c.leaf_pos, l.up_tree, l.up_level, l.place // 8,
         sha256(array_to_string(r.hashes[:l.place % 8], '') || c.folded || array_to_string(r.hashes[l.place % 8 + 2:], '')),
         c.proof || array_to_string(r.hashes[:l.place % 8], '') || array_to_string(r.hashes[l.place % 8 + 2:], '')
  FROM climb c JOIN linked l ON l.tree = c.tree AND l.level = c.level AND l.pos = c.pos
  JOIN runs r ON r.up_tree = l.up_tree AND r.up_level = l.up_level AND r.run = l.place // 8
), ended AS (
  SELECT * FROM climb c WHERE NOT EXISTS (SELECT 1 FROM linked l WHERE l.tree = c.tree AND l.level = c.level AND l.pos = c.pos)
), roots AS (
  SELECT hash AS root FROM tops WHERE n <= 8 ** level
)
SELECT p.doc_id, p.leaf, s.hash AS subroot, root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = root AS verified
FROM placed p JOIN ended e ON e.leaf_tree = p.tree AND e.leaf_pos = p.pos JOIN subroots s ON s.tree = p.tree CROSS JOIN roots
"""


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whitened_components(table(spark, sf_dir, "embeddings"), most=32)
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_token_files": op2_token_files,
    "op3_decontamination": op3_decontamination,
    "op4_fingerprints": op4_fingerprints,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_quality": op6_quality,
    "op7_mixing": op7_mixing,
    "op8_chat": op8_chat,
    "op9_token_counts": op9_token_counts,
    "op10_personal_data": op10_personal_data,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE_SQL = {
    "op1_url_filters": OP1_SQL,
    "op7_mixing": OP7_SQL,
    "op8_chat": OP8_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
