"""URL filters: pattern rules found through their rarest literal token.

A rule is a regular expression over ``host + path`` with the literal tokens that any match must hold. Each rule is filed
under the one token that the corpus has least often, counted over all URLs. A URL fetches the rules filed under its own
tokens, and only those run their expressions. The longest fitting rule gives the verdict; without one the default holds.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = "[A-Za-z0-9]+"
#: Rules go to each worker by broadcast up to this size; beyond it they are joined by token.
BROADCAST_BYTES = 16 << 20
SHARES = 16


@dataclass(frozen=True)
class Rule:
    """``name`` is returned, ``pattern`` must be found in ``host + path``, ``tokens`` are whole tokens of any match."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]


def prefix_rule(verdict: str, host: str, path: str = "/") -> Rule:
    """A rule for ``host`` and its subdomains whose path starts with ``path``.

    The last token of the path may go on in the URL (``/7`` fits ``/745``), so it counts only if a mark follows it.
    """
    host = host.lower()
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(host + path, verdict, pattern, tuple(dict.fromkeys(re.findall(TOKEN, host) + re.findall(rf"{TOKEN}(?=[^A-Za-z0-9])", path))))


def split_url(url):
    """(host, path) columns: host up to ``/ ? #`` with A-Z lower-cased, path up to ``? #``; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "#", 1))
    rest = F.substring_index(rest, "?", 1)
    host = F.substring_index(rest, "/", 1)
    path = F.substring(rest, F.length(host) + 1, F.length(rest))
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def token_counts(keys: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """How many URLs hold each token that some rule names, over all rows; at most one row a token comes back.

    The names are sent to where the URLs are read while they are under ``BROADCAST_BYTES``, so that a token of every URL is counted
    there. A longer list meets the counts of all tokens.
    """
    named = sorted({t for r in rules for t in r.tokens})
    if not named:
        return {}
    names = keys.sparkSession.createDataFrame([(t,) for t in named], "token string")
    own = keys.select(F.explode(F.array_distinct(F.regexp_extract_all("key", F.lit(TOKEN), 0))).alias("token"))
    if sum(len(t) + 32 for t in named) <= BROADCAST_BYTES:
        counted = own.join(F.broadcast(names), "token", "left_semi").groupBy("token").count()
    else:
        counted = own.groupBy("token").count().join(names, "token", "left_semi")
    return {r["token"]: r["count"] for r in counted.collect()}


def filed(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Token -> numbers of the rules filed under it; "" holds those without a literal token, which always run."""
    index: dict[str, list[int]] = {}
    for i, r in enumerate(rules):
        index.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=""), []).append(i)
    return index


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` with host, path, rule (name or null) and verdict in place of columns of these names.

    Every row is returned, repeated rows too. A null URL, or one without ``://``, has an empty host and path and can only
    meet rules that fit an empty key. URLs of any length are judged whole. Rules of equal length are decided by name, then verdict.
    """
    spark = pages.sparkSession
    host, path = split_url(F.col(url))
    taken = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    keyed = pages.select(F.struct(*taken).alias("page"), host.alias("host"), path.alias("path"))
    index = filed(rules, token_counts(keyed.select(F.concat("host", "path").alias("key")), rules))
    if sum(len(r.pattern) + len(r.name) + 64 for r in rules) > broadcast_bytes:
        return _judge_by_join(keyed, rules, index, default).select("page.*", "host", "path", "rule", "verdict")
    sent = spark.sparkContext.broadcast((rules, index))

    @F.pandas_udf("rule string, verdict string")
    def judge(keys):
        import pandas as pd

        rules, index = sent.value
        tests, tokens = {}, re.compile(TOKEN, re.ASCII)
        always = index.get("", [])
        out = []
        for key in keys:
            found = [i for i in {*always, *(i for t in set(tokens.findall(key)) for i in index.get(t, ()))} if tests.setdefault(i, re.compile(rules[i].pattern)).search(key)]
            best = max((rules[i] for i in found), key=lambda r: (len(r.name), r.name, r.verdict), default=None)
            out.append((best.name, best.verdict) if best else (None, default))
        return pd.DataFrame(out, columns=["rule", "verdict"])

    return keyed.withColumn("judged", judge(F.concat("host", "path"))).select("page.*", "host", "path", "judged.rule", "judged.verdict")


def _judge_by_join(keyed: DataFrame, rules: list[Rule], index: dict[str, list[int]], default: str) -> DataFrame:
    """The same by joins on the token, for rule lists too large to broadcast. Distinct keys are judged once.

    A token of every URL is dealt over ``SHARES`` tasks by the URL, and the rules go to all of these.
    """
    spark = keyed.sparkSession
    rows = [(t, rules[i].name, rules[i].verdict, rules[i].pattern) for t, own in index.items() for i in own]
    filed_rules = spark.createDataFrame(rows, "token string, rule string, verdict string, pattern string")
    keys = keyed.select(F.concat("host", "path").alias("key")).distinct()
    tokens = keys.select("key", F.explode(F.array_union(F.array(F.lit("")), F.array_distinct(F.regexp_extract_all("key", F.lit(TOKEN), 0)))).alias("token"))
    tokens = tokens.withColumn("share", F.pmod(F.xxhash64("key"), F.lit(SHARES)))
    filed_rules = filed_rules.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SHARES - 1).cast("long"))))
    fits = tokens.join(filed_rules, ["token", "share"]).filter(F.expr("key rlike pattern"))
    best = fits.groupBy("key").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
    return keyed.withColumn("key", F.concat("host", "path")).join(best, "key", "left").select("page", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
