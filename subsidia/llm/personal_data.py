"""Personal data: patterns of form for the known kinds, and bootstrapped contextual extraction for the rest.

The base finds e-mail addresses, IP addresses, card numbers and phone numbers by form. These finds are seeds, and so are words
of the forms that access keys have and any examples that the caller knows. Every identifier-like word of a text (one with a digit
or an @) is a candidate instance; the words around it make lexical patterns, and so does its shape. Patterns and instances form
a graph: a pattern becomes trusted if it surrounds trusted instances and hardly any ordinary ones (numbers, dates, short words), and
more of the trusted ones than there are at large; an instance that trusted patterns surround becomes trusted, and so on for a few
rounds of joins and groupings. Instances of which nothing is known count little either way, so a context of keys finds keys of
forms that nobody has listed. Words outside base spans that high-confidence patterns surround are reported as kind ``id``; a form
alone, as of a key, is no reason to report.

DataFrame functions only. A text is read once; what goes on is one row an identifier-like word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsidia.llm.common import staged

KINDS = ("email", "ip", "card", "phone")

# Written so that the same matches are found without backtracking over long runs: a run of letters is entered at its beginning
# or where the last match ended, and what is taken isn't given back.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: An identifier-like word: a run between spaces with a digit or an @. Entered at its beginning only, so it is linear.
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"

WORD_KIND = "word"
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, WORD_KIND: CANDIDATE}

# Forms of words that are keys wherever they stand in a context of keys. They are seeds, not results.
SEED_FORMS = (
    r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{32,}$",
    r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]{32,}$",
    r"^AKIA[0-9A-Z]{16}$",
    r"^gh[pousr]_[A-Za-z0-9]{36,}$",
    r"^eyJ[\w-]+\.[\w-]+\.[\w-]+$",
)
#: Values shorter than this have no shape.
SHAPED = 12

ROUNDS = 3
#: A pattern is trusted from this share of trusted instances on, and only with so many different ones in so many documents.
CONFIDENCE, SUPPORT = 0.8, 5
#: How many times the share of trusted values among all known values a pattern's share must be.
LIFT = 1.1
#: What an instance of which nothing is known counts against a pattern; an ordinary one counts 1. And what each pattern starts with.
UNKNOWN, PRIOR = 0.1, 0.5
#: Letters and digits of the shortest word, and digits of the shortest number, that may be an identifier.
WORD_LENGTH, NUMBER_LENGTH = 6, 9
DATE = r"^[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}$"


def pieces(text: Column, kind: str, pattern: str) -> Column:
    """All matches in order: array of (kind, pos, gap, value, near, head).

    ``gap`` is the number of code points since the last match. For words only, ``near`` and ``head`` are the last and first 64
    of them, further on to the nearest word if they hold none, and an element without value has the rest of the text.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    near = head = lambda g: F.lit("")
    if kind == WORD_KIND:
        worded = lambda part: F.rlike(part, F.lit(r"[^\s\p{Punct}]"))
        last, first = (lambda g: F.substring(g, -64, 64)), (lambda g: F.substring(g, 1, 64))
        close = lambda part: F.regexp_replace(part, r"\s++", "")
        before, behind = r"(?<![\s\p{Punct}])([\s\p{Punct}]++)$", r"^([\s\p{Punct}]++)"
        near = lambda g: F.lower(F.when(worded(last(g)), last(g)).otherwise(F.concat(last(F.regexp_replace(g, before, "")), last(close(F.regexp_extract(g, before, 1))))))
        head = lambda g: F.lower(F.when(worded(first(g)), first(g)).otherwise(F.concat(first(close(F.regexp_extract(g, behind, 1))), first(F.regexp_replace(g, behind, "")))))
    else:
        gaps = F.slice(gaps, F.lit(1), F.size(values))
    paired = F.zip_with(values, gaps, lambda v, g: F.struct(F.length(g).alias("gap"), v.alias("value"), near(g).alias("near"), head(g).alias("head")))
    return F.transform(paired, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), x["gap"].alias("gap"), x["value"].alias("value"), x["near"].alias("near"), x["head"].alias("head")))


def matches(text: Column) -> Column:
    """The matches of every kind and the identifier-like words; each expression runs only over texts that can hold it."""
    figures = F.rlike(text, F.lit("[0-9]"))
    may = {
        "email": F.contains(text, F.lit("@")),
        "ip": figures & F.rlike(text, F.lit(r"[0-9]\.[0-9]")),
        "card": figures,
        "phone": F.contains(text, F.lit("+")),
        WORD_KIND: F.rlike(text, F.lit("[0-9@]")),
    }
    nothing = F.array().cast("array<struct<kind string, pos int, gap int, value string, near string, head string>>")
    return F.concat(*[F.when(may[k], pieces(text, k, p)).otherwise(nothing) for k, p in PATTERNS.items()])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    figures = F.reverse(F.transform(F.filter(F.split(number, ""), lambda c: c != ""), lambda c: c.cast("int")))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _byte(part: Column) -> Column:
    """Whether a run of digits, of any length, is at most 255."""
    bare = F.ltrim(part, F.lit("0"))
    return F.when(bare == "", True).otherwise((F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(256)) <= 255))


def valid(kind: Column, value: Column) -> Column:
    """Whether a match holds: parts of an address at most 255, 16 to 19 digits that pass Luhn, 8 to 15 digits of a phone."""
    n = F.length(digits(value))
    card = F.when(n.between(16, 19), luhn(digits(value))).otherwise(False)
    return F.when(kind == "ip", F.forall(F.split(value, r"\."), _byte)).when(kind == "card", card).when(kind == "phone", n.between(8, 15)).otherwise(True)


def refuted(value: Column) -> Column:
    """Whether a word has the form of a card or an address and fails its test."""
    n = F.length(digits(value))
    card = F.rlike(value, F.lit(r"^[0-9][0-9-]*$")) & n.between(16, 19)
    address = F.rlike(value, F.lit(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"))
    return F.when(card, ~luhn(digits(value))).when(address, ~F.forall(F.split(value, r"\."), _byte)).otherwise(False)


def ordinary(value: Column) -> Column:
    """Whether a word is known to be no identifier: a date, a number of few digits, a short word, or one that is refuted."""
    bare = F.regexp_replace(value, r"[^\p{L}\p{N}]", "")
    few = F.length(bare) < F.when(F.rlike(bare, F.lit(r"\p{L}")), WORD_LENGTH).otherwise(NUMBER_LENGTH)
    return few | F.rlike(value, F.lit(DATE)) | refuted(value)


def shape(value: Column) -> Column:
    """Classes of characters and length of a value with both letters and digits: ``a9:40``; null for shorter ones than ``SHAPED``."""
    has = lambda pattern, mark: F.when(F.rlike(value, F.lit(pattern)), mark).otherwise("")
    classes = F.concat(has("[A-Z]", "A"), has(r"\p{Ll}", "a"), has("[0-9]", "9"), F.regexp_replace(F.array_join(F.sort_array(F.array_distinct(F.split(F.regexp_replace(value, r"[\p{L}\p{N}]", ""), ""))), ""), r"\s", ""))
    mixed = F.rlike(value, F.lit("[0-9]")) & F.rlike(value, F.lit(r"\p{L}")) & (F.length(value) >= SHAPED)
    return F.when(mixed, F.concat(classes, F.lit(":"), F.length(value).cast("string")))


def spans(read: DataFrame) -> DataFrame:
    """Of (row, found): one row a valid match or word: row, kind, start, end, value, contexts (null for base kinds).

    Contexts are the word and the two words before and behind. Words with only spaces and marks between make a run, and each
    word of a run has the contexts of the run; ``own`` are those of its first and last word, so that a run counts once. The shape
    is a context too. Places are running sums over the matches of a kind, so a text with a million matches takes a million steps.
    """
    one = read.filter(F.size("found") > 0).dropDuplicates(["row"]).select("row", F.explode("found").alias("m")).select("row", "m.*")
    rising, falling = (Window.partitionBy("row", "kind").orderBy(o) for o in ("pos", F.desc("pos")))
    placed = one.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(rising).cast("int")).withColumn("behind", F.lead("head").over(rising)).withColumn("start", F.col("end") - F.length("value"))
    word = F.col("kind") == WORD_KIND
    lead = F.when(word, F.regexp_extract("value", r"^([^\p{L}\p{N}+@]*)", 1)).otherwise("")
    bare = F.when(word, F.regexp_replace(F.substring("value", F.length("lead") + 1, F.length("value")), r"[^\p{L}\p{N}]++$", "")).otherwise(F.col("value"))
    placed = placed.withColumn("lead", lead).withColumn("whole", F.col("value")).withColumn("value", bare)
    placed = placed.withColumn("start", F.col("start") + F.length("lead")).withColumn("end", F.col("start") + F.length("value"))
    words = lambda c: F.filter(F.split(c, r"[\s\p{Punct}]+"), lambda w: w != "")
    marks = lambda c, p: F.regexp_replace(F.regexp_extract(c, p, 1), r"\s+", "")
    tail = F.substring("whole", F.length("lead") + F.length("value") + 1, F.length("whole"))
    before, behind = words("near"), words("behind")
    left = lambda n: F.when(word & (F.size(before) > 0), F.concat(F.array_join(F.slice(before, -F.least(F.size(before), F.lit(n)), F.lit(n)), " "), F.lit("|"), marks("near", r"([\p{Punct}\s]*)$"), "lead"))
    right = lambda n: F.when(word & (F.size(behind) > 0), F.concat(tail, marks("behind", r"^([\p{Punct}\s]*)"), F.lit("|"), F.array_join(F.slice(behind, 1, n), " ")))
    placed = placed.withColumn("before", F.array(left(1), left(2))).withColumn("behind", F.array(right(1), right(2)))
    contexts = []
    for c, w in (("before", rising), ("behind", falling)):
        given = F.when(F.col(c)[0].isNotNull(), F.col(c))
        run = F.last(given, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        placed = placed.withColumn(f"{c}_run", run).withColumn(f"{c}_own", given.isNotNull())
        own = F.col(f"{c}_own")
        contexts.append(F.coalesce(F.transform(f"{c}_run", lambda x: F.struct(x.alias("context"), own.alias("own"))), F.array().cast("array<struct<context string, own boolean>>")))
    formed = F.coalesce(F.filter(F.array(F.struct(F.concat(F.lit("shape "), shape(F.col("value"))).alias("context"), F.lit(True).alias("own"))), lambda x: x["context"].isNotNull()), F.array().cast("array<struct<context string, own boolean>>"))
    placed = placed.filter("value <> ''").filter(valid(F.col("kind"), F.col("value")))
    return placed.select("row", "kind", "start", "end", "value", F.when(word, F.array_distinct(F.concat(*contexts, formed))).alias("contexts"))


def trusted_patterns(instances: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT, lift: float = LIFT, unknown: float = UNKNOWN) -> DataFrame:
    """Patterns of high confidence: pattern, score.

    ``instances``: value, pattern, docs, seed (whether the value was found by form), plain (whether it is ordinary), one row for each
    value and pattern, so that a value repeated in a million documents is one node. A round scores patterns by the trusted share of
    their different values: trusted ones against ordinary ones, a part (``unknown``) of the others, and ``PRIOR``, so that few can't be
    sure. Then values are scored by their best pattern. The share must be ``lift`` times that of all known values, as long as these
    leave room for it.
    """
    values = instances.groupBy("value").agg(F.bool_or("seed").alias("seed"), F.bool_or("plain").alias("plain")).filter("seed OR plain")
    seeds = values.agg(F.avg(F.col("seed").cast("double")).alias("share")).first()["share"] or 0.0
    confidence = max(confidence, min(lift * seeds, (1 + 3 * confidence) / 4))
    known = instances.withColumn("trust", F.col("seed").cast("double"))
    scores = None
    for i in range(rounds):
        trusted, plain = F.col("trust") >= confidence, F.col("plain") & ~F.col("seed")
        against = F.when(trusted, 0.0).when(plain, 1.0).otherwise(unknown)
        own = known.groupBy("pattern").agg(F.sum(F.when(trusted, F.col("trust")).otherwise(0.0)).alias("trust"), F.sum(against).alias("against"), F.sum(F.when(trusted, F.col("docs"))).alias("docs"))
        score = F.col("trust") / (F.col("trust") + F.col("against") + PRIOR)
        scores = staged(own.withColumn("score", score).filter((F.col("trust") >= support) & (F.col("docs") >= support) & (F.col("score") >= confidence)).select("pattern", "score"), "pattern-scores")
        if i + 1 < rounds:
            best = known.filter("NOT plain").join(scores, "pattern").groupBy("value").agg(F.max("score").alias("best"))
            known = staged(instances.join(best, "value", "left").withColumn("trust", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("best", F.lit(0.0)))).drop("best"), "pattern-trust")
    return scores


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT, forms: tuple[str, ...] = SEED_FORMS, examples: tuple[str, ...] = ()) -> DataFrame:
    """One row a document: doc_id, base and extra (arrays of kind, start, end, value; places in code points).

    Null texts count as empty and hold nothing. Equal rows have equal results, one row for each. An empty table gives an
    empty table. A word that overlaps a base span is not reported again. ``forms`` (patterns of whole words) and ``examples`` (words)
    are seeds besides the base spans.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    read = staged(docs.select(F.col(doc_id).alias("doc_id"), F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"), t)).alias("row"), matches(t).alias("found")), "personal-read")
    # A word is a seed if it overlaps a base span: one that began before it and ends in it or later, or one that begins in it.
    word = F.col("kind") == WORD_KIND
    rising, falling = Window.partitionBy("row").orderBy("start", "end", "kind"), Window.partitionBy("row").orderBy(F.desc("start"), F.desc("end"), "kind")
    all_spans = spans(read).withColumn("past", F.max(F.when(~word, F.col("end"))).over(rising)).withColumn("coming", F.min(F.when(~word, F.col("start"))).over(falling))
    seed = F.coalesce(F.col("past") > F.col("start"), F.lit(False)) | F.coalesce(F.col("coming") < F.col("end"), F.lit(False))
    all_spans = staged(all_spans.select("row", "kind", "start", "end", "value", "contexts", seed.alias("seed")), "personal-spans")

    # All contexts of a word are patterns, with the marks between; a run without words around it has none.
    each = all_spans.filter(word).select("row", "start", "end", "value", "seed", F.explode("contexts").alias("c")).select("row", "start", "end", "value", "seed", "c.*")
    each = each.withColumn("pattern", F.xxhash64("context"))
    formed = F.lit(False)
    for form in forms:
        formed = formed | F.rlike("value", F.lit(form))
    known = F.col("seed") | formed | (F.col("value").isin(list(examples)) if examples else F.lit(False))
    instances = staged(each.filter("own").groupBy("pattern", "value").agg(F.count("*").alias("docs"), F.bool_or(known).alias("seed"), ordinary(F.col("value")).alias("plain")), "personal-instances")
    scores = trusted_patterns(instances, rounds, confidence, support)
    new = each.filter(~F.col("seed") & ~refuted(F.col("value"))).join(scores, "pattern", "left_semi").select("row", F.lit("id").alias("kind"), "start", "end", "value").distinct()

    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    listed = all_spans.filter(~word).select("row", "kind", "start", "end", "value").unionByName(new)
    held = listed.groupBy("row").agg(*[F.sort_array(F.collect_list(F.when(c, F.struct(rank.alias("rank"), "start", "end", "kind", "value")))).alias(n) for n, c in (("base", F.col("kind") != "id"), ("extra", F.col("kind") == "id"))])
    plain = lambda c: F.coalesce(F.transform(c, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))), F.array().cast("array<struct<kind string, start int, end int, value string>>")).alias(c)
    return read.select("doc_id", "row").join(staged(held, "personal-held"), "row", "left").select("doc_id", plain("base"), plain("extra"))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents (ids unique) with every span replaced by its kind in brackets; of overlapping spans the first holds."""
    spans = found.select("doc_id", F.array_sort(F.transform(F.concat("base", "extra"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))).alias("spans"))
    packed = docs.select(F.struct(*docs.columns).alias("doc"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    joined = packed.join(spans, F.col("id").eqNullSafe(F.col("doc_id")), "left")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, s):
        made = F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"]), F.lit("["), s["kind"], F.lit("]"))
        return F.when(s["start"] >= state["at"], F.struct(s["end"].alias("at"), made.alias("out"))).otherwise(state)

    whole = F.aggregate("spans", zero, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    return joined.withColumn("text", F.when(F.col("spans").isNull(), F.col("text")).otherwise(whole)).select(F.col("doc").withField(text, F.col("text")).alias("doc")).select("doc.*")
