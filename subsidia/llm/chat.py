"""Chat formatting: records of different layouts become turns, then one marked text, with DataFrame functions only.

A record is a VARIANT. Its nested field paths, those that some layout knows, without types and values, are hashed to a fingerprint;
the fingerprint picks a declarative mapping from fields to turns. So one table may hold messages, prompt/completion pairs and instruction records
side by side, and a layout that no mapping covers is reported rather than guessed.

The template marks each turn as ``<turn ROLE>\\nTEXT</turn>\\n``. Inside roles and texts ``\\`` becomes ``\\e`` and ``<``
becomes ``\\l``, in roles ``>`` becomes ``\\g`` too, so neither a mark nor an escape can be forged and reading back is exact.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role string, text string>>"


@dataclass(frozen=True)
class Layout:
    """A mapping: either a list (``path`` with the two field names) or fixed fields (role, path) in order."""

    name: str
    paths: tuple[str, ...]
    list_path: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout("messages", ("messages[].content", "messages[].role"), "$.messages", "role", "content"),
    Layout("messages_parts", ("messages[].content[].text", "messages[].role"), "$.messages", "role", "content"),
    Layout("nested_messages", ("data.messages[].content", "data.messages[].role"), "$.data.messages", "role", "content"),
    Layout("conversations", ("conversations[].from", "conversations[].value"), "$.conversations", "from", "value"),
    Layout("prompt", ("completion", "prompt"), fields=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout("chosen", ("prompt", "response"), fields=(("user", "$.prompt"), ("assistant", "$.response"))),
    Layout("instruction", ("instruction", "output"), fields=(("user", "$.instruction"), ("assistant", "$.output"))),
    Layout("instruction_input", ("input", "instruction", "output"), fields=(("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Layout("question", ("answer", "question"), fields=(("user", "$.question"), ("assistant", "$.answer"))),
)

#: Names that other writers give to the roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(record: Column) -> Column:
    """The nested paths of a record's leaves, such as ``messages[].role``, from its schema; without types and values.

    An empty list has the path of its elements (``messages[]``). The walk over the schema keeps the path of each open bracket.
    """
    tokens = F.regexp_extract_all(F.schema_of_variant(record), F.lit(r"`[^`]*`(?=: )|[^\s,<>:`]+(?=: )|OBJECT<|ARRAY<|>|[A-Z_]+(?:\([0-9, ]*\))?"), F.lit(0))
    none = F.array().cast("array<string>")
    zero = F.struct(none.alias("open"), F.lit("").alias("at"), none.alias("paths"))

    def step(s, token):
        top = F.coalesce(F.try_element_at(s["open"], F.lit(-1)), F.lit(""))
        inside = F.concat(s["at"], F.when(token == "ARRAY<", "[]").otherwise(""))
        leaf = F.rlike(token, F.lit(r"^[A-Z_]+(\([0-9, ]*\))?$")) & (s["at"] != top)
        name = F.concat(top, F.when((top == "") | (token == ""), "").otherwise("."), F.translate(token, "`", ""))
        return (
            F.when(token.isin("OBJECT<", "ARRAY<"), F.struct(F.array_append(s["open"], inside).alias("open"), inside.alias("at"), s["paths"].alias("paths")))
            .when(token == ">", F.struct(F.slice(s["open"], 1, F.greatest(F.size(s["open"]) - 1, F.lit(0))).alias("open"), F.coalesce(F.try_element_at(s["open"], F.lit(-2)), F.lit("")).alias("at"), s["paths"].alias("paths")))
            .when(leaf | F.endswith(s["at"], F.lit("[]")) & F.rlike(token, F.lit(r"^[A-Z_]+(\([0-9, ]*\))?$")), F.struct(s["open"].alias("open"), top.alias("at"), F.array_append(s["paths"], s["at"]).alias("paths")))
            .otherwise(F.struct(s["open"].alias("open"), name.alias("at"), s["paths"].alias("paths")))
        )

    return F.aggregate(tokens, zero, step, lambda s: F.array_sort(F.array_distinct(s["paths"])))


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of those field paths of the record that some layout knows; other fields don't count."""
    known = sorted({p for x in layouts for p in (*x.paths, *_empty(x))})
    return F.md5(F.array_join(F.array_intersect(field_paths(record), F.array(*map(F.lit, known))), "\n"))


def _empty(layout: Layout) -> tuple[str, ...]:
    """The path that a list layout has when its list is empty."""
    return (layout.list_path[2:] + "[]",) if layout.list_path else ()


def canonical(df: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds fingerprint, layout (null if no mapping fits) and turns (role, text; null where layout is null); columns of these names
    are replaced.

    Fields that no layout knows don't matter. Null texts become empty ones, null roles empty. A content given as a list of parts is
    their texts, joined. Roles of messages stay as they are; those of records written as from/value get their usual names. Null
    fields of a fixed layout give no turn; a list keeps every element. An empty list has a layout if its path is known.
    Null records have none.
    """
    mark_of = lambda paths: hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()
    print_of = {mark_of(_empty(x)): x for x in reversed(layouts) if x.list_path} | {mark_of(x.paths): x for x in layouts}
    key, name, turns = F.col("fingerprint"), F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    role = lambda r: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv]), F.coalesce(r, F.lit(""))), r, F.lit(""))
    turn = lambda r, t: F.struct(r.alias("role"), F.coalesce(t, F.lit("")).alias("text"))
    for mark, x in print_of.items():
        if x.list_path:
            items = F.variant_get(record, x.list_path, f"array<struct<`{x.role}` string, `{x.text}` variant>>")
            made = F.transform(items, _from_item(x, turn, role))
        else:
            each = [F.variant_get(record, path, "string") for _, path in x.fields]
            made = F.filter(F.array(*[F.when(t.isNotNull(), turn(F.lit(r), t)) for (r, _), t in zip(x.fields, each, strict=True)]), lambda t: t.isNotNull())
        name = F.when(key == mark, F.lit(x.name)).otherwise(name)
        turns = F.when(key == mark, made.cast(TURNS)).otherwise(turns)
    return df.withColumn("fingerprint", fingerprint(F.col(record), layouts)).withColumn("layout", name).withColumn("turns", turns)


def _from_item(layout: Layout, turn, role):
    named = role if layout.role == "from" else (lambda r: F.coalesce(r, F.lit("")))

    def text(content):
        parts = F.try_variant_get(content, "$", "array<struct<text string>>")
        joined = F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "")
        return F.when(F.startswith(F.schema_of_variant(content), F.lit("ARRAY")), joined).otherwise(F.try_variant_get(content, "$", "string"))

    return lambda item: turn(named(item[layout.role]), text(item[layout.text]))


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\e")), F.lit("<"), F.lit("\\l"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(">"), F.lit("\\g"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")), F.lit("\\e"), F.lit("\\"))


def formatted(df: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Adds formatted (the marked text) and loss_spans: (start, length) in code points of the texts of roles to learn.

    Columns of these names are replaced. Null turns have null results; no turns give an empty text without spans.
    """
    marked = F.transform("turns", lambda t: F.concat(F.lit("<turn "), escaped_role(t["role"]), F.lit(">\n"), escaped(t["text"]), F.lit("</turn>\n")))
    step = lambda s, t: F.struct(
        (s["at"] + F.length(t["whole"])).cast("long").alias("at"),
        F.when(t["learn"], F.array_append(s["spans"], F.struct((s["at"] + t["head"]).cast("long").alias("start"), t["n"].cast("long").alias("length")))).otherwise(s["spans"]).alias("spans"),
    )
    parts = F.zip_with("turns", marked, lambda t, m: F.struct(m.alias("whole"), t["role"].isin(*learn).alias("learn"), (F.length(escaped_role(t["role"])) + 8).alias("head"), F.length(escaped(t["text"])).alias("n")))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start bigint, length bigint>>").alias("spans"))
    return df.withColumn("loss_spans", F.aggregate(parts, zero, step, lambda s: s["spans"])).withColumn("formatted", F.array_join(marked, ""))


def read_turns(formatted_text: Column) -> Column:
    """The turns (role, text) of a marked text."""
    pieces = F.filter(F.split(formatted_text, "</turn>\n"), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(unescaped(F.substring(F.substring_index(p, ">\n", 1), 7, F.length(p))).alias("role"), unescaped(F.substring(p, F.instr(p, ">\n") + 2, F.length(p))).alias("text")))


def read_loss(formatted_text: Column, spans: Column) -> Column:
    """All text under the loss mask."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(formatted_text, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def conversations_as_records(rows: DataFrame, vary: bool = False) -> DataFrame:
    """(conv_id, record): the rows of each conversation by turn, as one record in the layout of messages.

    ``vary`` deals conversations, by a hash of their id, over all layouts that hold them without loss: messages (also with names,
    nested, or in parts), from/value unless a role has another name there, and prompt/completion for a user's and an
    assistant's turn. A conversation is one training example, so its rows meet in one task, as its text does. Equal turns are ordered
    by role, then text; null turns come first. Null roles and texts are empty.
    """
    message = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(message)).alias("m"))
    made = lambda f: F.transform("m", f)
    plain = made(lambda x: F.struct(x["content"].alias("content"), x["role"].alias("role")))
    record = F.to_variant_object(F.struct(plain.alias("messages")))
    if vary:
        named = made(lambda x: F.struct(x["content"].alias("content"), F.lit("n").alias("name"), x["role"].alias("role")))
        parts = made(lambda x: F.struct(F.array(F.struct(F.lit("text").alias("type"), x["content"].alias("text"))).alias("content"), x["role"].alias("role")))
        pairs = made(lambda x: F.struct(x["role"].alias("from"), x["content"].alias("value")))
        usual = ~F.exists("m", lambda x: x["role"].isin(*ROLES))
        single = F.coalesce((F.size("m") == 2) & (F.try_element_at("m", F.lit(1))["role"] == "user") & (F.try_element_at("m", F.lit(2))["role"] == "assistant"), F.lit(False))
        text = lambda i: F.try_element_at("m", F.lit(i))["content"]
        kind = F.pmod(F.xxhash64("conv_id"), F.lit(6))
        record = (
            F.when((kind == 1) & single, F.to_variant_object(F.struct(F.lit(7).alias("id"), text(1).alias("prompt"), text(2).alias("completion"))))
            .when((kind == 2) & usual, F.to_variant_object(F.struct(pairs.alias("conversations"))))
            .when(kind == 3, F.to_variant_object(F.struct(named.alias("messages"), F.lit("x").alias("note"))))
            .when(kind == 4, F.to_variant_object(F.struct(F.struct(plain.alias("messages")).alias("data"))))
            .when(kind == 5, F.to_variant_object(F.struct(parts.alias("messages"))))
            .otherwise(record)
        )
    return held.select("conv_id", record.alias("record"))
