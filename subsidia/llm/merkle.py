"""A Merkle manifest of a dataset: trees of runs of eight, and proofs that are climbed by a recursive query.

Leaves are numbered within their group (``lang``) by one range shuffle and prefix sums of run lengths, so no task holds a group. Every
level is written as node rows that name their parent: id, up (the parent's id), slot (place in the parent's run) and the
children's digests. A recursive query then ascends from the leaves to the root: the eight leaves of a run share all siblings
above it and climb in one row, each with its own folded digest. Nodes near the root, of which there are at most ``TOP_NODES``, are
broadcast, so that the root is no hot key; below, a node meets only the runs under it.

Digests are kept as 32 bytes and hashed as lower-case hex text.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsidia.llm.common import staged

#: Nodes that are broadcast, of some 350 bytes.
TOP_NODES = 4_096
#: The tree of subroots.
TOP_TREE = -1
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def digest(*parts: Column) -> Column:
    """sha256 of the parts one after another, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def text_of(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def leaf_hash(fields: list[Column]) -> Column:
    """The digest of a row: of each field ``-`` if null, else its UTF-8 length in bytes, ``:`` and the value."""
    spelled = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in spelled])


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """``df`` in ranges of ``order`` (nulls first), written, with _at: the partition in the upper bits, the row in it in the lower 33."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranked")


def runs_of(df: DataFrame, *by: str) -> DataFrame:
    """For each value of ``by`` and partition of ``ranked`` rows: _part, _shift (added to _at gives the position within ``by``), n (rows of ``by``)."""
    runs = df.groupBy(*by, F.shiftright("_at", 33).alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_c"))
    before = F.sum("_c").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    return runs.select(*by, "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_c").over(Window.partitionBy(*by)).alias("n"))


def numbered_trees(runs: DataFrame, group: str) -> DataFrame:
    """(group, tree): the groups numbered from 0 in their order, null first."""
    groups = ranked(runs.select(group).distinct(), group)
    at = groups.withColumn("_part", F.shiftright("_at", 33)).join(runs_of(groups), "_part")
    return at.select(group, (F.col("_at") + F.col("_shift")).alias("tree"))


def node_id(tree: Column, level: Column, pos: Column) -> Column:
    return F.concat_ws("/", tree, level, pos)


@dataclass
class Manifest:
    """packs: the runs of leaves (id, up, up_stage, slot, tree, children, members); stages: the number and the node rows of each
    level above, lowest first; subroots: (tree, subroot); root: 64 hex digits, None for an empty dataset."""

    packs: DataFrame
    stages: list[tuple[int, DataFrame]]
    subroots: DataFrame
    root: str | None


def _linked(nodes: DataFrame, trees: int, height: int, arity: int) -> DataFrame:
    """Adds id, up, up_stage and slot to rows of tree, level, pos and n (leaves of the tree). The stage of a node of the
    tree of subroots is its level after the ``height`` of the highest other tree."""
    last, top, level = F.col("n") <= F.pow(F.lit(float(arity)), F.col("level")), F.col("tree") == TOP_TREE, F.col("level") + 1
    joins_top = last & ~top & F.lit(trees > 1)
    up = F.when(~last, node_id(F.col("tree"), level, F.expr(f"pos div {arity}"))).when(joins_top, node_id(F.lit(TOP_TREE), F.lit(1), F.expr(f"tree div {arity}")))
    up_stage = F.when(~last, F.when(top, level + height).otherwise(level)).when(joins_top, height + 1)
    slot = F.when(last & ~top, F.col("tree")).otherwise(F.col("pos")) % arity
    return nodes.withColumns({"id": node_id(F.col("tree"), F.col("level"), F.col("pos")), "up": up, "up_stage": up_stage, "slot": slot.cast("int")})


def _parents(nodes: DataFrame, trees: int, height: int, arity: int) -> DataFrame:
    """The next level of rows (tree, level, pos, n, hash) of one level."""
    run = F.transform(F.sort_array(F.collect_list(F.struct("pos", "hash"))), lambda x: F.hex(x["hash"]))
    up = nodes.groupBy("tree", "n", "level", F.expr(f"pos div {arity}").alias("parent")).agg(F.unhex(F.array_join(run, "")).alias("children"))
    up = up.select("tree", "n", (F.col("level") + 1).alias("level"), F.col("parent").alias("pos"), "children", digest(text_of(F.col("children"))).alias("hash"))
    return staged(_linked(up, trees, height, arity), "nodes")


def build(leaves: DataFrame, group: str, order: list[str], member: list[str], leaf: str = "leaf", arity: int = 8) -> Manifest:
    """The manifest of rows that hold a digest ``leaf``; ``member`` columns go along with each leaf.

    Leaves are ordered by ``order``, nulls first, ties by digest; rows that are equal in that too are interchangeable, and each
    is a leaf. A null group is a group, the first. A group of one leaf has that leaf as its subroot; a single group's subroot is the root.
    An empty table gives empty packs and no root.
    """
    rows = staged(leaves.select(group, *order, *[c for c in member if c not in (group, leaf, *order)], leaf, F.monotonically_increasing_id().alias("_row")), "leaves")
    at = ranked(rows, group, *order, leaf, "_row")
    runs = staged(runs_of(at, group), "runs")
    trees = staged(numbered_trees(runs, group), "trees")
    n_trees, longest = trees.count(), runs.agg(F.max("n")).first()[0] or 0
    height = next(h for h in range(64) if longest <= arity**h)
    same = lambda a, b: a[group].eqNullSafe(b[group])
    runs = runs.join(trees, same(runs, trees)).select(runs[group], "_part", "_shift", "n", "tree")
    placed = at.withColumn("_part", F.shiftright("_at", 33))
    placed = placed.join(runs, same(placed, runs) & (placed["_part"] == runs["_part"])).withColumn("pos", F.col("_at") + F.col("_shift"))
    gathered = placed.groupBy("tree", "n", F.expr(f"pos div {arity}").alias("parent")).agg(
        F.sort_array(F.collect_list(F.struct("pos", F.struct(F.col(leaf).alias("leaf"), *[placed[c] for c in member]).alias("member")))).alias("members")
    )
    packs = gathered.select("tree", "n", F.when(F.col("n") > 1, 1).otherwise(0).alias("level"), F.col("parent").alias("pos"), F.col("members.member").alias("members"))
    packs = packs.withColumn("children", F.unhex(F.array_join(F.transform("members", lambda m: F.hex(m["leaf"])), "")))
    packs = packs.withColumn("hash", F.when(F.col("n") > 1, digest(text_of(F.col("children")))).otherwise(F.col("children")))
    packs = staged(_linked(packs, n_trees, height, arity), "packs")
    is_last = F.col("n") <= F.pow(F.lit(float(arity)), F.col("level"))
    stages, last, below = [], [packs.filter(is_last)], packs
    for level in range(2, height + 1):
        below = _parents(below.filter(~is_last), n_trees, height, arity)
        stages.append((level, below))
        last.append(below.filter(is_last))
    subroots = last[0].select("tree", "hash")
    for x in last[1:]:
        subroots = subroots.unionByName(x.select("tree", "hash"))
    subroots = staged(subroots, "subroots")
    top, level = subroots.select(F.lit(TOP_TREE).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.lit(0).alias("level"), F.col("tree").alias("pos"), "hash"), 0
    while n_trees > arity**level:
        top, level = _parents(top, n_trees, height, arity), level + 1
        stages.append((height + level, top))
    root = top.select(text_of(F.col("hash"))).first()
    return Manifest(packs, stages, subroots.select("tree", text_of(F.col("hash")).alias("subroot")), root and root[0])


#: From a row to its parent's: folds each digest into the parent's run and appends the run's other digests.
CLIMB = """
WITH RECURSIVE climb(pack, up, up_stage, slot, folded, siblings) AS (
  SELECT pack, up, up_stage, slot, folded, siblings FROM {start}
  UNION ALL
  SELECT HINT c.pack, n.up, n.up_stage, n.slot,
         transform(c.folded, h -> unhex(sha2(lower(hex(concat(left(n.children, 32 * c.slot), h, substring(n.children, 32 * c.slot + 33)))), 256))),
         concat(c.siblings, left(n.children, 32 * c.slot), substring(n.children, 32 * c.slot + 33))
  FROM climb c JOIN {nodes} n ON n.id = c.up
)
SELECT * FROM climb WHERE up_stage IS NULL OR up_stage > {highest}"""


def _ascend(start: DataFrame, stages: list[tuple[int, DataFrame]], hint: str = "") -> DataFrame:
    """``start`` after its climb through ``stages``: the rows whose parent lies above them."""
    if not stages:
        return start
    spark = start.sparkSession
    nodes = functools.reduce(DataFrame.unionByName, [s.select("id", "up", "up_stage", "slot", "children") for _, s in stages])
    limit = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")  # a level has as many rows as there are runs of leaves
    try:
        return staged(spark.sql(CLIMB.replace("HINT", hint), start=start, nodes=nodes, highest=stages[-1][0]), "climbed")
    finally:
        if limit is None:
            spark.conf.unset(ROW_LIMIT)
        else:
            spark.conf.set(ROW_LIMIT, limit)


def climb(manifest: Manifest, tampered: str = "tampered", top_nodes: int = TOP_NODES) -> DataFrame:
    """One row a leaf: its member columns, leaf, subroot, root (hex), proof (the siblings' digests from the leaf's run to the root, left
    to right, 32 bytes each) and folded (hex): the root that follows from the member column ``tampered``, a digest or null for the leaf itself.
    """
    cut, held = len(manifest.stages), 0
    while cut and (held := held + manifest.stages[cut - 1][1].count()) <= top_nodes:
        cut -= 1
    changed = lambda m: F.coalesce(m[tampered], m["leaf"])
    before, behind = lambda i: F.left("children", 32 * i), lambda i: F.substring("children", 32 * i + 33, F.lit(1 << 20))
    refolded = F.transform("members", lambda m, i: digest(text_of(F.concat(before(i), changed(m), behind(i)))))
    packs = manifest.packs
    folded = F.when(F.col("n") > 1, refolded).otherwise(F.transform("members", changed))
    start = packs.select(F.col("id").alias("pack"), "up", "up_stage", "slot", folded.alias("folded"), F.expr("cast('' as binary)").alias("siblings"))
    climbed = _ascend(_ascend(start, manifest.stages[:cut]), manifest.stages[cut:], "/*+ BROADCAST(n) */")
    joined = packs.join(climbed.select("pack", "folded", "siblings"), F.col("id") == F.col("pack"))
    each = joined.select("tree", "children", "siblings", F.posexplode(F.arrays_zip("members", "folded")).alias("_i", "_m"))
    names = [f.name for f in packs.schema["members"].dataType.elementType if f.name != "leaf"]
    out = each.select(
        "tree",
        *[F.col("_m.members")[c].alias(c) for c in names],
        text_of(F.col("_m.members.leaf")).alias("leaf"),
        F.concat(before(F.col("_i")), behind(F.col("_i")), "siblings").alias("proof"),
        text_of(F.col("_m.folded")).alias("folded"),
    )
    return out.join(manifest.subroots, "tree").drop("tree").withColumn("root", F.lit(manifest.root).cast("string"))


#: The columns of documents in the order of their leaf.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, tampered: the digest with the text's A-Z lower-cased where 3 divides crc32(doc_id), else null.

    A null id is never tampered with, a null text stays null. Other columns are ignored.
    """
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    changed = leaf_hash([lowered if c == "text" else F.col(c) for c in FIELDS])
    return docs.select("doc_id", "lang", leaf_hash([F.col(c) for c in FIELDS]).alias("leaf"), F.when(chosen, changed).alias("tampered"))
