"""Operator 12: a Merkle manifest of a dataset, and the proof of each row by a recursive query.

A row's hash is a leaf; every ARITY consecutive nodes of a tree become their parent's hash, until one is left: the group's
subroot. Subroots, in the order of their groups, are the leaves of one more tree, whose last node is the root.

Built levels are stored as rows that link a node to an ancestor: the levels between a node and the ancestor STRIDE levels up
make one link, which holds the siblings to the left and right at each of them. So a tree of 10^10 rows is climbed in seven
steps, and links above the first hold a twenty-seventh of the rows. The climb is a recursive query: it joins each leaf's place with the
links, appends the siblings as a row of its own (a proof isn't copied from step to step) and folds the leaf's hash with them.

Rows are numbered within their group without a window over it: they are dealt by range, and a range's rows are counted on
from those of the ranges before. So a group with any share of all rows is many tasks.

Groups are ordered null first, then bytewise. Within a group null ids come first; rows of one id are ordered by their
leaves, and rows alike in both are interchangeable. No rows: no root, and an empty result. Only the named columns are read,
so others may have any names. A text of any length is hashed as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import materialise

ARITY, STRIDE = 3, 3
#: The tree of the subroots (groups are numbered from 0).
TOP = -1
#: Rows of a climb that Spark allows by default are fewer than a large dataset's.
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


@dataclass(frozen=True)
class Manifest:
    """leaves: tree, pos, id, leaf, shown (the hash that is to be verified), subroot, path, up_tree, up_level, up_idx;
    links: tree, level, idx, path, up_tree, up_level, up_idx; root: None without rows."""

    leaves: DataFrame
    links: DataFrame
    root: str | None


def digest(parts: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of the columns, each as `-` if null, else its UTF-8 byte count, a colon and itself."""
    told = [F.coalesce(F.concat(F.octet_length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("-")) for p in parts]
    return F.sha2(F.concat(*told), 256)


def numbered(df: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """df with pos (from 0) and n (rows) within each tree. Equal rows are dealt by a number that follows from their place."""
    dealt = df.withColumn("_tie", F.rand(7)).repartitionByRange(tree, *order, "_tie").withColumn("_part", F.spark_partition_id())
    dealt = materialise(dealt)
    counts = dealt.groupBy(tree, "_part").agg(F.count("*").alias("_own"))
    along = Window.partitionBy(tree).orderBy("_part")
    before = counts.select(tree, "_part", (F.sum("_own").over(along) - F.col("_own")).alias("_before"), F.sum("_own").over(Window.partitionBy(tree)).alias("n"))
    placed = dealt.withColumn("_place", F.row_number().over(Window.partitionBy(tree, "_part").orderBy(*order, "_tie")))
    return placed.join(before, [tree, "_part"]).withColumn("pos", F.col("_before") + F.col("_place") - 1).drop("_tie", "_part", "_place", "_before", "_own")


def _levels(groups: DataFrame, stride: int) -> DataFrame:
    """groups with h1, h2, ...: the hashes of the nodes so many levels above `kids`."""
    groups = groups.withColumn("h0", F.transform("kids", lambda x: x["hash"]))
    for t in range(stride):
        runs = F.sequence(F.lit(0), F.floor((F.size(f"h{t}") - 1) / ARITY).cast("int"))
        groups = groups.withColumn(f"h{t + 1}", F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(F.col(f"h{t}"), i * ARITY + 1, ARITY), ""), 256)))  # noqa: B023
    return groups.drop("h0")


def _path(place: Column, height: Column, stride: int) -> Column:
    """(before, after) of a kid at each of height levels."""
    steps = []
    for t in range(stride):
        run, own = F.floor(place / ARITY ** (t + 1)).cast("int") * ARITY, F.floor(place / ARITY**t).cast("int") % ARITY
        part = lambda start, count, t=t: F.array_join(F.slice(F.col(f"h{t}"), start, count), "")
        steps.append(F.struct(part(run + 1, own).alias("before"), part(run + own + 2, ARITY - 1 - own).alias("after")))
    return F.slice(F.array(*steps), F.lit(1), height)


def _linked(groups: DataFrame, level: int, top: bool, stride: int) -> DataFrame:
    """The kids of each group with their path and the place that it leads to: a node of the same tree or, at its end, the
    leaf of the top tree (nowhere in the top tree)."""
    last = F.col("n") <= ARITY**stride
    kids = groups.withColumn("h0", F.transform("kids", lambda x: x["hash"]))
    kids = kids.select("tree", "n", "height", "parent", *[f"h{t}" for t in range(stride)], F.explode("kids").alias("kid"))
    place = (F.col("kid.idx") % ARITY**stride).cast("int")
    nowhere = F.lit(None).cast("long")
    return kids.select(
        "tree", F.lit(level).cast("long").alias("level"), "kid.*", _path(place, F.col("height"), stride).alias("path"),
        F.when(last, nowhere if top else F.lit(TOP).cast("long")).otherwise(F.col("tree")).alias("up_tree"),
        F.when(last, nowhere if top else F.lit(0).cast("long")).otherwise(F.lit(level + 1).cast("long")).alias("up_level"),
        F.when(last, nowhere if top else F.col("tree")).otherwise(F.col("parent")).alias("up_idx"),
    )


def _built(leaves: DataFrame, most: int, top: bool, extra: Sequence[str] = (), stride: int = STRIDE) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """(linked leaves with extra, links above them, (tree, hash) of the last nodes). leaves: tree, idx, hash, n, extra; most:
    the greatest n. Trees of one leaf have no link: their leaf is their last node."""
    width = ARITY**stride
    height = F.lit(stride)
    for t in range(stride - 1, 0, -1):
        height = F.when(F.col("n") <= ARITY**t, t).otherwise(height)
    linked, links, ended = None, [], [leaves.where("n = 1").select("tree", "hash")]
    nodes, level = leaves.where("n > 1"), 0
    while most > 1 or linked is None:
        kid = F.struct("idx", "hash", *(extra if level == 0 else ()))
        groups = nodes.groupBy("tree", F.floor(F.col("idx") / width).alias("parent")).agg(F.array_sort(F.collect_list(kid)).alias("kids"), F.max("n").alias("n"))
        groups = materialise(_levels(groups.withColumn("height", height), stride))
        made = _linked(groups, level, top, stride)
        if linked is None:
            linked = made
        else:
            links.append(made.drop("hash"))
        last = F.element_at(F.array(*[F.element_at(f"h{t}", 1) for t in range(1, stride + 1)]), F.col("height"))
        above = groups.select("tree", F.col("parent").alias("idx"), last.alias("hash"), F.ceil(F.col("n") / width).alias("n"))
        ended.append(above.where("n = 1").select("tree", "hash"))
        nodes, level, most = above.where("n > 1"), level + 1, -(-most // width)
    return linked, links, reduce(DataFrame.unionByName, ended)


def build(rows: DataFrame, group: str, id_: str, leaf: str, shown: str, stride: int = STRIDE) -> Manifest:
    """The manifest of rows (group, id, leaf, shown: the leaf as it is now, null if unchanged), written level by level."""
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))  # null first, then bytewise
    leaves = materialise(rows.select(tree.alias("name"), F.col(id_).alias("id"), F.col(leaf).alias("leaf"), F.col(shown).alias("shown")))
    placed = numbered(leaves, "name", ["id", "leaf"])
    names = numbered(leaves.groupBy("name").agg(F.count("*").alias("size")).withColumn("all", F.lit(0)), "all", ["name"])
    names = materialise(names.select("name", "size", F.col("pos").alias("tree"), F.col("n").alias("trees")))
    most, trees = names.agg(F.max("size"), F.max("trees")).first()
    own = placed.drop("n").join(names.select("name", "tree", F.col("size").alias("n")), "name")
    own = materialise(own.select("tree", F.col("pos").alias("idx"), F.col("leaf").alias("hash"), "n", "id", "shown"))
    linked, links, subroots = _built(own, most or 1, False, ("id", "shown"), stride)
    lone = own.where("n = 1").withColumn("path", F.lit(None).cast(linked.schema["path"].dataType))
    lone = lone.withColumns({"level": F.lit(0).cast("long"), "up_tree": F.lit(TOP).cast("long"), "up_level": F.lit(0).cast("long"), "up_idx": F.col("tree")}).drop("n")
    subroots = materialise(subroots)
    tops = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "hash", F.lit(trees or 0).cast("long").alias("n"))
    first, above, ends = _built(tops, trees or 1, True, stride=stride)
    every = reduce(DataFrame.unionByName, [*links, first.drop("hash"), *above])
    root = ends.select("hash").first()
    known = linked.unionByName(lone).join(subroots.select("tree", F.col("hash").alias("subroot")), "tree")
    return Manifest(known.withColumnsRenamed({"idx": "pos", "hash": "leaf"}).drop("level"), materialise(every), root["hash"] if root else None)


CLIMB = """
WITH RECURSIVE climb(tree, pos, up_tree, up_level, up_idx, folded, step, siblings, id, leaf, subroot) AS (
  SELECT tree, pos, up_tree, up_level, up_idx, {fold_first}, 0, {siblings}, id, leaf, subroot FROM {{leaves}}
  UNION ALL
  SELECT c.tree, c.pos, l.up_tree, l.up_level, l.up_idx, {fold_next}, c.step + 1, {siblings_next}, CAST(NULL AS {id_type}), CAST(NULL AS STRING), CAST(NULL AS STRING)
  FROM climb c JOIN {{links}} l ON c.up_tree = l.tree AND c.up_level = l.level AND c.up_idx = l.idx)
SELECT * FROM climb
"""


def proofs(manifest: Manifest) -> DataFrame:
    """id, leaf, subroot, root, proof (the siblings' digests on end, binary), folded_root: the root recomputed from the hash
    shown and the siblings; verified: whether it is the root. One row for each leaf."""
    spark = manifest.leaves.sparkSession
    fold = "aggregate(coalesce({0}, array()), {1}, (h, p) -> sha2(concat(p.before, h, p.after), 256))"
    own = "unhex(array_join(transform(coalesce({0}, array()), p -> concat(p.before, p.after)), ''))"
    query = CLIMB.format(
        fold_first=fold.format("path", "coalesce(shown, leaf)"), fold_next=fold.format("l.path", "c.folded"),
        siblings=own.format("path"), siblings_next=own.format("l.path"), id_type=manifest.leaves.schema["id"].dataType.simpleString(),
    )
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        steps = materialise(spark.sql(query, leaves=manifest.leaves, links=manifest.links))
    finally:
        spark.conf.set(ROW_LIMIT, before)
    told = F.array_sort(F.collect_list(F.struct("step", "siblings")))
    proof = F.unhex(F.array_join(F.transform(told, lambda x: F.hex(x["siblings"])), ""))
    keep = [F.first(c, ignorenulls=True).alias(c) for c in ("id", "leaf", "subroot")]
    whole = steps.groupBy("tree", "pos").agg(*keep, proof.alias("proof"), F.max_by("folded", "step").alias("folded_root"))
    root = F.lit(manifest.root).cast("string")
    return whole.select("id", "leaf", "subroot", root.alias("root"), "proof", "folded_root", (F.col("folded_root") == root).alias("verified"))


def verify(docs: DataFrame, changed: Column, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), text: str = "text", group: str = "source", id_: str = "doc_id") -> DataFrame:
    """proofs() of docs against the manifest of docs, where the text shown is changed; both hashes come from one reading."""
    leaf = digest([F.col(f"`{c}`") for c in columns])
    shown = digest([changed if c == text else F.col(f"`{c}`") for c in columns])
    rows = docs.select(F.col(f"`{group}`").alias("grp"), F.col(f"`{id_}`").alias("id"), leaf.alias("leaf"), F.when(~changed.eqNullSafe(F.col(f"`{text}`")), shown).alias("shown"))
    return proofs(build(rows, "grp", "id", "leaf", "shown"))
