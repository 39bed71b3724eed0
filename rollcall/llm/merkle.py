"""Merkle manifest of a dataset: a tree of digests over all rows.

Every row is a leaf.  The leaves of a group, in order, are hashed in runs of
``FANOUT`` until one digest is left, the group's subroot; the subroots, in the
order of their groups, are hashed likewise to the root.

* Places in the order are given without a global window: rows are range
  partitioned and sorted, and each partition's rows are counted on from those
  of the partitions before it (one row per partition and group is summed up).
* A level is one slot pivot: grouped by parent, conditional aggregates spread
  the children into ``FANOUT`` columns, and their concatenation is hashed.  No
  group has more than ``FANOUT`` rows, however large a group of rows is.
* Proofs go down again, level by level: a parent's columns without the own slot
  are the siblings, put in front of the siblings of the parent.  The digests of
  all levels above the leaves are an eighth of the rows.

Levels are written tables, so a lost executor costs only what it ran.

Edge cases: a null field is ``-``; rows with equal ids are ordered by their
leaf digest, null ids come first; equal rows are separate leaves; a null group
comes before all others; a group of one row is its own subroot, one group is the
root; an empty table gives an empty result.  Texts of any length are hashed in
place and travel no further.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, written

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts put together; null parts are nothing."""
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """``-`` or the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row, some of its fields changed."""
    return digest(*(field(changed.get(name, F.col(name))) for name in FIELDS))


def tampered_leaf() -> Column:
    """The digest after tampering, which lower-cases the text of every row
    whose id has a crc32 that 3 divides; null where a row is let alone."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, leaf(text=ascii_lower(F.col("text"))))


def numbered(rows: DataFrame, group: str, order: list[str], what: str) -> DataFrame:
    """Rows with ``pos``, their place from 0 on in their group (not null)."""
    ranged = written(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                     .withColumn("_at", F.monotonically_increasing_id())
                     .withColumn("_part", F.spark_partition_id()), f"{what}-ranged")
    runs = ranged.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(runs.select(group, "_part", (F.col("_first") - F.coalesce(F.sum("_n").over(earlier), F.lit(0))).alias("_zero")),
                     f"{what}-starts")
    return ranged.join(starts, [group, "_part"]).withColumn("pos", F.col("_at") - F.col("_zero")).drop("_at", "_part", "_zero")


def _pivots(nodes: DataFrame, what: str) -> tuple[list[DataFrame], DataFrame]:
    """From ``grp, pos, node, payload`` the levels (``grp, pos, slots``: the
    children of the node in that place, null where there is none) from the
    lowest up, and ``grp, depth, subroot``."""
    sizes = written(nodes.groupBy("grp").agg(F.count("*").alias("n")), f"{what}-sizes")
    depth, n = 0, sizes.agg(F.max("n")).first()[0] or 1
    while FANOUT ** depth < n:
        depth += 1
    depths = F.lit(0)
    for d in range(depth):
        depths = F.when(F.col("n") > FANOUT ** d, F.lit(d + 1)).otherwise(depths)
    sizes = sizes.select("grp", depths.alias("depth"))
    now = nodes.join(sizes, "grp")
    roots = [now.where("depth = 0").select("grp", "depth", F.col("node").alias("subroot"))]
    levels = []
    for d in range(1, depth + 1):
        own = ["node", "payload"] if d == 1 else ["node"]
        slots = [F.max(F.when(F.col("pos") % FANOUT == s, F.struct(*own))).alias(f"s{s}") for s in range(FANOUT)]
        spread = (now.where(F.col("depth") >= d).groupBy("grp", "depth", F.floor(F.col("pos") / FANOUT).cast("long").alias("parent"))
                  .agg(*slots))
        level = written(spread.withColumn("node", digest(*(F.col(f"s{s}.node") for s in range(FANOUT)))), f"{what}-level-{d}")
        now = level.select("grp", "depth", F.col("parent").alias("pos"), "node")
        roots.append(now.where(F.col("depth") == d).select("grp", "depth", F.col("node").alias("subroot")))
        levels.append(level)
    found = roots[0]
    for r in roots[1:]:
        found = found.unionByName(r)
    return levels, written(found, f"{what}-roots")


def _children(parents: DataFrame) -> DataFrame:
    """The children of pivoted rows that carry a ``path``, each with its own
    siblings put before it."""
    def one(s: int) -> Column:
        def side(slots) -> Column:
            return F.concat_ws("", *(F.col(f"s{i}.node") for i in slots))
        step = F.struct(side(range(s)).alias("before"), side(range(s + 1, FANOUT)).alias("after"))
        return F.when(F.col(f"s{s}").isNotNull(), F.struct(
            (F.col("parent") * FANOUT + s).alias("pos"), F.col(f"s{s}").alias("child"),
            F.concat(F.array(step), F.col("path")).alias("path")))
    kept = [c for c in ("grp", "depth", "subroot") if c in parents.columns]
    return (parents.select(*kept, F.explode(F.array_compact(F.array(*(one(s) for s in range(FANOUT))))).alias("c"))
            .select(*kept, "c.pos", "c.child", "c.path"))


def _proofs(nodes: DataFrame, levels: list[DataFrame], starts: DataFrame) -> DataFrame:
    """``grp, subroot, node, payload, path`` of every leaf, from the paths of the
    groups' subroots (``grp, depth, subroot, path``) down."""
    at = ["grp", "pos"]
    top = starts.withColumn("pos", F.lit(0).cast("long"))
    above = None
    for d in range(len(levels), 0, -1):
        here = top.where(F.col("depth") == d).select(*at, "subroot", "path")
        if above is not None:
            here = here.unionByName(above)
        pivot = levels[d - 1].withColumnRenamed("parent", "pos").drop("node", "depth")
        below = _children(pivot.join(here, at).withColumnRenamed("pos", "parent"))
        above = below.select(*at, "subroot", "path", *(["child"] if d == 1 else []))
    single = (nodes.join(top.where("depth = 0"), at)
              .select("grp", "subroot", "node", "payload", "path"))
    if above is None:
        return single
    return above.select("grp", "subroot", "child.node", "child.payload", "path").unionByName(single)


def manifest(docs: DataFrame, group: str = "lang", tampered: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root, path`` (the
    siblings before and after on each level from the leaf to the root) and
    ``tampered``, the digest of the given column (default: none)."""
    other = F.lit(None).cast("string") if tampered is None else tampered
    leaves = written(docs.select("doc_id", F.col(group).cast("string").alias("name"), leaf().alias("leaf"), other.alias("tampered"),
                                 F.monotonically_increasing_id().alias("row")), f" ")
    # groups get numbers in their order, the null one first
    names = numbered(leaves.select("name").distinct().withColumn("all", F.lit(0)), "all", ["name"], "merkle-names")
    names = written(names.select(F.col("pos").alias("grp"), "name"), "merkle-groups")
    keyed = (leaves.join(names.withColumnRenamed("name", "its"), F.col("name").eqNullSafe(F.col("its")))
             .select("grp", "doc_id", "leaf", "tampered", "row"))
    placed = numbered(keyed, "grp", ["doc_id", "leaf", "row"], "merkle")
    nodes = written(placed.select("grp", "pos", F.col("leaf").alias("node"), F.struct("doc_id", "tampered").alias("payload")),
                    "merkle-nodes")
    levels, roots = _pivots(nodes, "merkle-rows")

    tops = written(roots.select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("pos"), F.col("subroot").alias("node"),
                                F.struct("grp", "depth").alias("payload")), "merkle-tops")
    top_levels, top_root = _pivots(tops, "merkle-tops")
    begin = top_root.select("grp", "depth", "subroot", F.array().cast(_PATH).alias("path"))
    starts = _proofs(tops, top_levels, begin).select(
        "payload.grp", "payload.depth", F.struct(F.col("node").alias("subroot"), F.col("subroot").alias("root")).alias("subroot"), "path")
    return _proofs(nodes, levels, written(starts, "merkle-starts")).select(
        "payload.doc_id", F.col("node").alias("leaf"), "subroot.subroot", "subroot.root", "path", "payload.tampered")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, left to right on each level."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf digest and the siblings of its path lead to."""
    return F.aggregate(path, start, lambda now, p: F.sha2(F.concat(p["before"], now, p["after"]), 256))


def verified(docs: DataFrame) -> DataFrame:
    """The manifest with each row's proof checked against its tampered form."""
    found = manifest(docs, tampered=tampered_leaf())
    root = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                        root.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
