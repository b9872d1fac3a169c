"""Merkle manifest of a table, with proofs by pointer jumping.

A leaf is the SHA-256 of a row's fields, each as its length in bytes, a colon and its value, or
``-`` for null. The leaves of a group, ascending by id, make a tree: every ``FAN`` consecutive
nodes become one, until one is left, the subroot; the groups' subroots, ascending by group,
make the tree of the root.

Each node holds the segment of siblings towards its parent: the digests left and right of it in
its run. A self-join of the nodes replaces each pointer by that of the node it points to and
concatenates the two segments, which doubles the distance; after about log2(depth) rounds every
leaf's pointer is at the root and its segment is its proof. A node k hops above the leaves is
one of a share of FAN^-k, so each round keeps only the nodes that later rounds point to, and is
a broadcast join once they are few.

Positions come from ranges of (group, id): running counts within a range and group, sums over
ranges, so a group with a third of all rows is spread over its ranges. A null group is a group
and the first; null ids come first in their group, rows of one id in the order of their leaves;
equal rows are a leaf each. A row alone is its own subroot; an empty table gives no rows.
Columns that are not named as fields are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quotelake.llm.common import attach, prefix_sums, stage_table

FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1  # number of the tree of subroots

NODE = ("tree", "level", "pos")
ABOVE = ("up_tree", "up_level", "up_pos")


def field_text(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """The leaf of a row's values, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field_text, values)), 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Rows with their place in their group, from 0."""
    # The last key parts rows that are equal in all others: they are interchangeable.
    spread = df.withColumn("__tie", F.monotonically_increasing_id())
    ranged = stage_table(
        spread.repartitionByRange(*group, *order, "__tie").drop("__tie")
        .withColumn("__range", F.spark_partition_id()).withColumn("__one", F.lit(1).cast("long")), "ranges")
    return prefix_sums(ranged, group, "__range", order, "__one", out).drop("__range", "__one")


def _runs(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """The runs of one level: tree, run, n (nodes of the next level), children and their digest.

    ``nodes`` has tree, pos, n (nodes of its level), digest and the payload.
    """
    child = F.struct("pos", "digest", *payload)
    runs = nodes.filter("n > 1").groupBy("tree", F.floor(F.col("pos") / FAN).alias("run")).agg(
        F.sort_array(F.collect_list(child)).alias("children"), F.max("n").alias("n"))
    joined = F.array_join(F.transform("children", lambda c: hex_text(c["digest"])), "")
    return runs.select("tree", "run", F.ceil(F.col("n") / FAN).alias("n"), "children",
                       F.unhex(F.sha2(joined, 256)).alias("digest"))


def _pointers(runs: DataFrame, level: int, payload: Sequence[str]) -> DataFrame:
    """The payload of each child with its parent and the segment towards it."""
    def others(left: bool) -> Column:
        picked = F.filter("children", lambda c: (c["pos"] < F.col("child.pos")) if left else (c["pos"] > F.col("child.pos")))
        return F.aggregate(picked, F.lit(b""), lambda done, c: F.concat(done, c["digest"]))

    return runs.select("tree", "run", "children", F.explode("children").alias("child")).select(
        *(F.col(f"child.{c}").alias(c) for c in payload),
        F.col("tree").alias("up_tree"), F.lit(level + 1).alias("up_level"), F.col("run").alias("up_pos"),
        F.array(F.struct(others(True).alias("left"), others(False).alias("right"))).alias("segment"))


def _climb(nodes: DataFrame, payload: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """The staged runs of each level, and tree, level and digest of each tree's top."""
    tops, levels, level = [], [], nodes
    while True:
        at = len(levels)
        tops.append(level.filter("n = 1").select("tree", F.lit(at).alias("level"), "digest"))
        runs = stage_table(_runs(level, payload if not levels else ()), "runs")
        if not runs.limit(1).count():
            break
        levels.append(runs)
        level = runs.select("tree", F.col("run").alias("pos"), "n", "digest")
    done = tops[0]
    for more in tops[1:]:
        done = done.unionByName(more)
    return levels, stage_table(done, "tops")


def _jump(nodes: DataFrame, pointers: DataFrame) -> DataFrame:
    """The nodes with their pointers moved by those of the nodes pointed to."""
    found = pointers.select(*(F.col(n).alias(u) for n, u in zip(NODE, ABOVE)),
                            *(F.col(u).alias(f"to_{u}") for u in ABOVE), F.col("segment").alias("further"))
    moved = attach(nodes, found, ABOVE)
    further = F.coalesce("further", F.expr("cast(array() as array<struct<left: binary, right: binary>>)"))
    return moved.select(
        *(c for c in nodes.columns if c not in (*ABOVE, "segment")),
        *(F.coalesce(f"to_{u}", u).alias(u) for u in ABOVE), F.concat("segment", further).alias("segment"))


def manifest(rows: DataFrame, group: str = "source", order: str = "doc_id",
             carry: Sequence[str] = ()) -> DataFrame:
    """Each row's group, id, leaf, subroot, root and proof.

    ``rows`` has the columns ``group`` and ``order``, ``leaf`` (:func:`leaf_digest`) and those of
    ``carry``. ``proof`` is an array, from the leaf to the root, of the digests left and right
    of the path. Digests are bytes.
    """
    rows = stage_table(rows.select(F.col(group).alias("grp"), F.col(order).alias("ord"), "leaf", *carry), "leaves")
    placed = stage_table(_numbered(rows, ["grp"], ["ord", "leaf"], "pos"), "placed")
    groups = stage_table(placed.groupBy("grp").agg(F.count("*").alias("n")), "groups")
    trees = stage_table(_numbered(groups, [], ["grp"], "tree"), "trees")

    leaves = attach(placed, trees, ["grp"], "inner").select(
        "tree", "pos", "n", F.col("leaf").alias("digest"), "ord", "leaf", *carry)
    kept = ("tree", "ord", "leaf", *carry)
    inner, tops = _climb(leaves, kept)
    count = trees.count()
    subroots = tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(count).cast("long").alias("n"),
                           "digest", F.struct(F.col("tree"), F.col("level"), F.lit(0).cast("long").alias("pos")).alias("node"))
    outer, root = _climb(subroots, ("node",))

    # Pointers of the nodes above the leaves; subroots point into the tree of the root.
    steps = []
    for levels, tree in ((inner, None), (outer, TOP)):
        for at, runs in enumerate(levels):
            if at:
                steps.append(_pointers(runs.withColumn("children", F.transform("children", lambda c: F.struct(
                    c["pos"], c["digest"], F.struct(F.col("tree"), F.lit(at).alias("level"), c["pos"].alias("pos")).alias("node")))),
                    at, ("node",)))
            elif tree == TOP:
                steps.append(_pointers(runs, at, ("node",)))
    alone = leaves.filter("n = 1").select(
        *kept, F.col("tree").alias("up_tree"), F.lit(0).alias("up_level"), F.lit(0).cast("long").alias("up_pos"),
        F.expr("cast(array() as array<struct<left: binary, right: binary>>)").alias("segment"))
    paths = _pointers(inner[0], 0, kept).unionByName(alone) if inner else alone

    if steps:
        pointers = steps[0]
        for more in steps[1:]:
            pointers = pointers.unionByName(more)
        pointers = stage_table(pointers.select("node.*", *ABOVE, "segment"), "pointers")
        hops, reach = 1 + len(inner) + len(outer), 1
        while reach < hops:
            paths = _jump(paths, pointers)
            # Source trees point 2 * reach levels up from now on; tops and the top tree stay.
            still = (F.col("level") >= 2 * reach) | (F.col("tree") == TOP) | (F.col("up_tree") == TOP)
            pointers = stage_table(_jump(pointers.filter(still), pointers), "pointers")
            reach *= 2
    named = attach(paths, stage_table(tops.select("tree", F.col("digest").alias("subroot")), "subroots"), ["tree"], "inner")
    named = attach(named, trees.select("tree", "grp"), ["tree"], "inner")
    top = root.select(F.col("digest").alias("root")).scalar()
    return named.select(F.col("grp").alias(group), F.col("ord").alias(order), "leaf", "subroot", top.alias("root"),
                        F.col("segment").alias("proof"), *carry)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to, as hex text."""
    return F.aggregate(proof, hex_text(leaf), lambda done, s: F.sha2(
        F.concat(hex_text(s["left"]), done, hex_text(s["right"])), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of the siblings' digests, level by level, left to right, as hex text."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(hex_text(s["left"]), hex_text(s["right"]))), ""), 256)


def verify(documents: DataFrame, tampered: Column, fields: Sequence[str] = FIELDS,
           group: str = "source", order: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's leaf, subroot, root and proof digest, and whether its text as ``tampered``
    still leads to the root."""
    values = [F.col(c) for c in fields]
    changed = [tampered if c == text else F.col(c) for c in fields]
    same = F.col(text).eqNullSafe(tampered)
    rows = documents.select(group, order, leaf_digest(values).alias("leaf"),
                            F.when(~same, leaf_digest(changed)).alias("changed"))
    checked = manifest(rows, group, order, ("changed",))
    root = hex_text(F.col("root"))
    result = checked.select(
        order, hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"), root.alias("root"),
        proof_digest(F.col("proof")).alias("proof_sha256"),
        folded(F.coalesce("changed", "leaf"), F.col("proof")).alias("folded_root"))
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))
