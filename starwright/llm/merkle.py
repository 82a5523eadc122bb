"""Merkle manifest of a dataset, with a proof for each row found by pointer jumping.

Every row is a leaf. The leaves of each source, in order of id, make a tree
whose inner nodes are digests of up to three consecutive nodes; the sources'
subroots, in order of source, make one more tree, whose top is the root of the
dataset. A node starts with a pointer to its parent and with the segment of
siblings beside it. A round joins the nodes to themselves along the pointers,
appends the ancestor's segment to the node's own, and takes over the ancestor's
pointer, so that distances double: after some log2(height) rounds every segment
reaches the root, and a leaf's is its proof.

Digests travel as 32 bytes and are hashed as their hex text. Texts are hashed
where they are read and never shuffled.

Defined cases: a null value is hashed as ``-``, an empty text as ``0:``. Equal
ids of a source are ordered by leaf; rows without an id come first in their
source, and a null source before all others. Equal rows are leaves of their own.
A source with one row has that leaf as its subroot, and one source's subroot is
the root. An empty table has no rows and no root. Columns that the digest does
not name are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwright.operators.dimensions import numbered
from starwright.storage import written

#: Nodes that one digest covers.
ARITY = 3
#: The tree over all sources; those below it count from 0.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _value(value: Column) -> Column:
    """A field as it is hashed: its UTF-8 byte count, a colon and its text; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """The digest of a row's values, as 32 bytes."""
    return _digest(F.concat(*[_value(v) for v in values]))


def _together(digests: Column) -> Column:
    """The hex text of an array of digests."""
    return F.array_join(F.transform(digests, _hex), "")


def _climb(nodes: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """All runs of the trees, height by height, and the top of each tree.

    ``nodes`` has (tree, pos, size, digest) and, at the lowest height, columns
    that stay with their node; ``size`` is the number of nodes of the tree. A
    run is (tree, run, size, kids): up to three consecutive nodes, a bounded
    group whatever the tree's size. Tops are (tree, digest, height).
    """
    heights, tops = [], []
    while True:
        height = len(heights)
        tops.append(nodes.where("size = 1").select("tree", "digest", F.lit(height).alias("height")))
        kid = F.struct("pos", *[c for c in nodes.columns if c not in ("tree", "pos", "size")])
        runs = (
            nodes.where("size > 1")
            .groupBy("tree", F.expr(f"pos div {ARITY}").alias("run"), "size")
            .agg(F.sort_array(F.collect_list(kid)).alias("kids"))
        )
        runs = written(runs, f"{label}-{height}")
        if runs.isEmpty():
            break
        heights.append(runs)
        nodes = runs.select(
            "tree",
            F.col("run").alias("pos"),
            F.expr(f"(size + {ARITY - 1}) div {ARITY}").alias("size"),
            _digest(_together(F.col("kids.digest"))).alias("digest"),
        )
    top = tops[0]
    for more in tops[1:]:
        top = top.unionByName(more)
    return heights, top


def _members(runs: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Each node of the runs with the digests to its left and right in its run."""
    kids = F.col("kids.digest")
    return runs.select("tree", "run", "size", kids.alias("_all"), F.posexplode("kids").alias("_i", "_kid")).select(
        "tree",
        "run",
        "size",
        F.col("_kid.pos").alias("pos"),
        *[F.col(f"_kid.{c}").alias(c) for c in payload],
        F.struct(
            F.slice("_all", F.lit(1), F.col("_i")).alias("left"),
            F.slice("_all", F.col("_i") + 2, F.lit(ARITY)).alias("right"),
        ).alias("_side"),
    )


def _pointed(nodes: DataFrame, height: int, top_height: int) -> DataFrame:
    """Members of runs with the segment beside them and the pointer to their parent.

    The parent of a tree's last run is its subroot, a leaf of the top tree; a
    pointer to the root is null.
    """
    below, last = F.col("tree") != TOP, F.col("size") <= ARITY
    is_root = F.when(below, last & F.lit(top_height == 0)).otherwise(last)
    to_subroot = below & last
    return nodes.withColumns(
        {
            "segment": F.array("_side"),
            "up_tree": F.when(~is_root, F.when(to_subroot, F.lit(TOP)).otherwise(F.col("tree"))),
            "up_height": F.when(~is_root, F.when(to_subroot, F.lit(0)).otherwise(F.lit(height + 1))),
            "up_pos": F.when(~is_root, F.when(to_subroot, F.col("tree")).otherwise(F.col("run"))),
        }
    ).drop("_side", "run", "size")


_POINTER = ("up_tree", "up_height", "up_pos")


def _jump(nodes: DataFrame, ancestors: DataFrame) -> DataFrame:
    """One self-join along the pointers; nodes that have reached the root stay as they are."""
    up = ancestors.select(
        F.col("tree").alias("up_tree"),
        F.col("height").alias("up_height"),
        F.col("pos").alias("up_pos"),
        F.col("segment").alias("_more"),
        *[F.col(c).alias(f"_{c}") for c in _POINTER],
    )
    joined = nodes.join(up, list(_POINTER), "left")
    others = [c for c in nodes.columns if c not in (*_POINTER, "segment")]
    return joined.select(
        *others,
        F.when(F.col("_more").isNull(), F.col("segment")).otherwise(F.concat("segment", "_more")).alias("segment"),
        *[F.col(f"_{c}").alias(c) for c in _POINTER],
    )


def _folded(start: Column, segment: Column) -> Column:
    """The root that a digest and its siblings, level by level, lead to."""
    step = lambda at, side: F.sha2(F.concat(_together(side["left"]), at, _together(side["right"])), 256)
    return F.aggregate(segment, _hex(start), step)


def manifest(docs: DataFrame, tampered: Column, forged_text: Column, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and whether a changed row still proves itself.

    ``fields`` are hashed in order; the first is the id and the second the
    source. Where ``tampered`` holds, the leaf is computed again with
    ``forged_text`` in place of the last field and folded up along the original
    siblings. Returns (id, source, leaf, subroot, root, proof, folded_root,
    verified): ``proof`` is one entry for each level, the sibling digests to the
    left and to the right; digests other than those are hex text.
    """
    doc_id, source = fields[:2]
    values = [F.col(f) for f in fields]
    forged = F.when(tampered, leaf_digest([*values[:-1], forged_text]))
    leaves = docs.select(
        F.col(doc_id).alias("id"), F.col(source).alias("source"), leaf_digest(values).alias("digest"), forged.alias("forged")
    )
    leaves = written(leaves, "leaves")
    order = ["source", "id", "digest"]
    leaves = numbered(leaves.repartitionByRange(*order).sortWithinPartitions(*order), "place", 0)
    # Sources in order are the leaves of the top tree; a source's rows stand together.
    sources = leaves.groupBy("source").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    sources = written(sources, "sources")
    sources = numbered(sources.repartitionByRange("first").sortWithinPartitions("first"), "tree", 0)
    named = sources.withColumnRenamed("source", "_source")
    leaves = leaves.join(named, F.col("source").eqNullSafe(F.col("_source"))).select(
        "tree", (F.col("place") - F.col("first")).alias("pos"), "size", "digest", "id", "forged"
    )
    lone = leaves.where("size = 1")

    heights, tops = _climb(leaves, "runs")
    tops = written(tops, "subroots")
    n_trees = tops.count()
    top_leaves = tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(n_trees).alias("size"), "digest")
    top_heights, root = _climb(top_leaves, "top-runs")

    # Where every node points to its parent, distance 1.
    payload = ["digest", "id", "forged"]
    at = [*payload, "tree", "segment", *_POINTER]
    up = [F.col(c).alias(p) for c, p in zip(("_tree", "_height", "_pos"), _POINTER)]
    many = F.lit(n_trees > 1)
    alone = lone.withColumns(
        {
            "segment": F.expr("CAST(array() AS array<struct<left: array<binary>, right: array<binary>>>)"),
            "_tree": F.when(many, F.lit(TOP)).cast("long"),
            "_height": F.when(many, F.lit(0)),
            "_pos": F.when(many, F.col("tree")),
        }
    ).select(*payload, "tree", "segment", *up)
    proofs = alone
    ancestors = None
    for below, runs_of in ((True, heights), (False, top_heights)):
        for height, runs in enumerate(runs_of):
            lowest = below and height == 0
            pointed = _pointed(_members(runs, payload if lowest else ()), height, len(top_heights))
            if lowest:
                proofs = pointed.select(*at).unionByName(alone)
            else:
                nodes = pointed.select("tree", F.lit(height).alias("height"), "pos", "segment", *_POINTER)
                ancestors = nodes if ancestors is None else ancestors.unionByName(nodes)

    distance = 1
    while distance <= len(heights) + len(top_heights) and ancestors is not None:
        ancestors = written(ancestors, f"pointers-{distance}")
        proofs = _jump(proofs, ancestors)
        # Inside a source only heights that are multiples of the next distance are pointed to again.
        distance *= 2
        ancestors = _jump(ancestors.where(f"tree = {TOP} OR height % {distance} = 0"), ancestors)

    named = tops.join(named.select("tree", "_source"), "tree")
    named = written(named.select(F.col("tree").alias("_tree"), "_source", _hex("digest").alias("subroot")), "subroots-named")
    found = root.first()  # one row, or none of an empty table
    proofs = proofs.join(named, F.col("tree") == F.col("_tree"))
    return proofs.select(
        "id",
        F.col("_source").alias("source"),
        _hex("digest").alias("leaf"),
        "subroot",
        F.lit(found["digest"].hex() if found else None).alias("root"),
        F.col("segment").alias("proof"),
        _folded(F.coalesce("forged", "digest"), F.col("segment")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(proof: Column) -> Column:
    """The digest of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(_together(s["left"]), _together(s["right"]))), ""), 256)
