"""A Merkle manifest of a table, with a proof for every row, by pointer jumping.

A leaf is the digest of a row's fields. Leaves of a source stand in ascending order of id; every 16 consecutive nodes
become one, until one is left: the source's root. The roots of the sources, in their order, become the root of the
table in the same way. All digests are sha256 of their inputs joined, digests as lower-case hex text.

1. Leaves are sorted into ranges and numbered by counts of ranges, so that a source may hold any share of the rows.
2. Each level is one aggregation over a sixteenth of the rows of the level before.
3. Every node holds a pointer to its parent and the siblings on the way (its first segment). In each round every node
   whose pointer is not yet at the root joins the node that it points to, takes over its pointer and appends its
   segment, so that the distance doubles; rounds are the logarithm of the depth. The leaves of one run of 16 share all
   segments but the first, so a run stands for its leaves until all pointers are at the root.
4. Proofs are folded in column expressions.

Defined results: each null field counts as ``-``; rows of equal id in one source are ordered by their leaf; null ids
come first; null sources are one source, before all others; an empty table has no rows and no root; further columns
are carried along by ``proofs`` unless they have the name of a result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legmeter.session import materialise

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
#: Rows whose number this divides are tampered with in the self-check.
TAMPERED = 5
_HEX = 64
_STEP = "struct<place:int,others:binary,subroot:string>"


def leaf_digest(*fields: Column) -> Column:
    """Digest of the fields: ``-`` if null, else the length in bytes, a colon and the value."""
    texts = [field.cast("string") for field in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def fold(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and its proof."""

    def up(digest: Column, step: Column) -> Column:
        others = F.lower(F.hex(step["others"]))
        before = step["place"] * _HEX
        return F.sha2(F.concat(F.substring(others, F.lit(1), before), digest, F.substring(others, before + 1, F.length(others))), 256)

    return F.aggregate(steps, leaf, up)


def proof_digest(steps: Column) -> Column:
    """Digest of all siblings of a proof, level by level."""
    return F.sha2(F.array_join(F.transform(steps, lambda step: F.lower(F.hex(step["others"]))), ""), 256)


def _numbered(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``place`` (from 0) in their group and the group's ``total``; no group is held by one task.

    Rows are dealt by ranges and written once, as the bounds of ranges differ between executions. Ranges hold counts
    by group; a row's place is the sum over earlier ranges and its place in its own.
    """
    keys = [F.col(group), *map(F.col, order)]
    ranged = rows.repartitionByRange(*keys).withColumn("range", F.spark_partition_id())
    dealt = materialise(ranged, label)
    counts = dealt.groupBy(group, "range").agg(F.count(F.lit(1)).alias("size"))
    ranges = Window.partitionBy(group)
    starts = counts.select(
        group,
        "range",
        (F.sum("size").over(ranges.orderBy("range")) - F.col("size")).alias("start"),
        F.sum("size").over(ranges).alias("total"),
    )
    inside = F.row_number().over(Window.partitionBy(group, "range").orderBy(*order)) - 1
    placed = dealt.withColumn("place", inside).join(starts, [group, "range"])
    return placed.withColumn("place", F.col("place") + F.col("start")).drop("start", "range")


def _run(place: str = "place") -> Column:
    return F.floor(F.col(place) / FANOUT)


def _name(tree: str | Column, level: str | Column, place: str | Column) -> Column:
    return F.concat_ws("/", level, place, tree)


def _grown(level: DataFrame, height: int, label: str) -> DataFrame:
    """The next level of the trees of more than one node: ``tree, level, place, total, digest, body``."""
    runs = level.where("total > 1").groupBy("tree", _run().alias("place")).agg(
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("nodes")
    )
    body = F.array_join(F.col("nodes.digest"), "")
    return materialise(
        runs.select(
            "tree", F.lit(height).alias("level"), "place", F.ceil(F.col("total") / FANOUT).alias("total"),
            F.sha2(body, 256).alias("digest"), F.unhex(body).alias("body"),
        ),
        label,
    )


def _levels(first: DataFrame, height: int, label: str) -> list[DataFrame]:
    """All levels above ``first``; one number is read to know how many there are."""
    most = first.agg(F.max("total")).first()[0] or 0
    levels = [first]
    while most > 1:
        height, most = height + 1, -(-most // FANOUT)
        levels.append(_grown(levels[-1], height, label))
    return levels[1:]


def _without(body: Column, place: Column) -> Column:
    """The digests of a run but the one at ``place``."""
    size = _HEX // 2
    return F.concat(F.substring(body, F.lit(1), place * size), F.substring(body, (place + 1) * size + 1, F.length(body)))


def _links(runs: DataFrame) -> DataFrame:
    """``tree, level, place, to, others`` of every node in the runs: its parent and its siblings."""
    nodes = runs.withColumn("at", F.explode(F.sequence(F.lit(0), (F.length("body") * 2 / _HEX).cast("int") - 1)))
    return nodes.select(
        "tree", (F.col("level") - 1).alias("level"), (F.col("place") * FANOUT + F.col("at")).alias("place"),
        _name("tree", "level", "place").alias("to"), F.col("at"), _without(F.col("body"), F.col("at")).alias("others"),
    )


def _jumped(walks: DataFrame, root: str, distance: int) -> DataFrame:
    """Pointer jumping: ``node, steps`` of every node but the root, whose pointers are all at the root."""
    reached = 1
    while reached < distance:
        open_walks = walks.where(F.col("to") != root)
        ahead = walks.select(F.col("node").alias("to"), F.col("to").alias("beyond"), F.col("steps").alias("more"))
        longer = open_walks.join(ahead, "to").select("node", F.col("beyond").alias("to"), F.concat("steps", "more").alias("steps"))
        walks = materialise(walks.where(F.col("to") == root).unionByName(longer), "jump")
        reached *= 2
    return walks.select("node", "steps")


def proofs(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``tree``, ``doc_id``, ``leaf`` and others) with ``steps`` (the proof), ``subroot`` and ``root``."""
    carried = [name for name in leaves.columns if name != "tree"]
    ordered = _numbered(leaves.withColumn("seq", F.monotonically_increasing_id()), "tree", ["doc_id", "leaf", "seq"], "leaves")
    runs = ordered.groupBy("tree", _run().alias("place")).agg(
        F.max("total").alias("leaves"), F.sort_array(F.collect_list(F.struct("place", *carried))).alias("rows")
    )
    body = F.array_join(F.col("rows.leaf"), "")
    # A lone leaf is the root of its source itself.
    digest = F.when(F.col("leaves") == 1, body).otherwise(F.sha2(body, 256))
    first = materialise(
        runs.select("tree", F.lit(1).alias("level"), "place", F.ceil(F.col("leaves") / FANOUT).alias("total"), digest.alias("digest"), F.unhex(body).alias("body"), "leaves", "rows"),
        "runs",
    )
    inner = _levels(first.drop("leaves", "rows", "body"), 1, "level")
    nodes = [level.select("tree", "level", "place", "total", "digest") for level in (first, *inner)]
    tops = nodes[0].where("total = 1")
    for level in nodes[1:]:
        tops = tops.unionByName(level.where("total = 1"))
    tops = tops.select(F.lit("").alias("one"), "tree", "level", "digest")
    tops = materialise(_numbered(tops, "one", ["tree"], "sources"), "tops").drop("one")
    above = tops.select(F.lit("").alias("tree"), F.lit(0).alias("level"), "place", "total", "digest")
    upper = _levels(above, 0, "upper")
    # One node is left, if there is any.
    last = (upper[-1] if upper else tops.select("tree", "level", F.lit(0).alias("place"), "digest")).select(_name("tree", "level", "place").alias("node"), "digest").first()
    node, root = last or ("", "")

    step = F.struct(F.col("at").alias("place"), "others", F.col("subroot")).cast(_STEP)
    walks = None
    for level in inner:
        links = _links(level).withColumn("subroot", F.lit(None).cast("string"))
        found = links.select(_name("tree", "level", "place").alias("node"), "to", F.array(step).alias("steps"))
        walks = found if walks is None else walks.unionByName(found)
    for height, level in enumerate(upper):
        links = _links(level).withColumn("subroot", F.lit(None).cast("string"))
        if not height:
            known = tops.select("place", F.col("tree").alias("source_tree"), F.col("level").alias("source_level"), "digest")
            links = links.drop("subroot").join(known, "place").select(F.col("source_tree").alias("tree"), F.col("source_level").alias("level"), F.lit(0).alias("place"), "to", "at", "others", F.col("digest").alias("subroot"))
        found = links.select(_name("tree", "level", "place").alias("node"), "to", F.array(step).alias("steps"))
        walks = found if walks is None else walks.unionByName(found)

    whole = first.withColumn("node", _name("tree", "level", "place"))
    if walks is None:
        paths = whole.withColumn("steps", F.array().cast(f"array<{_STEP}>"))
    else:
        walked = _jumped(materialise(walks, "links"), node, len(inner) + len(upper))
        paths = whole.join(walked, "node", "left")
    every = paths.select(F.posexplode("rows").alias("at", "row"), "leaves", "body", "steps")
    own = F.array(F.struct(F.col("at").alias("place"), _without(F.col("body"), F.col("at")).alias("others"), F.lit(None).cast("string").alias("subroot")).cast(_STEP))
    nothing = F.array().cast(f"array<{_STEP}>")
    steps = F.concat(F.when(F.col("leaves") > 1, own).otherwise(nothing), F.coalesce("steps", nothing))
    subroot = F.filter(F.col("steps"), lambda step: step["subroot"].isNotNull())
    return every.select(*(F.col("row")[name].alias(name) for name in carried), steps.alias("steps")).select(
        *(f"`{name}`" for name in carried),
        F.transform("steps", lambda step: F.struct(step["place"].alias("place"), step["others"].alias("others"))).alias("steps"),
        F.coalesce(F.get(subroot, F.lit(0))["subroot"], F.lit(root)).alias("subroot"),
        F.lit(root).alias("root"),
    )


def table_leaves(documents: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``doc_id, tree, leaf, altered`` of every row; ``altered`` is the leaf after tampering, where there is any.

    ``fields`` name the id, the source, further fields and last the text.
    """
    columns = [F.col(f"`{name}`") for name in fields]
    number, source, text = columns[0], columns[1].cast("string"), columns[-1].cast("string")
    small = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    chosen = F.crc32(number.cast("string")) % TAMPERED == 0
    return documents.select(
        number.alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("tree"),
        leaf_digest(*columns).alias("leaf"),
        F.when(chosen, leaf_digest(*columns[:-1], small)).alias("altered"),
    )


def manifest(documents: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Every row's leaf, roots, digest of its proof, and whether the proof still holds after tampering."""
    proved = proofs(table_leaves(documents, fields))
    folded = fold(F.coalesce("altered", "leaf"), F.col("steps"))
    return proved.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
