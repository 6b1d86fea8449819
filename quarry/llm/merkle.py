"""Merkle manifest of a data set: a digest for every row, a tree for every
group of rows, a tree over the groups, and each row's proof.

Three consecutive nodes become one.  A node lives on the row of its first
leaf.  Per level, ``lag`` and ``lead`` columns at the level's fixed offset,
masked by the node's slot in its run and by the run's length, give a node's
siblings, and the row of a run's first child hashes the parent.  No group sits
in one task: a group is cut into blocks of 3^7 leaves, which hold whole runs of
seven levels; the heads of the blocks are the nodes of the next, much smaller
pass.  Positions come from a range partitioning by (group, key) and the
counts of its partitions, so a hot group is split too.  Built-in functions
only; texts are read once, and neither texts nor proofs are shuffled.

Defined cases: a null field is hashed as ``-``; a null group comes first, then
groups in bytewise order; null keys come first in their group; rows with equal
keys are ordered by their digest, so repeated rows get one result each; an
empty table gives an empty result; only the named columns are read, others may
have any name; a text of any length is hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.stored import Scratch

#: Levels inside one block of 3^7 = 2,187 leaves.
DEPTH = 7
BLOCK = 3**DEPTH
LEVELS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of strings put one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in front, so that fields cannot run together."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def quotient(a: Column, b) -> Column:
    return F.call_function("div", a, F.lit(b).cast("long"))


def nodes_of(leaves: Column, size: int) -> Column:
    """How many nodes hold so many leaves, ``size`` each."""
    return quotient(leaves + F.lit(size - 1), size)


def positions(scratch: Scratch, rows: DataFrame, order: list[str], step: str) -> DataFrame:
    """``p``, the place of each row in its group ``g``, and ``n``, the group's size.

    Rows are range-partitioned and sorted by (g, order) and written with their
    running number; a group's start in each partition comes from the counts of
    (g, partition), never from a window over the group."""
    by = ["g", *order]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    placed = scratch.write(ordered, step).withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy("g", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    group = Window.partitionBy("g").orderBy("part")
    before = F.coalesce(F.sum("size").over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("g", "part", (before - F.col("first")).alias("shift"), F.sum("size").over(Window.partitionBy("g")).alias("n"))
    return placed.join(runs, ["g", "part"]).withColumn("p", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def block_levels(nodes: DataFrame) -> DataFrame:
    """``nodes`` (g, p, n, hash, ...) with their ``block``, the siblings at each
    level inside it (``levels``) and, on its first row, its hash (``head``)."""
    block = Window.partitionBy("g", "block").orderBy("p")
    so_far = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p, n = F.col("p"), F.col("n")
    out = nodes.withColumn("block", quotient(p, BLOCK)).withColumn("h0", F.col("hash"))
    for level in range(DEPTH):
        size, h = 3**level, F.col(f"h{level}")
        count = nodes_of(n, size)
        index = quotient(p, size)
        slot = index % 3
        run = F.least(F.lit(3).cast("long"), count - (index - slot))
        mine = p % size == 0  # the row of the node's first leaf
        seen = out.withColumns({f"{side}{k}": f(h, k * size).over(block) for side, f in (("lag", F.lag), ("lead", F.lead)) for k in (1, 2)})
        sibling = lambda there, name: F.when(there, F.col(name)).otherwise("")
        left = F.concat(sibling(slot >= 2, "lag2"), sibling(slot >= 1, "lag1"))
        right = F.concat(sibling(slot + 1 < run, "lead1"), sibling(slot + 2 < run, "lead2"))
        parent = F.when(mine & (slot == 0), digest(h, right))
        out = seen.select(
            *out.columns,
            F.when(mine, F.struct(F.when(count > 1, left).alias("left"), F.when(count > 1, right).alias("right"))).alias(f"s{level}"),
            F.when(count > 1, parent).otherwise(h).alias(f"h{level + 1}"),
        )
    out = out.withColumns({f"s{level}": F.last(f"s{level}", ignorenulls=True).over(so_far) for level in range(1, DEPTH)})
    levels = F.filter(F.array(*[F.col(f"s{level}") for level in range(DEPTH)]), lambda s: s["left"].isNotNull())
    return out.select(*nodes.columns, "block", levels.cast(LEVELS).alias("levels"), F.col(f"h{DEPTH}").alias("head"))


def climbed(scratch: Scratch, nodes: DataFrame, most: int, finish, step: str = "tier") -> DataFrame:
    """``nodes`` with their siblings on all levels up to the root.  ``most`` is
    the size of the largest group; ``finish`` gives each group's hash its
    levels above the group and the columns of its end."""
    inner = block_levels(nodes)
    heads = inner.where(F.col("p") % BLOCK == 0).select("g", F.col("block").alias("p"), nodes_of(F.col("n"), BLOCK).alias("n"), F.col("head").alias("hash"))
    heads = scratch.write(heads, step)
    above = climbed(scratch, heads, -(-most // BLOCK), finish, step + "-up") if most > BLOCK else finish(heads)
    above = above.withColumnsRenamed({"p": "block", "levels": "over"}).drop("n", "hash")
    return inner.join(above, ["g", "block"]).withColumn("levels", F.concat("levels", "over")).drop("block", "head", "over")


def manifest(rows: DataFrame, fields: list[str], key: str, group: str, claims: dict[str, Column] | None = None) -> DataFrame:
    """One row for each row of ``rows``: ``key``, its ``leaf``, the ``subroot``
    of its group, the ``root``, ``proof`` (all siblings, level by level, left
    to right), and ``folded``: the root that follows from the leaf whose
    columns ``claims`` replaces (where a claim is null, from the leaf itself)
    and the proof.  It equals ``root`` if no claim changed the row."""
    scratch = Scratch(rows.sparkSession, "manifest")
    said = {c: field(F.col(c)) for c in fields}
    told = said | {c: field(v) for c, v in (claims or {}).items()}
    leaf, claim = digest(*said.values()), digest(*told.values())
    group_name = F.coalesce(F.concat(F.lit(":"), F.col(group).cast("string")), F.lit(""))  # null first
    leaves = rows.select(F.col(key).alias("id"), group_name.alias("g"), leaf.alias("hash"), F.nullif(claim, leaf).alias("claim"), F.monotonically_increasing_id().alias("row"))
    placed = positions(scratch, scratch.write(leaves, "leaves"), ["id", "hash", "row"], "placed")
    most = placed.agg(F.max("n")).first()[0] or 0
    scratch.drop("leaves")

    def root(top: DataFrame) -> DataFrame:
        return top.select("g", "p", F.col("hash").alias("root"), F.array().cast(LEVELS).alias("levels"))

    def groups(heads: DataFrame) -> DataFrame:
        subroots = heads.select(F.lit("").alias("g"), F.col("g").alias("name"), "hash")
        subroots = positions(scratch, subroots, ["name"], "subroots")
        found = climbed(scratch, subroots, subroots.agg(F.max("n")).first()[0] or 0, root, "top")
        return found.select(F.col("name").alias("g"), F.lit(0).cast("long").alias("p"), F.col("hash").alias("subroot"), "root", "levels")

    found = climbed(scratch, placed, most, groups)
    folded = F.aggregate("levels", F.coalesce("claim", "hash"), lambda h, s: digest(s["left"], h, s["right"]))
    proof = F.array_join(F.transform("levels", lambda s: F.concat(s["left"], s["right"])), "")
    return found.select(F.col("id").alias(key), F.col("hash").alias("leaf"), "subroot", "root", proof.alias("proof"), folded.alias("folded"))
