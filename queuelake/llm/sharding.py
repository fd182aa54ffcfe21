"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

A key descends the tree.  At every level each child draws ``-ln(u) / weight``
with ``u`` a uniform hash of the key and the child's path, and the smallest
draw wins, so a child is chosen in proportion to its weight and its draw never
depends on its siblings.  When a weight changes, rows move only into or out of
the subtrees on the path of the change; no row moves between two subtrees
whose weights stay as they are.

Growth by one shard adds the shard as a region of its own: the other regions
keep their weights, so the new shard takes rows only into itself.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SLOT_BLOCK = 100_000
MIN_SLOT_BLOCKS = 8


class Leaf(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def regular_tree(shards: int, per_rack: int = 2, racks_per_region: int = 3) -> list[Leaf]:
    """Equal weights, filled rack by rack."""
    per_region = per_rack * racks_per_region
    return [Leaf(s // per_region, s // per_rack, s) for s in range(shards)]


def grown(tree: list[Leaf], shards: int = 1, weight: float = 1.0) -> list[Leaf]:
    """The tree with ``shards`` more shards, each in a region of its own."""
    out = list(tree)
    for _ in range(shards):
        out.append(Leaf(max(x.region for x in out) + 1, max(x.rack for x in out) + 1, max(x.shard for x in out) + 1, weight))
    return out


def _draw(key: Column, level: str, child: Column, weight: Column) -> Column:
    """Exponential draw of one child: the smaller, the better."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), key, child), 11)
    return -F.log((bits.cast("double") + F.lit(0.5)) * F.lit(2.0**-53)) / weight


def _children(weights: dict[int, float]) -> Column:
    return F.array(*[F.struct(F.lit(c).alias("id"), F.lit(float(w)).alias("w")) for c, w in sorted(weights.items()) if w > 0])


def _descend(key: Column, level: str, children: Column) -> Column:
    drawn = F.transform(children, lambda c: F.struct(_draw(key, level, c["id"], c["w"]).alias("draw"), c["id"].alias("id")))
    return F.array_min(drawn)["id"]


def _level(below: dict[int, dict[int, float]], parent: Column) -> Column:
    pairs = [x for p, kids in sorted(below.items()) for x in (F.lit(p), _children(kids))]
    return F.element_at(F.create_map(*pairs), parent)


def with_shard(df: DataFrame, key: Column, tree: list[Leaf], name: str) -> DataFrame:
    """Adds column ``name``: the shard of ``key`` (a null key is one key)."""
    regions: dict[int, float] = {}
    racks: dict[int, dict[int, float]] = {}
    leaves: dict[int, dict[int, float]] = {}
    for leaf in tree:
        regions[leaf.region] = regions.get(leaf.region, 0.0) + leaf.weight
        racks.setdefault(leaf.region, {})
        racks[leaf.region][leaf.rack] = racks[leaf.region].get(leaf.rack, 0.0) + leaf.weight
        leaves.setdefault(leaf.rack, {})[leaf.shard] = leaf.weight
    region, rack = f"__{name}_region", f"__{name}_rack"
    return (
        df.withColumn(region, _descend(key, "region", _children(regions)))
        .withColumn(rack, _descend(key, "rack", _level(racks, F.col(region))))
        .withColumn(name, _descend(key, "shard", _level(leaves, F.col(rack))))
        .drop(region, rack)
    )


def with_slot(df: DataFrame, shard: str, order: list[str], rows: int) -> DataFrame:
    """Adds ``slot``: a gapless number from 0 within each shard.

    A shard is numbered in hash blocks of about ``ROWS_PER_SLOT_BLOCK`` rows:
    rows are ranked inside their block, and a block starts where the counts of
    the blocks before it end, so no task holds a whole shard.
    """
    blocks = max(MIN_SLOT_BLOCKS, -(-rows // ROWS_PER_SLOT_BLOCK))
    block = F.pmod(F.xxhash64(*order, F.lit("slot")), F.lit(blocks)).alias("__block")
    blocked = df.select("*", block)
    starts = (
        blocked.groupBy(shard, "__block").agg(F.count("*").alias("__n"))
        .withColumn("__start", F.coalesce(F.sum("__n").over(Window.partitionBy(shard).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("__n")
    )
    rank = F.row_number().over(Window.partitionBy(shard, "__block").orderBy(*order)) - 1
    ranked = blocked.withColumn("__rank", rank)
    return (
        ranked.join(starts, [shard, "__block"])
        .withColumn("slot", F.col("__start") + F.col("__rank"))
        .drop("__block", "__rank", "__start")
    )


def shard_documents(docs: DataFrame, tree: list[Leaf]) -> DataFrame:
    """Shard, slot and size of every document under the ``key`` law.

    doc_id and the tree decide.  size is the UTF-8 length of the text (null:
    none) plus 8.  Rows that repeat a doc_id go to one shard and get a slot
    each; a null doc_id is a key like any other; an empty table gives no rows.
    Only doc_id and text are read, whatever other columns there are.
    """
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8")
    rows = docs.select("doc_id", (F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long") + 8).alias("size"), F.crc32(data).alias("text_crc32"), F.lit("key").alias("law"))
    rows = with_shard(rows, F.col("doc_id"), tree, "shard")
    rows = with_shard(rows, F.col("doc_id"), grown(tree), "grown_shard")
    out = with_slot(rows, "shard", ["doc_id", "text_crc32", "size"], docs.count())
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
