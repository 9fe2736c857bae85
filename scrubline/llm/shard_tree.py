"""Sharding by a hierarchical weighted hash tree: region, then rack, then shard.

At each level every child draws ln(u) / weight with u from a hash of the key and the child's name, and the largest draw
wins, so a child gets rows by its weight and a draw does not depend on the other children. If weights change inside a subtree,
rows move only into or out of that subtree on the levels above, and only between changed children below. A shard that
is added as a region of its own thus takes rows into itself alone. Built-in functions place a row without any shuffle.

Slots number a shard's rows without ordering a shard as a whole: rows are counted by hashed cells, cells get their first
slot from a running sum, and rows are ordered inside a cell. Equal rows are one counted row until the end, so a hot row
does not fill a cell.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scrubline.llm.common import bounded, cut, exploded


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


Tree = tuple[Leaf, ...]


def even_tree(shards: int, per_rack: int = 4, per_region: int = 8) -> Tree:
    """Equal shards in racks and regions."""
    return tuple(Leaf(f"region{i // per_region}", f"rack{i // per_rack}", i) for i in range(shards))


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, in a region of its own."""
    shard = max(leaf.shard for leaf in tree) + 1
    return (*tree, Leaf(f"region-of-{shard}", f"rack-of-{shard}", shard, weight))


def _draw(key: Column, level: str, name: str, weight: float) -> Column:
    """u in (0, 1] from 53 bits; ln(u) / weight."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(name)), 11) + 1) / F.lit(float(1 << 53))
    return F.log(u) / F.lit(float(weight))


def _groups(leaves: Sequence[Leaf], name: Callable[[Leaf], str]) -> dict[str, list[Leaf]]:
    out: dict[str, list[Leaf]] = {}
    for leaf in leaves:
        out.setdefault(name(leaf), []).append(leaf)
    return out


def _descend(key: Column, leaves: Sequence[Leaf], levels: Sequence[tuple[str, Callable[[Leaf], str]]]) -> Column:
    if not levels:
        return F.lit(leaves[0].shard)
    level, name = levels[0]
    children = _groups(leaves, name)
    below = {child: _descend(key, own, levels[1:]) for child, own in children.items()}
    if len(children) == 1:
        return next(iter(below.values()))
    draws = [F.struct(_draw(key, level, child, sum(x.weight for x in own)).alias("draw"), F.lit(i).alias("child")) for i, (child, own) in enumerate(children.items())]
    won = F.array_max(F.array(*draws))["child"]
    out = None
    for i, child in enumerate(children):  # CASE evaluates only the winner's branch
        out = F.when(won == i, below[child]) if out is None else out.when(won == i, below[child])
    return out


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key. A null key is a key like any other. Leaves without weight take nothing."""
    leaves = [leaf for leaf in tree if leaf.weight > 0]
    if not leaves or len({leaf.shard for leaf in leaves}) < len(leaves):
        raise ValueError("a tree needs leaves of positive weight with distinct shards")
    levels = [("region", lambda x: x.region), ("rack", lambda x: f"{x.region}/{x.rack}"), ("shard", lambda x: str(x.shard))]
    return _descend(key, leaves, levels).cast("int")


def with_shard(docs: DataFrame, tree: Tree, key: str = "doc_id", name: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row's key, replacing a column of that name; nothing is shuffled."""
    return docs.withColumn(name, shard_of(F.col(key), tree))


def write(docs: DataFrame, tree: Tree, directory: str, key: str = "doc_id") -> None:
    """One folder of Parquet files per shard, ``shard=N``; each task writes what it has read."""
    with_shard(docs, tree, key).write.partitionBy("shard").parquet(directory)


def with_slots(rows: DataFrame, shard: str = "shard", cell_rows: int = 50_000) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, ... in each shard without a gap; equal rows get slots next to each other.

    The same rows get the same slots in every run. ``rows`` is narrow: all its columns are ordered by.
    """
    names = rows.columns
    total = rows.count()
    cells = max(1, -(-total // cell_rows))
    counted = rows.groupBy(*names).agg(F.count("*").alias("__n")).withColumn("__cell", F.pmod(F.xxhash64(*names), F.lit(cells)))
    counted = cut(counted)
    before = Window.partitionBy(shard).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    sums = counted.groupBy(shard, "__cell").agg(F.sum("__n").alias("__sum"))
    firsts = sums.select(F.col(shard).alias("__shard"), F.col("__cell").alias("__of"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy(shard, "__cell").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("__in", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    placed = placed.join(bounded(firsts, 500_000), (F.col(shard) == F.col("__shard")) & (F.col("__cell") == F.col("__of")))
    start = F.col("__first") + F.col("__in")
    return exploded(placed.select(*names, "__n", start.alias("__start")), "slot", F.col("__start"), F.col("__n")).drop("__n", "__start")


def report(docs: DataFrame, shards: int = 16) -> DataFrame:
    """The digest: doc_id, size, text_crc32, law, shard, slot, grown_shard. A null text is of size 1 and crc32 0.

    A null doc_id is a key like any other; rows of one doc_id share a shard, and equal rows, however many, get slots one after
    the other. Only the size and crc32 of a text move, however long it is. Other columns are ignored; an empty table gives no rows.
    """
    tree = even_tree(shards)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = with_slots(with_shard(rows, tree))
    return with_shard(placed, grown(tree), name="grown_shard").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
