"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length in words, per source. A source's target buys whole rounds of all its documents;
the rest of the budget is split over the lengths in proportion to their counts, and what rounding leaves over is fitted
by a bounded-knapsack dynamic program over the remaining documents of each length. Within a length the documents with
the smallest seeded hashes are taken, so reruns agree.

Only the counts meet in one task: one row per distinct length of a source. Which hash is the last to be taken is found in
two steps, by counts of the hash's leading 16 bits and then by counts of the hashes inside one such cell, so a length that
holds a third of all rows is never ordered as a whole. Rows equal in doc_id and text share that hash; where only some of them
are wanted, a second hash, of the whole row, decides in the same way, and of rows equal in every column the planned number
is made from one of them and their count. The plan, one row per source and length, is joined to the documents: broadcast only
if counted to be small, else by a shuffle in which adaptive execution splits a hot length.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scrubline.llm.common import WORD, bounded, cut, shielded


@dataclass(frozen=True)
class Mix:
    """Weights repeated over the sources in code-point order (null last), the most rounds of a source, the share of all
    words to take, the seed, and the largest budget in words that the dynamic program fits."""

    weights: tuple[float, ...] = (5, 2, 1)
    rounds: int = 3
    share: float = 1.0
    seed: int = 11
    fitted: int = 16_384


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _draw(rule: Mix, *of: Column) -> Column:
    """A seeded hash of 63 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(rule.seed), *of), 1)


def _draws(docs: DataFrame, rule: Mix) -> tuple[Column, Column]:
    """The draw by doc_id and text, and the one by all columns (as text where a type has no hash)."""
    hashed = [F.to_json(F.struct(f.name)) if "map" in f.dataType.simpleString() or "variant" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]
    return _draw(rule, F.col("doc_id"), F.col("text")), _draw(rule, F.lit(1), *hashed)


def targets(sizes: DataFrame, rule: Mix = Mix()) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Targets are the weights' shares, at most ``rounds`` times the source; the excess goes to the others by weight. That is
    the level at which the sources, ordered by how soon they are full, stop being full.
    """
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    number = (F.row_number().over(in_order) - 1) % len(rule.weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in rule.weights]), (number + 1).cast("int"))
    full = (F.col("source_size") * rule.rounds).cast("double")
    rows = sizes.withColumns({"weight": weight, "full": full})
    upto = Window.orderBy((F.col("full") / F.col("weight")), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(whole) * rule.share
    spent, spent_weight = F.coalesce(F.sum("full").over(upto), F.lit(0.0)), F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    # The level if all sources before this one are full and the others are not.
    rows = rows.withColumn("level", (budget - spent) / (F.sum("weight").over(whole) - spent_weight))
    stays = F.col("full") >= F.col("level") * F.col("weight")
    level = F.max(F.when(stays, F.col("level"))).over(whole)
    target = F.least(F.col("full"), F.coalesce(level * F.col("weight"), F.col("full")))
    return rows.select("source", "source_size", target.alias("target"))


def fit(budget: int, sizes: np.ndarray, counts: np.ndarray, limit: int) -> np.ndarray:
    """How many documents of each length to take, so that their words come as near to the budget as the program finds."""
    total = int((sizes * counts).sum())
    taken = np.zeros(len(sizes), dtype=np.int64)
    if total == 0 or budget <= 0:
        return taken
    share = [int(n) * budget for n in counts]
    taken[:] = np.minimum([x // total for x in share], counts)
    left = budget - int((sizes * taken).sum())
    # One more of a length, largest remainder first, until the rest is small enough for the dynamic program.
    for i in sorted(range(len(sizes)), key=lambda i: (-(share[i] % total), -int(sizes[i]))):
        if left <= limit:
            break
        if taken[i] < counts[i] and 0 < sizes[i] <= left:
            taken[i] += 1
            left -= int(sizes[i])
    if left > limit:
        # All that is left over is longer than this; the shortest of it comes nearest, if anything does.
        over = [i for i in range(len(sizes)) if taken[i] < counts[i] and sizes[i] > 0]
        if over and sizes[near := min(over, key=lambda i: abs(int(sizes[i]) - left))] < 2 * left:
            taken[near] += 1
        return taken
    return taken + _knapsack(left, sizes, counts - taken)


def _knapsack(budget: int, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bounded subset sum: the counts whose words come nearest to the budget, from below if two are as near."""
    out = np.zeros(len(sizes), dtype=np.int64)
    usable = [i for i in range(len(sizes)) if counts[i] > 0 and sizes[i] > 0]
    if budget <= 0 or not usable:
        return out
    room = 2 * budget  # nothing taken is as near as that
    by = np.full(room + 1, -1, dtype=np.int64)  # the bundle by which a sum was first reached
    reached = np.zeros(room + 1, dtype=bool)
    reached[0] = True
    bundles: list[tuple[int, int, int]] = []  # length's place, documents, words
    for i in sorted(usable, key=lambda i: -int(sizes[i])):
        n, part = int(counts[i]), 1
        while n and not reached[budget]:
            part = min(part, n)
            words = part * int(sizes[i])
            if words > room:
                break
            new = reached[: room + 1 - words] & ~reached[words:]
            by[words:][new] = len(bundles)
            reached[words:] |= new
            bundles.append((i, part, words))
            n -= part
            part *= 2
        if reached[budget]:
            break
    sums = np.flatnonzero(reached)
    best = int(min(sums, key=lambda s: (abs(s - budget), s)))
    while best:
        i, part, words = bundles[by[best]]
        out[i] += part
        best -= words
    return out


def _plan(rule: Mix):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ignore_index=True)
        sizes, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        whole, budget = int(rows["source_size"].iloc[0]), round(float(rows["target"].iloc[0]))
        rounds = min(rule.rounds, budget // whole) if whole else 0
        rest = budget - rounds * whole if rounds < rule.rounds else 0
        return rows.assign(rounds=rounds, more=fit(rest, sizes, counts, rule.fitted))[["source", "size", "n", "source_size", "target", "rounds", "more"]]

    return run


_ALL = (1 << 63) - 1


def _last(rows: DataFrame, by: list[str], draw: str) -> DataFrame:
    """(by..., upper, m, t): for rows with ``more`` to take of each group, the draw at which that many are reached, how many of
    the t rows that share it are among them. Found by counts: of the draw's leading bits, then inside one cell of them."""
    cell = F.shiftright(draw, 47).cast("int")
    upto = Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    cells = rows.groupBy(*by, "more", cell.alias("cell")).agg(F.count("*").alias("n")).withColumn("sum", F.sum("n").over(upto.orderBy("cell")))
    reached = cut(cells.filter("sum >= more and sum - n < more").select(*[F.col(c).alias(f"_{c}") for c in by], F.col("cell").alias("_cell"), F.expr("more - (sum - n)").alias("place")))
    same = cell == F.col("_cell")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    inside = rows.join(reached, same).groupBy(*by, "place", draw).agg(F.count("*").alias("n"))
    summed = inside.withColumn("sum", F.sum("n").over(upto.orderBy(draw)))
    return cut(summed.filter("sum >= place and sum - n < place").select(*by, F.col(draw).alias("upper"), F.expr("place - (sum - n)").alias("m"), F.col("n").alias("t")))


_PLAN = "source string, size bigint, n bigint, source_size bigint, target double, rounds bigint, more bigint"


def plan(sized: DataFrame, rule: Mix = Mix()) -> DataFrame:
    """One row per source and length: rounds of all documents, the largest hash ``upper`` that is taken once more, and of the rows
    that have it the largest second hash ``upper2``, of which ``m`` of ``t`` rows are taken.

    ``sized`` has (source, size, draw, draw2).
    """
    counts = cut(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    per_source = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    aimed = cut(targets(per_source, rule)).withColumnRenamed("source", "of")
    joined = counts.join(aimed, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    lengths = cut(joined.groupBy("source").applyInPandas(_plan(rule), _PLAN))
    partial = lengths.filter("more > 0 and more < n").select(F.col("source").alias("of"), F.col("size").alias("long"), "more")
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("long"))
    first = _last(sized.join(partial, same).drop("of", "long"), ["source", "size"], "draw")
    # Rows that share the last hash although only some of them are wanted: equal in doc_id and text.
    tied = first.filter("m < t").select(F.col("source").alias("of"), F.col("size").alias("long"), "upper", F.col("m").alias("more"))
    second = _last(sized.join(tied, same & (F.col("draw") == F.col("upper"))).drop("of", "long"), ["source", "size"], "draw2")
    keyed = lambda df, *more: df.select(F.col("source").alias("of"), F.col("size").alias("long"), *more)
    found = lengths.join(keyed(first, "upper"), same, "left").drop("of", "long")
    found = found.join(keyed(second, F.col("upper").alias("upper2"), "m", "t"), same, "left").drop("of", "long")
    everything = F.when(F.col("more") == 0, F.lit(-1)).when(F.col("more") == F.col("n"), F.lit(_ALL))
    return found.select(
        F.col("source").alias("of"), F.col("size").alias("long"), "source_size", "target", "rounds", F.coalesce(everything, "upper").alias("upper"),
        F.coalesce("upper2", F.lit(_ALL)).alias("upper2"), F.coalesce("m", F.lit(1)).alias("m"), F.coalesce("t", F.lit(1)).alias("t"),
    )


# Rows equal in every column that are made from one row in one go.
_MADE_ROWS = 10_000


def with_times(docs: DataFrame, rule: Mix = Mix()) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``times`` and ``taken`` (size times ``times``), replacing such columns.

    ``times`` is how often the mix holds the document, at most ``rounds``. A null text has size 0; a null source is a source of
    its own, the last one. Repeated rows are rows: of those equal in doc_id and text as many are taken as the plan says, chosen by
    their other columns, and of rows equal in every column any. A text of any length is counted where it is read. An empty table
    stays empty.
    """
    draw, draw2 = _draws(docs, rule)
    measured = size(F.col("text"))
    sized = cut(docs.select("source", measured.alias("size"), draw.alias("draw"), draw2.alias("draw2")))
    names = {c: f"__{c}" for c in ("of", "long", "rounds", "upper", "upper2", "m", "t")}
    chosen = bounded(plan(sized, rule).withColumnsRenamed(names), 500_000)
    made = ("size", "source_size", "target", "times", "taken")
    kept = [c for c in docs.columns if c not in made]
    with_size = docs.select(*kept, measured.alias("size"), draw.alias("__draw"), draw2.alias("__draw2"))
    on = F.col("source").eqNullSafe(F.col("__of")) & (F.col("size") == F.col("__long"))
    rows = with_size.join(chosen, on)
    last = F.col("__draw") == F.col("__upper")
    more = (F.col("__draw") < F.col("__upper")) | (last & (F.col("__draw2") <= F.col("__upper2")))
    alike = last & (F.col("__draw2") == F.col("__upper2")) & (F.col("__m") < F.col("__t"))
    out = lambda df, times: df.select(*kept, "size", "source_size", "target", times.alias("times"), (F.col("size") * times).alias("taken"))
    if chosen.filter("__m < __t").isEmpty():
        return out(rows, F.col("__rounds") + more.cast("bigint"))
    plain = out(rows.filter(~alike), F.col("__rounds") + more.cast("bigint"))
    # Rows equal in every column, some of them taken: one of them and their count make them all, in pieces.
    row = F.struct(*kept, "size", "source_size", "target", "__rounds")
    one = cut(rows.filter(alike).groupBy("__of", "__long", "__m", "__t").agg(F.any_value(row).alias("row")))
    both = F.explode(F.array(F.struct(F.lit(1).alias("extra"), F.col("__m").alias("copies")), F.struct(F.lit(0).alias("extra"), (F.col("__t") - F.col("__m")).alias("copies"))))
    parts = one.select("row", both.alias("b")).select("row", "b.*")
    parts = parts.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / _MADE_ROWS))))
    dealt = parts.repartition("part", "extra")
    here = F.least(F.lit(_MADE_ROWS), F.col("copies") - F.col("part") * _MADE_ROWS)
    made = dealt.select("row.*", "extra", F.explode(F.sequence(F.lit(1), here.cast("int"))).alias("__i"))
    return plain.unionByName(out(made, F.col("__rounds") + F.col("extra")))


def mixed(docs: DataFrame, rule: Mix = Mix()) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, its columns unchanged."""
    def repeated(rows: DataFrame) -> DataFrame:
        times = with_times(rows, rule).filter("times > 0")
        return times.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))

    return shielded(docs, ("doc_id", "text", "source"), repeated)


def report(docs: DataFrame, rule: Mix = Mix()) -> DataFrame:
    """The digest: doc_id, size, source_size, target, taken."""
    return with_times(docs.select("doc_id", "text", "source"), rule).select("doc_id", "size", "source_size", "target", "taken")
