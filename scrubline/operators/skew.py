"""Left joins on the loan id that survive a loan id with very many rows.

Ordinary loans take one chain of left joins: the loans are shuffled once by loan id and every join reuses that
partitioning. Adaptive execution cannot split a hot key there, neither inside such a chain nor on the right side of a
left join. So hot loan ids are found first, taken out of the chain, and joined apart on (loan id, piece of the left rows,
piece of the right rows), which spreads one loan over many tasks. The two parts together are the whole join.

A row's piece comes from a number that is stored with the hot rows in the shared folder before any join reads it. A task
rerun after a lost executor reads the same number, whatever order the rows had when they were numbered.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.shared import bounded, cut
from scrubline.sources.schemas import LOAN

# A hot list of up to so many rows is sent to all tasks; a longer one is joined by a shuffle.
SENT_ROWS = 100_000
# The same for the cells in which hot ids may be: one number each.
SENT_CELLS = 1_000_000


@dataclass(frozen=True)
class Skew:
    """A loan id is hot when its loans and its rows in every row set make over ``piece_rows`` joined rows, or when one
    row set alone has that many rows of it. No task of a hot join makes more than about ``piece_rows`` rows of one id.

    The search counts ids in ``cells`` hash cells first. It stays exact at any number of ids, but spares the count of single ids
    only while there are several times more cells than ids. ``co_partitioned`` is for tables bucketed by loan id: ids
    are then counted inside their buckets.
    """

    piece_rows: int = 1_000_000
    cells: int = 1 << 22
    co_partitioned: bool = False


def _same(part: DataFrame) -> DataFrame:
    return part


@dataclass(frozen=True)
class Join:
    """``loans`` to be left-joined with every row set on the loan id.

    Hot ids are looked for in ``loans`` and in ``searched``: the row sets that may hold many rows of a loan, under their
    names (all of them, unless given). ``prepare`` is applied to each part of the loans after the split, before the joins.
    """

    loans: DataFrame
    row_sets: Mapping[str, DataFrame]
    searched: Mapping[str, DataFrame] | None = None
    prepare: Callable[[DataFrame], DataFrame] = _same

    def counted(self) -> dict[str, DataFrame]:
        """The id columns that are searched. Right rows without an id match nothing and are not counted."""
        sets = self.row_sets if self.searched is None else self.searched
        return {"loans": self.loans.select(LOAN)} | {name: df.select(LOAN).filter(F.col(LOAN).isNotNull()) for name, df in sets.items()}


# Rows of the count-min table: hash functions, each applied to the ids that are candidates after the one before.
_TABLE_ROWS = 2


def _column(join: int, name: str) -> str:
    return f"_{join}_{name}"


def _product(joins: Sequence[Join]) -> Column:
    """The most rows that any of the joins makes, from the counts of an id or of a cell."""
    made = [reduce(lambda a, b: a * b, [F.greatest(F.col(_column(j, n)), F.lit(1)).cast("double") for n in join.counted()]) for j, join in enumerate(joins)]
    return F.greatest(*made) if len(made) > 1 else made[0]


def _tagged(joins: Sequence[Join]) -> DataFrame:
    """All ids that are searched, with the number of the set they are from."""
    frames = [df for join in joins for df in join.counted().values()]
    return reduce(DataFrame.unionByName, [df.withColumn("_of", F.lit(i)) for i, df in enumerate(frames)])


def _counts(joins: Sequence[Join], tagged: DataFrame, by: Column) -> DataFrame:
    """Rows of every set under each value of ``by``, counted map-side first."""
    names = [_column(j, n) for j, join in enumerate(joins) for n in join.counted()]
    return tagged.groupBy(by).agg(*[F.count(F.when(F.col("_of") == i, 1)).alias(n) for i, n in enumerate(names)])


def _cell(row: int, cells: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), LOAN), F.lit(cells))


def heavy_cells(joins: Sequence[Join], tagged: DataFrame, row: int, skew: Skew) -> DataFrame:
    """Cells of one row of the count-min table in which an id may be hot: a cell's counts are never under those of its ids."""
    cells = _counts(joins, tagged, _cell(row, skew.cells).alias("_cell"))
    return cells.filter(_product(joins) > skew.piece_rows).select("_cell")


def candidates(tagged: DataFrame, heavy: DataFrame, row: int, skew: Skew) -> DataFrame:
    return tagged.join(heavy, _cell(row, skew.cells) == F.col("_cell"), "left_semi")


def counts_in_buckets(joins: Sequence[Join]) -> DataFrame:
    """Rows of the loans' ids in every set. Tables bucketed by loan id are counted and joined where they are, without an
    exchange. An id without a loan is not listed: nothing moves its rows, and a merge join passes over them."""
    frames = {_column(j, n): df for j, join in enumerate(joins) for n, df in join.counted().items()}
    first, *others = [df.groupBy(LOAN).agg(F.count("*").alias(name)) for name, df in frames.items()]
    whole = reduce(lambda a, b: a.join(b, LOAN, "left"), others, first)
    return whole.select(LOAN, *[F.coalesce(name, F.lit(0)).alias(name) for name in frames])


def hot_loans(joins: Sequence[Join], skew: Skew) -> list[DataFrame] | None:
    """For each join (LoanId, loans, <row set>...): ids that are hot in any of the joins, the missing one too, with their row
    counts; None if there is none.

    Only id columns are read. With no hot cell, the usual case, the search ends after one job, whose exchange carries cells
    and counts. Otherwise the ids in hot cells are hashed anew, and only those that stay candidates are counted one by one.
    """
    if skew.co_partitioned and len(joins) == 1:
        counts = counts_in_buckets(joins)
    else:
        tagged = _tagged(joins)
        for row in range(_TABLE_ROWS):
            heavy = heavy_cells(joins, tagged, row, skew)
            if heavy.isEmpty():
                return None
            tagged = candidates(tagged, bounded(heavy, SENT_CELLS), row, skew)
        counts = _counts(joins, tagged, F.col(LOAN))
    found = counts.filter(_product(joins) > skew.piece_rows)
    if found.isEmpty():
        return None
    hot = cut(found)
    return [hot.select(LOAN, *[F.col(_column(j, n)).alias(n) for n in join.counted()]) for j, join in enumerate(joins)]


def find_hot_loans(loans: DataFrame, row_sets: Mapping[str, DataFrame], skew: Skew) -> DataFrame | None:
    """``hot_loans`` of one join."""
    hot = hot_loans([Join(loans, row_sets)], skew)
    return None if hot is None else hot[0]


def left_joins(joins: Sequence[Join], skew: Skew | None) -> list[DataFrame]:
    """Every join, after one search for all of them. The search runs at once, the joins when the results are read. With
    ``skew`` None nothing is looked for or split."""
    hot = None if skew is None else hot_loans(joins, skew)
    return [_chain(join.prepare(join.loans), join.row_sets) if hot is None else _split(join, own, skew) for join, own in zip(joins, hot or joins)]


def left_join(
    loans: DataFrame,
    row_sets: Mapping[str, DataFrame],
    skew: Skew | None,
    *,
    searched: Mapping[str, DataFrame] | None = None,
    prepare: Callable[[DataFrame], DataFrame] = _same,
) -> DataFrame:
    """``left_joins`` of one join."""
    return left_joins([Join(loans, row_sets, searched, prepare)], skew)[0]


def _split(join: Join, hot: DataFrame, skew: Skew) -> DataFrame:
    loans, row_sets, prepare = join.loans, join.row_sets, join.prepare
    ids = bounded(hot.select(F.col(LOAN).alias("_hot")), SENT_ROWS)
    is_hot = F.col(LOAN).eqNullSafe(F.col("_hot"))
    ordinary = {name: df.join(ids, is_hot, "left_anti") for name, df in row_sets.items()}
    apart = {name: _numbered(df.join(ids, is_hot, "left_semi")) for name, df in row_sets.items()}
    seeded = prepare(_numbered(loans.join(ids, is_hot, "left_semi")))
    return _chain(prepare(loans.join(ids, is_hot, "left_anti")), ordinary).unionByName(
        _chain_in_pieces(seeded, apart, hot, skew)
    )


def _chain(loans: DataFrame, row_sets: Mapping[str, DataFrame]) -> DataFrame:
    for df in row_sets.values():
        loans = loans.join(df, LOAN, "left")
    return loans


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with a stored random-looking ``_seed``."""
    return cut(rows.withColumn("_seed", F.xxhash64(F.monotonically_increasing_id())))


def _pieces(left_rows: Column, right_rows: Column, piece_rows: int) -> tuple[Column, Column]:
    """Numbers of left and right pieces, so that a pair of pieces joins to about ``piece_rows`` rows."""
    rights = F.greatest(F.ceil(right_rows / piece_rows), F.lit(1))
    lefts = F.ceil(left_rows * F.least(right_rows, F.lit(float(piece_rows))) / piece_rows)
    return F.greatest(F.least(lefts.cast("double"), left_rows), F.lit(1.0)).cast("int"), rights.cast("int")


def _chain_in_pieces(loans: DataFrame, row_sets: Mapping[str, DataFrame], hot: DataFrame, skew: Skew) -> DataFrame:
    """The chain for hot loans, each join on pieces. ``loans`` and the row sets carry ``_seed``."""
    left_rows = F.col("loans").cast("double")
    for name, df in row_sets.items():
        # A row set that was not searched has one row of a loan at most.
        right_rows = F.greatest(F.col(name), F.lit(1)).cast("double") if name in hot.columns else F.lit(1.0)
        lefts, rights = _pieces(left_rows, right_rows, skew.piece_rows)
        grid = hot.select(F.col(LOAN).alias("_loan"), lefts.alias("_lefts"), rights.alias("_rights"))
        loans = _join_in_pieces(loans, df, bounded(grid, SENT_ROWS))
        left_rows = left_rows * right_rows
    return loans.drop("_seed")


def _join_in_pieces(left: DataFrame, right: DataFrame, grid: DataFrame) -> DataFrame:
    """Each left row meets every right piece of its loan once, and each right row every left piece once."""
    same_loan = F.col(LOAN).eqNullSafe(F.col("_loan"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.col("_seed"), F.col(n)).cast("int")
    lefts = left.join(grid, same_loan).withColumn("_left", own("_lefts")).withColumn("_right", every("_rights"))
    rights = (
        right.join(grid, same_loan)
        .withColumn("_right", own("_rights"))
        .withColumn("_left", every("_lefts"))
        .withColumnRenamed("_seed", "_right_seed")
        .drop("_loan", "_lefts", "_rights")
    )
    joined = lefts.join(rights, [LOAN, "_left", "_right"], "left")
    # With several right pieces the loan surely has right rows, so a copy that met none in its piece is no result row.
    met = F.col("_right_seed").isNotNull() | (F.col("_rights") == 1)
    return (
        joined.filter(met)
        .withColumn("_seed", F.xxhash64("_seed", "_right_seed"))
        .drop("_loan", "_lefts", "_rights", "_left", "_right", "_right_seed")
    )
