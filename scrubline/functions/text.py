"""Text comparison as a case-insensitive, blank-padded collation does it.

Trailing blanks never count; letter case does not count unless ``case_sensitive``. Output columns keep their
raw text: these only build predicates and join keys.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Text:
    case_sensitive: bool = False

    def key(self, column: Column) -> Column:
        trimmed = F.rtrim(column)
        return trimmed if self.case_sensitive else F.lower(trimmed)

    def fold(self, value: str) -> str:
        trimmed = value.rstrip(" ")
        return trimmed if self.case_sensitive else trimmed.lower()

    def equals(self, column: Column, value: str) -> Column:
        return self.key(column) == self.fold(value)

    def differs(self, column: Column, value: str) -> Column:
        return self.key(column) != self.fold(value)

    def isin(self, column: Column, values: Sequence[str]) -> Column:
        return self.key(column).isin(sorted({self.fold(v) for v in values}))

    def between(self, column: Column, low: str, high: str) -> Column:
        """Text range: '45' and '4000' lie between '400' and '498'."""
        return self.key(column).between(self.fold(low), self.fold(high))

    def contains(self, column: Column, piece: str) -> Column:
        return column.like(f"%{piece}%") if self.case_sensitive else column.ilike(f"%{piece}%")

    def wide_isin(self, column: Column, values: Sequence[str]) -> Column:
        """A wider ``isin`` on the raw column that parquet can apply at the scan.

        A value equal after trimming and case folding begins with one of the spellings, so no row is lost.
        """
        spellings = sorted({s for v in values for s in self._spellings(v.rstrip(" "))})
        return reduce(or_, [column.startswith(s) for s in spellings])

    def wide_between(self, column: Column, low: str, high: str) -> Column:
        """A wider ``between`` for digit bounds on the raw column that parquet can apply at the scan.

        Blanks sort below digits, so 'high' padded with blanks stays below the next value after it.
        """
        if not (low.isdigit() and high.isdigit()):
            raise ValueError("wide_between takes bounds made of digits")
        after_high = high[:-1] + chr(ord(high[-1]) + 1)
        return (column >= low) & (column < after_high)

    def at_scan(self, condition: Callable[["Text"], Column]) -> Column:
        """A condition built from positive ``isin`` and ``between`` tests, preceded by its wider, pushable form.

        The wide form is a conjunct of its own: inside an OR, one part that parquet cannot apply holds back the rest.
        """
        return condition(_Wide(self.case_sensitive)) & condition(self)

    def _spellings(self, value: str) -> set[str]:
        if self.case_sensitive:
            return {value}
        return {"".join(letters) for letters in product(*[{ch.lower(), ch.upper()} for ch in value])}


class _Wide(Text):
    """Text tests in their wide forms."""

    def isin(self, column: Column, values: Sequence[str]) -> Column:
        return self.wide_isin(column, values)

    def between(self, column: Column, low: str, high: str) -> Column:
        return self.wide_between(column, low, high)
