"""The input tables by name, wherever they live."""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, StructField, StructType

from scrubline.sources.schemas import PERIOD, TABLE_NAMES, schema


# Digits kept behind a declared decimal's own when a source holds doubles: enough to tell values apart, too few for
# binary noise to show.
_MORE_DIGITS = 4
# Fixed value: the most digits of a Spark decimal.
_MOST_DIGITS = 38


def _kept_type(declared: DataType, found: DataType) -> DataType:
    """The declared type, or for decimals a wider one, so that no digit of the source is lost."""
    if not isinstance(declared, DecimalType):
        return declared
    if isinstance(found, (DoubleType, FloatType)):
        return DecimalType(declared.precision + _MORE_DIGITS, declared.scale + _MORE_DIGITS)
    if not isinstance(found, DecimalType):
        return declared
    scale = max(declared.scale, found.scale)
    whole = max(declared.precision - declared.scale, found.precision - found.scale)
    if scale + whole > _MOST_DIGITS:
        raise ValueError(f"a {found.simpleString()} does not fit a {declared.simpleString()} column")
    return declared if (whole + scale, scale) == (declared.precision, declared.scale) else DecimalType(whole + scale, scale)


def conform(df: DataFrame, name: str) -> DataFrame:
    """The declared columns in the declared types; decimals with more digits keep them.

    A column that is absent is refused: filled with nulls, it would silently turn rules off. A column already of its
    type is left alone, so filters push down.
    """
    found = {field.name.lower(): field.dataType for field in df.schema}
    missing = [field.name for field in schema(name) if field.name.lower() not in found]
    if missing:
        raise ValueError(f"table {name} has no column {', '.join(missing)}")
    fields = [StructField(f.name, _kept_type(f.dataType, found[f.name.lower()])) for f in schema(name)]
    return df.to(StructType(fields))


Place = str | DataFrame | Callable[[], DataFrame]


class Tables:
    """Maps a table name to a parquet path (anything with a slash), a catalog table, a DataFrame or a maker of one.

    A table is opened once, so every use of it in a report sees the same files.
    """

    def __init__(self, spark: SparkSession, places: Mapping[str, Place]):
        self.spark = spark
        self._places = dict(places)
        self._opened: dict[str, DataFrame] = {}

    @classmethod
    def in_directory(cls, spark: SparkSession, directory: str) -> "Tables":
        """One parquet dataset per table; the month-end ones are partitioned by period."""
        return cls(spark, {name: f"{directory.rstrip('/')}/{name}" for name in TABLE_NAMES})

    @classmethod
    def in_catalog(cls, spark: SparkSession, database: str) -> "Tables":
        return cls(spark, {name: f"{database}.{name}" for name in TABLE_NAMES})

    def live(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = conform(self._open(name), name)
        return self._opened[name]

    def _open(self, name: str) -> DataFrame:
        if name not in self._places:
            raise KeyError(f"no place given for table {name}")
        place = self._places[name]
        if not isinstance(place, str):
            return place if isinstance(place, DataFrame) else place()
        return self.spark.read.parquet(place) if "/" in place else self.spark.table(place)

    def bucketed_by(self, column: str, names: Sequence[str]) -> bool:
        """Whether all of these are catalog tables that are bucketed by that column."""

        def bucketed(name: str) -> bool:
            place = self._places.get(name)
            if not isinstance(place, str) or "/" in place:
                return False
            return [c.name for c in self.spark.catalog.listColumns(place) if c.isBucket] == [column]

        return all(bucketed(name) for name in names)

    def snapshot(self, name: str, period: Column) -> DataFrame:
        """One period of a month-end table. The period is a literal, so partitions are pruned without a join on it."""
        return self.live(f"{name}_me").filter(F.col(PERIOD) == period).drop(PERIOD)
