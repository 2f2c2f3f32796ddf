"""Indexes of text categories from tables, whatever the number of categories.

Each column gets a dictionary: its values by falling frequency, ties in
alphabetical order, numbered from 0. It is made by one range sort, written as a
table and joined; neither fitting nor applying brings it to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwarden.operators.lookup import attach_per_key, stage
from tillwarden.session import shared_folder

DICTIONARY = "value string, rows_at long, place double"


def ranked_dictionary(rows: DataFrame, column: str, folder: str) -> DataFrame:
    """``value``, ``rows_at`` and ``place`` of every value of a column, written below ``folder``.

    Values are counted in every task first, dealt to ranges of (count, value) and
    sorted there; a place is the one within the range plus the sizes of the
    ranges before, of which there are as many as tasks.
    """
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value"))
    counts = counts.agg(F.count("*").alias("rows_at"))
    order = [F.desc("rows_at"), F.asc("value")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = stage(dealt.withColumn("seat", F.monotonically_increasing_id()), f"{folder}/sorted")
    dealt = dealt.withColumn("part", F.shiftright("seat", 33))
    ranges = dealt.groupBy("part").agg(F.count("*").alias("held"), F.min("seat").alias("first"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("part", "first", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("ahead"))
    place = (F.col("seat") - F.col("first") + F.col("ahead")).cast("double")
    placed = dealt.join(F.broadcast(ranges), "part").select("value", "rows_at", place.alias("place"))
    return stage(placed, f"{folder}/places")


class _Categories(Params):
    """Columns, the names of their indexes, and where the dictionaries lie."""

    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "indexes", TypeConverters.toListString)
    folder = Param(Params._dummy(), "folder", "dictionaries", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "values per column", TypeConverters.toListInt)


class CategoryIndexer(Estimator, _Categories, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the dictionaries of some columns, in a new folder of the cluster's shared one."""

    def __init__(self, columns: Sequence[str] = (), indexes: Sequence[str] = ()):
        super().__init__()
        self._set(inputCols=list(columns), outputCols=list(indexes))

    def _fit(self, rows: DataFrame) -> CategoryModel:
        folder = shared_folder(rows.sparkSession, "categories")
        columns = self.getOrDefault(self.inputCols)
        sizes = [ranked_dictionary(rows, c, f"{folder}/{c}").count() for c in columns]
        return CategoryModel(columns, self.getOrDefault(self.outputCols), folder, sizes)


class CategoryModel(Model, _Categories, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the indexes; a value without a place, or none, gets the number of places."""

    def __init__(
        self,
        columns: Sequence[str] = (),
        indexes: Sequence[str] = (),
        folder: str = "",
        sizes: Sequence[int] = (),
    ):
        super().__init__()
        self._set(inputCols=list(columns), outputCols=list(indexes), folder=folder, sizes=list(sizes))

    def dictionary(self, rows: DataFrame, column: str) -> DataFrame:
        path = f"{self.getOrDefault(self.folder)}/{column}/places"
        return rows.sparkSession.read.schema(DICTIONARY).parquet(path)

    def _transform(self, rows: DataFrame) -> DataFrame:
        columns, indexes, sizes = (self.getOrDefault(p) for p in (self.inputCols, self.outputCols, self.sizes))
        for column, index, size in zip(columns, indexes, sizes, strict=True):
            places = self.dictionary(rows, column).withColumnsRenamed(
                {"value": column, "rows_at": "_rows_at", "place": index}
            )
            # Frequent values come from a bounded broadcast, so their rows are not brought to one task.
            found = attach_per_key(rows, places, column, weight="_rows_at", spread=rows.columns[0])
            rows = found.withColumn(index, F.coalesce(index, F.lit(float(size)))).drop("_rows_at")
        return rows

    def kept_in(self, spark, folder: str) -> CategoryModel:
        """The same model with its dictionaries copied to ``folder``, to stay as long as the model does."""
        columns, indexes, sizes = (self.getOrDefault(p) for p in (self.inputCols, self.outputCols, self.sizes))
        for column in columns:
            stage(self.dictionary(spark.range(0), column), f"{folder}/{column}/places")
        return CategoryModel(columns, indexes, folder, sizes)
