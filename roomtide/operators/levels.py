"""Category levels as a table: counted, numbered and joined to rows, whatever their number.

A level table has one row per feature and level: ``feature``, ``level``, ``n`` (training rows) and
``index``. Frequent levels of a feature are numbered 0..k-1 in order of their text, all rare ones
share index k, and a level that training has not seen is not in the table. Nothing of it passes
through the driver but one row per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.operators.ranking import ROWS_PER_RANGE, free_names, row_numbers
from roomtide.session import cut_lineage

MISSING = "missing"
LEVELS = "level string, n bigint, index bigint, feature string"


def long_levels(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature and level, a row for every row and feature; no value is the level ``missing``."""
    pairs = [F.struct(F.lit(f).alias("feature"), F.coalesce(F.col(f"`{f}`").cast("string"), F.lit(MISSING)).alias("level")) for f in features]
    return df.select(F.inline(F.array(*pairs)))


def level_table(train: DataFrame, features: Sequence[str], min_frequency: int, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The level table of ``train``, written to the shared folder by feature."""
    counts = cut_lineage(long_levels(train, features).groupBy("feature", "level").agg(F.count("*").alias("n")), "level-counts")
    frequent = counts.where(F.col("n") >= min_frequency)
    numbered = cut_lineage(row_numbers(frequent, "feature", "level", "number", rows_per_range), "level-numbers")
    starts = numbered.groupBy("feature").agg(F.min("number").alias("start"), F.count("*").alias("frequent"))  # a row per feature
    own = numbered.join(starts, "feature").select("feature", "level", "n", (F.col("number") - F.col("start")).alias("index"))
    rare = counts.where(F.col("n") < min_frequency).join(starts, "feature", "left")
    rare = rare.select("feature", "level", "n", F.coalesce("frequent", F.lit(0)).alias("index"))
    return cut_lineage(own.unionByName(rare).select("level", "n", F.col("index").cast("long").alias("index"), "feature"), "levels", ["feature"])


def level_widths(table: DataFrame, features: Sequence[str]) -> dict[str, int]:
    """How many columns the levels of every feature take."""
    found = {r.feature: r.width for r in table.groupBy("feature").agg((F.max("index") + 1).alias("width")).collect()}  # a row per feature
    return {f: int(found.get(f, 0)) for f in features}


def join_levels(rows: DataFrame, table: DataFrame, columns: dict[str, str], out: dict[str, str]) -> DataFrame:
    """Rows with the index of the level of every feature, null for levels that are not in the table.

    ``columns`` and ``out`` give the column with the level and the new column of each feature. One
    join per feature: Spark sends small parts of the table to all tasks and shuffles by level where
    there are very many, splitting hot levels.
    """
    for feature, column in columns.items():
        level, index = free_names(rows, "_level", "_index")
        part = table.where(F.col("feature") == feature).select(F.col("level").alias(level), F.col("index").alias(index))
        value = F.coalesce(rows[f"`{column}`"].cast("string"), F.lit(MISSING))
        rows = rows.join(part, value == F.col(level), "left").withColumn(out[feature], F.col(index)).drop(level, index)
    return rows


class LevelEncoder(Transformer, MLReadable, MLWritable):
    """A pipeline stage that adds ``<feature>_level``: the index from a level table, or the feature's width for unseen levels.

    The columns tell Spark ML their number of values, so an encoder after this stage need not look
    at the rows. A saved stage holds a copy of its table.
    """

    features = Param(Params._dummy(), "features", "categorical columns", TypeConverters.toListString)
    widths = Param(Params._dummy(), "widths", "number of indexes of each column", TypeConverters.toListInt)

    def __init__(self, table: DataFrame | None = None, features: Sequence[str] = (), widths: Sequence[int] = ()):
        super().__init__()
        self.table = table
        self._set(features=list(features), widths=list(widths))

    @classmethod
    def fitted(cls, train: DataFrame, features: Sequence[str], min_frequency: int) -> LevelEncoder:
        table = level_table(train, features, min_frequency)
        widths = level_widths(table, features)
        return cls(table, features, [max(1, widths[f]) for f in features])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getOrDefault(self.features)
        found = join_levels(dataset, self.table, {f: f for f in names}, {f: f"{f}_level" for f in names})
        made = {}
        for name, width in zip(names, self.getOrDefault(self.widths)):
            attribute = {"ml_attr": {"type": "nominal", "num_vals": width, "name": f"{name}_level"}}
            value = F.coalesce(F.col(f"`{name}_level`"), F.lit(width)).cast("double")
            made[f"{name}_level"] = value.alias(f"{name}_level", metadata=attribute)
        return found.select(*[made.get(c, F.col(f"`{c}`")) for c in found.columns])

    def copy(self, extra=None) -> LevelEncoder:
        made = super().copy(extra)
        made.table = self.table
        return made

    def write(self) -> LevelWriter:
        return LevelWriter(self)

    @classmethod
    def read(cls) -> LevelReader:
        return LevelReader(cls)


class LevelWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.table.write.partitionBy("feature").parquet(f"{path}/levels")


class LevelReader(DefaultParamsReader):
    def load(self, path: str) -> LevelEncoder:
        stage = super().load(path)
        stage.table = self.sparkSession.read.schema(LEVELS).parquet(f"{path}/levels")
        return stage
