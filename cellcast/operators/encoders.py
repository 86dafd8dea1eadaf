"""Category preprocessing as saved ``pyspark.ml`` stages (M1, M4).

``CategoryText`` turns categories into strings, ``ModeImputer`` fills nulls with
each column's most frequent value, ``OrdinalEncoder`` gives each value its place in
the sorted level table (A27) and unseen values -1.  All three are fitted by
aggregates, save with the pipeline they belong to, and transform inside the JVM.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    def _pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.getInputCols(), self.getOutputCols(), strict=True))


class CategoryText(Transformer, _Columns):
    """categories as strings; with a ``missing`` token nulls become that token."""

    missing = Param(Params._dummy(), "missing", "string for nulls; empty: nulls stay", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None, missing: str = ""):
        super().__init__()
        self._setDefault(missing="")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        token = self.getOrDefault(self.missing)
        text = {}
        for source, target in self._pairs():
            value = F.col(source).cast("string")
            text[target] = F.coalesce(value, F.lit(token)) if token else value
        return dataset.withColumns(text)


class ModeImputer(Estimator, _Columns):
    """Most frequent value of each column, the smallest on ties; all columns in one scan."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ModeImputerModel:
        columns = self.getInputCols()
        found = {r["feature"]: r["mode"] for r in column_modes(dataset, columns).collect()}  # a row per column
        empty = [c for c in columns if c not in found]
        if empty:
            raise ValueError(f"No value to fill nulls with in columns {empty}")
        return ModeImputerModel(
            inputCols=columns, outputCols=self.getOutputCols(), modes=[found[c] for c in columns]
        )


class ModeImputerModel(Model, _Columns):
    modes = Param(Params._dummy(), "modes", "value for nulls, by column", TypeConverters.toListString)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] | None = None,
        outputCols: Sequence[str] | None = None,
        modes: Sequence[str] | None = None,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = zip(self._pairs(), self.getOrDefault(self.modes), strict=True)
        return dataset.withColumns({t: F.coalesce(F.col(s).cast("string"), F.lit(m)) for (s, t), m in filled})


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M1: (feature, mode, n): the most frequent value, nulls aside, and how often it occurs."""
    entry = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    counts = df.select(entry.alias("e")).select("e.*").where("value is not null").groupBy("feature", "value").agg(F.count("*").alias("n"))
    best = F.min(F.struct(F.negative("n").alias("less"), "value"))
    return counts.groupBy("feature").agg(best.alias("b")).select(
        "feature", F.col("b.value").alias("mode"), F.negative("b.less").alias("n")
    )


class OrdinalEncoder(Estimator, _Columns):
    """Place of each value in its column's sorted levels; unseen values and nulls get -1.

    The levels are those of the training rows, kept with the model; more than
    ``maxLevels`` of one column are refused (:func:`cellcast.operators.learn.ordinal_codes`
    joins a level table of any size).
    """

    maxLevels = Param(Params._dummy(), "maxLevels", "levels of a column at most", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] | None = None,
        outputCols: Sequence[str] | None = None,
        maxLevels: int = 100_000,
    ):
        super().__init__()
        self._setDefault(maxLevels=100_000)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> OrdinalEncoderModel:
        columns, most = self.getInputCols(), self.getOrDefault(self.maxLevels)
        entry = F.explode(
            F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in columns])
        )
        levels = dataset.select(entry.alias("e")).select("e.*").where("level is not null").distinct().persist()
        try:
            sizes = {r["feature"]: r["count"] for r in levels.groupBy("feature").count().collect()}
            large = [c for c in columns if sizes.get(c, 0) > most]
            if large:
                raise ValueError(f"Columns {large} have more than {most:,} levels; join a level table instead.")
            found: dict[str, list[str]] = {c: [] for c in columns}
            for r in levels.collect():  # at most maxLevels of each column
                found[r["feature"]].append(r["level"])
        finally:
            levels.unpersist()
        ordered = json.dumps([sorted(found[c]) for c in columns])
        return OrdinalEncoderModel(inputCols=columns, outputCols=self.getOutputCols(), levels=ordered)


class OrdinalEncoderModel(Model, _Columns):
    levels = Param(Params._dummy(), "levels", "JSON: the sorted levels of each column", TypeConverters.toString)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] | None = None,
        outputCols: Sequence[str] | None = None,
        levels: str | None = None,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def level_lists(self) -> list[list[str]]:
        return json.loads(self.getOrDefault(self.levels))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pairs, lists = self._pairs(), self.level_lists()
        text = [f"{t}__text" for _, t in pairs]
        out = dataset.withColumns({x: F.col(s).cast("string") for x, (s, _) in zip(text, pairs)})
        known = [levels or [""] for levels in lists]
        indexer = StringIndexerModel.from_arrays_of_labels(known, text, [t for _, t in pairs], "keep")
        out = indexer.transform(out).drop(*text)
        unseen = {
            t: F.when(F.col(t) < len(levels), F.col(t)).otherwise(F.lit(-1.0)).alias(t)
            for (_, t), levels in zip(pairs, lists)
        }
        return out.withColumns(unseen)
