"""Model surface on pyspark.ml: class balance, category levels, preprocessing,
classifiers, artifact scoring and candidate selection (M1-M7, M10, A11, A22,
A23, A27, F10, F11).

Boosted-tree libraries of the reference are re-aimed at ``pyspark.ml`` trees:
the process (weights, early stopping on a validation slice, thresholds chosen
on validation) is kept; the scores of a different trainer cannot match.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellcast.fixed_values import CATEGORICAL_MISSING_TOKEN, MINIMUM_RECALL, WEIGHT_CANDIDATES
from cellcast.functions.categories import category_string
from cellcast.operators.encoders import CategoryText, ModeImputer, OrdinalEncoder
from cellcast.operators.numbering import number_rows
from cellcast.session import cut_lineage


# --------------------------------------------------------------------------- #
# Label distribution and class weights
# --------------------------------------------------------------------------- #
def class_balance(df: DataFrame, label_col: str) -> DataFrame:
    """Rows and percent per label (a handful of rows; the total is a window
    over that small grouped table)."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())
    return counts.withColumn("percent", F.col("rows") * F.lit(100.0) / total)


def balanced_class_weights(df: DataFrame, label_col: str) -> DataFrame:
    """``n / (2 * n_label)`` per label, imbalance ratio neg/pos and its square root."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("rows"))
    everything = Window.partitionBy()
    total = F.sum("rows").over(everything)
    pos = F.sum(F.when(F.col(label_col) == 1, F.col("rows"))).over(everything)
    neg = F.sum(F.when(F.col(label_col) == 0, F.col("rows"))).over(everything)
    return counts.select(
        label_col,
        "rows",
        (total / (F.lit(2.0) * F.col("rows"))).alias("class_weight"),
        (neg / pos).alias("imbalance_ratio"),
        F.sqrt(neg / pos).alias("sqrt_imbalance"),
    )


def with_balanced_weights(df: DataFrame, label_col: str, weight_col: str = "weight") -> DataFrame:
    """Row weights for ``class_weight="balanced"`` (two label counts, broadcast)."""
    weights = balanced_class_weights(df, label_col).select(label_col, "class_weight")
    return df.join(F.broadcast(weights), label_col, "left").withColumnRenamed("class_weight", weight_col)


# --------------------------------------------------------------------------- #
# Category levels
# --------------------------------------------------------------------------- #
def category_levels(train: DataFrame, columns: Sequence[str], as_type: dict[str, str] | None = None) -> DataFrame:
    """Sorted string levels per column, learned from training rows only.

    Output (feature, level, level_index); a column with no levels raises.  One
    scan reads all columns; levels are numbered by a range sort, so a vocabulary
    of any size is spread over the cluster.
    """
    as_type = as_type or {}
    entry = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), category_string(F.col(c), as_type.get(c)).alias("level")) for c in columns])
    )
    levels = train.select(entry.alias("e")).select("e.feature", "e.level").distinct()
    numbered = number_rows(levels, ["feature"], ["level"], "level_index")
    numbered = numbered.withColumn("level_index", F.col("level_index").cast("int"))
    require_levels(numbered, columns)
    return numbered


def require_levels(levels: DataFrame, columns: Sequence[str]) -> None:
    present = {r[0] for r in levels.select("feature").distinct().collect()}
    empty = [c for c in columns if c not in present]
    if empty:
        raise ValueError(f"There are no training levels of {empty}.")


def apply_levels(
    df: DataFrame, levels: DataFrame, columns: Sequence[str], as_type: dict[str, str] | None = None
) -> DataFrame:
    """map values to saved levels; unseen values become null.

    The join strategy is left to AQE, which broadcasts a level table only when
    its measured size allows it.
    """
    as_type = as_type or {}
    out = df
    for c in columns:
        lv = levels.filter(F.col("feature") == c).select(
            F.col("level").alias(f"_lv_{c}"), F.col("level_index").alias(f"{c}_index")
        )
        key = category_string(F.col(c), as_type.get(c))
        out = out.withColumn(f"_key_{c}", key).join(lv, F.col(f"_key_{c}") == F.col(f"_lv_{c}"), "left")
        out = out.withColumn(c, F.col(f"_lv_{c}")).drop(f"_key_{c}", f"_lv_{c}")
    return out


def ordinal_codes(df: DataFrame, levels: DataFrame, columns: Sequence[str], as_type: dict[str, str] | None = None) -> DataFrame:
    """M4 for a level table of any size: ``<column>_code`` is the place in the table, -1 if unseen."""
    out = apply_levels(df.select("*", *[F.col(c).alias(f"_own_{c}") for c in columns]), levels, columns, as_type)
    codes = {f"{c}_code": F.coalesce(F.col(f"{c}_index"), F.lit(-1)) for c in columns}
    kept = {c: F.col(f"_own_{c}") for c in columns}
    return out.withColumns(codes | kept).drop(*[f"_own_{c}" for c in columns], *[f"{c}_index" for c in columns])


# --------------------------------------------------------------------------- #
# Legacy-schema tolerance
# --------------------------------------------------------------------------- #
def available_features(df: DataFrame, wanted: Sequence[str], optional: Sequence[str] = ()) -> list[str]:
    """Required features must exist; optional ones are dropped (with a warning) if absent."""
    missing_required = [c for c in wanted if c not in df.columns and c not in optional]
    if missing_required:
        raise ValueError(f"The training rows lack {missing_required}.")
    missing_optional = [c for c in optional if c not in df.columns]
    if missing_optional:
        print(f"Going on without the optional columns {missing_optional}.")
    return [c for c in wanted if c in df.columns]


# --------------------------------------------------------------------------- #
# M1-M5: preprocessing and classifiers
# --------------------------------------------------------------------------- #
def preprocessing_stages(
    numeric: Sequence[str], categorical: Sequence[str], scale: bool = True, one_hot: bool = True, missing: str = ""
):
    """M1 and M4: median impute (+ scale) for numbers; categories most-frequent impute,
    then one-hot (unseen levels are all zero) or ordinal codes in level order (unseen: -1).

    With a ``missing`` token nulls are a category of their own instead (M5).
    """
    stages = []
    imputed = [f"{c}__imp" for c in numeric]
    if numeric:
        stages.append(Imputer(strategy="median", inputCols=list(numeric), outputCols=imputed))
    encoded: list[str] = []
    if categorical:
        text, filled = [f"{c}__str" for c in categorical], [f"{c}__cat" for c in categorical]
        encoded = [f"{c}__code" for c in categorical]
        stages.append(CategoryText(inputCols=list(categorical), outputCols=text, missing=missing))
        stages.append(ModeImputer(inputCols=text, outputCols=filled))
        if one_hot:
            indexed = [f"{c}__idx" for c in categorical]
            stages.append(StringIndexer(inputCols=filled, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"))
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep", dropLast=True))
        else:
            stages.append(OrdinalEncoder(inputCols=filled, outputCols=encoded))
    if scale and numeric:
        stages.append(VectorAssembler(inputCols=imputed, outputCol="_num_vec", handleInvalid="keep"))
        stages.append(StandardScaler(inputCol="_num_vec", outputCol="_num_scaled", withMean=True, withStd=True))
        inputs = ["_num_scaled", *encoded]
    else:
        inputs = [*imputed, *encoded]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return stages


def classifier(kind: str, label_col: str, weight_col: str | None, seed: int = 42, **params):
    """M2 logistic, M3 random forest, M4/M5 gradient-boosted trees."""
    common = {"labelCol": label_col, "featuresCol": "features"}
    if weight_col:
        common["weightCol"] = weight_col
    if kind == "logistic":
        return LogisticRegression(maxIter=params.get("max_iter", 1000), **common)
    if kind == "random_forest":
        return RandomForestClassifier(
            numTrees=params.get("trees", 300),
            maxDepth=params.get("depth", 15),
            minInstancesPerNode=params.get("min_leaf", 10),
            seed=seed,
            **common,
        )
    if kind == "gbt":
        extra = {}
        if params.get("validation_col"):
            extra["validationIndicatorCol"] = params["validation_col"]
            extra["validationTol"] = params.get("validation_tol", 0.01)
        return GBTClassifier(
            maxIter=params.get("iterations", 300),
            stepSize=params.get("learning_rate", 0.05),
            maxDepth=params.get("depth", 5),
            seed=seed,
            **extra,
            **common,
        )
    raise ValueError(f"Unknown model kind: {kind}")


def fit_model(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label_col: str,
    kind: str = "gbt",
    balanced: bool = True,
    validation: DataFrame | None = None,
    weight_col: str | None = None,
    **params,
) -> PipelineModel:
    """Fit preprocessing + classifier as one PipelineModel.

    With ``validation`` and a boosted model, the validation rows are appended
    with an indicator column for early stopping, and missing categories are a
    level of their own (M5); all other models impute them (M1-M4).
    """
    data = train
    early_stopping = validation is not None and kind == "gbt"
    if balanced:
        data = with_balanced_weights(data, label_col, "_weight")
        weight_col = "_weight"
    if early_stopping:
        v = validation
        if balanced:
            v = with_balanced_weights(v, label_col, "_weight")
        data = data.withColumn("_is_val", F.lit(False)).unionByName(v.withColumn("_is_val", F.lit(True)))
        params["validation_col"] = "_is_val"
    linear = kind == "logistic"
    missing = CATEGORICAL_MISSING_TOKEN if early_stopping else ""
    stages = preprocessing_stages(numeric, categorical, scale=linear, one_hot=linear, missing=missing)
    stages.append(classifier(kind, label_col, weight_col, **params))
    # Every stage and every optimizer iteration scans the training rows: keep
    # them cached for the fit (spills to disk if they do not fit in memory).
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=stages).fit(data)
    finally:
        data.unpersist()


def score(model: PipelineModel, df: DataFrame, categorical: Sequence[str], output_col: str = "score") -> DataFrame:
    """M6: probability of class 1 from a fitted pipeline."""
    scored = model.transform(df)
    out = scored.withColumn(output_col, vector_to_array(F.col("probability"))[1])
    drop = [c for c in scored.columns if c not in df.columns and c != output_col]
    return out.drop(*drop)


# --------------------------------------------------------------------------- #
# Artifacts (D15): PipelineModel + one metadata row
# --------------------------------------------------------------------------- #
REQUIRED_ARTIFACT_KEYS = ("threshold", "feature_columns", "categorical_features")


def save_artifact(model: PipelineModel, path: str, metadata: dict) -> None:
    missing = [k for k in REQUIRED_ARTIFACT_KEYS if k not in metadata]
    if missing:
        raise ValueError(f"The metadata of a model needs {missing}.")
    model.write().overwrite().save(f"{path}/model")
    from pyspark.sql import SparkSession

    session = SparkSession.getActiveSession()
    meta = dict(metadata)
    meta.setdefault("categorical_missing_value", CATEGORICAL_MISSING_TOKEN)
    session.createDataFrame([(json.dumps(meta),)], ["metadata"]).coalesce(1).write.mode("overwrite").json(
        f"{path}/metadata"
    )


def load_artifact(path: str) -> tuple[PipelineModel, dict]:
    from pyspark.sql import SparkSession

    session = SparkSession.getActiveSession()
    meta = json.loads(session.read.json(f"{path}/metadata").first()["metadata"])
    missing = [k for k in REQUIRED_ARTIFACT_KEYS if k not in meta]
    if missing:
        raise ValueError(f"The metadata of a model needs {missing}.")
    return PipelineModel.load(f"{path}/model"), meta


# --------------------------------------------------------------------------- #
# Candidate selection by a lexicographic key
# --------------------------------------------------------------------------- #
def select_candidate(results: DataFrame, keys: Sequence[str], index_col: str = "candidate") -> DataFrame:
    """Best row by ``keys`` descending; the first candidate wins ties."""
    order = F.struct(*[F.col(k) for k in keys], F.negative(F.col(index_col)).alias("_neg"))
    best = results.agg(F.max(order).alias("_b")).select(F.negative(F.col("_b._neg")).alias(index_col))
    return results.join(best, index_col, "inner")


def weight_candidates(train: DataFrame, label_col: str) -> list[tuple[str, float]]:
    """(name, weight of the positive class) of the candidates; one count of both classes."""
    n = train.agg(F.count_if(F.col(label_col) == 1).alias("pos"), F.count_if(F.col(label_col) == 0).alias("neg")).first()
    if not n["pos"]:
        raise ValueError("No positive row to learn from.")
    root = math.sqrt(n["neg"] / n["pos"])
    return [(name, root if weight is None else weight) for name, weight in WEIGHT_CANDIDATES]


def search_positive_weight(
    train: DataFrame,
    validation: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label_col: str,
    kind: str = "gbt",
    minimum_recall: float = MINIMUM_RECALL,
    **params,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """A model per weight of the positive class; (best model, its row, all rows).

    Each candidate's threshold is chosen on the validation rows; the best has the
    highest precision there, then the highest average precision, then comes first.
    """
    from cellcast.operators.ranking import binary_metrics, choose_threshold, score_levels

    models, records = {}, []
    for i, (name, weight) in enumerate(weight_candidates(train, label_col)):
        weighted = train.withColumn("_weight", F.when(F.col(label_col) == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))
        models[i] = fit_model(weighted, numeric, categorical, label_col, kind, balanced=False, weight_col="_weight", **params)
        scored = cut_lineage(score(models[i], validation, categorical).select(label_col, "score"), "candidate")
        chosen = choose_threshold(score_levels(scored, label_col, "score"), "score", minimum_recall=minimum_recall).first()
        row = binary_metrics(scored, label_col, "score", chosen["threshold"])
        records.append(
            row.select(
                F.lit(i).alias("candidate"),
                F.lit(name).alias("weight_name"),
                F.lit(float(weight)).alias("positive_weight"),
                F.lit(float(chosen["threshold"])).alias("threshold"),
                *row.columns,
            )
        )
    results = records[0]
    for r in records[1:]:
        results = results.unionByName(r)
    results = cut_lineage(results, "candidates")  # a row per candidate
    best = select_candidate(results, ["precision", "pr_auc"])
    return models[best.first()["candidate"]], best, results


def finite_or_null(x: float | None) -> float | None:
    return x if x is not None and math.isfinite(x) else None


# --------------------------------------------------------------------------- #
# M7: several models on one table -> per-day percentile ranks -> weighted blend
# --------------------------------------------------------------------------- #
def blended_daily_ranks(
    df: DataFrame,
    models: dict[str, tuple[PipelineModel, Sequence[str]]],
    weights: dict[str, float],
    date_col: str = "date",
    output_col: str = "blended_score",
) -> DataFrame:
    """Score every model on the same rows, turn each score into a
    within-day average percentile (W8), and blend them (F22)."""
    from cellcast.operators.ranking import average_percentile, blend, score_bounds_many

    scored = df
    for name, (model, categorical) in models.items():
        scored = score(model, scored, categorical, f"_score_{name}")
    # Written once: every rank reads it, and nothing has to be released afterwards.
    scored = cut_lineage(scored, "scored")
    bounds = score_bounds_many(scored, [f"_score_{n}" for n in models])
    for name in models:
        scored = average_percentile(scored, [date_col], f"_score_{name}", f"rank_{name}", bounds[f"_score_{name}"])
    names = list(weights)
    return scored.withColumn(output_col, blend([f"rank_{n}" for n in names], [weights[n] for n in names]))
