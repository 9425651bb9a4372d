"""Price regression with Spark ML: frame, split, features, three models, scores."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestay.functions.numeric import rounded
from lodestay.operators.forest import Forest, grow_forest
from lodestay.operators.ordering import exact_quantiles
from lodestay.operators.summaries import at_or_below_quantile
from lodestay.session import durable, written

SEED = 42
TEST_PERCENT = 20
MINIMUM_CATEGORY_ROWS = 10
MISSING_CATEGORY = "Missing"
RARE_CATEGORY = "__rare__"
NORMAL_EQUATIONS = 4096  # features up to which Spark solves them
SCORED_VALUES = 1 << 17  # of the rows that walk down a tree together
SCORED_WIDTH = 1024  # features of the vectors that are sent to Python in batches
SCORED_NODES = 1 << 17  # of a forest that is sent to all tasks; a larger one scores where its trees are
ALL_ROWS = sys.maxsize
LOOKUP_BYTES = 8 << 20  # of a category table that is sent to all tasks

# The default target, features and the columns that would leak the target.
TARGET = "price_best_available"
CATEGORICAL = (
    "neighbourhood", "room_type", "detailed_property_type", "host_is_superhost", "host_identity_verified",
    "host_portfolio_segment",
)
NUMERICAL = (
    "latitude", "longitude", "accommodates", "bathrooms", "bedrooms", "beds", "minimum_nights", "maximum_nights",
    "availability_365", "number_of_reviews", "reviews_per_month", "number_of_reviews_ltm", "review_scores_rating",
    "calculated_host_listings_count", "detailed_review_count", "review_events_per_active_year",
    "unavailability_rate_proxy",
)
LEAKAGE = frozenset({
    "price_raw", "price", "detailed_price", "detailed_price_raw", "price_best_available", "price_source",
    "price_per_bedroom", "price_per_guest",
})
DUMMY, RIDGE, FOREST = "Dummy Regressor", "Ridge Regression", "Random Forest Regressor"


@dataclass(frozen=True)
class ModelSpec:
    key: str = "id"
    target: str = TARGET
    numerical: Sequence[str] = NUMERICAL
    categorical: Sequence[str] = CATEGORICAL
    leakage: frozenset = LEAKAGE
    alpha: float = 1.0
    trees: int = 200
    depth: int = 18
    minimum_leaf: int = 3
    max_bins: int = 64  # values a continuous feature is cut into by the forest
    forest_rows: int = ALL_ROWS  # labelled rows the forest is grown on: all, unless a caller wants a sample by key hash
    histogram_mb: int = 512  # node statistics a task gathers in one pass of the forest
    ridge_iterations: int = 1000  # of the iterative solver; an error if it has not converged by then
    ridge_tolerance: float = 1e-10
    max_encoded_categories: int = 10_000  # one-hot columns; more are an error, as their labels live on the driver
    hashed_buckets: int | None = None  # instead of one-hot columns: so many signed hash buckets a categorical column
    seed: int = SEED


def modelling_frame(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Key, features and a positive target; a missing target is dropped, never filled in."""
    features = [*spec.categorical, *spec.numerical]
    missing = sorted(({*features, spec.target, spec.key}) - set(df.columns))
    if missing:
        raise ValueError(f"required modelling columns are missing: {missing}")
    leaking = sorted(set(features) & spec.leakage)
    if leaking:
        raise ValueError(f"target leakage in the feature list: {leaking}")
    frame = df.select(
        F.col(spec.key),
        *[F.col(c).cast("string").alias(c) for c in spec.categorical],
        *[F.col(c).cast("double").alias(c) for c in spec.numerical],
        F.col(spec.target).cast("double").alias(spec.target),
    )
    return frame.where(F.col(spec.target) > 0)


def split_bucket(key: str, seed: int = SEED) -> Column:
    """0..99 from the key alone, so the split survives any repartitioning or retry."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def with_split(df: DataFrame, key: str, seed: int = SEED, test_percent: int = TEST_PERCENT) -> DataFrame:
    return df.withColumn("is_test", split_bucket(key, seed) < test_percent)


def category_counts(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, category, rows) over the training rows, in one scan."""
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c), F.lit(MISSING_CATEGORY)).alias("category"))
        for c in columns
    ]
    long = train.select(F.explode(F.array(*pairs)).alias("p")).select("p.feature", "p.category")
    return long.groupBy("feature", "category").agg(F.count(F.lit(1)).alias("train_rows"))


def rare_category_map(train: DataFrame, columns: Sequence[str], minimum: int = MINIMUM_CATEGORY_ROWS) -> DataFrame:
    """What each training category is encoded as."""
    counts = category_counts(train, columns)
    encoded = F.when(F.col("train_rows") < minimum, RARE_CATEGORY).otherwise(F.col("category"))
    return counts.withColumn("encoded_as", encoded)


@dataclass
class FittedFeatures:
    """Everything learnt from the training rows."""

    spec: ModelSpec
    medians: dict
    means: dict
    deviations: dict
    categories: DataFrame | None  # None with hashed buckets, which need no table
    encoder: PipelineModel | None = None
    small: bool = False  # the category table has been measured and is at most LOOKUP_BYTES
    names: list = field(default_factory=list)

    def prepare(self, df: DataFrame) -> DataFrame:
        """Impute, standardise and encode: unseen categories become a label of their own, or every category a sign."""
        spec = self.spec
        df = self.standardised(df)
        if spec.hashed_buckets:
            return df.withColumns({f"__hot_{c}": signed_buckets(c, spec.hashed_buckets) for c in spec.categorical})
        for c in spec.categorical:
            side = self.categories.where(F.col("feature") == c).select(
                F.col("category").alias(f"__cat_{c}"), F.col("encoded_as").alias(f"__enc_{c}")
            )
            if self.small:  # its plan shows no size, and a shuffle of all rows by few categories would be uneven
                side = F.broadcast(side)
            df = df.join(side, F.col(c) == F.col(f"__cat_{c}"), "left").drop(f"__cat_{c}")
        return df.withColumns({f"__enc_{c}": F.coalesce(f"__enc_{c}", F.lit("__unseen__")) for c in spec.categorical})

    def standardised(self, df: DataFrame) -> DataFrame:
        """Impute and standardise the numbers, fill in missing categories."""
        spec, out = self.spec, {}
        for c in spec.numerical:
            filled = F.coalesce(F.col(c), F.lit(self.medians[c]))
            out[c] = (filled - F.lit(self.means[c])) / F.lit(self.deviations[c] or 1.0)
        for c in spec.categorical:
            out[c] = F.coalesce(F.col(c), F.lit(MISSING_CATEGORY))
        return df.withColumns(out)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.encoder.transform(self.prepare(df))


def fit_features(train: DataFrame, spec: ModelSpec) -> FittedFeatures:
    """Exact medians, then mean and population deviation of the filled columns, category table, encoder."""
    numeric = list(spec.numerical)
    medians = exact_quantiles(train, [], {c: (c, 0.5) for c in numeric}).first().asDict()
    medians = {c: 0.0 if v is None else v for c, v in medians.items()}
    filled = {c: F.coalesce(F.col(c), F.lit(medians[c])) for c in numeric}
    stats = train.agg(
        *[F.avg(filled[c]).alias(f"m_{c}") for c in numeric], *[F.stddev_pop(filled[c]).alias(f"s_{c}") for c in numeric]
    ).first()
    means, deviations = {c: stats[f"m_{c}"] for c in numeric}, {c: stats[f"s_{c}"] for c in numeric}
    if spec.hashed_buckets:
        fitted = FittedFeatures(spec, medians, means, deviations, None)
        return _hashed(fitted, train)
    categories = durable(rare_category_map(train, spec.categorical))
    row_bytes = F.octet_length("feature") + F.octet_length("category") + F.octet_length("encoded_as") + 64
    size = categories.agg(F.sum(row_bytes).alias("n")).first().n or 0
    fitted = FittedFeatures(spec, medians, means, deviations, categories, small=size <= LOOKUP_BYTES)
    kept = categories.select("feature", "encoded_as").distinct()
    encoded = kept.count()
    if encoded > spec.max_encoded_categories:
        raise ValueError(
            f"{encoded} categories with {MINIMUM_CATEGORY_ROWS} rows or more; one-hot encoding takes up to "
            f"{spec.max_encoded_categories} (ModelSpec.max_encoded_categories); ModelSpec.hashed_buckets takes any number")
    indexer = StringIndexer(
        inputCols=[f"__enc_{c}" for c in spec.categorical],
        outputCols=[f"__idx_{c}" for c in spec.categorical],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    ).fit(kept.select(*[F.when(F.col("feature") == c, F.col("encoded_as")).alias(f"__enc_{c}") for c in spec.categorical]))
    # The last slot is the one kept for unseen values: dropping it encodes them as all zeros.
    onehot = OneHotEncoder(
        inputCols=[f"__idx_{c}" for c in spec.categorical],
        outputCols=[f"__hot_{c}" for c in spec.categorical],
        dropLast=True,
    )
    assembler = VectorAssembler(inputCols=[*numeric, *[f"__hot_{c}" for c in spec.categorical]], outputCol="features")
    fitted.encoder = Pipeline(stages=[indexer, onehot, assembler]).fit(fitted.prepare(train))
    labels = fitted.encoder.stages[0].labelsArray
    fitted.names = numeric + [f"{c}_{v}" for c, values in zip(spec.categorical, labels) for v in values]
    return fitted


def signed_buckets(column: str, n: int) -> Column:
    """A vector with 1 or -1 in the bucket of the value's hash. The sign is another hash, so that categories that share
    a bucket cancel out on average."""
    bucket = f"pmod(xxhash64('{column}', `{column}`), {n})"
    sign = f"CASE WHEN xxhash64('sign of {column}', `{column}`) % 2 = 0 THEN 1D ELSE -1D END"
    return array_to_vector(F.expr(f"transform(sequence(0, {n - 1}), k -> CASE WHEN k = {bucket} THEN {sign} ELSE 0D END)"))


def _hashed(fitted: FittedFeatures, train: DataFrame) -> FittedFeatures:
    """Signed hash buckets for each categorical column, whatever the number of its categories.

    Nothing is learnt and no label reaches the driver. Rare categories are not
    set apart, an unseen one has the bucket and sign of its hash. A bucket is
    named after its source column, so importance is had per bucket and column.
    """
    spec, stages = fitted.spec, []
    for c in spec.categorical:
        stages.append(VectorSizeHint(inputCol=f"__hot_{c}", size=spec.hashed_buckets, handleInvalid="optimistic"))
    numeric = list(spec.numerical)
    stages.append(VectorAssembler(inputCols=[*numeric, *[f"__hot_{c}" for c in spec.categorical]], outputCol="features"))
    fitted.encoder = Pipeline(stages=stages).fit(fitted.prepare(train))
    fitted.names = numeric + [f"{c}_bucket_{k}" for c in spec.categorical for k in range(spec.hashed_buckets)]
    return fitted


def fit_ridge(train: DataFrame, spec: ModelSpec) -> object:
    """Least squares + alpha * |w|^2 on ``features`` -> ``label``, by the same iterative solver at every size.

    Spark minimises the mean squared error on a label scaled by its sample
    standard deviation, so the same penalty is alpha / n times that deviation.
    """
    row = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("label").alias("s")).first()
    model = LinearRegression(
        featuresCol="features", labelCol="label", elasticNetParam=0.0, solver="l-bfgs",
        maxIter=spec.ridge_iterations, tol=spec.ridge_tolerance, regParam=spec.alpha / row.n * (row.s or 1.0),
        standardization=False,
    ).fit(train)
    if model.summary.totalIterations >= spec.ridge_iterations:  # Spark counts up to the bound, never beyond
        raise RuntimeError("ridge regression has not converged (ModelSpec.ridge_iterations)")
    return model


def solve_ridge(train: DataFrame, spec: ModelSpec, size: int) -> object:
    """The model of ``fit_ridge`` from the normal equations of the ``size`` features, in one pass over the rows.

    The iterative solver passes over all rows hundreds of times. It is left to more features than Spark solves
    directly. Here the label is scaled by its population deviation.
    """
    if size > NORMAL_EQUATIONS:
        return fit_ridge(train, spec)
    row = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("s")).first()
    return LinearRegression(
        featuresCol="features", labelCol="label", elasticNetParam=0.0, solver="normal",
        regParam=spec.alpha / row.n * (row.s or 1.0), standardization=False,
    ).fit(train)


def sample_order(spec: ModelSpec) -> Column:
    return F.xxhash64(F.lit(spec.seed), F.col(spec.key).cast("string"))


def forest_sample(train: DataFrame, spec: ModelSpec) -> DataFrame:
    """All training rows, or the ``forest_rows`` with the smallest key hashes: the same whatever the partitions."""
    if spec.forest_rows >= ALL_ROWS:
        return train
    return train.orderBy(sample_order(spec), F.col(spec.key)).limit(spec.forest_rows)


def around_sample(train: DataFrame, spec: ModelSpec) -> DataFrame:
    """The rows of ``forest_sample`` and any others with the hash of its last one. That hash is found from the keys, and
    the rows by a filter, so that no vectors need to be made of the rest."""
    if spec.forest_rows >= ALL_ROWS:
        return train
    last = forest_sample(train.select(spec.key), spec).agg(F.max(sample_order(spec)).alias("hash")).first().hash
    return train if last is None else train.where(sample_order(spec) <= last)


def fit_forest(train: DataFrame, spec: ModelSpec) -> Forest:
    """A forest on ``forest_sample``, which is all rows by default, with cuts from the values of all these rows."""
    rows = forest_sample(train, spec)
    return grow_forest(
        rows, sample_order(spec), spec.trees, spec.depth, spec.minimum_leaf, spec.max_bins, spec.histogram_mb)


_NODE = re.compile(r"(?:If \(feature (\d+) (?:<= (\S+)|in \{([^}]*)\})\)|Predict: (\S+))$")


def listed_tree(text: str) -> tuple[np.ndarray, ...] | None:
    """The nodes of ``toDebugString``: feature, cut, two children each, value. Features at or below the cut go to the
    first child, a leaf's children are itself. None if a split is neither at a value nor of 0 and 1."""
    feature, cut, child, value, above = [], [], [], [], []
    for line in map(str.strip, text.splitlines()[1:]):
        if not line or line.startswith("Else"):
            continue
        found = _NODE.match(line)
        if not found or found[3] not in (None, "0.0", "1.0"):
            return None
        column, bound, inside, predicted = found.groups()
        at = len(feature)
        if above:  # the nodes come depth first
            child[above.pop()] = at
        if predicted is not None:
            node = (0, np.inf, (at, at), float(predicted))
        else:
            node = (int(column), float(bound or 0.5), (-1, -1), 0.0)
            above += [2 * at, 2 * at + 1] if inside == "1.0" else [2 * at + 1, 2 * at]
        feature.append(node[0])
        cut.append(node[1])
        child.extend(node[2])
        value.append(node[3])
    return np.array(feature), np.array(cut), np.array(child), np.array(value)


def forest_scores(forest) -> Callable[[Column], Column] | None:
    """The prediction of a small forest as a function of a feature vector, the same doubles as its own.

    A batch of rows walks down one tree at a time. None if the forest is large, has splits that ``listed_tree`` does not
    hold, or so many features that a batch of dense vectors is large.
    """
    if forest.nodes > SCORED_NODES:
        return None
    trees, width = [listed_tree(t.toDebugString) for t in forest.trees], forest.numFeatures
    if width > SCORED_WIDTH or any(t is None for t in trees):
        return None

    def walked(tree, flat, starts):
        feature, cut, child, value = tree
        at, then = None, np.zeros(len(starts), np.int64)
        while at is None or not np.array_equal(at, then):
            at = then
            then = child[2 * at + np.logical_not(flat[starts + feature[at]] <= cut[at])]
        return value[at]

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        step = max(1, SCORED_VALUES // width)
        for vectors in parts:
            out = np.zeros(len(vectors))
            for i in range(0, len(vectors), step):
                flat = np.concatenate(vectors.iloc[i:i + step].tolist())
                starts = np.arange(0, len(flat), width)
                for tree in trees:
                    out[i:i + step] += walked(tree, flat, starts)
            yield pd.Series(out / len(trees))

    return lambda features: scored(vector_to_array(features))


def original_scale(c: str) -> Column:
    """Back from log1p, never negative."""
    return F.greatest(F.expm1(F.col(c)), F.lit(0.0))


def prediction_column(model: str) -> str:
    return model.lower().replace(" ", "_") + "_prediction"


@dataclass
class PriceExperiment:
    predictions: DataFrame
    results: DataFrame
    importance: DataFrame
    features: FittedFeatures
    ridge: object
    forest: object
    held: Sequence[DataFrame] = ()

    def close(self) -> None:
        """Release what was kept for fitting; the result tables are computed anew if read later."""
        for df in self.held:
            df.unpersist()


@dataclass
class Prepared:
    """Split rows, what was learnt from the training rows, and these as vectors (made as they are read)."""

    frame: DataFrame
    test: DataFrame
    train: DataFrame
    features: FittedFeatures
    ready: DataFrame


def prepare_price_experiment(df: DataFrame, spec: ModelSpec) -> Prepared:
    frame = with_split(modelling_frame(df, spec), spec.key, spec.seed).withColumn("label", F.log1p(spec.target))
    frame = written(frame)  # read many times while fitting, a few columns at a time
    train, test = frame.where(~F.col("is_test")), frame.where("is_test")
    features = fit_features(train, spec)
    ready = features.transform(train).select(spec.key, "features", "label")
    return Prepared(frame, test, train, features, ready)


def run_price_experiment(df: DataFrame, spec: ModelSpec | None = None) -> PriceExperiment:
    """Split, fit the three models on log1p(target), score all test rows on the original scale.

    Medians, deviations, categories, the models and the baseline come from all training rows.
    """
    spec = spec or ModelSpec()
    p = prepare_price_experiment(df, spec)
    baseline = exact_quantiles(p.train, [], {"median": ("label", 0.5)}).first()
    ready = p.ready.persist()  # read by the solver, for its summary and by the forest
    ridge, forest = solve_ridge(ready, spec, len(p.features.names)), fit_forest(ready, spec)
    ready.unpersist()
    scored = ridge.setPredictionCol("__ridge").transform(p.features.transform(p.test))
    scored = scored.select(spec.key, spec.target, "features", "__ridge")
    scores = forest_scores(forest)
    scored = scored.withColumn("__forest", scores(F.col("features"))) if scores else forest.setPredictionCol("__forest").transform(scored)
    predictions = scored.select(
        spec.key,
        F.col(spec.target).alias("actual_price"),
        F.greatest(F.expm1(F.lit(baseline["median"])), F.lit(0.0)).alias(prediction_column(DUMMY)),
        original_scale("__ridge").alias(prediction_column(RIDGE)),
        original_scale("__forest").alias(prediction_column(FOREST)),
    )
    models = {m: prediction_column(m) for m in (DUMMY, RIDGE, FOREST)}
    return PriceExperiment(
        predictions,
        compare_models(predictions, "actual_price", models),
        feature_importance(df.sparkSession, p.features.names, forest),
        p.features, ridge, forest, [x for x in (p.frame, p.features.categories) if x is not None],
    )


def forest_importance(df: DataFrame, spec: ModelSpec | None = None) -> DataFrame:
    """The importance table alone, without the other models."""
    spec = spec or ModelSpec()
    p = prepare_price_experiment(df, spec)
    rows = p.features.transform(around_sample(p.train, spec)).select(spec.key, "features", "label").persist()
    forest = fit_forest(rows, spec)
    rows.unpersist()
    return feature_importance(df.sparkSession, p.features.names, forest)


def score(predictions: DataFrame, actual: str, predicted: str, model: str) -> DataFrame:
    """One row: MAE, RMSE (2 digits) and R2 (4 digits)."""
    a, e = F.col(actual), F.col(actual) - F.col(predicted)
    return predictions.agg(
        rounded(F.avg(F.abs(e)), 2).alias("mae_eur"),
        rounded(F.sqrt(F.avg(e * e)), 2).alias("rmse_eur"),
        rounded(1 - F.try_divide(F.avg(e * e), F.var_pop(a)), 4).alias("r2"),
    ).select(F.lit(model).alias("model"), "*")


def compare_models(predictions: DataFrame, actual: str, models: dict, baseline: str = DUMMY) -> DataFrame:
    """All models in one pass, best MAE first, with the improvement over the baseline in percent."""
    a = F.col(actual)
    aggs = [F.var_pop(a).alias("v")]
    for i, c in enumerate(models.values()):
        e = a - F.col(c)
        aggs += [F.avg(F.abs(e)).alias(f"mae{i}"), F.avg(e * e).alias(f"mse{i}")]
    base = list(models).index(baseline) if baseline in models else 0
    cells = [
        F.struct(
            F.lit(m).alias("model"),
            rounded(f"mae{i}", 2).alias("mae_eur"),
            rounded(F.sqrt(f"mse{i}"), 2).alias("rmse_eur"),
            rounded(1 - F.try_divide(F.col(f"mse{i}"), F.col("v")), 4).alias("r2"),
            rounded(F.try_divide(F.col(f"mae{base}") - F.col(f"mae{i}"), F.col(f"mae{base}")) * 100.0, 1)
            .alias("mae_improvement_pct"),
        )
        for i, m in enumerate(models)
    ]
    return predictions.agg(*aggs).select(F.inline(F.array(*cells))).orderBy("mae_eur", "model")


def feature_importance(spark, names: Sequence[str], forest) -> DataFrame:
    """(rank, feature, importance), most important first; one row per model feature."""
    values = [float(v) for v in forest.featureImportances.toArray()]
    if len(values) != len(names):
        raise ValueError("feature names and importances differ in number")
    rows = spark.createDataFrame(list(zip(names, values)), "feature string, importance double")
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), F.asc("feature"))
    return rows.select(F.row_number().over(w).alias("rank"), "feature", "importance")


def diagnostic_rows(predictions: DataFrame, actual: str, p: float = 0.99) -> DataFrame:
    """Rows shown in the actual-vs-predicted check: at or below the p-quantile of the actual price."""
    return at_or_below_quantile(predictions, actual, p)
