"""Readmission models on MLlib: split, preprocessing, two classifiers, out-of-fold scores."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carepanel.functions.numeric import rounded
from carepanel.functions.quantiles import exact_quantiles
from carepanel.operators import boosting, curves
from carepanel.operators.drivers import LinearTerm
from carepanel.operators.encounter_features import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from carepanel.sources.scratch import ensure_checkpoint_dir, settled, settled_columns

# Run parameters.
SEED = 42
TEST_PARTS = 5
FOLDS = 5
KINDS = ["logreg", "gbm"]
DEFAULT_CHAMPION = "gbm"
BOOSTING = {"maxIter": 400, "maxDepth": 4, "stepSize": 0.05, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.9"}
LOGISTIC_ITERATIONS = 1000
#: Folds fitted at the same time from driver threads. Boosting runs thousands of short jobs in a row, whose cost is
#: mostly their start, so the folds of a run share the executors well.
FIT_THREADS = FOLDS
#: Training rows per partition. Every level of every boosted tree is a job over all partitions: small tables in
#: hundreds of partitions spend their time on starting tasks.
ROWS_PER_PART = 20_000
#: How the median fill stage writes a column's fill value; ``linear_terms`` reads the values back from it.
MEDIAN_FILL = re.compile(r"CAST\('([^']*)' AS DOUBLE\)\) AS `([^`]*)_n`")
WEIGHT, FEATURES = "row_weight", "features"


BUCKETS = 4096


def with_folds(rows: DataFrame, id_col: str, label: str, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """``fold`` for every row, stratified: per label the fold sizes differ by one at most.

    Rows of a label are dealt out in the order of a digest of id and seed, so the folds are the same on any
    cluster. No task ranks a whole label: the digest picks one of BUCKETS buckets, counts per label and bucket
    (a small table) give each bucket its offset, and rows are ranked inside their bucket only.
    """
    digest = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("bigint")
    dealt = rows.withColumn("_digest", digest).withColumn("_bucket", F.col("_digest") % BUCKETS)
    counts = dealt.groupBy(F.col(label).alias("_label"), F.col("_bucket").alias("_of")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_label").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_label", "_of", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(label, "_bucket").orderBy("_digest", id_col)
    ranked = dealt.withColumn("_rank", F.row_number().over(inside) - 1)
    joined = ranked.join(offsets, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_bucket") == F.col("_of")), "left")
    return joined.withColumn("fold", ((F.col("_offset") + F.col("_rank")) % folds).cast("int")).select(*rows.columns, "fold")


def with_split(features: DataFrame, id_col: str, label: str, seed: int = SEED) -> DataFrame:
    """``is_test`` for a stratified share of one in ``TEST_PARTS``."""
    return with_folds(features, id_col, label, TEST_PARTS, seed).withColumn("is_test", F.col("fold") == 0).drop("fold")


def positive_class_weight(rows: DataFrame, label: str) -> DataFrame:
    """Negatives per positive, 1.0 without positives."""
    positives = F.count_if(F.col(label) == 1)
    negatives = F.count_if(F.col(label) == 0)
    return rows.agg(
        F.coalesce(rounded(F.try_divide(negatives.cast("double"), positives), 4), F.lit(1.0)).alias("scale_pos_weight")
    )


def with_row_weights(train: DataFrame, label: str, kind: str) -> DataFrame:
    """Balanced weights for the logistic model, negatives-per-positive for the boosted trees."""
    sizes = train.agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("pos"))
    ).scalar()
    n, pos = sizes["n"].cast("double"), sizes["pos"].cast("double")
    is_pos = F.col(label) == 1
    if kind == "logreg":
        of_class = F.when(is_pos, pos).otherwise(n - pos)
        weight = F.coalesce(F.try_divide(n, 2 * of_class), F.lit(1.0))
    else:
        ratio = F.coalesce(rounded(F.try_divide(n - pos, pos), 4), F.lit(1.0))
        weight = F.when(is_pos, ratio).otherwise(1.0)
    return train.withColumn(WEIGHT, weight)


def _most_frequent(train: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent level per column (ties to the first in order); one row comes to the driver."""
    row = train.agg(*[F.mode(c, True).alias(c) for c in columns]).first()
    return {c: row[c] if row[c] is not None else "" for c in columns}


def preprocessing(train: DataFrame, numeric: list[str], categorical: list[str]) -> list:
    """Stages fit on training rows only: exact median fill and scaling, mode fill and one-hot.

    Medians come from distributed selection (``exact_quantiles``), not from a sketch; a column without any value in
    training is filled with 0. A level not seen in training gets an all-zero vector.
    """
    modes = _most_frequent(train, categorical)
    medians = exact_quantiles(train, numeric, [0.5]) if numeric else {}
    quoted = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    filled = ", ".join(f"coalesce(`{c}`, {quoted(modes[c])}) AS `{c}_f`" for c in categorical)
    numbers = ", ".join(f"coalesce(CAST(`{c}` AS DOUBLE), CAST('{(medians[c][0] or 0.0)!r}' AS DOUBLE)) AS `{c}_n`" for c in numeric)
    return [
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, {numbers} FROM __THIS__"),
        VectorAssembler(inputCols=[f"{c}_n" for c in numeric], outputCol="numbers"),
        StandardScaler(withMean=True, withStd=True, inputCol="numbers", outputCol="numbers_scaled"),
        StringIndexer(
            handleInvalid="keep", stringOrderType="alphabetAsc",
            inputCols=[f"{c}_f" for c in categorical], outputCols=[f"{c}_i" for c in categorical],
        ),
        OneHotEncoder(dropLast=True, inputCols=[f"{c}_i" for c in categorical], outputCols=[f"{c}_v" for c in categorical]),
        VectorAssembler(inputCols=["numbers_scaled", *[f"{c}_v" for c in categorical]], outputCol=FEATURES),
    ]


def estimator(kind: str, label: str, n_rows: int, **overrides):
    """The two model kinds. The logistic penalty equals an inverse strength of 1 summed over rows."""
    shared = {"labelCol": label, "featuresCol": FEATURES, "weightCol": WEIGHT}
    if kind == "logreg":
        options = {"maxIter": LOGISTIC_ITERATIONS, "regParam": 1.0 / max(n_rows, 1), "standardization": False}
        return LogisticRegression(**shared, **{**options, **overrides})
    if kind == "gbm":
        return GBTClassifier(**shared, seed=SEED, checkpointInterval=10, **{**BOOSTING, **overrides})
    raise ValueError(f"unknown model kind: {kind!r}")


def packed(rows: DataFrame, n: int, per_part: int = ROWS_PER_PART) -> DataFrame:
    """The same ``n`` rows in at most one partition per ``per_part`` of them, without a shuffle."""
    return rows.coalesce(max(1, -(-n // per_part)))


def fit_preprocessing(
    train: DataFrame, label: str, kind: str, numeric: list[str] = NUMERIC_FEATURES, categorical: list[str] = CATEGORICAL_FEATURES
) -> tuple[PipelineModel, DataFrame, int]:
    """The fitted stages before the classifier, the weighted rows in partitions by their number, and that number."""
    ensure_checkpoint_dir(train.sparkSession)
    n = train.count()
    weighted = packed(with_row_weights(train, label, kind), n)
    return Pipeline(stages=preprocessing(train, numeric, categorical)).fit(weighted), weighted, n


def fit(
    train: DataFrame, label: str, kind: str, numeric: list[str] = NUMERIC_FEATURES,
    categorical: list[str] = CATEGORICAL_FEATURES, **overrides,
) -> PipelineModel:
    """Fit preprocessing and classifier on the given rows.

    The classifier reads assembled vectors that are stored once, in partitions by their number of rows, so that its
    many jobs neither carry the plan of the cleaning nor start more tasks than the rows need.
    """
    prepared, weighted, n = fit_preprocessing(train, label, kind, numeric, categorical)
    vectors = settled(prepared.transform(weighted).select(FEATURES, label, WEIGHT))
    return PipelineModel([*prepared.stages, estimator(kind, label, n, **overrides).fit(vectors)])


def fit_boosted(
    trains: list[DataFrame], label: str, numeric: list[str] = NUMERIC_FEATURES, categorical: list[str] = CATEGORICAL_FEATURES,
    side_by_side: int = FIT_THREADS, **overrides,
) -> list[PipelineModel]:
    """As ``fit`` of kind gbm for each of ``trains``: preprocessing is fitted for each on its own rows, the trees of all
    are grown in lockstep (``boosting``)."""
    with ThreadPoolExecutor(max(1, side_by_side)) as pool:
        prepared = list(pool.map(lambda train: fit_preprocessing(train, label, "gbm", numeric, categorical), trains))

    def inputs(k: int) -> DataFrame:
        stages, weighted, _ = prepared[k]
        rows = stages.transform(weighted).withColumn("scaled", vector_to_array("numbers_scaled"))
        numbers = [F.col("scaled")[i].alias(f"x{i}") for i in range(len(numeric))]
        places = [F.col(f"{c}_i").cast("int").alias(f"c{i}") for i, c in enumerate(categorical)]
        return rows.select(F.lit(k).alias("of"), *numbers, *places, label, WEIGHT)

    levels = {k: [len(found) for found in stages.stages[4].labelsArray] for k, (stages, _, _) in enumerate(prepared)}
    specs = {k: estimator("gbm", label, n, **overrides) for k, (_, _, n) in enumerate(prepared)}
    table = settled_columns(reduce(DataFrame.unionByName, [inputs(k) for k in range(len(trains))]))
    boosted = boosting.fit_side_by_side(table, len(numeric), levels, specs, specs[0].getMaxBins())
    return [
        PipelineModel([*stages.stages, boosted[k]]) if k in boosted else fit(trains[k], label, "gbm", numeric, categorical, **overrides)
        for k, (stages, _, _) in enumerate(prepared)
    ]


def predict(model: PipelineModel, rows: DataFrame, keep: list[str]) -> DataFrame:
    scored = model.transform(rows.withColumn(WEIGHT, F.lit(1.0)))
    return scored.select(*keep, vector_to_array("probability")[1].alias("probability"))


def compare_models(
    features: DataFrame, id_col: str, label: str, options: dict[str, dict] | None = None
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit both kinds on the training part and measure them on the test part."""
    parts = settled(with_split(features, id_col, label))
    train, test = parts.where(~F.col("is_test")), parts.where("is_test")
    models, measured = {}, []
    for order, kind in enumerate(KINDS):
        models[kind] = fit(train, label, kind, **(options or {}).get(kind, {}))
        scored = predict(models[kind], test, [id_col, label])
        row = curves.evaluate(scored, label).withColumns({"model": F.lit(kind), "model_order": F.lit(order)})
        measured.append(row)
    return reduce(DataFrame.unionByName, measured), models


def out_of_fold(
    features: DataFrame, id_col: str, label: str, kind: str = DEFAULT_CHAMPION, folds: int = FOLDS, keep: tuple[str, ...] = (),
    side_by_side: int = FIT_THREADS, **overrides,
) -> DataFrame:
    """Every patient scored by a model that did not see that patient, with ``n_train``: the rows that model was
    trained on. ``keep`` names columns to carry along.

    The folded rows are stored once; the folds' models are fitted side by side from a bounded pool of driver threads
    (at most ``side_by_side`` Spark jobs at a time), each on its training rows of the one stored table.
    """
    folded = settled_columns(with_folds(features, id_col, label, folds))
    sizes = {r["fold"]: r["n"] for r in folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    trains = [folded.where(F.col("fold") != k) for k in range(folds)]
    if kind == "gbm" and boosting.fits_here(estimator(kind, label, total, **overrides)):
        models = fit_boosted(trains, label, side_by_side=side_by_side, **overrides)
    else:
        with ThreadPoolExecutor(max(1, side_by_side)) as pool:
            models = list(pool.map(lambda train: fit(train, label, kind, **overrides), trains))

    def scored_fold(k: int) -> DataFrame:
        rows = predict(models[k], folded.where(F.col("fold") == k), [id_col, label, "fold", *keep])
        return rows.withColumn("n_train", F.lit(total - sizes.get(k, 0)).cast("long"))

    return reduce(DataFrame.unionByName, [scored_fold(k) for k in range(folds)])


def linear_terms(model: PipelineModel, train: DataFrame, numeric: list[str] = NUMERIC_FEATURES) -> list[LinearTerm]:
    """The fitted logistic model as terms on the original feature columns.

    Scaling is folded into the weights; the centre of a level is its share in the training rows. Only
    coefficients and means (one number per level) come to the driver.
    """
    stages = model.stages
    fills = next(s for s in stages if "SQLTransformer" in type(s).__name__ and "AS DOUBLE)) AS" in s.getStatement())
    scaler = next(s for s in stages if "StandardScaler" in type(s).__name__)
    indexer = next(s for s in stages if "StringIndexer" in type(s).__name__)
    weights = stages[-1].coefficients.toArray()
    transformed = model.transform(train.withColumn(WEIGHT, F.lit(1.0)))
    means = transformed.agg(Summarizer.mean(F.col(FEATURES)).alias("m")).first()["m"].toArray()
    medians = {name: float(value) for value, name in MEDIAN_FILL.findall(fills.getStatement())}
    terms, slot = [], 0
    for i, name in enumerate(numeric):
        std = float(scaler.std[i]) or 1.0
        terms.append(
            LinearTerm(name, float(weights[slot]) / std, float(scaler.mean[i]), fill=float(medians[name]))
        )
        slot += 1
    for column, labels in zip(indexer.getInputCols(), indexer.labelsArray):
        for level in labels:
            terms.append(LinearTerm(column.removesuffix("_f"), float(weights[slot]), float(means[slot]), level=level))
            slot += 1
    return terms


def save_run(models: dict[str, PipelineModel], champion: str, metrics_document: DataFrame, root: str) -> None:
    """Persist the champion, the logistic model (for explanations) and the metrics document."""
    models[champion].write().overwrite().save(f"{root}/champion")
    models["logreg"].write().overwrite().save(f"{root}/logreg")
    metrics_document.write.mode("overwrite").text(f"{root}/metrics")


def saved_champion(spark, root: str) -> str:
    """Name of the champion in a stored metrics document, the default when there is none."""
    from carepanel.operators.bi_export import METRICS_SCHEMA
    from carepanel.sources.sinks import list_names

    if "metrics" not in list_names(spark, root):
        return DEFAULT_CHAMPION
    parsed = spark.read.text(f"{root}/metrics").select(F.from_json("value", METRICS_SCHEMA)["champion"].alias("c")).first()
    return parsed["c"] if parsed and parsed["c"] else DEFAULT_CHAMPION


def load_champion(root: str) -> PipelineModel:
    return PipelineModel.load(f"{root}/champion")
