"""Default-probability models: preparation, training, scoring and selection."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel
from pyspark.util import inheritable_thread_target

from lendscope import fixed_values as fx
from lendscope.operators import attribution, cleaning, evaluation, loss, oversampling, sampling
from lendscope.operators.forest_scores import forest_probability
from lendscope.operators.shared_storage import cut_lineage, ensure_checkpoint_dir, spread
from lendscope.operators.tree_attribution import tree_attributions, tree_explainer
from lendscope.plans.ensembles import first_trees
from lendscope.sources import sinks

LABEL = "label"
WEIGHT = "class_weight"
VECTOR = "features"
BOOSTING_ROUNDS = 500
PATIENCE = 30
FIRST_ROUNDS = PATIENCE + 10
ROUND_ROWS = 10_000
CHECKPOINT_ROUNDS = 25
MODELS = ("Logistic Regression", "Random Forest", "Gradient Boosting", "Balanced Gradient Boosting")


@dataclass
class TrainingData:
    """Scaled frames (id, features, label); train also holds the synthetic rows and weights."""

    train: DataFrame
    validation: DataFrame
    test: DataFrame
    features: list[str]
    scaler: sampling.Scaler
    train_rows: int
    medians: dict[str, float]


@dataclass
class Trained:
    name: str
    model: PipelineModel
    seconds: float
    rounds: int | None = None

    @property
    def classifier(self):
        return self.model.stages[-1]


def prepare(table: DataFrame, target: str, id_column: str = "loan_id", balance: bool = True,
            fill_from_train: bool = False) -> TrainingData:
    """C10, C11, P1, P3, P4 and P5.

    Medians come from all rows unless ``fill_from_train`` limits them to the training split.
    The prepared frames are written once to the shared folder: training reads them many times.
    """
    labelled = cleaning.drop_null_target(table, target)
    if fill_from_train:
        split = sampling.stratified_split(labelled, target, id_column)
        names = [c for c in cleaning.feature_columns(labelled, target) if c != id_column]
        train_only = split.filter(F.col("split") == "train").select(
            *[cleaning.finite(F.col(f"`{c}`").cast("double")).alias(c) for c in names])
        fill = cleaning.median_values(train_only, names)
    else:
        names = [c for c in cleaning.feature_columns(labelled, target) if c != id_column]
        fill = cleaning.median_values(
            labelled.select(*[cleaning.finite(F.col(f"`{c}`").cast("double")).alias(c) for c in names]), names)
    matrix = cleaning.feature_matrix(labelled, target, id_column, fill)
    features = [c for c in matrix.columns if c not in (id_column, target)]
    parts = cut_lineage(sampling.stratified_split(matrix, target, id_column).withColumnRenamed(target, LABEL))
    train_rows = parts.filter(F.col("split") == "train")
    scaler = sampling.fit_scaler(train_rows, features)
    scaled = sampling.scale(parts, scaler)
    train = scaled.filter(F.col("split") == "train")
    if balance:
        train = oversampling.balance_classes(train, features, LABEL, id_column)
    written = cut_lineage(train)
    train = sampling.add_class_weight(written, LABEL, WEIGHT)
    held = {s: scaled.filter(F.col("split") == s).drop("split") for s in ("validation", "test")}
    return TrainingData(spread(train), held["validation"], held["test"], features, scaler, written.count(), fill)


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR)


def logistic_regression(rows: int) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=VECTOR, labelCol=LABEL, weightCol=WEIGHT, maxIter=1000, regParam=1.0 / max(rows, 1),
        elasticNetParam=0.0, standardization=False,
    )


def random_forest() -> RandomForestClassifier:
    """The node a row has reached in each tree is kept from level to level, so no level walks the trees from the root again."""
    return RandomForestClassifier(
        featuresCol=VECTOR, labelCol=LABEL, weightCol=WEIGHT, numTrees=200, maxDepth=10, minInstancesPerNode=50,
        featureSubsetStrategy="sqrt", seed=fx.SEED, maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=-1,
    )


def boosted_trees(rounds: int, weighted: bool) -> GBTClassifier:
    model = GBTClassifier(
        featuresCol=VECTOR, labelCol=LABEL, maxIter=rounds, maxDepth=6, stepSize=0.05, subsamplingRate=0.8,
        featureSubsetStrategy="0.8", seed=fx.SEED, maxMemoryInMB=512, checkpointInterval=CHECKPOINT_ROUNDS,
    )
    return model.setWeightCol(WEIGHT) if weighted else model


def patient_rounds(losses: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """Rounds up to the best loss, and whether ``patience`` rounds without gain followed it."""
    best = 0
    for i, value in enumerate(losses):
        if value < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_boosted(data: TrainingData, weighted: bool, rounds: int = BOOSTING_ROUNDS, patience: int = PATIENCE,
                first_rounds: int = FIRST_ROUNDS) -> tuple[PipelineModel, int]:
    """Boosting with early stopping on the validation loss.

    One fit gives the losses of all its rounds in one pass, and the ensemble is cut to its best length through its
    stored trees, so nothing is fitted at that length again. Only if the loss still improves at the end of a fit, a fit of
    twice the rounds takes its place.
    """
    ensure_checkpoint_dir(data.train.sparkSession)
    assembler = _assembler(data.features)
    # A round runs several small jobs one after the other, so partitions with little work only add tasks.
    tasks = max(1, data.train_rows // ROUND_ROWS)
    train = assembler.transform(data.train).select(VECTOR, LABEL, WEIGHT).coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    held_out = assembler.transform(data.validation).select(VECTOR, LABEL, F.lit(1.0).alias(WEIGHT)).coalesce(tasks)
    validation = held_out.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        length = min(first_rounds, rounds)
        while True:
            model = boosted_trees(length, weighted).fit(train)
            best, stopped = patient_rounds(model.evaluateEachIteration(validation), patience)
            if stopped or length >= rounds:
                break
            length = min(rounds, 2 * length)
        return PipelineModel([assembler, first_trees(train.sparkSession, model, best)]), best
    finally:
        train.unpersist()
        validation.unpersist()


def train_model(name: str, data: TrainingData, rounds: int = BOOSTING_ROUNDS) -> Trained:
    start = time.time()
    if name in ("Gradient Boosting", "Balanced Gradient Boosting"):
        model, used = fit_boosted(data, weighted=name.startswith("Balanced"), rounds=rounds)
        return Trained(name, model, time.time() - start, used)
    if name == "Logistic Regression":
        estimator = logistic_regression(data.train_rows)
    elif name == "Random Forest":
        estimator = random_forest()
    else:
        raise ValueError(f"unknown model: {name}")
    model = Pipeline(stages=[_assembler(data.features), estimator]).fit(data.train)
    return Trained(name, model, time.time() - start)


def side_by_side(spark: SparkSession, fit: Callable[[str], Trained], names: Sequence[str]) -> dict[str, Trained]:
    """``fit`` of each name; the forest alone, as it fills all cores and most memory, the others at the same time.

    Boosting and regression run many short jobs, between which cores wait. Each model's seconds hold the time it waited for others.
    """
    fitted = {name: fit(name) for name in names if name == "Random Forest"}
    rest = [name for name in names if name not in fitted]
    with ThreadPoolExecutor(max(1, len(rest))) as pool:
        pending = {name: pool.submit(inheritable_thread_target(spark)(fit), name) for name in rest}
        fitted |= {name: future.result() for name, future in pending.items()}
    return {name: fitted[name] for name in names}


def train_all(data: TrainingData, names: Sequence[str] = MODELS, rounds: int = BOOSTING_ROUNDS) -> dict[str, Trained]:
    return side_by_side(data.train.sparkSession, lambda name: train_model(name, data, rounds), names)


def scoring_pipeline(trained: Trained, data: TrainingData) -> PipelineModel:
    """One pipeline from raw features to scores: medians for gaps, scaling, vector, model.

    Feature names, medians and scales are part of it, so a reloaded one needs nothing else.
    """
    def number(x: float) -> str:
        return f"{float(x)!r}D"

    def scaled(c: str) -> str:
        value = f"CAST(`{c}` AS DOUBLE)"
        held = f"CASE WHEN NOT isnan({value}) AND abs({value}) < CAST('Infinity' AS DOUBLE) THEN {value} END"
        filled = f"coalesce({held}, {number(data.medians[c])})" if c in data.medians else held
        return f"({filled} - {number(data.scaler.means[c])}) / {number(data.scaler.deviations[c])} AS `scaled_{c}`"

    projection = SQLTransformer(statement=f"SELECT *, {', '.join(map(scaled, data.features))} FROM __THIS__")
    assembler = _assembler([f"scaled_{c}" for c in data.features])
    return PipelineModel([projection, assembler, trained.classifier])


def score(model: PipelineModel, df: DataFrame, output: str = "score") -> DataFrame:
    """P(class 1) and the class at 0.5 (M6); a forest of two classes votes on batches of rows."""
    last = model.stages[-1]
    if isinstance(last, RandomForestClassificationModel) and last.numClasses == 2:
        vectors = PipelineModel(model.stages[:-1]).transform(df)
        scored = vectors.withColumn(output, forest_probability(df.sparkSession, last, vector_to_array(last.getFeaturesCol())))
    else:
        scored = model.transform(df).withColumn(output, vector_to_array("probability")[1])
    predicted = (F.col(output) > evaluation.THRESHOLD).cast("int")
    return scored.withColumn("predicted", predicted).drop(VECTOR, "rawPrediction", "probability", "prediction")


def score_all(trained: Mapping[str, Trained], df: DataFrame, id_column: str = "loan_id") -> DataFrame:
    """Long (model, id, label, score) over all models."""
    frames = [
        score(t.model, df).select(F.lit(t.name).alias("model"), id_column, LABEL, "score") for t in trained.values()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def compare_models(trained: Mapping[str, Trained], df: DataFrame, id_column: str = "loan_id") -> DataFrame:
    """One row per model with all metrics and the training time; every row is scored once."""
    metrics = evaluation.model_comparison(cut_lineage(score_all(trained, df, id_column)))
    seconds = F.create_map(*[F.lit(x) for t in trained.values() for x in (t.name, t.seconds)])
    return metrics.withColumn("train_time_sec", F.round(seconds[F.col("model")], 2))


def explain(trained: Trained, data: TrainingData, rows: int | None = None, id_column: str = "loan_id") -> DataFrame:
    """Long attributions of the test rows, or of ``rows`` of them: closed form for linear models, else trees."""
    sample = spread(sampling.hash_sample(data.test, rows, id_column) if rows else data.test)
    if trained.name == "Logistic Regression":
        weights = dict(zip(data.features, map(float, trained.classifier.coefficients), strict=True))
        return attribution.linear_attributions(sample, weights, id_column)
    explainer = tree_explainer(sample.sparkSession, trained.classifier, data.features)
    return tree_attributions(sample, explainer, id_column)


@dataclass
class TrainingRun:
    data: TrainingData
    trained: dict[str, Trained]
    metrics: DataFrame
    best: Trained
    model_path: str | None = None


def training_run(table: DataFrame, target: str, id_column: str = "loan_id", model_path: str | None = None,
                 names: Sequence[str] = MODELS, rounds: int = BOOSTING_ROUNDS) -> TrainingRun:
    """Prepare, train, evaluate on the test split, pick by AUC and optionally persist (M8)."""
    data = prepare(table, target, id_column)
    trained = train_all(data, names, rounds)
    metrics = cut_lineage(compare_models(trained, data.test, id_column))
    best = trained[evaluation.best_model(metrics).first()["model"]]
    if model_path:
        sinks.save_model(scoring_pipeline(best, data), model_path)
    return TrainingRun(data, trained, metrics, best, model_path)


def portfolio_losses(run: TrainingRun, lgd: float = fx.LGD, ead: float | str = fx.FIXED_EAD, id_column: str = "loan_id") -> DataFrame:
    """Loan-level expected losses of the test split under the best model; every row is scored once."""
    scores = score(run.best.model, run.data.test).withColumnRenamed("score", "pd_predicted")
    kept = [id_column, LABEL, "pd_predicted", *([ead] if isinstance(ead, str) else [])]
    return loss.grade_loans(loss.expected_loss(cut_lineage(scores.select(*kept)), lgd=lgd, ead=ead))
