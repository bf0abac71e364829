"""Three-class label model on Spark ML.

Everything stays distributed: feature preparation is a SQL stage of the
pipeline, categorical columns are indexed once at training time (codes are
saved with the model), the classifier is Spark ML's tree ensemble.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import IndexToString, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfeed.params import (BOOSTING_DEPTH, BOOSTING_ROUNDS, FILL_RANK, FOREST_DEPTH, FOREST_TREES, LABELS, LOSS_EVERY,
                              TRAIN_PARTITION_ROWS)
from trustfeed.session import materialize

LABEL_COL = "recommend"

NUMERIC_FEATURES = ["age", "mirrors", "collects", "comments", "upvotes", "downvotes",
                    "followship_rank", "followship_score", "max_age", "max_mirrors",
                    "max_collects", "max_comments", "post_score"]
BOOL_FEATURES = ["is_original", "is_content_warning", "custom_filters_gardener_flagged"]
CATEGORICAL_FEATURES = ["language", "region", "content_warning", "main_content_focus"]

# A boosted tree draws nothing from its partitions, and every level of every tree is a job over all of them: beyond this many
# they hold more rows each, up to so many.
BOOSTED_PARTITIONS = 32
BOOSTED_PARTITION_ROWS = 250_000

# Labels and the rank/score columns they were derived from; drop the latter
# (``leaky=False``) to measure a model that cannot read the rule back.
LEAKY_FEATURES = ["followship_rank", "followship_score", "post_score"]


def feature_columns(leaky: bool = True) -> tuple[list[str], list[str], list[str]]:
    num = [c for c in NUMERIC_FEATURES if leaky or c not in LEAKY_FEATURES]
    return num, list(BOOL_FEATURES), list(CATEGORICAL_FEATURES)


def _prep_statement(num: list[str], boo: list[str], cat: list[str]) -> str:
    """Sentinels for trees without missing-value branches: rank 1e10, other
    numbers -1, booleans 1/0/-1; a flag per numeric column marks the gap."""
    parts = []
    for c in num:
        fill = repr(FILL_RANK) if c == "followship_rank" else "-1"
        parts.append(f"CAST(coalesce({c}, {fill}) AS DOUBLE) AS f_{c}")
        parts.append(f"CAST({c} IS NULL AS DOUBLE) AS m_{c}")
    for c in boo:
        parts.append(f"CASE WHEN {c} THEN 1.0 WHEN NOT {c} THEN 0.0 ELSE -1.0 END AS f_{c}")
    for c in cat:
        parts.append(f"CAST({c} AS STRING) AS s_{c}")
    return "SELECT *, " + ", ".join(parts) + " FROM __THIS__"


def build_pipeline(classifier: str = "rf", leaky: bool = True, num_trees: int = FOREST_TREES,
                   max_depth: int | None = None, max_iter: int = BOOSTING_ROUNDS, seed: int = 1) -> tuple[Pipeline, list[str]]:
    num, boo, cat = feature_columns(leaky)
    prep = SQLTransformer(statement=_prep_statement(num, boo, cat))
    # Codes fitted once on the training data; unseen/NULL values -> extra code. One column per code: a tree's
    # bin limit then doesn't bound the number of categories.
    cat_idx = StringIndexer(inputCols=[f"s_{c}" for c in cat], outputCols=[f"i_{c}" for c in cat],
                            handleInvalid="keep", stringOrderType="alphabetAsc")
    one_hot = OneHotEncoder(inputCols=[f"i_{c}" for c in cat], outputCols=[f"o_{c}" for c in cat], dropLast=False)
    # Fixed feature order
    inputs = [f"f_{c}" for c in num] + [f"m_{c}" for c in num] + [f"f_{c}" for c in boo] + \
        [f"o_{c}" for c in cat]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    if classifier == "rf":
        clf = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=num_trees,
                                     maxDepth=max_depth or FOREST_DEPTH, seed=seed)
    elif classifier == "gbt":
        clf = OneVsRest(classifier=GBTClassifier(maxIter=max_iter, maxDepth=max_depth or BOOSTING_DEPTH, seed=seed),
                        labelCol="label", featuresCol="features", parallelism=len(LABELS))
    else:
        raise ValueError(classifier)
    return Pipeline(stages=[prep, cat_idx, one_hot, assembler, clf]), inputs


def label_indexer(label_col: str = LABEL_COL) -> StringIndexer:
    """MAYBE, NO, YES -> 0, 1, 2 (alphabetical)."""
    return StringIndexer(inputCol=label_col, outputCol="label", stringOrderType="alphabetAsc",
                         handleInvalid="error")


def training_rows(labelled: DataFrame, key: str = "post_id") -> DataFrame:
    """The labelled rows with the key, label and features, written once."""
    cols = [key, LABEL_COL, *NUMERIC_FEATURES, *BOOL_FEATURES, *CATEGORICAL_FEATURES]
    rows = labelled.where(F.col(LABEL_COL).isNotNull()).select(*dict.fromkeys(cols))
    return materialize(rows, "training-rows")


def training_partitions(rows: int, classifier: str, partition_rows: int = TRAIN_PARTITION_ROWS) -> int:
    """Partitions to train on, from the number of rows alone."""
    partitions = max(1, -(-rows // partition_rows))
    if classifier == "gbt":
        partitions = min(partitions, max(BOOSTED_PARTITIONS, -(-rows // BOOSTED_PARTITION_ROWS)))
    return partitions


def dealt_rows(rows: DataFrame, partitions: int, key: str = "post_id") -> DataFrame:
    """Written rows dealt out by key hash into sorted partitions.

    Trees draw their bootstrap samples per partition, by position: with the
    partitions fixed by the rows alone the fitted model is the same on any
    cluster and for any split of the input.
    """
    return rows.repartition(partitions, key).sortWithinPartitions(key, F.xxhash64(*rows.columns))


def train(labelled: DataFrame, classifier: str = "rf", leaky: bool = True, partition_rows: int = TRAIN_PARTITION_ROWS,
          **kw) -> PipelineModel:
    """Fit the pipeline on rows with a label; the returned model also maps
    the class id back to the label text (``predicted_recommend``).

    The codes are fitted on the rows as written; only the trees need them dealt out.
    """
    rows = training_rows(labelled)
    lab = label_indexer().fit(rows)
    pipeline, _ = build_pipeline(classifier, leaky, **kw)
    prep, cat_idx, *rest = pipeline.getStages()
    pipeline.setStages([prep, cat_idx.fit(prep.transform(rows)), *rest])
    dealt = dealt_rows(rows, training_partitions(rows.count(), classifier, partition_rows))
    fitted = pipeline.fit(lab.transform(dealt))
    decode = IndexToString(inputCol="prediction", outputCol=f"predicted_{LABEL_COL}", labels=lab.labels)
    return PipelineModel(stages=[lab, *fitted.stages, decode])


def label_codes(model: PipelineModel) -> list[tuple[str, int]]:
    """(label, code) of the fitted encoder."""
    return [(label, code) for code, label in enumerate(model.stages[0].labels)]


def predict(model: PipelineModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Class id -> label text, per row, on the executors."""
    # stage 0 is the label indexer, which prediction input does not need
    out = PipelineModel(stages=model.stages[1:]).transform(df)
    keep = keep or ["post_id"]
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      F.col(f"predicted_{LABEL_COL}").alias(LABEL_COL))


def feature_importance(model: PipelineModel) -> list[tuple[str, float]]:
    """(input column, importance) of the tree ensemble; a category column's codes are added up."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    sizes = {}
    for s in model.stages:
        if hasattr(s, "categorySizes"):
            sizes = dict(zip(s.getOutputCols(), s.categorySizes))
    clf = model.stages[-2]
    models = [clf] if hasattr(clf, "featureImportances") else clf.models   # one-vs-rest: mean over the classes
    imp = sum(m.featureImportances.toArray() for m in models) / len(models)
    out, at = [], 0
    for c in assembler.getInputCols():
        n = sizes.get(c, 1)
        out.append((c, float(imp[at:at + n].sum())))
        at += n
    return out


def scored_rows(model: PipelineModel, df: DataFrame, *keep: str) -> DataFrame:
    """Rows with a label, their label code, prediction, (if the classifier gives it) the true class's probability, and ``keep``."""
    scored = model.transform(df.where(F.col(LABEL_COL).isNotNull()))
    p = F.get(vector_to_array("probability"), F.col("label").cast("int")) if "probability" in scored.columns \
        else F.lit(None).cast("double")
    return scored.select("post_id", LABEL_COL, "label", "prediction", F.col(f"predicted_{LABEL_COL}").alias("predicted"),
                         p.alias("p_true"), *keep)


def evaluate(model: PipelineModel, df: DataFrame) -> dict:
    """Accuracy, weighted F1 and log loss on rows with a label, from one pass over them.

    The rows are scored once and counted per (label, prediction); all metrics
    come from those few counts.
    """
    return _metrics(_score_counts(scored_rows(model, df)).collect())


def evaluate_by(model: PipelineModel, df: DataFrame, flag: str = "is_test") -> dict[bool, dict]:
    """``evaluate`` of the rows with ``flag`` false and of those with it true, from one pass over both."""
    counts = _score_counts(scored_rows(model, df, flag), flag).collect()
    return {value: _metrics([r for r in counts if r[flag] is value]) for value in (False, True)}


def _score_counts(scored: DataFrame, *by: str) -> DataFrame:
    return scored.groupBy(*by, "label", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.sum(-F.log(F.greatest("p_true", F.lit(1e-15)))).alias("loss"))


def _metrics(counts: list) -> dict:
    n = sum(r["n"] for r in counts)
    if not n:
        return {}
    hit = sum(r["n"] for r in counts if r["label"] == r["prediction"])
    f1 = 0.0
    for c in {r["label"] for r in counts}:
        actual = sum(r["n"] for r in counts if r["label"] == c)
        guessed = sum(r["n"] for r in counts if r["prediction"] == c)
        both = sum(r["n"] for r in counts if r["label"] == c == r["prediction"])
        f1 += actual * 2 * both / (actual + guessed) / n
    out = {"accuracy": hit / n, "f1": f1}
    if all(r["loss"] is not None for r in counts):
        out["logLoss"] = sum(r["loss"] for r in counts) / n
    return out


def boosting_losses(model: PipelineModel, df: DataFrame, every: int = LOSS_EVERY) -> list[tuple[str, int, float]]:
    """(label, round, loss) of each one-vs-rest booster on ``df`` after every ``every`` rounds."""
    rows = df.where(F.col(LABEL_COL).isNotNull())
    ready = PipelineModel(stages=model.stages[:-2]).transform(rows).select("features", "label")
    ready = materialize(ready, "loss-rows")
    out = []
    for code, booster in enumerate(model.stages[-2].models):
        labels = ready.select("features", (F.col("label") == code).cast("double").alias(booster.getLabelCol()))
        losses = booster.evaluateEachIteration(labels)
        out += [(model.stages[0].labels[code], r, float(losses[r - 1]))
                for r in range(1, len(losses) + 1) if r % every == 0 or r == 1]
    return out


def confusion(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows per (true label, predicted label)."""
    return scored_rows(model, df).groupBy(F.col(LABEL_COL).alias("actual"), "predicted").agg(F.count(F.lit(1)).alias("count"))


def save_model(model: PipelineModel, root: str, version: str) -> str:
    """One versioned artifact holding encoders, classifier and labels."""
    path = f"{root.rstrip('/')}/{version}"
    model.write().overwrite().save(path)
    return path


def load_model(root: str, version: str) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/{version}")
