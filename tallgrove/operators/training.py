"""Training forests, boosted trees and single trees from a parameter table."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tallgrove.functions.params import Params
from tallgrove.functions.roles import Roles, resolve_roles
from tallgrove.operators.evaluation import confusion_matrix
from tallgrove.operators.nodes import export_nodes, prune, tree_rules
from tallgrove.operators.scoring import Model, load_model, score
from tallgrove.sources.model_rows import Header, encode
from tallgrove.sources.tables import snapshot

MAX_CATEGORIES = 4096  # a split search over more values is not meaningful
MIN_BINS = 32
DEEPEST = 30  # what the library can grow; MAX_TREE_DEPTH sets less
LEAST_PARTITIONS, ROWS_PER_PARTITION = 8, 100_000  # INPUT_PARTITIONS sets the number itself

_log = logging.getLogger(__name__)


@dataclass
class TrainResult:
    """What a training call leaves behind; relations unless noted."""

    model_rows: DataFrame
    importance: DataFrame
    confusion_matrix: DataFrame
    header: Header
    nodes: DataFrame
    oob: DataFrame | None = None
    rules: DataFrame | None = None
    statistics: DataFrame | None = None
    selected_params: DataFrame | None = None
    candidates: DataFrame | None = None
    _model: Model | None = field(default=None, repr=False)

    @property
    def model(self) -> Model:
        """The parsed model, loaded once."""
        if self._model is None:
            self._model = load_model(self.model_rows)
        return self._model


@dataclass
class Prepared:
    """Indexed training rows in a reproducible order, persisted until released."""

    source: DataFrame
    rows: DataFrame
    roles: Roles
    header_features: tuple[tuple[str, tuple[str, ...] | None], ...]
    labels: tuple[str, ...]
    bins: int

    def header(self, kind: str) -> Header:
        return Header(kind, self.labels, self.header_features)

    def release(self) -> None:
        self.rows.unpersist()


def prepare(
    df: DataFrame, params: Params, extra: tuple[str, ...] = (), source: DataFrame | None = None
) -> Prepared:
    """Index labels and categories alphabetically and assemble the feature vector.

    Rows without a label are left out. Spark's tree fits depend on the layout
    of their input, so rows are placed and ordered by id, or by a hash of all columns
    where there is none, in ``INPUT_PARTITIONS`` partitions; without the parameter
    their number follows from the number of rows, never from the session.
    ``extra`` columns are carried along.
    """
    roles = resolve_roles(df.drop(*extra), params)
    labelled = df.filter(F.col(roles.label).isNotNull()).select(
        *([roles.id] if roles.id else []),
        *extra,
        F.col(roles.label).cast("string").alias("_label"),
        *[F.col(c).cast("string").alias(c) for c in roles.categorical],
        *[F.col(c).cast("double").alias(c) for c in roles.numeric],
    )
    count = params.whole("INPUT_PARTITIONS", 0) or max(LEAST_PARTITIONS, -(-labelled.count() // ROWS_PER_PARTITION))
    order = F.col(roles.id) if roles.id else F.xxhash64(*labelled.columns)
    placed = labelled.repartition(count, order).sortWithinPartitions(order)
    placed = placed.persist(StorageLevel.MEMORY_AND_DISK)

    wanted = ["_label", *roles.categorical]
    # Distinct values travel to the driver below, so their number is looked at first.
    sizes = placed.agg(*[F.approx_count_distinct(c).alias(c) for c in wanted]).first()
    for column in wanted:
        if sizes[column] > 1.2 * MAX_CATEGORIES:
            raise ValueError(f"{column} has about {sizes[column]} values, more than {MAX_CATEGORIES}")
    indexer = StringIndexer(
        inputCols=wanted,
        outputCols=["label"] + [f"_i_{c}" for c in roles.categorical],
        stringOrderType="alphabetAsc",
        handleInvalid="keep" if roles.categorical else "error",
    ).fit(placed)
    labels, *categories = [tuple(values) for values in indexer.labelsArray]
    if not labels:
        raise ValueError("no labelled rows to train on")
    categories = categories[: len(roles.categorical)]
    largest = max([len(c) for c in categories], default=0)
    if largest > MAX_CATEGORIES:
        raise ValueError(f"a categorical column has {largest} values, more than {MAX_CATEGORIES}")
    # The label gets its own indexer: it must not have a slot for unseen values.
    label_indexer = StringIndexerModel.from_labels(list(labels), "_label", "label", handleInvalid="error")
    rows = label_indexer.transform(placed)
    if roles.categorical:
        feature_indexer = StringIndexerModel.from_arrays_of_labels(
            [list(c) for c in categories],
            list(roles.categorical),
            [f"_i_{c}" for c in roles.categorical],
            handleInvalid="keep",
        )
        rows = feature_indexer.transform(rows)
    inputs = [f"_i_{c}" for c in roles.categorical] + list(roles.numeric)
    assembled = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error").transform(rows)
    # Numbers and categories stay beside the vector: scoring reads those.
    kept = [*([roles.id] if roles.id else []), *extra, "_label", "label", *roles.features, "features"]
    cached = assembled.select(*kept).persist(StorageLevel.MEMORY_AND_DISK)
    cached.count()
    placed.unpersist()
    features = tuple(zip(roles.categorical, categories)) + tuple((c, None) for c in roles.numeric)
    return Prepared(df if source is None else source, cached, roles, features, labels, max(MIN_BINS, largest + 1))


def _importance(values, header: Header, spark, name_column: str) -> DataFrame:
    rows = [(name, float(v)) for (name, _), v in zip(header.features, values)]
    return spark.createDataFrame(rows, f"{name_column} string, IMPORTANCE double")


def finish(
    prepared: Prepared, header: Header, nodes: DataFrame, importance: DataFrame, **more
) -> TrainResult:
    """Store the model rows and put the side outputs together."""
    stored = snapshot(encode(header, nodes), label="model-rows")
    result = TrainResult(stored, importance, stored, header, nodes, **more)
    source = prepared.source.filter(F.col(prepared.roles.label).isNotNull())
    result.confusion_matrix = training_matrix(source, result, prepared.roles.label)
    return result


def training_matrix(df: DataFrame, result: TrainResult, label: str) -> DataFrame:
    """Confusion matrix of the model on the rows it was trained on."""
    scored = score(df.withColumn("_truth", F.col(label).cast("string")), result.model, "_truth")  # no key is needed
    return confusion_matrix(scored, "_truth", "SCORE")


def depth_of(params: Params, max_depth: int | None, default: int = DEEPEST) -> int:
    """The depth a call may grow to: its argument, else MAX_TREE_DEPTH, else the deepest possible."""
    return min(DEEPEST, params.whole("MAX_TREE_DEPTH", default) if max_depth is None else max_depth)


def tell_depth(depths: list[int], limit: int) -> None:
    """Say so if trees would have grown beyond the limit."""
    stopped = sum(depth >= limit for depth in depths)
    if stopped:
        _log.warning("%d of %d trees reached the depth limit of %d", stopped, len(depths), limit)


def forest_estimator(prepared: Prepared, params: Params, max_depth: int, **more) -> RandomForestClassifier:
    tried = min(params.whole("TRY_NUM", 0) or len(prepared.roles.features), len(prepared.roles.features))
    settings = dict(
        numTrees=params.whole("TREES_NUM", 100),
        featureSubsetStrategy=str(tried) if "TRY_NUM" in params else "auto",
        seed=params.whole("SEED", 0),
        minInfoGain=params.number("SPLIT_THRESHOLD", 1e-5),
        minInstancesPerNode=params.whole("NODE_SIZE", 1),
        maxDepth=max_depth,
        maxBins=prepared.bins,
    )
    return RandomForestClassifier(**{**settings, **more})


def train_forest(df: DataFrame, params, max_depth: int | None = None) -> TrainResult:
    """Random forest: model rows, importance, training matrix and, if asked, OOB error."""
    from tallgrove.operators.out_of_bag import train_with_bags

    params = Params.read(params, "forest")
    max_depth = depth_of(params, max_depth)
    prepared = prepare(df, params)
    try:
        if params.whole("CALCULATE_OOB", 0) == 1:
            return train_with_bags(prepared, params, max_depth)
        spark = df.sparkSession
        header = prepared.header("forest")
        model = forest_estimator(prepared, params, max_depth).fit(prepared.rows)
        tell_depth([tree.depth for tree in model.trees], max_depth)
        nodes = export_nodes(model, header, spark).withColumn("WEIGHT", F.lit(1.0))
        return finish(prepared, header, nodes, _importance(model.featureImportances.toArray(), header, spark, "COLUMN_NAME"))
    finally:
        prepared.release()


def boosted_estimator(prepared: Prepared, params: Params, **more) -> GBTClassifier:
    if len(prepared.labels) < 2:
        raise ValueError(f"boosted trees need two classes, found {len(prepared.labels)}")
    settings = dict(
        maxDepth=params.whole("MAX_TREE_DEPTH", 6),
        maxIter=params.whole("ITER_NUM", 10),
        stepSize=params.number("LEARNING_RATE", 0.3),
        minInfoGain=params.number("MIN_SPLIT_LOSS", 0.0),
        subsamplingRate=params.number("ROW_SAMPLE_RATE", 1.0),
        seed=params.whole("SEED", 0),
        maxBins=prepared.bins,
    )
    return GBTClassifier(**{**settings, **more})


def fit_boosted(estimator: GBTClassifier, rows: DataFrame, header: Header) -> tuple[DataFrame, list[float]]:
    """Node rows and importances. Of more than two classes each is boosted against all others.

    The trees of class c then carry CLASS = c, and are numbered from those of the first class on.
    """
    spark, classes = rows.sparkSession, len(header.labels)
    if classes == 2:
        model = estimator.fit(rows)
        return export_nodes(model, header, spark), model.featureImportances.toArray().tolist()
    nodes, importances, before = [], [], 0
    for c in range(classes):
        model = estimator.fit(rows.withColumn("label", (F.col("label") == c).cast("double")))
        mine = export_nodes(model, header, spark)
        nodes.append(mine.withColumn("TREE", F.col("TREE") + before).withColumn("CLASS", F.lit(c)))
        importances.append(model.featureImportances.toArray())
        before += len(model.trees)
    return reduce(DataFrame.unionByName, nodes), (sum(importances) / classes).tolist()


def train_boosted(df: DataFrame, params, store: str | None = None) -> TrainResult:
    """Boosted trees; ``RANGE_*`` parameters start a search first, whose finished fits ``store`` keeps."""
    from tallgrove.operators.tuning import needs_folds, prepare_with_folds, search

    params = Params.read(params, "boosted")
    searching = needs_folds(params)
    prepared = prepare_with_folds(df, params) if searching else prepare(df, params)
    try:
        spark = df.sparkSession
        more, chosen = {}, params
        if searching:
            found = search(prepared, params, "boosted", store=store)
            chosen = Params.of(**{**params, **found.best})
            more = {"selected_params": found.selected("PARM_NAME"), "candidates": found.candidates,
                    "statistics": found.statistics()}
        header = prepared.header("boosted")
        nodes, values = fit_boosted(boosted_estimator(prepared, chosen), prepared.rows, header)
        return finish(prepared, header, nodes, _importance(values, header, spark, "VARIABLE_NAME"), **more)
    finally:
        prepared.release()


def tree_estimator(prepared: Prepared, params: Params, max_depth: int, **more) -> DecisionTreeClassifier:
    if params.whole("ALGORITHM", 3) != 3:
        raise ValueError("only ALGORITHM = 3 (CART) is available")
    settings = dict(
        impurity="gini",
        minInstancesPerNode=params.whole("MIN_RECORDS_OF_LEAF", 1),
        minInfoGain=params.number("SPLIT_THRESHOLD", 0.0),
        seed=params.whole("SEED", 0),
        maxDepth=max_depth,
        maxBins=prepared.bins,
    )
    return DecisionTreeClassifier(**{**settings, **more})


def train_tree(df: DataFrame, params, max_depth: int | None = None, store: str | None = None) -> TrainResult:
    """CART: model rows, rules, training matrix, and statistics of a CV or grid search, whose finished fits ``store`` keeps."""
    from tallgrove.operators.tuning import needs_folds, prepare_with_folds, search

    params = Params.read(params, "tree")
    max_depth = depth_of(params, max_depth)
    searching = needs_folds(params)
    prepared = prepare_with_folds(df, params) if searching else prepare(df, params)
    try:
        spark = df.sparkSession
        more, chosen = {}, params
        if searching:
            found = search(prepared, params, "tree", max_depth, store)
            chosen = Params.of(**{**params, **found.best})
            more = {"selected_params": found.selected("PARAM_NAME"), "candidates": found.candidates,
                    "statistics": found.statistics()}
        header = prepared.header("tree")
        model = tree_estimator(prepared, chosen, max_depth).fit(prepared.rows)
        tell_depth([model.depth], max_depth)
        nodes = prune(export_nodes(model, header, spark), chosen.whole("MIN_RECORDS_OF_PARENT", 0))
        if params.whole("IS_OUTPUT_RULES", 0) == 1:
            more["rules"] = tree_rules(nodes, header.labels).drop("TREE")
        importance = _importance(model.featureImportances.toArray(), header, spark, "COLUMN_NAME")
        return finish(prepared, header, nodes, importance, **more)
    finally:
        prepared.release()
