"""The registered queries: each reads the tables of a folder and returns a relation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrove.functions import calls
from tallgrove.functions import columns as fc
from tallgrove.functions import params as fp
from tallgrove.functions import routines
from tallgrove.operators import evaluation as ev
from tallgrove.operators import payloads as pl
from tallgrove.operators.forecasting import ses_forecast
from tallgrove.operators.nodes import tree_rules
from tallgrove.operators.ordering import ROWS_PER_BUCKET, distributed_rank, positions, shuffle_key
from tallgrove.operators.out_of_bag import bag_counts as bag_counts_of
from tallgrove.operators.out_of_bag import oob_error as oob_error_of
from tallgrove.operators.sampling import TEST, TRAIN, VALIDATE, folds_by_rank, split, stratified_folds, stratified_partition
from tallgrove.operators.scoring import load_model, score
from tallgrove.operators.training import TrainResult, train_boosted, train_forest, train_tree, training_matrix
from tallgrove.operators.tuning import candidate_counts, candidate_metrics
from tallgrove.plans import given_splits as gs
from tallgrove.sources import features as ft
from tallgrove.sources.model_rows import chunk, unchunk
from tallgrove.sources.registry import BOOSTED, FOREST, Registry
from tallgrove.sources.tables import (
    append,
    bucket_stats,
    drop,
    empty_like,
    hash_partitioned,
    load,
    partition_stats,
    refill,
    register,
    scratch_path,
    snapshot,
    write_bucketed,
)
from tallgrove.streaming.scoring import read_feature_stream, read_scores, score_stream, write_latest_scores, write_scores

QUERIES: dict = {}

FOREST_NAME = "CUSTOMER_CHURN"
SAVED_AT = dt.datetime(2024, 1, 2, 3, 4, 5)


# Registry keys that differ from the function's name.
KEYS = {
    "stratified_partition_ids": "stratified_partition",
    "folds": "stratified_folds",
    "partition_rows": "partition_stats",
    "rules": "tree_rules",
    "ses_forecasts": "ses_forecast",
    "in_list": "id_in_list",
}


def query(function):
    QUERIES[KEYS.get(function.__name__, function.__name__)] = function
    return function


# ---------------------------------------------------------------- feature views


@query
def abt_features(spark: SparkSession, directory: str) -> DataFrame:
    return ft.churn_view(spark, directory)


@query
def abt_view(spark: SparkSession, directory: str) -> DataFrame:
    register(ft.new_customer_view(spark, directory), "new_customer_view")
    return spark.sql("SELECT v.* FROM new_customer_view AS v")


@query
def score_input(spark: SparkSession, directory: str) -> DataFrame:
    return gs.part_of_view(spark, directory, VALIDATE).select(ft.ID, *ft.feature_columns())


@query
def row_counts(spark: SparkSession, directory: str) -> DataFrame:
    return ft.churn_view(spark, directory).agg(F.count(F.lit(1)).alias("NCOUNT"))


@query
def wholesale_view(spark: SparkSession, directory: str) -> DataFrame:
    return ft.wholesale_view(spark, directory)


@query
def retail_sales(spark: SparkSession, directory: str) -> DataFrame:
    return ft.retail_sales(spark, directory)


# ------------------------------------------------------------- split and folds


@query
def stratified_partition_ids(spark: SparkSession, directory: str) -> DataFrame:
    return gs.assignment(spark, directory)


@query
def partition_2way(spark: SparkSession, directory: str) -> DataFrame:
    view = gs.wholesale_table(spark, directory)
    parts = stratified_partition(view, "IDCOL", "CUSTOMERTYPE", (0.7, 0.3, 0.0), 23, check_ids=False)
    return parts.withColumnRenamed("PARTITION_TYPE", "PARTITION_NUMBER")


@query
def partition_unstratified(spark: SparkSession, directory: str) -> DataFrame:
    view = gs.feature_table(spark, directory)
    return stratified_partition(view, ft.ID, None, (0.6, 0.2, 0.1), 7, check_ids=False)


@query
def partition_counts(spark: SparkSession, directory: str) -> DataFrame:
    return gs.assignment(spark, directory).groupBy("PARTITION_TYPE").agg(F.count(F.lit(1)).alias("NCOUNT"))


@query
def partition_label_counts(spark: SparkSession, directory: str) -> DataFrame:
    tagged = gs.tagged_view(spark, directory)
    return tagged.groupBy("PARTITION_TYPE", ft.LABEL).agg(F.count(F.lit(1)).alias("NCOUNT"))


def _joined_part(spark: SparkSession, directory: str, part: int) -> DataFrame:
    """Rows joined with their assignment, as with a split stored on its own."""
    return split(gs.feature_table(spark, directory), gs.assignment(spark, directory), ft.ID, part)


@query
def split_train(spark: SparkSession, directory: str) -> DataFrame:
    return _joined_part(spark, directory, TRAIN)


@query
def split_test(spark: SparkSession, directory: str) -> DataFrame:
    return _joined_part(spark, directory, TEST)


@query
def split_val(spark: SparkSession, directory: str) -> DataFrame:
    return _joined_part(spark, directory, VALIDATE)


@query
def folds(spark: SparkSession, directory: str) -> DataFrame:
    view = gs.wholesale_table(spark, directory)
    return stratified_folds(view, "IDCOL", "CUSTOMERTYPE", 10, 25, check_ids=False)


# -------------------------------------------------------- scoring, given splits


def _new_scores(spark: SparkSession, directory: str, **options) -> DataFrame:
    return score(ft.new_customer_view(spark, directory), gs.model(spark, directory), ft.ID, **options)


def _part_scores(spark: SparkSession, directory: str, kind: str = "forest") -> DataFrame:
    """Scores of all labelled rows beside the observed label and the part."""
    tagged = gs.tagged_view(spark, directory).withColumnRenamed(ft.LABEL, "ORIGINAL_LABEL")
    later = 0.1 if kind == "boosted" else 1.0
    model = gs.model(spark, directory, kind, later)
    return score(tagged, model, ft.ID, keep=("PARTITION_TYPE", "ORIGINAL_LABEL"))


@query
def tree_score(spark: SparkSession, directory: str) -> DataFrame:
    return _new_scores(spark, directory)


@query
def soft_score(spark: SparkSession, directory: str) -> DataFrame:
    scored = _new_scores(spark, directory, vote="soft")
    return scored.withColumn("CONFIDENCE", F.round("CONFIDENCE", 6))


@query
def verbose_score(spark: SparkSession, directory: str) -> DataFrame:
    return _new_scores(spark, directory, verbose=True)


@query
def boosted_score(spark: SparkSession, directory: str) -> DataFrame:
    view = ft.new_customer_view(spark, directory)
    scored = score(view, gs.model(spark, directory, "boosted", 0.1), ft.ID)
    return scored.withColumn("CONFIDENCE", F.round("CONFIDENCE", 6))


@query
def boosted_verbose(spark: SparkSession, directory: str) -> DataFrame:
    """One row per account and class, the confidence as text."""
    view = ft.new_customer_view(spark, directory)
    scored = score(view, gs.model(spark, directory, "boosted", 0.1), ft.ID, verbose=True, text_confidence=True)
    number = F.round(F.col("CONFIDENCE").cast("double"), 6)
    return scored.select(ft.ID, "SCORE", number.alias("CONFIDENCE"), F.typeof("CONFIDENCE").alias("KIND"))


@query
def boosted_classes(spark: SparkSession, directory: str) -> DataFrame:
    """Given boosted trees of three classes, by way of their model rows."""
    model = load_model(gs.three_class_rows(spark))
    scored = score(load(spark, directory, "customer"), model, "c_custkey", verbose=True)
    return scored.withColumn("CONFIDENCE", F.round("CONFIDENCE", 6))


@query
def boosted_class_score(spark: SparkSession, directory: str) -> DataFrame:
    model = load_model(gs.three_class_rows(spark))
    scored = score(load(spark, directory, "customer"), model, "c_custkey", engine="arrays")
    return scored.withColumn("CONFIDENCE", F.round("CONFIDENCE", 6))


@query
def array_score(spark: SparkSession, directory: str) -> DataFrame:
    """The vectorised scorer, whatever the model's size."""
    return _new_scores(spark, directory, engine="arrays")


@query
def score_counts(spark: SparkSession, directory: str) -> DataFrame:
    return _new_scores(spark, directory).groupBy("SCORE").agg(F.count(F.lit(1)).alias("NCOUNT"))


@query
def distinct_scores(spark: SparkSession, directory: str) -> DataFrame:
    return _new_scores(spark, directory).agg(F.countDistinct("SCORE").alias("NSCORES"))


@query
def churned_rows(spark: SparkSession, directory: str) -> DataFrame:
    return _new_scores(spark, directory).filter(F.col("SCORE") == ft.POSITIVE)


@query
def churned_count(spark: SparkSession, directory: str) -> DataFrame:
    return _new_scores(spark, directory).agg(F.count_if(F.col("SCORE") == ft.POSITIVE).alias("NCOUNT"))


@query
def high_conf(spark: SparkSession, directory: str) -> DataFrame:
    """Text confidences are turned into numbers before the comparison."""
    model = gs.model(spark, directory, "boosted", 0.1)
    scored = score(ft.new_customer_view(spark, directory), model, ft.ID, text_confidence=True)
    sure = (F.col("SCORE") == ft.POSITIVE) & (fc.to_double(F.col("CONFIDENCE")) > 0.55)
    return scored.filter(sure).select(
        ft.ID, "SCORE", F.round(fc.to_double(F.col("CONFIDENCE")), 6).alias("CONFIDENCE")
    )


@query
def to_double(spark: SparkSession, directory: str) -> DataFrame:
    """Prices as text, some of them marked, back to numbers; marked ones are NULL."""
    orders = load(spark, directory, "orders")
    mark = F.when(F.col("o_orderstatus") == "F", "~").otherwise("")
    text = F.concat(mark, F.col("o_totalprice").cast("string"))
    return orders.select("o_orderkey", fc.to_double(text).alias("PRICE"))


@query
def in_list(spark: SparkSession, directory: str) -> DataFrame:
    wanted = ["NATION_1", "NATION_4", "NATION_9", "NATION_16"]
    return _new_scores(spark, directory, keep=("ServiceName",)).filter(F.col("ServiceName").isin(wanted))


@query
def ordered_by_id(spark: SparkSession, directory: str) -> DataFrame:
    return _new_scores(spark, directory).filter(F.col("SCORE") == ft.POSITIVE).orderBy(ft.ID)


@query
def ordered_by_score(spark: SparkSession, directory: str) -> DataFrame:
    return _new_scores(spark, directory).orderBy("SCORE", F.desc("CONFIDENCE"), ft.ID)


@query
def top_risk(spark: SparkSession, directory: str) -> DataFrame:
    """The ten accounts with the highest probability to churn."""
    scored = _new_scores(spark, directory, vote="soft").select(ft.ID, gs.probability())
    rounded = scored.withColumn("CHURN_PROBABILITY", F.round("CHURN_PROBABILITY", 6))
    return rounded.orderBy(F.desc("CHURN_PROBABILITY"), ft.ID).limit(10)


@query
def parallel_score(spark: SparkSession, directory: str) -> DataFrame:
    view = hash_partitioned(ft.new_customer_view(spark, directory), ft.ID, 8)
    return score(view, gs.model(spark, directory), ft.ID)


@query
def partition_rows(spark: SparkSession, directory: str) -> DataFrame:
    return partition_stats(hash_partitioned(ft.new_customer_view(spark, directory), ft.ID, 8))


# ------------------------------------------------------------------ evaluation


@query
def actual_vs_pred(spark: SparkSession, directory: str) -> DataFrame:
    validation = gs.part_of_view(spark, directory, VALIDATE)
    scored = score(validation, gs.model(spark, directory), ft.ID)
    return ev.compare_with_observed(validation, scored, ft.ID, ft.LABEL, ft.ID)


@query
def auc_input(spark: SparkSession, directory: str) -> DataFrame:
    train = gs.part_of_view(spark, directory, TRAIN)
    rows = ev.compare_with_observed(train, score(train, gs.model(spark, directory), ft.ID), ft.ID, ft.LABEL, ft.ID)
    rows = rows.withColumnRenamed("PREDICTED_LABEL", "SCORE")
    return rows.select("ID", "ORIGINAL_LABEL", gs.probability())


@query
def positive_prob(spark: SparkSession, directory: str) -> DataFrame:
    scored = _new_scores(spark, directory)
    value = ev.positive_probability(F.col("SCORE"), F.col("CONFIDENCE"), ft.POSITIVE)
    return scored.select(ft.ID, F.round(value, 6).alias("CHURN_PROBABILITY"))


@query
def compare_results(spark: SparkSession, directory: str) -> DataFrame:
    return _part_scores(spark, directory).select(ft.ID, "SCORE", "CONFIDENCE", "ORIGINAL_LABEL")


@query
def mismatches(spark: SparkSession, directory: str) -> DataFrame:
    rows = _part_scores(spark, directory).filter(F.col("SCORE") != F.col("ORIGINAL_LABEL"))
    return rows.select(ft.ID, "SCORE", "ORIGINAL_LABEL", "PARTITION_TYPE")


@query
def mismatch_count(spark: SparkSession, directory: str) -> DataFrame:
    return _part_scores(spark, directory).agg(
        F.count(F.lit(1)).alias("NROWS"),
        F.count_if(F.col("SCORE") != F.col("ORIGINAL_LABEL")).alias("NMISMATCH"),
    )


@query
def confusion_matrix(spark: SparkSession, directory: str) -> DataFrame:
    return ev.confusion_matrix(_part_scores(spark, directory), "ORIGINAL_LABEL", "SCORE")


def _rounded_stats(stats: DataFrame) -> DataFrame:
    for name in ("PRECISION", "RECALL", "FBETA", "ACCURACY", "KAPPA"):
        stats = stats.withColumn(name, F.round(name, 6))
    return stats


@query
def class_stats(spark: SparkSession, directory: str) -> DataFrame:
    matrix = ev.confusion_matrix(_part_scores(spark, directory), "ORIGINAL_LABEL", "SCORE")
    return _rounded_stats(ev.class_stats(matrix, beta=2.0))


@query
def auc(spark: SparkSession, directory: str) -> DataFrame:
    rows = _part_scores(spark, directory).select("ORIGINAL_LABEL", gs.probability())
    area = ev.auc(rows, "ORIGINAL_LABEL", "CHURN_PROBABILITY", ft.POSITIVE)
    return area.withColumn("STAT_VALUE", F.round("STAT_VALUE", 6))


@query
def auc_many_scores(spark: SparkSession, directory: str) -> DataFrame:
    """Nearly as many scores as rows: is a late order recognised by its price?"""
    orders = load(spark, directory, "orders")
    rows = orders.select(
        F.when(F.col("o_orderstatus") == "F", ft.POSITIVE).otherwise(ft.NEGATIVE).alias("ORIGINAL_LABEL"),
        (F.col("o_totalprice") / 1000000).alias("P"),
        "o_orderpriority",
    )
    area = ev.auc(rows, "ORIGINAL_LABEL", "P", ft.POSITIVE, by=("o_orderpriority",))
    return area.withColumn("STAT_VALUE", F.round("STAT_VALUE", 6))


@query
def roc_curve(spark: SparkSession, directory: str) -> DataFrame:
    rows = _part_scores(spark, directory, "boosted").select("ORIGINAL_LABEL", gs.probability())
    points = ev.roc_curve(rows, "ORIGINAL_LABEL", "CHURN_PROBABILITY", ft.POSITIVE)
    return points.withColumn("FPR", F.round("FPR", 6)).withColumn("TPR", F.round("TPR", 6))


@query
def quality_by_sample(spark: SparkSession, directory: str) -> DataFrame:
    """Accuracy, kappa and area of the training and the validation part side by side."""
    rows = _part_scores(spark, directory).filter(F.col("PARTITION_TYPE").isin(TRAIN, VALIDATE))
    rows = rows.select("PARTITION_TYPE", "ORIGINAL_LABEL", "SCORE", gs.probability())
    by = ("PARTITION_TYPE",)
    stats = ev.class_stats(ev.confusion_matrix(rows, "ORIGINAL_LABEL", "SCORE", by), by=by)
    areas = ev.auc(rows, "ORIGINAL_LABEL", "CHURN_PROBABILITY", ft.POSITIVE, by)
    joined = _rounded_stats(stats).join(areas, "PARTITION_TYPE")
    return joined.select(
        "PARTITION_TYPE", "CLASS", "PRECISION", "RECALL", "ACCURACY", "KAPPA",
        F.round("STAT_VALUE", 6).alias("AUC"),
    )


def _model_areas(spark: SparkSession, directory: str) -> DataFrame:
    rows = None
    for name, kind in ((FOREST, "forest"), (BOOSTED, "boosted")):
        scored = _part_scores(spark, directory, kind).filter(F.col("PARTITION_TYPE") == TEST)
        tagged = scored.select(F.lit(name).alias("MODEL_TYPE"), "ORIGINAL_LABEL", gs.probability())
        rows = tagged if rows is None else rows.unionByName(tagged)
    return ev.auc(rows, "ORIGINAL_LABEL", "CHURN_PROBABILITY", ft.POSITIVE, ("MODEL_TYPE",))


@query
def model_compare(spark: SparkSession, directory: str) -> DataFrame:
    return _model_areas(spark, directory).withColumn("STAT_VALUE", F.round("STAT_VALUE", 6))


@query
def champion(spark: SparkSession, directory: str) -> DataFrame:
    """Save the better model on the test part as champion; list what was saved."""
    areas = snapshot(_model_areas(spark, directory), label="areas")
    forest = ev.single_value(areas.filter(F.col("MODEL_TYPE") == FOREST), "STAT_VALUE")
    boosted = ev.single_value(areas.filter(F.col("MODEL_TYPE") == BOOSTED), "STAT_VALUE")
    registry = Registry.create(spark, scratch_path(spark, "registry"))
    registry.save_champion(
        FOREST_NAME,
        ev.select_champion(forest, boosted),
        (FOREST, gs.model_rows(spark, directory)),
        (BOOSTED, gs.model_rows(spark, directory, "boosted", 0.1)),
        saved_at=SAVED_AT,
    )
    return registry.versions(FOREST_NAME, above=99).select("MODEL_NAME", "MODEL_VERSION", "MODEL_TYPE")


@query
def scripted_champion(spark: SparkSession, directory: str) -> DataFrame:
    """The choice between two models as one script over their areas; its one row says which is saved."""
    register(snapshot(_model_areas(spark, directory), label="areas"), "script_areas")
    chosen = spark.sql(f"""BEGIN
  DECLARE forest DOUBLE;
  DECLARE boosted DOUBLE;
  SET forest = (SELECT STAT_VALUE FROM script_areas WHERE MODEL_TYPE = '{FOREST}');
  SET boosted = (SELECT STAT_VALUE FROM script_areas WHERE MODEL_TYPE = '{BOOSTED}');
  IF forest > boosted THEN
    SELECT 'a' AS CHOICE;
  ELSE
    SELECT 'b' AS CHOICE;
  END IF;
END""")
    registry = Registry.create(spark, scratch_path(spark, "registry"))
    registry.save_champion(
        FOREST_NAME,
        ev.single_value(chosen, "CHOICE"),
        (FOREST, gs.model_rows(spark, directory)),
        (BOOSTED, gs.model_rows(spark, directory, "boosted", 0.1)),
        saved_at=SAVED_AT,
    )
    return registry.versions(FOREST_NAME, above=99).select("MODEL_NAME", "MODEL_VERSION", "MODEL_TYPE")


# ------------------------------------------------- parameters, model text, rows


@query
def params_table(spark: SparkSession, directory: str) -> DataFrame:
    """Typed parameter rows for every product group, sized by its own history."""
    sales = ft.retail_sales(spark, directory)
    periods = sales.groupBy("PRODUCT_ID").agg(F.count(F.lit(1)).alias("n"))

    def row(name: str, whole=None, number=None, text=None):
        return F.struct(
            F.lit(name).alias("PARAM_NAME"),
            (F.lit(None) if whole is None else whole).cast("int").alias("INT_VALUE"),
            (F.lit(None) if number is None else number).cast("double").alias("DOUBLE_VALUE"),
            (F.lit(None) if text is None else text).cast("string").alias("STRING_VALUE"),
        )

    rows = F.array(
        row("FORECAST_NUM", whole=F.col("n") % 12),
        row("ALPHA", number=F.round(F.lit(2.0) / (F.col("n") + 1), 6)),
        row("MEASURE_NAME", text=F.lit("MSE")),
    )
    return periods.select("PRODUCT_ID", F.inline(rows))


@query
def params_unnest(spark: SparkSession, directory: str) -> DataFrame:
    """Every account's measures as parameter rows, zipped from four arrays."""
    view = ft.churn_view(spark, directory)
    names = F.array(F.lit("DataUsage_PCT"), F.lit("Revenue_Month"), F.lit("ServiceType"))
    none = F.lit(None)
    arrays = view.select(
        ft.ID,
        names.alias("n"),
        F.array(F.col("DataUsage_PCT").cast("int"), none, none).alias("i"),
        F.array(none, F.col("Revenue_Month"), none).alias("d"),
        F.array(none, none, F.col("ServiceType")).alias("s"),
    )
    return fp.unnest(arrays, [ft.ID], "n", "i", "d", "s")


@query
def chunk_roundtrip(spark: SparkSession, directory: str) -> DataFrame:
    """Whole documents cut into pieces of 1000 characters and joined again."""
    documents = load(spark, directory, "documents").select("doc_id", "text")
    pieces = chunk(documents, ["doc_id"], "text", 1000)
    counts = pieces.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("N_PIECES"), F.max(F.length("CONTENT")).cast("bigint").alias("LONGEST")
    )
    whole = unchunk(pieces, ["doc_id"]).select("doc_id", F.md5("TEXT").alias("MD5"))
    return counts.join(whole, "doc_id")


@query
def model_preview(spark: SparkSession, directory: str) -> DataFrame:
    """The beginning of every document's text."""
    documents = load(spark, directory, "documents")
    return documents.select("doc_id", F.md5(fc.preview(F.col("text"), 1000)).alias("PREVIEW_MD5"))


@query
def node_counts(spark: SparkSession, directory: str) -> DataFrame:
    """The training rows that reach each node of the given trees, read back from model rows."""
    nodes = [
        (t, n["NODE"], int(n["COUNTS"][0]), int(n["COUNTS"][1]))
        for t, tree in enumerate(gs.model(spark, directory).trees)
        for n in tree.nodes.values()
    ]
    return spark.createDataFrame(nodes, "TREE int, NODE int, N_ACTIVE long, N_CHURNED long")


@query
def rules(spark: SparkSession, directory: str) -> DataFrame:
    return tree_rules(gs.node_rows(spark, directory), (ft.NEGATIVE, ft.POSITIVE))


# -------------------------------------------------------- registry and routines


def _registry(spark: SparkSession, directory: str) -> Registry:
    registry = Registry.create(spark, scratch_path(spark, "registry"))
    registry.save(FOREST_NAME, "1.1", FOREST, gs.model_rows(spark, directory), SAVED_AT)
    registry.save(FOREST_NAME, "1.2", BOOSTED, gs.model_rows(spark, directory, "boosted", 0.1), SAVED_AT)
    return registry


@query
def registry_versions(spark: SparkSession, directory: str) -> DataFrame:
    return _registry(spark, directory).versions(FOREST_NAME)


@query
def registry_load(spark: SparkSession, directory: str) -> DataFrame:
    """Score new rows with a model that went through the registry."""
    rows = _registry(spark, directory).load(FOREST_NAME, "1.1", FOREST)
    return score(ft.new_customer_view(spark, directory), load_model(rows), ft.ID)


@query
def registry_load_boosted(spark: SparkSession, directory: str) -> DataFrame:
    rows = _registry(spark, directory).load(FOREST_NAME, 1.2, BOOSTED)
    scored = score(ft.new_customer_view(spark, directory), load_model(rows), ft.ID)
    return scored.withColumn("CONFIDENCE", F.round("CONFIDENCE", 6))


@query
def registry_rows(spark: SparkSession, directory: str) -> DataFrame:
    """The registry table itself, long text as a preview."""
    table = _registry(spark, directory).table()
    return table.withColumn("MODEL_CONTENT", fc.preview(F.col("MODEL_CONTENT")))


@query
def append_refill(spark: SparkSession, directory: str) -> DataFrame:
    """Two scoring runs into one result table, after the table was emptied."""
    path = scratch_path(spark, "result")
    scored = _part_scores(spark, directory)
    for part in (VALIDATE, TRAIN, TEST):
        rows = scored.filter(F.col("PARTITION_TYPE") == part).select(ft.ID, "SCORE", "CONFIDENCE")
        # The first run is thrown away, the next two accumulate.
        table = append(rows, path) if part == TEST else refill(rows, path)
    return table


@query
def tvf_score(spark: SparkSession, directory: str) -> DataFrame:
    register(ft.new_customer_view(spark, directory), "new_customer_view")
    routines.register_scoring_tvf(
        spark, "predict_customer_churn", "new_customer_view", gs.model(spark, directory), ft.ID
    )
    return spark.sql("SELECT * FROM predict_customer_churn()")


@query
def score_one(spark: SparkSession, directory: str) -> DataFrame:
    """The function with an argument, for the account of the largest single order."""
    register(ft.new_customer_view(spark, directory), "new_customer_view")
    register(load(spark, directory, "orders"), "orders_view")
    routines.register_scoring_tvf(
        spark, "predict_single_churn", "new_customer_view", gs.model(spark, directory), ft.ID, "ip_id"
    )
    wanted = spark.sql("SELECT max_by(o_custkey, struct(o_totalprice, o_custkey)) AS id FROM orders_view")
    account = ev.single_value(wanted, "id")
    return spark.sql("SELECT * FROM predict_single_churn(:account)", args={"account": account})


@query
def state_score(spark: SparkSession, directory: str) -> DataFrame:
    """Score by state id, without model rows."""
    description = "Churn model version 1.1"
    rows = gs.model_rows(spark, directory)
    handle = routines.load_state(rows, {"ALGORITHM": 2, "STATE_DESCRIPTION": description})
    found = routines.states(spark).filter(F.col("DESCRIPTION") == description)
    assert found.filter(F.col("STATE_ID") == handle.state_id).count() == 1
    params = {"THREAD_RATIO": 0.5, "VERBOSE": 0, "STATE_ID": handle.state_id}
    return routines.score_with_params(ft.new_customer_view(spark, directory), None, params, ft.ID)


@query
def stream_score(spark: SparkSession, directory: str) -> DataFrame:
    """New accounts written to a folder, scored as a stream of its files."""
    view = ft.new_customer_view(spark, directory)
    source, sink = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    view.write.parquet(source)
    scored = score_stream(read_feature_stream(spark, source, view.schema), gs.model(spark, directory), ft.ID)
    write_scores(scored, sink, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema(scored.schema).parquet(sink)


@query
def stream_latest(spark: SparkSession, directory: str) -> DataFrame:
    """Accounts with even ids arrive before a second version is saved, the others after."""
    view = ft.new_customer_view(spark, directory)
    source, sink, state = (scratch_path(spark, f"stream-{n}") for n in ("latest-in", "latest-out", "latest-state"))
    registry = Registry.create(spark, scratch_path(spark, "registry"))
    versions = (FOREST, gs.model_rows(spark, directory)), (BOOSTED, gs.model_rows(spark, directory, "boosted", 0.1))
    for i, (kind, rows) in enumerate(versions):
        registry.save(FOREST_NAME, 1.0 + i, kind, rows, saved_at=SAVED_AT)
        append(view.filter(F.col(ft.ID) % 2 == i), source)
        stream = read_feature_stream(spark, source, view.schema)
        write_latest_scores(stream, registry, FOREST_NAME, ft.ID, sink, state).awaitTermination()
    return read_scores(spark, sink).drop("batch").withColumn("CONFIDENCE", F.round("CONFIDENCE", 6))


@query
def score_grouped(spark: SparkSession, directory: str) -> DataFrame:
    """A model that travels as several groups of trees, over rows whose ids repeat."""
    view = ft.new_customer_view(spark, directory)
    model = load_model(gs.model_rows(spark, directory), broadcast_chars=1)
    return score(view.unionByName(view), model, ft.ID)


@query
def score_bucketed(spark: SparkSession, directory: str) -> DataFrame:
    """A stored table, hash-bucketed by the id, scored in place."""
    table = f"new_customers_{spark.sparkContext.applicationId.replace('-', '_').replace('.', '_')}"
    view = write_bucketed(ft.new_customer_view(spark, directory), table, ft.ID, 8)
    return score(view, gs.model(spark, directory), ft.ID)


@query
def split_bucketed(spark: SparkSession, directory: str) -> DataFrame:
    """Data and assignment bucketed alike by the id, joined where they lie."""
    name = spark.sparkContext.applicationId.replace("-", "_").replace(".", "_")
    rows = write_bucketed(gs.feature_table(spark, directory), f"features_{name}", ft.ID, 8)
    parts = write_bucketed(gs.assignment(spark, directory), f"parts_{name}", ft.ID, 8)
    return split(rows, parts, ft.ID, TRAIN)


@query
def bucket_totals(spark: SparkSession, directory: str) -> DataFrame:
    """Rows of a bucketed table by what its files hold: in all, and how many lie in a bucket that is not their hash's."""
    name = spark.sparkContext.applicationId.replace("-", "_").replace(".", "_")
    table = write_bucketed(ft.new_customer_view(spark, directory), f"counted_{name}", ft.ID, 8)
    return bucket_stats(table, ft.ID, 8).agg(
        F.sum("RECORD_COUNT").alias("RECORD_COUNT"), F.sum("STRAYED").alias("STRAYED"), F.max("BUCKET_ID").alias("LAST_BUCKET")
    )


@query
def procedure_score(spark: SparkSession, directory: str) -> DataFrame:
    """The same scores by a plain call and by the table function wrapped around it, where both agree."""
    view = ft.new_customer_view(spark, directory)
    called = routines.scoring_procedure(view, gs.model(spark, directory), ft.ID)
    routines.register_wrapper(spark, "churn_by_procedure", called)
    return called.intersectAll(spark.sql("SELECT * FROM churn_by_procedure()"))


@query
def routine_columns(spark: SparkSession, directory: str) -> DataFrame:
    """What the catalog says of the scoring function's columns, per segment of the customers."""
    tvf_score(spark, directory)
    told = routines.describe_routine(spark, "predict_customer_churn")
    columns = told.agg(F.concat_ws(" ", F.collect_list("function_desc")).alias("text"))
    segments = load(spark, directory, "customer").select("c_mktsegment").distinct()
    return segments.join(columns).select(
        "c_mktsegment",
        *[F.col("text").contains(f"{name} ").alias(f"HAS_{name}") for name in ("ACCOUNTID", "PREDICTION", "PRED_CONFIDENCE")],
    )


@query
def scripted_block(spark: SparkSession, directory: str) -> DataFrame:
    """A script that counts the scores and names those of the larger class.

    What a script selects is held by the driver, so it names a relation instead, which stays lazy.
    """
    register(_new_scores(spark, directory), "block_scores")
    spark.sql("""BEGIN
  DECLARE churned BIGINT;
  DECLARE active BIGINT;
  SET (churned, active) = (SELECT count_if(SCORE = 'Churned'), count_if(SCORE = 'Active') FROM block_scores);
  IF churned >= active THEN
    CREATE OR REPLACE TEMPORARY VIEW block_found AS SELECT AccountID, CONFIDENCE FROM block_scores WHERE SCORE = 'Churned';
  ELSE
    CREATE OR REPLACE TEMPORARY VIEW block_found AS SELECT AccountID, CONFIDENCE FROM block_scores WHERE SCORE = 'Active';
  END IF;
END""")
    return spark.table("block_found")


@query
def empty_copy(spark: SparkSession, directory: str) -> DataFrame:
    """An empty relation like the view is filled with one segment, counted and dropped."""
    view = ft.new_customer_view(spark, directory)
    path = scratch_path(spark, "empty-copy")
    empty = refill(empty_like(view), path)
    before = empty.count()
    filled = append(view.filter(F.col("ServiceType") == "BUILDING"), path)
    register(filled, "empty_copy_view")
    dropped = drop(spark, "empty_copy_view") and not spark.catalog.tableExists("empty_copy_view")
    return filled.groupBy("ServiceName").agg(
        F.count(F.lit(1)).alias("NCOUNT"), F.lit(before).cast("bigint").alias("NBEFORE"), F.lit(dropped).alias("DROPPED")
    )


@query
def account_in_list(spark: SparkSession, directory: str) -> DataFrame:
    """Scores of listed account ids, one of them given as text."""
    ids = load(spark, directory, "orders").select(F.col("o_custkey").alias("id"))
    listed = [ev.single_value(ids.agg(f("id").alias("id")), "id") for f in (F.min, F.max)]
    scored = score(ft.new_customer_view(spark, directory), gs.model(spark, directory), ft.ID)
    return scored.filter(F.col(ft.ID).isin(*listed) | (F.col(ft.ID) == F.lit("7")))


@query
def score_positions(spark: SparkSession, directory: str) -> DataFrame:
    """The order of the sorted report, as positions."""
    placed = positions(_new_scores(spark, directory), "SCORE", [F.desc("CONFIDENCE"), ft.ID])
    return placed.select(ft.ID, "SCORE", "POSITION")


@query
def order_ranks(spark: SparkSession, directory: str) -> DataFrame:
    """Rank and total of every order within its priority, in the order of a seeded hash."""
    orders = load(spark, directory, "orders").select("o_orderkey", "o_orderpriority")
    keyed = orders.withColumn("KEY", shuffle_key("o_orderkey", 11))
    return distributed_rank(keyed, ["o_orderpriority"], "KEY", "o_orderkey").drop("KEY")


@query
def order_folds(spark: SparkSession, directory: str) -> DataFrame:
    """Folds by rank modulo k over all orders."""
    return folds_by_rank(load(spark, directory, "orders"), "o_orderkey", "o_orderpriority", 10, 25)


# ------------------------------------------------------- calls with parameter tables


@query
def partition_thirds(spark: SparkSession, directory: str) -> DataFrame:
    """Three thirds of all orders of each priority, asked by a parameter table."""
    params = fp.Params.of(
        PARTITION_METHOD=1, RANDOM_SEED=11, STRATIFIED_COLUMN="o_orderpriority", TRAINING_PERCENT=1 / 3,
        TESTING_PERCENT=1 / 3, VALIDATION_PERCENT=1 / 3,
    ).to_df(spark)
    orders = load(spark, directory, "orders").select("o_orderkey", "o_orderpriority")
    return calls.partition(orders, params)


@query
def confusion_call(spark: SparkSession, directory: str) -> DataFrame:
    rows = _part_scores(spark, directory).select(ft.ID, "ORIGINAL_LABEL", F.col("SCORE").alias("PREDICTED_LABEL"))
    params = fp.Params.from_arrays(["BETA"], doubles=[2.0]).to_df(spark)
    return _rounded_stats(calls.confusion_matrix(rows, params)[1])


def _late_orders(spark: SparkSession, directory: str) -> DataFrame:
    return load(spark, directory, "orders").select(
        F.when(F.col("o_orderstatus") == "F", ft.POSITIVE).otherwise(ft.NEGATIVE).alias("ORIGINAL_LABEL"),
        (F.col("o_totalprice") / 1000000).alias("P"),
        "o_orderpriority",
    )


#: Pieces of the score range that the queries of pieces ask for, until each holds ROWS_PER_BUCKET rows.
PIECES = 64


def _piece_rows(rows: int) -> int:
    return min(ROWS_PER_BUCKET, max(97, -(-rows // PIECES)))


@query
def auc_pieces(spark: SparkSession, directory: str) -> DataFrame:
    """The area by pieces of the score range smaller than the groups."""
    rows = _late_orders(spark, directory)
    size = _piece_rows(rows.count())
    area = ev.auc(rows, "ORIGINAL_LABEL", "P", ft.POSITIVE, by=("o_orderpriority",), rows_per_bucket=size)
    return area.withColumn("STAT_VALUE", F.round("STAT_VALUE", 6))


@query
def roc_pieces(spark: SparkSession, directory: str) -> DataFrame:
    rows = _late_orders(spark, directory)
    size = _piece_rows(rows.count())
    points = ev.roc_curve(rows, "ORIGINAL_LABEL", "P", ft.POSITIVE, ("o_orderpriority",), rows_per_bucket=size)
    return points.withColumn("FPR", F.round("FPR", 6)).withColumn("TPR", F.round("TPR", 6))


# ------------------------------------------------------- training on the tables


def _stepped(spark: SparkSession, directory: str) -> DataFrame:
    columns = [ft.ID, "ServiceType", "DataUsage_PCT", "DataUsage_PCT_PM", "Revenue_Month_PM", ft.LABEL]
    return ft.with_stepped_label(gs.feature_table(spark, directory)).select(*columns)


def _churn_params(**more) -> dict:
    return {"HAS_ID": 1, "DEPENDENT_VARIABLE": ft.LABEL, "SEED": 2, "THREAD_RATIO": 1.0, **more}


def _forest(spark: SparkSession, directory: str, trees: int, oob: int = 0, depth: int = 5) -> TrainResult:
    params = _churn_params(
        TREES_NUM=trees, TRY_NUM=5, SPLIT_THRESHOLD=1e-5, NODE_SIZE=1, CALCULATE_OOB=oob
    )
    return train_forest(gs.part_of_view(spark, directory, TRAIN), params, max_depth=depth)


@query
def rf_train(spark: SparkSession, directory: str) -> DataFrame:
    rows = _forest(spark, directory, 100).model_rows
    return rows.select("ROW_INDEX", "TREE_INDEX", fc.preview(F.col("MODEL_CONTENT")).alias("MODEL_CONTENT"))


@query
def importance(spark: SparkSession, directory: str) -> DataFrame:
    return _forest(spark, directory, 100).importance


@query
def oob_error(spark: SparkSession, directory: str) -> DataFrame:
    return _forest(spark, directory, 8, oob=1).oob


@query
def bag_counts(spark: SparkSession, directory: str) -> DataFrame:
    """Rows outside each tree's bag, and the rows the bag holds with repetition, for a forest of 100 trees."""
    return bag_counts_of(gs.feature_table(spark, directory), ft.ID, seed=2, trees=100)


@query
def oob_given_trees(spark: SparkSession, directory: str) -> DataFrame:
    """Out-of-bag error of the given trees, up to each of them."""
    train = gs.part_of_view(spark, directory, TRAIN)
    errors = oob_error_of(train, gs.model(spark, directory), ft.ID, ft.LABEL, seed=2)
    return errors.withColumn("OOB_ERROR", F.round("OOB_ERROR", 6))


@query
def rf_score(spark: SparkSession, directory: str) -> DataFrame:
    """A forest on a rule it can express: every account gets the rule's class."""
    view = _stepped(spark, directory)
    params = _churn_params(TREES_NUM=10, TRY_NUM=5, SPLIT_THRESHOLD=1e-5)
    result = train_forest(view, params, max_depth=6)
    return score(view, result.model, ft.ID).select(ft.ID, "SCORE")


@query
def train_cm(spark: SparkSession, directory: str) -> DataFrame:
    """Training matrix of a tree on a rule it can express exactly."""
    return train_tree(_stepped(spark, directory), _churn_params(ALGORITHM=3), max_depth=6).confusion_matrix


@query
def train_cm_grouped(spark: SparkSession, directory: str) -> DataFrame:
    """The same matrix of a forest whose trees travel in groups."""
    view = _stepped(spark, directory)
    params = _churn_params(TREES_NUM=10, TRY_NUM=5, SPLIT_THRESHOLD=1e-5)
    result = train_forest(view, params, max_depth=6)
    result._model = load_model(result.model_rows, broadcast_chars=1)
    return training_matrix(view, result, ft.LABEL)


@query
def dt_score(spark: SparkSession, directory: str) -> DataFrame:
    view = _stepped(spark, directory)
    result = train_tree(view, _churn_params(ALGORITHM=3, MODEL_FORMAT=1), max_depth=6)
    return score(view, result.model, ft.ID)


@query
def gbt_train(spark: SparkSession, directory: str) -> DataFrame:
    params = _churn_params(ITER_NUM=8, MAX_TREE_DEPTH=4, LEARNING_RATE=0.3, ROW_SAMPLE_RATE=0.7)
    return train_boosted(gs.part_of_view(spark, directory, TRAIN), params).model_rows


@query
def gbt_score(spark: SparkSession, directory: str) -> DataFrame:
    view = _stepped(spark, directory)
    params = _churn_params(ITER_NUM=4, MAX_TREE_DEPTH=4, LEARNING_RATE=0.3)
    return score(view, train_boosted(view, params).model, ft.ID).select(ft.ID, "SCORE")


def _wholesale_params(**more) -> dict:
    return {
        "ALGORITHM": 3, "MODEL_FORMAT": 1, "HAS_ID": 1, "DEPENDENT_VARIABLE": "CUSTOMERTYPE",
        "CATEGORICAL_VARIABLE": "CUSTOMERTYPE", "THREAD_RATIO": 0.4, "SEED": 25, **more,
    }


@query
def dt_train(spark: SparkSession, directory: str) -> DataFrame:
    params = _wholesale_params(
        MIN_RECORDS_OF_PARENT=4, MIN_RECORDS_OF_LEAF=3, IS_OUTPUT_RULES=1, IS_OUTPUT_CONFUSION_MATRIX=1
    )
    return train_tree(gs.wholesale_table(spark, directory), params, max_depth=6).rules


@query
def cv_metric(spark: SparkSession, directory: str) -> DataFrame:
    """Cross-validated error and area of a tree on a rule it can express."""
    params = _churn_params(
        ALGORITHM=3, RESAMPLING_METHOD="stratified_cv", EVALUATION_METRIC="AUC", FOLD_NUM=3
    )
    stats = train_tree(_stepped(spark, directory), params, max_depth=6).statistics
    return stats.select("STAT_NAME", F.round(fc.to_double(F.col("STAT_VALUE")), 6).alias("STAT_VALUE"))


@query
def grid_search(spark: SparkSession, directory: str) -> DataFrame:
    params = _wholesale_params(
        MIN_RECORDS_OF_PARENT_VALUES="{3,6}", MIN_RECORDS_OF_LEAF_VALUES="{2,8}",
        SPLIT_THRESHOLD_VALUES="{1e-2, 1e-5}", RESAMPLING_METHOD="stratified_cv",
        EVALUATION_METRIC="AUC", PARAM_SEARCH_STRATEGY="grid", FOLD_NUM=3,
        PROGRESS_INDICATOR_ID="CROSS_VALIDATION",
    )
    return train_tree(gs.wholesale_table(spark, directory), params, max_depth=5).candidates


@query
def cv_search(spark: SparkSession, directory: str) -> DataFrame:
    params = _churn_params(
        FOLD_NUM=3, CV_METRIC="ERROR_RATE", REF_METRIC="AUC", MAX_TREE_DEPTH=3,
        RANGE_ITER_NUM="[2,3,6]", RANGE_LEARNING_RATE="[0.1,2,0.5]", ROW_SAMPLE_RATE=0.7,
    )
    return train_boosted(gs.part_of_view(spark, directory, TRAIN), params).selected_params


def _labelled_part(spark: SparkSession, directory: str, part: int) -> DataFrame:
    rows = gs.part_of_view(spark, directory, part)
    return rows.withColumn("label", (F.col(ft.LABEL) == ft.POSITIVE).cast("double"))


@query
def value_grid(spark: SparkSession, directory: str) -> DataFrame:
    """A listed grid over one given tree: all candidates from one pass over the validation part."""
    parents = fp.parse_values("{1,300,500}")
    thresholds = fp.parse_values("{0.0, 1e-3, 1e-1}")
    variants = [
        {"MIN_RECORDS_OF_PARENT": p, "SPLIT_THRESHOLD": t} for p in parents for t in thresholds
    ]
    model = gs.model(spark, directory, "tree")
    shared = spark.sparkContext.broadcast((model.header, model.trees, variants))
    counts = candidate_counts(
        _labelled_part(spark, directory, VALIDATE), model.header, shared, "tree", list(range(len(variants)))
    )
    metrics = candidate_metrics(counts, ["CANDIDATE"])
    return metrics.select(
        "CANDIDATE", F.round("ERROR_RATE", 6).alias("ERROR_RATE"), F.round("AUC", 6).alias("AUC")
    )


@query
def range_grid(spark: SparkSession, directory: str) -> DataFrame:
    """A range grid over given boosted trees: iterations and learning rate."""
    rows = _labelled_part(spark, directory, VALIDATE)
    iterations = fp.parse_range("[1,3,3]", whole=True)
    counts = None
    for i, rate in enumerate(fp.parse_range("[0.1,3,1.0]")):
        model = gs.model(spark, directory, "boosted", rate)
        variants = [{"ITER_NUM": n} for n in iterations]
        ids = [i * len(iterations) + j for j in range(len(iterations))]
        shared = spark.sparkContext.broadcast((model.header, model.trees, variants))
        found = candidate_counts(rows, model.header, shared, "boosted", ids)
        counts = found if counts is None else counts.unionByName(found)
    # Sums of the same leaves may differ in the last digits; such scores are ties.
    counts = counts.withColumn("SCORE", F.round("SCORE", 9))
    metrics = candidate_metrics(counts, ["CANDIDATE"])
    return metrics.select(
        "CANDIDATE", F.round("ERROR_RATE", 6).alias("ERROR_RATE"), F.round("AUC", 6).alias("AUC")
    )


# -------------------------------------------------------------------- forecasts


def _smoothing_params(spark: SparkSession, adaptive: int = 0) -> DataFrame:
    def rows(group: str, levels: tuple[float, float]) -> list[tuple]:
        values = fp.Params.of(
            ADAPTIVE_METHOD=adaptive, MEASURE_NAME="MSE", ALPHA=0.1, DELTA=0.2, FORECAST_NUM=12,
            EXPOST_FLAG=1, PREDICTION_CONFIDENCE_1=levels[0], PREDICTION_CONFIDENCE_2=levels[1],
        )
        return [(group, *row) for row in values.rows()]

    data = rows("ECONOMY", (0.8, 0.95)) + rows("PROMO", (0.75, 0.8))
    return spark.createDataFrame(data, f"PRODUCT_ID string, {fp.SCHEMA}")


def _smoothed(spark: SparkSession, directory: str, adaptive: int = 0) -> tuple[DataFrame, DataFrame]:
    sales = ft.retail_sales(spark, directory)
    return ses_forecast(sales, "PRODUCT_ID", "DAY", "SALES", _smoothing_params(spark, adaptive))


@query
def ses_forecasts(spark: SparkSession, directory: str) -> DataFrame:
    forecast, _ = _smoothed(spark, directory)
    return forecast.select("PRODUCT_ID", "DAY", F.round("SALES", 4).alias("SALES"))


@query
def ses_intervals(spark: SparkSession, directory: str) -> DataFrame:
    forecast, _ = _smoothed(spark, directory)
    bounds = [f"PI{i}_{side}" for i in (1, 2) for side in ("LOWER", "UPPER")]
    return forecast.filter(F.col("PI1_LOWER").isNotNull()).select(
        "PRODUCT_ID", "DAY", *[F.round(b, 4).alias(b) for b in bounds], "PI1_LEVEL", "PI2_LEVEL"
    )


@query
def ses_stats(spark: SparkSession, directory: str) -> DataFrame:
    _, stats = _smoothed(spark, directory)
    return stats.withColumn("STAT_VALUE", F.round("STAT_VALUE", 4))


@query
def ses_adaptive(spark: SparkSession, directory: str) -> DataFrame:
    forecast, _ = _smoothed(spark, directory, adaptive=1)
    return forecast.select("PRODUCT_ID", "DAY", F.round("SALES", 4).alias("SALES"))


# --------------------------------------------------------------------- payloads


@query
def like_filter(spark: SparkSession, directory: str) -> DataFrame:
    part = load(spark, directory, "part")
    kept = (F.col("p_type") == "PROMO") & ~F.col("p_name").like("%ring%")
    return part.filter(kept).select("p_partkey", "p_name")


@query
def hex_decode(spark: SparkSession, directory: str) -> DataFrame:
    """Whole texts as hexadecimal and back."""
    documents = load(spark, directory, "documents")
    hexed = documents.select("doc_id", fc.bytes_to_hex(F.col("text").cast("binary")).alias("h"))
    data = fc.hex_to_bytes(F.col("h"))
    return hexed.select("doc_id", F.octet_length(data).cast("bigint").alias("N_BYTES"), F.md5(data).alias("MD5"))


@query
def check_models(spark: SparkSession, directory: str) -> DataFrame:
    """Is there a usable model for every payload class and every document source?"""
    vectors = load(spark, directory, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    catalogue = vectors.select(
        F.concat(F.lit("CLASS_"), "label").alias("MODEL_NAME"), (F.col("n") >= 45).alias("AVAILABLE")
    )
    sources = load(spark, directory, "documents").select(F.concat(F.lit("SOURCE_"), "source").alias("MODEL_NAME"))
    requested = sources.distinct().unionByName(catalogue.select("MODEL_NAME"))
    return pl.check_models(requested, catalogue)


def _payloads(spark: SparkSession, directory: str) -> DataFrame:
    return pl.hex_payloads(load(spark, directory, "embeddings"), "vec_id", "embedding")


def _payload_models(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """A catalogue of two models (the class, whether it is odd) and their rows, stored once."""
    vectors = load(spark, directory, "embeddings")
    parity = vectors.withColumn("label", F.col("label") % 2)
    models = snapshot(
        pl.centroid_model(vectors, "label", "embedding", "CLASS").unionByName(
            pl.centroid_model(parity, "label", "embedding", "PARITY")
        ),
        label="payload-models",
    )
    listed = [("CLASS", "nearest_mean", True), ("PARITY", "nearest_mean", True)]
    return spark.createDataFrame(listed, "MODEL_NAME string, LOADER string, AVAILABLE boolean"), models


def _classified(spark: SparkSession, directory: str, *names: str) -> DataFrame:
    catalogue, models = _payload_models(spark, directory)
    images = pl.decode_payloads(_payloads(spark, directory))
    found = pl.classify_by_catalogue(images, "NR", "IMAGE", catalogue, models, names)
    return found.withColumn("SCORE", F.round("SCORE", 5))


@query
def payload_classify(spark: SparkSession, directory: str) -> DataFrame:
    """Every payload by two models of the catalogue, from one read."""
    return _classified(spark, directory, "CLASS", "PARITY")


@query
def payload_parity(spark: SparkSession, directory: str) -> DataFrame:
    """The second model alone: is the class even or odd?"""
    return _classified(spark, directory, "PARITY").drop("MODEL_NAME")
