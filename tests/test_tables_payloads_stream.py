from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tallgrove.functions import columns as fc
from tallgrove.operators import payloads as pl
from tallgrove.operators import scoring as sc
from tallgrove.operators.training import train_tree
from tallgrove.sources import features as ft
from tallgrove.sources import tables as tb
from tallgrove.sources.model_rows import chunk, unchunk
from tallgrove.sources.registry import Registry
from tallgrove.streaming.scoring import read_feature_stream, read_scores, score_stream, write_latest_scores, write_scores


def test_empty_like_has_the_schema_and_no_rows(churn):
    empty = tb.empty_like(churn)
    assert empty.schema == churn.schema and empty.isEmpty()


def test_register_and_drop(spark):
    tb.register(spark.range(3), "three")
    assert spark.sql("SELECT count(*) FROM three").first()[0] == 3
    assert tb.drop(spark, "three") and not tb.drop(spark, "three")


def test_snapshot_is_stable(spark):
    df = spark.range(100).withColumn("r", F.rand())
    stored = tb.snapshot(df)
    assert sorted(stored.collect()) == sorted(stored.collect())
    assert stored.dtypes == df.dtypes


class FakeSession:
    """Just enough of a session to ask for a scratch path."""

    def __init__(self, configured, master):
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}
        self.sparkContext, self.master, self.folder = self, master, None
        self.applicationId = "app-1"

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_uses_the_configured_folder(spark):
    assert tb.scratch_path(FakeSession("hdfs://x/ck/", "yarn"), "a").startswith("hdfs://x/ck/tallgrove/app-1/a-")
    local = FakeSession(None, "local[2]")
    first, second = tb.scratch_path(local, "a"), tb.scratch_path(local, "a")
    assert first != second and first.startswith(local.folder) and second.startswith(local.folder)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tb.scratch_path(FakeSession(None, "spark://host:7077"), "a")
    assert tb.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir", ""))


def test_bounded_switches_to_a_stored_table(spark):
    df = spark.range(50).selectExpr("id", "array(id, id + 1) AS a")
    small, large = tb.bounded(df), tb.bounded(df, max_rows=10)
    assert "LocalTableScan" in small._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in large._jdf.queryExecution().executedPlan().toString().lower()
    assert sorted(small.collect()) == sorted(large.collect()) == sorted(df.collect())


def test_bucketed_tables_join_without_a_shuffle(spark, churn):
    left = tb.write_bucketed(churn.select(ft.ID, "ServiceType"), "left_accounts", ft.ID, 8)
    right = tb.write_bucketed(churn.select(ft.ID, "Revenue_Month"), "right_accounts", ft.ID, 8)
    joined = left.hint("merge").join(right, ft.ID)
    assert joined.count() == churn.count()
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()


def test_partition_stats_cover_all_rows(churn):
    stats = tb.partition_stats(tb.hash_partitioned(churn, ft.ID, 8)).collect()
    assert len(stats) == 8 and sum(r["RECORD_COUNT"] for r in stats) == churn.count()


def test_chunks(spark):
    texts = ["", "a", "é" * 10, "abcdefghij" * 7 + "xyz"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    pieces = chunk(df, ["id"], "t", 10)
    assert pieces.agg(F.max(F.length("CONTENT"))).first()[0] == 10
    back = {r["id"]: r["TEXT"] for r in unchunk(pieces.repartition(5), ["id"]).collect()}
    assert back == dict(enumerate(texts))


def test_text_numbers(spark):
    df = spark.createDataFrame([("0.9",), ("1",), ("1e-3",), ("n/a",)], "t string")
    assert [r[0] for r in df.select(fc.to_double(F.col("t"))).collect()] == [0.9, 1.0, 0.001, None]


def test_feature_views_keep_customers_without_orders(spark):
    customer = spark.createDataFrame(
        [(1, 0, 10.0, "BUILDING"), (2, 0, 5.0, "HOUSEHOLD")],
        "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string",
    )
    nation = spark.createDataFrame([(0, "N")], "n_nationkey int, n_name string")
    orders = spark.sql("""
        SELECT * FROM VALUES (1L, 'F', 100.0D, timestamp_ntz'2001-01-31 00:00:00', '1-URGENT'),
          (1L, 'P', 50.0D, timestamp_ntz'2000-08-01 00:00:00', '5-LOW'),
          (1L, 'O', 7.0D, timestamp_ntz'2000-07-31 00:00:00', '5-LOW'),
          (1L, 'O', 1.0D, timestamp_ntz'2001-02-01 00:00:00', '5-LOW')
        AS t(o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)""")
    view = {r[ft.ID]: r for r in ft.churn_features(customer, nation, orders, "2001-02-01", True).collect()}
    one, two = view[1], view[2]
    assert (one["DataUsage_PCT"], one["VoiceUsage_PCT"], one["SMSUsage_PCT"]) == (2, 1, 1)
    assert (one["Revenue_Month"], one["Revenue_Month_PM"], one["ServiceFailureRate_PCT"]) == (150.0, 7.0, 0.5)
    assert (one["CustomerLifetimeValue_USD"], one["Device_Lifetime"]) == (157.0, 185)
    assert one[ft.LABEL] == "Active" and two[ft.LABEL] == "Churned"
    assert two["Revenue_Month"] == 0.0 and two["Device_Lifetime"] == 0


def test_orders_are_aggregated_before_the_join(spark):
    plan = ft.churn_view(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    join, aggregate = plan.index("Join LeftOuter"), plan.index("Aggregate")
    assert join < aggregate  # printed from the top


def test_payload_round_trip_and_nearest_class(spark):
    data = [(i, [float(i % 3) * 5 + 0.25 * d for d in range(4)], i % 3) for i in range(30)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    images = pl.hex_payloads(df, "vec_id", "embedding")
    decoded = {r["NR"]: np.frombuffer(r["IMAGE"], dtype="<f4").tolist() for r in pl.decode_payloads(images).collect()}
    assert decoded == {str(i): v for i, v, _ in data}
    model = pl.centroid_model(df, "label", "embedding", "M")
    found = pl.classify_payloads(pl.decode_payloads(images), "NR", "IMAGE", model).collect()
    assert all(r["LABEL"] == str(int(r["NR"]) % 3) and r["SCORE"] == pytest.approx(0) for r in found)


def test_catalogue_names_loaders(spark):
    data = [(i, [float(i % 3) * 5 + 0.25 * d for d in range(4)], i % 3) for i in range(30)] + [(30, None, 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    low = df.withColumn("label", F.col("label") == 0)
    models = pl.centroid_model(df, "label", "embedding", "A").unionByName(pl.centroid_model(low, "label", "embedding", "B"))
    rows = [("A", "nearest_mean", True), ("B", "nearest_mean", True), ("C", "nearest_mean", False), ("D", "other", True)]
    catalogue = spark.createDataFrame(rows, "MODEL_NAME string, LOADER string, AVAILABLE boolean")
    images = pl.decode_payloads(pl.hex_payloads(df, "vec_id", "embedding"))
    found = pl.classify_by_catalogue(images, "NR", "IMAGE", catalogue, models, ["A", "B"])
    got = {(r["NR"], r["MODEL_NAME"]): (r["LABEL"], r["SCORE"]) for r in found.collect()}
    assert len(got) == 62 and got["30", "A"] == got["30", "B"] == (None, None)
    assert all(got[str(i), "A"] == (str(i % 3), 0.0) for i in range(30))
    assert all(got[str(i), "B"][0] == ("true" if i % 3 == 0 else "false") for i in range(30))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and plan.count("ArrowEvalPython") <= 2  # one turns numbers to bytes, one asks both models
    for name, message in (("C", "not available"), ("D", "no loader"), ("E", "not registered")):
        with pytest.raises(ValueError, match=message):
            pl.classify_by_catalogue(images, "NR", "IMAGE", catalogue, models, [name])


def test_payload_classes_match_numpy(spark):
    vectors = tb.load(spark, SMALL, "embeddings")
    model = pl.centroid_model(vectors, "label", "embedding", "M")
    images = pl.decode_payloads(pl.hex_payloads(vectors, "vec_id", "embedding"))
    got = {int(r["NR"]): r["LABEL"] for r in pl.classify_payloads(images, "NR", "IMAGE", model).collect()}
    plain = vectors.toPandas()
    data = np.stack(plain["embedding"]).astype(float)
    labels = sorted(plain["label"].unique(), key=str)
    centres = np.stack([data[plain["label"] == c].mean(axis=0) for c in labels])
    nearest = ((data[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
    assert got == {int(v): str(labels[k]) for v, k in zip(plain["vec_id"], nearest)}


def test_model_check(spark):
    catalogue = spark.createDataFrame([("A", True), ("B", False)], "MODEL_NAME string, AVAILABLE boolean")
    requested = spark.createDataFrame([("A",), ("B",), ("C",)], "MODEL_NAME string")
    got = {r["MODEL_NAME"]: (r["Code"], r["Longtext"]) for r in pl.check_models(requested, catalogue).collect()}
    assert got == {"A": pl.AVAILABLE, "B": pl.UNAVAILABLE, "C": pl.UNKNOWN}


def test_stream_scores_equal_batch_scores(spark, churn, forest, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    view = churn.drop(ft.LABEL)
    view.repartition(6).write.parquet(source)
    for _ in range(2):  # the second run resumes from the checkpoint
        stream = read_feature_stream(spark, source, view.schema, files_per_trigger=2)
        write_scores(score_stream(stream, forest.model, ft.ID), sink, state).awaitTermination()
        got = spark.read.parquet(sink).toPandas().sort_values(ft.ID, ignore_index=True)
        batch = sc.score(view, forest.model, ft.ID).toPandas().sort_values(ft.ID, ignore_index=True)
        pd.testing.assert_frame_equal(got, batch)
        view = view.withColumn(ft.ID, F.col(ft.ID) + 100_000).unionByName(view) if _ == 0 else view
        if _ == 0:
            view.filter(F.col(ft.ID) >= 100_000).write.mode("append").parquet(source)


def test_stream_takes_the_latest_model(spark, churn, forest, tmp_path):
    """Each batch is scored by the version there is when it begins; a repeated batch replaces its own rows."""
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    view = churn.drop(ft.LABEL)
    registry = Registry.create(spark, str(tmp_path / "registry"))
    assert registry.latest("M") is None
    other = train_tree(churn, {"HAS_ID": 1, "DEPENDENT_VARIABLE": ft.LABEL, "ALGORITHM": 3}, max_depth=1)

    def run(times: int = 1):
        for _ in range(times):
            stream = read_feature_stream(spark, source, view.schema)
            write_latest_scores(stream, registry, "M", ft.ID, sink, state).awaitTermination()

    registry.save("M", 2.0, "RDT", forest.model_rows)
    registry.save("OTHER", 9.0, "DT", other.model_rows)
    view.filter(F.col(ft.ID) % 2 == 0).write.parquet(source)
    run(2)
    registry.save("M", 10.0, "DT", other.model_rows)
    assert registry.latest("M") == (10.0, "DT") and registry.latest("M", "RDT") == (2.0, "RDT")
    view.filter(F.col(ft.ID) % 2 == 1).write.mode("append").parquet(source)
    run()
    (tmp_path / "state" / "commits" / "1").unlink()  # as if the run had ended before the commit
    (tmp_path / "state" / "commits" / ".1.crc").unlink(missing_ok=True)
    run()
    got = read_scores(spark, sink).drop("batch").toPandas().sort_values(ft.ID, ignore_index=True)
    old = sc.score(view.filter(F.col(ft.ID) % 2 == 0), forest.model, ft.ID).withColumn("MODEL_VERSION", F.lit(2.0))
    new = sc.score(view.filter(F.col(ft.ID) % 2 == 1), other.model, ft.ID).withColumn("MODEL_VERSION", F.lit(10.0))
    wanted = old.unionByName(new).toPandas().sort_values(ft.ID, ignore_index=True)
    pd.testing.assert_frame_equal(got.drop(columns="MODEL_TYPE"), wanted)
