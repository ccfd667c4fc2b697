"""Cross-validated search over model parameters.

One fit answers many candidates: a tree grown with the loosest limits contains
the trees of all stricter parent sizes and split thresholds, and a boosted model
with the most iterations contains those with fewer. Only what changes the growth
itself (leaf size, learning rate, split loss) needs a fit of its own. Held-out
rows are read once per fit and answered for all its candidates; they reach the
shuffle as counts per (candidate, score).

The counts of a fit are kept in a folder named by the digest of all that they depend on: the rows,
the fold, the parameters and the candidates. A search that is started again with the same
``store`` skips the fits that are finished there.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from hashlib import sha256
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrove.functions.params import Params, parse_range, parse_values, typed_row
from tallgrove.functions.roles import resolve_roles
from tallgrove.operators.evaluation import area
from tallgrove.operators.nodes import export_nodes
from tallgrove.operators.ordering import running_totals
from tallgrove.operators.sampling import stratified_folds
from tallgrove.operators.scoring import Descent, Tree, feature_value, trees_of
from tallgrove.operators.training import DEEPEST, Prepared, boosted_estimator, fit_boosted, prepare, tree_estimator
from tallgrove.sources.model_rows import Header
from tallgrove.sources.tables import scratch_path, snapshot

PARALLEL_FITS = 8  # a single fit waits for the driver between its many small jobs
FOLD = "FOLD"
LARGER_IS_BETTER = {"AUC": True, "ERROR_RATE": False}


def tree_grid(params: Params) -> dict[str, list]:
    """Values per parameter for single trees, in the order they are tried."""
    names = ("MIN_RECORDS_OF_PARENT", "MIN_RECORDS_OF_LEAF", "SPLIT_THRESHOLD")
    return {
        n: parse_values(params[f"{n}_VALUES"]) if f"{n}_VALUES" in params else [params.get(n)] for n in names
    }


def boosted_grid(params: Params) -> dict[str, list]:
    names = ("ITER_NUM", "LEARNING_RATE", "MIN_SPLIT_LOSS")
    return {
        n: parse_range(params[f"RANGE_{n}"], whole=n == "ITER_NUM") if f"RANGE_{n}" in params else [params.get(n)]
        for n in names
    }


def needs_folds(params: Params) -> bool:
    listed = any(name.startswith("RANGE_") or name.endswith("_VALUES") for name in params)
    return listed or params.get("RESAMPLING_METHOD") is not None


def prepare_with_folds(df: DataFrame, params: Params) -> Prepared:
    """Training rows with a stratified fold number."""
    method = params.get("RESAMPLING_METHOD", "stratified_cv")
    if method not in ("cv", "stratified_cv"):
        raise ValueError(f"unknown RESAMPLING_METHOD {method}")
    roles = resolve_roles(df, params)
    if roles.id is None:
        raise ValueError("folds need an id column (HAS_ID = 1)")
    labelled = df.filter(F.col(roles.label).isNotNull())
    stratify = roles.label if method == "stratified_cv" else None
    stored = snapshot(labelled, label="search-rows")  # read for the cuts, the folds and the fits
    folds = stratified_folds(
        stored, roles.id, stratify, params.whole("FOLD_NUM", 5), params.whole("SEED", 0), keep_columns=True
    )
    return prepare(folds, params, extra=(FOLD,), source=stored)


@dataclass
class SearchResult:
    """``candidates``: ``(CANDIDATE, <parameters>, ERROR_RATE, AUC)``; ``best`` a dict."""

    candidates: DataFrame
    best: dict
    metrics: dict

    def selected(self, name_column: str) -> DataFrame:
        rows = [typed_row(n, v) for n, v in self.best.items()]
        return self.candidates.sparkSession.createDataFrame(
            rows, f"{name_column} string, INT_VALUE int, DOUBLE_VALUE double, STRING_VALUE string"
        )

    def statistics(self) -> DataFrame:
        rows = [(n, None if v is None else str(v)) for n, v in self.metrics.items()]
        return self.candidates.sparkSession.createDataFrame(rows, "STAT_NAME string, STAT_VALUE string")


class _Tree:
    """Single trees: candidates of one fit differ in parent size and threshold."""

    grid = staticmethod(tree_grid)
    fit_names = ("MIN_RECORDS_OF_LEAF",)

    @staticmethod
    def estimator(prepared: Prepared, params: Params, grid: dict, fixed: dict, max_depth: int):
        loosest = min(v or 0.0 for v in grid["SPLIT_THRESHOLD"])
        return tree_estimator(
            prepared, Params.of(**{**params, **fixed, "SPLIT_THRESHOLD": float(loosest)}), max_depth
        )

    @staticmethod
    def fit(estimator, rows: DataFrame, header: Header) -> DataFrame:
        return export_nodes(estimator.fit(rows), header, rows.sparkSession)

    @staticmethod
    def answers(header: Header, trees: list[Tree], variants: list[dict]):
        walks = [
            Descent(header, [trees[0].pruned(v["MIN_RECORDS_OF_PARENT"] or 0, v["SPLIT_THRESHOLD"] or 0.0)], "soft")
            for v in variants
        ]
        return lambda rows: np.stack([w.sums(rows) for w in walks], axis=1)


class _Boosted:
    """Boosted trees: candidates of one fit differ in the number of iterations."""

    grid = staticmethod(boosted_grid)
    fit_names = ("LEARNING_RATE", "MIN_SPLIT_LOSS")

    @staticmethod
    def estimator(prepared: Prepared, params: Params, grid: dict, fixed: dict, max_depth: int):
        counts = [v for v in grid["ITER_NUM"] if v is not None]
        most = {"ITER_NUM": max(counts)} if counts else {}
        return boosted_estimator(prepared, Params.of(**{**params, **fixed, **most}))

    @staticmethod
    def fit(estimator, rows: DataFrame, header: Header) -> DataFrame:
        return fit_boosted(estimator, rows, header)[0]

    @staticmethod
    def answers(header: Header, trees: list[Tree], variants: list[dict]):
        walk = Descent(header, trees, "soft")
        margins = range(walk.payload.shape[1])
        roots = [[root for root, tree in zip(walk.roots, trees) if tree.of_class == c] for c in margins]
        stops = [min(v["ITER_NUM"] or len(roots[0]), len(roots[0])) for v in variants]

        def probabilities(rows: pd.DataFrame) -> np.ndarray:
            x = walk.matrix(rows)
            found = []
            for c in margins:
                steps = np.stack([walk.payload[walk.leaves(x, root), c] for root in roots[c]], axis=1)
                found.append(1 / (1 + np.exp(-2 * np.cumsum(steps, axis=1)[:, [s - 1 for s in stops]])))
            if len(found) == 1:
                return np.stack([1 - found[0], found[0]], axis=2)
            alone = np.stack(found, axis=2)
            total = alone.sum(axis=2, keepdims=True)
            return np.divide(alone, total, out=np.full_like(alone, 1 / len(found)), where=total > 0)

        return probabilities


KINDS = {"tree": _Tree, "boosted": _Boosted}


def candidate_counts(
    rows: DataFrame, header: Header, shared, kind: str, ids: list[int]
) -> DataFrame:
    """``(CANDIDATE, SCORE, POSITIVE, WRONG, ROWS)``: all variants of one fit in one pass.

    ``rows`` has the features and ``label``, the index of the true class; ``shared`` is the
    broadcast (header, trees, variants). Batches are counted before the shuffle.
    """
    build = KINDS[kind].answers
    keys = ["CANDIDATE", "SCORE", "POSITIVE", "WRONG"]
    inputs = rows.select("label", *[feature_value(header, name).alias(name) for name, _ in header.features])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        probabilities = build(*shared.value)
        for batch in batches:
            if batch.empty:
                continue
            found = np.asarray(probabilities(batch))
            truth = batch["label"].to_numpy()[:, None]
            # With more than two classes there is no area; one score then suffices.
            value = found[:, :, 1] if found.shape[2] == 2 else np.zeros(found.shape[:2])
            yield pd.DataFrame({
                "CANDIDATE": np.tile(np.array(ids), len(batch)),
                "SCORE": value.ravel(),
                "POSITIVE": np.repeat(truth[:, 0] == 1, len(ids)),
                "WRONG": (found.argmax(axis=2) != truth).ravel(),
            }).groupby(keys, as_index=False).size().rename(columns={"size": "ROWS"})

    counted = inputs.mapInPandas(count, "CANDIDATE int, SCORE double, POSITIVE boolean, WRONG boolean, ROWS long")
    return counted.groupBy(*keys).agg(F.sum("ROWS").alias("ROWS"))


def candidate_metrics(counts: DataFrame, by: list[str], classes: int = 2) -> DataFrame:
    """``(*by, ERROR_RATE, AUC)`` from candidate counts."""
    errors = counts.groupBy(*by).agg(
        (F.sum(F.when(F.col("WRONG"), F.col("ROWS")).otherwise(0)) / F.sum("ROWS")).alias("ERROR_RATE")
    )
    by_score = counts.groupBy(*by, "SCORE").agg(
        F.sum(F.when(F.col("POSITIVE"), F.col("ROWS")).otherwise(0)).alias("p"),
        F.sum(F.when(~F.col("POSITIVE"), F.col("ROWS")).otherwise(0)).alias("n"),
    )
    if classes != 2:
        return errors.withColumn("AUC", F.lit(None).cast("double"))
    areas = area(running_totals(by_score, by, "SCORE", ["p", "n"]), tuple(by))
    return errors.join(areas, by).select(*by, "ERROR_RATE", F.col("STAT_VALUE").alias("AUC"))


def rows_digest(rows: DataFrame) -> str:
    """Of the training rows in any order: their number and two sums of hashes."""
    columns = [c for c in rows.columns if c != "features"]  # the vector is made of the others
    wide = [F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)") for seed in (1, 2)]
    return repr(tuple(rows.agg(F.count(F.lit(1)), *[F.sum(w) for w in wide]).first()))


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether a write to the folder has come to its end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def search(
    prepared: Prepared, params: Params, kind: str, max_depth: int = DEEPEST, store: str | None = None
) -> SearchResult:
    """Try every candidate on every fold and pick the best mean of the chosen metric.

    ``store`` is a folder that all executors reach; fits finished there are not made again, and one that
    was stopped is. Without it results last as long as the run. ``CV_METRIC`` (or ``EVALUATION_METRIC``) selects: AUC is maximised, ERROR_RATE
    minimised, ties go to the earlier candidate. Both metrics are reported.
    """
    spark = prepared.rows.sparkSession
    way = KINDS[kind]
    grid = way.grid(params)
    header = prepared.header(kind)
    metric = params.get("CV_METRIC") or params.get("EVALUATION_METRIC") or "ERROR_RATE"
    if metric not in LARGER_IS_BETTER:
        raise ValueError(f"unknown metric {metric}")
    if metric == "AUC" and len(header.labels) != 2:
        raise ValueError("AUC needs two classes")

    names = list(grid)
    candidates = [dict(zip(names, values)) for values in product(*grid.values())]
    fixed_values = list(product(*[grid[n] for n in way.fit_names]))
    folds = params.whole("FOLD_NUM", 5)
    path = store.rstrip("/") if store else scratch_path(spark, "search")
    shared_by_all = (kind, header.to_json(), sorted(params.items()), max_depth, folds, rows_digest(prepared.rows))

    def run(job: tuple[int, tuple]) -> str:
        fold, values = job
        mine = [i for i, c in enumerate(candidates) if all(c[n] == v for n, v in zip(way.fit_names, values))]
        told = repr((shared_by_all, fold, values, [(i, candidates[i]) for i in mine]))
        folder = f"{path}/fit={sha256(told.encode()).hexdigest()}"  # fits run side by side and must not share a commit
        if finished(spark, folder):
            return folder
        fixed = {n: v for n, v in zip(way.fit_names, values) if v is not None}
        estimator = way.estimator(prepared, params, grid, fixed, max_depth)
        nodes = way.fit(estimator, prepared.rows.filter(F.col(FOLD) != fold), header)
        trees = trees_of(nodes.collect())  # one fit's nodes
        held_out = prepared.rows.filter(F.col(FOLD) == fold)
        shared = spark.sparkContext.broadcast((header, trees, [candidates[i] for i in mine]))
        counts = candidate_counts(held_out, header, shared, kind, mine)
        counts.withColumn(FOLD, F.lit(fold)).write.mode("overwrite").parquet(folder)
        shared.destroy()
        return folder

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        folders = list(pool.map(run, product(range(folds), fixed_values)))

    counts = spark.read.parquet(*folders)
    means = (
        candidate_metrics(counts, ["CANDIDATE", FOLD], len(header.labels))
        .groupBy("CANDIDATE")
        .agg(F.avg("ERROR_RATE").alias("ERROR_RATE"), F.avg("AUC").alias("AUC"))
    )
    kinds = {n: "double" if any(isinstance(v, float) for v in values) else "int" for n, values in grid.items()}
    listed = spark.createDataFrame(
        [
            (i, *[None if v is None else float(v) if kinds[n] == "double" else int(v) for n, v in c.items()])
            for i, c in enumerate(candidates)
        ],
        "CANDIDATE int, " + ", ".join(f"{n} {k}" for n, k in kinds.items()),
    )
    table = snapshot(listed.join(means, "CANDIDATE"), label="candidates")
    ordered = F.desc_nulls_last(metric) if LARGER_IS_BETTER[metric] else F.asc_nulls_last(metric)
    winner = table.orderBy(ordered, "CANDIDATE").first()
    best = {n: winner[n] for n in names if winner[n] is not None}
    return SearchResult(table, best, {m: winner[m] for m in ("ERROR_RATE", "AUC")})
