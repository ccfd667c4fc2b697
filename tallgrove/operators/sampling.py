"""Exact stratified splits and folds."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrove.operators.ordering import distributed_rank, exact_cuts, shuffle_key
from tallgrove.sources.tables import bounded, matching

TRAIN, TEST, VALIDATE = 1, 2, 3


def require_unique(df: DataFrame, id_column: str) -> None:
    """Raise if an id occurs twice; a split by id would then be undefined."""
    twice = df.groupBy(id_column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate id in {id_column}: {twice[0][0]}")


def exact_share(share: float | str | Fraction) -> Fraction:
    """A share as the fraction that was meant: floats by their shortest decimals, unless 1/3 and the like fit better."""
    if isinstance(share, Fraction):
        return share
    exact = Fraction(str(share))
    simple = exact.limit_denominator(1000)
    return simple if abs(simple - exact) < Fraction(1, 10**12) else exact


def rounded_part(share: Fraction) -> str:
    """SQL for ``floor(TOTAL * share + 0.5)`` in whole numbers of up to 38 digits."""
    twice = 2 * share.denominator
    return f"((cast(TOTAL as decimal(18,0)) * {2 * share.numerator}BD + {share.denominator}BD) div {twice}BD)"


def _assign(
    df: DataFrame,
    id_column: str,
    stratify: str | None,
    seed: int,
    quotas: list[str],
    output: str,
    keep: list[str],
) -> DataFrame:
    """``(id, *keep, output)``: the first quota whose last row does not lie before the row.

    The last row of each quota is found first; with those few rows known the
    assignment is a map over ``df``, without a shuffle. Rows beyond the last
    quota are left out.
    """
    stratum = F.col(stratify) if stratify else F.lit(0)
    keyed = df.select(
        F.col(id_column), *keep, stratum.alias("_stratum"), shuffle_key(id_column, seed).alias("_key")
    )
    cuts = bounded(exact_cuts(keyed.drop(*keep), ["_stratum"], "_key", id_column, quotas))
    me = F.struct(keyed["_key"].alias("_key"), keyed[id_column].alias(id_column))
    ahead = F.filter(
        "CUTS", lambda c: F.struct(c["_key"].alias("_key"), c[id_column].alias(id_column)) >= me
    )
    ceiling = F.array_min(F.transform(ahead, lambda c: c["rank"]))
    return (
        keyed.join(cuts, matching(keyed, cuts, ["_stratum"]))
        .select(*[keyed[c] for c in (id_column, *keep)], "QUOTAS", ceiling.alias("_ceiling"))
        .filter(F.col("_ceiling").isNotNull())
        .select(id_column, *keep, (F.size(F.filter("QUOTAS", lambda q: q < F.col("_ceiling"))) + 1).alias(output))
    )


def stratified_partition(
    df: DataFrame,
    id_column: str,
    stratify: str | None,
    shares: tuple[float | Fraction, ...] = (0.6, 0.2, 0.2),
    seed: int = 23,
    check_ids: bool = True,
    keep_columns: bool = False,
) -> DataFrame:
    """``(id, PARTITION_TYPE)`` with 1 = train, 2 = test, 3 = validate.

    A stratum of n rows gives ``floor(n * c + 0.5)`` rows up to each cumulative
    share c, in the order of a seeded hash of the id. NULL is a stratum of its
    own; ``stratify=None`` treats all rows as one. Ids of a view grouped by id
    need no check. ``keep_columns`` adds the part to the rows of ``df`` instead,
    which saves the join that brings assignment and rows together.
    """
    parts = [exact_share(s) for s in shares]
    if any(p < 0 for p in parts) or sum(parts) > 1:
        raise ValueError("shares must be non-negative and add up to at most 1")
    if check_ids:
        require_unique(df, id_column)
    quotas = [rounded_part(sum(parts[: i + 1], Fraction(0))) for i in range(3)]
    keep = [c for c in df.columns if c != id_column] if keep_columns else []
    return _assign(df, id_column, stratify, seed, quotas, "PARTITION_TYPE", keep)


def stratified_folds(
    df: DataFrame,
    id_column: str,
    stratify: str | None,
    k: int,
    seed: int,
    check_ids: bool = True,
    keep_columns: bool = False,
) -> DataFrame:
    """``(id, FOLD)`` with folds 0..k-1 whose sizes per stratum differ by at most one.

    ``keep_columns`` adds the fold to the rows of ``df`` instead.
    """
    if k < 2:
        raise ValueError("at least two folds are needed")
    if check_ids:
        require_unique(df, id_column)
    quotas = [f"(TOTAL * {i}) div {k}" for i in range(1, k + 1)]
    keep = [c for c in df.columns if c != id_column] if keep_columns else []
    folds = _assign(df, id_column, stratify, seed, quotas, "FOLD", keep)
    return folds.withColumn("FOLD", F.col("FOLD") - 1)


def folds_by_rank(df: DataFrame, id_column: str, stratify: str | None, k: int, seed: int, check_ids: bool = True) -> DataFrame:
    """``(id, FOLD)``: every stratum's rows in the order of a seeded hash of the id, dealt to folds 0..k-1 in turn."""
    if k < 2:
        raise ValueError("at least two folds are needed")
    if check_ids:
        require_unique(df, id_column)
    stratum = F.col(stratify) if stratify else F.lit(0)
    keyed = df.select(F.col(id_column), stratum.alias("_stratum"), shuffle_key(id_column, seed).alias("_key"))
    ranked = distributed_rank(keyed, ["_stratum"], "_key", id_column)
    return ranked.select(id_column, ((F.col("RANK") - 1) % k).cast("int").alias("FOLD"))


def split(df: DataFrame, assignment: DataFrame, id_column: str, part: int) -> DataFrame:
    """The rows of ``df`` that were assigned to ``part``."""
    chosen = assignment.filter(F.col("PARTITION_TYPE") == part).select(id_column)
    return df.join(chosen, id_column)
