"""Check SQL for the registered queries, written for DuckDB over the same tables.

The texts share common table expressions but no code with the Spark side.
"""

from __future__ import annotations

import datetime as dt
import math
from statistics import NormalDist

LABELLED, SCORING = "2001-02-01", "2001-08-01"
SUFFIXES = ("", "_PM", "_PPM", "_PPPM")


def _back(day: str, months: int) -> str:
    d = dt.date.fromisoformat(day)
    total = d.year * 12 + d.month - 1 - months
    return f"{total // 12:04d}-{total % 12 + 1:02d}-01"


def _abt(name: str, horizon: str, labelled: bool) -> str:
    columns = []
    for measure, extra in (
        ("DataUsage_PCT", "true"),
        ("VoiceUsage_PCT", "o_orderpriority = '1-URGENT'"),
        ("SMSUsage_PCT", "o_orderstatus = 'P'"),
    ):
        for k in range(3):
            columns.append(f"count(*) FILTER ({_inside(horizon, k)} AND {extra}) AS {measure}{SUFFIXES[k]}")
    for k in range(4):
        columns.append(
            f"round(coalesce(sum(o_totalprice) FILTER ({_inside(horizon, k)}), 0.0), 2) AS Revenue_Month{SUFFIXES[k]}"
        )
    for k in range(3):
        columns.append(
            "round(coalesce(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END)"
            f" FILTER ({_inside(horizon, k)}), 0.0), 6) AS ServiceFailureRate_PCT{SUFFIXES[k]}"
        )
    for k in range(3):
        end = _back(horizon, 6 * k)
        columns.append(
            f"round(coalesce(sum(o_totalprice) FILTER (o_orderdate < TIMESTAMP '{end} 00:00:00'), 0.0), 2)"
            f" AS CustomerLifetimeValue_USD{SUFFIXES[k]}"
        )
    for k in range(3):
        end = _back(horizon, 6 * k)
        columns.append(
            f"greatest(coalesce(date_diff('day', min(o_orderdate)::DATE, DATE '{end}'), 0), 0)::INTEGER"
            f" AS Device_Lifetime{SUFFIXES[k]}"
        )
    if labelled:
        columns.append(
            f"CASE WHEN count(*) FILTER (o_orderdate >= TIMESTAMP '{horizon} 00:00:00') = 0"
            " THEN 'Churned' ELSE 'Active' END AS ContractActivityLABEL"
        )
    listed = ",\n  ".join(columns)
    return f"""{name} AS (
SELECT c_custkey AS AccountID, c_mktsegment AS ServiceType, n_name AS ServiceName,
  max(c_acctbal) AS DataAllowance_MB, c_custkey % 7 AS VoiceAllowance_Minutes,
  c_custkey % 11 AS SMSAllowance_N_Messages,
  {listed}
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN orders ON c_custkey = o_custkey
GROUP BY c_custkey, c_mktsegment, n_name)"""


def _inside(horizon: str, k: int) -> str:
    start, end = _back(horizon, 6 * (k + 1)), _back(horizon, 6 * k)
    return (
        f"o_custkey IS NOT NULL AND o_orderdate >= TIMESTAMP '{start} 00:00:00'"
        f" AND o_orderdate < TIMESTAMP '{end} 00:00:00'"
    )


def _partition(
    name: str, source: str, key: str, stratum: str, seed: int, shares: tuple[int, int, int], column: str
) -> str:
    """Row numbers in the order of a seeded hash, cut at rounded cumulative shares (millionths)."""
    c1, c2, c3 = shares[0], shares[0] + shares[1], sum(shares)
    over = f"PARTITION BY {stratum} " if stratum else ""
    total = f"PARTITION BY {stratum}" if stratum else ""
    return f"""{name} AS (
SELECT {key}, (CASE WHEN r <= (n * {c1} + 500000) // 1000000 THEN 1
  WHEN r <= (n * {c2} + 500000) // 1000000 THEN 2
  WHEN r <= (n * {c3} + 500000) // 1000000 THEN 3 END)::INTEGER AS {column}
FROM (SELECT {key}, row_number() OVER ({over}ORDER BY md5(concat('{seed}:', {key})), {key}) AS r,
  count(*) OVER ({total}) AS n FROM {source})
WHERE r <= (n * {c3} + 500000) // 1000000)"""


ABT = _abt("abt", LABELLED, True)
NEWABT = _abt("newabt", SCORING, False)
PART = _partition("part", "abt", "AccountID", "ContractActivityLABEL", 23, (600000, 200000, 200000), "PARTITION_TYPE")

LEAVES = """
  CASE WHEN Revenue_Month <= 100000 THEN CASE WHEN DataUsage_PCT <= 0 THEN 2 ELSE 3 END
       ELSE CASE WHEN CustomerLifetimeValue_USD <= 1200000 THEN 5 ELSE 6 END END AS l0,
  CASE WHEN CustomerLifetimeValue_USD <= 900000 THEN CASE WHEN Revenue_Month_PM <= 50000 THEN 2 ELSE 3 END
       ELSE CASE WHEN Revenue_Month <= 0 THEN 5 ELSE 6 END END AS l1,
  CASE WHEN ServiceType IN ('BUILDING', 'MACHINERY') THEN CASE WHEN DataUsage_PCT <= 1 THEN 2 ELSE 3 END
       ELSE 4 END AS l2"""

# Class counts per leaf of the three trees, from the training part.
COUNTS = f"""oldleaf AS (SELECT abt.*, {LEAVES} FROM abt),
trainleaf AS (SELECT * FROM oldleaf JOIN part USING (AccountID) WHERE PARTITION_TYPE = 1),
seen AS (
  SELECT 0 AS t, l0 AS l, ContractActivityLABEL AS y FROM trainleaf
  UNION ALL SELECT 1, l1, ContractActivityLABEL FROM trainleaf
  UNION ALL SELECT 2, l2, ContractActivityLABEL FROM trainleaf),
cnt AS (SELECT t, l, count(*) FILTER (y = 'Active') AS c0, count(*) FILTER (y = 'Churned') AS c1
  FROM seen GROUP BY t, l)"""


def _votes(name: str, source: str, extra: str = "") -> str:
    """Hard votes, soft share sum and boosted margin per row of a relation with leaf numbers."""

    def of(t: int, expression: str, default: str) -> str:
        return f"coalesce((SELECT {expression} FROM cnt WHERE t = {t} AND l = l{t}), {default})"

    value = "round((c1 - c0)::DOUBLE / (c0 + c1), 6)"
    hard = " + ".join(of(t, "CASE WHEN c1 > c0 THEN 1 ELSE 0 END", "0") for t in range(3))
    soft = " + ".join(of(t, "c1::DOUBLE / (c0 + c1)", "0.5") for t in range(3))
    m = [of(t, value, "0.0") for t in range(3)]
    return f"""{name} AS (SELECT {source}.*, {hard} AS votes, {soft} AS soft,
  {m[0]} AS m0, {m[1]} AS m1, {m[2]} AS m2 FROM {source}{extra})"""


NEWLEAF = f"newleaf AS (SELECT newabt.*, {LEAVES} FROM newabt)"
HARD = """CASE WHEN votes * 2 > 3 THEN 'Churned' ELSE 'Active' END AS SCORE,
  greatest(votes, 3 - votes) / 3.0::DOUBLE AS CONFIDENCE"""
SECOND = "(1 / (1 + exp(-2 * (m0 + 0.1 * m1 + 0.1 * m2))))"
BOOSTED = f"""CASE WHEN {SECOND} > 0.5 THEN 'Churned' ELSE 'Active' END AS SCORE,
  greatest({SECOND}, 1 - {SECOND}) AS CONFIDENCE"""

BASE = f"WITH {ABT},\n{PART},\n{COUNTS}"
NEW = f"{BASE},\n{NEWABT},\n{NEWLEAF},\n{_votes('newvotes', 'newleaf')}"
OLD = f"""{BASE},
{_votes('oldvotes', 'oldleaf')},
old AS (SELECT oldvotes.*, PARTITION_TYPE, {HARD} FROM oldvotes JOIN part USING (AccountID)),
oldboosted AS (SELECT oldvotes.*, PARTITION_TYPE, {BOOSTED} FROM oldvotes JOIN part USING (AccountID))"""
SCORED = f"{NEW},\nscored AS (SELECT AccountID, {HARD} FROM newvotes)"
PROB = "round(CASE WHEN SCORE = 'Churned' THEN CONFIDENCE ELSE 1 - CONFIDENCE END, 9)"


def _area(source: str, by: str, label: str = "y", score: str = "s") -> str:
    """Exact area per group: every negative counts the positives above it and half its ties."""
    key = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""(SELECT {key}sum(n * (before + p / 2.0))::DOUBLE / nullif(sum(p)::DOUBLE * sum(n), 0) AS AREA
FROM (SELECT {key}s, p, n, coalesce(sum(p) OVER ({part}ORDER BY s DESC
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT {key}{score} AS s, count(*) FILTER ({label} = 'Churned') AS p,
      count(*) FILTER ({label} <> 'Churned') AS n FROM {source} GROUP BY {key}{score})) {group})"""


def _stats(cells: str, by: str = "", beta: float = 1.0) -> str:
    """Per-class statistics from rows (by, a, p) of observed and predicted class."""
    b = by or "1"
    square = beta * beta
    return f"""k AS (SELECT DISTINCT g, c FROM (SELECT {b} AS g, a AS c FROM {cells} UNION SELECT {b}, p FROM {cells})),
pc AS (SELECT g, c, (SELECT count(*) FROM {cells} WHERE {b} = g AND a = c) AS sup,
  (SELECT count(*) FROM {cells} WHERE {b} = g AND p = c) AS pre,
  (SELECT count(*) FROM {cells} WHERE {b} = g AND a = c AND p = c) AS hit FROM k),
tot AS (SELECT g, sum(sup)::DOUBLE AS n, sum(hit)::DOUBLE AS agree, sum(sup::DOUBLE * pre) AS cross_ FROM pc GROUP BY g),
st AS (SELECT g, c AS CLASS, round(hit::DOUBLE / nullif(pre, 0), 6) AS PRECISION,
  round(hit::DOUBLE / nullif(sup, 0), 6) AS RECALL,
  round(CASE WHEN pre > 0 AND sup > 0 THEN {1 + square} * hit
    / nullif({1 + square} * hit + {square} * (sup - hit) + (pre - hit), 0) END, 6) AS FBETA,
  sup::BIGINT AS SUPPORT, round(agree / n, 6) AS ACCURACY,
  round((agree / n - cross_ / (n * n)) / nullif(1 - cross_ / (n * n), 0), 6) AS KAPPA
  FROM pc JOIN tot USING (g))"""


RETAIL = """retail AS (SELECT p_type AS PRODUCT_ID,
  ((year(l_shipdate) - 1995) * 12 + month(l_shipdate))::INTEGER AS DAY, round(sum(l_quantity), 2) AS SALES
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""

WHOLESALE = """wholesale AS (SELECT *, CASE WHEN DETERGENTS + MEATDELI > FRESHPRODUCE + MILK THEN 1 ELSE 2 END AS CUSTOMERTYPE
FROM (SELECT o_custkey AS IDCOL,
  round(sum(CASE WHEN p_type = 'SMALL' THEN l_extendedprice ELSE 0.0 END), 2) AS FRESHPRODUCE,
  round(sum(CASE WHEN p_type = 'MEDIUM' THEN l_extendedprice ELSE 0.0 END), 2) AS MILK,
  round(sum(CASE WHEN p_type = 'LARGE' THEN l_extendedprice ELSE 0.0 END), 2) AS GROCERY,
  round(sum(CASE WHEN p_type = 'STANDARD' THEN l_extendedprice ELSE 0.0 END), 2) AS FROZEN,
  round(sum(CASE WHEN p_type = 'ECONOMY' THEN l_extendedprice ELSE 0.0 END), 2) AS DETERGENTS,
  round(sum(CASE WHEN p_type = 'PROMO' THEN l_extendedprice ELSE 0.0 END), 2) AS MEATDELI
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY o_custkey))"""

LEVELS = {"ECONOMY": (0.8, 0.95), "PROMO": (0.75, 0.8)}


def _z(level: float) -> str:
    return repr(NormalDist().inv_cdf((1 + level) / 2))


SMOOTHED = f"""WITH RECURSIVE {RETAIL},
series AS (SELECT *, row_number() OVER (PARTITION BY PRODUCT_ID ORDER BY DAY) AS i FROM retail
  WHERE PRODUCT_ID IN ('ECONOMY', 'PROMO')),
fit AS (SELECT PRODUCT_ID, i, DAY, SALES, SALES AS f FROM series WHERE i = 1
  UNION ALL SELECT s.PRODUCT_ID, s.i, s.DAY, s.SALES, 0.1 * r.SALES + (1 - 0.1) * r.f
  FROM fit r JOIN series s ON s.PRODUCT_ID = r.PRODUCT_ID AND s.i = r.i + 1),
final AS (SELECT fit.PRODUCT_ID, DAY AS last, 0.1 * SALES + (1 - 0.1) * f AS f, mse FROM fit
  JOIN (SELECT PRODUCT_ID, max(i) AS i, avg((SALES - f) * (SALES - f)) FILTER (i > 1) AS mse
    FROM fit GROUP BY PRODUCT_ID) USING (PRODUCT_ID, i)),
ahead AS (SELECT PRODUCT_ID, (last + h)::INTEGER AS DAY, f, sqrt(mse) * sqrt(1 + (h - 1) * 0.1 * 0.1) AS spread
  FROM final, range(1, 13) AS x(h))"""

ADAPTIVE = f"""WITH RECURSIVE {RETAIL},
series AS (SELECT *, row_number() OVER (PARTITION BY PRODUCT_ID ORDER BY DAY) AS i FROM retail
  WHERE PRODUCT_ID IN ('ECONOMY', 'PROMO')),
fit AS (SELECT PRODUCT_ID, i, DAY, SALES, SALES AS f, 0.0::DOUBLE AS e, 0.0::DOUBLE AS m, 0.1::DOUBLE AS a
    FROM series WHERE i = 1
  UNION ALL SELECT PRODUCT_ID, i, DAY, SALES, a * y + (1 - a) * f, e, m, a FROM (
    SELECT s.PRODUCT_ID, s.i, s.DAY, s.SALES, r.SALES AS y, r.f,
      0.2 * (r.SALES - r.f) + 0.8 * r.e AS e, 0.2 * abs(r.SALES - r.f) + 0.8 * r.m AS m,
      CASE WHEN 0.2 * abs(r.SALES - r.f) + 0.8 * r.m > 0
        THEN abs((0.2 * (r.SALES - r.f) + 0.8 * r.e) / (0.2 * abs(r.SALES - r.f) + 0.8 * r.m)) ELSE r.a END AS a
    FROM fit r JOIN series s ON s.PRODUCT_ID = r.PRODUCT_ID AND s.i = r.i + 1)),
lastrow AS (SELECT * FROM fit JOIN (SELECT PRODUCT_ID, max(i) AS i FROM fit GROUP BY PRODUCT_ID) USING (PRODUCT_ID, i)),
final AS (SELECT PRODUCT_ID, DAY AS last, a2 * SALES + (1 - a2) * f AS f FROM (SELECT *,
    CASE WHEN 0.2 * abs(SALES - f) + 0.8 * m > 0
      THEN abs((0.2 * (SALES - f) + 0.8 * e) / (0.2 * abs(SALES - f) + 0.8 * m)) ELSE a END AS a2 FROM lastrow))"""

# Nodes of the three given trees: counts of a node add up those of its leaves.
NODES = """nodes AS (SELECT t2 AS t, k.node, coalesce(sum(c0), 0) AS c0, coalesce(sum(c1), 0) AS c1 FROM cnt RIGHT JOIN (VALUES
  (0, 0, 2), (0, 0, 3), (0, 0, 5), (0, 0, 6), (0, 1, 2), (0, 1, 3), (0, 4, 5), (0, 4, 6),
  (0, 2, 2), (0, 3, 3), (0, 5, 5), (0, 6, 6),
  (1, 0, 2), (1, 0, 3), (1, 0, 5), (1, 0, 6), (1, 1, 2), (1, 1, 3), (1, 4, 5), (1, 4, 6),
  (1, 2, 2), (1, 3, 3), (1, 5, 5), (1, 6, 6),
  (2, 0, 2), (2, 0, 3), (2, 0, 4), (2, 1, 2), (2, 1, 3), (2, 2, 2), (2, 3, 3), (2, 4, 4)
  ) AS k(t2, node, leaf) ON t = t2 AND l = leaf GROUP BY t2, k.node)"""

RULES = """(VALUES
  (0, 2, 'Revenue_Month <= 100000.0 and DataUsage_PCT <= 0.0'),
  (0, 3, 'Revenue_Month <= 100000.0 and not DataUsage_PCT <= 0.0'),
  (0, 5, 'not Revenue_Month <= 100000.0 and CustomerLifetimeValue_USD <= 1200000.0'),
  (0, 6, 'not Revenue_Month <= 100000.0 and not CustomerLifetimeValue_USD <= 1200000.0'),
  (1, 2, 'CustomerLifetimeValue_USD <= 900000.0 and Revenue_Month_PM <= 50000.0'),
  (1, 3, 'CustomerLifetimeValue_USD <= 900000.0 and not Revenue_Month_PM <= 50000.0'),
  (1, 5, 'not CustomerLifetimeValue_USD <= 900000.0 and Revenue_Month <= 0.0'),
  (1, 6, 'not CustomerLifetimeValue_USD <= 900000.0 and not Revenue_Month <= 0.0'),
  (2, 2, 'ServiceType in {BUILDING, MACHINERY} and DataUsage_PCT <= 1.0'),
  (2, 3, 'ServiceType in {BUILDING, MACHINERY} and not DataUsage_PCT <= 1.0'),
  (2, 4, 'not ServiceType in {BUILDING, MACHINERY}')) AS r(t, l, path)"""

# The first tree with every node's size and gain, for cutting it by a candidate's limits.
GRID = f"""{BASE},
{NODES},
n0 AS (SELECT node, c0, c1, c0 + c1 AS n,
  coalesce(1 - (c0 * c0 + c1 * c1)::DOUBLE / nullif((c0 + c1) * (c0 + c1), 0), 0) AS g
  FROM nodes WHERE t = 0),
gain AS (SELECT p.node, p.n, coalesce(p.g - (a.n * a.g + b.n * b.g) / nullif(p.n, 0), 0) AS gain FROM (VALUES (0, 1, 4), (1, 2, 3), (4, 5, 6))
    AS k(node, l, r) JOIN n0 p ON p.node = k.node JOIN n0 a ON a.node = k.l JOIN n0 b ON b.node = k.r),
cand AS (SELECT (pi * 3 + ti)::INTEGER AS CANDIDATE, p, th FROM (VALUES (0, 1), (1, 300), (2, 500)) AS x(pi, p),
    (VALUES (0, 0.0), (1, 0.001), (2, 0.1)) AS y(ti, th)),
cut AS (SELECT CANDIDATE, node, n < p OR gain < th AS c FROM cand, gain),
val AS (SELECT l0, ContractActivityLABEL AS y FROM oldleaf JOIN part USING (AccountID) WHERE PARTITION_TYPE = 3),
stopped AS (SELECT CANDIDATE, y, CASE WHEN (SELECT c FROM cut WHERE cut.CANDIDATE = cand.CANDIDATE AND node = 0) THEN 0
    WHEN l0 IN (2, 3) AND (SELECT c FROM cut WHERE cut.CANDIDATE = cand.CANDIDATE AND node = 1) THEN 1
    WHEN l0 IN (5, 6) AND (SELECT c FROM cut WHERE cut.CANDIDATE = cand.CANDIDATE AND node = 4) THEN 4
    ELSE l0 END AS node FROM cand, val),
answered AS (SELECT CANDIDATE, y, coalesce(c1::DOUBLE / nullif(n, 0), 0.5) AS s, CASE WHEN c1 > c0 THEN 'Churned' ELSE 'Active' END AS guess
  FROM stopped JOIN n0 USING (node))"""

RANGES = f"""{BASE},
{_votes('oldvotes', 'oldleaf')},
val AS (SELECT m0, m1, m2, ContractActivityLABEL AS y FROM oldvotes JOIN part USING (AccountID) WHERE PARTITION_TYPE = 3),
answered AS (SELECT (ri * 3 + ii)::INTEGER AS CANDIDATE, y,
    round(1 / (1 + exp(-2 * (m0 + CASE WHEN ii >= 1 THEN rate * m1 ELSE 0 END
      + CASE WHEN ii >= 2 THEN rate * m2 ELSE 0 END))), 9) AS s
  FROM val, (VALUES (0, 0.1::DOUBLE), (1, 0.55), (2, 1.0)) AS r(ri, rate), (VALUES (0), (1), (2)) AS i(ii))"""

NEAREST = """WITH vec AS (SELECT vec_id::VARCHAR AS NR, embedding, {label} AS lab FROM embeddings),
item AS (SELECT NR, lab, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM vec),
centre AS (SELECT lab, pos, avg(v) AS c FROM item GROUP BY lab, pos),
dist AS (SELECT NR, centre.lab, sum((v - c) * (v - c)) AS d FROM item JOIN centre USING (pos) GROUP BY NR, centre.lab)
SELECT NR, arg_min(lab, d)::VARCHAR AS LABEL, round(min(d), 5) AS SCORE FROM dist GROUP BY NR"""

# Poisson(1) distribution function, for draws from a hash of seed, tree and id.
CDF = []
for _k in range(12):
    CDF.append((CDF[-1] if CDF else 0.0) + math.exp(-1) / math.factorial(_k))


def _start(at: int) -> str:
    return f"(('0x' || substr(md5(concat('2:', AccountID)), {at}, 8))::BIGINT % 2147483647)"


def _uniform(a: object, b: object) -> str:
    mixed = f"(({_start(1)} * {a}::BIGINT + {b}::BIGINT) % 2147483647)"
    return f"((({mixed} * {mixed} + {_start(9)}) % 2147483647)::DOUBLE / 2147483647.0::DOUBLE)"


def _factors(tree: int) -> tuple[int, int]:
    return pow(48271, tree + 1, 2147483647), pow(69621, tree + 1, 2147483647)


def _draws(uniform: str) -> str:
    cases = " ".join(f"WHEN {uniform} < {bound!r} THEN {k}" for k, bound in enumerate(CDF))
    return f"CASE {cases} ELSE 12 END"


STEPPED = """(SELECT AccountID, CASE WHEN ServiceType IN ('BUILDING', 'MACHINERY') AND DataUsage_PCT <= 0
  THEN 'Churned' ELSE 'Active' END AS SCORE FROM abt)"""

CHURN_COLUMNS = "AccountID, SCORE, CONFIDENCE"


def _all() -> dict[str, str]:
    only_abt = f"WITH {ABT}"
    with_part = f"WITH {ABT},\n{PART}"
    new_scores = f"{SCORED} SELECT {CHURN_COLUMNS} FROM scored"
    boosted_new = f"{NEW} SELECT AccountID, SCORE, round(CONFIDENCE, 6) AS CONFIDENCE FROM (SELECT AccountID, {BOOSTED} FROM newvotes)"
    soft = "CASE WHEN soft / 3 > 0.5 THEN 'Churned' ELSE 'Active' END AS SCORE, greatest(soft / 3, 1 - soft / 3)"
    queries = {
        "abt_features": f"{only_abt} SELECT * FROM abt",
        "abt_view": f"WITH {NEWABT} SELECT * FROM newabt",
        "score_input": f"{with_part} SELECT abt.* EXCLUDE (ContractActivityLABEL) FROM abt JOIN part USING (AccountID) WHERE PARTITION_TYPE = 3",
        "row_counts": f"{only_abt} SELECT count(*) AS NCOUNT FROM abt",
        "wholesale_view": f"WITH {WHOLESALE} SELECT * FROM wholesale",
        "retail_sales": f"WITH {RETAIL} SELECT * FROM retail",
        "stratified_partition": f"{with_part} SELECT * FROM part",
        "partition_2way": f"WITH {WHOLESALE},\n"
        + _partition("p2", "wholesale", "IDCOL", "CUSTOMERTYPE", 23, (700000, 300000, 0), "PARTITION_NUMBER")
        + " SELECT * FROM p2",
        "partition_unstratified": f"{only_abt},\n"
        + _partition("p3", "abt", "AccountID", "", 7, (600000, 200000, 100000), "PARTITION_TYPE")
        + " SELECT * FROM p3",
        "partition_counts": f"{with_part} SELECT PARTITION_TYPE, count(*) AS NCOUNT FROM part GROUP BY 1",
        "partition_label_counts": f"{with_part} SELECT PARTITION_TYPE, ContractActivityLABEL, count(*) AS NCOUNT"
        " FROM abt JOIN part USING (AccountID) GROUP BY 1, 2",
        "stratified_folds": f"""WITH {WHOLESALE} SELECT IDCOL, ((r * 10 + n - 1) // n - 1)::INTEGER AS FOLD
FROM (SELECT IDCOL, row_number() OVER (PARTITION BY CUSTOMERTYPE ORDER BY md5(concat('25:', IDCOL)), IDCOL) AS r,
  count(*) OVER (PARTITION BY CUSTOMERTYPE) AS n FROM wholesale)""",
        "tree_score": new_scores,
        "array_score": new_scores,
        "parallel_score": new_scores,
        "state_score": new_scores,
        "registry_load": new_scores,
        "stream_score": new_scores,
        "ordered_by_score": new_scores,
        "tvf_score": f"{SCORED} SELECT AccountID AS ACCOUNTID, SCORE AS PREDICTION, CONFIDENCE AS PRED_CONFIDENCE FROM scored",
        "score_one": f"""{SCORED} SELECT AccountID AS ACCOUNTID, SCORE AS PREDICTION, CONFIDENCE AS PRED_CONFIDENCE FROM scored
WHERE AccountID = (SELECT o_custkey FROM orders ORDER BY o_totalprice DESC, o_custkey DESC LIMIT 1)""",
        "soft_score": f"{NEW} SELECT AccountID, {soft.replace('greatest', 'round(greatest', 1)}, 6) AS CONFIDENCE FROM newvotes",
        "verbose_score": f"""{NEW} SELECT AccountID, 'Churned' AS SCORE, votes / 3.0::DOUBLE AS CONFIDENCE FROM newvotes
UNION ALL SELECT AccountID, 'Active', (3 - votes) / 3.0::DOUBLE FROM newvotes""",
        "boosted_score": boosted_new,
        "registry_load_boosted": boosted_new,
        "score_counts": f"{SCORED} SELECT SCORE, count(*) AS NCOUNT FROM scored GROUP BY 1",
        "distinct_scores": f"{SCORED} SELECT count(DISTINCT SCORE) AS NSCORES FROM scored",
        "churned_rows": f"{SCORED} SELECT {CHURN_COLUMNS} FROM scored WHERE SCORE = 'Churned'",
        "ordered_by_id": f"{SCORED} SELECT {CHURN_COLUMNS} FROM scored WHERE SCORE = 'Churned'",
        "churned_count": f"{SCORED} SELECT count(*) AS NCOUNT FROM scored WHERE SCORE = 'Churned'",
        "high_conf": f"""{NEW} SELECT AccountID, SCORE, round(CONFIDENCE, 6) AS CONFIDENCE
FROM (SELECT AccountID, {BOOSTED} FROM newvotes) WHERE SCORE = 'Churned' AND CONFIDENCE > 0.55""",
        "to_double": "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS PRICE FROM orders",
        "id_in_list": f"""{SCORED} SELECT AccountID, ServiceName, SCORE, CONFIDENCE FROM scored JOIN
(SELECT AccountID, ServiceName FROM newabt) USING (AccountID)
WHERE ServiceName IN ('NATION_1', 'NATION_4', 'NATION_9', 'NATION_16')""",
        "top_risk": f"""{NEW} SELECT AccountID, round(soft / 3, 6) AS CHURN_PROBABILITY FROM newvotes
ORDER BY 2 DESC, 1 LIMIT 10""",
        "actual_vs_pred": f"""{OLD} SELECT AccountID AS ID, ContractActivityLABEL AS ORIGINAL_LABEL,
SCORE AS PREDICTED_LABEL, CONFIDENCE FROM old WHERE PARTITION_TYPE = 3""",
        "auc_input": f"""{OLD} SELECT AccountID AS ID, ContractActivityLABEL AS ORIGINAL_LABEL, {PROB} AS CHURN_PROBABILITY
FROM old WHERE PARTITION_TYPE = 1""",
        "positive_prob": f"{NEW} SELECT AccountID, round(votes / 3.0::DOUBLE, 6) AS CHURN_PROBABILITY FROM newvotes",
        "compare_results": f"{OLD} SELECT {CHURN_COLUMNS}, ContractActivityLABEL AS ORIGINAL_LABEL FROM old",
        "mismatches": f"""{OLD} SELECT AccountID, SCORE, ContractActivityLABEL AS ORIGINAL_LABEL, PARTITION_TYPE
FROM old WHERE SCORE <> ContractActivityLABEL""",
        "mismatch_count": f"""{OLD} SELECT count(*) AS NROWS, count(*) FILTER (SCORE <> ContractActivityLABEL) AS NMISMATCH
FROM old""",
        "confusion_matrix": f"""{OLD}, c AS (SELECT DISTINCT c FROM (SELECT SCORE AS c FROM old UNION
SELECT ContractActivityLABEL FROM old)) SELECT a.c AS ACTUAL_CLASS, p.c AS PREDICTED_CLASS,
(SELECT count(*) FROM old WHERE ContractActivityLABEL = a.c AND SCORE = p.c) AS COUNT FROM c a, c p""",
        "class_stats": f"""{OLD}, cells AS (SELECT ContractActivityLABEL AS a, SCORE AS p FROM old),
{_stats('cells', beta=2.0)} SELECT CLASS, PRECISION, RECALL, FBETA, SUPPORT, ACCURACY, KAPPA FROM st""",
        "auc": f"""{OLD}, v AS (SELECT ContractActivityLABEL AS y, {PROB} AS s FROM old)
SELECT 'AUC' AS STAT_NAME, round(AREA, 6) AS STAT_VALUE FROM {_area('v', '')}""",
        "auc_many_scores": f"""WITH v AS (SELECT o_orderpriority, o_totalprice / 1000000 AS s,
CASE WHEN o_orderstatus = 'F' THEN 'Churned' ELSE 'Active' END AS y FROM orders)
SELECT o_orderpriority, 'AUC' AS STAT_NAME, round(AREA, 6) AS STAT_VALUE FROM {_area('v', 'o_orderpriority')}""",
        "roc_curve": f"""{OLD}, v AS (SELECT ContractActivityLABEL AS y, {PROB} AS s FROM oldboosted),
g AS (SELECT s, count(*) FILTER (y = 'Churned') AS p, count(*) FILTER (y = 'Active') AS n FROM v GROUP BY s),
w AS (SELECT row_number() OVER (ORDER BY s DESC) AS ID, sum(n) OVER (ORDER BY s DESC) AS cn,
  sum(p) OVER (ORDER BY s DESC) AS cp, sum(n) OVER () AS an, sum(p) OVER () AS ap FROM g)
SELECT ID, round(cn::DOUBLE / an, 6) AS FPR, round(cp::DOUBLE / ap, 6) AS TPR FROM w
UNION ALL SELECT 0, 0.0, 0.0""",
        "quality_by_sample": f"""{OLD}, cells AS (SELECT PARTITION_TYPE AS pt, ContractActivityLABEL AS a, SCORE AS p,
ContractActivityLABEL AS y, {PROB} AS s FROM old WHERE PARTITION_TYPE IN (1, 3)),
{_stats('cells', 'pt')} SELECT g AS PARTITION_TYPE, CLASS, PRECISION, RECALL, ACCURACY, KAPPA, round(AREA, 6) AS AUC
FROM st JOIN {_area('cells', 'pt')} ON g = pt""",
        "model_compare": f"""{OLD}, v AS (SELECT 'RDT' AS MODEL_TYPE, ContractActivityLABEL AS y, {PROB} AS s FROM old
WHERE PARTITION_TYPE = 2 UNION ALL SELECT 'GBDT', ContractActivityLABEL, {PROB} FROM oldboosted WHERE PARTITION_TYPE = 2)
SELECT MODEL_TYPE, 'AUC' AS STAT_NAME, round(AREA, 6) AS STAT_VALUE FROM {_area('v', 'MODEL_TYPE')}""",
        "champion": f"""{OLD}, v AS (SELECT 'RDT' AS MODEL_TYPE, ContractActivityLABEL AS y, {PROB} AS s FROM old
WHERE PARTITION_TYPE = 2 UNION ALL SELECT 'GBDT', ContractActivityLABEL, {PROB} FROM oldboosted WHERE PARTITION_TYPE = 2),
a AS (SELECT * FROM {_area('v', 'MODEL_TYPE')})
SELECT 'CUSTOMER_CHURN' AS MODEL_NAME, 99.9::DOUBLE AS MODEL_VERSION, CASE WHEN (SELECT AREA FROM a WHERE MODEL_TYPE = 'RDT')
> (SELECT AREA FROM a WHERE MODEL_TYPE = 'GBDT') THEN 'RDT' ELSE 'GBDT' END AS MODEL_TYPE""",
        "params_table": f"""WITH {RETAIL}, n AS (SELECT PRODUCT_ID, count(*) AS n FROM retail GROUP BY 1)
SELECT PRODUCT_ID, 'FORECAST_NUM' AS PARAM_NAME, (n % 12)::INTEGER AS INT_VALUE, NULL::DOUBLE AS DOUBLE_VALUE,
NULL::VARCHAR AS STRING_VALUE FROM n
UNION ALL SELECT PRODUCT_ID, 'ALPHA', NULL, round(2.0::DOUBLE / (n + 1), 6), NULL FROM n
UNION ALL SELECT PRODUCT_ID, 'MEASURE_NAME', NULL, NULL, 'MSE' FROM n""",
        "params_unnest": f"""{only_abt} SELECT AccountID, 'DataUsage_PCT' AS PARAM_NAME, DataUsage_PCT::INTEGER AS INT_VALUE,
NULL::DOUBLE AS DOUBLE_VALUE, NULL::VARCHAR AS STRING_VALUE FROM abt
UNION ALL SELECT AccountID, 'Revenue_Month', NULL, Revenue_Month, NULL FROM abt
UNION ALL SELECT AccountID, 'ServiceType', NULL, NULL, ServiceType FROM abt""",
        "chunk_roundtrip": """SELECT doc_id, ((length(text) + 999) // 1000)::BIGINT AS N_PIECES,
least(length(text), 1000)::BIGINT AS LONGEST, md5(text) AS MD5 FROM documents""",
        "model_preview": "SELECT doc_id, md5(substring(text, 1, 1000)) AS PREVIEW_MD5 FROM documents",
        "node_counts": f"""{BASE}, {NODES} SELECT t AS TREE, node AS NODE, c0::BIGINT AS N_ACTIVE, c1::BIGINT AS N_CHURNED
FROM nodes""",
        "tree_rules": f"""{BASE} SELECT r.t AS TREE, r.l AS ROW_INDEX, path || ' => ' ||
CASE WHEN c1 > c0 THEN 'Churned' ELSE 'Active' END AS RULES_CONTENT FROM {RULES} LEFT JOIN cnt ON cnt.t = r.t AND cnt.l = r.l""",
        "registry_versions": """SELECT DISTINCT 'CUSTOMER_CHURN' AS MODEL_NAME, v AS MODEL_VERSION, k AS MODEL_TYPE,
DATE '2024-01-02' AS MODEL_DATE, '03:04:05' AS MODEL_TIME FROM customer, (VALUES (1.1::DOUBLE, 'RDT'), (1.2, 'GBDT')) AS x(v, k)""",
        "append_refill": f"{OLD} SELECT {CHURN_COLUMNS} FROM old WHERE PARTITION_TYPE IN (1, 2)",
        "bag_counts": f"""{only_abt}, f(t, a, b) AS (VALUES {", ".join(str((t, *_factors(t))) for t in range(100))}),
d AS (SELECT t, {_uniform('a', 'b')} AS u FROM abt, f)
SELECT t::INTEGER AS TREE_INDEX, count(*) FILTER (w = 0) AS N_OUTSIDE, sum(w)::BIGINT AS N_DRAWN
FROM (SELECT t, {_draws('u')} AS w FROM d) GROUP BY t""",
        "oob_given_trees": f"""{BASE}, v AS (SELECT ContractActivityLABEL AS y,
{", ".join(f"({_uniform(*_factors(t))} < {CDF[0]!r})::INTEGER AS o{t}" for t in range(3))},
{", ".join(f"coalesce((SELECT (c1 > c0)::INTEGER FROM cnt WHERE t = {t} AND l = l{t}), 0) AS v{t}" for t in range(3))}
FROM trainleaf), u AS (
SELECT 0 AS t, y, o0 AS o, o0 * v0 AS p FROM v UNION ALL SELECT 1, y, o0 + o1, o0 * v0 + o1 * v1 FROM v
UNION ALL SELECT 2, y, o0 + o1 + o2, o0 * v0 + o1 * v1 + o2 * v2 FROM v)
SELECT t::INTEGER AS TREE_INDEX, round(avg(CASE WHEN (2 * p > o) <> (y = 'Churned') THEN 1.0 ELSE 0.0 END), 6) AS OOB_ERROR
FROM u WHERE o > 0 GROUP BY t""",
        "rf_score": f"{only_abt} SELECT * FROM {STEPPED}",
        "gbt_score": f"{only_abt} SELECT * FROM {STEPPED}",
        "dt_score": f"{only_abt} SELECT *, 1.0::DOUBLE AS CONFIDENCE FROM {STEPPED}",
        "train_cm": f"""{only_abt}, y AS (SELECT * FROM {STEPPED}), c AS (SELECT DISTINCT SCORE AS c FROM y)
SELECT a.c AS ACTUAL_CLASS, p.c AS PREDICTED_CLASS,
(SELECT count(*) FROM y WHERE SCORE = a.c AND a.c = p.c) AS COUNT FROM c a, c p""",
        "cv_metric": f"""{only_abt}, y AS (SELECT * FROM {STEPPED})
SELECT 'ERROR_RATE' AS STAT_NAME, CASE WHEN count(*) > 0 THEN 0.0::DOUBLE END AS STAT_VALUE FROM y
UNION ALL SELECT 'AUC', CASE WHEN count(DISTINCT SCORE) = 2 THEN 1.0::DOUBLE END FROM y""",
        "value_grid": f"""{GRID} SELECT e.CANDIDATE, round(ERROR_RATE, 6) AS ERROR_RATE, round(AREA, 6) AS AUC
FROM (SELECT CANDIDATE, avg(CASE WHEN guess <> y THEN 1.0 ELSE 0.0 END) AS ERROR_RATE FROM answered GROUP BY 1) e
JOIN {_area('answered', 'CANDIDATE')} a ON a.CANDIDATE = e.CANDIDATE""",
        "range_grid": f"""{RANGES} SELECT e.CANDIDATE, round(ERROR_RATE, 6) AS ERROR_RATE, round(AREA, 6) AS AUC
FROM (SELECT CANDIDATE, avg(CASE WHEN (s > 0.5) <> (y = 'Churned') THEN 1.0 ELSE 0.0 END) AS ERROR_RATE FROM answered GROUP BY 1) e
JOIN {_area('answered', 'CANDIDATE')} a ON a.CANDIDATE = e.CANDIDATE""",
        "ses_forecast": f"""{SMOOTHED} SELECT PRODUCT_ID, DAY, round(f, 4) AS SALES FROM fit WHERE i > 1
UNION ALL SELECT PRODUCT_ID, DAY, round(f, 4) FROM ahead""",
        "ses_intervals": f"""{SMOOTHED}, z(PRODUCT_ID, l1, l2, z1, z2) AS (VALUES {', '.join(
            f"('{k}', {a}::DOUBLE, {b}::DOUBLE, {_z(a)}::DOUBLE, {_z(b)}::DOUBLE)" for k, (a, b) in LEVELS.items())})
SELECT PRODUCT_ID, DAY, round(f - z1 * spread, 4) AS PI1_LOWER, round(f + z1 * spread, 4) AS PI1_UPPER,
round(f - z2 * spread, 4) AS PI2_LOWER, round(f + z2 * spread, 4) AS PI2_UPPER, l1 AS PI1_LEVEL, l2 AS PI2_LEVEL
FROM ahead JOIN z USING (PRODUCT_ID)""",
        "ses_stats": f"{SMOOTHED} SELECT PRODUCT_ID, 'MSE' AS STAT_NAME, round(mse, 4) AS STAT_VALUE FROM final",
        "ses_adaptive": f"""{ADAPTIVE} SELECT PRODUCT_ID, DAY, round(f, 4) AS SALES FROM fit WHERE i > 1
UNION ALL SELECT PRODUCT_ID, (last + h)::INTEGER, round(f, 4) FROM final, range(1, 13) AS x(h)""",
        "like_filter": "SELECT p_partkey, p_name FROM part WHERE p_type = 'PROMO' AND p_name NOT LIKE '%ring%'",
        "hex_decode": "SELECT doc_id, strlen(text)::BIGINT AS N_BYTES, md5(text) AS MD5 FROM documents",
        "check_models": """SELECT 'CLASS_' || label AS MODEL_NAME, CASE WHEN count(*) >= 45 THEN '0' ELSE '1' END AS "Code",
CASE WHEN count(*) >= 45 THEN 'OK' ELSE 'model is registered but not available' END AS "Longtext"
FROM embeddings GROUP BY label UNION ALL
SELECT DISTINCT 'SOURCE_' || source, '2', 'model is not registered' FROM documents""",
        "payload_classify": f"""SELECT 'CLASS' AS MODEL_NAME, * FROM ({NEAREST.format(label="label")})
UNION ALL SELECT 'PARITY', * FROM ({NEAREST.format(label="label % 2")})""",
        "payload_parity": NEAREST.format(label="label % 2"),
    }
    queries["score_grouped"] = f"{new_scores} UNION ALL SELECT {CHURN_COLUMNS} FROM scored"
    queries["score_bucketed"] = new_scores
    queries["procedure_score"] = queries["tvf_score"]
    queries["routine_columns"] = """SELECT DISTINCT c_mktsegment, true AS "HAS_ACCOUNTID", true AS "HAS_PREDICTION",
true AS "HAS_PRED_CONFIDENCE" FROM customer"""
    queries["scripted_block"] = f"""{SCORED} SELECT AccountID, CONFIDENCE FROM scored WHERE SCORE = (
SELECT SCORE FROM scored GROUP BY 1 ORDER BY count(*) DESC, SCORE DESC LIMIT 1)"""
    queries["empty_copy"] = f"""WITH {NEWABT} SELECT ServiceName, count(*) AS NCOUNT, 0::BIGINT AS NBEFORE, true AS DROPPED
FROM newabt WHERE ServiceType = 'BUILDING' GROUP BY 1"""
    queries["account_in_list"] = f"""{new_scores} WHERE AccountID = 7
OR AccountID = (SELECT min(o_custkey) FROM orders) OR AccountID = (SELECT max(o_custkey) FROM orders)"""
    queries["score_positions"] = f"""{SCORED} SELECT AccountID, SCORE,
row_number() OVER (PARTITION BY SCORE ORDER BY CONFIDENCE DESC, AccountID) AS POSITION FROM scored"""
    queries["partition_thirds"] = """SELECT o_orderkey,
(CASE WHEN r <= (2 * n + 3) // 6 THEN 1 WHEN r <= (4 * n + 3) // 6 THEN 2 ELSE 3 END)::INTEGER AS PARTITION_TYPE
FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(concat('11:', o_orderkey)), o_orderkey) AS r,
  count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)"""
    queries["order_ranks"] = """SELECT o_orderkey, o_orderpriority,
row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(concat('11:', o_orderkey)), o_orderkey) AS "RANK",
count(*) OVER (PARTITION BY o_orderpriority) AS TOTAL FROM orders"""
    queries["order_folds"] = """SELECT o_orderkey, ((row_number() OVER (
PARTITION BY o_orderpriority ORDER BY md5(concat('25:', o_orderkey)), o_orderkey) - 1) % 10)::INTEGER AS FOLD FROM orders"""
    queries["bucket_totals"] = f"SELECT count(*) AS RECORD_COUNT, 0::BIGINT AS STRAYED, 7 AS LAST_BUCKET FROM ({new_scores})"
    queries["confusion_call"] = queries["class_stats"]
    queries["auc_pieces"] = queries["auc_many_scores"]
    queries["roc_pieces"] = """WITH g AS (SELECT o_orderpriority AS k, o_totalprice / 1000000 AS s,
  count(*) FILTER (o_orderstatus = 'F') AS p, count(*) FILTER (o_orderstatus <> 'F') AS n FROM orders GROUP BY 1, 2),
w AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY s DESC) AS ID, sum(n) OVER (PARTITION BY k ORDER BY s DESC) AS cn,
  sum(p) OVER (PARTITION BY k ORDER BY s DESC) AS cp, sum(n) OVER (PARTITION BY k) AS an, sum(p) OVER (PARTITION BY k) AS ap FROM g)
SELECT k AS o_orderpriority, ID, round(cn::DOUBLE / an, 6) AS FPR, round(cp::DOUBLE / ap, 6) AS TPR FROM w
UNION ALL SELECT DISTINCT k, 0, 0.0, 0.0 FROM g"""
    queries["train_cm_grouped"] = queries["train_cm"]
    for name, part in (("split_train", 1), ("split_test", 2), ("split_val", 3)):
        queries[name] = f"{with_part} SELECT abt.* FROM abt JOIN part USING (AccountID) WHERE PARTITION_TYPE = {part}"
    queries["scripted_champion"] = queries["champion"]
    queries["boosted_verbose"] = f"""{NEW}, b AS (SELECT AccountID, {BOOSTED} FROM newvotes)
SELECT AccountID, SCORE, round(CONFIDENCE, 6) AS CONFIDENCE, 'string' AS KIND FROM b
UNION ALL SELECT AccountID, CASE SCORE WHEN 'Churned' THEN 'Active' ELSE 'Churned' END, round(1 - CONFIDENCE, 6), 'string' FROM b"""
    queries["stream_latest"] = f"""{SCORED}, b AS (SELECT AccountID, {BOOSTED} FROM newvotes)
SELECT AccountID, SCORE, round(CONFIDENCE, 6) AS CONFIDENCE, 1.0::DOUBLE AS MODEL_VERSION, 'RDT' AS MODEL_TYPE
FROM scored WHERE AccountID % 2 = 0
UNION ALL SELECT AccountID, SCORE, round(CONFIDENCE, 6), 2.0, 'GBDT' FROM b WHERE AccountID % 2 = 1"""
    margins = """WITH m AS (SELECT c_custkey,
  CASE WHEN c_acctbal <= 3000 THEN -0.8 ELSE 0.9 END + 0.3 * CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 0.3 ELSE -0.2 END AS g,
  CASE WHEN c_acctbal <= 6000 THEN 0.5 ELSE -0.6 END + 0.3 * CASE WHEN c_nationkey <= 12 THEN 0.25 ELSE -0.15 END AS p,
  CASE WHEN c_acctbal <= 0 THEN 1.1 ELSE -0.7 END + 0.3 * CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 0.4 ELSE -0.1 END AS r FROM customer),
a AS (SELECT c_custkey, x.k AS SCORE, 1 / (1 + exp(-2 * x.v::DOUBLE)) AS alone
  FROM (SELECT c_custkey, unnest([{'k': 'gold', 'v': g}, {'k': 'plain', 'v': p}, {'k': 'risk', 'v': r}]) AS x FROM m)),
s AS (SELECT c_custkey, SCORE, round(alone / sum(alone) OVER (PARTITION BY c_custkey), 6) AS CONFIDENCE FROM a)"""
    queries["boosted_classes"] = f"{margins} SELECT * FROM s"
    queries["boosted_class_score"] = f"""{margins} SELECT * FROM s
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY CONFIDENCE DESC, SCORE) = 1"""
    queries["split_bucketed"] = queries["split_train"]
    return queries


ORACLE = _all()
