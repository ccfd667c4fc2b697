"""Scoring as SQL table functions, and models kept ready under a state id."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrove.functions.params import Params
from tallgrove.operators.scoring import Model, load_model, score


@dataclass(frozen=True)
class ModelHandle:
    state_id: str
    description: str
    model: Model
    session: SparkSession


# Models of this driver by state id; each belongs to the session that loaded it, and executors
# hold their broadcasts until the state is dropped.
_states: dict[str, ModelHandle] = {}


def load_state(rows: DataFrame, params: Params | DataFrame | dict) -> ModelHandle:
    """Parse a model once and keep it; scoring by its id needs no model rows."""
    description = Params.read(params, "state").get("STATE_DESCRIPTION") or ""
    model = load_model(rows)
    text = repr((description, model.header, [(t.weight, t.nodes) for t in model.trees]))
    handle = ModelHandle(hashlib.md5(text.encode()).hexdigest().upper(), description, model, rows.sparkSession)
    if handle.state_id in _states:
        _states[handle.state_id].model.release()
    _states[handle.state_id] = handle
    return handle


def states(spark: SparkSession) -> DataFrame:
    """``(STATE_ID, DESCRIPTION)`` of the models kept in this session."""
    rows = [(h.state_id, h.description) for h in _states.values() if h.session is spark]
    return spark.createDataFrame(rows, "STATE_ID string, DESCRIPTION string")


def find_state(description: str) -> ModelHandle:
    found = [h for h in _states.values() if h.description == description]
    if len(found) != 1:
        raise ValueError(f"{len(found)} model states are described as {description!r}")
    return found[0]


def drop_state(state_id: str) -> None:
    """Forget a model and take its broadcasts back."""
    _states.pop(state_id).model.release()


def score_with_params(
    df: DataFrame, model_rows: DataFrame | None, params: Params | DataFrame | dict, id_column: str, **options
) -> DataFrame:
    """Score as a parameter table asks: ``STATE_ID`` takes a kept model, else the rows."""
    params = Params.read(params, "score")
    state = params.get("STATE_ID")
    if state is not None:
        if state not in _states:
            raise ValueError(f"no model state {state}")
        model = _states[state].model
    else:
        model = load_model(model_rows)
    return score(df, model, id_column, verbose=params.whole("VERBOSE", 0) == 1, **options)


def register_scoring_tvf(
    spark: SparkSession,
    name: str,
    source_view: str,
    model: Model | DataFrame,
    id_column: str,
    arg: str | None = None,
    vote: str = "hard",
) -> None:
    """Create ``name()`` or ``name(arg)`` returning (ACCOUNTID, PREDICTION, PRED_CONFIDENCE).

    The function is SQL over the view of the source's scores, so it is the same scoring as
    ``score()`` for every model, size and NULL. Spark inlines it, and the argument becomes a
    filter on the id that moves below the scoring to the scan.
    """
    scored = scoring_procedure(spark.table(source_view), model, id_column, vote)
    scored.createOrReplaceTempView(f"{name}_scores")
    id_type = scored.schema["ACCOUNTID"].dataType.simpleString()
    where = f"WHERE ACCOUNTID = {name}.{arg}" if arg else ""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}({f'{arg} {id_type}' if arg else ''})
        RETURNS TABLE (ACCOUNTID {id_type}, PREDICTION STRING, PRED_CONFIDENCE DOUBLE)
        RETURN SELECT ACCOUNTID, PREDICTION, PRED_CONFIDENCE FROM {name}_scores {where}
    """)


def scoring_procedure(df: DataFrame, model: Model | DataFrame, id_column: str, vote: str = "hard") -> DataFrame:
    """The same result by a plain call: (ACCOUNTID, PREDICTION, PRED_CONFIDENCE)."""
    scored = score(df, model, id_column, vote=vote)
    return scored.select(
        F.col(id_column).alias("ACCOUNTID"),
        F.col("SCORE").alias("PREDICTION"),
        F.col("CONFIDENCE").alias("PRED_CONFIDENCE"),
    )


def register_wrapper(spark: SparkSession, name: str, procedure: DataFrame) -> None:
    """A table function around the result of a procedure, with its types."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in procedure.schema.fields)
    names = ", ".join(f"`{f.name}`" for f in procedure.schema.fields)
    procedure.createOrReplaceTempView(f"{name}_result")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}()
        RETURNS TABLE ({columns})
        RETURN SELECT {names} FROM {name}_result
    """)


def describe_routine(spark: SparkSession, name: str) -> DataFrame:
    """What the catalog knows of a routine: parameters and returned columns."""
    return spark.sql(f"DESCRIBE FUNCTION EXTENDED {name}")

