"""Which column is the id, the label, a category or a number."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallgrove.functions.params import Params


@dataclass(frozen=True)
class Roles:
    id: str | None
    label: str | None
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]

    @property
    def features(self) -> list[str]:
        return [*self.categorical, *self.numeric]


def resolve_roles(df: DataFrame, params: Params) -> Roles:
    """Roles from schema and parameters.

    With ``HAS_ID`` = 1 the first column is the id; the label is named by
    ``DEPENDENT_VARIABLE`` (the last column otherwise); text columns and those
    named by ``CATEGORICAL_VARIABLE`` are categories.
    """
    names = df.columns
    id_column = names[0] if params.whole("HAS_ID", 0) == 1 else None
    label = params.get("DEPENDENT_VARIABLE") or names[-1]
    if label not in names:
        raise ValueError(f"no column {label}")
    listed = {n.strip() for n in (params.get("CATEGORICAL_VARIABLE") or "").split(",") if n.strip()}
    categorical, numeric = [], []
    for field in df.schema.fields:
        if field.name in (id_column, label):
            continue
        if isinstance(field.dataType, T.StringType) or field.name in listed:
            categorical.append(field.name)
        elif isinstance(field.dataType, T.NumericType):
            numeric.append(field.name)
        else:
            raise ValueError(f"{field.name} is neither text nor number")
    return Roles(id_column, label, tuple(categorical), tuple(numeric))
