"""Models in pipelines: calls with per-row errors, scoring into a log."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.operators.expect import Rules, finite
from lodestone.operators.upsert import insert_only

RESPONSE = "result string, errorMessage string"


def call_model(df: DataFrame, request: str, call: Callable[[str], str], name: str = "response", parallel: int | None = None) -> DataFrame:
    """Add a struct (result, errorMessage) of a model call per row; a failing call fails its row only, null is not asked.

    Calls are costly, so a caller writes the result (see ``lodestone.catalog.stage``) before using it twice; ``parallel``
    deals rows evenly first.
    """

    @F.pandas_udf(RESPONSE)
    def ask(requests: pd.Series) -> pd.DataFrame:
        rows = []
        for r in requests:
            if r is None:
                rows.append((None, None))
                continue
            try:
                rows.append((call(r), None))
            except Exception as e:  # what a remote model raises is data here
                rows.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(rows, columns=["result", "errorMessage"])

    return (df.repartition(parallel) if parallel else df).withColumn(name, ask(F.col(request)))


def score_new(model, features: DataFrame, log: DataFrame, keys: Sequence[str], version: str, prediction: str = "prediction") -> DataFrame:
    """Scored rows that the log lacks for this model version: what a rerun appends is nothing.

    A prediction that is not finite raises.
    """
    pinned = features.withColumn("model_version", F.lit(version))
    new = insert_only(log, pinned, [*keys, "model_version"])
    scored = model.transform(new).withColumn("predicted", F.col(prediction).cast("double"))
    checked = Rules({"finite_prediction": finite("predicted")}).enforce(scored)
    return checked.select(*keys, "model_version", "predicted", F.current_timestamp().alias("scored_at"), F.lit(None).cast("double").alias("actual"))


def label_schema(fields: dict[str, Sequence[str]]) -> str:
    """The JSON schema of an object that has one of the allowed labels in each field and nothing else."""
    properties = {f: {"type": "string", "enum": list(v)} for f, v in fields.items()}
    return json.dumps({"type": "object", "properties": properties, "required": list(fields), "additionalProperties": False}, sort_keys=True)
