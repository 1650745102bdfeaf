"""JSON functions that Spark lacks (F-2, F-4, P-22, P-30): Arrow-batched, never row by row."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.BooleanType())
def is_valid_json(texts: pd.Series) -> pd.Series:
    """Whether a text is one whole JSON value (no trailing garbage; NaN is allowed); null is not."""

    def ok(t) -> bool:
        if t is None:
            return False
        try:
            json.loads(t)
            return True
        except (ValueError, RecursionError):
            return False

    return texts.map(ok).astype(bool)


def _turn_keys(value):
    if isinstance(value, dict):
        return {str(k).replace("-", "_"): _turn_keys(v) for k, v in value.items()}
    return [_turn_keys(v) for v in value] if isinstance(value, list) else value


@F.pandas_udf(T.StringType())
def normalise_keys(texts: pd.Series) -> pd.Series:
    """JSON objects at any depth with underscores for hyphens in their keys; unreadable text becomes null."""

    def turn(t):
        try:
            return None if t is None else json.dumps(_turn_keys(json.loads(t)), ensure_ascii=False)
        except (ValueError, RecursionError):
            return None

    return texts.map(turn)


def strict_json(text: Column) -> Column:
    """A cheap JVM screen before the exact test: only texts that may be JSON go to Python."""
    return F.when(text.isNull() | (F.trim(text) == ""), F.lit(False)).otherwise(is_valid_json(text))


def json_lenient(text: Column) -> Column:
    """The text as JSON, or what stands in its fenced json block; null if neither parses (P-22)."""
    fenced = F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1), F.lit(""))
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(fenced))


def parsed_arguments(arguments: Column) -> Column:
    """Arguments as an object where they parse, else null (P-4; the text itself is kept beside it)."""
    return F.try_parse_json(arguments)


@F.pandas_udf(T.StringType())
def flatten_json(texts: pd.Series) -> pd.Series:
    """A JSON list of any depth as one flat list; anything else becomes null."""

    def flat(v):
        return [y for x in v for y in flat(x)] if isinstance(v, list) else [v]

    def turn(t):
        try:
            v = json.loads(t) if t is not None else None
        except (ValueError, RecursionError):
            return None
        return json.dumps(flat(v)) if isinstance(v, list) else None

    return texts.map(turn)
