"""Registers the scalar functions for Spark SQL (X-*)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from tracewright.functions import jsonx


@udtf(returnType="step_no int, role string, kind string, name string, text string")
class TraceSteps:
    """One row for each step of a session's messages given as JSON text; unreadable text gives none."""

    def eval(self, messages: str):
        import json

        try:
            rows = json.loads(messages) if messages else []
        except ValueError:
            rows = []
        n = 0
        for m in rows if isinstance(rows, list) else []:
            if not isinstance(m, dict):
                continue
            if m.get("content"):
                yield n, m.get("role"), "text", None, m["content"] if isinstance(m["content"], str) else json.dumps(m["content"])
                n += 1
            for c in m.get("tool_calls") or []:
                f = c.get("function") or {}
                yield n, m.get("role"), "tool", f.get("name"), f.get("arguments")
                n += 1


def register(spark: SparkSession) -> None:
    """SQL functions is_valid_json, normalise_keys, flatten_json and the table function trace_steps."""
    for name in ("is_valid_json", "normalise_keys", "flatten_json"):
        spark.udf.register(name, getattr(jsonx, name))
    spark.udtf.register("trace_steps", TraceSteps)
