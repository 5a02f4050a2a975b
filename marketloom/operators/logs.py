"""Run logs: caps for each run and level, and age."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAPS, DAYS = {"info": 5_000, "warn": 20_000}, 30


def capped(lines: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """Lines (run_id, t, level, scope, message) within the caps, with a summary line for each level that was cut."""
    caps = CAPS if caps is None else caps
    cap = F.element_at(F.create_map(*[F.lit(x) for kv in caps.items() for x in kv]), F.col("level"))
    order = Window.partitionBy("run_id", "level").orderBy("t", "scope", "message")
    kept = lines.withColumns({"nth": F.row_number().over(order), "cap": cap}).where("cap is null or nth <= cap").drop("nth", "cap")
    cut = lines.groupBy("run_id", "level").agg(F.count("*").alias("n"), F.max("t").alias("t")).withColumn("cap", cap).where("n > cap")
    note = F.format_string("%d %s lines were not kept: a run keeps at most %d", F.col("n") - F.col("cap"), "level", "cap")
    return kept.unionByName(cut.select("run_id", "t", F.lit("warn").alias("level"), F.lit("run-log").alias("scope"), note.alias("message")))


def recent(lines: DataFrame, now, days: int = DAYS) -> DataFrame:
    return lines.where(F.col("t") >= F.lit(now).cast("timestamp") - F.expr(f"interval {days} days"))
