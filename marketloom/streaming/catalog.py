"""What happens over time, as Structured Streaming: imports, liveness, rate limits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marketloom.operators import match, validate
from marketloom.schema import PRODUCT_RECORD


def captures(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of product records from line files as they arrive."""
    return spark.readStream.schema(f"retailer string, {PRODUCT_RECORD}").option("maxFilesPerTrigger", files_per_batch).json(path)


def import_stream(records: DataFrame, retailer: str, started_at, load: Callable, store: Callable, checkpoint: str):
    """Imports each micro-batch. load() gives (products, identifiers, listings); store(imported, batch_id) keeps them. A
    batch that is run again finds its own listings and changes nothing: imports are idempotent."""

    def batch(df: DataFrame, batch_id: int) -> None:
        valid, _, _ = validate.split(df.where(F.col("retailer") == retailer).drop("retailer"))
        rows = valid.withColumn("ordinal", F.monotonically_increasing_id())
        store(match.import_rows(match.written(rows), retailer, started_at, *load()), batch_id)

    return records.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def liveness(fetches: DataFrame, late: str = "10 minutes", runs: DataFrame | None = None) -> DataFrame:
    """Pages fetched and the last sign of life of each run and minute. fetches: run_id, ts; with runs (run_id, status), a
    table, what comes from runs that aren't running is dropped: a late report must not make a closed run look alive."""
    if runs is not None:
        fetches = fetches.join(runs.where("status = 'running'").select("run_id"), "run_id")
    minutes = fetches.withWatermark("ts", late).groupBy("run_id", F.window("ts", "1 minute"))
    return minutes.agg(F.count("*").alias("pages_read"), F.max("ts").alias("last_alive_at")).select("run_id", F.col("window.start").alias("minute"), "pages_read", "last_alive_at")


def silent(alive: DataFrame, runs: DataFrame, now, minutes: int = 10) -> DataFrame:
    """Running runs of which nothing was heard for so many minutes."""
    last = alive.groupBy("run_id").agg(F.max("last_alive_at").alias("last_alive_at"))
    heard = F.coalesce("last_alive_at", "started_at")
    return runs.where("status = 'running'").join(last, "run_id", "left").where(heard < F.lit(now).cast("timestamp") - F.expr(f"interval {minutes} minutes"))


def limited_stream(bumps: DataFrame, limit: int = 120, late: str = "1 hour", shares: int = 16) -> DataFrame:
    """The first bumps (bump_id, user_id, ts) of each user and hour in the order they come; the counts of an hour are kept
    until the watermark has passed it. An hour's users are dealt into so many shares, each a group with the counts of all
    its users: a call of Python for each user and hour would cost far more than its few rows."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known, used = np.frombuffer(state.get[0], "<i8").reshape(2, -1) if state.exists else np.empty((2, 0), "<i8")
        some = [f for f in frames if len(f)]
        rows = some[0] if len(some) == 1 else pd.concat(some)
        rows = rows.iloc[np.lexsort((rows["bump_id"], rows["ts"], rows["user_id"]))]
        users, first, n = np.unique(rows["user_id"].to_numpy("<i8"), return_index=True, return_counts=True)
        every = np.union1d(known, users)
        total, at = np.zeros(len(every), "<i8"), np.searchsorted(every, users)
        total[np.searchsorted(every, known)] = used
        keep = np.arange(len(rows)) - np.repeat(first, n) < np.repeat(limit - total[at], n)
        total[at] = np.minimum(total[at] + n, limit)
        state.update((np.stack([every, total]).tobytes(),))
        # A row can come when the watermark has passed its hour: a time that is over already would end the stream. Rows
        # without a time are of no hour that ever passes.
        if pd.notna(key[0]):
            state.setTimeoutTimestamp(max(int(pd.Timestamp(key[0]).timestamp() * 1000) + 3_600_000, state.getCurrentWatermarkMs() + 1))
        yield rows.loc[keep, ["bump_id", "user_id", "ts"]]

    hours = bumps.where("user_id is not null").withWatermark("ts", late).withColumns({"hour": F.date_trunc("hour", "ts"), "share": F.pmod(F.xxhash64("user_id"), F.lit(shares))})
    return hours.groupBy("hour", "share").applyInPandasWithState(run, "bump_id long, user_id long, ts timestamp", "used binary", "append", GroupStateTimeout.EventTimeTimeout)
