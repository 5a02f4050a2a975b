"""Runs: open, close, sweep, reap, purge, and what a run did to the listings. Time is always given, never the clock's."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FLOOR, REAP_HOURS = 0.5, 12


def reap(runs: DataFrame, now) -> DataFrame:
    """Runs left running for over REAP_HOURS are failed."""
    dead = (F.col("status") == "running") & (F.col("started_at") < F.lit(now).cast("timestamp") - F.expr(f"interval {REAP_HOURS} hours"))
    return runs.withColumns({"error": F.when(dead, "reaped").otherwise(F.col("error")), "finished_at": F.when(dead, F.lit(now).cast("timestamp")).otherwise(F.col("finished_at")), "status": F.when(dead, "failed").otherwise(F.col("status"))})


def open_run(runs: DataFrame, run_id: str, retailer: str, now) -> DataFrame:
    new = runs.sparkSession.createDataFrame([(run_id, retailer)], "run_id string, retailer string").withColumns({"status": F.lit("running"), "started_at": F.lit(now).cast("timestamp")})
    return reap(runs, now).unionByName(new, allowMissingColumns=True)


def verdicts(closing: DataFrame, runs: DataFrame) -> DataFrame:
    """status, reason and previous_valid for runs that close (run_id, retailer, started_at, products_valid, covered).

    Nothing found is partial; a covered index is completed; fewer than FLOOR of what the last completed run of the
    retailer found is partial; all else is completed.
    """
    last = runs.where("status = 'completed'").select("retailer", F.col("run_id").alias("other"), F.col("started_at").alias("other_at"), F.col("products_valid").alias("other_valid"))
    previous = closing.select("run_id", "retailer").join(last, "retailer").where("other <> run_id").groupBy("run_id").agg(F.max_by("other_valid", "other_at").alias("previous_valid"))
    return _judged(closing.join(previous, "run_id", "left"))


def _judged(runs: DataFrame) -> DataFrame:
    low = (F.col("previous_valid") > 0) & (F.col("products_valid") < F.col("previous_valid") * FLOOR)
    low = F.coalesce(low, F.lit(False)) & ~F.coalesce("covered", F.lit(False))
    status = F.when(F.col("products_valid") == 0, "partial").when(low, "partial").otherwise("completed")
    reason = F.when(F.col("products_valid") == 0, "found_nothing").when(low, F.format_string("found %d, previous completed run found %d (below the 50%% floor)", "products_valid", "previous_valid"))
    return runs.withColumns({"status": status, "reason": reason})


def replay_verdicts(runs: DataFrame) -> DataFrame:
    """Verdicts of each retailer's runs in the order they started, as if each closed before the next one.

    Only a completed run is held against the next: a fold over the retailer's runs, in an array of its own, which is
    meant for hundreds or thousands of runs of a retailer.
    """
    one = F.struct("started_at", "run_id", F.col("products_valid").cast("long").alias("n"), F.coalesce("covered", F.lit(False)).alias("covered"))
    folded = runs.groupBy("retailer").agg(F.array_sort(F.collect_list(one)).alias("r"))
    start = F.struct(F.lit(None).cast("long").alias("last"), F.array().cast("array<struct<run_id:string,status:string,previous_valid:bigint>>").alias("done"))

    def step(acc, run):
        bad = (run["n"] == 0) | (~run["covered"] & F.coalesce((acc["last"] > 0) & (run["n"] < acc["last"] * FLOOR), F.lit(False)))
        made = F.struct(run["run_id"].cast("string").alias("run_id"), F.when(bad, "partial").otherwise("completed").alias("status"), acc["last"].alias("previous_valid"))
        return F.struct(F.when(bad, acc["last"]).otherwise(run["n"]).alias("last"), F.concat(acc["done"], F.array(made)).alias("done"))

    done = folded.select("retailer", F.explode(F.aggregate("r", start, step, lambda a: a["done"])).alias("d"))
    return done.select("retailer", "d.run_id", "d.status", "d.previous_valid")


def sweep(listings: DataFrame, completed: DataFrame) -> DataFrame:
    """listings with those that a completed run (retailer, started_at) did not see made unavailable; swept says which."""
    last = completed.groupBy("retailer").agg(F.max("started_at").alias("run_at"))
    gone = F.coalesce((F.col("last_seen_at") < F.col("run_at")) & F.col("available"), F.lit(False))
    marked = listings.join(last, "retailer", "left").withColumn("swept", gone)
    return marked.withColumn("available", F.col("available") & ~F.col("swept")).drop("run_at")


def close(closing: DataFrame, runs: DataFrame, listings: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """Verdict and sweep in one: (runs, listings) after the running ones among closing have closed. Others stay."""
    judged = verdicts(closing.join(runs.where("status = 'running'").select("run_id"), "run_id", "left_semi"), runs)
    after = sweep(listings, judged.where("status = 'completed'"))
    swept = after.groupBy("retailer").agg(F.count_if("swept").alias("swept_n"))
    done = judged.join(swept, "retailer", "left").select("run_id", F.col("status").alias("new_status"), "reason", F.when(F.col("status") == "completed", F.coalesce("swept_n", F.lit(0))).otherwise(0).alias("new_marked"), F.col("products_valid").alias("new_valid"))
    both = runs.join(done, "run_id", "left")
    is_new = F.col("new_status").isNotNull()
    both = both.withColumns({"finished_at": F.when(is_new, F.lit(now).cast("timestamp")).otherwise(F.col("finished_at")), "marked_unavailable": F.when(is_new, F.col("new_marked")).otherwise(F.col("marked_unavailable")), "products_valid": F.coalesce("new_valid", "products_valid"), "error": F.coalesce("reason", "error"), "status": F.coalesce("new_status", "status")})
    return both.select(runs.columns), after.drop("swept")


def stop(runs: DataFrame, stopped: DataFrame, now) -> DataFrame:
    """Runs closed as failed or partial (run_id, new_status, reason), without a sweep."""
    both = runs.join(stopped.select("run_id", "new_status", F.left("reason", F.lit(2000)).alias("reason")), "run_id", "left")
    is_new = F.col("new_status").isNotNull() & (F.col("status") == "running")
    return both.withColumns({"finished_at": F.when(is_new, F.lit(now).cast("timestamp")).otherwise(F.col("finished_at")), "error": F.when(is_new, F.col("reason")).otherwise(F.col("error")), "status": F.when(is_new, F.col("new_status")).otherwise(F.col("status"))}).select(runs.columns)


def run_listings(runs: DataFrame, listings: DataFrame, kind: str) -> DataFrame:
    """Listings that each run (run_id, retailer, started_at, status) made new, repriced or left behind (gone).

    A listing is new to the runs that started when it was first seen, repriced by those that started at its last price,
    and gone by the first completed runs after it was last seen: each kind is an equal-join on retailer and time.
    """
    if kind not in ("new", "repriced", "gone"):
        raise ValueError(f"unknown kind: {kind}")
    if kind != "gone":
        at = "first_seen_at" if kind == "new" else "last_price_at"
        found = listings if kind == "new" else listings.where("last_price_at <> first_seen_at")
        return runs.join(found.withColumn("started_at", F.col(at)), ["retailer", "started_at"])
    done = runs.where("status = 'completed'")
    missing = listings.where(~F.col("available"))
    # Of each retailer's distinct times in order, the first start of a completed run after a listing was last seen.
    starts = done.select("retailer", F.col("started_at").alias("t"), F.col("started_at").alias("start"))
    seen = missing.select("retailer", F.col("last_seen_at").alias("t"), F.lit(None).cast("timestamp").alias("start"))
    later = Window.partitionBy("retailer").orderBy("t", F.col("start").asc_nulls_last()).rowsBetween(1, Window.unboundedFollowing)
    times = starts.unionByName(seen).distinct().withColumn("started_at", F.min("start").over(later))
    next_start = times.where("start is null and started_at is not null").select("retailer", F.col("t").alias("last_seen_at"), "started_at")
    return done.join(missing.join(next_start, ["retailer", "last_seen_at"]), ["retailer", "started_at"])


def page(found: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    """One page of run_listings with the total beside it."""
    total = found.agg(F.count("*").alias("total"))
    rows = found.orderBy("retailer_name", "external_id").offset(max(offset, 0)).limit(min(max(limit, 1), 200))
    return rows.crossJoin(F.broadcast(total))


def purge(evidence: DataFrame, products: DataFrame, identifiers: DataFrame, listings: DataFrame, retailers: DataFrame):
    """(products, identifiers, listings, counts) without the listings of evidence (retailer, external_id), and without
    the products that then have none left. A retailer that isn't known is an error."""
    unknown = evidence.join(retailers.select("retailer"), "retailer", "left_anti").limit(1).collect()
    if unknown:
        raise ValueError(f"unknown retailer: {unknown[0]['retailer']}")
    keys = evidence.select("retailer", "external_id").distinct()
    gone = listings.join(keys, ["retailer", "external_id"], "left_semi")
    left = listings.join(keys, ["retailer", "external_id"], "left_anti")
    orphaned = gone.select("product_id").distinct().join(left.select("product_id"), "product_id", "left_anti")
    counts = gone.agg(F.count("*").alias("listings_deleted")).crossJoin(F.broadcast(orphaned.agg(F.count("*").alias("products_deleted"))))
    return products.join(orphaned, "product_id", "left_anti"), identifiers.join(orphaned, "product_id", "left_anti"), left, counts


def add_counters(runs: DataFrame, reports: DataFrame, counters: list[str]) -> DataFrame:
    """runs with the reports' counters (run_id and counters) added; negative reports count as nothing. Closed runs stay.

    Where reports have stats (a map) and reported_at, the run's stats take their entries over, later reports last.
    """
    given = [F.sum(F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))).alias(f"add_{c}") for c in counters]
    with_stats = "stats" in reports.columns
    if with_stats:
        given.append(F.array_sort(F.collect_list(F.when(F.col("stats").isNotNull(), F.struct("reported_at", F.map_entries("stats").alias("e"))))).alias("said"))
    both, live = runs.join(reports.groupBy("run_id").agg(*given), "run_id", "left"), F.col("status") == "running"
    new = {c: F.coalesce(F.col(c), F.lit(0)) + F.when(live, F.coalesce(f"add_{c}", F.lit(0))).otherwise(0) for c in counters}
    if with_stats:
        said = F.when(live, F.transform("said", lambda r: F.map_from_entries(r["e"])))
        over = lambda old, entries: F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(entries, k)), entries)
        new["stats"] = F.aggregate(F.coalesce(said, F.array().cast("array<map<string,string>>")), F.coalesce("stats", F.create_map().cast("map<string,string>")), over)
    return both.withColumns(new).select(runs.columns)


def alive(runs: DataFrame, reports: DataFrame) -> DataFrame:
    """runs with pages_read, last_alive_at and progress of the reports (run_id, reported_at, pages, done, total, unit).

    Reports of runs that are no longer running are dropped. Pages add up, a negative number counting as nothing; of
    done, total and unit each takes the last one reported.
    """
    last = lambda c, value: F.max_by(value, F.when(value.isNotNull(), F.col("reported_at"))).alias(c)
    at_least = lambda c: F.greatest(F.col(c), F.lit(0))
    said = reports.join(runs.where("status = 'running'").select("run_id"), "run_id", "left_semi").groupBy("run_id").agg(
        F.sum(F.greatest(F.coalesce("pages", F.lit(0)), F.lit(0))).alias("new_pages"), F.max("reported_at").alias("new_alive"),
        last("new_done", F.when(F.col("done").isNotNull(), at_least("done"))), last("new_total", F.when(F.col("total").isNotNull(), at_least("total"))), last("new_unit", F.nullif(F.trim("unit"), F.lit(""))),
    )
    both = runs.join(said, "run_id", "left")
    new = {"pages_read": F.col("pages_read") + F.coalesce("new_pages", F.lit(0)), "last_alive_at": F.coalesce("new_alive", "last_alive_at"), "progress_done": F.coalesce("new_done", "progress_done"), "progress_total": F.coalesce("new_total", "progress_total"), "progress_unit": F.coalesce("new_unit", "progress_unit")}
    return both.withColumns(new).select(runs.columns)
