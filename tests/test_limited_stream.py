"""Hourly limits over several batches, with a restart between them."""

import datetime as dt

from marketloom.streaming import catalog as streams

BUMP = "bump_id long, user_id long, ts timestamp"


def test_limits_hold_over_restarts_with_few_states(spark, tmp_path):
    """Users of an hour share a state: one for each user and hour took a call of Python for each of them."""
    at = dt.datetime(2024, 1, 1, 5)
    first = [(k, k % 300, at + dt.timedelta(seconds=k)) for k in range(450)] + [(9000, 7, None), (9001, None, at)]
    second = [(k, k % 300, at + dt.timedelta(seconds=k % 7)) for k in range(1000, 1900)] + [(9002, 7, None), (9003, 7, None)]
    for rows in (first, second):
        spark.createDataFrame(rows, BUMP).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        made = streams.limited_stream(spark.readStream.schema(BUMP).parquet(f"{tmp_path}/in"), 2)
        q = made.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
        q.awaitTermination(120)
    expected, used = set(), {}
    for rows in (first, second):
        for bump, user, ts in sorted(rows, key=lambda r: (r[2] or at, r[0])):
            n = used[user, ts is None] = used.get((user, ts is None), 0) + 1
            if user is not None and n <= 2:
                expected.add((bump, user, ts))
    got = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert len(got) == len(expected) and set(got) == expected
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 32
