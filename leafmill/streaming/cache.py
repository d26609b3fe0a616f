"""The cache as keyed state of a stream of requests."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from leafmill.functions import values as V
from leafmill.operators.cache import answer

OUT = "key string, id long, at timestamp, cached boolean"


def answered(requests: DataFrame, ttl_s: float = V.CACHE_TTL_S, failure_s: float = V.FAILURE_TTL_S, late: str = "1 hour") -> DataFrame:
    """(key, id, at, cached) for a stream of (key, id, at, ok).

    State is the end of the key's entry; it is dropped once the watermark,
    ``late`` behind the newest request, has passed it.
    """
    times = int(ttl_s * 1_000_000), int(failure_s * 1_000_000)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        until = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["us", "id"])
        hits = []
        for t, good in zip(rows["us"], rows["ok"], strict=True):
            hit, until = answer(until, int(t), bool(good), *times)
            hits.append(hit)
        state.update((until,))
        state.setTimeoutTimestamp(max(until // 1000, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame({"key": key[0], "id": rows["id"], "at": rows["at"], "cached": hits})

    rows = requests.select("key", "id", F.col("at").cast("timestamp").alias("at"), F.unix_micros(F.col("at").cast("timestamp")).alias("us"), F.coalesce("ok", F.lit(False)).alias("ok"))
    rows = rows.withWatermark("at", late)
    return rows.groupBy("key").applyInPandasWithState(run, OUT, "until long", "append", GroupStateTimeout.EventTimeTimeout)
