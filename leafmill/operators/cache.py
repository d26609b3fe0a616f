"""Replay of a cache whose entries live a fixed time from the miss that stored them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions import values as V


def answer(stored_until: int | None, at: int, good: bool, ttl_us: int, failure_us: int) -> tuple[bool, int]:
    """(hit, end of the entry) for one request: a hit leaves the entry as it is, a miss stores its outcome."""
    if stored_until is not None and at < stored_until:
        return True, stored_until
    return False, at + (ttl_us if good else failure_us)


def replay(requests: DataFrame, key: str, at: str, order: str, ttl_s: float = V.CACHE_TTL_S, ok: str | None = None, failure_s: float = V.FAILURE_TTL_S) -> DataFrame:
    """``requests`` with ``cached``: whether the entry stored by the key's last miss is still alive.

    Failures (``ok`` false) live for their own, shorter time.  A hit doesn't
    refresh an entry.  A key's state is one time, carried through its rows in
    order, so no group is held in memory.  The number of entries isn't bounded.
    """
    good = F.coalesce(F.col(ok), F.lit(False)) if ok else F.lit(True)
    rows = requests.withColumns({"_key": F.col(key).cast("string"), "_us": F.unix_micros(F.col(at).cast("timestamp")), "_ok": good})
    rows = rows.repartition("_key").sortWithinPartitions("_key", "_us", order)
    times = int(ttl_s * 1_000_000), int(failure_s * 1_000_000)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, until = None, None
        for pdf in batches:
            hits = []
            for k, t, g in zip(pdf["_key"], pdf["_us"], pdf["_ok"], strict=True):
                if k != current:
                    current, until = k, None
                hit, until = answer(until, t, g, *times)
                hits.append(hit)
            yield pdf.drop(columns=["_key", "_us", "_ok"]).assign(cached=hits)

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema)
    return rows.mapInPandas(run, f"{names}, cached boolean")


class _Store:
    """Entries in order of their first storing; storing into a full store drops the oldest, whatever the key."""

    def __init__(self, most: int, life_us: int):
        self.most, self.life, self.entries = most, life_us, {}

    def alive(self, key: str, at: int) -> bool:
        return key in self.entries and at - self.entries[key] < self.life

    def put(self, key: str, at: int) -> None:
        if len(self.entries) >= self.most:
            del self.entries[next(iter(self.entries))]
        self.entries[key] = at


def replay_sessions(requests: DataFrame, session: str, key: str, at: str, order: str, ok: str, ttl_s: float = V.CACHE_TTL_S, most: int = 32, failure_s: float = V.FAILURE_TTL_S, most_failures: int = 8) -> DataFrame:
    """``requests`` with ``cached`` (null, 'page' or 'error'), each session with two bounded stores of its own.

    Failures are looked up first, and leave their store when found stale.  A
    session's state is at most ``most + most_failures`` entries, carried
    through its rows in order.
    """
    rows = requests.withColumns({"_s": F.col(session).cast("string"), "_k": F.col(key).cast("string"), "_us": F.unix_micros(F.col(at).cast("timestamp")), "_ok": F.coalesce(F.col(ok), F.lit(False))})
    rows = rows.repartition("_s").sortWithinPartitions("_s", "_us", order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, pages, errors = object(), None, None
        for pdf in batches:
            out = []
            for s, k, t, good in zip(pdf["_s"], pdf["_k"], pdf["_us"], pdf["_ok"], strict=True):
                if s != current:
                    current, pages, errors = s, _Store(most, int(ttl_s * 1_000_000)), _Store(most_failures, int(failure_s * 1_000_000))
                if errors.alive(k, t):
                    out.append("error")
                    continue
                errors.entries.pop(k, None)
                if pages.alive(k, t):
                    out.append("page")
                    continue
                (pages if good else errors).put(k, t)
                out.append(None)
            yield pdf.drop(columns=["_s", "_k", "_us", "_ok"]).assign(cached=pd.Series(out, index=pdf.index, dtype=object))

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema)
    return rows.mapInPandas(run, f"{names}, cached string")
