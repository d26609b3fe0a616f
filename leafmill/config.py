"""Settings, read once: numbers are coerced and clamped, switches must be real booleans."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, fields


def number(value: object, low: float, high: float, default: float) -> float:
    """``value`` as a number within [low, high]; ``default`` for what isn't a finite number."""
    try:
        n = float(value) if value is not None and not isinstance(value, (list, dict)) else math.nan
    except (TypeError, ValueError):
        n = math.nan
    return min(high, max(low, n)) if math.isfinite(n) else default


@dataclass(frozen=True)
class Settings:
    """Limits of reads; see LIMITS for their ranges."""

    timeout_ms: int = 15_000
    max_bytes: int = 3 * 1024 * 1024
    max_chars: int = 6_000
    max_links: int = 20
    cache_ttl_ms: int = 300_000
    cache_max: int = 32
    paginate_max: int = 3
    spa_render: bool = True
    paginate: bool = True
    user_agent: str = "leafmill"

    @classmethod
    def of(cls, raw: Mapping[str, object] | None) -> Settings:
        raw, out = raw or {}, {}
        for f in fields(cls):
            v = raw.get(f.name)
            if f.name in LIMITS:
                out[f.name] = int(number(v, *LIMITS[f.name], f.default))
            elif isinstance(f.default, bool):
                out[f.name] = v if isinstance(v, bool) else f.default
            else:
                out[f.name] = v if isinstance(v, str) and v.strip() else f.default
        return cls(**out)


#: Least and largest value of each number (fixed values).
LIMITS = {
    "timeout_ms": (500, 120_000),
    "max_bytes": (65_536, 16_777_216),
    "max_chars": (500, 20_000),
    "max_links": (1, 50),
    "cache_ttl_ms": (0, 3_600_000),
    "cache_max": (1, 256),
    "paginate_max": (1, 10),
}
