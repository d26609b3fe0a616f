"""Compact JSON.  Order of keys, numbers and clipping need a real parser, so this runs as an Arrow UDF."""

from __future__ import annotations

import json
import math
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.functions import values as V

_LONE = re.compile("[\ud800-\udfff]")


def _clip(s: str) -> str:
    more = len(s) - V.JSON_STRING_CHARS
    return f"{s[: V.JSON_STRING_CHARS]}…[+{more} chars]" if more > 0 else s


def number(x: float) -> str:
    """A double as the web writes it: shortest digits, plain from 1e-6 up to 1e21, else with an exponent; null if not finite."""
    if not math.isfinite(x):
        return "null"
    if x == 0:
        return "0"
    mantissa, _, power = repr(abs(x)).partition("e")
    whole, _, part = mantissa.partition(".")
    digits = (whole + part).lstrip("0")
    point = len(whole) + int(power or 0) - (len(whole + part) - len(digits))
    digits = digits.rstrip("0")
    n = len(digits)
    if 0 < point <= 21:
        out = digits + "0" * (point - n) if n <= point else f"{digits[:point]}.{digits[point:]}"
    elif -6 < point <= 0:
        out = f"0.{'0' * -point}{digits}"
    else:
        exponent = point - 1
        out = f"{digits[0]}{'.' + digits[1:] if n > 1 else ''}e{'+' if exponent > 0 else '-'}{abs(exponent)}"
    return f"-{out}" if x < 0 else out


def string(s: str) -> str:
    """A JSON string; halves of a pair that stand alone are written as escapes, so that the text can be encoded."""
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", json.dumps(s, ensure_ascii=False))


def _keys(v: dict) -> list[str]:
    """Keys that are array indices come first, in order."""
    index = {k for k in v if k.isascii() and k.isdigit() and len(k) < 11 and str(int(k)) == k and int(k) < 2**32 - 1}
    return [*sorted(index, key=int), *(k for k in v if k not in index)]


def written(value: object) -> str:
    """A parsed value without blanks. Strings are clipped, but for those in objects below a fixed depth."""
    out: list[str] = []
    # what is still to be written, last first: texts, and (value, depth, whether strings are clipped)
    left: list[str | tuple] = [(value, 0, True)]
    while left:
        x = left.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        v, depth, clips = x
        if isinstance(v, str):
            out.append(string(_clip(v) if clips else v))
        elif isinstance(v, bool) or v is None:
            out.append({True: "true", False: "false", None: "null"}[v])
        elif isinstance(v, float):
            out.append(number(v))
        elif isinstance(v, list):
            left.append("]")
            for i in range(len(v) - 1, -1, -1):
                left += [(v[i], depth + 1, clips), *([","] if i else [])]
            left.append("[")
        else:
            clips, keys = clips and depth < V.JSON_DEPTH, _keys(v)
            left.append("}")
            for i in range(len(keys) - 1, -1, -1):
                left += [(v[keys[i]], depth + 1, clips), string(keys[i]) + ":", *([","] if i else [])]
            left.append("{")
    return "".join(out)


def compact(text: str | None) -> str | None:
    """A JSON text without blanks, long strings clipped; null for what isn't JSON, or is nested too deeply to be read."""
    if text is None:
        return None

    def refused(_: str) -> None:
        raise ValueError

    try:
        # all numbers are doubles, however many digits they have
        value = json.loads(text, parse_constant=refused, parse_int=float)
    except (ValueError, RecursionError):
        return None
    return written(value)


@F.pandas_udf(T.StringType())
def _compact(s: pd.Series) -> pd.Series:
    return s.map(compact)


def compact_json(text: Column) -> Column:
    return _compact(text)
