"""Bytes to text.  Sniffing is a column expression; codecs run as an Arrow UDF."""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.functions import values as V
from leafmill.functions.html import first


def sniff_charset(body: Column, content_type: Column) -> Column:
    """By byte order mark, then the header, then a meta tag in the first 2048 bytes; null if none says."""
    head = F.hex(F.substring(body, 1, 3))
    start = F.decode(F.substring(body, 1, 2048), "ISO-8859-1")
    return F.coalesce(
        F.when(head == "EFBBBF", "utf-8").when(head.startswith("FFFE"), "utf-16le").when(head.startswith("FEFF"), "utf-16be"),
        first(content_type, "(?i)charset=[\"']?([A-Za-z0-9_-]+)"),
        first(F.lower(start), "<meta[^>]+charset=[\"']?([a-z0-9_-]+)"),
    )


def _controls(e: UnicodeError) -> tuple[str, int]:
    """Single bytes that a code page leaves open are controls below A0, else unreadable."""
    bad = e.object[e.start : e.end]
    return "".join(chr(b) if b < 0xA0 else "\ufffd" for b in bad), e.end


codecs.register_error("leafmill-controls", _controls)


def decode_bytes(body: bytes, charset: str | None) -> tuple[str, str]:
    """(text, charset): never fails; a wrong declaration gives way to UTF-8 if that is clean, an unknown one at once."""
    name = (charset or "utf-8").lower().replace("gb2312", "gbk", 1).replace("gb_2312", "gbk", 1)
    codec = V.CHARSETS.get(name, "utf-8")

    def read(codec: str) -> str:
        errors = "leafmill-controls" if codec in V.CODE_PAGES else "replace"
        return bytes(body).decode(codec, errors).removeprefix("\ufeff")

    text = read(codec)
    if name not in ("utf-8", "utf8") and "\ufffd" in text[:2000]:
        plain = read("utf-8")
        if "\ufffd" not in plain[:2000]:
            return plain, "utf-8"
    return text, name


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("charset", T.StringType())]))
def _decode(body: pd.Series, charset: pd.Series) -> pd.DataFrame:
    rows = [(None, None) if b is None else decode_bytes(b, c) for b, c in zip(body, charset, strict=True)]
    return pd.DataFrame(rows, columns=["text", "charset"])


def decode(body: Column, content_type: Column) -> Column:
    """Struct of text and charset."""
    return _decode(body, sniff_charset(body, content_type))


def looks_binary(body: Column) -> Column:
    """Whether the first 512 bytes hold a NUL, or control characters for over three tenths."""
    head = F.hex(F.substring(body, 1, V.BINARY_HEAD))
    pairs = F.regexp_replace(head, "(..)", "$1 ")
    control = F.regexp_count(pairs, F.lit("(?:0[1-8]|0E|0F|1[0-9A-F]) "))
    return F.coalesce(F.regexp_like(pairs, F.lit("(?:^| )00 ")) | (control > V.CONTROL_SHARE * F.length(head) / 2), F.lit(False))
