"""Packing of documents into fixed sequences by harmonic classes.

A piece of length n belongs to class j = capacity // n, and every sequence of
class j takes exactly j pieces.  Documents are cut so that pieces fill their
class: a piece stays whole only if the room it leaves unused in its class is
small, else the largest reciprocal part ``capacity // (j + 1)`` is cut off.
Classes and their chunks are packed independently of each other; the last,
incomplete sequences of all classes are packed together at the end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafmill.llm.common import chunks_for, finished, load, ranked, written

#: Pieces of one class ranked by one task.
PIECES_PER_CHUNK = 100_000

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int"

#: The split of text into words that the byte-level vocabulary was made with (fixed value).
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(maxsize=4)
def tokenizer(name: str, added: bool = False):
    """The byte-level vocabulary; gives the ids of the JSON file of the same name (tested), several times as fast.

    With ``added``, it knows the added tokens of that file too, if they are allowed in the call.
    """
    import base64
    import json

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    special = {}
    if added:
        with open(public_tokenizers.path(name.removesuffix(".tiktoken") + ".json"), encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return tiktoken.Encoding(name, pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)


def harmonic_cuts(n: int, capacity: int, waste: float) -> list[int]:
    """Cut ``n`` < capacity so that each piece leaves at most ``waste`` of the capacity unused in its sequence."""
    out = []
    while n:
        j = capacity // n
        if capacity - j * n <= waste * capacity:
            out.append(n)
            break
        out.append(capacity // (j + 1))
        n -= out[-1]
    return out


def pieces(docs: DataFrame, capacity: int, waste: float, key: str, text: str, end_id: int, vocabulary: str, ids: bool) -> DataFrame:
    """One row per piece: its place in the document, its ids' checksum and class (and the ids, if asked for)."""
    schema = PIECE + (", ids array<int>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(vocabulary, added=True).encode_to_numpy
        tail = [harmonic_cuts(n, capacity, waste) for n in range(capacity)]
        for batch in batches:
            keys, found, kept = batch.column(0).to_pylist(), [], []
            for k, s in zip(keys, batch.column(1), strict=True):
                own = np.append(encode(s.as_py() or "", allowed_special="all").astype("<u4", copy=False), np.uint32(end_id))
                at = 0
                for n in [capacity] * (len(own) // capacity) + tail[len(own) % capacity]:
                    found.append((k, at, n, zlib.crc32(own[at : at + n].tobytes()), len(own), capacity // n))
                    if ids:
                        kept.append(own[at : at + n].astype("i4"))
                    at += n
            cols = list(zip(*found, strict=True)) or [[]] * 6
            arrays = [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 5 + [pa.int32()], strict=True)]
            names = [x.split()[0] for x in PIECE.split(", ")]
            if ids:
                arrays.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def best_fit(capacity: int):
    """Packs the pieces of one group, longest first, each into the fullest sequence that has room."""

    def run(pdf):
        import bisect

        pdf = pdf.sort_values(["length", "doc_id", "start", "rid"], ascending=[False, True, True, True], na_position="first", kind="stable").reset_index(drop=True)
        room: list[tuple[int, int]] = []
        seq, off, bins = [], [], 0
        for n in pdf["length"].tolist():
            i = bisect.bisect_left(room, (n, -1))
            if i < len(room):
                free, k = room.pop(i)
            else:
                free, k, bins = capacity, bins, bins + 1
            seq.append(k)
            off.append(capacity - free)
            bisect.insort(room, (free - n, k))
        return pdf.assign(bin=np.array(seq, "i8"), offset=np.array(off, "i8"))

    return run


def pack(docs: DataFrame, capacity: int = 2048, waste: float = 0.01, key: str = "doc_id", text: str = "text", end_id: int = 1, vocabulary: str = "byte_bpe_50k.tiktoken", ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    class, sequence_id, offset (and ids).  A null or empty text is the one
    token ``end_id``; repeated rows are packed once each; a null key is kept;
    an empty table gives no rows; other columns are not read.  ``waste`` is
    the share of a sequence that one class may leave unused.  Sequence ids
    run from 0 by class, largest pieces first.
    """
    made = pieces(docs, capacity, waste, key, text, end_id, vocabulary, ids)
    kept = written(made.withColumn("rid", F.monotonically_increasing_id()), "pieces")
    # at most one row per class: fewer than 2 * sqrt(capacity) + 1 rows
    count = {r["class"]: r["n"] for r in kept.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    base, at = {}, 0
    for j in sorted(count):
        base[j], at = at, at + count[j] // j
    if not count:
        return kept.drop("rid").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    n = chunks_for(sum(count.values()), len(count), PIECES_PER_CHUNK, 64)
    rows = ranked(kept.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "rid"), F.lit(n))), "class", "_chunk", ["doc_id", "start", "rid"], "rank")
    facts = F.create_map(*[x for j in sorted(count) for x in (F.lit(j), F.struct(F.lit(base[j]).cast("long").alias("base"), F.lit(count[j] // j * j).cast("long").alias("whole")))])
    rows = written(rows.withColumn("_f", facts[F.col("class")]).withColumn("bin", F.when(F.col("rank") < F.col("_f.whole"), F.col("_f.base") + F.expr("rank div class"))).drop("_f"), "ranked")

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", *(["ids"] if ids else [])]
    alone = rows.filter(F.col("bin").isNotNull() & (F.col("class") == 1)).select(*names, F.col("bin").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    before = W.partitionBy("bin").orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    full = rows.filter(F.col("bin").isNotNull() & (F.col("class") > 1)).select(*names, F.col("bin").alias("sequence_id"), F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
    # fewer than j pieces of each class j are left over: a bounded group, whatever the input
    left = rows.filter(F.col("bin").isNull()).select(*names, "rid")
    left = left.groupBy(F.lit(0).alias("_all")).applyInPandas(best_fit(capacity), schema=_ddl(left) + ", bin long, offset long")
    left = left.select(*names, (F.col("bin") + F.lit(at)).alias("sequence_id"), "offset")
    return alone.unionByName(full).unionByName(left)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into sequences of 2048 tokens."""
    out = finished(lambda: pack(load(spark, sf_dir, "documents")), "packed")
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class")
