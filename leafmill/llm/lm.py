"""Language-model scoring by a weighted backoff automaton.

Tokens are words (ASCII lower case, split at ASCII white space) and one end
per text.  Every n-gram of the training texts up to ``order`` words is
counted; nothing is cut off, so the model grows with the corpus.  Its states
are the n-grams that were seen as histories.  From the state h an arc reads
every word w that was seen behind it, with the weight

    p(w | h) = (c(h w) + m p(w | h')) / (c(h) + m),

where h' is h without its oldest word and m the strength of that prior; any
other word takes the failure arc to h', of weight m / (c(h) + m).  At the
empty history stand the smoothed unigrams

    p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)),

the base model.  The probabilities behind each history add up to one.  A text
starts in the state of the end token, and no history reaches back across it.

The automaton of a large corpus fits no machine, so its arcs travel to the
texts: texts are cut into blocks of a fixed size, and each block sends its
distinct n-grams, as hashes, to the buckets of the hash space, where their
counts meet and are added up.  The counts come back to the block, which
now holds just the arcs and failure arcs that its own texts can take, and is
traversed.  A frequent n-gram meets once per block, not once per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import finished, load, remainder, written
from leafmill.llm.hashing import U, blocks, mix, word_hashes

#: Longest n-gram, and the strength of the prior of n-grams of two, three ... words.
ORDER, PRIOR = 3, (64.0, 8.0)
#: Tokens of a block; a longer text is cut into pieces that carry their history along.
BLOCK_TOKENS = 1 << 20
#: Positions of all blocks for each bucket of counts.
BUCKET_POSITIONS = 1 << 20
#: Bytes of words: all but ASCII white space.
_INSIDE = np.ones(256, bool)
_INSIDE[[9, 10, 11, 12, 13, 32]] = False
END = U(0x5851F42D4C957F2D)
#: Bits of the hashes of single words and of longer n-grams. An n-gram that isn't there is taken for one that is with a probability of their number / 2 ** 56.
WORD_BITS, GRAM_BITS = 63, 56


def _bits(n: int) -> int:
    return WORD_BITS if n == 1 else GRAM_BITS


def _packed(x: np.ndarray) -> bytes:
    """Integers by planes of bytes, compressed: high planes of small values are all zero."""
    raw = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(b: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(b, n * 8, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, n).T).view("<u8").ravel()


def _sorted_packed(x: np.ndarray) -> bytes:
    """Ascending integers by their differences."""
    return _packed(np.diff(x, prepend=U(0)))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the tokens of all texts, each with its end; number of tokens of each text)."""
    h, doc, _, _ = word_hashes(texts, _INSIDE)
    n = np.bincount(doc, minlength=len(texts))
    return np.insert(h, np.cumsum(n), END), n + 1


def grams(h: np.ndarray, first: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: the hashes of the n-grams that end at each position, and whether there is one.

    ``first``: position in its piece of each token.
    """
    g = h
    for n in range(1, order + 1):
        if n > 1:
            g = mix(np.concatenate([np.zeros(1, U), g[:-1]]) * U(0xD1342543DE82EF95) + h)
        yield g >> U(64 - _bits(n)), first >= n - 1


class _Pieces:
    """Pieces of texts of one block; each starts with its history, which is read but not scored."""

    def __init__(self):
        self.hashes: list[np.ndarray] = []
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, rid: int, key, learned: bool, history: np.ndarray, own: np.ndarray) -> None:
        self.hashes += [history, own]
        self.rows.append((rid, key, learned, len(history), len(own)))
        self.size += len(own)


BLOCK = "block long, words long, distinct binary, seq binary, rid array<long>, doc_id array<{key}>, learned array<boolean>, lead array<int>, size array<int>, positions long, trained long"


def cut(docs: DataFrame, order: int, block_tokens: int) -> DataFrame:
    """Blocks of texts as words; ``docs``: (doc_id, text, learned).  A block's number is made of its task's."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    key_type = _arrow(docs, "doc_id").field("doc_id").type
    schema = BLOCK.format(key=kind)

    def record(number: int, p: _Pieces) -> pa.RecordBatch:
        h = np.concatenate(p.hashes)
        distinct, seq = np.unique(h, return_inverse=True)
        rid, keys, learned, lead, size = zip(*p.rows, strict=True)
        trained = sum(s for s, y in zip(size, learned, strict=True) if y)
        one = lambda x, t: pa.array([x], t)
        arrays = [one(number, pa.int64()), one(len(distinct), pa.int64()), one(_sorted_packed(distinct), pa.binary()), one(_packed(seq), pa.binary())]
        arrays += [one(list(x), pa.list_(t)) for x, t in ((rid, pa.int64()), (keys, key_type), (learned, pa.bool_()), (lead, pa.int32()), (size, pa.int32()))]
        arrays += [one(len(h), pa.int64()), one(trained, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        rid, held = number, _Pieces()
        for batch in batches:
            keys, learned = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for at, texts in blocks(batch.column(1)):
                h, n = tokens(texts)
                for i, own in enumerate(np.split(h, np.cumsum(n)[:-1]), at):
                    history = np.full(1, END)
                    for start in range(0, len(own), block_tokens):
                        part = own[start : start + block_tokens]
                        held.add(rid, keys[i], bool(learned[i]), history, part)
                        history = np.concatenate([history, part])[-max(order - 1, 1) :]
                        if held.size >= block_tokens:
                            yield record(number, held)
                            number, held = number + 1, _Pieces()
                    rid += 1
        if held.rows:
            yield record(number, held)

    return docs.select("doc_id", "text", "learned").mapInArrow(run, schema)


def _arrow(df: DataFrame, column: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.select(column).schema)


class Block:
    """A block read back: its words, and the place of each in its piece."""

    def __init__(self, row: dict):
        words = np.cumsum(_unpacked(row["distinct"], row["words"]), dtype=U)
        self.h = words[_unpacked(row["seq"], row["positions"]).astype(np.int64)]
        lead, size = np.array(row["lead"], np.int64), np.array(row["size"], np.int64)
        self.start = np.concatenate([[0], np.cumsum(lead + size)[:-1]])
        self.first = np.arange(len(self.h)) - np.repeat(self.start, lead + size)
        self.own = self.first >= np.repeat(lead, lead + size)
        self.learns = self.own & np.repeat(np.array(row["learned"], bool), lead + size)
        self.begin = self.start + lead


def sent(made: DataFrame, order: int, buckets: int) -> DataFrame:
    """(bucket, block, n, size, keys, counts): each block's distinct n-grams with their counts in its training texts."""
    # equal parts of the space of hashes
    bounds = {b: np.array([(i << b) // buckets for i in range(1, buckets)], U) for b in (WORD_BITS, GRAM_BITS)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                for n, (g, valid) in enumerate(grams(b.h, b.first, order), 1):
                    # sorted with the training flag as the lowest bit
                    x = (g[valid] << U(1)) | b.learns[valid]
                    x.sort()
                    key = x >> U(1)
                    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                    if not len(key):
                        continue
                    key, c = key[at], np.add.reduceat(x & U(1), at)
                    edge = np.concatenate([[0], np.searchsorted(key, bounds[_bits(n)]), [len(key)]])
                    some = np.flatnonzero(np.diff(edge))
                    parts = [(k, slice(edge[k], edge[k + 1])) for k in some.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([(n - 1) * buckets + k for k, _ in parts], pa.int64()),
                            pa.array([row["block"]] * len(parts), pa.int64()),
                            pa.array([n] * len(parts), pa.int32()),
                            pa.array([s.stop - s.start for _, s in parts], pa.int64()),
                            pa.array([_sorted_packed(key[s]) for _, s in parts], pa.binary()),
                            pa.array([_packed(c[s]) for _, s in parts], pa.binary()),
                        ],
                        ["bucket", "block", "n", "size", "keys", "counts"],
                    )

    columns = ("block", "words", "distinct", "seq", "learned", "lead", "size", "positions")
    return made.select(*columns).mapInArrow(run, "bucket long, block long, n int, size long, keys binary, counts binary")


def _added(table: pa.Table) -> pa.Table:
    """One bucket: the counts of all blocks added up, for each block in the order of its keys; and how many keys have any."""
    size = table["size"].to_pylist()
    key = np.concatenate([np.cumsum(_unpacked(x.as_py(), n), dtype=U) for x, n in zip(table["keys"], size, strict=True)])
    c = np.concatenate([_unpacked(x.as_py(), n) for x, n in zip(table["counts"], size, strict=True)])
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    total = np.add.reduceat(c[order], at)
    c[order] = np.repeat(total, np.diff(np.concatenate([at, [len(key)]])))
    parts = np.split(c, np.cumsum(size)[:-1])
    n, bucket = table["n"][0].as_py(), table["bucket"][0].as_py()
    return pa.table(
        {
            "block": pa.array([*table["block"].to_pylist(), -1], pa.int64()),
            "n": pa.array([n] * (len(size) + 1), pa.int32()),
            "bucket": pa.array([bucket] * (len(size) + 1), pa.int64()),
            "size": pa.array([*size, int(np.count_nonzero(total))], pa.int64()),
            "counts": pa.array([*map(_packed, parts), None], pa.binary()),
        }
    )


COUNTS = "block long, n int, bucket long, size long, counts binary"


def traverse(b: Block, counts: list[np.ndarray], total: int, distinct: int, prior: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """log10 probabilities of every position: (of the base model, of the automaton).

    ``counts``: for each length, the count of the n-gram that ends at each
    position.  The state carried to a position is the longest history with a
    count, which the counts at the position before it tell; from it the arc
    is taken if the n-gram has a count, else the failure arc, until one reads
    the word.
    """
    p = (counts[0] + 0.1) / (total + 0.1 * (distinct + 1))
    base, arc, back = np.log10(p), [np.log10(p)], [np.zeros(len(p))]
    for n in range(1, len(counts)):
        history = np.concatenate([[0], counts[n - 1][:-1]]) * (b.first >= n)
        m = prior[n - 1]
        # where nothing was seen behind the history the failure arc costs nothing
        back.append(np.log10(m / (history + m)))
        p = (counts[n] + m * p) / (history + m)
        arc.append(np.log10(p))
    score, reading = np.zeros(len(p)), np.ones(len(p), bool)
    for n in range(len(counts) - 1, -1, -1):
        taken = reading & ((counts[n] > 0) if n else True)
        score += np.where(taken, arc[n], 0.0)
        reading = reading & ~taken
        score += np.where(reading, back[n], 0.0)
    return base, score


def score(docs: DataFrame, learns: Column, key: str = "doc_id", text: str = "text", order: int = ORDER, prior: tuple[float, ...] = PRIOR, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Score every whole text by a model of those rows for which ``learns`` holds.

    Returns (key, learned, n_tokens, n_known, train_tokens, base_score,
    score); scores are log10 probabilities.  Null text is empty (its end is
    scored); null keys and repeated rows stay; without training rows every
    token has probability one (the smoothed mass of the unknown); an empty
    table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.coalesce(learns, F.lit(False)).alias("learned"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    made = written(cut(rows, order, block_tokens), "blocks")
    facts = made.agg(F.coalesce(F.sum("positions"), F.lit(0)).alias("positions"), F.coalesce(F.sum("trained"), F.lit(0)).alias("trained")).collect()[0]
    total, buckets = facts["trained"], max(1, -(-facts["positions"] // BUCKET_POSITIONS))
    counts = written(sent(made, order, buckets).groupBy("bucket").applyInArrow(_added, COUNTS), "counts")
    distinct = counts.filter("block = -1 and n = 1").agg(F.coalesce(F.sum("size"), F.lit(0))).collect()[0][0]
    facts_of = [x.split()[0] for x in BLOCK.split(", ")]
    outputs = f"rid long, doc_id {kind}, learned boolean, n_tokens long, n_known long, base double, score double"
    key_type = _arrow(rows, "doc_id").field("doc_id").type

    def run(table: pa.Table) -> pa.Table:
        """One block: its own row, which has no n, and the counts of its n-grams."""
        alone = pa.compute.is_null(table["n"])
        row = table.select(facts_of).filter(alone).to_pylist()[0]
        parts = table.select(["n", "bucket", "keys", "counts"]).filter(pa.compute.invert(alone)).sort_by([("n", "ascending"), ("bucket", "ascending")]).to_pylist()
        b = Block(row)
        found = []
        for n, (g, valid) in enumerate(grams(b.h, b.first, order), 1):
            c = np.zeros(len(g), np.int64)
            own = [_unpacked(x["counts"], x["keys"]) for x in parts if x["n"] == n]
            if own:
                # the counts stand in the order of the distinct hashes
                x = g[valid]
                by = np.argsort(x)
                x = x[by]
                place = np.zeros(len(x), np.int64)
                place[by] = np.cumsum(np.concatenate([[False], x[1:] != x[:-1]]))
                c[valid] = np.concatenate(own).astype(np.int64)[place]
            found.append(c)
        base, deep = traverse(b, found, total, distinct, prior)
        # a piece ends where the next one starts; its history is no part of its sums
        edges = np.stack([b.begin, np.append(b.start[1:], len(b.h))], axis=1).ravel()
        add = lambda x: np.add.reduceat(np.append(x, x[:1] * 0), edges)[::2]
        return pa.table(
            {
                "rid": pa.array(row["rid"], pa.int64()),
                "doc_id": pa.array(row["doc_id"], key_type),
                "learned": pa.array(row["learned"], pa.bool_()),
                "n_tokens": pa.array(row["size"], pa.int64()),
                "n_known": pa.array(add((found[0] > 0).astype(np.int64)), pa.int64()),
                "base": pa.array(add(base), pa.float64()),
                "score": pa.array(add(deep), pa.float64()),
            }
        )

    null = lambda name, of: F.lit(None).cast(of.schema[name].dataType).alias(name)
    answers = counts.filter("block >= 0").select("block", "n", "bucket", F.col("size").alias("keys"), "counts")
    left = made.select(*facts_of, *[null(c, answers) for c in ("n", "bucket", "keys", "counts")])
    right = answers.select("block", *[null(c, made) for c in facts_of[1:]], "n", "bucket", "keys", "counts")

    out = left.unionByName(right).groupBy("block").applyInArrow(run, outputs)
    # a long text is in several pieces
    out = out.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.first("learned").alias("learned"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")])
    return out.select(F.col("doc_id").alias(key), "learned", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def op8_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of nine of ten."""
    out = finished(lambda: score(load(spark, sf_dir, "documents"), remainder("doc_id", 10) != 0), "scores")
    return out.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
