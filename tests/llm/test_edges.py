"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leafmill.llm import ann, common, decontam, dedup, licenses, lm, packing, pii, secrets, sharding, toxicity
from leafmill.llm.common import remainder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, root int, base string, score double, spans int, `class` int, rid long, `_c0` string"
LONG = "word and more words. " * 10_000
TEXTS = [(1, "All rights reserved. Mail a@b.com now"), (1, "All rights reserved. Mail a@b.com now"), (2, None), (3, ""), (None, "no id here"), (None, "no id here"), (4, LONG), (5, "\x00   😀 ?!"), (6, "x" * 50_000), (7, " \n\t ")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, "s", None if t is None else len(t), "f", 1, "b", 0.5, 2, 3, 4, "c") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tests(spark):
    return spark.createDataFrame([(1, "what is this question about. the answer is here."), (2, None), (3, ""), (4, "one"), (1, "what is this question about. the answer is here.")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 1), (4, 1, 0), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")


def test_packing(odd, empty):
    rows = packing.pack(odd).collect()
    assert sum(r.length for r in rows if r.start == 0 and r.doc_tokens == 1 and r.length == 1) == 2  # null and empty text
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert sum(r.doc_tokens for r in rows if r.start == 0) == sum(r.length for r in rows)
    assert packing.pack(empty).collect() == []


def test_sharding(odd, empty):
    rows = sharding.shard(odd, [1.0] * 3).collect()
    assert len(rows) == len(TEXTS)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted((i is None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    for s in range(3):
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    assert sharding.shard(empty, [1.0]).collect() == []
    with pytest.raises(ValueError, match="positive"):
        sharding.shard(odd, [0.0])


def test_dedup(odd, empty):
    rows = dedup.near_duplicates(odd).collect()
    assert len(rows) == len(TEXTS)
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, set()).add((r.class_id, r.n_docs))
    assert of[1] == {(1, 2)}
    assert of[2] == of[3] == {(2, 2)}  # null is the empty text
    assert of[None] == {(None, 2)}
    assert of[5] != of[7]
    kept = dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4, 5, 6, 7]
    assert dedup.near_duplicates(empty).collect() == []
    assert dedup.deduplicated(empty).collect() == []


def test_decontamination(odd, empty, tests):
    hit = odd.filter("doc_id = 1").limit(1).withColumn("text", F.concat(F.lit("intro text. What is this question about? The answer is here! "), "text"))
    rows = decontam.scan(odd.unionByName(hit), tests).collect()
    assert [(r.doc_id, r.item_id, r.question_overlap, r.answer_overlap) for r in rows] == [(1, 1, 1.0, 1.0)] * 2
    assert decontam.clean(odd.unionByName(hit), tests).count() == len(TEXTS)
    assert decontam.scan(empty, tests).collect() == []
    assert decontam.scan(odd, tests.limit(0)).collect() == []
    assert decontam.clean(odd, tests.limit(0)).count() == len(TEXTS)


def test_pii(odd, empty):
    rows = pii.detect(odd, extra=[F.col("doc_id"), F.col("text")]).select("doc_id", "text", pii.listed(F.col("base")).alias("b")).collect()
    assert len(rows) == len(TEXTS)
    assert sorted(r.b for r in rows if r.b) == ["email:26:33"] * 2
    out = pii.redacted(odd)
    assert out.columns == odd.columns
    got = [(r.doc_id, r.text, r.n_chars, r.spans) for r in out.collect() if r.doc_id == 1]
    assert got == [(1, "All rights reserved. Mail [EMAIL] now", 37, 2)] * 2
    assert pii.redacted(empty).collect() == []


def test_secrets(spark, odd, empty):
    model = secrets.train(secrets.labelled(spark, 30))
    token = odd.filter("doc_id = 1").withColumn("text", F.lit("set password = 'b7db7aa4a5fcc78305' now"))
    rows = secrets.scan(odd.unionByName(token), model).filter("secret").collect()
    assert [(r.doc_id, r.start, r.end) for r in rows] == [(1, 16, 34)] * 2
    assert secrets.scan(empty, model).collect() == []


def test_licenses(odd, empty):
    rows = licenses.scan(odd).collect()
    assert [(r.doc_id, r.license, r.coverage, r.start, r.end) for r in rows] == [(1, "all-rights-reserved", 1.0, 0, 19)] * 2
    assert licenses.scan(empty).collect() == []
    with pytest.raises(ValueError, match="fewer"):
        licenses.index([("short", "two words")])


def test_toxicity(odd, empty, labels):
    model = toxicity.train(odd, labels)
    out = toxicity.score(odd, model)
    assert out.columns == odd.columns
    assert all(0 <= r.score <= 1 for r in out.collect())
    assert toxicity.score(empty, model).collect() == []
    blank = toxicity.train(odd, labels.limit(0))
    assert all(r.score < 1e-100 for r in toxicity.score(odd, blank).collect())
    one = toxicity.train(odd, labels.filter("toxic = 1"))
    assert len({r.score for r in toxicity.score(odd, one).collect()}) == 1


def test_lm(odd, empty):
    rows = lm.score(odd, remainder("doc_id", 10) != 0).collect()
    assert len(rows) == len(TEXTS)
    assert all(r.score < 0 and r.n_tokens >= 1 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 7)} == {1}
    assert lm.score(empty, F.lit(True)).collect() == []
    none = lm.score(odd, F.lit(False)).collect()
    assert {(r.base_score, r.score, r.n_known, r.train_tokens) for r in none} == {(0.0, 0.0, 0, 0)}


def test_ann(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (10, [-1.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, rank int")
    out = {}
    for r in ann.search(df, k=3).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(out[0]) == [(1, 1, 1.0), (2, 2, 1.0), (3, 20, 0.5)]
    assert sorted(out[20]) == [(1, 0, 0.5), (2, 1, 0.5), (3, 2, 0.5)]
    assert set(out) == {0, 20}
    assert ann.search(df.limit(0)).collect() == []


@pytest.mark.parametrize("k", range(5))
def test_stages(spark, tmp_path, odd, empty, tests, labels, k):
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    odd.select(*cols).write.parquet(f"{tmp_path}/documents.parquet")
    tests.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.withColumn("toxic", F.lit(0)).write.parquet(f"{tmp_path}/labels.parquet")
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    if k < 4:
        assert out.columns == cols
    assert out.count() >= 7
    assert stage(spark, empty.select(*cols), str(tmp_path)).count() == 0


def test_finished_leaves_the_result_only(spark, odd):
    def places():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{common.shared_dir(spark)}/leafmill/{spark.sparkContext.applicationId}")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return {x.getPath().getName() for x in files.listStatus(path)} if files.exists(path) else set()

    before = places()
    out = common.finished(lambda: common.finished(lambda: common.written(common.written(odd, "one"), "two"), "inner").filter("doc_id = 1"), "outer")
    assert out.count() == 2
    assert [n.split("-")[0] for n in places() - before] == ["outer"]
    with pytest.raises(ZeroDivisionError):
        common.finished(lambda: common.written(odd, "lost").limit(1 // 0), "never")
    assert [n.split("-")[0] for n in places() - before] == ["outer"]


def test_hot_keys_join_as_the_others_do(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rows = spark.range(500).withColumn("k", F.when(F.col("id") < 300, -1).otherwise(F.col("id") % 40))
    table = common.written(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "counted")
    got = common.join_counted(rows, table, "k", "n").collect()
    assert sorted(r.id for r in got) == list(range(500))
    assert {r.n for r in got if r.k == -1} == {300}
