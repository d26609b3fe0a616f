from datetime import datetime, timedelta

from leafmill.operators import cache
from leafmill.plans.queries import QUERIES
from leafmill.streaming import cache as stream_cache
from leafmill.streaming import pages

AT = datetime(2024, 1, 1)
REQUESTS = [("k", i, AT + timedelta(seconds=s), ok) for i, (s, ok) in enumerate([(0, True), (200, True), (299, False), (300, False), (310, True), (331, True), (500, True)])] + [("j", 99, AT, True)]
WANT = {0: False, 1: True, 2: True, 3: False, 4: True, 5: False, 6: True, 99: False}


def test_replay_and_stream_agree(spark, tmp_path):
    batch = spark.createDataFrame(REQUESTS, "key string, id long, at timestamp, ok boolean")
    assert {r.id: r.cached for r in cache.replay(batch, "key", "at", "id", ok="ok").collect()} == WANT
    folder = str(tmp_path / "requests")
    batch.filter("id < 3 or id = 99").coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(batch.schema).parquet(folder)
    answers = stream_cache.answered(stream)

    def run():
        query = answers.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        assert query.awaitTermination(60)

    run()
    batch.filter("id >= 3 and id < 99").coalesce(1).write.mode("append").parquet(folder)
    run()
    assert {r.id: r.cached for r in spark.read.parquet(str(tmp_path / "out")).collect()} == WANT


def test_pages_are_read_as_they_arrive(spark, small, tmp_path):
    spark.read.parquet(f"{small}/pages.parquet").repartition(2).write.parquet(str(tmp_path / "pages"))
    query = pages.read_text(pages.arriving(spark, str(tmp_path / "pages"))).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    assert query.awaitTermination(60)
    want = {r.page_id: r.text for r in QUERIES["read_text"](spark, small).collect()}
    assert {r.page_id: r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want
