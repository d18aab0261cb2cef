"""The link stream hands its Python workers small batches, whatever the session allows."""

import pytest
from pyspark.sql import functions as F

from pagemill.streaming.pipeline import STATE_STORE, STREAM_BATCH, start_link_dedup_stream

ROWS, SIZE = STREAM_BATCH


@pytest.fixture
def session(spark):
    before = {key: spark.conf.get(key, None) for key in STREAM_BATCH}
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _links(spark, tmp_path) -> list:
    """The winners of 3,000 rows with 1,500 links in two micro-batches, with the rows of the batch that each one
    came to Python in."""
    @F.pandas_udf("int")
    def batch_rows(url):
        return url.map(lambda _: len(url)).astype("int32")

    requests, sink = f"{tmp_path}/requests", f"{tmp_path}/links"
    rows = spark.range(0, 3000, 1, 1).select(F.format_string("http://a.test/%d", F.col("id") % 1500).alias("url"),
                                             F.array(F.lit(0).cast("long"), 3000 - F.col("id")).alias("seq"))
    for part in (rows.filter(F.col("seq")[1] > 200), rows.filter(F.col("seq")[1] <= 200)):
        part.coalesce(1).write.mode("append").parquet(requests)
        stream = spark.readStream.schema(rows.schema).parquet(requests).withColumn("batch_rows", batch_rows("url"))
        start_link_dedup_stream(spark, stream, sink, f"{tmp_path}/ckpt").awaitTermination()
    return spark.read.parquet(sink).collect()


def test_batches_of_the_link_stream_are_small(session, tmp_path):
    session.conf.set(ROWS, "10000")
    session.conf.set(SIZE, "64m")
    store = session.conf.get(STATE_STORE, None)
    won = _links(session, tmp_path)
    # the second half of the first micro-batch beats the first one; links of the second one came before
    first = {f"http://a.test/{i % 1500}": 3000 - i for i in range(2800)}
    assert {r.url: r.seq[1] for r in won} == first and len(won) == 1500
    assert max(r.batch_rows for r in won) <= STREAM_BATCH[ROWS]
    assert (session.conf.get(ROWS), session.conf.get(SIZE)) == ("10000", "64m")
    assert session.conf.get(STATE_STORE, None) == store


def test_smaller_batches_of_a_session_stay(session, tmp_path):
    session.conf.set(ROWS, "100")
    session.conf.set(SIZE, "1m")
    assert max(r.batch_rows for r in _links(session, tmp_path)) <= 100
