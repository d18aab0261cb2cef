import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from pagemill.llm import warc


def rows_of():
    long = "<p>" + "shared text " * 40 + "</p>"
    rows = [(i, f"http://h/{i}", f"<p>page {i} " + "x" * (i % 7 * 50) + "</p>") for i in range(200)]
    rows += [(500 + i, f"http://h/{i}", long) for i in range(60)]
    return rows + [(700, None, "short"), (701, "http://s", "short"), (702, "http://n", None), (703, "u\r\nInjected: 1", ""),
                   (None, "http://null", long), (704, "é", "日本 " * 60), (705, "http://t", "twice " * 50),
                   (705, "http://t", "twice " * 50), (706, "http://big", "y" * 500_000)]


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows_of()],
                                 "page_id long, url string, html string, digest string")


def test_round_trip(spark, frame, tmp_path):
    folder = f"file://{tmp_path}/a"
    warc.write(frame.repartition(6), folder, shard_bytes=2000, range_bytes=20_000)
    got = warc.read(spark, folder, with_payload=True).collect()
    rows = rows_of()
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    texts = {(i, (h or "").encode()) for i, _, h in rows}
    by_digest = {hashlib.sha256((h or "").encode()).hexdigest(): h or "" for _, _, h in rows}
    responses = {}
    for r in got:
        text = by_digest[r["payload_digest"]]
        assert (r["page_id"], text.encode()) in texts and r["payload_bytes"] == len(text.encode())
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == text.encode() and r["refers_to"] is None
            responses.setdefault(text, []).append(r["page_id"])
        else:
            assert r["refers_to"] == first[text]
    for text, ids in responses.items():
        if len(text.encode()) >= 100:
            assert ids == [first[text]]
    assert sum(r["page_id"] == 705 and r["record_type"] == "revisit" for r in got) == 1


def test_same_rows_same_bytes(spark, frame, tmp_path):
    for name, parts in (("a", 3), ("b", 9)):
        warc.write(frame.repartition(parts), f"file://{tmp_path}/{name}", shard_bytes=2000, range_bytes=20_000)
    shards = [{f: (tmp_path / d / f).read_bytes() for f in os.listdir(tmp_path / d) if f.endswith(".gz")} for d in "ab"]
    assert shards[0] == shards[1] and len(shards[0]) > 5
    ids = []
    for name in sorted(shards[0]):
        plain = gzip.decompress(shards[0][name])
        ids += [int(x.split(b": ")[1]) for x in plain.split(b"\r\n") if x.startswith(b"X-Page-ID")]
    assert ids == sorted(ids)
    assert not [f for f in os.listdir(tmp_path / "a") if f.endswith(".tmp")]
    manifest = spark.read.parquet(f"file://{tmp_path}/a/manifest").collect()
    assert {m["shard"]: (m["bytes"], m["sha256"]) for m in manifest} == {
        k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in shards[0].items()}


def test_ranges_follow_the_bytes_however_ids_are_spread(spark):
    """Far-off ids, clusters, an id and nulls that are heavier than a range: parts are bounded and in order."""
    ids = [*range(2000), *range(10 ** 12, 10 ** 12 + 500), 2 ** 62, -(2 ** 62), *[77] * 600, *[None] * 600]
    rows = [(i, hashlib.sha256(str(k).encode()).hexdigest(), 100) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "page_id long, digest string, payload_bytes long")
    plan = warc._ranges(df, 10_000, cells=16)
    got = df.withColumn("part", plan.part(F.col("page_id"), F.col("digest"))).collect()
    size = {}
    for r in got:
        size[r["part"]] = size.get(r["part"], 0) + 100
    assert max(size.values()) <= 15_000 and len(size) <= plan.parts < 2.5 * len(ids) * 100 / 10_000
    order = sorted(got, key=lambda r: (r["page_id"] is not None, r["page_id"] or 0, r["digest"]))
    assert [r["part"] for r in order] == sorted(r["part"] for r in got)


def test_one_task_a_shard(spark, frame, tmp_path):
    folder = f"file://{tmp_path}/a"
    warc.write(frame.unionByName(frame.limit(1).withColumn("page_id", F.lit(2 ** 61))), folder, shard_bytes=2000,
               range_bytes=20_000)
    shards = spark.read.parquet(f"{folder}/manifest").count()
    read = warc.read(spark, folder)
    assert shards > 10 and read.rdd.getNumPartitions() == shards
    tasks = read.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > shards / 2


def test_damage_is_noticed_and_strays_are_not_read(spark, frame, tmp_path):
    folder = f"file://{tmp_path}/a"
    warc.write(frame, folder)
    (tmp_path / "a" / "pages-999999-00000.warc.gz").write_bytes(b"left behind")
    n = warc.read(spark, folder).count()
    assert n == len(rows_of())
    shard = tmp_path / "a" / spark.read.parquet(f"{folder}/manifest").first()["shard"]
    shard.write_bytes(shard.read_bytes()[:-30])
    with pytest.raises(Exception):
        warc.read(spark, folder).count()


def test_empty(spark, frame, tmp_path):
    folder = f"file://{tmp_path}/a"
    warc.write(frame.limit(0), folder)
    assert warc.read(spark, folder).count() == 0
    warc.write(frame.where(F.col("page_id").isNull()), f"file://{tmp_path}/b")
    assert [tuple(r)[:1] + (r["record_type"],) for r in warc.read(spark, f"file://{tmp_path}/b").collect()] == [(None, "response")]
