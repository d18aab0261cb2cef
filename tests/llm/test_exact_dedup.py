import hashlib
import re

from pyspark.sql import functions as F

from pagemill.llm.exact_dedup import drop_duplicates, exact_duplicates, frequent_digests

SCHEMA = "doc_id long, text string, digest string, __n int"


def brute(rows):
    groups = {}
    for doc, text in rows:
        t = text or ""
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        groups.setdefault(key, []).append((-len(t), doc is None, doc or 0, doc))
    return {key: (min(g)[3], len(g)) for key, g in groups.items()}


def table(spark, rows):
    return spark.createDataFrame([(d, t, "other", 1) for d, t in rows], SCHEMA)


ROWS = [(5, "a b"), (3, "ab"), (4, "a  b"), (9, None), (8, ""), (7, " \t\n\x0b\x0c\r"), (None, "null id"), (2, "null id"),
        (1, "é x"), (10, "éx"), (11, "same"), (11, "same"), (12, "x" * 100_000), (13, "x" * 100_000 + " "),
        *[(100 + i, "hot " * (1 + i % 2)) for i in range(400)]]


def test_matches_brute_force(spark):
    got = exact_duplicates(table(spark, ROWS).repartition(5)).collect()
    want = brute(ROWS)
    assert len(got) == len(ROWS)
    by = {hashlib.sha256(k.encode()).digest(): v for k, v in want.items()}
    for r in got:
        assert (r["keep_id"], r["group_size"]) == by[bytes(r["digest"])]
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(want)  # one row a group, also of rows that repeat id and text


def test_heavy_path_and_ordinary_path_agree(spark):
    df = table(spark, ROWS)
    few = {tuple(r) for r in exact_duplicates(df, counters=1).select("id", "keep_id", "group_size").collect()}
    many = {tuple(r) for r in exact_duplicates(df).select("id", "keep_id", "group_size").collect()}
    assert few == many


def test_summaries_find_the_frequent(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).cast("binary").alias("digest"))
    found = frequent_digests(rows.repartition(4), 8).collect()
    assert b"hot" in {bytes(r["digest"]) for r in found} and len(found) <= 8


def test_drop_keeps_columns_and_one_row_a_group(spark):
    out = drop_duplicates(table(spark, ROWS))
    assert out.columns == ["doc_id", "text", "digest", "__n"]
    rows = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(rows) == len(brute(ROWS))
    assert (4, "a  b") in rows and rows.count((11, "same")) == 1 and (2, "null id") in rows


def test_empty(spark):
    df = table(spark, [])
    assert exact_duplicates(df).count() == 0 and drop_duplicates(df).count() == 0
