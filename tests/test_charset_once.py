"""The evidence of a charset is searched once a row, and texts are decoded in slices."""

import pyarrow as pa
from pyspark.sql import functions as F

from pagemill.functions import charset as CH


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_charset_is_searched_once_in_one_pass(spark):
    df = spark.createDataFrame([(1, bytearray(b"abc"), {"Content-Type": "text/html; charset=gbk"}, None)],
                               "id int, content binary, headers map<string,string>, manual string")
    plan = _plan(CH.decode_content(df, manual=F.col("manual")).select("id", "body"))
    assert plan.count("ArrowEvalPython") == 1 and "Union" not in plan and "Filter" not in plan


def test_each_row_is_read_by_its_own_evidence(spark):
    rows = [(1, b"caf\xe9", {"content-TYPE": "x; charset='latin-1'"}, None), (2, b"\xc4\xe3", None, "gbk"),
            (3, b'<meta charset="big5">\xa7A', {}, None), (4, b"\xc3\xa9", {"Content-Type": "charset=gbk"}, " UTF-8 "),
            (5, None, {"Content-Type": "charset=gbk"}, None), (6, b"<meta charset='big5'>\xe9", {"Content-Type": "charset=none"}, "bad")]
    df = spark.createDataFrame([(i, None if c is None else bytearray(c), h, m) for i, c, h, m in rows],
                               "id int, content binary, headers map<string,string>, manual string")
    got = {r.id: (r.body, r.encoding_info.encoding, r.encoding_info.source, r.encoding_error)
           for r in CH.decode_content(df, manual=F.col("manual")).collect()}
    assert got[1][0] == "café" and got[1][2] == CH.SOURCE_HEADER
    assert got[2] == ("你", "gbk", CH.SOURCE_MANUAL, None)
    assert got[3] == ('<meta charset="big5">你', "big5", CH.SOURCE_META, None)
    assert got[4] == ("é", "utf-8", CH.SOURCE_MANUAL, None)
    assert got[5] == ("", "gbk", CH.SOURCE_HEADER, None)
    assert got[6] == ("<meta charset='big5'>�", "big5", CH.SOURCE_META, None)


def test_texts_leave_the_decoder_in_slices():
    n = 2 * CH.SLICE_ROWS + 1
    out = list(CH._read_slices(iter([(pa.array([b"\xc4\xe3"] * n), pa.array(["gbk"] * n), pa.array([True] * n))])))
    assert [len(a) for a in out] == [CH.SLICE_ROWS] * 2 + [1]
    assert out[0][0].as_py() == {"encoding": "gbk", "confidence": None, "body": "你", "error": None}
