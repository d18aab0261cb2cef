"""urljoin, hashes, masking, time functions."""

import datetime as dt
import hashlib
from urllib.parse import urljoin as py_urljoin

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.functions import timefn as T
from pagemill.functions.hashing import content_hash, link_hash
from pagemill.functions.urls import mask_url, url_host, urljoin

BASE = "http://a/b/c/d;p?q"
RFC_5_4 = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/",
    "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y",
    "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", ";x": "http://a/b/c/;x",
    "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "..": "http://a/b/", "../g": "http://a/b/g",
    "../../g": "http://a/g", "g;x?y#s": "http://a/b/c/g;x?y#s",
}


def test_urljoin_rfc3986_examples(spark):
    df = spark.createDataFrame([(BASE, k) for k in RFC_5_4], "b string, r string")
    got = {r.r: r.u for r in df.select("r", urljoin(F.col("b"), F.col("r")).alias("u")).collect()}
    assert got == RFC_5_4


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab/.?#:;=%", max_size=8), min_size=1, max_size=20))
def test_urljoin_equals_stdlib(spark, refs):
    df = spark.createDataFrame([("https://h.test/x/y?z", r) for r in refs], "b string, r string")
    got = [r.u for r in df.select(urljoin(F.col("b"), F.col("r")).alias("u")).collect()]
    assert got == [py_urljoin("https://h.test/x/y?z", r) for r in refs]


def test_hashes_empty_is_empty(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,), ("中文",)], "t string")
    rows = df.select(link_hash(F.col("t")), content_hash(F.col("t"))).collect()
    assert rows[0][0] == hashlib.md5(b"abc").hexdigest()
    assert rows[3][1] == hashlib.sha256("中文".encode()).hexdigest()
    assert [tuple(r) for r in rows[1:3]] == [("", ""), ("", "")]


def test_mask_and_host(spark):
    df = spark.createDataFrame([("redis://:pw@host:6379/0",), ("http://u:p@proxy:8080",),
                                ("https://plain.test/x",)], "u string")
    got = [tuple(r) for r in df.select(mask_url(F.col("u")), url_host(F.col("u"))).collect()]
    assert got == [("redis://:****@host:6379/0", "host"), ("http://u:****@proxy:8080", "proxy"),
                   ("https://plain.test/x", "plain.test")]


def test_time_strings(spark):
    df = spark.createDataFrame([("2024-03-05T10:11:12.5+08:00",), ("Tue, 05 Mar 2024 02:11:12 GMT",),
                                ("",), (None,)], "s string")
    got = [r[0] for r in df.select(T.parse_requested_at(F.col("s"))).collect()]
    assert got[0] == dt.datetime(2024, 3, 5, 2, 11, 12, 500000)
    assert got[1] == dt.datetime(2024, 3, 5, 2, 11, 12)
    assert got[2] is None and got[3] is None


def test_local_now_and_iso(spark):
    assert T.local_now("2024-01-01T00:00:00") == dt.datetime(2024, 1, 1, 8, 0)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8, 0, 0),), (dt.datetime(2024, 1, 1, 8, 0, 0, 5),)],
                               "t timestamp_ntz")
    got = [r[0] for r in df.select(T.iso_with_offset(F.col("t"))).collect()]
    assert got == ["2024-01-01T08:00:00+08:00", "2024-01-01T08:00:00.000005+08:00"]


def test_urljoin_resolves_as_rfc_3986_says(spark):
    from pyspark.sql import functions as F

    from pagemill.functions.urls import urljoin

    base = "http://a/b/c/d;p?q"
    want = {"g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g",
            "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s",
            "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x",
            "": base, ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/",
            "../g": "http://a/b/g", "../..": "http://a/", "../../g": "http://a/g", "../../../g": "http://a/g",
            "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", "..g": "http://a/b/c/..g",
            "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/../h": "http://a/b/c/h", "g?y/../x": "http://a/b/c/g?y/../x",
            "http:g": "http://a/b/c/g", " \n/x\ty": "http://a/xy", "mailto:a@b": "mailto:a@b", "http://[x": None}
    df = spark.createDataFrame([(base, r) for r in want] + [(None, "g")], "b string, r string")
    got = df.select("b", "r", urljoin(F.col("b"), F.col("r")).alias("u")).collect()
    assert {x.r: x.u for x in got if x.b} == want and [x.u for x in got if not x.b] == [None]


def test_codec_names_are_text_encodings_that_encode():
    from pagemill.functions.charset import CODEC_KEYS

    assert {"utf_8", "gbk", "big5", "latin_1"} <= set(CODEC_KEYS)
    assert not {"base64", "undefined", "rot13", "hex"} & set(CODEC_KEYS)


def test_a_charset_that_cannot_decode_is_reported(spark):
    from pagemill.functions.charset import decode_content

    df = spark.createDataFrame([(bytearray(b'<meta charset="idna">a..b'), {}), (bytearray(b'<meta charset="undefined">x'), {})],
                               "content binary, headers map<string,string>")
    rows = decode_content(df, "content").select("body", "encoding_error").collect()
    assert all(r.body for r in rows) and any((r.encoding_error or "").startswith("idna") for r in rows)


def test_urljoin_patterns_agree_with_full_resolution(spark):
    from urllib.parse import urljoin as python_join

    from pagemill.functions.urls import resolved, urljoin

    bases = ["https://h.test/a/b?q#f", "http://h.test", "https://u:p@h.test:80/x/", "HTTPS://H.test/a", "https://[::1]/a", "ftp://h/a", "/rel"]
    refs = ["https://o.test/x", "https://o.test", "http://o.test/a/../b", "https://o.test/?", "https://o.test/#", "https://o.test/a;p",
            "https://o.test/?q=1#x", "HTTPS://o.test/", "https://[x/", "//o.test/x", "/", "/x", "/x/../y", "/x/.hidden", "/./x", "/a//b",
            "/x;p", "/x?", "/x?q", "/x?q#", "/x#f", "/x?a/../b", "/a b", "/é", "x", "?q", "#f", "", " /x", "/x\n", "mailto:a@b"]
    df = spark.createDataFrame([(b, r) for b in bases for r in refs], "b string, r string")
    got = df.select("b", "r", urljoin(F.col("b"), F.col("r")).alias("fast"), resolved(F.col("b"), F.col("r")).alias("full")).collect()
    for x in got:
        assert x.fast == x.full, (x.b, x.r)
        if "[" not in x.b + x.r:
            assert x.fast == python_join(x.b, x.r), (x.b, x.r)
