"""Charset columns (charset_bytes), fetch outcomes, message decoding (bad_messages), pending rows."""

import pytest
from pyspark.sql import functions as F

from pagemill.functions import charset as CH
from pagemill.operators.fetch import fetch, fetch_with, page_snapshot
from pagemill.operators.requests import requests_from_rows
from pagemill.sources.queue import decode_messages, encode_requests, requests_from_pending

TEXT = "中文字符 and ascii"
BIG5 = "繁體中文"


def _charset_rows():
    return [
        ("header-gbk", TEXT.encode("gbk"), {"Content-Type": "text/html; charset=GBK"}, None),
        ("header-quoted", TEXT.encode("utf-8"), {"content-type": "text/html; charset=\"utf8\""}, None),
        ("meta-gb2312", f'<meta charset="gb2312"><p>{TEXT}</p>'.encode("gb2312"), {}, None),
        ("meta-http-equiv", f'<meta http-equiv="Content-Type" content="text/html; charset=big5">{BIG5}'.encode("big5"), {}, None),
        ("manual-latin1", "café".encode("latin-1"), {}, "ISO-8859-1"),
        ("manual-invalid", "café".encode("utf-8"), {"Content-Type": "text/html; charset=utf-8"}, "no-such-codec"),
        ("header-invalid", "plain".encode("utf-8"), {"Content-Type": "text/html; charset=x-bogus"}, None),
        ("bad-bytes", b"ok \xff\xfe end", {"Content-Type": "text/html; charset=utf-8"}, None),
        ("none", b"", {}, None),
    ]


@pytest.fixture(scope="module")
def decoded(spark):
    df = spark.createDataFrame(_charset_rows(),
                               "name string, content binary, headers map<string,string>, manual string")
    info = CH.with_encoding_info(df, manual=F.col("manual"))
    out = CH.with_decoded_body(info)
    return {r.name: r for r in out.collect()}


def test_detection_order_and_sources(decoded):
    assert decoded["header-gbk"].encoding_info.encoding == "gbk"
    assert decoded["header-gbk"].encoding_info.source == "Content-Type header"
    assert decoded["header-quoted"].encoding_info.encoding == "utf-8"
    assert decoded["meta-gb2312"].encoding_info.encoding == "gb2312"
    assert decoded["meta-gb2312"].encoding_info.confidence == 0.95
    assert decoded["meta-http-equiv"].encoding_info.encoding == "big5"
    assert decoded["manual-latin1"].encoding_info.source == "manual"
    assert decoded["manual-invalid"].encoding_info.source == "Content-Type header"
    assert decoded["none"].encoding_info.source == "default"
    assert list(decoded["header-gbk"].encoding_info.methods) == ["header"]


def test_decoding(decoded):
    assert decoded["header-gbk"].body == TEXT
    assert TEXT in decoded["meta-gb2312"].body
    assert BIG5 in decoded["meta-http-equiv"].body
    assert decoded["manual-latin1"].body == "café"
    assert decoded["bad-bytes"].body == b"ok \xff\xfe end".decode("utf-8", "replace")
    assert decoded["none"].body == ""


def test_normalize_encoding(spark):
    df = spark.createDataFrame([("UTF8",), (" Latin1 ",), ("windows-1252",), ("nope",), ("",), (None,)], "e string")
    got = [r[0] for r in df.select(CH.normalize_encoding(F.col("e"))).collect()]
    assert got == ["utf-8", "iso-8859-1", "windows-1252", None, None, None]


def test_fetch_outcomes(spark):
    pages = spark.createDataFrame(
        [(1, "https://h/ok", "<p>older</p>", 200), (2, "https://h/404", "nf", 404),
         (3, "https://h/500", "err", 500), (4, "https://h/ok", "<p>ok</p>", 200)],
        "page_id long, url string, html string, status int")
    snap = page_snapshot(pages)
    reqs = requests_from_rows(spark, [{"url": u} for u in
                                      ["https://h/ok", "https://h/404", "https://h/500", "https://h/none", ""]])
    got = {r.url: r for r in fetch(reqs, snap, as_of="2024-01-01T00:00:00").collect()}
    assert set(got) == {"https://h/ok", "https://h/404", "https://h/500", "https://h/none"}  # no url: skipped
    assert got["https://h/ok"].status == 200 and got["https://h/ok"].body == "<p>ok</p>"  # highest page_id is the current version
    assert (got["https://h/404"].status, got["https://h/404"].http_status, got["https://h/404"].body) == (0, 404, "")
    assert got["https://h/404"].error is None
    assert got["https://h/none"].status == 0 and got["https://h/none"].error
    assert got["https://h/ok"].requested_at == "2024-01-01T08:00:00+08:00"
    spider = fetch(reqs, snap, profile="spider", as_of="2024-01-01T00:00:00").first()
    assert spider.requested_at == "Mon, 01 Jan 2024 00:00:00 GMT"
    assert fetch(reqs, snap, on_failed_fetch="drop").count() == 1


def test_fetch_with_callable_retries(spark):
    def fake(url, method, headers, params, data, json):
        if "timeout" in url:
            raise TimeoutError("slow")
        if "boom" in url:
            raise ValueError("broken")
        return (404 if "missing" in url else 200), {"Content-Type": "text/html"}, b"<p>x</p>"

    reqs = requests_from_rows(spark, [{"url": f"https://h/{p}"} for p in ["a", "timeout", "boom", "missing"]])
    got = {r.url: r for r in fetch_with(reqs, fake, num_partitions=2, retry_delay_s=0.0).collect()}
    assert got["https://h/a"].status == 200 and bytes(got["https://h/a"].content) == b"<p>x</p>"
    assert got["https://h/timeout"].attempts == 3 and got["https://h/timeout"].status == 0
    assert got["https://h/boom"].attempts == 1 and "broken" in got["https://h/boom"].error
    assert got["https://h/missing"].http_status == 404 and got["https://h/missing"].status == 0


def test_bad_messages_dead_lettered(spark):
    msgs = spark.createDataFrame([
        ('{"url": "https://h/1", "method": "post", "meta": {"workflow_index": 2}}', [0, 1]),
        ('{"url": "https://h/2"', [0, 2]),                              # truncated
        ('{"method": "GET"}', [0, 3]),                                  # missing url
        ('{"url": "https://u:secret@h/3", "meta": "wrong type"}', [0, 4]),
        ('{"url": 5}', [0, 5]),                                         # wrong type, coerced to text
    ], "value string, seq array<bigint>")
    reqs, dead = decode_messages(msgs)
    r = {x.url: x for x in reqs.collect()}
    assert r["https://h/1"].method == "POST" and r["https://h/1"].meta.workflow_index == 2
    assert r["https://u:secret@h/3"].meta.workflow_index == 0
    errs = sorted(d.error for d in dead.collect())
    assert errs == ["invalid JSON", "missing url"]
    reqs2, dead2 = decode_messages(msgs, missing_url="skip")
    assert [d.error for d in dead2.collect()] == ["invalid JSON"]
    enc = encode_requests(reqs).first().value
    assert enc.startswith('{"url":')


def test_pending_requests(spark):
    pending = spark.createDataFrame([
        (1, "https://h/a", None, '{"User-Agent": "x"}', '{"q": "1"}', '{"test": "true"}', None),
        (2, "https://h/b", "POST", "", "{}", None, None),
    ], "id long, url string, method string, headers_json string, params_json string, meta_json string, created_at timestamp")
    got = {r.url: r for r in requests_from_pending(pending).collect()}
    a, b = got["https://h/a"], got["https://h/b"]
    assert a.method == "GET" and a.headers == {"User-Agent": "x"} and a.meta.params == {"q": "1"}
    assert a.params is None and a.meta.context == {"test": "true"}
    assert b.method == "POST" and b.headers == {} and b.meta.params is None
    assert requests_from_pending(pending, since_id=1).count() == 1


def test_decode_content_matches_two_step_form(spark, decoded):
    df = spark.createDataFrame(_charset_rows(),
                               "name string, content binary, headers map<string,string>, manual string")
    got = {r.name: r for r in CH.decode_content(df, manual=F.col("manual")).collect()}
    assert set(got) == set(decoded)
    for name, r in got.items():
        assert r.body == decoded[name].body, name
        assert r.encoding_info.encoding == decoded[name].encoding_info.encoding, name
        assert r.encoding_info.source == decoded[name].encoding_info.source, name


def test_merge_headers_request_wins(spark):
    from pagemill.operators.fetch import merge_headers

    df = spark.createDataFrame([({"User-Agent": "req", "X": "1"},), (None,)], "h map<string,string>")
    got = [r[0] for r in df.select(merge_headers({"User-Agent": "session", "Accept": "*/*"}, F.col("h"))).collect()]
    assert got[0] == {"Accept": "*/*", "User-Agent": "req", "X": "1"}
    assert got[1] == {"User-Agent": "session", "Accept": "*/*"}


def test_run_sql_named_parameters(spark):
    from pagemill.sources.queue import run_sql

    spark.createDataFrame([("t1", 1), ("t2", 2)], "task_id string, n int").createOrReplaceTempView("arts")
    got = run_sql(spark, "SELECT n FROM arts WHERE task_id = :task", task="t2").collect()
    assert [r.n for r in got] == [2]


def test_step_manual_encoding(spark):
    from pagemill.config import parse_config

    step = parse_config({"taskInfo": {}, "workflowSteps": [
        {"type": "data_extraction", "config": {"encodingMode": "manual", "encoding": "gbk"}},
        {"type": "data_extraction", "config": {"encodingMode": "auto", "encoding": "gbk"}}]}).steps
    assert step[0].manual_encoding == "gbk" and step[1].manual_encoding is None
    df = spark.createDataFrame([(TEXT.encode("gbk"),)], "content binary")
    out = CH.decode_content(df, headers="none", manual=F.lit(step[0].manual_encoding)).first()
    assert out.body == TEXT and out.encoding_info.source == "manual"


def test_fetch_decodes_snapshot_bytes(spark):
    pages = spark.createDataFrame([
        (1, "https://h/gbk", "", {"Content-Type": "text/html; charset=gbk"}, TEXT.encode("gbk")),
        (2, "https://h/meta", "", {}, f'<meta charset="big5">{BIG5}'.encode("big5")),
        (3, "https://h/manual", "", {"Content-Type": "text/html; charset=utf-8"}, "café".encode("latin-1")),
    ], "page_id long, url string, html string, headers map<string,string>, content binary")
    snap = page_snapshot(pages, unique_urls=True)
    reqs = requests_from_rows(spark, [{"url": "https://h/gbk"}, {"url": "https://h/meta"},
                                      {"url": "https://h/manual", "meta": {"encoding": "latin-1"}},
                                      {"url": "https://h/none"}])
    got = {r.url: r for r in fetch(reqs, snap).collect()}
    g, m, man, none = (got[u] for u in ["https://h/gbk", "https://h/meta", "https://h/manual", "https://h/none"])
    assert (g.body, g.encoding, g.encoding_source, g.body_reencoded) == (TEXT, "gbk", "Content-Type header", False)
    assert BIG5 in m.body and (m.encoding, m.encoding_confidence, m.body_reencoded) == ("big5", 0.95, None)
    assert (man.body, man.encoding_source, man.body_reencoded) == ("café", "manual", True)
    assert none.encoding is None and none.body == ""


def test_fetch_text_snapshot_charset_columns(spark):
    pages = spark.createDataFrame([(1, "https://h/a", '<meta charset="UTF-8"><p>x</p>')],
                                  "page_id long, url string, html string")
    r = fetch(requests_from_rows(spark, [{"url": "https://h/a"}]), page_snapshot(pages)).first()
    assert (r.encoding, r.encoding_source, r.body_reencoded) == ("utf-8", "HTML meta tag", False)


def test_queue_round_trip_multiple_queues(spark):
    from pagemill.sources.queue import read_queue, write_queue
    from pagemill.streaming.pipeline import scratch_dir

    root = scratch_dir(spark, "queues")
    reqs = requests_from_rows(spark, [
        {"url": "https://h/中文", "meta": {"workflow_index": 2, "context": {"title": "标题"}}},
        {"url": "https://h/b", "method": "post"}])
    write_queue(encode_requests(reqs), f"{root}/start")
    write_queue(encode_requests(requests_from_rows(spark, [{"url": "https://h/c"}])), f"{root}/retry")
    raw = read_queue(spark, [f"{root}/start", f"{root}/retry"])
    assert raw.count() == 3
    assert any("中文" in r.value and "\\u" not in r.value for r in raw.collect())  # unescaped
    back, dead = decode_messages(raw)
    got = {r.url: r for r in back.collect()}
    assert dead.count() == 0 and set(got) == {"https://h/中文", "https://h/b", "https://h/c"}
    assert got["https://h/中文"].meta.context == {"title": "标题"} and got["https://h/b"].method == "POST"
