"""Fetch: requests -> responses (E1-E5, F1, F2, J6; quirks Q1-Q3).

Three forms:

* ``fetch(requests, snapshot)`` – the request frontier joined to a page
  snapshot on url: an inner join, for which the planner may broadcast a small
  frontier (never the pages of an outer join's other side), and, with the urls
  of the snapshot alone, an anti-join for the requests that have no page.
* ``fetch(requests, ClusteredSnapshot)`` – the same against pages kept in buckets by
  url (``operators.snapshot``): the frontier alone is moved.
* ``fetch_with(requests, fetcher)`` – a user-supplied client called inside
  ``mapInPandas`` over ``repartition(n, host, salt)`` (politeness per task,
  hot hosts split over a few tasks, one client per partition), with the
  retry policy of E3.

Response projection (F1): a response with HTTP status >= 400 counts as
failed: status 0, empty headers and body, error null; the true code is
kept in ``http_status``. Failed fetches stay in the output (Q3) unless
``on_failed_fetch='drop'``.
"""

from __future__ import annotations

import time
from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.common import empty_map
from pagemill.functions.timefn import http_date, iso_with_offset, local_now, local_now_literal
from pagemill.functions.urls import url_host
from pagemill.operators.dedup import first_wins_wide
from pagemill.operators.requests import normalize_requests
from pagemill.operators.snapshot import ClusteredSnapshot

NO_PAGE = "no page for url in snapshot"


def page_snapshot(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                  version_col: str = "page_id", unique_urls: bool = False) -> DataFrame:
    """One page per url (the highest ``version_col`` wins).

    Only pages whose url repeats are shuffled (``first_wins_wide``); with
    ``unique_urls`` the check is left out as well.
    """
    extra = [c for c in ("status", "headers", "content") if c in pages.columns]
    snap = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        (-F.col(version_col).cast("long")).alias("_order"), *extra)
    if unique_urls:
        return snap.drop("_order")
    return first_wins_wide(snap, "url", "_order").drop("_order")


def fetch(requests: DataFrame, snapshot: DataFrame | ClusteredSnapshot, profile: str = "worker",
          as_of: str | None = None, on_failed_fetch: str = "keep",
          charset: bool = True) -> DataFrame:
    """Responses for ``requests`` from ``snapshot``
    (url, html[, status, headers, content]).

    ``charset``: add encoding, encoding_confidence, encoding_source and
    body_reencoded (X16-X19). A snapshot with raw ``content`` bytes is decoded
    (request ``meta.encoding`` > Content-Type header > meta tag > guess); a
    text snapshot is reported by header / meta evidence and kept as is.
    """
    req = normalize_requests(requests)
    if isinstance(snapshot, ClusteredSnapshot):
        has_bytes, j = snapshot.with_content, snapshot.answers(req)
    else:
        has_bytes, j = "content" in snapshot.columns, _joined(req, snapshot)
    matched = F.col("_surl").isNotNull()
    http_status = F.when(matched, F.col("_code"))
    ok = matched & (F.col("_code") < 400)
    # worker: ISO time with offset; spider: the HTTP Date header form (UTC)
    requested_at = (http_date(F.lit(local_now(as_of, 0)).cast("timestamp_ntz"))
                    if profile == "spider" else iso_with_offset(local_now_literal(as_of)))
    out = j.select(
        F.col("url"),
        F.when(ok, F.col("_code")).otherwise(F.lit(0)).alias("status"),
        http_status.alias("http_status"),
        F.when(ok, F.coalesce(F.col("_hdrs"), empty_map())).otherwise(empty_map()).alias("headers"),
        F.when(ok, F.coalesce(F.col("_html"), F.lit(""))).otherwise(F.lit("")).alias("body"),
        *([F.when(ok, F.col("_content")).alias("content")] if has_bytes else []),
        F.col("meta"),
        requested_at.alias("requested_at"),
        F.when(~matched, F.lit(NO_PAGE)).alias("error"),
        F.col("seq"),
        F.col("attempt"),
    )
    if on_failed_fetch == "drop":
        out = out.filter(F.col("status") != 0)
    if charset:
        out = with_charset_columns(out, decode_bytes=has_bytes)
    return out


def _joined(req: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Every request with the page of its url, if there is one."""
    snap = snapshot.select(
        F.col("url").alias("_surl"), F.col("html").alias("_html"),
        (F.col("status") if "status" in snapshot.columns else F.lit(200)).cast("int").alias("_code"),
        (F.col("headers") if "headers" in snapshot.columns else empty_map()).alias("_hdrs"),
        *([F.col("content").alias("_content")] if "content" in snapshot.columns else []),
    )
    hit = snap.join(req, snap["_surl"] == req["url"], "inner")
    urls = snap.select(F.col("_surl").alias("_known")).filter(F.col("_known").isNotNull())
    miss = req.join(urls, req["url"] == urls["_known"], "left_anti")
    return hit.unionByName(miss, allowMissingColumns=True)


def with_charset_columns(responses: DataFrame, decode_bytes: bool) -> DataFrame:
    """X16-X19 columns on responses; only successful responses carry them."""
    from pagemill.functions import charset as CH

    ok = F.col("status") != 0
    if decode_bytes:
        dec = CH.decode_content(responses, "content", "headers", manual=F.col("meta.encoding"),
                                info="_enc", out="_decoded")
        declared = CH.charset_from_headers(F.col("headers"))
        dec = dec.withColumn("body", F.when(ok, F.col("_decoded")).otherwise(F.col("body")))
        # by text: decoded as the header declares it, the body would read differently; the text
        # can differ only where we decoded with another charset, so only those rows are decoded again
        other = declared.isNotNull() & (F.col("_enc.encoding") != declared)
        dec = dec.withColumn("_declared", F.when(other, CH.decode_as(F.when(other, F.col("content")), declared)))
        reencoded = F.when(declared.isNotNull(), F.coalesce(F.col("_declared") != F.col("body"), F.lit(False)))
        dec = dec.withColumn("_re", reencoded)
        reencoded = F.col("_re")
        out = dec.drop("_decoded", "content", "_declared")
    else:
        out = CH.with_encoding_info(
            responses.withColumn("_bytes", F.encode(F.substring("body", 1, CH.META_SCAN_BYTES), "UTF-8")),
            "_bytes", "headers", manual=F.col("meta.encoding"), statistical=False,
            out="_enc").drop("_bytes")
        out = out.withColumn("encoding_error", F.lit(None).cast("string"))
        reencoded = F.lit(False)
    return (out.withColumn("encoding", F.when(ok, F.col("_enc.encoding")))
            .withColumn("encoding_confidence", F.when(ok, F.col("_enc.confidence")))
            .withColumn("encoding_source", F.when(ok, F.col("_enc.source")))
            .withColumn("body_reencoded", F.when(ok, reencoded))
            .withColumn("encoding_error", F.when(ok, F.col("encoding_error")))
            .drop("_enc", "_re"))


def merge_headers(session_headers: dict, request_headers):
    """Request headers win over session defaults."""
    from pagemill.operators.links import overlay
    base = F.create_map(*[F.lit(x) for kv in session_headers.items() for x in kv]) \
        if session_headers else empty_map()
    return overlay(base, F.coalesce(request_headers, empty_map()))


RESPONSE_SCHEMA = ("url string, status int, http_status int, headers map<string,string>, "
                   "content binary, error string, attempts int, seq array<bigint>, "
                   "meta struct<workflow_index:int,context:map<string,string>,"
                   "params:map<string,string>,encoding:string>")


def fetch_with(requests: DataFrame, fetcher: Callable, num_partitions: int | None = None,
               max_retries: int = 3, retry_delay_s: float = 1.0, min_interval_s: float = 0.0,
               retryable: tuple = (TimeoutError, ConnectionError),
               per_host_parallelism: int = 4) -> DataFrame:
    """E1 (callable form), E3, E5: call ``fetcher(url, method, headers, params, data, json)``
    -> (status, headers dict, content bytes) for each request.

    Requests are grouped by host and split into ``per_host_parallelism``
    salted groups (by url hash), so a host holding a large share of the
    frontier is served by several tasks instead of one, each sequential with
    ``min_interval_s`` between calls (a host sees at most
    ``per_host_parallelism`` requests per interval); ``num_partitions`` plays
    the role of the concurrency setting. Retryable errors are retried up to
    ``max_retries`` attempts with ``retry_delay_s`` between; any other
    exception stops at once. The error text is cleared when a later attempt
    succeeds.
    """
    salt = F.pmod(F.xxhash64(F.col("url")), F.lit(max(1, int(per_host_parallelism))))
    req = (normalize_requests(requests).withColumn("_host", url_host(F.col("url")))
           .withColumn("_salt", salt))
    n = num_partitions or req.sparkSession.sparkContext.defaultParallelism
    req = req.repartition(n, "_host", "_salt")

    def run(batches):
        last = 0.0
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                status, headers, content, error, attempts = 0, {}, None, None, 0
                for attempt in range(max_retries):
                    attempts = attempt + 1
                    wait = min_interval_s - (time.monotonic() - last)
                    if wait > 0:
                        time.sleep(wait)
                    last = time.monotonic()
                    try:
                        status, headers, content = fetcher(
                            r.url, r.method, dict(r.headers or {}), dict(r.params or {}),
                            r.data, r.json)
                        error = None
                        break
                    except retryable as exc:  # noqa: PERF203
                        error = f"request failed: {exc}"
                        if attempt < max_retries - 1:
                            time.sleep(retry_delay_s)
                    except Exception as exc:  # not retryable
                        error = f"unexpected error: {exc}"
                        break
                meta = r.meta
                rows.append((r.url, status if error is None and status < 400 else 0,
                             status if error is None else None,
                             {str(k): str(v) for k, v in (headers or {}).items()}
                             if error is None and status < 400 else {},
                             content if error is None and status < 400 else b"",
                             error, attempts, list(r.seq) if r.seq is not None else None,
                             meta))
            yield pd.DataFrame(rows, columns=["url", "status", "http_status", "headers", "content",
                                              "error", "attempts", "seq", "meta"])

    return req.mapInPandas(run, RESPONSE_SCHEMA)


def fetch_live(requests: DataFrame, fetcher: Callable, wf=None, profile: str = "worker", as_of: str | None = None,
               on_failed_fetch: str = "keep", session_headers: dict | None = None, **policy) -> DataFrame:
    """E1-E5 with a client, in the shape of ``fetch``: request headers over ``session_headers`` (E4), retries
    and pauses of ``fetch_with`` (E3, E5), bytes decoded with the step's or the request's charset. The task's
    concurrency and request interval are those of ``wf`` unless given; ``attempt`` counts the calls made."""
    req = normalize_requests(requests)
    if session_headers:
        req = req.withColumn("headers", merge_headers(session_headers, F.col("headers")))
    if wf is not None:
        if wf.concurrency:
            policy.setdefault("num_partitions", int(wf.concurrency))
        if wf.request_interval:
            policy.setdefault("min_interval_s", float(wf.request_interval))
        steps = [s for s in wf.steps if s.manual_encoding]
        if steps:  # X18: a step's own charset, unless the request names one
            own = F.create_map(*[x for s in steps for x in (F.lit(s.index), F.lit(s.manual_encoding))])
            req = req.withColumn("meta", F.col("meta").withField("encoding", F.coalesce(
                "meta.encoding", own[F.col("meta.workflow_index")])))
    got = fetch_with(req, fetcher, **policy)
    requested_at = (http_date(F.lit(local_now(as_of, 0)).cast("timestamp_ntz"))
                    if profile == "spider" else iso_with_offset(local_now_literal(as_of)))
    got = got.select("url", "status", "http_status", "headers", F.lit("").alias("body"), "content", "meta",
                     requested_at.alias("requested_at"), "error", "seq", F.col("attempts").alias("attempt"))
    if on_failed_fetch == "drop":
        got = got.filter(F.col("status") != 0)
    return with_charset_columns(got, decode_bytes=True)
