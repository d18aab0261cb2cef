"""Polite fetching as a plan: every request gets a slot of its host, failures come back later.

A host answers ``parallel`` requests per interval. The place of a request among those of
its host gives its slot, the slot its due time; places come from one range-partitioned sort by
(host, order) and sums of the hosts' counts over its partitions, so a host with a third of all
requests is ranked by many tasks. No task waits: the requests of a round are called in waves of
``window_s`` seconds, and the driver starts a wave when it is due. Requests that fail with a
retryable error form the next round, with ``attempt + 1`` and the slots after those that
their host has used; other errors, and the last attempt's, are final.
"""

from __future__ import annotations

import inspect
import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.common import empty_map
from pagemill.functions.urls import url_host
from pagemill.operators.requests import normalize_requests
from pagemill.session import cut_lineage, drop_tables

#: What a call answers; the request's own columns pass by as they are.
CALLED = "status int, http_status int, headers map<string,string>, content binary, error string, retryable boolean"
CALL_SCHEMA = ("url string, host string, seq array<bigint>, meta struct<workflow_index:int,context:map<string,string>,"
               f"params:map<string,string>,encoding:string>, attempt int, slot long, due double, {CALLED}")
#: Calls whose answers a task holds at one time.
AT_ONCE = 256


def places(rows: DataFrame, key: str, order: str, written: list | None = None) -> DataFrame:
    """``rows`` with ``place``: 0, 1, 2 ... within each ``key`` by ``order`` (equal rows in any order).

    No key is gathered in a task: the sort deals large keys over several partitions, and what is summed per key
    is one count a partition.
    """
    sorted_rows = cut_lineage(rows.orderBy(key, order).withColumn("_at", F.monotonically_increasing_id()), written)
    part = F.shiftright("_at", 33)
    spans = sorted_rows.groupBy(F.col(key).alias("_key"), part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    joined = sorted_rows.join(spans, F.col(key).eqNullSafe(F.col("_key")) & (part == F.col("_part")))
    return joined.withColumn("place", F.col("_at") - F.col("_first") + F.col("_before")).drop(
        "_at", "_key", "_part", "_first", "_before")


def due_slots(requests: DataFrame, used: DataFrame | None = None, interval_s: float = 1.0, parallel: int = 1,
              written: list | None = None) -> DataFrame:
    """Requests with ``host``, ``slot`` and ``due`` (seconds from the start). ``used`` (host, used): slots of earlier
    rounds. Urls without a host share the host ''."""
    hosted = requests.withColumn("host", F.coalesce(url_host(F.col("url")), F.lit("")))
    placed = places(hosted, "host", "seq", written)
    if used is not None:
        placed = placed.join(used.select(F.col("host").alias("_host"), "used"), F.col("host") == F.col("_host"), "left").drop("_host")
    slot = F.col("place") + (F.coalesce(F.col("used"), F.lit(0)) if used is not None else F.lit(0))
    placed = placed.withColumn("slot", slot.cast("long")).drop("place", *(["used"] if used is not None else []))
    return placed.withColumn("due", F.floor(F.col("slot") / F.lit(int(parallel))).cast("double") * F.lit(float(interval_s)))


def _called(wave: DataFrame, client: Callable, retryable: tuple) -> DataFrame:
    """The calls of a wave's requests: each task makes its own one after the other, each once. A client that names a
    parameter ``attempt`` gets it. Nested columns go through the tasks as JSON texts, those of no use there unread."""
    numbered = "attempt" in inspect.signature(client).parameters
    meta = wave.schema["meta"].dataType
    passing = "url string, host string, seq string, meta string, attempt int, slot long, due double"
    schema = f"{passing}, status int, http_status int, headers string, content binary, error string, retryable boolean"

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                asked = {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}
                answers = []
                for url, method, headers, params, data, body, attempt in zip(*(asked[n] for n in (
                        "url", "method", "headers", "params", "data", "json", "attempt"))):
                    code, status, found, content, error, again = None, 0, None, b"", None, False
                    extra = {"attempt": attempt} if numbered else {}
                    try:
                        code, fields, raw = client(url, method, json.loads(headers or "{}"), json.loads(params or "{}"), data, body, **extra)
                        if code < 400:
                            status, content = code, raw
                            found = json.dumps({str(k): str(v) for k, v in fields.items()}) if fields else None
                    except retryable as exc:
                        error, again = f"request failed: {exc}", True
                    except Exception as exc:  # noqa: BLE001 - whatever a client raises is the request's outcome
                        error = f"unexpected error: {exc}"
                    answers.append((status, code, found, content, error, again))
                kept = [part.column(part.schema.names.index(n)) for n in ("url", "host", "seq", "meta", "attempt", "slot", "due")]
                types = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.string(), pa.bool_())
                yield pa.RecordBatch.from_arrays(kept + [pa.array(c, t) for c, t in zip(zip(*answers), types)], names=[
                    "url", "host", "seq", "meta", "attempt", "slot", "due", "status", "http_status", "headers", "content",
                    "error", "retryable"])

    def text(name: str) -> Column:  # null where there is nothing in it
        return F.when(F.size(name) > 0, F.to_json(name)).alias(name)

    asked = wave.select("url", "host", F.to_json("seq").alias("seq"), F.to_json("meta").alias("meta"), "attempt", "slot", "due", "method",
                        text("headers"), text("params"), "data", "json")
    done = asked.mapInArrow(run, schema)
    return done.withColumns({
        "seq": F.from_json("seq", "array<bigint>"), "meta": F.from_json("meta", meta),
        "headers": F.coalesce(F.from_json("headers", "map<string,string>"), empty_map())})


def fetch_scheduled(requests: DataFrame, client: Callable, interval_s: float = 1.0, parallel: int = 1,
                    max_attempts: int = 3, window_s: float = 60.0, clock: bool = True,
                    retryable: tuple = (TimeoutError, ConnectionError)) -> DataFrame:
    """Every call that was made: ``CALL_SCHEMA`` and ``final``, true for the call that settles its request.

    ``client(url, method, headers, params, data, json[, attempt])`` -> (status, headers, content). ``clock=False``
    makes the calls of a round at once (a client without a network, or one that keeps the slots itself). Calls are
    written wave by wave, so a lost executor repeats at most a wave. Requests without a url make no call.
    """
    calls, written, used = [], [], None
    frontier = normalize_requests(requests).withColumn("attempt", F.lit(1))
    started = time.monotonic()
    for attempt in range(1, max_attempts + 1):
        slots = due_slots(frontier, used, interval_s, parallel, written)
        if clock:
            slots = cut_lineage(slots.withColumn("_wave", F.floor(F.col("due") / F.lit(window_s))), written)
            last = slots.agg(F.max("_wave")).first()[0]
            waves = [] if last is None else [slots.where(F.col("_wave") == w).drop("_wave") for w in range(int(last) + 1)]
        else:
            waves = [slots]
        made = []
        for number, wave in enumerate(waves):
            if clock:
                time.sleep(max(0.0, started + number * window_s - time.monotonic()))
            made.append(cut_lineage(_called(wave, client, retryable)))
        if not made:
            break
        done = made[0]
        for more in made[1:]:
            done = done.unionByName(more)
        again = F.col("retryable") & F.lit(attempt < max_attempts)
        calls.append(done.withColumn("final", ~again))
        failed = done.where(again).select(F.col("seq").alias("_seq"), F.col("url").alias("_url"))
        if attempt == max_attempts or failed.isEmpty():
            break
        counts = done.groupBy("host").agg(F.count(F.lit(1)).alias("used"))
        used = counts if used is None else used.unionByName(counts).groupBy("host").agg(F.sum("used").alias("used"))
        used = cut_lineage(used, written)
        frontier = cut_lineage(frontier.join(failed, F.col("seq").eqNullSafe(F.col("_seq")) & (F.col("url") == F.col("_url")),
                                             "left_semi").withColumn("attempt", F.lit(attempt + 1)), written)
    drop_tables(requests.sparkSession, written)
    if not calls:
        return requests.sparkSession.createDataFrame([], CALL_SCHEMA + ", final boolean")
    out = calls[0]
    for more in calls[1:]:
        out = out.unionByName(more)
    return out
