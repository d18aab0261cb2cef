"""User row generators (U1 worker, U2 spider).

A data step may name a registered Python callable
``fn(body, url, data) -> iterable of request dicts`` (see
``config.register_generator``). It runs inside ``mapInArrow`` on the
executors, per item, in parallel; its output rows become next-round
requests. Source text from configs is never executed.

Defaults (worker): method GET, headers = workflow default headers,
``meta.workflow_index`` = next step unless the generator sets it (which
allows cycles, bounded by ``max_rounds``), dont_filter false, context not
inherited. Spider: index always the next step, meta holds only the index.
A generator that raises turns the item into a dead letter.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagemill.config import GENERATORS
from pagemill.schemas import REQUEST

OUT_SCHEMA = T.StructType(REQUEST.fields + [T.StructField("error", T.StringType()), T.StructField("payload", T.StringType())])

#: Characters of pages, and requests, after which requests go back to the JVM, whatever the size of the batch that came in.
SLICE_CHARS, SLICE_REQUESTS = 1 << 21, 1000


def run_generator(items: DataFrame, name: str, next_index: int, default_headers: dict,
                  profile: str = "worker") -> DataFrame:
    """Requests (plus error rows) produced by generator ``name`` for every item."""
    if name not in GENERATORS:
        raise KeyError(f"no generator registered under {name!r}")
    fn = GENERATORS[name]
    src = items.select("source_url", "body", F.to_json("data").alias("data_json"), "seq")
    return src.mapInArrow(lambda batches: generated(batches, fn, next_index, default_headers, profile), OUT_SCHEMA)


def generated(batches, fn, next_index: int, default_headers: dict, profile: str = "worker"):
    """Batches of requests from batches of items (url, body, data as JSON, seq). An item at a time becomes Python
    objects and requests leave in slices: a worker holds one batch as it came in."""
    for batch in batches:
        rows, chars = [], 0
        for item in zip(*batch.columns):
            url, body, data_json, seq = (v.as_py() for v in item)
            rows.extend(_requests(fn, url, body, data_json, list(seq), next_index, default_headers, profile))
            chars += len(body or "")
            if rows and (chars >= SLICE_CHARS or len(rows) >= SLICE_REQUESTS):
                yield _request_batch(rows)
                rows, chars = [], 0
        if rows:
            yield _request_batch(rows)


def _requests(fn, url, body, data_json, parent: list, next_index: int, default_headers: dict, profile: str):
    try:
        produced = list(fn(body or "", url, json.loads(data_json or "{}")) or [])
    except Exception as exc:  # the item goes to the dead letters
        yield (None, None, None, None, None, None, None, None, parent, 0, f"generator failed: {exc}", url)
        return
    for k, req in enumerate(produced):
        meta = dict(req.get("meta") or {})
        if profile == "spider":
            idx, ctx, headers = next_index, {}, {}
        else:
            idx = int(meta.get("workflow_index", next_index))
            ctx = meta.get("context") or {}
            headers = req.get("headers") or default_headers
        yield (req.get("url"), req.get("method", "GET"), _pairs(headers),
               {"workflow_index": idx, "context": _pairs(ctx), "params": None, "encoding": meta.get("encoding")},
               None, req.get("data"), None, bool(req.get("dont_filter", False)),
               [parent[0] + 1] + parent[1:] + [k], 0, None, None)


def _pairs(d: dict) -> list:
    return list({str(a): str(b) for a, b in d.items()}.items())


def _request_batch(rows: list) -> pa.RecordBatch:
    schema = to_arrow_schema(OUT_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type, from_pandas=True) for c, f in zip(zip(*rows), schema)], schema=schema)
