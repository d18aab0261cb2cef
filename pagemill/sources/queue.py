"""Queue messages and request tables.

A queue is a directory of JSON-lines files (batch: ``spark.read``;
streaming: ``readStream``); order is the explicit ``seq`` column, never
file order. Decoding splits messages into requests and dead letters
without a Python UDF: validity via ``try_parse_json``, fields via
``from_json`` with a fixed schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.common import empty_map
from pagemill.functions.urls import mask_url
from pagemill.operators.requests import request_columns

MESSAGE_SCHEMA = (
    "url string, method string, headers map<string,string>, "
    "meta struct<workflow_index:int,context:map<string,string>,params:map<string,string>,encoding:string>, "
    "params map<string,string>, data string, json string, dont_filter boolean"
)
DEAD_LETTER_COLS = ["error", "stage", "payload"]


OUTCOME_OK = "ok"
OUTCOME_BAD_JSON = "invalid JSON"
OUTCOME_NO_URL = "missing url"


def classify_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """One pass over the messages: ``outcome`` ('ok' | 'invalid JSON' |
    'missing url'), the parsed message ``_r`` (null for invalid JSON), the
    masked raw ``payload`` and ``seq``."""
    v = F.col(value_col)
    seq = F.col("seq") if "seq" in messages.columns else F.array(F.lit(0).cast("long"),
                                                                 F.monotonically_increasing_id())
    ok = F.try_parse_json(v).isNotNull()
    parsed = F.when(ok, F.from_json(v, MESSAGE_SCHEMA))
    has_url = F.coalesce(parsed["url"], F.lit("")) != ""
    outcome = (F.when(~ok, F.lit(OUTCOME_BAD_JSON)).when(~has_url, F.lit(OUTCOME_NO_URL))
               .otherwise(F.lit(OUTCOME_OK)))
    return messages.select(outcome.alias("outcome"), parsed.alias("_r"),
                           mask_url(v).alias("payload"), seq.alias("seq"))


def decode_messages(messages: DataFrame, value_col: str = "value", missing_url: str = "dead_letter",
                    default_index: int = 0):
    """(requests, dead_letters) from JSON message text.

    invalid JSON -> dead letter 'invalid JSON'; no url -> dead letter
    'missing url' (``missing_url='dead_letter'``) or dropped ('skip', the
    fetch worker's behaviour). Credentials in payloads are masked. Both
    outputs filter one ``classify_messages`` projection.
    """
    c = classify_messages(messages, value_col)
    dead_outcomes = [OUTCOME_BAD_JSON, OUTCOME_NO_URL] if missing_url == "dead_letter" else [OUTCOME_BAD_JSON]
    dead = c.filter(F.col("outcome").isin(dead_outcomes)).select(
        F.col("outcome").alias("error"), F.lit("decode").alias("stage"), "payload")
    r = F.col("_r")
    requests = c.filter(F.col("outcome") == OUTCOME_OK).select(*request_columns(
        url=r["url"],
        method=F.upper(F.coalesce(F.nullif(r["method"], F.lit("")), F.lit("GET"))),
        headers=F.coalesce(r["headers"], empty_map()),
        workflow_index=F.coalesce(r["meta"]["workflow_index"], F.lit(default_index)),
        context=F.coalesce(r["meta"]["context"], empty_map()),
        params=r["meta"]["params"], encoding=r["meta"]["encoding"],
        dont_filter=F.coalesce(r["dont_filter"], F.lit(False)),
        seq=F.col("seq"),
    ))
    return requests, dead


def encode_requests(requests: DataFrame) -> DataFrame:
    """K1 / K2: one JSON message per request (non-ASCII stays unescaped)."""
    return requests.select(F.to_json(F.struct(
        "url", "method", "headers", "meta", "dont_filter")).alias("value"), "seq")


def requests_from_pending(pending: DataFrame, since_id: int | None = None) -> DataFrame:
    """Pending-request rows -> requests.

    method defaults to GET; JSON text columns parse to maps (null/empty ->
    null); non-empty params are moved into ``meta.params`` (Q11), and the meta's
    context, params and encoding go where requests carry them.
    ``since_id`` is an optional cursor (Q15); default: the whole table.
    """
    df = pending if since_id is None else pending.filter(F.col("id") > F.lit(since_id))

    def js(c):
        return F.from_json(F.nullif(F.trim(F.col(c)), F.lit("")), "map<string,string>")

    params = js("params_json")
    # the meta of a pending request: its own index and encoding, a nested context, and any other
    # top-level entries, which are context as well (nested ones win)
    known = ("workflow_index", "context", "params", "encoding")
    meta_in = js("meta_json")
    meta = F.from_json(F.nullif(F.trim(F.col("meta_json")), F.lit("")),
                       "workflow_index int, context map<string,string>, params map<string,string>, encoding string")
    loose = F.map_filter(F.coalesce(meta_in, empty_map()), lambda k, v: ~k.isin(*known))
    nested = F.coalesce(meta["context"], empty_map())
    ctx = F.map_concat(F.map_filter(loose, lambda k, v: ~F.array_contains(F.map_keys(nested), k)), nested)
    params = F.when(F.size(F.coalesce(params, empty_map())) > 0, params).otherwise(meta["params"])
    return df.select(*request_columns(
        url=F.col("url"),
        method=F.coalesce(F.nullif(F.col("method"), F.lit("")), F.lit("GET")),
        headers=F.coalesce(js("headers_json"), empty_map()),
        workflow_index=F.coalesce(meta["workflow_index"], F.lit(0)),
        context=ctx,
        params=params, encoding=meta["encoding"],
        dont_filter=F.lit(False),
        seq=F.array(F.lit(0).cast("long"), F.col("id").cast("long")),
    ))


def read_pending_jdbc(spark: SparkSession, url: str, table: str = "pending_requests",
                      partitions: int | None = None, properties: dict | None = None) -> DataFrame:
    """S4 over JDBC, range-partitioned on ``id`` between its smallest and largest value,
    so the scan is parallel whatever the ids are."""
    properties = properties or {}
    span = spark.read.jdbc(url, f"(SELECT min(id) AS lo, max(id) AS hi FROM {table}) span",
                           properties=properties).first()
    if span is None or span[0] is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column="id", lowerBound=int(span[0]), upperBound=int(span[1]) + 1,
                           numPartitions=partitions or spark.sparkContext.defaultParallelism,
                           properties=properties)


def run_sql(spark: SparkSession, query: str, **params) -> DataFrame:
    """SQL with named ``:param`` markers bound as literals (no string pasting)."""
    return spark.sql(query, args=params)


def read_queue(spark: SparkSession, path: str, schema: str = "value string, seq array<bigint>") -> DataFrame:
    """Messages of one or more queue directories (a list of paths unions them)."""
    paths = path if isinstance(path, (list, tuple)) else [path]
    return spark.read.schema(schema).json(list(paths))


def write_queue(df: DataFrame, path: str) -> None:
    """K3: append messages (``value``, ``seq``) to a queue directory."""
    df.write.mode("append").json(path)


def queue_messages_from_events(events: DataFrame) -> DataFrame:
    """Event rows as queue messages: view/click events carry a request, error
    events a truncated (invalid) payload, other events a payload without url."""
    url = F.concat(F.lit("https://"), F.col("event_type"), F.lit(".example.com/u/"),
                   F.col("user_id").cast("string"))
    req = F.to_json(F.struct(url.alias("url"), F.lit("get").alias("method"),
                             F.struct(F.lit(0).alias("workflow_index"),
                                      F.create_map(F.lit("event"), F.col("event_type")).alias("context"))
                             .alias("meta")))
    value = (F.when(F.col("event_type").isin("view", "click"), req)
             .when(F.col("event_type") == "error", F.expr("substring(props, 1, length(props) - 1)"))
             .otherwise(F.col("props")))
    return events.select(F.col("event_id"), F.col("event_type").alias("queue"), value.alias("value"),
                         F.array(F.lit(0).cast("long"), F.col("event_id").cast("long")).alias("seq"))
