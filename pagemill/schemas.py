"""Schemas of the record types flowing through a workflow."""

from pyspark.sql import types as T

STR = T.StringType()
STR_MAP = T.MapType(STR, STR)

META = T.StructType([
    T.StructField("workflow_index", T.IntegerType()),
    T.StructField("context", STR_MAP),
    T.StructField("params", STR_MAP),
    T.StructField("encoding", STR),
])

# seq orders arrivals: [round, path...]; compared lexicographically
SEQ = T.ArrayType(T.LongType())

REQUEST = T.StructType([
    T.StructField("url", STR),
    T.StructField("method", STR),
    T.StructField("headers", STR_MAP),
    T.StructField("meta", META),
    T.StructField("params", STR_MAP),
    T.StructField("data", STR),
    T.StructField("json", STR),
    T.StructField("dont_filter", T.BooleanType()),
    T.StructField("seq", SEQ),
    T.StructField("attempt", T.IntegerType()),
])

RESPONSE_FIELDS = [
    ("url", "string"), ("status", "int"), ("http_status", "int"),
    ("headers", "map<string,string>"), ("body", "string"), ("meta", META.simpleString()),
    ("requested_at", "string"), ("error", "string"), ("encoding", "string"),
    ("encoding_confidence", "double"), ("encoding_source", "string"),
    ("body_reencoded", "boolean"), ("seq", "array<bigint>"),
]

PENDING_REQUEST = (
    "id bigint, url string, method string, headers_json string, params_json string, "
    "meta_json string, created_at timestamp"
)

ARTICLES = T.StructType([
    T.StructField("id", STR),
    T.StructField("task_id", STR),
    T.StructField("title", STR),
    T.StructField("link", STR),
    T.StructField("link_hash", STR),
    T.StructField("source_url", STR),
    T.StructField("extra", STR),
    T.StructField("created_at", T.TimestampNTZType()),
])

ARTICLE_CONTENTS = T.StructType([
    T.StructField("article_id", STR),
    T.StructField("content", STR),
    T.StructField("content_hash", STR),
    T.StructField("created_at", T.TimestampNTZType()),
])

DEAD_LETTER = T.StructType([
    T.StructField("error", STR),
    T.StructField("stage", STR),
    T.StructField("payload", STR),
    T.StructField("item", STR),
])
