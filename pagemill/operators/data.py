"""Data-extraction step (W3 worker, W4 spider) and the item / article projections.

Items carry ``data`` as a struct generated from the step's rules (field
set known on the driver): a ``multiple`` rule gives array<string>, a
single rule gives string (null when nothing matched, '' for an empty
expression). A repeated field name keeps the last rule.
"""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.config import Step, Workflow
from pagemill.functions import rules as R
from pagemill.functions.common import empty_map


def data_rules(step: Step) -> "OrderedDict[str, R.Rule]":
    out: "OrderedDict[str, R.Rule]" = OrderedDict()
    for r in step.data_rules:
        out[r.field] = r
    return out


def data_struct(step: Step, profile: str = "worker", dom_col: str = "dom") -> Column:
    dom = F.col(dom_col)
    fields = []
    for name, r in data_rules(step).items():
        v = R.values(dom, r, profile) if r.multiple else R.first(dom, r, profile)
        fields.append(v.alias(str(name)))
    if not fields:
        return F.struct(F.lit(None).cast("string").alias("_none")).alias("data")
    return F.struct(*fields).alias("data")


def data_step(responses: DataFrame, step: Step, wf: Workflow, profile: str = "worker",
              dom_col: str = "dom") -> DataFrame:
    """F7 items: task_id, task_name, source_url, context, data (+ seq, step_index)."""
    return responses.select(
        F.lit(wf.task_id).alias("task_id"),
        F.lit(None if wf.task_name is None else str(wf.task_name)).cast("string").alias("task_name"),
        F.col("url").alias("source_url"),
        F.coalesce(F.col("meta.context"), empty_map()).alias("context"),
        data_struct(step, profile, dom_col),
        F.col("body"),
        F.col("seq"),
        F.lit(step.index).alias("step_index"),
    )


def _text_of(c: Column, dtype: T.DataType) -> Column:
    """A data field as text: lists become their JSON text."""
    if isinstance(dtype, T.ArrayType):
        return F.when(F.size(c) > 0, F.to_json(c))
    return c


def _field(items: DataFrame, name: str):
    dt = items.schema["data"].dataType
    if isinstance(dt, T.StructType) and name in dt.fieldNames():
        return _text_of(F.col("data").getField(name), dt[name].dataType)
    return F.lit(None).cast("string")


def article_projection(items: DataFrame, profile: str = "worker") -> DataFrame:
    """F5 (worker) / F6 (spider): item -> article fields.

    worker: title = data.title or context.title or '', link = context.link or
            source_url, content = data.content or '', extra = context.
    spider: title = context.title or data.title, link = context.link or url,
            content = data.content, extra = data.
    """
    ctx = F.col("context")
    d_title, d_content = _field(items, "title"), _field(items, "content")
    c_title, c_link = ctx.getItem("title"), ctx.getItem("link")
    if profile == "spider":
        title = F.coalesce(F.nullif(c_title, F.lit("")), d_title)
        content = d_content
        extra = F.to_json(F.col("data"), {"ignoreNullFields": "false"})
    else:
        title = F.coalesce(F.nullif(d_title, F.lit("")), F.nullif(c_title, F.lit("")), F.lit(""))
        content = F.coalesce(F.nullif(d_content, F.lit("")), F.lit(""))
        extra = F.to_json(ctx)
    link = F.coalesce(F.nullif(c_link, F.lit("")), F.col("source_url"))
    return items.select(
        F.col("task_id").cast("string").alias("task_id"),
        title.alias("title"), link.alias("link"), content.alias("content"),
        F.col("source_url"), extra.alias("extra"), F.col("seq"),
    )


def item_json(items: DataFrame) -> DataFrame:
    """K5: the queue form of an item as one JSON text per row."""
    return items.select(F.to_json(F.struct(
        "task_id", "task_name", "source_url", "context", "data"),
        {"ignoreNullFields": "false"}).alias("value"), "seq")


def route(wf: Workflow, step: Step, has_store: bool = True) -> str:
    """K10 / F9: 'store' for the last step without a generator, else 'queue'."""
    if wf.is_last_step(step.index) and not wf.has_custom_code(step.index) and has_store:
        return "store"
    return "queue"


def preview_data(step: Step, profile: str = "worker", dom_col: str = "dom") -> Column:
    """Rule values keyed by field, lists kept as lists (JSON text per value)."""
    dom = F.col(dom_col)
    per = OrderedDict()
    for name, r in data_rules(step).items():
        if not name:
            continue
        v = R.values(dom, r, profile) if r.multiple else F.array(R.first(dom, r, profile))
        per[name] = v
    if not per:
        return F.create_map().cast("map<string,array<string>>")
    return F.map_from_arrays(F.array(*[F.lit(k) for k in per]), F.array(*per.values()))
