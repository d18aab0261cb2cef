"""Link-extraction step (W1 worker, W2 spider) as one projection + posexplode.

Per page: the ``link`` rule's matches (capped by ``maxLinks``, O4) are
exploded with their position; every other rule of the step contributes the
value at the same position, or its last value when it has fewer (J1),
and nothing when it matched nothing. Links are resolved against the page
URL (X8) and become next-step requests whose context is the parent's
context overlaid with the new fields (X25). No shuffle: the step is a
narrow transformation of the response partition.
"""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.config import Step, Workflow
from pagemill.functions import rules as R
from pagemill.functions.common import empty_map
from pagemill.functions.urls import urljoin


def cap_links(arr: Column, max_links) -> Column:
    """Python-slice semantics of ``links[:maxLinks]``; falsy = no cap."""
    if not max_links:
        return arr
    n = int(max_links)
    if n > 0:
        return F.slice(arr, 1, n)
    return F.slice(arr, 1, F.greatest(F.size(arr) + n, F.lit(0)))


def padded_value(arr: Column, pos: Column) -> Column:
    """arr[pos] if present, else the last element; null if arr is empty."""
    return (F.when(F.size(arr) == 0, F.lit(None).cast("string"))
            .when(pos < F.size(arr), F.get(arr, pos))
            .otherwise(F.get(arr, F.size(arr) - 1)))


def overlay(parent: Column, child: Column) -> Column:
    """Child keys win over parent keys (no session-wide dedup policy needed)."""
    keys = F.map_keys(child)
    kept = F.map_filter(F.coalesce(parent, empty_map()), lambda k, v: ~F.array_contains(keys, k))
    return F.map_concat(kept, child)


def child_seq(seq: Column, pos: Column) -> Column:
    """seq of a child request: [round+1, parent path..., pos]."""
    return F.concat(F.array(F.get(seq, 0) + 1),
                    F.slice(seq, 2, F.greatest(F.size(seq) - 1, F.lit(0))),
                    F.array(pos.cast("long")))


def split_link_rules(step: Step):
    rules = step.link_rules
    link_rule = next((r for r in rules if r.field == "link"), None)
    others: "OrderedDict[str, R.Rule]" = OrderedDict()
    for r in rules:
        if r.field != "link":
            others[r.field] = r  # dict semantics: a repeated name keeps the last rule
    return link_rule, others


def link_step(responses: DataFrame, step: Step, wf: Workflow, profile: str = "worker",
              dom_col: str = "dom") -> DataFrame:
    """Next-step requests from the pages in ``responses`` (which carry ``dom``)."""
    return link_rows(responses, step, wf, profile, dom_col).drop("_base", "_raw")


def link_rows(responses: DataFrame, step: Step, wf: Workflow, profile: str = "worker",
              dom_col: str = "dom") -> DataFrame:
    """``link_step`` with the page (``_base``) and the link as it stands there (``_raw``): requests and dead
    letters of a round both derive from these rows, so the rules are evaluated once."""
    from pagemill.operators.requests import empty_requests, request_columns

    link_rule, others = split_link_rules(step)
    if link_rule is None:
        # Q7: no rule named exactly 'link' -> nothing is emitted
        none = F.lit(None).cast("string")
        return empty_requests(responses.sparkSession).withColumns({"_base": none, "_raw": none})
    dom = F.col(dom_col)
    links = cap_links(R.values(dom, link_rule, profile), link_rule.max_links)
    other_cols = [R.values(dom, r, profile).alias(f"_f{i}") for i, r in enumerate(others.values())]
    # the values of all rules are columns of the page before its links are exploded: a generator in the same
    # projection would come first, and every other rule be evaluated once a link
    found = responses.select(F.col("url").alias("_base"), F.col("meta"), F.col("seq"), links.alias("_links"), *other_cols)
    # exploded as an expression: of a bare column Spark infers a filter on its size, and moves that with all it is
    # made of, the normaliser too, below the projection, so that every page would be parsed a second time
    placed = F.explode(F.transform("_links", lambda link, i: F.struct(i.alias("_pos"), link.alias("_raw")))).alias("_link")
    exploded = found.select("_base", "meta", "seq", *[f"_f{i}" for i in range(len(others))], placed).select(
        "*", "_link.*").drop("_link")
    entries = []
    for i, name in enumerate(others):
        v = padded_value(F.col(f"_f{i}"), F.col("_pos"))
        if profile == "spider":
            v = F.when(v != "", v)  # spider keeps truthy values only
        entries.append(F.struct(F.lit(name).alias("k"), v.alias("v")))
    if entries:
        new_ctx = F.map_from_entries(F.filter(F.array(*entries), lambda e: e["v"].isNotNull()))
    else:
        new_ctx = empty_map()
    if profile == "spider":
        # Blank links dropped (F8), no inherited context, no headers, dont_filter
        exploded = exploded.filter(F.col("_raw") != "")
        context = new_ctx
        headers = empty_map()
        dont_filter = F.lit(True)
    else:
        context = overlay(F.col("meta.context"), new_ctx)
        hdr = wf.default_headers()
        headers = (F.create_map(*[F.lit(x) for kv in hdr.items() for x in kv])
                   if hdr else empty_map())
        dont_filter = F.lit(False)
    return exploded.select(*request_columns(
        url=urljoin(F.col("_base"), F.col("_raw")),
        headers=headers,
        workflow_index=F.lit(step.index + 1),
        context=context,
        dont_filter=dont_filter,
        seq=child_seq(F.col("seq"), F.col("_pos")),
    ), "_base", "_raw")


def unresolved(rows: DataFrame) -> DataFrame:
    """Links among ``link_rows`` that name no page (a malformed authority), as dead letters: error, stage, payload."""
    return rows.filter(F.col("url").isNull()).select(
        F.lit("link cannot be resolved").alias("error"), F.lit("links").alias("stage"),
        F.to_json(F.struct(F.col("_base").alias("page"), F.col("_raw").alias("link"))).alias("payload"))


def link_dead_letters(responses: DataFrame, step: Step, profile: str = "worker",
                      dom_col: str = "dom") -> DataFrame:
    """Links of the step that name no page (``unresolved``), from the pages themselves.
    ``link_step`` gives them a null url, which no fetch takes."""
    link_rule, _ = split_link_rules(step)
    empty = responses.sparkSession.createDataFrame([], "error string, stage string, payload string")
    if link_rule is None:
        return empty
    links = cap_links(R.values(F.col(dom_col), link_rule, profile), link_rule.max_links)
    found = responses.select(F.col("url").alias("_base"), F.explode(links).alias("_raw"))
    return unresolved(found.withColumn("url", urljoin(F.col("_base"), F.col("_raw"))))


def preview_links(responses: DataFrame, step: Step, profile: str = "worker",
                  dom_col: str = "dom") -> Column:
    """Every rule's list (maxLinks applied per rule) as map<field, array>."""
    rules = [r for r in step.link_rules if r.field]
    per = OrderedDict()
    for r in rules:
        per[r.field] = cap_links(R.values(F.col(dom_col), r, profile), r.max_links)
    if not per:
        return F.create_map().cast("map<string,array<string>>")
    return F.map_from_arrays(F.array(*[F.lit(k) for k in per]), F.array(*per.values()))
