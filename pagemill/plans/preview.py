"""Previews of a workflow on given pages (W7-W10, O5, F11) and rule coverage.

A preview runs every step of a workflow against each given page without
queues: link steps report every rule's list (``maxLinks`` per rule) on the
*same* page (Q14); a data step first follows link number ``link_index`` of
the last link step (O5, bounds-checked) through the page snapshot, then
reports its rules. Output is one row per (page, step):

    page_id, step_id, step_type, name, result map<string,array<string>>,
    error string, warning string

All pages are previewed in one distributed plan (steps are a fixed, small
sequence known on the driver).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.config import STEP_DATA, STEP_LINKS, STEP_REQUEST, Step, Workflow
from pagemill.functions import rules as R
from pagemill.functions.common import empty_map
from pagemill.functions.html import content_length, with_dom
from pagemill.functions.urls import urljoin
from pagemill.operators.data import preview_data
from pagemill.operators.links import cap_links, preview_links
from pagemill.session import cut_lineage

RESULT_TYPE = "map<string,array<string>>"


def _row(df: DataFrame, step: Step, result: Column, error: Column | None = None,
         warning: Column | None = None) -> DataFrame:
    return df.select(
        F.col("page_id"),
        F.lit(str(step.id)).alias("step_id"),
        F.lit(step.type).alias("step_type"),
        F.lit(step.name or f"Step {step.id}").alias("name"),
        result.alias("result"),
        (error if error is not None else F.lit(None).cast("string")).alias("error"),
        (warning if warning is not None else F.lit(None).cast("string")).alias("warning"),
    )


def _spans(wf_or_steps) -> bool:
    steps = wf_or_steps.steps if isinstance(wf_or_steps, Workflow) else wf_or_steps
    return R.needs_spans([r for s in steps for r in (s.link_rules + s.data_rules)])


def preview_step(pages: DataFrame, step: Step, html_col: str = "html") -> DataFrame:
    """One step on each given page; unsupported types give a warning row."""
    df = with_dom(pages, html_col, _spans([step]))
    if step.type == STEP_LINKS:
        if not step.link_rules:
            return _row(df, step, empty_map(RESULT_TYPE), warning=F.lit("No link extraction rules configured"))
        return _row(df, step, preview_links(df, step))
    if step.type == STEP_DATA:
        if not step.data_rules:
            return _row(df, step, empty_map(RESULT_TYPE), warning=F.lit("No extraction rules configured"))
        return _row(df, step, preview_data(step))
    return _row(df, step, empty_map(RESULT_TYPE), warning=F.lit(f"Unsupported step type: {step.type}"))


def preview_workflow(pages: DataFrame, wf: Workflow, snapshot: DataFrame | None = None,
                     link_index: int = 0, html_col: str = "html") -> DataFrame:
    """Run all steps on every page (page_id, url, html)."""
    spans = _spans(wf)
    cur = with_dom(pages.select("page_id", "url", F.col(html_col).alias("body")), "body", spans)
    # every step row below reads the normalised pages: materialise them once
    cur = cut_lineage(cur).withColumn("_links", F.lit(None).cast("array<string>"))
    rows = []
    last_link_step = None
    for step in wf.steps:
        if step.type == STEP_REQUEST:
            res = F.create_map(
                F.lit("url"), F.array(F.col("url")),
                F.lit("method"), F.array(F.lit(step.config.get("method", "GET"))),
                F.lit("status_code"), F.array(F.lit("200")),
                F.lit("content_length"), F.array(content_length(F.col("body")).cast("string")))
            rows.append(_row(cur, step, res))
        elif step.type == STEP_LINKS:
            last_link_step = step
            if not step.link_rules:
                rows.append(_row(cur, step, empty_map(RESULT_TYPE),
                                 warning=F.lit("No link extraction rules configured")))
                continue
            res = preview_links(cur, step)
            rows.append(_row(cur, step, res))
            link_rule = next((r for r in step.link_rules if r.field == "link"), None)
            if link_rule is not None:
                links = cap_links(R.values(F.col("dom"), link_rule), link_rule.max_links)
                cur = cur.withColumn("_links", F.when(F.size(links) > 0, links).otherwise(F.col("_links")))
        elif step.type == STEP_DATA:
            if last_link_step is None:
                prior = next((s for s in wf.steps[:step.index] if s.type == STEP_LINKS), None)
                if prior is not None:
                    lr = next((r for r in prior.link_rules if r.field == "link"), None)
                    if lr is not None:
                        cur = cur.withColumn("_links", cap_links(R.values(F.col("dom"), lr), lr.max_links))
            n = F.size(F.coalesce(F.col("_links"), F.array().cast("array<string>")))
            has = F.col("_links").isNotNull() & (n > 0)
            in_range = has & F.lit(0 <= link_index) & (F.lit(link_index) < n)
            # Out-of-range index -> error row; no links -> extract on the page itself
            out_of_range = cur.filter(has & ~in_range)
            rows.append(_row(out_of_range, step, empty_map(RESULT_TYPE), error=F.concat(
                F.lit(f"link index {link_index} out of range (0-"), (n - 1).cast("string"), F.lit(")"))))
            same = cur.filter(~has)
            follow = cut_lineage(cur.filter(in_range).select("page_id", urljoin(
                F.col("url"), F.get(F.col("_links"), link_index)).alias("_target")))
            found = _details(follow, snapshot)
            target = same.select("page_id", "url", "dom", F.lit(None).cast("string").alias("_error"))
            detail = with_dom(found.select("page_id", F.col("_target").alias("url"), F.col("_html").alias("body"), "_error"),
                              "body", spans)
            target = target.unionByName(detail.select("page_id", "url", "dom", "_error"))
            fine = F.col("_error").isNull()
            if not step.data_rules:
                rows.append(_row(target, step, empty_map(RESULT_TYPE), error=F.col("_error"),
                                 warning=F.when(fine, F.lit("No extraction rules configured"))))
            else:
                result = F.when(fine, preview_data(step)).otherwise(empty_map(RESULT_TYPE))
                rows.append(_row(target, step, result, error=F.col("_error")))
        else:
            rows.append(_row(cur, step, empty_map(RESULT_TYPE),
                             warning=F.lit(f"Unknown step type: {step.type}")))
    return reduce(lambda a, b: a.unionByName(b), rows)


def _details(follow: DataFrame, snapshot: DataFrame | None) -> DataFrame:
    """The detail pages of ``follow`` (page_id, _target): ``_html``, '' and an ``_error`` where there is none. The
    targets join the pages (an inner join, which may broadcast the few targets, never the pages); targets
    without a page come from an anti-join with the urls alone."""
    text = F.lit(None).cast("string")
    at = F.concat(F.lit(" ("), F.col("_target"), F.lit(")"))
    none = F.concat(F.lit("detail page request failed: no page"), at)
    if snapshot is None:
        return follow.select("page_id", "_target", F.lit("").alias("_html"), none.alias("_error"))
    code = F.col("status") if "status" in snapshot.columns else F.lit(200)
    snap = snapshot.select(F.col("url").alias("_surl"), F.col("html").alias("_text"), code.alias("_code"))
    bad = F.col("_code") >= 400
    hit = snap.join(follow, snap["_surl"] == follow["_target"]).select(
        "page_id", "_target", F.when(bad, F.lit("")).otherwise(F.col("_text")).alias("_html"),
        F.when(bad, F.concat(F.lit("detail page request failed: HTTP "), F.col("_code").cast("string"), at)).otherwise(text).alias("_error"))
    known = snap.select("_surl")
    miss = follow.join(known, follow["_target"] == known["_surl"], "left_anti")
    return hit.unionByName(miss.select("page_id", "_target", F.lit("").alias("_html"), none.alias("_error")))


def extraction_coverage(pages: DataFrame, wf: Workflow, html_col: str = "html") -> DataFrame:
    """Per (step, field): values found in all pages and pages with at least one."""
    df = with_dom(pages, html_col, _spans(wf))
    entries = []
    for step in wf.steps:
        rules = step.link_rules if step.type == STEP_LINKS else (
            step.data_rules if step.type == STEP_DATA else [])
        for r in rules:
            v = R.values(F.col("dom"), r)
            if step.type == STEP_LINKS:
                v = cap_links(v, r.max_links)
            elif not r.multiple:
                v = F.slice(v, 1, 1)
            entries.append(F.struct(F.lit(str(step.id)).alias("step_id"), F.lit(r.field).alias("field"),
                                    F.size(v).alias("n")))
    if not entries:
        return df.sparkSession.createDataFrame([], "step_id string, field string, values long, pages long")
    ex = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return ex.groupBy("step_id", "field").agg(
        F.sum("n").cast("long").alias("values"),
        F.count_if(F.col("n") > 0).cast("long").alias("pages"))
