"""Run a workflow to completion over a page snapshot (W5, W6; K10, K13, Q3, Q12, Q13).

Each round is one set of distributed jobs:

    frontier -> fetch (join to snapshot) -> dispatch (literal CASE on the
    workflow index) -> normalise each page once -> link steps  -> next frontier
                                                 -> data steps  -> items
                                                                -> generator requests

The fetched-and-normalised responses of a round are written as a table in
the cluster's checkpoint folder (reliable, lineage cut), so every step of
the round reads them once and a lost executor recomputes nothing older than
the round; the next frontier derives from that table. The driver loop only decides whether another round is needed
(``isEmpty`` on the new frontier). It runs until the frontier is empty; a
caller that expects cycles (generators, Q13) gives ``max_rounds`` and gets
what is still to be requested as ``frontier``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.config import STEP_DATA, STEP_LINKS, Workflow
from pagemill.functions import rules as R
from pagemill.functions.html import with_dom
from pagemill.operators.data import article_projection, data_step, route
from pagemill.operators.fetch import fetch, fetch_live
from pagemill.operators.generator import run_generator
from pagemill.operators.links import link_rows, unresolved
from pagemill.operators.requests import empty_requests
from pagemill.operators.seen import SeenUrls
from pagemill.operators.snapshot import ClusteredSnapshot
from pagemill.operators.store import ArticleTables, SaveResult, save_articles
from pagemill.session import cut_lineage, drop_tables, ensure_checkpoint_dir

REQUEST_COLS = ["url", "method", "headers", "meta", "params", "data", "json", "dont_filter",
                "seq", "attempt"]


#: Items of a workflow that has no data step.
NO_ITEMS = ("task_id string, task_name string, source_url string, context map<string,string>, "
            "data struct<_none:string>, body string, seq array<bigint>, step_index int, route string")


@dataclass
class WorkflowResult:
    items: DataFrame            # every item produced (with its route)
    queued_items: DataFrame     # items routed to the item queue (K5)
    saved: SaveResult | None    # store writes for items routed to the store
    dead_letters: DataFrame     # error, stage, payload
    rounds: int
    frontier: DataFrame         # requests not made yet; empty when the run is complete
    complete: bool


def _union(dfs, empty, allow_missing: bool = False):
    dfs = [d for d in dfs if d is not None]
    if not dfs:
        return empty
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def run_workflow(wf: Workflow, seeds: DataFrame, snapshot: DataFrame | ClusteredSnapshot | None, max_rounds: int | None = None,
                 profile: str = "worker", store: ArticleTables | None = None, has_store: bool = True,
                 as_of: str | None = None, on_failed_fetch: str = "keep",
                 dedup_urls: bool | SeenUrls = False, checkpoint: bool = True, fetcher=None,
                 session_headers: dict | None = None, **policy) -> WorkflowResult:
    """Loop fetch -> extract -> frontier until the frontier is empty, or ``max_rounds`` are over.
    ``fetcher``: a client called for each request instead of the join with ``snapshot`` (which may
    then be None); ``policy`` goes to ``fetch_with``. ``dedup_urls``: no url is requested twice (T4), neither
    in this run nor, with a ``SeenUrls``, in runs before it."""
    spark = seeds.sparkSession
    frontier = seeds.select(*REQUEST_COLS)
    items_parts, dead_parts = [], []
    seen = None
    if dedup_urls:
        seen = dedup_urls if isinstance(dedup_urls, SeenUrls) else SeenUrls(
            spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/seen-{uuid.uuid4().hex}", buckets=16)
    round_tables: list = []  # per-round response tables, dropped once items are written
    rounds, complete = 0, False
    if checkpoint:  # every round joins the snapshot, and a round reads its frontier more than once
        frontier = cut_lineage(frontier, round_tables)
        if isinstance(snapshot, DataFrame):
            snapshot = cut_lineage(snapshot, round_tables)
    while not complete and (max_rounds is None or rounds < max_rounds):
        rounds += 1
        if seen is not None:  # T4: dont_filter rows bypass it
            frontier = seen.admit(frontier, seen.next_id(), round_tables)
        if fetcher is None:
            responses = fetch(frontier, snapshot, profile, as_of, on_failed_fetch)
        else:
            responses = fetch_live(frontier, fetcher, wf, profile, as_of, on_failed_fetch, session_headers, **policy)
        responses = normalised(wf, responses, profile)
        if checkpoint:
            responses = cut_lineage(responses, round_tables)
        next_parts, new_items, new_dead = run_steps(wf, responses, profile, has_store, checkpoint, round_tables)
        items_parts += new_items
        dead_parts += new_dead
        # the frontier derives from this round's written responses (and written
        # generator output): short lineage, and isEmpty reads at most one row
        frontier = _union(next_parts, empty_requests(spark).select(*REQUEST_COLS))
        complete = frontier.isEmpty()
    if checkpoint and not complete:
        frontier = cut_lineage(frontier)  # the caller's, beyond the round tables
    # data structs of several data steps differ: union by name, missing fields null
    items = _union(items_parts, spark.createDataFrame([], NO_ITEMS), allow_missing=True).drop("body")
    dead = _union(dead_parts, spark.createDataFrame([], "error string, stage string, payload string"))
    if checkpoint:  # items feed the queue, the store and the caller: extract them once
        items, dead = cut_lineage(items), cut_lineage(dead)
        drop_tables(spark, round_tables)  # nothing returned reads the tables of the rounds
        if complete:
            frontier = empty_requests(spark).select(*REQUEST_COLS)
    queued = items.filter(F.col("route") == "queue")
    to_store = items.filter(F.col("route") == "store")
    saved = None
    if has_store:
        saved = save_articles(store or ArticleTables.empty(spark),
                              article_projection(to_store, profile), as_of=as_of)
    return WorkflowResult(items, queued, saved, dead, rounds, frontier, complete)


def run_steps(wf: Workflow, responses: DataFrame, profile: str = "worker", has_store: bool = True,
              checkpoint: bool = True, written: list | None = None) -> tuple[list, list, list]:
    """One round of given, normalised responses (with ``_step`` and ``dom``) through their steps:
    parts of the next requests, of the items (with their route) and of the dead letters. Batch runs
    and streams share it. ``checkpoint``: the links of each step (requests and dead letters alike) and generator
    output are written once, so no rule is evaluated twice; ``written`` gets the tables' paths."""
    keep = (lambda df: cut_lineage(df, written)) if checkpoint else (lambda df: df)
    next_parts, items_parts, dead_parts = [], [], []
    for step in wf.steps:
        mine = responses.filter(F.col("_step") == step.index)
        if step.type == STEP_LINKS:
            rows = keep(link_rows(mine, step, wf, profile))
            next_parts.append(rows.filter(F.col("url").isNotNull()).select(*REQUEST_COLS))
            dead_parts.append(unresolved(rows))
        elif step.type == STEP_DATA:
            items = data_step(mine, step, wf, profile).withColumn("route", F.lit(route(wf, step, has_store)))
            items_parts.append(items)
            if step.custom_code:
                gen = keep(run_generator(items, step.custom_code, step.index + 1, wf.default_headers(), profile))
                next_parts.append(gen.filter(F.col("error").isNull()).select(*REQUEST_COLS))
                dead_parts.append(gen.filter(F.col("error").isNotNull()).select(
                    "error", F.lit("generator").alias("stage"), "payload"))
    return next_parts, items_parts, dead_parts


def normalised(wf: Workflow, responses: DataFrame, profile: str = "worker") -> DataFrame:
    """Responses with the index of their step and their parsed page; those of no step go."""
    mode = "strict" if profile == "spider" else "lenient"
    rules = [r for s in wf.steps for r in (s.link_rules + s.data_rules)]
    found = responses.withColumn("_step", wf.dispatch_column(F.col("meta.workflow_index"), mode))
    return with_dom(found.filter(F.col("_step").isNotNull()), "body", R.needs_spans(rules, profile))


def process_responses(wf: Workflow, responses: DataFrame, profile: str = "worker"):
    """One round over given responses (no fetch), generators included: (next_requests, items)."""
    reqs, items, _ = run_steps(wf, normalised(wf, responses, profile), profile, checkpoint=False)
    spark = responses.sparkSession
    return (_union(reqs, empty_requests(spark).select(*REQUEST_COLS)),
            _union(items, None, allow_missing=True) if items else None)
