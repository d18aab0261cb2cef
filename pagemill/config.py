"""Workflow configuration: load, validate, and derive driver-side literals.

The config is a small control object (a few steps and rules), so it lives
on the driver; ``rules_frame`` exposes it as a DataFrame for reports.
Keys the workflow format declares but no behaviour reads (trim, dataType,
required, timeout, retryCount, ...) are accepted and kept in ``extras``.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from typing import Any, Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.rules import Rule

STEP_REQUEST = "request"
STEP_LINKS = "link_extraction"
STEP_DATA = "data_extraction"


@dataclass
class Step:
    index: int
    id: Any
    type: str
    config: dict = field(default_factory=dict)
    name: str | None = None

    @property
    def link_rules(self) -> list[Rule]:
        return [Rule.from_dict(r) for r in self.config.get("linkExtractionRules") or []]

    @property
    def data_rules(self) -> list[Rule]:
        return [Rule.from_dict(r) for r in self.config.get("extractionRules") or []]

    @property
    def custom_code(self):
        return self.config.get("nextRequestCustomCode") or None

    @property
    def manual_encoding(self) -> str | None:
        if self.config.get("encodingMode", "auto") == "manual" and self.config.get("encoding"):
            return self.config.get("encoding")
        return None


@dataclass
class Workflow:
    task_info: dict
    steps: list[Step]
    raw: dict = field(default_factory=dict, repr=False)

    @property
    def task_id(self) -> str:
        # always text: a missing id becomes 'None', as str() of it would
        return str(self.task_info.get("id"))

    @property
    def task_name(self):
        return self.task_info.get("name")

    @property
    def base_url(self) -> str:
        return self.task_info.get("baseUrl") or ""

    @property
    def concurrency(self) -> int | None:
        return self.task_info.get("concurrency")

    @property
    def request_interval(self) -> float | None:
        return self.task_info.get("requestInterval")

    # Default headers from the first request step with headersMode=json
    def default_headers(self) -> dict:
        for s in self.steps:
            if s.type == STEP_REQUEST:
                if s.config.get("headersMode") == "json" and s.config.get("headersJson"):
                    try:
                        h = json.loads(s.config["headersJson"])
                        return {str(k): str(v) for k, v in h.items()} if isinstance(h, dict) else {}
                    except json.JSONDecodeError:
                        return {}
                # only the first request step with json headers counts; keep looking
        return {}

    # Effective step for a workflow index
    def dispatch(self, index: int, mode: str = "lenient") -> int | None:
        """Index of the step that handles a response at ``index`` (or None).

        lenient (worker): skip request steps and unknown types.
        strict (spider):  request steps advance, an unknown type stops.
        """
        i = index
        while 0 <= i < len(self.steps):
            t = self.steps[i].type
            if t in (STEP_LINKS, STEP_DATA):
                return i
            if t == STEP_REQUEST or mode == "lenient":
                i += 1
                continue
            return None
        return None

    def dispatch_table(self, mode: str = "lenient") -> list[tuple[int, int | None]]:
        return [(i, self.dispatch(i, mode)) for i in range(len(self.steps))]

    def dispatch_column(self, index: Column, mode: str = "lenient") -> Column:
        """Effective step index as a literal CASE over the (few) step indexes."""
        expr = None
        for i, eff in self.dispatch_table(mode):
            val = F.lit(eff).cast("int")
            expr = F.when(index == i, val) if expr is None else expr.when(index == i, val)
        if expr is None:
            return F.lit(None).cast("int")
        return expr.otherwise(F.lit(None).cast("int"))

    # F9
    def is_last_step(self, index: int) -> bool:
        return index == len(self.steps) - 1

    def has_custom_code(self, index: int) -> bool:
        return bool(self.steps[index].custom_code)


def parse_config(cfg: dict) -> Workflow:
    if "taskInfo" not in cfg or "workflowSteps" not in cfg:
        raise ValueError("workflow config needs 'taskInfo' and 'workflowSteps'")
    steps = [
        Step(index=i, id=s.get("id", i + 1), type=s.get("type"), config=s.get("config") or {},
             name=s.get("name"))
        for i, s in enumerate(cfg.get("workflowSteps") or [])
    ]
    return Workflow(task_info=cfg.get("taskInfo") or {}, steps=steps, raw=cfg)


def load_config(path: str) -> Workflow:
    """Read a workflow JSON file (FileNotFoundError / ValueError as documented)."""
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    with open(path, encoding="utf-8") as fh:
        return parse_config(json.load(fh))


def seed_request(wf: Workflow, strict: bool = True) -> dict | None:
    """S2 (strict) / S3 (lenient): the one start request of a workflow."""
    if strict:
        if not wf.steps:
            raise ValueError("workflow has no steps")
        first = wf.steps[0]
        if first.type != STEP_REQUEST:
            raise ValueError("first workflow step must be a request step")
        if first.config.get("headersMode") == "json" and first.config.get("headersJson"):
            json.loads(first.config["headersJson"])  # strict: bad JSON raises
        url = first.config.get("url") or wf.base_url
        if not url:
            raise ValueError("no start url")
        return {"url": url, "method": first.config.get("method") or "GET",
                "headers": wf.default_headers(),
                "meta": {"workflow_index": 0,
                         "context": {"task_id": wf.task_id, "task_name": str(wf.task_name)}},
                "dont_filter": False}
    if not wf.base_url:
        return None
    return {"url": wf.base_url, "method": "GET", "headers": {},
            "meta": {"workflow_index": 0, "context": {}}, "dont_filter": False}


def rules_frame(spark: SparkSession, wf: Workflow) -> DataFrame:
    """Exploded rules table: one row per (step, rule)."""
    rows = []
    for s in wf.steps:
        for kind, rules in (("link", s.link_rules), ("data", s.data_rules)):
            for r in rules:
                rows.append((s.index, s.type, kind, r.field, r.expression, r.extract_type,
                             r.multiple, None if r.max_links in (None, "") else int(r.max_links)))
    return spark.createDataFrame(
        rows,
        "step_index int, step_type string, rule_kind string, field string, expression string, "
        "extract_type string, multiple boolean, max_links int")


# registry of row generators (U1/U2): users register Python callables by name
GENERATORS: dict[str, Callable] = {}


def register_generator(name: str, fn: Callable) -> None:
    """Register ``fn(body, url, data) -> iterable[dict]`` under ``name``.

    A step's ``nextRequestCustomCode`` names a registered generator; source
    text from configs is never executed.
    """
    GENERATORS[name] = fn
