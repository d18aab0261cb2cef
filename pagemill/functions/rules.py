"""Extraction rules as column expressions.

A rule (fieldName, expression, extractType, multiple, maxLinks) becomes a
Catalyst expression over the normalised page (see ``htmlnorm``):

  attribute / text result  -> ``xpath(xhtml, expr)``
  element result           -> ``xpath(xhtml, '(expr)/@_nid')`` mapped to
                              outer-HTML substrings of the clean ``html``
  number / boolean / string expression -> ``xpath_double`` /
                              ``xpath_boolean`` / ``xpath_string`` rendered
                              as text ('6.0', '1' / '0', text)

All values are whitespace-stripped. ``values(...)`` is the list form
(``multiple``); ``first(...)`` is the single form (null if nothing matched).
The rule kind is decided here on the driver, from the expression text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.css import css_to_xpath

# ---- fixed values ----------------------------------------------------------
# Unicode whitespace as stripped by Python's str.strip()
STRIP_CHARS = (
    "\\t\\n\\x0b\\x0c\\r\\x1c\\x1d\\x1e\\x1f \\x85\\xa0\\u1680"
    "\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
)
STRIP_PATTERN = f"^[{STRIP_CHARS}]+|[{STRIP_CHARS}]+$"
NUMBER_FUNCS = ("count", "sum", "number", "string-length", "floor", "ceiling", "round")
BOOLEAN_FUNCS = ("boolean", "not", "contains", "starts-with", "true", "false", "lang")
STRING_FUNCS = ("string", "concat", "normalize-space", "substring", "substring-before",
                "substring-after", "translate", "name", "local-name", "namespace-uri")
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    field: str
    expression: str = ""
    extract_type: str = "xpath"
    multiple: bool = False
    max_links: Any = None
    extras: dict = field(default_factory=dict, compare=False, hash=False)

    @staticmethod
    def from_dict(d: dict) -> "Rule":
        known = {"fieldName", "expression", "extractType", "multiple", "maxLinks"}
        return Rule(
            field=d.get("fieldName"),
            expression=d.get("expression") or "",
            extract_type=d.get("extractType", "xpath") or "xpath",
            multiple=bool(d.get("multiple", False)),
            max_links=d.get("maxLinks"),
            extras={k: v for k, v in d.items() if k not in known},
        )


def to_xpath(expression: str, extract_type: str, profile: str = "worker") -> str:
    """Rule expression -> XPath. Worker: only 'css' is CSS. Spider: anything but 'xpath'."""
    is_css = extract_type == "css" if profile == "worker" else extract_type != "xpath"
    xp = css_to_xpath(expression) if is_css else expression
    # keep the internal node-id attribute invisible to attribute wildcards
    return re.sub(r"(@\*|attribute::\*)", "\\1[name()!='_nid']", xp)


def _strip_outer(expr: str) -> str:
    e = expr.strip()
    while True:
        # drop trailing predicates: (...)[n]
        m = re.match(r"^(.*\))\s*(\[[^\[\]]*\])$", e, re.S)
        if m and _balanced(m.group(1)):
            e = m.group(1).strip()
            continue
        if e.startswith("(") and e.endswith(")") and _balanced(e[1:-1]):
            e = e[1:-1].strip()
            continue
        return e


def _balanced(s: str) -> bool:
    depth = 0
    quote = None
    for ch in s:
        if quote:
            quote = None if ch == quote else quote
        elif ch in "\"'":
            quote = ch
        elif ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
            if depth < 0:
                return False
    return depth == 0 and quote is None


def _last_step(expr: str) -> str:
    depth = 0
    quote = None
    last = 0
    for i, ch in enumerate(expr):
        if quote:
            quote = None if ch == quote else quote
        elif ch in "\"'":
            quote = ch
        elif ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        elif ch == "/" and depth == 0:
            last = i + 1
    step = expr[last:]
    return re.sub(r"\[.*\]$", "", step, flags=re.S).strip()


def classify(xpath: str) -> str:
    """'number' | 'boolean' | 'string' | 'value' (attr/text) | 'element'."""
    e = _strip_outer(xpath)
    m = re.match(r"^([a-z][a-z\-]*)\s*\(", e)
    if m and _balanced(e[m.end() - 1:]) and e.endswith(")") and m.group(1) not in (
            "text", "node", "comment", "processing-instruction"):
        fn = m.group(1)
        if fn in NUMBER_FUNCS:
            return "number"
        if fn in BOOLEAN_FUNCS:
            return "boolean"
        if fn in STRING_FUNCS:
            return "string"
    if re.search(r"(^|[^!<>])=|!=|<|>| and | or ", e.replace("::", "  ")) and "[" not in e:
        return "boolean"
    branches = [b.strip() for b in _split_union(e)]
    kinds = set()
    for b in branches:
        step = _last_step(_strip_outer(b))
        if step.startswith("@") or step.startswith("attribute::") or step in (
                "text()", "child::text()") or step.endswith("text()"):
            kinds.add("value")
        elif step.startswith("comment()"):
            kinds.add("value")
        else:
            kinds.add("element")
    return "element" if kinds == {"element"} else "value"


def _split_union(expr: str):
    depth = 0
    quote = None
    cur = ""
    for ch in expr:
        if quote:
            quote = None if ch == quote else quote
        elif ch in "\"'":
            quote = ch
        elif ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        elif ch == "|" and depth == 0:
            yield cur
            cur = ""
            continue
        cur += ch
    yield cur


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, STRIP_PATTERN, "")


def _render_number(c: Column) -> Column:
    # Python str(float): 6.0, nan, inf
    return (F.when(F.isnan(c), F.lit("nan"))
            .when(c == float("inf"), F.lit("inf"))
            .when(c == float("-inf"), F.lit("-inf"))
            .otherwise(c.cast("string")))


def values(dom: Column, rule: Rule, profile: str = "worker") -> Column:
    """array<string> of stripped matches, in document order (never null)."""
    if not rule.expression:
        return F.array().cast("array<string>")
    xp = to_xpath(rule.expression, rule.extract_type, profile)
    kind = classify(xp)
    xhtml = dom.getField("xhtml")
    if kind == "number":
        arr = F.array(_render_number(F.xpath_double(xhtml, F.lit(xp))))
    elif kind == "boolean":
        arr = F.array(F.when(F.xpath_boolean(xhtml, F.lit(xp)), F.lit("1")).otherwise(F.lit("0")))
    elif kind == "string":
        arr = F.array(F.xpath_string(xhtml, F.lit(xp)))
    elif kind == "element":
        nids = F.xpath(xhtml, F.lit(f"({xp})/@_nid"))
        html = dom.getField("html")
        starts = dom.getField("starts")
        lens = dom.getField("lens")
        arr = F.transform(
            nids,
            lambda n: F.substr(html,
                               F.get(starts, n.cast("int")),
                               F.get(lens, n.cast("int"))),
        )
    else:
        arr = F.xpath(xhtml, F.lit(xp))
    arr = F.transform(F.coalesce(arr, F.array().cast("array<string>")), strip_ws)
    # a page that did not parse (null dom) yields no values
    return F.when(xhtml.isNull(), F.array().cast("array<string>")).otherwise(arr)


def first(dom: Column, rule: Rule, profile: str = "worker") -> Column:
    """Single form: first stripped match or null; empty expression -> ''."""
    if not rule.expression:
        return F.lit("")
    return F.get(values(dom, rule, profile), 0)


def needs_spans(rules, profile: str = "worker") -> bool:
    return any(r.expression and classify(to_xpath(r.expression, r.extract_type, profile)) == "element"
               for r in rules)
