"""CSS selector -> XPath 1.0, done once on the driver per rule.

Covers the selector forms extraction rules use: type / universal,
``#id``, ``.class``, attribute tests (``[a]``, ``=``, ``~=``, ``|=``,
``^=``, ``$=``, ``*=``), combinators (descendant, ``>``, ``+``, ``~``),
groups (``,``), ``:first-child``, ``:last-child``, ``:nth-child(n)``,
``:first-of-type``, ``:last-of-type``, ``:only-child``, ``:empty``,
``:not(simple)`` and the pseudo-elements ``::text`` and ``::attr(name)``.
"""

from __future__ import annotations

import re

_TOKEN = re.compile(
    r"""\s*(?:
      (?P<comb>[>+~])
    | (?P<pseudo_el>::(?:text|attr\(\s*[^)\s]+\s*\)))
    | (?P<id>\#[\w\-]+)
    | (?P<cls>\.[\w\-]+)
    | (?P<attr>\[\s*[\w\-:]+\s*(?:[~|^$*]?=\s*(?:"[^"]*"|'[^']*'|[^\]\s]+)\s*)?\])
    | (?P<pseudo>:[\w\-]+(?:\([^)]*\))?)
    | (?P<tag>\*|[\w\-]+)
    | (?P<comma>,)
    )""",
    re.VERBOSE,
)


def _lit(s: str) -> str:
    if "'" not in s:
        return f"'{s}'"
    if '"' not in s:
        return f'"{s}"'
    parts = s.split("'")
    return "concat(" + ", \"'\", ".join(f"'{p}'" for p in parts) + ")"


def _attr_cond(text: str) -> str:
    m = re.match(r"\[\s*([\w\-:]+)\s*(?:([~|^$*]?=)\s*(\"[^\"]*\"|'[^']*'|[^\]\s]+)\s*)?\]", text)
    name, op, val = m.group(1).lower(), m.group(2), m.group(3)
    a = f"@{name}"
    if op is None:
        return a
    if val[:1] in "\"'":
        val = val[1:-1]
    v = _lit(val)
    if op == "=":
        return f"{a} = {v}"
    if op == "~=":
        return f"{a} and contains(concat(' ', normalize-space({a}), ' '), {_lit(' ' + val + ' ')})"
    if op == "|=":
        return f"{a} and ({a} = {v} or starts-with({a}, {_lit(val + '-')}))"
    if op == "^=":
        return f"{a} and starts-with({a}, {v})"
    if op == "$=":
        return f"{a} and substring({a}, string-length({a})-{len(val) - 1}) = {v}"
    return f"{a} and contains({a}, {v})"


def _nth(arg: str, axis: str, test: str) -> str:
    arg = arg.strip().lower()
    if arg == "odd":
        a, b = 2, 1
    elif arg == "even":
        a, b = 2, 0
    elif "n" in arg:
        m = re.match(r"([+-]?\d*)n\s*([+-]\s*\d+)?", arg)
        a_s = m.group(1)
        a = -1 if a_s == "-" else (1 if a_s in ("", "+") else int(a_s))
        b = int(m.group(2).replace(" ", "")) if m.group(2) else 0
    else:
        return f"count({axis}::{test}) = {int(arg) - 1}"
    pos = f"(count({axis}::{test}) + 1)"
    if a == 0:
        return f"{pos} = {b}"
    if a > 0:
        return f"{pos} >= {b} and ({pos} - {b}) mod {a} = 0"
    return f"{pos} <= {b} and ({b} - {pos}) mod {-a} = 0"


def _pseudo_cond(text: str, tag: str) -> str:
    m = re.match(r":([\w\-]+)(?:\((.*)\))?$", text)
    name, arg = m.group(1).lower(), m.group(2)
    if name == "first-child":
        return "count(preceding-sibling::*) = 0"
    if name == "last-child":
        return "count(following-sibling::*) = 0"
    if name == "only-child":
        return "count(preceding-sibling::*) = 0 and count(following-sibling::*) = 0"
    if name == "first-of-type":
        return f"count(preceding-sibling::{tag}) = 0"
    if name == "last-of-type":
        return f"count(following-sibling::{tag}) = 0"
    if name == "nth-child":
        return _nth(arg, "preceding-sibling", "*")
    if name == "nth-of-type":
        return _nth(arg, "preceding-sibling", tag)
    if name == "empty":
        return "not(*) and not(string-length())"
    if name == "not":
        inner = _compound_conds(arg.strip(), "*")
        return "not(" + " and ".join(inner[1] or ["true()"]) + ")"
    raise ValueError(f"unsupported CSS pseudo-class: {text}")


def _compound_conds(text: str, default_tag: str = "*"):
    tag = default_tag
    conds = []
    for m in _TOKEN.finditer(text):
        kind = m.lastgroup
        tok = m.group(kind)
        if kind == "tag":
            tag = tok.lower()
        elif kind == "id":
            conds.append(f"@id = {_lit(tok[1:])}")
        elif kind == "cls":
            conds.append(
                f"@class and contains(concat(' ', normalize-space(@class), ' '), {_lit(' ' + tok[1:] + ' ')})")
        elif kind == "attr":
            conds.append(_attr_cond(tok))
        elif kind == "pseudo":
            conds.append(_pseudo_cond(tok, tag))
    return tag, conds


def css_to_xpath(selector: str) -> str:
    """Translate one CSS selector (group) into an XPath expression."""
    out_groups = []
    for group in _split_groups(selector):
        steps = []
        comb = None
        tail = ""
        buf = ""
        pos = 0
        group = group.strip()
        while pos < len(group):
            m = _TOKEN.match(group, pos)
            if not m or m.end() == pos:
                raise ValueError(f"cannot parse CSS selector: {selector!r}")
            kind = m.lastgroup
            ws_before = m.start(kind) > pos and buf
            if kind in ("comb",) or (ws_before and kind not in ("pseudo_el",)):
                if buf:
                    steps.append((comb, buf))
                    buf = ""
                comb = m.group("comb") if kind == "comb" else " "
                if kind == "comb":
                    pos = m.end()
                    continue
            if kind == "pseudo_el":
                tok = m.group(kind)
                tail = "/text()" if tok == "::text" else "/@" + tok[len("::attr("):-1].strip()
            else:
                buf += m.group(kind)
            pos = m.end()
        if buf:
            steps.append((comb, buf))
        xp = ""
        for i, (c, compound) in enumerate(steps):
            tag, conds = _compound_conds(compound)
            pred = "".join(f"[{c_}]" for c_ in conds)
            if i == 0:
                xp = f"descendant-or-self::{tag}{pred}"
            elif c == ">":
                xp += f"/{tag}{pred}"
            elif c == "+":
                xp += f"/following-sibling::*[1][self::{tag}]{pred}"
            elif c == "~":
                xp += f"/following-sibling::{tag}{pred}"
            else:
                xp += f"/descendant-or-self::*/{tag}{pred}"
        out_groups.append(xp + tail)
    return " | ".join(out_groups)


def _split_groups(selector: str):
    depth = 0
    quote = None
    cur = ""
    for ch in selector:
        if quote:
            quote = None if ch == quote else quote
        elif ch in "\"'":
            quote = ch
        elif ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        elif ch == "," and depth == 0:
            yield cur
            cur = ""
            continue
        cur += ch
    yield cur
