"""Turn raw, possibly broken HTML into well-formed XHTML for Catalyst's ``xpath``.

This is the one per-page Python step of extraction. It runs inside an
Arrow UDF (``pagemill.functions.html``), slice by slice; everything after it –
rule evaluation, zipping, joining, de-duplication – is JVM-side.

Output per page:
  xhtml   well-formed XML; every element carries ``_nid="<n>"`` (document
          order) so element rules can be resolved to spans.
  html    the same tree serialised as HTML (no ``_nid``), the text element
          rules return (outer HTML, like an HTML serialiser would produce).
  starts  1-based start offset of element n in ``html``.
  lens    length of element n's outer HTML.

Recovery follows the usual HTML-parser conventions: tags and attribute
names lower-cased, void elements closed, implied end tags (``<p>``
closed by a new block, list items closing each other, ...), stray end
tags ignored, ``html``/``head``/``body`` created when missing, script and
style content kept as raw text, characters not allowed in XML dropped,
duplicate attributes first-wins.
"""

from __future__ import annotations

import re
from html import unescape
from urllib.parse import quote

# ---- fixed values: HTML structure tables --------------------------------
VOID_ELEMENTS = frozenset(
    "area base basefont bgsound br col embed frame hr img input isindex "
    "keygen link meta param source track wbr".split()
)
RAW_TEXT_ELEMENTS = frozenset(["script", "style"])
HEAD_ELEMENTS = frozenset("title meta link base style script noscript".split())
FONT_STYLE = ("tt", "i", "b", "u", "s", "strike", "big", "small")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
BLOCK_CLOSING_P = (
    "p div ul ol dl menu dir address pre listing xmp blockquote form hr "
    "table fieldset center article aside section header footer nav main "
    "figure figcaption details summary"
).split()
# start tag -> open elements it closes when they are the current node
START_CLOSES = {
    "p": ("p", "head") + HEADINGS + FONT_STYLE,
    "li": ("p", "head", "li") + HEADINGS,
    "dt": ("p", "head", "dt", "dd"),
    "dd": ("p", "head", "dt", "dd"),
    "option": ("option",),
    "optgroup": ("option", "optgroup"),
    "tr": ("th", "td", "tr", "caption", "col", "colgroup", "p"),
    "td": ("th", "td", "p"),
    "th": ("th", "td", "p"),
    "thead": ("caption", "col", "colgroup"),
    "tbody": ("th", "td", "tr", "caption", "col", "colgroup", "thead", "tfoot", "tbody", "p"),
    "tfoot": ("th", "td", "tr", "caption", "col", "colgroup", "thead", "tbody", "p"),
    "a": ("a", "head"),
    "title": ("p",),
}
for _h in HEADINGS:
    START_CLOSES[_h] = ("p", "head") + HEADINGS
for _b in BLOCK_CLOSING_P:
    START_CLOSES.setdefault(_b, ("p", "head"))
# an end tag may not close an open element of higher priority
END_PRIORITY = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180,
                "tbody": 180, "tfoot": 180, "table": 190, "head": 200,
                "body": 200, "html": 220}
# attributes holding URIs are %-escaped on HTML output
URI_ATTRIBUTES = frozenset(["href", "src", "action"])
# characters that may not appear in XML 1.0
_XML_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿\ud800-\udfff]")
_NAME_OK = re.compile(r"^[a-z_][a-z0-9_.\-]*$")
_NAME_FIX = re.compile(r"[^a-z0-9_.\-]")
# --------------------------------------------------------------------------


_NAMES: dict[str, str] = {}


def _clean_name(name: str) -> str:
    cached = _NAMES.get(name)
    if cached is not None:
        return cached
    if len(_NAMES) < 4096:
        cached = _NAMES[name] = _clean_name_uncached(name)
        return cached
    return _clean_name_uncached(name)


def _clean_name_uncached(name: str) -> str:
    name = name.lower()
    if _NAME_OK.match(name):
        return name
    name = _NAME_FIX.sub("_", name)
    if not name or not (name[0].isalpha() or name[0] == "_"):
        name = "_" + name
    return name


class _Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag, attrs=None):
        self.tag = tag
        self.attrs = attrs or []
        self.children = []


# one scan over the markup: comments, declarations / processing
# instructions, end tags, start tags (with their attribute text), text
_TOKEN = re.compile(
    r"<!--(.*?)(?:-->|\Z)"
    r"|<[!?][^>]*>?"
    r"|</([A-Za-z][^\t\n\r\f />]*)[^>]*>?"
    r"|<([A-Za-z][^\t\n\r\f />\x00]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|[^<]+|<",
    re.S,
)
_ATTR = re.compile(
    r"((?<=[\s'\"/])[^\s/>][^\s/=>]*)(\s*=+\s*('[^']*'|\"[^\"]*\"|(?!['\"])[^>\s]*))?")
_RAW_END = {t: re.compile(r"</%s(?=[\s/>])[^>]*>|</%s$" % (t, t), re.I) for t in RAW_TEXT_ELEMENTS}


def _attributes(text: str):
    out = []
    for m in _ATTR.finditer(" " + text):
        name, value = m.group(1), m.group(3)
        if value is not None:
            if value[:1] in "'\"" and value[-1:] == value[:1] and len(value) > 1:
                value = value[1:-1]
            value = unescape(value) if "&" in value else value
        out.append((name.lower(), value))
    return out


def _feed(builder: "_TreeBuilder", html: str) -> None:
    """Drive the tree builder with start / end / text / comment events."""
    pos, n = 0, len(html)
    text: list[str] = []

    def flush():
        if text:
            t = "".join(text)
            text.clear()
            builder.handle_data(unescape(t) if "&" in t else t)

    match = _TOKEN.match
    while pos < n:
        m = match(html, pos)
        pos = m.end()
        comment, end_tag, start_tag, attrs_text = m.groups()
        if start_tag is not None:           # start tag
            flush()
            tag = start_tag.lower()
            stripped = attrs_text.rstrip()
            # '/>' closes the tag unless the slash ends an unquoted value (href=x/)
            self_closing = stripped.endswith("/") and (
                len(stripped) == 1 or stripped[-2] in " \t\n\r\f\"'")
            builder.handle_starttag(tag, _attributes(attrs_text.rstrip("/ \t\n\r\f") if self_closing
                                                     else attrs_text))
            if tag in RAW_TEXT_ELEMENTS and not self_closing:
                end = _RAW_END[tag].search(html, pos)
                stop = end.start() if end else n
                if stop > pos:
                    builder.handle_data(html[pos:stop])
                pos = end.end() if end else n
                builder.handle_endtag(tag)
            elif self_closing:
                builder.handle_endtag(tag)
        elif end_tag is not None:           # end tag
            flush()
            builder.handle_endtag(end_tag.lower())
        elif comment is not None:           # comment
            flush()
            builder.handle_comment(comment)
        elif m.group(0).startswith(("<!", "<?")) and len(m.group(0)) > 1:
            flush()                         # doctype, declaration, PI: dropped
        else:
            text.append(m.group(0))         # text, or a lone '<'
    flush()


class _TreeBuilder:
    def __init__(self):
        self.root = _Node("#root")
        self.stack = [self.root]
        self.html = self.head = self.body = None

    # -- structure helpers --------------------------------------------
    def _top(self):
        return self.stack[-1]

    def _ensure_html(self):
        if self.html is None:
            self.html = _Node("html")
            self.root.children.append(self.html)
            self.stack = [self.root, self.html]

    def _ensure_head(self):
        self._ensure_html()
        if self.head is None:
            self.head = _Node("head")
            self.html.children.append(self.head)
        if self.head not in self.stack:
            self.stack = [self.root, self.html, self.head]

    def _ensure_body(self):
        self._ensure_html()
        if self.head is not None and self.head in self.stack:
            del self.stack[self.stack.index(self.head):]
        if self.body is None:
            self.body = _Node("body")
            self.html.children.append(self.body)
            self.stack = [self.root, self.html, self.body]
        elif self.body not in self.stack:
            self.stack = [self.root, self.html, self.body]

    def _attrs(self, attrs):
        seen = set()
        out = []
        for k, v in attrs:
            k = _clean_name(k)
            if k in seen or k == "_nid" or k.startswith("xmlns"):
                continue
            seen.add(k)
            out.append((k, None if v is None else _XML_BAD.sub("", v)))
        return out

    # -- parser callbacks -----------------------------------------------
    def handle_starttag(self, tag, attrs):
        tag = _clean_name(tag)
        attrs = self._attrs(attrs)
        if tag == "html":
            if self.html is None:
                self.html = _Node("html", attrs)
                self.root.children.append(self.html)
                self.stack = [self.root, self.html]
            return
        if tag == "head":
            if self.head is None and self.body is None:
                self._ensure_html()
                self.head = _Node("head", attrs)
                self.html.children.append(self.head)
                self.stack = [self.root, self.html, self.head]
            return
        if tag == "body":
            if self.body is None:
                self._ensure_html()
                if self.head is not None and self.head in self.stack:
                    del self.stack[self.stack.index(self.head):]
                self.body = _Node("body", attrs)
                self.html.children.append(self.body)
                self.stack = [self.root, self.html, self.body]
            return
        if tag in HEAD_ELEMENTS and self.body is None:
            self._ensure_head()
        elif self.body is None or self._top() in (self.root, self.html, self.head):
            self._ensure_body()
        closes = START_CLOSES.get(tag)
        if closes:
            while len(self.stack) > 3 and self._top().tag in closes:
                self.stack.pop()
        node = _Node(tag, attrs)
        self._top().children.append(node)
        if tag not in VOID_ELEMENTS:
            self.stack.append(node)

    def handle_endtag(self, tag):
        tag = _clean_name(tag)
        if tag in ("html", "body"):
            return
        prio = END_PRIORITY.get(tag, 100)
        for i in range(len(self.stack) - 1, 0, -1):
            open_tag = self.stack[i].tag
            if open_tag == tag:
                del self.stack[i:]
                return
            if END_PRIORITY.get(open_tag, 100) > prio:
                return

    def handle_data(self, data):
        data = _XML_BAD.sub("", data)
        if not data:
            return
        top = self._top()
        if top in (self.root, self.html) or (top is self.head and top is not None):
            if not data.strip():
                return
            self._ensure_body()
            p = _Node("p")
            self.body.children.append(p)
            self.stack.append(p)
        self._top().children.append(data)

    def handle_comment(self, data):
        data = _XML_BAD.sub("", data)
        self._top().children.append(("#comment", data))

    def handle_decl(self, decl):
        pass

    def unknown_decl(self, data):
        pass

    def handle_pi(self, data):
        pass


def _xml_text(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _xml_attr(s: str) -> str:
    return (s.replace("&", "&amp;").replace("<", "&lt;").replace('"', "&quot;")
            .replace("\n", "&#10;").replace("\r", "&#13;").replace("\t", "&#9;"))


def _html_attr(name: str, s: str) -> str:
    if name in URI_ATTRIBUTES:
        s = quote(s.strip(), safe="!*'()@/:=?;#%&,+")
    return s.replace("&", "&amp;").replace('"', "&quot;")


def _comment(s: str) -> str:
    """Comment text without ``--`` and without a hyphen at its end, as XML asks."""
    return re.sub(r"-(?=-|\Z)", "- ", s)


def normalize(html: str | None, with_html: bool = True):
    """Return (xhtml, html, starts, lens) for one page (see module doc)."""
    if html is None:
        html = ""
    b = _TreeBuilder()
    _feed(b, html)
    if b.html is None:
        b._ensure_html()
    xs: list[str] = []
    hs: list[str] = []
    hlen = 0
    starts: list[int] = []
    lens: list[int] = []
    # iterative walk: ("open", node) / ("close", node, nid, raw) / text
    work = [("node", c, False) for c in reversed(b.root.children)]
    while work:
        item = work.pop()
        kind = item[0]
        if kind == "close":
            _, node, nid = item
            xs.append(f"</{node.tag}>")
            if node.tag not in VOID_ELEMENTS:
                end = f"</{node.tag}>"
                hs.append(end)
                hlen += len(end)
            lens[nid] = hlen - starts[nid] + 1
            continue
        _, node, raw = item
        if isinstance(node, str):
            xs.append(_xml_text(node))
            t = node if raw else _xml_text(node)
            hs.append(t)
            hlen += len(t)
            continue
        if isinstance(node, tuple):
            c = _comment(node[1])
            xs.append(f"<!--{c}-->")
            t = f"<!--{node[1]}-->"
            hs.append(t)
            hlen += len(t)
            continue
        nid = len(starts)
        starts.append(hlen + 1)
        lens.append(0)
        xattrs = "".join(
            f' {k}="{_xml_attr(v if v is not None else k)}"' for k, v in node.attrs)
        xs.append(f'<{node.tag}{xattrs} _nid="{nid}">')
        hattrs = "".join(
            f' {k}' if v is None else f' {k}="{_html_attr(k, v)}"' for k, v in node.attrs)
        t = f"<{node.tag}{hattrs}>"
        hs.append(t)
        hlen += len(t)
        work.append(("close", node, nid))
        child_raw = node.tag in RAW_TEXT_ELEMENTS
        for c in reversed(node.children):
            work.append(("node", c, child_raw))
    xhtml = "".join(xs)
    if not with_html:
        return xhtml, None, None, None
    return xhtml, "".join(hs), starts, lens
