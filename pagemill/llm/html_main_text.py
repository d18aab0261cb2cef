"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: the runs of text between the starts and ends of
block elements, each with the tags, classes and ids of its ancestors. The CRF
labels each block as main text or not; its features are the ancestors' tags and
names, the parent, and properties of the text (length, share of linked text,
punctuation, place in the page), and transitions tie neighbours together.
Viterbi decoding picks the best labelling of the whole page.

The model is trained by gradient steps on the exact log-likelihood over a
bounded sample of labelled pages (``max_pages``). Unless the caller has labels,
pages whose authors marked the main text up serve as labelled ones: a block is
main when it lies in an ``article`` or ``main`` element and in no part that is
not text (see ``marked_label``). Each such page is learnt from three times (see
``examples``), once without the features that made its labels, so pages without
such markup are decoded by the other features.

Cases: a null or empty html, and a page without text, have the empty text.
Unclosed and misnested tags, comments, quotes and raw text elements are read as
browsers do, near enough: ``p``, ``li`` and table cells end where the next one
starts, an end tag without a start is skipped, a head without end ends at the
first start tag or text that does not belong there. Repeated rows, null ids and urls
are kept; other columns are not read. With no labelled page in the sample the
labels of ``marked_label`` are used as they are. Empty tables give empty
results.
"""

from __future__ import annotations

import html as entities
import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, map_rows

MAX_PAGES = 200

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*+>"""
    r"""|</?[a-zA-Z][^>]*+(?:>|\Z)|[^<]++|<""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
#: Elements that start and end a block.
BLOCK = frozenset("""address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
SILENT = frozenset("script style template noscript iframe object svg math canvas audio video head select textarea".split())
HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())  # these leave a head open
RAW = frozenset("script style textarea title iframe noscript".split())  # content without markup
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
#: An element that ends an open one of its row.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
         "th": ("td", "th"), "option": ("option",)}
_P_KEEPS = BLOCK - {"br", "button", "option"}  # these end an open p
MAIN_TAGS = frozenset(("article", "main"))
OTHER_TAGS = frozenset(("nav", "header", "footer", "aside", "form", "button", "dialog", "menu"))
#: Names of parts that are not the main text.
OTHER_NAMES = frozenset("""ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies
disqus footer masthead menu nav navbar navigation newsletter notice pagination popup promo promoted related share sharing
sidebar social sponsor sponsored subscribe widget""".split())


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, frozenset], ...]  # ancestors from the outside: tag, words of class, id and role
    linked: int  # characters inside links
    holders: int = 0  # so many outer ancestors hold all main elements of the page, or else all its articles


def leaf_blocks(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, frozenset]] = []
    ids: list[int] = []  # of the elements in the stack, by their order in the page
    paths: list[list[int]] = []  # of the blocks
    held_by: dict[str, list[int]] = {}  # ids of the ancestors that all elements of a kind have in common
    count = 0
    held: list[str] = []
    linked = silent = links = 0
    at, size, match = 0, len(page), _TOKEN.match

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                out.append(Block(text, tuple(stack), min(linked, len(text))))
                paths.append(ids.copy())
            held.clear()
            linked = 0

    def pop_to(k: int) -> None:
        nonlocal silent, links
        for tag, _ in stack[k:]:
            silent -= tag in SILENT
            links -= tag == "a"
        del stack[k:], ids[k:]

    while at < size:
        m = match(page, at)
        at = m.end()
        tag = m["tag"]
        if tag is None:
            piece = m[0]
            if (piece[0] != "<" or piece == "<") and stack and stack[-1][0] == "head" and piece.strip():
                pop_to(len(stack) - 1)
            if (piece[0] != "<" or piece == "<") and not silent:
                held.append(piece)
                if links:
                    linked += len(piece)
            continue
        tag = tag.lower()
        if tag in BLOCK:
            flush()
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop_to(k)
                    break
                if stack[k][0] in ("table", "body") and tag != "html":
                    break
            continue
        if stack and stack[-1][0] == "head" and tag not in HEAD:
            pop_to(len(stack) - 1)
        if tag in _P_KEEPS or tag in _ENDS:
            ends = _ENDS.get(tag, ()) + (("p",) if tag in _P_KEEPS else ())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    pop_to(k)
                    if stack and stack[-1][0] in ends and tag == "tr":
                        continue
                    break
                if stack[k][0] in BLOCK:
                    break
        if tag in VOID or m["rest"].endswith("/") and tag not in BLOCK:
            continue
        names = frozenset(w for v in _NAMES.findall(m["rest"]) for w in _WORD.findall("".join(v).lower()))
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.start() if end else size
            if tag in SILENT or tag == "title":
                continue
        kind = tag if tag in MAIN_TAGS else "named" if "main" in names and not names & OTHER_NAMES else None
        if kind:
            held_by[kind] = _shared(held_by.get(kind, ids), ids)
        stack.append((tag, names))
        ids.append(count)
        count += 1
        silent += tag in SILENT
        links += tag == "a"
    flush()
    holding = next((held_by[k] for k in ("main", "article", "named") if k in held_by), [])
    for block, path in zip(out, paths, strict=True):
        block.holders = len(_shared(path, holding))
    return out


def _shared(a: list[int], b: list[int]) -> list[int]:
    """What two paths have in common from the outside."""
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[:k]


def marked_label(block: Block) -> int:
    """1 where the page's own markup says main text."""
    return int(zone(block) == "main")


def zone(block: Block) -> str:
    """By markup alone: ``main``, ``other`` (a part that is not text, also inside the main one) or ``none``.
    The names of the page as a whole (html, body) and of what holds its main elements or articles tell of
    the layout ("has-nav", "no-sidebar") and name no part."""
    inside = False
    for k, (tag, names) in enumerate(block.path):
        if tag in OTHER_TAGS and not (tag == "header" and inside) or (
                k >= block.holders and tag not in ("html", "body") and names & OTHER_NAMES):
            return "other"
        inside = inside or tag in MAIN_TAGS or "main" in names
    return "main" if inside else "none"


def features(block: Block, place: int, count: int, blind: bool = False) -> list[str]:
    """Names of the features that hold. ``blind`` leaves out those that ``marked_label`` reads."""
    text, n = block.text, len(block.text)
    parent = block.path[-1][0] if block.path else "none"
    out = ["bias", "len:" + str(min(int(math.log2(n)), 11)), "link:" + str(4 * block.linked // n),
           "place:" + str(5 * place // count), "words:" + str(min(text.count(" "), 6))]
    if text[-1] in ".!?…:;\"'”»)":
        out.append("closed")
    if "," in text or ". " in text:
        out.append("clauses")
    if "©" in text or "http" in text or "@" in text:
        out.append("mark")
    if sum(c.isdigit() for c in text) * 3 > n:
        out.append("digits")
    if place == 0:
        out.append("first")
    if place == count - 1:
        out.append("last")
    # what marks parts is summed up by the zone, so that a kind of part that no training page has
    # weighs as much as the others
    read = MAIN_TAGS | OTHER_TAGS
    if not blind:
        out.append("zone:" + zone(block))
    if parent not in read:
        out.append("parent:" + parent)
    seen = set()
    for tag, names in block.path:
        if tag not in ("html", "body") and tag not in read:
            seen.add("tag:" + tag)
        seen.update("name:" + w for w in names if w != "main" and w not in OTHER_NAMES)
    out.extend(sorted(seen))
    return out


@dataclass
class Crf:
    """Two labels: scores of label 1 per feature, and of the transitions and starts."""

    weights: dict[str, float]
    step: list[list[float]]
    start: list[float]

    def decode(self, sequence: list[list[str]]) -> list[int]:
        """Viterbi: the best labelling; the other label on ties with label 0 first."""
        get, (s00, s01), (s10, s11) = self.weights.get, *self.step
        back, a, b = [], 0.0, 0.0
        for k, names in enumerate(sequence):
            e = sum(get(f, 0.0) for f in names)
            if not k:
                a, b = self.start[0], self.start[1] + e
                continue
            from_a, from_b = a + s00 >= b + s10, a + s01 > b + s11
            a, b = (a + s00 if from_a else b + s10), (a + s01 if from_b else b + s11) + e
            back.append((0 if from_a else 1, 0 if from_b else 1))
        labels = [int(b > a)] if sequence else []
        for choice in reversed(back):
            labels.append(choice[labels[-1]])
        return labels[::-1]


def train(sequences: list[list[list[str]]], labels: list[list[int]], steps: int = 100, penalty: float = 3e-4) -> Crf:
    """Maximum likelihood with a ridge penalty by Adam steps; forward and backward sums run over
    all pages at once."""
    names = sorted({f for s in sequences for fs in s for f in fs})
    index = {f: k for k, f in enumerate(names)}
    pages, longest = len(sequences), max(map(len, sequences))
    mask = np.zeros((pages, longest), bool)
    y = np.zeros((pages, longest), int)
    rows, cols = [], []
    for i, (s, l) in enumerate(zip(sequences, labels, strict=True)):
        mask[i, :len(s)], y[i, :len(s)] = True, l
        for t, fs in enumerate(s):
            rows += [i * longest + t] * len(fs)
            cols += [index[f] for f in fs]
    rows, cols = np.array(rows), np.array(cols)
    k, cells = len(names), pages * longest
    blocks = mask.sum()
    truth_step = np.zeros((2, 2))
    both = mask[:, 1:]
    np.add.at(truth_step, (y[:, :-1][both], y[:, 1:][both]), 1)
    truth = np.r_[np.bincount(cols, y.reshape(-1)[rows], k), truth_step.ravel(), np.bincount(y[:, 0], minlength=2)]
    w, m, v = np.zeros(k + 6), np.zeros(k + 6), np.zeros(k + 6)
    for turn in range(1, steps + 1):
        step, start = w[k:k + 4].reshape(2, 2), w[k + 4:]
        emit = np.zeros((pages, longest, 2))
        emit[:, :, 1] = np.bincount(rows, w[cols], cells).reshape(pages, longest)
        fore, aft = np.zeros_like(emit), np.zeros_like(emit)
        fore[:, 0] = start + emit[:, 0]
        for t in range(1, longest):
            nxt = np.logaddexp.reduce(fore[:, t - 1, :, None] + step, axis=1) + emit[:, t]
            fore[:, t] = np.where(mask[:, t, None], nxt, fore[:, t - 1])
        for t in range(longest - 2, -1, -1):
            nxt = np.logaddexp.reduce(step + (emit[:, t + 1] + aft[:, t + 1])[:, None, :], axis=2)
            aft[:, t] = np.where(mask[:, t + 1, None], nxt, 0)
        total = np.logaddexp.reduce(fore[:, -1], axis=1)
        p = np.exp(fore + aft - total[:, None, None])
        pair = np.exp(fore[:, :-1, :, None] + step + (emit + aft)[:, 1:, None, :] - total[:, None, None, None])
        expected = np.r_[np.bincount(cols, (p[:, :, 1] * mask).reshape(-1)[rows], k),
                         (pair * both[:, :, None, None]).sum((0, 1)).ravel(), p[:, 0].sum(0)]
        grad = (expected - truth) / blocks + penalty * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.2 * (1 - turn / (steps + 1)) * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-8)
    return Crf({f: float(w[i]) for f, i in index.items()}, w[k:k + 4].reshape(2, 2).tolist(), w[k + 4:].tolist())


def page_features(blocks: list[Block], blind: bool = False) -> list[list[str]]:
    return [features(b, i, len(blocks), blind) for i, b in enumerate(blocks)]


def examples(blocks: list[Block]) -> list[tuple[list[list[str]], list[int]]]:
    """What a page that its own markup labels is learnt from: as it is; without the features that made
    the labels; and with parts that look like the text but lie in another zone (comments, asides)
    put between its blocks."""
    marked = [marked_label(b) for b in blocks]
    plain = page_features(blocks)
    mixed, labels = [], []
    for k, (names, y) in enumerate(zip(plain, marked, strict=True)):
        mixed.append(names)
        labels.append(y)
        if y and k % 3 == 1:
            mixed.append(["zone:other" if f == "zone:main" else f for f in plain[(k * 7) % len(plain)] if f != "zone:none"])
            if "zone:other" not in mixed[-1]:
                mixed[-1].append("zone:other")
            labels.append(0)
    return [(plain, marked), (page_features(blocks, True), marked), (mixed, labels)]


def fit(pages: DataFrame, html_col: str = "html", max_pages: int = MAX_PAGES, label: Column | None = None) -> Crf | None:
    """Train on at most ``max_pages`` labelled pages, taken by the order of a hash of the page.
    ``label``: a column array<int>, a label for each leaf block; without it the pages that their
    own markup labels are used. None when there is no such page."""
    rows = pages.where(pages[html_col].isNotNull()).select(
        pages[html_col].alias("html"), (label if label is not None else F.lit(None).cast("array<int>")).alias("label"))
    if label is None:
        rows = rows.where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    sample = cut_lineage(rows.withColumn("h", F.xxhash64("html")).orderBy("h").limit(max_pages))

    def make():
        def each(cols):
            for page, given in zip(cols["html"], cols["label"], strict=True):
                blocks = leaf_blocks(page)
                if blocks and given is None:
                    yield from examples(blocks)
                elif blocks and len(given) == len(blocks):
                    yield page_features(blocks), given
        return each

    seen = map_rows(sample, make, "sequence array<array<string>>, label array<int>").toPandas()  # 3 * max_pages rows
    if not len(seen):
        return None
    return train([[list(f) for f in s] for s in seen["sequence"]], [list(x) for x in seen["label"]])


def extract(pages: DataFrame, model: Crf | None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars per row."""

    def make():
        def each(cols):
            for i, url, page in zip(cols["id"], cols["url"], cols["html"], strict=True):
                blocks = leaf_blocks(page or "")
                labels = model.decode(page_features(blocks)) if model else [marked_label(b) for b in blocks]
                text = "\n".join(b.text for b, y in zip(blocks, labels, strict=True) if y)
                yield i, url, text, len(text)
        return each

    rows = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    return map_rows(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, "
                                f"url {rows.schema['url'].dataType.simpleString()}, text string, n_chars long")
