"""Toxicity by a classifier chain.

Categories are predicted in a fixed order by linear (logistic) models on the
words and word stems of a text; the model of each category also sees the
log-odds of the categories before it. In training those come out of fold: the
log-odds fed to a later model are those of models that did not see the row, so
the later model does not trust the earlier ones more than it may at scoring.

The models are fitted on a bounded sample of labelled rows (``max_labelled``,
taken in the order of a hash of the id, so the same rows every time); terms
are counted and selected in Spark and at most ``max_terms`` are used. Every
text is then scored whole, in Arrow batches, by looking up its terms in the
weights: the models are small and of fixed size.

Cases: a null text is empty and gets the models' intercepts; null ids and rows
without a label are scored like others; label rows with a null label or id are
not used, of repeated labels of an id the largest counts; repeated documents
are scored alike, and equal texts count once in training. With no usable labels
or only one class a category's probability is its (smoothed) share and nothing
is rejected. Other columns pass through untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, map_rows, text_or_empty, tmp_name

MAX_LABELLED = 20_000
MAX_TERMS = 8_192
MIN_CHI = 12.0
SPARSITY = 0.05
STEM = 4
_WORDS = re.compile(r"[^\W\d_]+").findall


def terms(text: str) -> set[str]:
    """Distinct lower-case words, and the stems of the longer ones (marked by a star)."""
    words = set(_WORDS(text.lower()))
    return words | {w[:STEM] + "*" for w in words if len(w) > STEM}


@dataclass
class Link:
    """The model of one category."""

    category: str
    intercept: float
    weights: dict[str, float] = field(default_factory=dict)
    earlier: list[float] = field(default_factory=list)  # weights of the log-odds of the categories before


@dataclass
class Chain:
    links: list[Link]
    cut: float  # rejected from this probability of the last category

    def probabilities(self, text: str) -> list[float]:
        held, odds = terms(text), []
        for link in self.links:
            z = link.intercept + sum(w * o for w, o in zip(link.earlier, odds, strict=True))
            get = link.weights.get
            z += sum(get(t, 0.0) for t in held)
            odds.append(min(max(z, -30.0), 30.0))
        return [1 / (1 + np.exp(-z)) for z in odds]


class Incidence:
    """The rows x terms matrix of zeros and ones at (rows, cols), for its products with a vector. Terms that
    a sixteenth of the rows hold (at most ``most`` of them) are dense columns; the others are summed over
    runs of their places, sorted by row and by term. ``rows`` is ascending."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, n: int, k: int, most: int = 512):
        self.n, self.k = n, k
        df = np.bincount(cols, minlength=k)
        order = np.argsort(-df, kind="stable")[:most]
        self.top = order[df[order] * 16 >= max(n, 1)]
        place = np.full(k, -1)
        place[self.top] = np.arange(len(self.top))
        at = place[cols]
        self.dense = np.zeros((n, len(self.top)))
        self.dense[rows[at >= 0], at[at >= 0]] = 1
        rest, self.cols = rows[at < 0], cols[at < 0]
        self.rows = rest[np.argsort(self.cols, kind="stable")]
        self.by_row, self.row_starts = self._runs(rest, n)
        self.by_term, self.term_starts = self._runs(self.cols, k)

    @staticmethod
    def _runs(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The keys that occur, ascending, and where the run of each starts when sorted."""
        count = np.bincount(keys, minlength=size)
        held = np.flatnonzero(count)
        return held, (np.cumsum(count) - count)[held]

    def dot(self, w: np.ndarray) -> np.ndarray:
        """Per row, the sum of its terms' weights."""
        out = self.dense @ w[self.top]
        if len(self.cols):
            out[self.by_row] += np.add.reduceat(w[self.cols], self.row_starts)
        return out

    def back(self, r: np.ndarray) -> np.ndarray:
        """Per term, the sum of its rows' values."""
        out = np.zeros(self.k)
        if len(self.rows):
            out[self.by_term] = np.add.reduceat(r[self.rows], self.term_starts)
        out[self.top] = r @ self.dense
        return out


def fit_logistic(rows: np.ndarray, cols: np.ndarray, n: int, k: int, extra: np.ndarray, y: np.ndarray,
                 sparsity: float = SPARSITY, steps: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic regression on binary terms (rows, cols) and dense columns ``extra``: Adam steps on the
    whole sample, each followed by soft thresholding of the term weights (an L1 penalty that falls
    with the root of the sample), so a term needs evidence beyond chance."""
    penalty, dense = sparsity / np.sqrt(max(n, 1)), 1 + extra.shape[1]
    w = np.zeros(dense + k)
    share = (y.sum() + 0.5) / (len(y) + 1)
    w[0] = np.log(share / (1 - share))
    m, v, held = np.zeros(len(w)), np.zeros(len(w)), Incidence(rows, cols, n, k)
    for step in range(1, steps + 1):
        z = w[0] + extra @ w[1:dense] + held.dot(w[dense:])
        r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / max(n, 1)
        grad = np.r_[r.sum(), extra.T @ r + 1e-3 * w[1:dense], held.back(r)]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        rate = 0.1 * (1 - step / (steps + 1)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
        w -= rate * m / (1 - 0.9 ** step)
        w[dense:] = np.sign(w[dense:]) * np.maximum(np.abs(w[dense:]) - rate[dense:] * penalty, 0)
    return w[0], w[1:dense], w[dense:]


def _best_cut(p: np.ndarray, y: np.ndarray, beta: float = 0.5) -> float:
    """The probability from which rejecting gives the best F-beta out of fold (the middle of the gap
    there). A beta below 1 weighs precision more: clean documents stay."""
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    score = (1 + beta ** 2) * hit / (np.arange(1, len(y) + 1) + beta ** 2 * y.sum())
    last = np.r_[p[order][1:] < p[order][:-1], True]
    best = int(np.argmax(np.where(last, score, -1)))
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float(p[order][best] + below) / 2


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id",
              text_col: str = "text", max_labelled: int = MAX_LABELLED, max_terms: int = MAX_TERMS,
              min_chi: float = MIN_CHI, folds: int = 3) -> Chain:
    """Fit the chain; ``categories`` maps each category, in chain order, to a SQL expression
    (0 or 1) over the labels' columns."""
    names = list(categories)
    picked = (labels.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), *(F.expr(e).cast("int").alias(f"y{i}") for i, e in enumerate(categories.values())))
        .dropna().groupBy("id").agg(*(F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))))
        .orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    ys = [f"y{i}" for i in range(len(names))]
    text = text_or_empty(docs[text_col])
    sample = (docs.select(docs[id_col].alias("id"), text.alias("text"))
              .join(F.broadcast(picked), "id")  # at most max_labelled narrow rows
              # of equal texts with different labels the largest label counts, as for equal ids
              .groupBy(F.xxhash64("text").alias("text_hash"))
              .agg(F.first("text").alias("text"), *(F.max(y).alias(y) for y in ys)))

    def make():
        return lambda c: ((h, *y, sorted(terms(t))) for h, t, *y in zip(c["text_hash"], c["text"], *(c[y] for y in ys),
                                                                       strict=True))

    sample = cut_lineage(map_rows(sample.select("text_hash", "text", *ys), make,
                                  "text_hash long, " + ", ".join(f"{y} int" for y in ys) + ", terms array<string>"))
    total = sample.agg(F.count(F.lit(1)).alias("n"), *(F.sum(y).alias(y) for y in ys)).first()
    n = total["n"]
    per = sample.select("terms", *ys).withColumn("term", F.explode("terms")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), *(F.sum(y).alias(y) for y in ys)).where("df >= 5")
    # the terms that tell most: largest chi-square over the categories
    chi = [F.pow(F.col(y) * n - F.col("df") * (total[y] or 0), 2) / (F.col("df") * (n - F.col("df") + 1)) for y in ys]
    chosen = (per.withColumn("chi", F.greatest(*chi, F.lit(0.0))).where(F.col("chi") >= min_chi).orderBy(F.desc("chi"), "term").limit(max_terms)
              .select("term"))
    vocabulary = [r["term"] for r in chosen.collect()]  # at most max_terms
    index = {t: i for i, t in enumerate(vocabulary)}

    def make_rows():
        return lambda c: ((h, *y, [index[t] for t in ts if t in index])
                          for h, ts, *y in zip(c["text_hash"], c["terms"], *(c[y] for y in ys), strict=True))

    data = (map_rows(sample, make_rows, "text_hash long, " + ", ".join(f"{y} int" for y in ys) + ", at array<int>")
            .orderBy("text_hash").toArrow())  # at most max_labelled rows of small numbers
    size = data.num_rows
    y = np.stack([data[c].to_numpy() for c in ys], axis=1).astype(float)
    rows = np.repeat(np.arange(size), pc.list_value_length(data["at"]).to_numpy().astype(int))
    cols = pc.list_flatten(data["at"]).to_numpy().astype(int)
    fold = np.arange(size) % folds
    odds, links, cut = np.empty((size, 0)), [], 2.0
    for i, name in enumerate(names):
        share = (y[:, i].sum() + 0.5) / (size + 1)
        if size < 2 * folds or not 0 < y[:, i].sum() < size:
            links.append(Link(name, float(np.log(share / (1 - share))), {}, [0.0] * i))
            odds, cut = np.c_[odds, np.zeros(size)], 2.0
            continue
        out = np.zeros(size)
        for f in range(folds):
            use = fold != f
            new = np.cumsum(use) - 1
            take = use[rows]
            b, e, w = fit_logistic(new[rows[take]], cols[take], int(use.sum()), len(vocabulary), odds[use], y[use, i])
            out += (fold == f) * (b + odds @ e + np.bincount(rows, w[cols], size))
        b, e, w = fit_logistic(rows, cols, size, len(vocabulary), odds, y[:, i])
        links.append(Link(name, float(b), {t: float(x) for t, x in zip(vocabulary, w, strict=True) if abs(x) > 1e-4},
                          e.tolist()))
        out = np.clip(out, -30, 30)
        odds = np.c_[odds, out]
        cut = _best_cut(1 / (1 + np.exp(-out)), y[:, i])
    return Chain(links, cut)


def with_probabilities(df: DataFrame, chain: Chain, out: str, text_col: str = "text") -> DataFrame:
    """``df`` with a struct column ``out`` of the categories' probabilities."""
    names = [link.category for link in chain.links]

    @F.arrow_udf("struct<" + ", ".join(f"`{c}`: double" for c in names) + ">")
    def score(texts: pa.Array) -> pa.Array:
        rows = (chain.probabilities(t.as_py() or "") for t in texts)  # one text at a time in memory
        return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in zip(*rows, strict=True)], names=names)

    return df.withColumn(out, score(df[text_col]))


def scores(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, p_<category> ..., rejected."""
    names = [link.category for link in chain.links]
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return with_probabilities(rows, chain, "p").select(
        "id", *(F.col("p")[c].alias(f"p_{c}") for c in names), (F.col("p")[names[-1]] >= chain.cut).alias("rejected"))


def drop_toxic(df: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``df`` without the rows that the chain's last category rejects."""
    p = tmp_name(df, "p")
    return with_probabilities(df, chain, p, text_col).where(
        F.col(p)[chain.links[-1].category] < chain.cut).drop(p)
