"""Toxicity by a linear-chain conditional random field.

``fit`` learns from at most ``SAMPLE`` labelled documents (those with the smallest hash of their
id; the bound keeps the labels broadcastable):

1. words and word beginnings are counted by label and fold, and each gets a cautious log-odds (its
   lower confidence bound); a word's level is that of its strongest part;
2. tokens of toxic documents at a high level are labelled toxic, all others not;
3. a two-state chain is trained on windows of labelled tokens by its exact gradient
   (forward-backward); observations are the levels of a word and its neighbours as the other folds
   know them, so the chain learns from words that its lexicon misses. All windows count, equal ones
   as one with a weight;
4. a logistic curve maps a document's marginals, by the other folds' lexicon as well, to the
   probability of its label: what it is fitted on are texts the lexicon has not seen.

``score`` runs forward-backward over whole texts, in batches of similar length, and gives the
score and the spans of words whose marginal passes one half.

Null and empty texts have no words and get the score of a text without toxic words. Without
labels of both kinds the score is the share of toxic labels (0 without any). Labels that are null
are not used; a document with several labels counts as toxic if one says so. Repeated rows are
scored each by itself. Other columns are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import PLAIN_WORD, arrow_map, logistic_weights, per_worker, strings, texts

SAMPLE = 20_000  # labelled documents to learn from
FOLDS = 5
WINDOW = 48  # words of a window
LEVELS = (0.7, 1.4, 2.1, 2.8)  # log-odds bounds between levels
LABELLED = 2  # tokens from this level on are labelled toxic in toxic documents
PARTS = (4, 5, 6)  # lengths of word beginnings
MIN_DOCS = 4
CAUTION = 1.64  # standard errors between a log-odds and its lower bound
THRESHOLD = 0.3
CACHE = 200_000
_words = re.compile(PLAIN_WORD)


@dataclass
class Model:
    levels: dict[str, int] = field(default_factory=dict)  # by word or beginning (with an asterisk)
    name: str = ""  # tells lexicons apart
    emission: np.ndarray = field(default_factory=lambda: np.zeros((3, len(LEVELS) + 1)))  # previous, own, next word's level
    transition: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: np.ndarray = field(default_factory=lambda: np.zeros(6))


def lowered(text: str) -> str:
    return text.encode().lower().decode()  # bytes know only A-Z


def parts(word: str) -> list[str]:
    return [word] + [word[:k] + "*" for k in PARTS if len(word) > k]


class Levels(dict):
    """Level by word, looked up once per worker while there is room."""

    def __init__(self, lexicon: dict[str, int]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        level = self.lexicon.get(word, 0)
        for k in PARTS:
            if len(word) > k:
                level = max(level, self.lexicon.get(word[:k] + "*", 0))
        self[word] = level
        return level

    def of(self, text: str) -> np.ndarray:
        words = _words.findall(lowered(text))
        return np.fromiter(map(self.__getitem__, words), np.int8, len(words))


def potentials(levels: np.ndarray, emission: np.ndarray) -> np.ndarray:
    """The toxic state's score against the other at each word; rows are texts."""
    before, after = np.zeros_like(levels), np.zeros_like(levels)
    before[:, 1:], after[:, :-1] = levels[:, :-1], levels[:, 1:]
    return emission[0][before] + emission[1][levels] + emission[2][after]


def forward_backward(u: np.ndarray, lengths: np.ndarray, transition: np.ndarray, weight: np.ndarray | None = None):
    """Marginals of the toxic state (0 beyond a text's end), expected transitions (of weighted rows) and the log partition."""
    rows, steps = u.shape
    inside = np.arange(steps)[None, :] < lengths[:, None]
    e = np.stack([np.ones_like(u), np.exp(np.clip(u, -30, 30))], 2)
    t = np.exp(transition)
    alpha, scale = np.zeros_like(e), np.ones((rows, steps))
    now = e[:, 0] if steps else None
    for k in range(steps):
        if k:
            now = (alpha[:, k - 1] @ t) * e[:, k]
        scale[:, k] = now.sum(1)
        alpha[:, k] = now / scale[:, k, None]
    beta = np.ones_like(e)
    expected = np.zeros((2, 2))
    for k in range(steps - 2, -1, -1):
        message = e[:, k + 1] * beta[:, k + 1]
        live = inside[:, k + 1]
        joint = alpha[:, k, :, None] * t * message[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        expected += (joint if weight is None else joint * weight[:, None, None])[live].sum(0)
        back = message @ t.T
        back /= back.sum(1, keepdims=True) / 2
        beta[:, k] = np.where(live[:, None], back, 1.0)
    m = alpha * beta
    marginal = np.where(inside, m[:, :, 1] / np.maximum(m.sum(2), 1e-300), 0.0)
    return marginal, expected, float(np.log(scale)[inside].sum())


def marginals(levels: np.ndarray, lengths: np.ndarray, emission: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Marginals of the toxic state, 0 beyond a text's end; rows are texts in ascending order of length.

    The forward and backward recursions on the odds of the two states, which need no scaling:
    they stay within the range of one word's potential and of one transition.
    """
    size, (rows, steps) = len(LEVELS) + 1, levels.shape
    by_code = np.exp(np.clip(emission[0][:, None, None] + emission[1][None, :, None] + emission[2][None, None, :], -30, 30)).ravel()
    own = np.zeros((steps + 2, rows), np.uint8)  # one word's row of all texts lies together
    own[1:-1] = levels.T
    odds = by_code[own[:-2] * np.uint8(size * size) + own[1:-1] * np.uint8(size) + own[2:]]
    t = np.exp(transition - transition[0, 0])
    first = np.searchsorted(lengths, np.arange(steps + 1), side="right")  # texts from here on reach a word
    forward, backward = odds.copy(), np.ones_like(odds)
    for k in range(1, steps):
        before = forward[k - 1, first[k] :]
        forward[k, first[k] :] *= (t[0, 1] + t[1, 1] * before) / (1 + t[1, 0] * before)
    for k in range(steps - 2, -1, -1):
        after = odds[k + 1, first[k + 1] :] * backward[k + 1, first[k + 1] :]
        backward[k, first[k + 1] :] = (t[1, 0] + t[1, 1] * after) / (1 + t[0, 1] * after)
    forward *= backward
    forward /= 1 + forward
    for k in range(steps):
        forward[k, : first[k]] = 0
    return forward.T


def train_chain(
    levels: np.ndarray, lengths: np.ndarray, labels: np.ndarray, steps: int = 60, ridge: float = 1.0, weight: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Emission and transition weights by ascent along the exact gradient of the likelihood; ``weight``
    says how often each window is there."""
    weight = np.ones(len(levels)) if weight is None else weight.astype(float)
    inside = np.arange(levels.shape[1])[None, :] < lengths[:, None]
    size = len(LEVELS) + 1
    before, after = np.zeros_like(levels), np.zeros_like(levels)
    before[:, 1:], after[:, :-1] = levels[:, :-1], levels[:, 1:]

    def sums(values):
        values = (values * weight[:, None])[inside]
        return np.stack([np.bincount(x[inside], values, minlength=size) for x in (before, levels, after)])

    y = labels * inside
    follows = inside[:, 1:]
    seen_pairs = np.array([[(((y[:, :-1] == a) & (y[:, 1:] == b) & follows).sum(1) * weight).sum() for b in (0, 1)] for a in (0, 1)])
    seen = sums(y.astype(float))
    weights = np.zeros(3 * size + 4)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    total = max(1.0, float((inside.sum(1) * weight).sum()))
    for step in range(1, steps + 1):
        emission, transition = weights[: 3 * size].reshape(3, size), weights[3 * size :].reshape(2, 2)
        marginal, expected, _ = forward_backward(potentials(levels, emission), lengths, transition, weight)
        gradient = np.concatenate(((seen - sums(marginal)).ravel(), (seen_pairs - expected).ravel())) - ridge * weights
        gradient /= total
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        weights = weights + 0.25 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return weights[: 3 * size].reshape(3, size), weights[3 * size :].reshape(2, 2)


def evidence(marginal: np.ndarray, levels: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What the curve sees of a document: expected toxic words, all and at the two highest levels, their share, the strongest."""
    total = marginal.sum(1)
    high, highest = (np.log1p((marginal * (levels >= k)).sum(1)) for k in (len(LEVELS) - 1, len(LEVELS)))
    strongest = (marginal * levels).max(1) / len(LEVELS)
    return np.stack([np.ones(len(total)), strongest, np.log1p(total), high, highest, total / np.sqrt(np.maximum(lengths, 1))], 1)


def train_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Logistic regression of the label on the evidence."""
    return logistic_weights(x, y, np.ones(len(y)), ridge)


def by_length(all_levels: list[np.ndarray], work, cells: int = 400_000) -> None:
    """Calls ``work(indices, padded levels, lengths)`` on groups of texts of similar length, shorter ones first."""
    order = sorted(range(len(all_levels)), key=lambda i: len(all_levels[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at + 1) * len(all_levels[order[end]]) <= cells:
            end += 1
        group = order[at:end]
        lengths = np.array([len(all_levels[i]) for i in group])
        padded = np.zeros((len(group), max(1, int(lengths.max()))), np.int8)
        for k, i in enumerate(group):
            padded[k, : lengths[k]] = all_levels[i]
        work(group, padded, lengths)
        at = end


def _labelled(docs: DataFrame, labels: DataFrame, allowed, sample: int, label_col: str) -> tuple[DataFrame, int, int]:
    """The sampled documents with their labels, and how many of either kind."""
    marked = labels.select(labels["doc_id"].alias("doc_id"), labels[label_col].cast("int").alias("y"))
    marked = marked.filter(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & allowed(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("y").alias("y"))
    # The bound of the sample: also what makes the broadcast safe.
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    bad = sum(r["y"] == 1 for r in chosen)
    side = docs.sparkSession.createDataFrame([(r["doc_id"], r["y"]) for r in chosen], marked.schema)
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    return docs.join(F.broadcast(side), "doc_id").select("text", "y", fold), len(chosen) - bad, bad


def fit(docs: DataFrame, labels: DataFrame, allowed=lambda doc_id: F.lit(True), sample: int = SAMPLE,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from the labelled documents whose id passes ``allowed``."""
    rows, good, bad = _labelled(texts(docs, id_col, text_col), labels, allowed, sample, label_col)
    if not good or not bad:
        return Model(curve=np.array([np.log((bad + 1e-6) / (good + 1e-6)) if good + bad else -30.0, 0, 0, 0, 0, 0]))
    labelled = {(r["fold"], r["y"]): r["n"] for r in rows.groupBy("fold", "y").agg(F.count("*").alias("n")).collect()}

    def counted(batch):
        seen = [[Counter(), Counter()] for _ in range(FOLDS)]
        for text, y, fold in zip(strings(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            seen[fold][y].update({p for w in set(_words.findall(lowered(text))) for p in parts(w)})
        names = [list(clean.keys() | toxic.keys()) for clean, toxic in seen]
        yield {
            "part": [p for own in names for p in own], "fold": [f for f, own in enumerate(names) for _ in own],
            **{name: [seen[f][y][p] for f, own in enumerate(names) for p in own] for y, name in enumerate(("clean", "toxic"))},
        }

    counts = arrow_map(rows, counted, "part string, fold int, clean long, toxic long").groupBy("part").agg(
        F.sum("clean").alias("c"), F.sum("toxic").alias("t"),
        *[F.coalesce(F.sum(F.when(F.col("fold") == f, F.col(name))), F.lit(0)).alias(f"{name}{f}") for f in range(FOLDS) for name in ("clean", "toxic")],
    )

    def cautious(t, c, n_toxic, n_clean):
        odds = F.log((t + 0.5) / (n_toxic + 1)) - F.log((c + 0.5) / (n_clean + 1)) - CAUTION * F.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
        return F.when((t >= MIN_DOCS) & (odds > LEVELS[0]), odds)

    without = [
        cautious(F.col("t") - F.col(f"toxic{f}"), F.col("c") - F.col(f"clean{f}"), bad - labelled.get((f, 1), 0), good - labelled.get((f, 0), 0))
        for f in range(FOLDS)
    ]
    odds = [cautious(F.col("t"), F.col("c"), bad, good), *without]
    names = [f"o{k}" for k in range(FOLDS + 1)]
    strong = counts.select("part", *[o.alias(name) for o, name in zip(odds, names)]).filter(F.coalesce(*names).isNotNull())
    lexicons: list[dict[str, int]] = [{} for _ in odds]  # of all folds, and of all but each
    for r in strong.collect():  # parts of several toxic documents of the sample
        for own, name in zip(lexicons, names):
            if r[name] is not None:
                own[r["part"]] = int(np.searchsorted(LEVELS, r[name]))
    model = Model(levels=lexicons[0], name=hashlib.sha256(repr(sorted(lexicons[0].items())).encode()).hexdigest())

    def windows(batch):
        levels, out = [Levels(own) for own in lexicons], Counter()
        for text, y, fold in zip(strings(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            x, label = levels[fold + 1].of(text), (levels[0].of(text) >= LABELLED) & (y == 1)
            for at in range(0, len(x), WINDOW):
                out[x[at : at + WINDOW].tobytes(), label[at : at + WINDOW].astype(np.int8).tobytes()] += 1
        yield {"x": [a for a, _ in out], "y": [b for _, b in out], "n": list(out.values())}

    # Equal windows, most of them without any sign, meet before they travel; the order makes sums repeatable.
    picked = sorted(arrow_map(rows, windows, "x binary, y binary, n long").groupBy("x", "y").agg(F.sum("n").alias("n")).collect())
    if picked:
        lengths = np.array([len(r["x"]) for r in picked])
        x, y = (np.zeros((len(picked), WINDOW), np.int64) for _ in range(2))
        for k, r in enumerate(picked):
            x[k, : lengths[k]], y[k, : lengths[k]] = np.frombuffer(r["x"], np.int8), np.frombuffer(r["y"], np.int8)
        model.emission, model.transition = train_chain(x, lengths, y, weight=np.array([r["n"] for r in picked]))

    def seen(batch):
        texts_, folds = list(strings(batch.column(0))), batch.column(2).to_numpy(zero_copy_only=False)
        x = np.zeros((len(texts_), 6))
        for f in np.unique(folds):
            own = np.flatnonzero(folds == f)
            x[own], _ = _documents(model, Levels(lexicons[f + 1]), [texts_[i] for i in own], False)
        yield {"x": list(x), "y": batch.column(1)}

    points = arrow_map(rows, seen, "x array<double>, y int").collect()  # at most ``sample`` rows
    if points:
        model.curve = train_curve(np.array([r["x"] for r in points]), np.array([r["y"] for r in points], float))
    return model


def _levels(model: Model) -> Levels:
    """A worker's lookups for this model; a text's levels are the same whoever looks them up."""
    return per_worker(("toxicity", model.name), lambda: Levels(model.levels))


def _documents(model: Model, levels: Levels, batch: list[str], spans: bool):
    """Evidence of each text and, if wanted, its offending spans as (start, end) in code points."""
    x, found = np.zeros((len(batch), 6)), [[] for _ in batch]

    def work(group, padded, lengths):
        marginal = marginals(padded, lengths, model.emission, model.transition)
        x[group] = evidence(marginal, padded, lengths)
        if spans:
            for k, i in enumerate(group):
                if (hit := marginal[k] >= 0.5).any():
                    at = [m.span() for m in _words.finditer(lowered(batch[i]))]
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                    found[i] = [{"start": at[s][0], "end": at[e - 1][1]} for s, e in zip(edges[::2], edges[1::2])]

    by_length([levels.of(t) for t in batch], work)
    return x, found


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted, spans) for every row: one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the lexicon
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batch):
        own, levels = shared.value, _levels(shared.value)
        values = list(strings(batch.column(1)))
        for at in range(0, len(values), 2000):
            x, spans = _documents(own, levels, values[at : at + 2000], True)
            p = 1 / (1 + np.exp(-np.clip(x @ own.curve, -30, 30)))
            yield {"doc_id": batch.column(0)[at : at + 2000], "score": p, "predicted": (p >= THRESHOLD).astype(np.int32), "spans": spans}

    return arrow_map(rows, work, f"doc_id {kind}, score double, predicted int, spans array<struct<start: int, end: int>>")


def probability(docs: DataFrame, model: Model):
    """A column function: the score of a text, null or not."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(column: pd.Series) -> pd.Series:
        own, levels, out = shared.value, _levels(shared.value), []
        values = [t or "" for t in column]
        for at in range(0, len(values), 2000):
            x, _ = _documents(own, levels, values[at : at + 2000], False)
            out.append(1 / (1 + np.exp(-np.clip(x @ own.curve, -30, 30))))
        return pd.Series(np.concatenate(out) if out else [])

    return scored
