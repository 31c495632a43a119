"""Personal data by weak supervision.

Base kinds are patterns with a check: e-mail, IP, card and phone numbers; what passes is always
reported. Further kinds (keys, account numbers, id numbers, names) start from loose candidate
patterns. On each candidate, labelers vote yes, no or abstain: strict formats and checksums
(regex), lists of names and key prefixes (gazetteer), and cue words in front (context).
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler
is; a logistic classifier on the candidate's shape and surroundings is then trained on the
resulting probabilities and decides about every candidate. ``fit`` counts over all documents; what
reaches the driver is bounded by the number of vote and feature patterns.

Null texts count as empty and have no spans. Repeated rows are searched each by itself, an empty
table fits a model that accepts no candidate. A candidate that overlaps a base span, or one
before it in the order of kinds, is dropped. Only the id and text columns are read by ``find``;
``redact`` keeps all columns.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import arrow_map, logistic_weights, strings, texts

# --- base kinds ---------------------------------------------------------------------------------

BASE = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match begins where a run of digits does: earlier digits of the run would have matched too.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost spans of each base kind that pass its check, by kind, then start."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# --- candidates and labelers --------------------------------------------------------------------

# Given names, titles and cue words of the gazetteer and context labelers.
GIVEN = frozenset(
    "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas Sarah "
    "Charles Karen Daniel Nancy Matthew Lisa Anthony Betty Mark Sandra Paul Ashley Steven Emily Andrew Donna Peter Anna Maria Laura "
    "Hans Klaus Jürgen Wolfgang Ursula Monika Petra Sabine Pierre Jean Marie Michel Nathalie Isabelle Carlos José Juan Carmen Ana Luis".split()
)
TITLES = ("mr", "mrs", "ms", "dr", "prof", "herr", "frau", "monsieur", "madame", "señor", "señora")
CUES = {
    "key": ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key", "key", "bearer", "credential"),
    "account": ("iban", "account", "konto", "compte", "cuenta", "bank"),
    "id_number": ("ssn", "social", "security", "passport", "tax", "id"),
    "name": ("name", "signed", "dear", "regards", "contact", "sincerely", "author") + TITLES,
}
AGAINST = {
    "key": ("sha", "sha1", "sha256", "md5", "commit", "checksum", "hash", "digest", "revision"),
    "account": ("isbn", "version"),
    "id_number": ("isbn", "version", "page", "pp", "doi"),
    "name": ("the", "of", "in", "and", "street", "city", "university"),
}
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_", "pk_", "xoxb-", "xoxp-", "AIza", "eyJ")
KINDS = tuple(CUES)
_LOOSE = {
    "key": re.compile(r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*[0-9])[A-Za-z0-9_+/-]{20,}+"),
    "account": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "id_number": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "name": re.compile(r"\b[A-ZÄÖÜÉÁ][a-zäöüßéèáíóñ]{1,20} [A-ZÄÖÜÉÁ][a-zäöüßéèáíóñ]{1,20}\b"),
}
_BEFORE = re.compile(r"[^\W\d]+(?:[_-][^\W\d]+)*")


def entropy(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def _iban(text: str) -> bool:
    compact = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _strict(kind: str, text: str) -> int:
    """The regex labeler: a strict format or checksum."""
    if kind == "key":
        mixed = any(c.isdigit() for c in text) and any(c.isalpha() for c in text)
        return 1 if mixed and entropy(text) >= 3.0 and "/" not in text else -1
    if kind == "account":
        return 1 if _iban(text) else -1
    if kind == "id_number":
        area, group, serial = text.split("-")
        return 1 if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000" else -1
    return 1 if all(len(w) >= 3 for w in text.split()) else -1


def _listed(kind: str, text: str) -> int:
    """The gazetteer labeler."""
    if kind == "key":
        return 1 if text.startswith(PREFIXES) else 0
    if kind == "name":
        return 1 if text.split()[0] in GIVEN else -1
    return 0


def _cued(kind: str, words: list[str]) -> int:
    """The context labeler: cue words shortly before."""
    if any(w in AGAINST[kind] for w in words):
        return -1
    return 1 if any(w in CUES[kind] for w in words) else (-1 if kind == "name" else 0)


LABELERS = 3


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    votes: tuple[int, ...]
    features: int  # bits


def _features(kind: str, text: str, s: int, e: int, words: list[str]) -> int:
    span, left, right = text[s:e], text[max(0, s - 3) : s], text[e : e + 1]
    digits = len(_digits(span)) / len(span)
    bits = (
        digits >= 0.25, digits >= 0.6, any(c.isupper() for c in span), any(c.islower() for c in span), len(span) >= 28, len(span) >= 36,
        bool(left) and left[-1] in "\"'`" and right in "\"'`", any(c in "=:" for c in left), bool(words) and words[-1] in CUES[kind],
        any(w in AGAINST[kind] for w in words), kind == "name" and span.split()[0] in GIVEN, s == 0 or text[s - 1] in "\n.!?" or left.endswith(". "),
    )
    return sum(1 << k for k, b in enumerate(bits) if b)


FEATURES = 12


def candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[Candidate]:
    """Candidates of the further kinds with votes and features."""
    taken = [(s, e) for _, s, e in base]
    digit = bool(_DIGIT.search(text))
    for kind in KINDS:
        if kind != "name" and not digit:
            continue
        # Matches of one kind don't overlap each other, so only what earlier kinds took counts.
        taken.sort()
        starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
        for m in _LOOSE[kind].finditer(text):
            s, e = m.span()
            before = bisect_left(starts, e)
            if before and reach[before - 1] > s:
                continue
            words = [w.lower() for w in _BEFORE.findall(text[max(0, s - 32) : s])[-3:]]
            if kind != "name":
                taken.append((s, e))
            yield Candidate(kind, s, e, (_strict(kind, m[0]), _listed(kind, m[0]), _cued(kind, words)), _features(kind, text, s, e, words))


# --- aggregation of votes, classifier -----------------------------------------------------------


def reliabilities(patterns: dict[tuple[int, ...], float], steps: int = 60) -> tuple[float, np.ndarray, np.ndarray, dict[tuple[int, ...], float]]:
    """Expectation-maximisation over vote patterns and their counts.

    Gives the prior, each labeler's chance of yes when it votes on a true and on a false span,
    and the probability of a true span by pattern. Pseudo-counts keep labelers better than chance
    where data are scarce.
    """
    votes, n = np.array(list(patterns)), np.array(list(patterns.values()), float)
    yes, no = votes == 1, votes == -1
    prior, true, false = 0.3, np.full(votes.shape[1], 0.8), np.full(votes.shape[1], 0.2)
    for _ in range(steps):
        odds = math.log(prior / (1 - prior)) + yes @ np.log(true / false) + no @ np.log((1 - true) / (1 - false))
        p = 1 / (1 + np.exp(-odds))
        prior = (n @ p + 3) / (n.sum() + 10)
        true = ((n * p) @ yes + 8) / ((n * p) @ (yes | no) + 10)
        false = ((n * (1 - p)) @ yes + 2) / ((n * (1 - p)) @ (yes | no) + 10)
        false = np.minimum(false, true - 1e-3)
    return prior, true, false, {k: float(v) for k, v in zip(patterns, p)}


def logistic(x: np.ndarray, p: np.ndarray, n: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on soft labels with counts, scaled to keep the ridge's weight at any size."""
    return logistic_weights(x, p, n * min(1.0, 10_000 / max(n.sum(), 1.0)), ridge)


def _row(features: int) -> list[float]:
    return [1.0] + [float(features >> k & 1) for k in range(FEATURES)]


@dataclass
class Model:
    labelers: dict[str, tuple] = field(default_factory=dict)  # kind -> prior, true and false rates
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def probability(self, c: Candidate) -> float:
        w = self.weights.get(c.kind)
        return 0.0 if w is None else float(1 / (1 + np.exp(-np.clip(np.dot(w, _row(c.features)), -30, 30))))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Estimate labelers and train the classifier on the candidates of all documents."""

    def work(batch):
        seen = Counter()
        for text in strings(batch.column(1)):
            for c in candidates(text, base_spans(text)):
                seen[c.kind, *c.votes, c.features] += 1
        columns = list(map(list, zip(*((*k, n) for k, n in seen.items())))) or [[]] * (LABELERS + 3)
        yield dict(zip(("kind", "v0", "v1", "v2", "features", "n"), columns))

    schema = "kind string, v0 int, v1 int, v2 int, features int, n long"
    counted = arrow_map(texts(docs, id_col, text_col), work, schema).groupBy("kind", "v0", "v1", "v2", "features").agg(F.sum("n").alias("n"))
    by_kind = defaultdict(list)
    for r in counted.collect():  # bounded: kinds x 3^labelers x 2^features
        by_kind[r["kind"]].append(((r["v0"], r["v1"], r["v2"]), r["features"], r["n"]))
    model = Model()
    for kind, rows in sorted(by_kind.items()):
        rows.sort()
        patterns = Counter()
        for votes, _, n in rows:
            patterns[votes] += n
        prior, true, false, posterior = reliabilities(patterns)
        model.labelers[kind] = (prior, true, false)
        x = np.array([_row(f) for _, f, _ in rows])
        model.weights[kind] = logistic(x, np.array([posterior[v] for v, _, _ in rows]), np.array([n for *_, n in rows], float))
    return model


def spans_of(text: str, model: Model) -> list[tuple[str, int, int]]:
    """Base spans, then the accepted ones, by kind and start."""
    base = base_spans(text)
    more = sorted((KINDS.index(c.kind), c.start, c.end) for c in candidates(text, base) if model.probability(c) >= 0.5)
    return base + [(KINDS[k], s, e) for k, s, e in more]


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): spans are (kind, start, end, base) in code points; one pass, no shuffle."""
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batch):
        found = []
        for text in strings(batch.column(1)):
            found.append([{"kind": k, "start": s, "end": e, "base": k in BASE} for k, s, e in spans_of(text, model)])
        yield {"doc_id": batch.column(0), "spans": found}

    return arrow_map(rows, work, f"doc_id {kind}, spans array<struct<kind: string, start: int, end: int, base: boolean>>")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span, or group of overlapping spans, gives way to its first kind in brackets."""
    out, at = [], 0
    for s, e, k in sorted((s, e, k) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(model: Model) -> Callable[[Column], Column]:
    """A column function: the text with all spans replaced; null stays null."""

    @F.pandas_udf("string")
    def replaced(column: pd.Series) -> pd.Series:
        return column.map(lambda t: t if t is None else redacted(t, spans_of(t, model)))

    return replaced
