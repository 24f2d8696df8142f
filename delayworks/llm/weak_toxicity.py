"""Toxicity by weak supervision.

Voters are patterns: insults of a fixed lexicon, words and word beginnings found in labelled rows,
and ways in which hits pile up. Each votes for "toxic" or abstains. A generative label model
estimates, without labels, how often each voter votes in either class, and how far voters are
correlated beyond the class, so that voters that say the same don't count twice. Its posteriors are
the labels on which a linear classifier is trained; that classifier scores the texts.
"""

import re
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.llm.subword_classifier import labelled_sample
from delayworks.llm.tables import ship

SAMPLE = 6_000
VOTERS = 64
PREFIXES = (4, 5, 6, 7)
NEAR = 12
LEAST_PRECISION = 0.5
COVER = 4
CHANCE = 0.2
_TOKEN = re.compile(r"\w+")

# Common insults in English, German, French and Spanish.
LEXICON = (
    "idiot idiots moron morons stupid loser losers trash scum clown clowns pathetic worthless disgusting imbecile "
    "vermin filthy scumbag degenerate subhuman "
    "dummkopf arschloch abschaum versager widerlich idioten trottel "
    "imbécile connard ordure minable abruti racaille "
    "imbécil estúpido basura escoria patético asqueroso idiota"
).split()


@dataclass(frozen=True)
class Pattern:
    """A whole word, or the beginning of words."""

    text: str
    whole: bool


class Hits:
    """Finds the patterns of a text, in one pass over its words."""

    def __init__(self, patterns: Sequence[Pattern]):
        self.patterns = tuple(patterns)
        self.words = {p.text: i for i, p in enumerate(patterns) if p.whole}
        self.starts = {p.text: i for i, p in enumerate(patterns) if not p.whole}
        self.sizes = sorted({len(t) for t in self.starts})
        self.heads = {t[:3] for t in (*self.words, *self.starts)}

    def of(self, word: str) -> list[int]:
        found = [self.words[word]] if word in self.words else []
        return found + [self.starts[word[:n]] for n in self.sizes if len(word) >= n and word[:n] in self.starts]

    def measures(self, text: str) -> np.ndarray:
        """Counts of each pattern, then: words hit, different words hit, most hits nearby, hits in 100 words."""
        words = _TOKEN.findall(text.lower())
        counts = np.zeros(len(self.patterns) + 4)
        heads = self.heads
        at, hit = [], set()
        for i in [i for i, w in enumerate(words) if w[:3] in heads]:
            if found := self.of(words[i]):
                counts[found] += 1
                at.append(i)
                hit.add(words[i])
        if at:
            place = np.array(at)
            near = np.searchsorted(place, place + NEAR, "right") - np.arange(len(place))
            counts[-4:] = len(at), len(hit), near.max(), 100 * len(at) / len(words)
        return counts


def mine(texts: Sequence[str], labels: Sequence[int], voters: int = VOTERS) -> list[Pattern]:
    """Words and beginnings whose presence tells label 1, each chosen for rows that few others cover yet.

    A pattern qualifies if the lower bound (95%) of its precision, after the classes are given equal
    weight, is at least ``LEAST_PRECISION``, and its precision in the rows as they are too.
    """
    y = np.asarray(labels, bool)
    rows: list[set[Pattern]] = []
    inside, outside = Counter(), Counter()
    for text, label in zip(texts, labels):
        words = set(_TOKEN.findall(text.lower()))
        found = {Pattern(w, True) for w in words if len(w) > 2}
        found |= {Pattern(w[:n], False) for w in words for n in PREFIXES if len(w) > n}
        (inside if label else outside).update(found)
        if label:
            rows.append(found)
    if not rows or y.all():
        return []
    able = []
    for pattern, n in inside.items():
        total = n + outside[pattern]
        p = n / total
        low = (p + 1.35 / total - 1.645 * np.sqrt(p * (1 - p) / total + 0.676 / total**2)) / (1 + 2.706 / total)
        if n >= 4 and low >= LEAST_PRECISION:
            able.append((pattern, low))
    able.sort(key=lambda x: (-x[1] * inside[x[0]], -len(x[0].text), x[0].text, not x[0].whole))
    able = able[:4000]
    if not able:
        return []
    has = np.array([[p in row for p, _ in able] for row in rows])
    # of patterns found in the same rows, the longest says what is meant
    first = np.sort(np.unique(has, axis=1, return_index=True)[1])
    able, has = [able[i] for i in first], has[:, first]
    lows = np.array([low for _, low in able])
    need = np.full(len(rows), float(COVER))
    chosen: list[Pattern] = []
    while len(chosen) < voters:
        gain = (np.minimum(need, 1.0) @ has) * lows
        best = int(gain.argmax())
        if gain[best] < 2:
            break
        chosen.append(able[best][0])
        need = np.maximum(need - has[:, best], 0.0)
        lows[best] = 0
    return chosen


def votes(measures: np.ndarray) -> np.ndarray:
    """Of each pattern present, and of several hits: two words hit, two different ones, two nearby, one in 100 words."""
    return np.hstack([measures[:, :-4] > 0, measures[:, -4:] >= np.array([2, 2, 2, 1])]).astype(float)


def label_model(v: np.ndarray, rounds: int = 40) -> np.ndarray:
    """P(toxic) of each row of votes (0 or 1), by expectation maximisation.

    A voter's log likelihood is divided by one plus the sum of its positive correlations with the
    others within the classes; those up to ``CHANCE`` count as none. It begins from "toxic if any
    voter says so".
    """
    posterior = np.where(v.any(axis=1), 0.99, 0.01)
    weight = np.ones(v.shape[1])
    for _ in range(rounds):
        prior = np.clip(posterior.mean(), 1e-3, 0.999)
        rate = [(w @ v + 0.1) / (w.sum() + 1) for w in (1 - posterior, posterior)]
        rest = v - np.outer(1 - posterior, rate[0]) - np.outer(posterior, rate[1])
        spread = np.sqrt((rest**2).mean(axis=0)) + 1e-6
        correlation = (rest.T @ rest) / len(v) / np.outer(spread, spread)
        correlation[correlation < CHANCE] = 0
        np.fill_diagonal(correlation, 0)
        weight = 1 / (1 + correlation.sum(axis=1))
        logit = np.log(prior / (1 - prior)) + sum(
            side * (v @ (weight * np.log(p)) + (1 - v) @ (weight * np.log(1 - p))) for side, p in zip((-1, 1), rate)
        )
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return posterior


def _linear(measures: np.ndarray) -> np.ndarray:
    return np.hstack([measures > 0, np.log1p(measures)]).astype(float)


@dataclass(frozen=True)
class Model:
    hits: Hits
    weights: np.ndarray
    bias: float

    def scores(self, texts: Iterable[str]) -> np.ndarray:
        x = _linear(np.array([self.hits.measures(t) for t in texts]).reshape(-1, len(self.hits.patterns) + 4))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def train(texts: Sequence[str], labels: Sequence[int]) -> Model:
    """Labels serve to find patterns only; the fixed lexicon votes also without any. Equal texts count once."""
    unique = {text: label for text, label in zip(texts, labels)}
    texts, labels = list(unique), list(unique.values())
    found = mine(texts, labels)
    patterns = dict.fromkeys([*(Pattern(w, True) for w in LEXICON), *found])
    hits = Hits(list(patterns))
    measures = np.array([hits.measures(t) for t in texts]).reshape(-1, len(patterns) + 4)
    x = _linear(measures)
    target = label_model(votes(measures)) if len(texts) else np.zeros(0)
    # Newton steps of a logistic regression with a ridge; without rows, any hit makes a text toxic
    weights, bias = np.zeros(x.shape[1]), 0.0
    if not len(texts):
        weights[: len(patterns)] = 6.0
        return Model(hits, weights, -4.0)
    design = np.hstack([x, np.ones((len(x), 1))])
    beta = np.append(weights, bias)
    ridge = np.diag(np.append(np.full(x.shape[1], 0.5), 1e-3))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - target) + ridge @ beta
        step = np.linalg.solve((design.T * (p * (1 - p))) @ design + ridge, gradient)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return Model(hits, beta[:-1], float(beta[-1]))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = labelled_sample(documents, labels, "toxic", sample)
    return train(list(rows["text"]), list(rows["label"]))


def without_toxic(documents: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents that score below the threshold; all columns."""
    score = _score_udf(documents, model)
    return documents.where(score(F.coalesce(F.col(text_col).cast("string"), F.lit(""))) < threshold)


def _score_udf(documents: DataFrame, model: Model):
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts))

    return score
