"""Toxicity by weak supervision: many voters, a label model, a linear classifier."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import class_weights, fit_logistic, free_name, labelled_sample

_WORDS = re.compile(r"\w+")

#: General insults, by kind; each kind is a voter.
LEXICONS = {
    "wits": "idiot idiots idiotic moron morons stupid dumb imbecile fool fools dimwit dunce",
    "worth": "worthless useless pathetic loser losers failure nobody",
    "dirt": "trash garbage scum filth filthy vermin",
    "scorn": "disgusting disgrace clown clowns joke ridiculous shameful",
    "harm": "kill killed killing hateful despise despicable",
}

#: Patterns over the lower-case text; each is a voter.
PATTERNS = {
    "address": r"\b(?:you|ye|u)\s+(?:are|re|r)\s+(?:an?\s+|such\s+an?\s+|so\s+)?(?:idiot|moron|loser|clown|stupid|pathetic|worthless|scum|trash)",
    "order": r"\b(?:shut\s+up|get\s+lost|go\s+away|drop\s+dead)\b",
    "mangled": r"\b(?:[i1!]d[i1!]ot|m[o0]r[o0]n|l[o0]ser|stup[i1!]d|tr[a@]sh|cl[o0]wn)s?\b",
}

_SHORTEST, _LONGEST = 3, 8


def stems(word: str) -> list[str]:
    """A word's beginnings of 3 to 8 letters, and the whole word with an end mark."""
    return [word[:k] for k in range(_SHORTEST, min(len(word), _LONGEST) + 1)] + [word + "$"]


def _code(stem: str) -> int:
    """A stem's 64-bit code: bags of codes are a tenth of the size of bags of strings."""
    return xxhash.xxh64_intdigest(stem.encode("utf-8"))


def _bag(words: set[str]) -> np.ndarray:
    """Sorted distinct codes of all stems of some words."""
    return np.unique(np.array([_code(s) for w in words for s in stems(w)], dtype=np.uint64))


def _counts(bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes, and in how many bags each lies."""
    return np.unique(np.concatenate(bags) if bags else np.zeros(0, np.uint64), return_counts=True)


def _lookup(codes: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The counts of some codes, 0 where the table lacks them."""
    if not len(table[0]):
        return np.zeros(len(codes))
    at = np.minimum(np.searchsorted(table[0], codes), len(table[0]) - 1)
    return np.where(table[0][at] == codes, table[1][at], 0).astype(float)


@dataclass(frozen=True)
class ToxicityModel:
    """Feature numbers of stems (by their codes), the classifier's weights, its calibration,
    and how often each voter says toxic of toxic and of clean texts."""

    stem_ids: dict[int, int]
    weights: np.ndarray
    calibration: tuple[float, float]
    accuracies: dict[str, tuple[float, float]]


def _gain(a: np.ndarray, b: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Signed log-likelihood ratio of having a stem against the class: a of n1, b of n0."""
    def part(k: np.ndarray, n: float, p: np.ndarray) -> np.ndarray:
        q = np.clip(k / n, 1e-12, 1 - 1e-12)
        p = np.clip(p, 1e-12, 1 - 1e-12)
        return k * np.log(q / p) + (n - k) * np.log((1 - q) / (1 - p))

    pooled = (a + b) / (n1 + n0)
    found = 2 * (part(a, n1, pooled) + part(b, n0, pooled))
    return np.where(a / n1 >= b / n0, found, -found)


def _learned_lexicon(
    bags: list[np.ndarray], y: np.ndarray, most: int, least_gain: float = 32.0, least_lift: float = 20.0
) -> list[int]:
    """Codes of stems that mark class 1, best first, none for the same texts as one before."""
    n1, n0 = max(y.sum(), 1), max((1 - y).sum(), 1)
    codes, a = _counts([b for b, label in zip(bags, y, strict=True) if label])
    codes, a = codes[a >= 3], a[a >= 3].astype(float)
    b = _lookup(codes, _counts([b for b, label in zip(bags, y, strict=True) if not label]))
    gains = _gain(a, b, n1, n0)
    lift = ((a + 0.5) / n1) / ((b + 0.5) / n0)
    fit = (gains >= least_gain) & (lift >= least_lift)
    ranked = np.lexsort((codes, -gains))
    order = codes[ranked][fit[ranked]][: 40 * most]
    carriers: dict[int, set[int]] = {c: set() for c in order.tolist()}
    for i in np.flatnonzero(y).tolist():
        for c in np.intersect1d(bags[i], order, assume_unique=True).tolist():
            carriers[c].add(i)
    chosen: list[int] = []
    for c in order.tolist():
        if not any(len(carriers[c] & carriers[k]) > 0.9 * len(carriers[c]) for k in chosen):
            chosen.append(c)
        if len(chosen) == most:
            break
    return chosen


def label_model(
    votes: np.ndarray, prior: float, known: np.ndarray, rounds: int = 3, steps: int = 30
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1 for each row of votes (1 toxic, 0 none, -1 clean).

    A generative model: given the class, each voter says toxic, nothing or clean with
    probabilities that EM estimates; saying nothing is no evidence. ``known`` has the class of
    a development part and NaN elsewhere: those rows anchor the estimates, or else the larger
    class could swallow the smaller. Voters that agree beyond what the class explains are
    correlated; each round measures those correlations in the residuals, and gives voters
    that move together the say of fewer. Returns the model's posteriors (for all rows from
    votes alone), both classes' vote probabilities, and the voters' weights.
    """
    n, m = votes.shape
    say = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    anchored = ~np.isnan(known)
    weight = np.ones(m)
    post = np.where((votes == 1).any(axis=1), 0.9, 0.1)
    share = prior
    table = np.full((2, m, 3), 1 / 3)
    for _ in range(rounds):
        for _ in range(steps):
            belief = np.where(anchored, np.nan_to_num(known), post)
            for c, p in ((0, 1 - belief), (1, belief)):
                table[c] = (np.einsum("n,nmk->mk", p, say) + 0.3) / (p.sum() + 0.9)
            ratio = np.log(table[1] / table[0])
            ratio[:, 1] = 0.0
            z = np.log(share / (1 - share)) + np.einsum("nmk,mk,m->n", say, ratio, weight)
            post = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        belief = np.where(anchored, np.nan_to_num(known), post)
        word = say[:, :, 2] - say[:, :, 0]
        mean = table[:, :, 2] - table[:, :, 0]
        rest = word - (belief[:, None] * mean[1] + (1 - belief)[:, None] * mean[0])
        spread = np.sqrt((rest**2).mean(0)) + 1e-9
        tied = np.abs(rest.T @ rest / max(n, 1) / spread[:, None] / spread)
        np.fill_diagonal(tied, 0)
        weight = 1 / (1 + np.where(tied > 0.2, tied, 0).sum(1))
    return post, table, weight


def _soft_logistic(rows: list[np.ndarray], width: int, y: np.ndarray, w: np.ndarray, steps: int = 300) -> np.ndarray:
    """Logistic regression on sparse 0/1 features with soft labels; the last weight is the intercept."""
    at = np.concatenate([np.full(len(r), i) for i, r in enumerate(rows)]) if rows else np.zeros(0, int)
    col = np.concatenate(rows) if rows else np.zeros(0, int)
    beta, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    n = max(len(rows), 1)
    for t in range(1, steps + 1):
        z = np.bincount(at, beta[col], minlength=len(rows)) + beta[-1]
        r = w * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        g = np.append(np.bincount(col, r[at], minlength=width), r.sum()) + 2e-4 * np.append(beta[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        beta = beta - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return beta


def _vote(bag: set[int], plain: str, lexicons: list[list[int]], patterns: list[re.Pattern]) -> list[int]:
    """Lexicon and pattern voters say toxic or nothing; the last says clean if all are silent."""
    hits = [int(not bag.isdisjoint(lex)) for lex in lexicons]
    hits += [int(bool(p.search(plain))) for p in patterns]
    return [*hits, 1 if any(hits) else -1]


#: Without labels: the share of toxic texts, and how often a lexicon speaks in a toxic and in
#: a clean text.
ASSUMED_SHARE, ASSUMED_RATES = 0.05, (0.6, 0.02)


def fixed_model() -> ToxicityModel:
    """A model from assumptions alone: each insult weighs what its voter's odds are.

    A text without one scores ``ASSUMED_SHARE``, one insult gives about 0.6.
    """
    codes = dict.fromkeys(_code(w + "$") for listed in LEXICONS.values() for w in listed.split())
    toxic, clean = ASSUMED_RATES
    weights = np.full(len(codes) + 1, np.log(toxic / clean))
    weights[-1] = np.log(ASSUMED_SHARE / (1 - ASSUMED_SHARE))
    return ToxicityModel({c: i for i, c in enumerate(codes)}, weights, (1.0, 0.0), dict.fromkeys(LEXICONS, ASSUMED_RATES))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    rows_per_class: int = 2_000,
    max_chars: int = 60_000,
    learned_voters: int = 48,
    features: int = 1_500,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> ToxicityModel:
    """Fit on at most ``rows_per_class`` labelled texts of each class.

    Voters are fixed lexicons and patterns, stems found in the training labels (each one
    lexicon of its own), and one voter that speaks for the silence of the others. The label
    model turns their votes into posteriors, anchored by the labels of every second row; the
    classifier, over the stems that tell the posteriors apart best, is trained on the
    posteriors; training labels calibrate its margin. Without labels of both classes nothing
    can be estimated, and the fixed lexicons vote with assumed odds (``fixed_model``).
    """
    sample, counts = labelled_sample(docs, labels, label, train, rows_per_class, max_chars, key, text)
    if len({v for _, v in sample}) < 2:
        return fixed_model()
    plains = [t.lower() if t else "" for t, _ in sample]
    y = np.array([v for _, v in sample], dtype=float)
    bags = [_bag(set(_WORDS.findall(p))) for p in plains]
    lexicons = {name: [_code(w + "$") for w in listed.split()] for name, listed in LEXICONS.items()}
    for c in _learned_lexicon(bags, y, learned_voters):
        lexicons[f"stem {c:016x}"] = [c]
    patterns = {name: re.compile(p) for name, p in PATTERNS.items()}
    sets, regexes = list(lexicons.values()), list(patterns.values())
    listed = np.array(sorted({c for lex in sets for c in lex}), np.uint64)
    found = [set(np.intersect1d(b, listed, assume_unique=True).tolist()) for b in bags]
    votes = np.array([_vote(f, p, sets, regexes) for f, p in zip(found, plains, strict=True)], dtype=int)
    votes = votes.reshape(len(sample), len(sets) + len(regexes) + 1)
    w = class_weights(y, counts)
    # The sample holds classes in shares of its own; the posterior is for such a sample.
    shown = float(np.clip(y.mean(), 0.05, 0.95))
    known = np.where(np.arange(len(y)) % 2 == 0, y, np.nan)
    post, table, _ = label_model(votes, shown, known)

    every = _counts(bags)
    codes, n = every[0][every[1] >= 5], every[1][every[1] >= 5].astype(float)
    n1, n0 = max(float((post >= 0.5).sum()), 1.0), max(float((post < 0.5).sum()), 1.0)
    a = _lookup(codes, _counts([b for b, p in zip(bags, post, strict=True) if p >= 0.5]))
    gains = np.abs(_gain(a, n - a, n1, n0))
    ranked = np.lexsort((codes, -gains))
    best = codes[ranked][gains[ranked] > 12][:features].tolist()
    stem_ids = {c: i for i, c in enumerate(dict.fromkeys([*best, *(c for lex in lexicons.values() for c in lex)]))}
    chosen = np.array(sorted(stem_ids), np.uint64)
    rows = [
        np.array([stem_ids[c] for c in np.intersect1d(b, chosen, assume_unique=True).tolist()], dtype=int) for b in bags
    ]
    beta = _soft_logistic(rows, len(stem_ids), post, w)
    for j, name in enumerate(LEXICONS):
        for c in lexicons[name]:
            if not _lookup(np.array([c], np.uint64), every)[0]:
                # An insult that the sample lacks weighs as much as its kind's voter deserves.
                beta[stem_ids[c]] = 0.5 * float(np.log(table[1][j][2] / table[0][j][2]))
    z = np.array([beta[r].sum() + beta[-1] for r in rows])
    slope, base = fit_logistic((z / 4)[:, None], y, w)
    calibration = (max(slope, 0.0) / 4, base)
    accuracy = {name: (float(table[1][j][2]), float(table[0][j][2])) for j, name in enumerate([*lexicons, *patterns])}
    return ToxicityModel(stem_ids, beta, calibration, accuracy)


class _Scorer:
    """The model with the feature numbers of words that a worker has met."""

    def __init__(self, model: ToxicityModel):
        self.model, self.known = model, {}

    def score(self, text: str | None) -> float:
        if len(self.known) > 500_000:
            self.known = {}
        known, ids = self.known, self.model.stem_ids
        found: set[int] = set()
        for w in set(_WORDS.findall((text or "").lower())):
            hit = known.get(w)
            if hit is None:
                hit = known[w] = tuple(ids[c] for c in map(_code, stems(w)) if c in ids)
            if hit:
                found.update(hit)
        z = self.model.weights[sorted(found)].sum() + self.model.weights[-1]
        slope, base = self.model.calibration
        return float(1 / (1 + np.exp(-np.clip(slope * z + base, -30, 30))))


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """The score of a whole text as a column: Arrow batches of the text alone go to Python."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _Scorer(model)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype=float)

    return score(text)


def score_toxicity(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and score (0 to 1, higher: likelier toxic) of every row, from its whole text.

    Null and empty texts have the score of a text without any feature. Texts of any length
    are read whole. Rows repeat as they are, an empty table stays empty; other columns are
    left out. Nothing is shuffled.
    """
    return docs.select(docs[key], toxicity_score(model, docs[text]).alias("score"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``; all columns stay."""
    score = free_name(docs, "score")
    kept = docs.withColumn(score, toxicity_score(model, docs[text])).where(F.col(score) < threshold)
    return kept.select(*[kept[c] for c in docs.columns])
