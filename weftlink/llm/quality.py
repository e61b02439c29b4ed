"""Quality classifier: heuristic labellers vote, expectation-maximisation weighs them,
and the posterior labels train a hashed linear scorer."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free

#: Hash buckets of the scorer.
DIM = 1024
#: Most documents the scorer is fitted on: those with the least hashes of id and text.
FIT_ROWS = 4096
THRESHOLD = 0.5
JUNK, GOOD, ABSTAIN = 0, 1, 2

_LOWER = bytes(range(97, 123))
_UPPER = bytes(range(65, 91))
_SYMBOLS = bytes(b"#$%&*+<=>@[\\]^_`{|}~!")
_KEEP = bytes(range(128, 256))
#: Classes of bytes: letters of either case, digits and non-ASCII fall together.
_CLASS = bytes(1 if c in _LOWER else 2 if c in _UPPER else 3 if 48 <= c <= 57 else 4 if c in b" \t\n\r\x0b\x0c" else 5 if c > 127 else 6 if c < 32 else 7 + c % 25 for c in range(256))


def _group(chars: bytes) -> np.ndarray:
    return np.array([c in chars for c in range(256)], np.int64)


_GROUPS = np.stack([_group(_LOWER), _group(_UPPER), _group(_KEEP), _group(b" \t\n\r\x0b\x0c"), _group(_SYMBOLS), _group(b".,")])


def _runs(h: np.ndarray) -> np.ndarray:
    """How often each distinct value occurs."""
    s = np.sort(h)
    at = np.flatnonzero(s[1:] != s[:-1])
    return np.diff(np.concatenate([[-1], at, [len(s) - 1]]))


def statistics(text: str | None) -> np.ndarray:
    """Shares over the whole text: upper-case letters, symbols, distinct words,
    the commonest word, words equal to the one before, distinct lines, distinct
    word pairs, full stops and commas a word, and the logarithm of the words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    w = data.split()
    n = len(w)
    if not n:
        return np.array([0, 0, 0, 1, 0, 1, 0, 0, 0], float)
    low, up, wide, space, sym, marks = (_GROUPS @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)).tolist()
    letters = max(1, low + up + wide // 2)
    lines = [x for x in data.split(b"\n") if x.strip()]
    # word identities; only their equality matters
    h = np.fromiter(map(hash, w), np.int64, n)
    counts = _runs(h)
    again = np.count_nonzero(h[1:] == h[:-1]) / n
    pairs = len(_runs(h[1:] * 31 + h[:-1])) / (n - 1) if n > 1 else 1.0
    return np.array([up / letters, sym / max(1, len(data) - space), len(counts) / n, counts.max() / n, again, len(set(lines)) / max(1, len(lines)), pairs, marks / n, np.log(n)])


LABELLERS = ("shouting", "symbols", "repeated words", "stutter", "repeated passage", "no punctuation", "no words", "prose")
#: A labeller cries junk over a good document at most so often.
FALSE_ALARMS = 0.02


def votes(s: np.ndarray) -> list[int]:
    """One vote of each labeller: JUNK, GOOD or ABSTAIN. Seven know one kind of junk
    each and are silent otherwise; the last knows the look of prose."""
    up, sym, distinct, top, again, lines, pairs, marks, logn = s
    junk = lambda bad: JUNK if bad else ABSTAIN
    prose = distinct > 0 and up < 0.25 and sym < 0.03 and again < 0.1 and pairs > 0.6 and (top < 0.25 or logn < 2.1) and (marks > 0.02 or logn < 3)
    return [
        junk(up > 0.3),
        junk(sym > 0.06),
        junk(top > 0.25 and logn > 2),
        junk(again > 0.2 and logn > 2),
        junk(pairs < 0.6 and logn > 3),
        junk(marks < 0.02 and logn > 3),
        junk(distinct == 0),
        GOOD if prose else ABSTAIN,
    ]


def features(text: str | None, s: np.ndarray) -> np.ndarray:
    """Hashed features: the statistics in steps, and the shares of trigrams of byte
    classes over the whole text."""
    out = np.zeros(DIM, np.float32)
    c = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_CLASS), np.uint8).astype(np.uint32)
    if len(c) > 2:
        h = ((c[:-2] << 10) + (c[1:-1] << 5) + c[2:]) * np.uint32(2654435761)
        out += np.bincount(h >> np.uint32(22), minlength=DIM).astype(np.float32) / (len(c) - 2) * 4
    for k, v in enumerate(s):
        step = int(np.clip(v * (2 if k == 8 else 20), 0, 31))
        out[((k * 32 + step + 7919) * 2246822519 & 0xFFFFFFFF) >> 22] += 1
    return out


@dataclass(frozen=True)
class LabelModel:
    """prior: P(good); table[j, y, v]: P(labeller j says v | class y)."""

    prior: float
    table: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        j = np.arange(self.table.shape[0])
        log = np.log(self.table[j, :, :])
        score = sum(log[k][:, patterns[:, k]] for k in j)
        odds = score[GOOD] - score[JUNK] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """EM over vote patterns and how often they occur: labellers are taken to be
    independent given the class, each with its own rates of either error and of
    abstaining. They start as mostly right, which names the classes; that a
    labeller's false alarms stay rare is held throughout, as the kinds of junk are
    disjoint and one labeller's cry must not be outvoted by the others' silence."""
    m = len(LABELLERS)
    table = np.tile(np.array([[0.3, 0.1, 0.6], [0.01, 0.3, 0.69]]), (m, 1, 1))
    model = LabelModel(0.8, table)
    if not len(patterns):
        return model
    for _ in range(rounds):
        good = model.posterior(patterns)
        new = np.empty_like(table)
        for y, r in ((JUNK, (1 - good) * counts), (GOOD, good * counts)):
            for v in (JUNK, GOOD, ABSTAIN):
                new[:, y, v] = (r[:, None] * (patterns == v)).sum(0) + 0.5
        new /= new.sum(2, keepdims=True)
        over = np.maximum(new[:, GOOD, JUNK] - FALSE_ALARMS, 0)
        new[:, GOOD, JUNK] -= over
        new[:, GOOD, ABSTAIN] += over
        prior = float(np.clip((good * counts).sum() / counts.sum(), 0.01, 0.99))
        moved = np.abs(new - model.table).max()
        model = LabelModel(prior, new)
        if moved < 1e-6:
            break
    return model


def fit_scorer(x: np.ndarray, y: np.ndarray, steps: int = 500, ridge: float = 1e-5) -> np.ndarray:
    """Logistic regression on soft labels by Nesterov steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w, v = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    rate = 4.0 / max(1e-9, (x**2).sum(1).mean())
    for k in range(steps):
        at = w + k / (k + 3) * (w - v)
        v = w
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        w = at - rate * (x.T @ (p - y) / len(x) + ridge * at)
    return w


def _vote_udf():
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(["".join(map(str, votes(statistics(t)))) for t in texts], dtype=object)

    return run


def _sample_udf():
    @F.pandas_udf("struct<votes:string,x:binary>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            s = statistics(t)
            rows.append(("".join(map(str, votes(s))), features(t, s).tobytes()))
        return pd.DataFrame(rows, columns=["votes", "x"])

    return run


def _score_udf(weights: np.ndarray):
    w, bias = weights[:-1].astype(np.float64), float(weights[-1])

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        out = [1 / (1 + np.exp(-np.clip(features(t, statistics(t)) @ w + bias, -40, 40))) for t in texts]
        return pd.Series(out, dtype="float64")

    return run


@dataclass(frozen=True)
class QualityModel:
    labels: LabelModel
    weights: np.ndarray


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> QualityModel:
    """The label model is fitted on the votes over every document, which reach the
    driver as counts of vote patterns (at most 3 to the number of labellers); the
    scorer on the ``fit_rows`` documents with the least hashes of id and text, by their
    posterior; equal rows are one of these, so an id that a third of all rows share is not
    the sample, and reruns agree."""
    patterns = docs.groupBy(_vote_udf()(F.col(text_col)).alias("votes")).count().collect()
    grid = np.array([[int(c) for c in r["votes"]] for r in patterns], int).reshape(len(patterns), len(LABELLERS))
    model = fit_labels(grid, np.array([r["count"] for r in patterns], float))
    # three times as many by a share of the hashes' range, then the least of them
    total = sum(r["count"] for r in patterns)
    bound = min((1 << 63) - 1, -(1 << 63) + int(3 * fit_rows / max(1, total) * (1 << 64)))
    rows = docs.select(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(5)).alias("k"), F.col(text_col).alias("t")).where(F.col("k") <= bound)
    some = rows.groupBy("k").agg(F.first("t").alias("t")).orderBy("k").limit(fit_rows)
    sample = some.select("k", _sample_udf()(F.col("t")).alias("s")).select("k", "s.votes", "s.x").collect()
    sample.sort(key=lambda r: r["k"])
    if not sample:
        return QualityModel(model, np.zeros(DIM + 1))
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in sample])
    y = model.posterior(np.array([[int(c) for c in r["votes"]] for r in sample], int))
    return QualityModel(model, fit_scorer(x, y))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of good quality, over whole texts."""
    return docs.withColumn(out, _score_udf(model.weights)(F.col(text_col)))


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, quality_score, keep) for every row. Null and empty texts are scored as
    texts without words (junk by length alone, if the labellers hold so); repeated
    rows and null ids are scored row by row; other columns are ignored; an empty
    table gives no rows."""
    scored = score(docs.select(F.col(id_col), F.col(text_col)), fit(docs, id_col, text_col), text_col)
    return scored.select(id_col, "quality_score", (F.col("quality_score") >= threshold).alias("keep"))


def drop_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that reach the threshold, with all columns of ``docs``, of whatever names."""
    (out,) = free(docs, "quality_score")
    kept = score(docs, fit(docs, id_col, text_col), text_col, out).where(F.col(out) >= threshold)
    return kept.select(*docs.columns)
