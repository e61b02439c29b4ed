"""String similarity (operators C1-C8, J17), from the published definitions of the
scorers: a bit-parallel longest common subsequence, and what is built on it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _places(a: str) -> dict[str, int]:
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    return where


def _lcs(where: dict[str, int], n: int, b: str) -> int:
    full = (1 << n) - 1
    s = full
    for c in b:
        if u := s & where.get(c, 0):
            s = (s + u | s - u) & full
    return n - s.bit_count()


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a word of bits a step."""
    return _lcs(_places(a), len(a), b)


def ratio(a: str, b: str) -> float:
    """200 LCS / (len a + len b); two empty texts are equal."""
    n = len(a) + len(b)
    return 200.0 * lcs(a, b) / n if n else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    """C3."""
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """0 if a side has no token; 100 if one side's tokens are among the other's."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 100.0
    s = " ".join(both)
    one, two = " ".join([*both, *left]), " ".join([*both, *right])
    best = ratio(" ".join(left), " ".join(right)) if not both else ratio(one, two)
    return max(best, ratio(s, one), ratio(s, two)) if both else best


def partial_ratio(a: str, b: str) -> float:
    """C4: the best ratio of the shorter text with a window of the longer, windows over
    either end included."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    best = _best_window(a, b)
    return max(best, _best_window(b, a)) if len(a) == len(b) else best


def _best_window(a: str, b: str) -> float:
    m, where, best = len(a), _places(a), 0.0
    for i in range(1 - m, len(b)):
        w = b[max(0, i) : i + m]
        # a window that ends outside of a's letters is no better than the one before or a shorter one
        if (w[-1] if i + m <= len(b) else w[0]) in where:
            best = max(best, 200.0 * _lcs(where, m, w) / (m + len(w)))
            if best == 100.0:
                break
    return best


def partial_token_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if x & y:
        return 100.0
    return max(partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial_ratio(" ".join(sorted(x)), " ".join(sorted(y))))


def weighted_ratio(a: str, b: str) -> float:
    """Plain, token and partial ratios, the latter two scaled by .95 and by .9 (.6 if
    one text is over eight times as long as the other)."""
    if not a or not b:
        return 0.0
    spread = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if spread < 1.5:
        return max(best, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if spread <= 8 else 0.6
    return max(best, scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def jaro_winkler(a: str, b: str) -> float:
    """0 to 1; equal starts of up to four letters count above .7."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used = [False] * len(b)
    left = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                left.append(c)
                break
    if not left:
        return 0.0
    right = [c for c, u in zip(b, used, strict=True) if u]
    m, t = len(left), sum(x != y for x, y in zip(left, right, strict=True)) // 2
    j = (m / len(a) + m / len(b) + (m - t) / m) / 3
    start = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return j + start * 0.1 * (1 - j) if j > 0.7 else j


def dba_best(da: str, ca: str, db: str, cb: str) -> float | None:
    """The best token set ratio of any two names of the sides; null without second names."""
    if not da and not db:
        return None
    return max(token_set_ratio(x, y) for x in (da or ca).split("|") for y in (db or cb).split("|"))


# The same over many pairs at once: a pair is a row of arrays, a subsequence's bits are one
# 64-bit word, and every step works on a column of all rows. Texts whose shorter side is
# longer than a word go one by one.


def _codes(texts: list[str], width: int, pad: int) -> np.ndarray:
    out = np.full((len(texts), width), pad, np.uint32)
    for row, t in zip(out, texts, strict=True):
        if t:
            row[: len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def _places_many(a: list[str], b: list[str]) -> np.ndarray:
    """For each place of b the word of a's places with the same letter."""
    x, y = _codes(a, 64, 0xFFFFFFFF), _codes(b, max(1, max(map(len, b))), 0xFFFFFFFE)
    out = np.empty(y.shape, np.uint64)
    for t in range(y.shape[1]):
        out[:, t] = np.packbits(x == y[:, t : t + 1], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def _chunks(a: list[str], b: list[str], rows: int):
    """Rows whose shorter side fits a word, those of like lengths together; a is the shorter."""
    m, n = np.fromiter(map(len, a), int, len(a)), np.fromiter(map(len, b), int, len(b))
    order = np.lexsort((np.minimum(m, n), np.maximum(m, n)))
    order = order[np.minimum(m, n)[order] <= 64]
    for s in range(0, len(order), rows):
        at = order[s : s + rows].tolist()
        yield at, [min(a[k], b[k], key=len) for k in at], [b[k] if len(a[k]) <= len(b[k]) else a[k] for k in at]


def lcs_many(a: list[str], b: list[str]) -> np.ndarray:
    out = np.fromiter((lcs(x, y) if min(len(x), len(y)) > 64 else 0 for x, y in zip(a, b, strict=True)), float, len(a))
    for at, x, y in _chunks(a, b, 2048):
        where = _places_many(x, y)
        s = np.full(len(at), 0xFFFFFFFFFFFFFFFF, np.uint64)
        for t in range(where.shape[1]):
            u = s & where[:, t]
            s = (s + u) | (s - u)
        out[at] = 64 - np.bitwise_count(s).astype(float)
    return out


def ratio_many(a: list[str], b: list[str]) -> np.ndarray:
    """C1."""
    n = np.fromiter((len(x) + len(y) for x, y in zip(a, b, strict=True)), float, len(a))
    return np.where(n > 0, 200.0 * lcs_many(a, b) / np.maximum(n, 1), 100.0)


def token_sort_many(a: list[str], b: list[str]) -> np.ndarray:
    """C3."""
    in_order = lambda t: " ".join(sorted(t.split()))
    return ratio_many([in_order(x) for x in a], [in_order(x) for x in b])


def token_set_many(a: list[str], b: list[str]) -> np.ndarray:
    """C2. Common tokens stand first on both sides, so they are common letters: only the rest
    needs a subsequence, and the common tokens against either side need none."""
    out, rest = np.zeros(len(a)), []
    for k, (p, q) in enumerate(zip(a, b, strict=True)):
        x, y = set(p.split()), set(q.split())
        if not x or not y:
            continue
        both = x & y
        if both and (both == x or both == y):
            out[k] = 100.0
            continue
        size = sum(map(len, both)) + max(0, len(both) - 1)
        rest.append((k, size, " ".join(sorted(x - both)), " ".join(sorted(y - both))))
    if rest:
        k, size = [r[0] for r in rest], np.array([r[1] for r in rest], float)
        left, right = [r[2] for r in rest], [r[3] for r in rest]
        gap = size + (size > 0)
        m, n = (gap + np.fromiter(map(len, t), float, len(t)) for t in (left, right))
        best = 200.0 * (gap + lcs_many(left, right)) / (m + n)
        out[k] = np.where(size > 0, np.maximum(best, 200.0 * size / (size + np.minimum(m, n))), best)
    return out


def partial_many(a: list[str], b: list[str]) -> np.ndarray:
    """C4: all windows of the longer text at once; places beyond its ends match nothing."""
    out = np.fromiter((partial_ratio(x, y) if min(len(x), len(y)) > 64 or not x or not y else 0 for x, y in zip(a, b, strict=True)), float, len(a))
    for at, x, y in _chunks(a, b, 256):
        m, n = (np.fromiter(map(len, t), int, len(t)) for t in (x, y))
        for p, q, i, j in ((x, y, m, n), (y, x, n, m)):
            if p is y and not (m == n).any():
                break
            most = int(i.max())
            if most > 64 or not most:
                continue
            where = np.pad(_places_many(p, q), ((0, 0), (most - 1, most - 1)))
            width = where.shape[1] - most + 1
            s = np.full((len(at), width), 0xFFFFFFFFFFFFFFFF, np.uint64)
            for t in range(most):
                u = s & np.where((t < i)[:, None], where[:, t : t + width], np.uint64(0))
                s = (s + u) | (s - u)
            start = np.arange(width) - (most - 1)
            held = np.minimum(start + i[:, None], j[:, None]) - np.maximum(start, 0)
            score = np.where(held > 0, 200.0 * (64 - np.bitwise_count(s).astype(float)) / np.maximum(1, i[:, None] + held), 0.0).max(1)
            score[(i == 0) | (j == 0)] = 0
            out[at] = np.maximum(out[at], np.where((p is x) | (m == n), score, 0))
    return out


def partial_token_many(a: list[str], b: list[str]) -> np.ndarray:
    out = np.full(len(a), 100.0)
    todo = [k for k, (x, y) in enumerate(zip(a, b, strict=True)) if not set(x.split()) & set(y.split())]
    scores = []
    for tokens in (str.split, lambda t: set(t.split())):
        form = lambda t: " ".join(sorted(tokens(t)))  # noqa: B023, E731
        scores.append(partial_many([form(a[k]) for k in todo], [form(b[k]) for k in todo]))
    out[todo] = np.maximum(*scores)
    return out


def weighted_many(a: list[str], b: list[str]) -> np.ndarray:
    """C7."""
    m, n = (np.fromiter(map(len, t), float, len(t)) for t in (a, b))
    out = np.where(np.minimum(m, n) > 0, ratio_many(a, b), 0.0)
    spread = np.maximum(m, n) / np.maximum(1, np.minimum(m, n))
    pick = lambda rows: ([a[k] for k in rows], [b[k] for k in rows])
    near = np.flatnonzero((np.minimum(m, n) > 0) & (spread < 1.5)).tolist()
    out[near] = np.maximum(out[near], 0.95 * np.maximum(token_sort_many(*pick(near)), token_set_many(*pick(near))))
    far = np.flatnonzero((np.minimum(m, n) > 0) & (spread >= 1.5)).tolist()
    scale = np.where(spread[far] <= 8, 0.9, 0.6)
    out[far] = np.maximum(out[far], np.maximum(scale * partial_many(*pick(far)), 0.95 * scale * partial_token_many(*pick(far))))
    return out


def dba_many(da: list[str], ca: list[str], db: list[str], cb: list[str]) -> np.ndarray:
    """NaN without second names."""
    rows, x, y = [], [], []
    for k, (p, c, q, d) in enumerate(zip(da, ca, db, cb, strict=True)):
        if p or q:
            for u in (p or c).split("|"):
                for v in (q or d).split("|"):
                    rows.append(k)
                    x.append(u)
                    y.append(v)
    out = np.full(len(da), -1.0)
    np.maximum.at(out, rows, token_set_many(x, y))
    return np.where(out < 0, np.nan, out)


def _udf(many):
    """A scorer over Arrow batches, each distinct row once."""

    def run(cols: list[pd.Series]) -> pd.Series:
        keys = list(zip(*(c.fillna("") for c in cols), strict=True))
        known = {key: k for k, key in enumerate(dict.fromkeys(keys))}
        score = many(*map(list, zip(*known, strict=True))) if known else np.zeros(0)
        return pd.Series(score[[known[k] for k in keys]], dtype="float64")

    return run


def _pair_udf(many):
    run = _udf(many)

    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        return run([a, b])

    return F.pandas_udf(of, DoubleType())


ratio_udf = _pair_udf(ratio_many)
token_sort_udf = _pair_udf(token_sort_many)
token_set_udf = _pair_udf(token_set_many)
partial_udf = _pair_udf(partial_many)
weighted_udf = _pair_udf(weighted_many)
jaro_winkler_udf = _pair_udf(lambda a, b: np.fromiter(map(jaro_winkler, a, b), float, len(a)))


def _dba(da: pd.Series, ca: pd.Series, db: pd.Series, cb: pd.Series) -> pd.Series:
    score = _udf(dba_many)([da, ca, db, cb])
    return score.astype(object).where(score.notna(), None)


dba_udf = F.pandas_udf(_dba, DoubleType())


def levenshtein_similarity(a, b) -> F.Column:
    """C6, native: 1 - distance / longer length; two empty texts are equal."""
    n = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(n == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / n)


def jaccard(x, y) -> F.Column:
    """U4: null if both token arrays are empty."""
    n = F.size(F.array_union(x, y))
    return F.when(n > 0, F.size(F.array_intersect(x, y)) / n)
