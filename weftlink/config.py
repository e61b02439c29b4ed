"""Settings, their fingerprints, and stages that run again only if what they depend on
changed (operators X1, X6, X7, X10, N19, IO8, IO16, F16)."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, fields, is_dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Blocking:
    within_country: bool = True
    max_df: int = 20000
    max_products: float = 1.2e10
    k_s1: dict = field(default_factory=lambda: {"full": 15, "name": 6, "addr": 6})
    k_rec: dict = field(default_factory=lambda: {"full": 8, "name": 3, "addr": 3})
    diagnose: bool = True


@dataclass(frozen=True)
class Prune:
    min_p: float = 0.002
    rank_s1: int = 12
    rank_rec: int = 6


@dataclass(frozen=True)
class Decision:
    max_cands: int = 12
    policies: tuple = ("threshold", "two_threshold", "expected_f")
    excl_modes: tuple = ("none", "softmax", "hard", "softmax_hard")
    max_eval_s1: int = 400000


@dataclass(frozen=True)
class Scores:
    gate: tuple = (0.02, 0.98)
    n_models: int = 2
    train_rank_s1: int = 10
    neg_per_rec: int = 1


@dataclass(frozen=True)
class Config:
    seed: int = 42
    n_folds: int = 4
    sample_s1: int = 150000
    translit: bool = True
    blocking: Blocking = Blocking()
    prune: Prune = Prune()
    decision: Decision = Decision()
    scores: Scores = Scores()


FAST = {"sample_s1": 100000, "scores.gate": (0.03, 0.97), "scores.n_models": 1}


def parse_value(text: str) -> Any:
    """The value of ``a.b=value``: JSON where it is JSON, numbers like 1e6 or
    1_000 as numbers, anything else as text."""
    try:
        return json.loads(text)
    except ValueError:
        pass
    low = text.strip().lower()
    if low in ("true", "yes", "on", "false", "no", "off"):
        return low in ("true", "yes", "on")
    try:
        x = float(low.replace("_", ""))
    except ValueError:
        return text
    return int(x) if x.is_integer() and "e" not in low and "." not in low else x


def override(cfg: Any, changes: dict[str, Any]) -> Any:
    """``{"blocking.max_df": 500}`` and the like; an unknown name is an error."""
    for path, value in changes.items():
        head, _, rest = path.partition(".")
        if head not in {f.name for f in fields(cfg)}:
            raise KeyError(f"no setting {path!r}")
        old = getattr(cfg, head)
        if rest and isinstance(old, dict):
            value = old | {rest: value}
        elif rest and is_dataclass(old):
            value = override(old, {rest: value})
        elif isinstance(old, tuple) and isinstance(value, list):
            value = tuple(value)
        cfg = replace(cfg, **{head: value})
    return cfg


def load(path: str | None = None, sets: tuple[str, ...] = (), fast: bool = False) -> Config:
    """Defaults, then the fast profile, a JSON file, and ``a.b=value`` texts."""
    cfg = override(Config(), FAST) if fast else Config()
    if path:
        with open(path) as f:
            cfg = override(cfg, _flat(json.load(f)))
    return override(cfg, {k: parse_value(v) for k, _, v in (s.partition("=") for s in sets)})


def _flat(tree: dict, at: str = "") -> dict[str, Any]:
    out: dict[str, Any] = {}
    for k, v in tree.items():
        out |= _flat(v, f"{at}{k}.") if isinstance(v, dict) else {f"{at}{k}": v}
    return out


def inputs_key(spark: SparkSession, paths: list[str]) -> str:
    """IO16: digest of names, lengths and times of all files under the paths: a stage under
    this key is made again when its inputs change."""
    conf, seen = spark._jsc.hadoopConfiguration(), []
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = p.getFileSystem(conf).listFiles(p, True)
        while files.hasNext():
            f = files.next()
            seen.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.md5(repr(sorted(seen)).encode()).hexdigest()[:12]


def fingerprint(cfg: Config, parts: tuple[str, ...] = (), more: dict | None = None) -> str:
    """Digest of the settings a stage depends on (all if none are named), and of ``more``."""
    tree = asdict(cfg) | (more or {})
    return hashlib.md5(json.dumps({k: tree[k] for k in parts} if parts else tree, sort_keys=True, default=str).encode()).hexdigest()[:12]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def stage(spark: SparkSession, root: str, name: str, key: str, make: Callable[[], DataFrame]) -> DataFrame:
    """X10, IO8: the table of a stage; made and written only if there is none under this
    fingerprint. A half-written one has no _SUCCESS and is made again."""
    path = f"{root}/{name}-{key}"
    if not _exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def model_plan(n_folds: int, n_models: int) -> list[dict]:
    """F16: which folds each model learns from and which it scores out of sample. One
    model learns from half of the folds and scores the rest."""
    if not 1 <= n_models <= n_folds:
        raise ValueError("n_models must be from 1 to n_folds")
    folds = list(range(n_folds))
    held = [folds[m::n_models] for m in range(n_models)] if n_models > 1 else [folds[n_folds // 2 :]]
    return [{"model": m, "train": [f for f in folds if f not in h], "score": h, "shards": [f for f in folds if f % n_models == m]} for m, h in enumerate(held)]
