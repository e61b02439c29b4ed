"""Command line (operator X1): ``python -m weftlink link --train DIR --test DIR --work DIR --out DIR``."""

from __future__ import annotations

import argparse
import json

from weftlink import config
from weftlink.operators import linking
from weftlink.session import session
from weftlink.sources import require, write_json


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="weftlink")
    p.add_argument("command", choices=["link", "eda"])
    for name in ("train", "test", "work", "out"):
        p.add_argument(f"--{name}", required=name != "out")
    p.add_argument("--config", help="settings as JSON")
    p.add_argument("--set", action="append", default=[], metavar="a.b=value")
    p.add_argument("--fast", action="store_true")
    p.add_argument("--loco", action="store_true", help="also leave a country out at a time")
    p.add_argument("--master")
    a = p.parse_args(argv)
    cfg = config.load(a.config, tuple(a.set), a.fast)
    spark = session(a.master)
    require(spark, [f"{d}/source{k}.tsv" for d in (a.train, a.test) for k in (1, 2, 3)] + [f"{a.train}/truth.tsv"])
    if a.command == "eda":
        report = linking.eda(linking.prepare(spark, a.train, a.work, cfg, "train"), linking.prepare(spark, a.test, a.work, cfg, "test", labelled=False))
    else:
        report = linking.run(spark, a.train, a.test, a.work, a.out or f"{a.work}/out", cfg, loco=a.loco)
    write_json(spark, f"{a.work}/log", {"command": a.command, "settings": config.fingerprint(cfg), "report": report}, append=True)
    print(json.dumps(report, indent=1, default=str))
    return report


if __name__ == "__main__":
    main()
