"""Synthetic sources for end-to-end tests (operator IO26): businesses in a clean source and
noisy copies of them in two others, with the truth."""

from __future__ import annotations

import os
import random

# A small vocabulary of our own.
ADJECTIVES = "blue golden northern silver royal green united prime rapid crystal".split()
NOUNS = "harbor bakery tailor motors pharmacy garden electric books timber dairy".split()
STREETS = {"us": "oak maple cedar lake hill".split(), "in": "gandhi nehru tilak patel bose".split(), "fr": "voltaire hugo pasteur zola monge".split()}
FORMS = {"us": ["Inc", "LLC", "Corp", ""], "in": ["Pvt Ltd", "Ltd", ""], "fr": ["SARL", "SAS", ""]}
COPIES = 4


def _typo(r: random.Random, s: str) -> str:
    i = r.randrange(max(1, len(s) - 1))
    return s[:i] + (s[i + 1 : i + 2] + s[i : i + 1] if r.random() < 0.5 else r.choice("aeiou")) + s[i + 2 :]


def _entity(r: random.Random, country: str) -> dict:
    postal = f"{r.randrange(10000, 99999)}" if country != "in" else f"{r.randrange(100000, 999999)}"
    name = f"{r.choice(ADJECTIVES)} {r.choice(NOUNS)} {r.choice(ADJECTIVES)[:3]}{r.randrange(100)}"
    return {"name": name, "form": r.choice(FORMS[country]), "house": r.randrange(1, 400), "street": r.choice(STREETS[country]), "postal": postal, "country": country}


def _render(r: random.Random, e: dict, noisy: bool) -> tuple[str, str]:
    name, form = e["name"].title(), e["form"]
    if noisy and r.random() < 0.35:
        name = _typo(r, name)
    if noisy and r.random() < 0.15:
        name = " ".join(reversed(name.split()))
    name = f"{name} {form}".strip() if form and not (noisy and r.random() < 0.3) else name
    house = "" if noisy and r.random() < 0.25 else f"{e['house']} "
    road = {"us": ["Street", "St"], "in": ["Road", "Rd"], "fr": ["Rue", "R"]}[e["country"]][noisy and r.random() < 0.5]
    postal = "" if noisy and r.random() < 0.3 else f" {e['postal']}"
    return name, f"{house}{e['street'].title()} {road},{postal}"


def generate(path: str, n: int = 300, seed: int = 0, countries: tuple[str, ...] = ("us", "in")) -> None:
    """Write source1..3.tsv and truth.tsv. 8% of the entities share a name with another, 5%
    an address; 80% are in the clean source, 8% of those without copies; others have 0 to
    4 copies in each noisy source."""
    r = random.Random(seed)
    os.makedirs(path, exist_ok=True)
    entities: list[dict] = []
    for _ in range(n):
        e = _entity(r, r.choice(countries))
        if entities and r.random() < 0.08:
            e["name"] = r.choice(entities)["name"]
        if entities and r.random() < 0.05:
            o = r.choice(entities)
            e |= {k: o[k] for k in ("house", "street", "postal", "country")}
        entities.append(e)
    rows: dict[int, list] = {1: [], 2: [], 3: []}
    truth = []
    ids = iter(r.sample(range(10 * n, 1000 * n), 20 * n))
    for e in entities:
        clean = r.random() < 0.8
        copies = [] if clean and r.random() < 0.08 else [s for s in (2, 3) for _ in range(r.randrange(COPIES + 1 if clean else 3))]
        found = []
        for s in copies:
            found.append(f"S{s}-{next(ids)}")
            rows[s].append((found[-1], *_render(r, e, True), e["country"]))
        if clean:
            rows[1].append((f"S1-{next(ids)}", *_render(r, e, False), e["country"]))
            truth.append((rows[1][-1][0], ",".join(found)))
    for s, lines in rows.items():
        with open(f"{path}/source{s}.tsv", "w", encoding="utf-8-sig") as f:
            f.write("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join(x) + "\n" for x in lines))
    with open(f"{path}/truth.tsv", "w") as f:
        f.write("source1_entity_id\tmatched_entity_ids\n" + "".join("\t".join(x) + "\n" for x in truth))
