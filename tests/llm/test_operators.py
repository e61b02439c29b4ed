"""Each corpus operator against a brute-force version, a round trip or held-out accuracy,
and over nulls, empty and very long texts, repeated rows, empty tables and extra columns."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weftlink.llm import ann, chat, common, decontaminate, htmltext, mixing, quality, queries, simhash, tokens, urlfilter, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, count int, fp string, id string"


def docs(spark, texts, sources=None):
    rows = [(i, t, "en", sources[k] if sources else "s", 0, 1, "x", "y") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def words(n, seed):
    r = random.Random(seed)
    return [f"w{r.randrange(5000)}" for _ in range(n)]


# WARC


PAGES = "page_id long, url string, html string, size int, path string"


def test_warc_round_trip(spark):
    big = "é" * 3_000_000
    given = [(1, "http://a/ ü", "<p>x</p>", 0, ""), (2, None, "<p>x</p>", 0, ""), (3, "u", None, 0, ""), (4, "u", "", 0, ""), (5, "u\r\nX: y", big, 0, ""), (None, "u", "<p>x</p>", 0, ""), (7, "u", "only", 0, ""), (2, None, "<p>x</p>", 0, "")]
    pages = spark.createDataFrame(given, PAGES).repartition(3)
    got = warc.round_trip(pages, range_bytes=700).collect()
    assert len(got) == len(given)
    by = defaultdict(list)
    for r in got:
        by[r["record_id"]].append(r)
    for i, url, html, *_ in given:
        data = (html or "").encode()
        most = max((g[0] for g in given if (g[2] or "") == (html or "") and g[0] is not None), default=None)
        for r in by[f"urn:page:{'null' if i is None else i}"]:
            assert (r["payload_bytes"], r["payload_digest"], r["target_uri"]) == (len(data), warc.base32_sha1(data), url or "")
            if i == most:
                assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, data)
            else:
                assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", f"urn:page:{most}", None)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_warc_ranges_own_each_record_once(tmp_path):
    data, starts = b"", []
    for k in range(40):
        starts.append(len(data))
        body = bytes(random.Random(k).randrange(256) for _ in range(50)) + warc.MAGIC * 3
        data += warc.member(f"r{k}", "http://x", warc.base32_sha1(body), body, len(body), None)
    f = tmp_path / "a.warc.gz"
    f.write_bytes(data)
    for step in (1, 7, 100, 999, len(data)):
        got = []
        with f.open("rb") as h:
            for a in range(0, len(data), step):
                got += [(at, head["warc-record-id"]) for at, head, _ in warc.scan(h, len(data), a, min(a + step, len(data)))]
        assert got == [(s, f"<r{k}>") for k, s in enumerate(starts)]


class _Counted:
    def __init__(self, data):
        self.data, self.at, self.bytes, self.reads = data, 0, 0, 0

    def seek(self, at):
        self.at = at

    def read(self, n):
        self.bytes, self.reads = self.bytes + min(n, len(self.data) - self.at), self.reads + 1
        return self.data[self.at : self.at + n]


@pytest.mark.parametrize("size", [300, 40_000, 3_000_000])
def test_warc_scan_reads_its_range_and_one_record(size):
    data, longest = b"", 0
    for k in range(max(4, 600_000 // size)):
        body = random.Random(k).randbytes(size)
        m = warc.member(f"r{k}", "http://x", warc.base32_sha1(body), body, len(body), None)
        data, longest = data + m, max(longest, len(m))
    step, found = len(data) // 3 + 1, 0
    for a in range(0, len(data), step):
        f = _Counted(data)
        found += len(list(warc.scan(f, len(data), a, min(a + step, len(data)))))
        assert f.bytes <= step + longest + 2 * warc.PIECE and f.reads <= step / warc.CHUNK + longest / warc.PIECE + 3
    assert found == max(4, 600_000 // size)


def test_warc_copies_by_bitmap(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    given = [(k, "u", "hot" if k % 3 == 0 else f"twice {k // 6}" if k % 3 == 1 else f"once {k}", 0, "") for k in range(120)] + [(None, "u", "hot", 0, ""), (117, "u", "hot", 0, "")]
    pages = spark.createDataFrame(given, PAGES).repartition(3)
    for hot in (1, 4, 10**9):
        monkeypatch.setattr(warc, "HOT", hot)
        got = rows(warc.round_trip(pages), "record_id", "record_type", "refers_to")
        want = []
        for i, _, html, *_ in given:
            most = max(g[0] for g in given if g[2] == html and g[0] is not None)
            mine = f"urn:page:{'null' if i is None else i}"
            want.append((mine, "response", None) if i == most else (mine, "revisit", f"urn:page:{most}"))
        assert got == sorted(want, key=str)


# URL filter


def test_url_filter_intervals(spark):
    day = lambda d: f"2024-01-{d:02d} 00:00:00"
    entries = spark.createDataFrame([("ex.com", "block", day(5)), ("ex.com", "lift", day(10)), ("ex.com", "block", day(20)), ("ex.com", "block", day(20)), ("=a.ex.com", "allow", day(7)), ("deep.a.b.c.d.ex.org", "block", day(1)), ("n.com", "block", day(3)), ("n.com", "allow", day(3)), (None, "block", day(1)), ("z.com", None, day(1))], "pattern string, action string, since string").withColumn("since", F.to_timestamp("since"))
    caps = [(1, "http://ex.com/", 4), (2, "http://EX.com:80/x", 5), (3, "https://u@ex.com./", 9), (4, "http://ex.com", 10), (5, "http://ex.com", 21), (6, "http://a.ex.com", 6), (7, "http://a.ex.com", 8), (8, "http://b.a.ex.com", 21), (9, None, 3), (10, "nonsense", 3), (11, "http://x.deep.a.b.c.d.ex.org/", 2), (12, "http://n.com", 4), (13, "http://notex.com", 6), (1, "http://ex.com/", 4)]
    c = spark.createDataFrame([(i, u, day(d), "h", 1) for i, u, d in caps], "page_id long, url string, fetched string, host string, salt int").withColumn("fetched", F.to_timestamp("fetched"))
    c = c.union(spark.createDataFrame([(14, "http://ex.com", None, "h", 1)], "page_id long, url string, fetched timestamp, host string, salt int"))
    got = {r["page_id"]: r["decision"] for r in urlfilter.filter_urls(c, entries).collect()}
    assert {k for k, v in got.items() if v == "block"} == {2, 3, 5, 6, 8, 11}
    assert urlfilter.filter_urls(c, entries).count() == 15
    assert urlfilter.filter_urls(c, entries.where("false")).where("decision = 'block'").count() == 0
    assert urlfilter.filter_urls(c.where("false"), entries).count() == 0


# decontamination


def brute_contamination(texts, items, threshold=0.8):
    def grams(t, n):
        w = [x for x in t.lower().replace("\t", " ").replace("\n", " ").split(" ") if x]
        return {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}, len(w)

    out = set()
    for d, t in texts:
        for i, u in items:
            n = min(5, grams(u or "", 1)[1])
            if n and t:
                g, h = grams(u, n)[0], grams(t, n)[0]
                if len(g & h) >= math.ceil(len(g) * threshold - 1e-9):
                    out.add((d, i, len(g & h), len(g)))
    return out


def test_decontamination_matches_brute_force(spark):
    items = [(k, " ".join(words(12 + 3 * k, k))) for k in range(8)] + [(20, "just three words"), (21, ""), (22, None), (3, " ".join(words(21, 3))), (23, "one two three four five")]
    texts = []
    for k in range(60):
        w, it = words(150, 100 + k), (items[k % 8][1].split())
        it = [x if random.Random(k + j).random() > 0.02 * (k % 7) else "zz" for j, x in enumerate(it)]
        texts.append((k, " ".join(w[:70]) + "\n" + "  ".join(it).upper() + "\t" + " ".join(w[70:])))
    texts += [(100, None), (101, ""), (102, "Just THREE words"), (None, items[2][1]), (103, " ".join(words(60000, 9)) + " " + items[5][1]), (104, "one two three four five"), (104, "one two three four five")]
    d = docs(spark, texts)
    it = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in decontaminate.contamination(d, it).select("doc_id", "item_id", "matched", "total").collect()}
    assert got == brute_contamination(texts, items) and len(got) > 20
    assert decontaminate.contamination(d, it.where("false")).count() == 0
    assert decontaminate.contamination(d.where("false"), it).count() == 0
    kept = decontaminate.drop_contaminated(d, it)
    assert kept.columns == d.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {i for i, _ in texts} - {g[0] for g in got}


def test_decontamination_drops_only_rows_that_hold_an_item(spark):
    leak = "x a b c d e f g y"
    d = docs(spark, [(None, leak), (None, "clean one"), (None, None), (7, leak), (7, "clean two"), (7, "clean two"), (8, leak), (8, leak), (9, "")])
    kept = decontaminate.drop_contaminated(d, spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string"))
    assert rows(kept, "doc_id", "text") == sorted([(None, "clean one"), (None, None), (7, "clean two"), (7, "clean two"), (9, "")], key=str)


def test_decontamination_shuffled_keys(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    texts = [(1, "a b c d e f g"), (2, "x " + "a b c d e f g"), (3, "a b c")]
    got = decontaminate.contamination(docs(spark, texts), spark.createDataFrame([(9, "a b c d e f g")], "item_id long, text string"))
    assert {r["doc_id"] for r in got.collect()} == {1, 2}


def test_decontamination_sql_has_short_items(spark, tmp_path):
    items = [(1, "just three words"), (2, "x"), (3, "a b c d e f"), (4, ""), (5, None)]
    texts = [(1, "so just three  words"), (2, "y X"), (3, "a b c d e f x"), (4, "a b c d e"), (5, None), (6, "")]
    it = spark.createDataFrame(items, "item_id long, text string")
    docs(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    it.write.parquet(str(tmp_path / "benchmark.parquet"))
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = sorted(c.execute(f"SELECT doc_id, item_id, matched, total FROM ({queries.OP3_SQL})").fetchall())
    got = queries.op3_decontamination(spark, str(tmp_path)).select("doc_id", "item_id", "matched", "total").collect()
    assert sorted(map(tuple, got)) == want == sorted(brute_contamination([(i, t or "") for i, t in texts], items))


# approximate nearest neighbours


def brute_nearest(vec, query_ids, k):
    out = {}
    keep = {i: np.array(v, float) for i, v in vec if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    for q in query_ids:
        if q in keep:
            a = keep[q]
            s = [(-float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), i) for i, b in keep.items() if i != q and len(b) == len(a)]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in s)[:k]]
    return out


def test_ann_small_and_odd(spark):
    r = np.random.default_rng(0)
    vec = [(i, r.normal(size=4).tolist()) for i in range(40)] + [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(20)]
    vec += [(200, None), (201, [0.0] * 4), (202, [1.0, float("nan"), 0.0, 0.0]), (203, [1.0, None, 0.0, 0.0]), (204, []), (205, [float("inf")] * 4), (206, [1.0, 2.0]), (207, [2.0, 4.1]), (7, vec[7][1])]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in vec], "vec_id long, embedding array<double>, dim int, shard int")
    got = defaultdict(list)
    for x in ann.nearest(df, df, k=5, shard=16).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["vec_id"], x["score"]))
    want = brute_nearest(vec, {i for i, _ in vec}, 5)
    assert got.keys() == want.keys()
    for q, w in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in w], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in w], atol=1e-12)
    assert ann.nearest(df.where("false"), df).count() == 0


def _recall(spark, n):
    t = spark.read.parquet("/root/testdata/check_s/embeddings.parquet").where("embedding is not null").orderBy("vec_id").limit(n)
    e = common.staged(t, "vectors")
    got = defaultdict(set)
    for x in ann.nearest(e, e.where("vec_id % 50 = 0")).collect():
        got[x["query_id"]].add(x["vec_id"])
    vec = [(x["vec_id"], x["embedding"]) for x in e.collect()]
    want = brute_nearest(vec, got.keys(), 5)
    return np.mean([len(got[q] & {i for i, _ in w}) / 5 for q, w in want.items()])


def test_ann_recall_at_the_default_shard(spark):
    assert _recall(spark, 1500) >= 0.95
    assert _recall(spark, 5000) >= 0.95


def _scores(x, k=5):
    pdf = pd.DataFrame({"id": np.arange(len(x)), "vec": list(x), "dim": x.shape[1], "shard": 0})
    kept = {}
    put, ann._put = ann._put, lambda root, name, **arrays: kept.update(arrays) or name
    try:
        ann._build("")(pdf)
    finally:
        ann._put = put
    return kept


def test_ann_tells_multiples_and_near_copies_apart():
    r = np.random.default_rng(0)
    base, rest = r.normal(size=64), r.normal(size=(2000, 64))
    q = np.arange(2000, 2040)
    near = base + r.normal(size=(40, 64)) * 1e-5 * np.abs(base)
    scaled = base * 2.0 ** r.integers(-30, 30, 40)[:, None]
    for group in (near, scaled):
        x = np.vstack([rest, group])
        got = defaultdict(list)
        for i, j, s in ann.search(_scores(x), x[q], q, 5)[0]:
            got[i].append((j, s))
        for i in q.tolist():
            s = x @ x[i] / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[i]))
            s[i] = -9
            want = np.lexsort((np.arange(len(x)), -np.round(s, 14)))[:5]
            assert sorted(j for j, _ in got[i]) == sorted(want.tolist()) and np.allclose([v for _, v in got[i]], s[want], atol=1e-14)
        if group is scaled:
            assert all([j for j, _ in got[i]] == [j for j in range(2000, 2006) if j != i][:5] for i in q.tolist())


def test_ann_looks_at_a_share_of_the_shard_that_falls():
    r = np.random.default_rng(2)
    shares = []
    for n in (1000, 4000, 16000):
        x = r.normal(size=(n, 16))
        q = np.arange(0, n, 50)
        found, looked = ann.search(_scores(x), x[q], q, 5)
        u = ann.unit(x)
        s = u[q] @ u.T
        s[np.arange(len(q)), q] = -9
        want = {(int(q[i]), j) for i, w in enumerate(np.argsort(-s, axis=1)[:, :5].tolist()) for j in w}
        assert len(want & {(i, j) for i, j, _ in found}) / len(want) > 0.97
        shares.append(looked / len(q) / n)
    assert shares[0] > 1.5 * shares[1] > 2.5 * shares[2] and shares[2] < 0.15


# HTML


def test_html_main_text():
    page = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy now</div><div id="cookie-notice">We use cookies</div><article><header>by line</header><h1>Head &amp; line</h1><p><b>One\n two<br><p>Three &lt; four &#233; &eacute;</p><form><p>Mail</p></form><ul><li>x<li>y</ul></article><section class="comments"><p>First! A long comment, of many words, by a reader of the page.</p></section><aside>side</aside><footer>&copy; foot</footer></body></html>'
    assert htmltext.main_text(page) == "Head & line\n\nOne two\n\nThree < four é é\n\nx\n\ny"
    assert htmltext.main_text(None) == htmltext.main_text("") == htmltext.main_text("<nav>only</nav>") == ""
    assert htmltext.main_text("plain  text") == "plain text"
    assert htmltext.main_text("<article><p>cut <b") == "cut"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<html><head><title>x</title><p>one", "one"),
        ("<div class='wrap has-sidebar'><main><p>one</main><div id=sidebar>two</div></div>", "one"),
        ("<article><p>one</article><article class='comment-body'><p>two two two</article>", "one"),
        ("<div><p>one, one one one one</div><div class='commentList'>two</div><div id=cookieBanner>three</div>", "one, one one one one"),
        ("<!--><p>one</p><!-- two -->", "one"),
        ("a<b>b</i>c</b><li>x<li>y<ul><li>z</ul>", "abc\n\nx\n\ny\n\nz"),
    ],
)
def test_html_malformed(page, want):
    assert htmltext.main_text(page) == want


@pytest.mark.parametrize("page", ["<div>" * 50_000, "<b>" * 50_000 + "</i>" * 50_000, "<p><b>" * 30_000, "<ul><li>" * 30_000, "<article>" * 30_000])
def test_html_deep(page):
    assert htmltext.main_text(page + "x") == "x"


def test_html_density_without_article():
    para = "<p>" + "some words of the story go on and on, " * 8 + "</p>"
    menu = "".join(f'<li><a href="/{i}">link {i}</a></li>' for i in range(30))
    page = f'<body><div class="x"><ul>{menu}</ul></div><div><div class="story"><h2>Head</h2>{para * 5}</div><div><a href="/more">more</a> <a href="/m">and more</a></div></div></body>'
    got = htmltext.main_text(page).split("\n\n")
    assert got[0] == "Head" and len(got) == 6


STORY = "some words of the story go on and on, " * 6


@pytest.mark.parametrize("wrapper", ['class="has-sidebar"', 'class="content with-sidebar"', 'class="layout-side"', 'id="no-sidebar"', 'class="page-with-sidebar"', 'class="social-science"', 'class="content side-by-side"', 'id="legal"', 'class="sidebar"'])
def test_html_names_give_way_to_content(wrapper):
    story = STORY.strip()
    for text in (f"<article><p>{story}</p></article>", f"<p>{story}</p>"):
        assert htmltext.main_text(f'<body><div {wrapper}>{text}<div class="sidebar">other things</div></div></body>') == story
        assert htmltext.main_text(f'<body><div {wrapper}>{text}</div><div class="comments"><p>{story * 9}</p></div></body>') == story


def test_html_names_never_speak_for_a_part_of_several_words():
    assert htmltext.main_text(f'<body><article><p>{STORY}</p><div class="social-science"><p>two</p></div></article></body>').endswith("\n\ntwo")
    for name in ("cookie-banner", "site_footer", "shareButtons", "related-posts", "ad ad-slot-2", "newsletter-signup"):
        assert htmltext.main_text(f'<body><div><p>{STORY}</p><p>{STORY}</p></div><div class="{name}"><p>{STORY * 6}</p></div></body>') == "\n\n".join([STORY.strip()] * 2)
    assert htmltext.main_text(f'<body><div class="comments"><p>{STORY}</p></div></body>') == ""


def test_html_menus_inside_articles_go():
    menu = "".join(f'<li><a href="/{i}">link {i}</a></li>' for i in range(30))
    assert htmltext.main_text(f'<body><article><h1>T</h1><p>{STORY}</p><ul>{menu}</ul><p>Short.</p><ul><li>x<li>see <a>y</a></ul></article></body>') == f"T\n\n{STORY.strip()}\n\nShort.\n\nx\n\nsee y"
    assert htmltext.main_text(f"<body><p>a few words</p><ul>{menu}</ul></body>") == "a few words"
    assert htmltext.main_text(f"<body><div><p>a few words</p><ul>{menu}</ul></div></body>") == "a few words"


def _tree(r, depth=0):
    """A random page as (tag, children)."""
    say = lambda n: " ".join(r.choice(["river", "the", "a", "under", "stone,", "went."]) for _ in range(n))
    leaf = r.random()
    if depth > 3 or leaf < 0.3:
        return ("p", [say(r.randrange(1, 60)), ("b", [say(2)]), say(r.randrange(3))] if r.random() < 0.5 else [say(r.randrange(1, 60))])
    if leaf < 0.45:
        return ("ul", [("li", [("a", [say(r.randrange(1, 4))])] + ([say(9)] if r.random() < 0.1 else [])) for _ in range(r.randrange(1, 9))])
    if leaf < 0.55:
        return ("h2", [say(3)])
    tag = "article" if r.random() < 0.2 else r.choice(["div", "section"])
    return (tag, [_tree(r, depth + 1) for _ in range(r.randrange(1, 6))] + ([say(r.randrange(12)), ("a", [say(1)])] if r.random() < 0.2 else []))


def _brute_text(body):
    """Composite text density by its definition, each figure counted anew for each node."""
    kids = lambda n: [k for k in n[1] if not isinstance(k, str)]
    below = lambda n: [n] + [x for k in kids(n) for x in below(k)]
    chars = lambda n: sum(len(k.strip()) if isinstance(k, str) else chars(k) for k in n[1])
    linked = lambda n: chars(n) if n[0] == "a" else sum(map(linked, kids(n)))
    count = lambda n, tag=None: sum(x is not n and tag in (None, x[0]) for x in below(n))
    block = lambda n: any(x[0] not in ("a", "b") for x in below(n))
    blocks = lambda n: [k for k in kids(n) if block(k)]
    runs = lambda n: sum(len(k.strip()) if isinstance(k, str) else chars(k) - linked(k) for k in n[1] if isinstance(k, str) or not block(k))
    root = ("html", [body])

    def density(n):
        c, lc = chars(n), linked(n)
        if c <= lc:
            return 0.0
        base = math.log(c / (c - lc) * lc + linked(root) / chars(root) * c + math.e)
        return c / max(1, count(n)) * max(0.0, math.log(c / max(1, lc) * max(1, count(n)) / max(1, count(n, "a")))) / max(1.0, math.log(base))

    total = lambda n: sum(map(density, blocks(n))) + runs(n) if blocks(n) else density(n)
    plain = lambda n: sum(map(plain, blocks(n))) + runs(n) if blocks(n) else 0 if linked(n) or n[0] == "h2" else chars(n)
    menu = lambda n: block(n) and count(n, "a") >= 3 and linked(n) >= 0.8 * chars(n) and not plain(n)
    open_ = lambda n: [n] + [x for k in kids(n) if chars(k) and not menu(k) for x in open_(k)]
    best = max([x for x in open_(body) if x is body or block(x)], key=total)

    def way(n):
        return [n] if n is best else next(([n, *w] for k in kids(n) if (w := way(k))), [])

    path = way(body)
    floor = min((density(x) for x in path if density(x) > 0), default=0.0)
    first = next((k for k, x in enumerate(path) if x[0] == "article"), len(path))
    out = [[]]

    def write(n):
        if menu(n):
            return
        edge = n[0] not in ("a", "b")
        out.extend([[]] * edge)
        if edge:
            out[-1] = []
        for k in n[1]:
            out[-1].append(k) if isinstance(k, str) else write(k)
        if edge:
            out.append([])

    def visit(n, on, beside):
        if n is best:
            return write(n) if n is not body else [out[-1].append(k) if isinstance(k, str) else write(k) for k in n[1]]
        if not any(n is x for x in path):
            if not chars(n) or menu(n):
                return None
            if beside or density(n) >= floor and (on or n[0] == "article") or on and n[0] == "h2":
                return write(n)
            return [visit(k, False, False) for k in blocks(n)]
        inside = path.index(n) >= first
        run = []
        for k in [*n[1], None]:
            if k is not None and (isinstance(k, str) or not block(k)):
                run.append(k)
                continue
            if run and (inside or sum(len(x.strip()) if isinstance(x, str) else chars(x) - linked(x) for x in run) >= max(1.0, floor)):
                out.append([])
                for x in run:
                    out[-1].append(x) if isinstance(x, str) else write(x)
                out.append([])
            run = []
            if k is not None:
                visit(k, True, inside)

    visit(body, False, False)
    return "\n\n".join(x for b in out if (x := " ".join("".join(b).split())))


def test_html_density_matches_brute_force():
    show = lambda n: f"<{n[0]}>" + "".join(k if isinstance(k, str) else show(k) for k in n[1]) + f"</{n[0]}>"
    article = 0
    for seed in range(150):
        r = random.Random(seed)
        body = ("body", [_tree(r) for _ in range(r.randrange(1, 6))])
        page = show(body)
        article += "<article>" in page
        assert htmltext.main_text(page) == _brute_text(body), seed
    assert 20 < article < 140


def test_html_odd_rows(spark):
    given = [(1, "u", None, 0), (1, "u", None, 0), (2, None, "", 0), (None, "v", f"<p>{STORY}</p>", 7), (3, "w", f"<p>{STORY * 4000}</p>", 1), (3, "w", "<p>\ud7ff \U0001F600 x</p>", 1)]
    df = spark.createDataFrame(given, "page_id long, url string, html string, text int")
    got = rows(htmltext.extract(df), "page_id", "url", "text", "n_chars")
    want = [(i, u, t, len(t)) for i, u, t in [(1, "u", ""), (1, "u", ""), (2, None, ""), (None, "v", STORY.strip()), (3, "w", (STORY * 4000).strip()), (3, "w", "\ud7ff \U0001F600 x")]]
    assert got == sorted(want, key=str)
    assert htmltext.extract(df.where("false")).count() == 0


def test_html_keeps_shorter_marked_parts():
    para = lambda n: "<p>" + "some words of the story go on and on, " * 8 + f"{n}</p>"
    menu = "".join(f'<li><a href="/{i}">link {i}</a></li>' for i in range(30))
    page = f'<body><ul>{menu}</ul><article>{"".join(map(para, range(12)))}</article><div><div><article>{para(12)}{para(13)}</article></div></div><div>{para(14)}</div></body>'
    assert [x.split()[-1] for x in htmltext.main_text(page).split("\n\n")] == list(map(str, range(15)))


def test_html_query_keeps_articles(spark):
    import html as h

    pages = {r["page_id"]: r["html"] for r in common.table(spark, SF, "pages").collect()}
    for r in queries.op5_html_text(spark, SF).collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(h.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


# mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: k % 3 + 1 for k, s in enumerate(order)}
    full, target = set(), {}
    total = sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        target = {s: 3.0 * sizes[s] for s in full} | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            return target
        full |= set(over)


def check_mix(got, texts, sources):
    size = lambda t: len((t or "").encode().split())
    sizes = Counter()
    for (_, t), s in zip(texts, sources, strict=True):
        sizes[s] += size(t)
    target = brute_targets(sizes)
    assert len(got) == len(texts)
    taken, largest = Counter(), Counter()
    by = defaultdict(list)
    for (i, t), s in zip(texts, sources, strict=True):
        by[i].append((s, size(t)))
        largest[s] = max(largest[s], size(t))
    for r in got:
        s = next(s for s, n in by[r["doc_id"]] if n == r["size"])
        assert abs(r["target"] - target[s]) < 1e-6 * max(1, target[s]) and r["source_size"] == sizes[s]
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] + 1, s


def test_mixing_targets_and_rounding(spark, monkeypatch):
    r = random.Random(1)
    sources = [r.choice(["hot"] * 9 + ["b", "c", "dd", None, "é"]) for _ in range(800)] + ["zero", "tiny"]
    texts = [(i, " ".join(["w"] * r.choice([0, 1, 5, 30, 400]))) for i in range(800)] + [(900, None), (901, "one")]
    d = docs(spark, texts, sources)
    monkeypatch.setattr(mixing, "LEAF", 16)
    first, again = mixing.mix(d).collect(), mixing.mix(d.repartition(7)).collect()
    check_mix(first, texts, sources)
    assert sorted(map(str, first)) == sorted(map(str, again))
    assert mixing.mix(d.where("false")).count() == 0
    twice = d.union(d.where("doc_id = 3")).union(docs(spark, [(None, "a b"), (2**62 + 1, "c d")], ["hot", "hot"]))
    ids = [x["doc_id"] for x in mixing.mix(twice).collect()]
    assert ids.count(3) == 2 and None in ids and 2**62 + 1 in ids


def test_mixing_spreads_one_repeated_id(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 16)
    monkeypatch.setattr(mixing, "COPIES", 50)
    texts = [(7, "a b c")] * 330 + [(None, "a b")] * 120 + [(i, "w " * (i % 9)) for i in range(100, 650)]
    sources = ["hot"] * 450 + ["b", "c"] * 275
    d = docs(spark, texts, sources)
    got = mixing.mix(d).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in texts)
    check_mix(got, texts, sources)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(d.repartition(5)).collect()))
    # no group holds the whole of it
    each = mixing._each(spark.createDataFrame([(7, "hot", 3, 330)], "id long, source string, size long, m long"))
    keys = [r["key"] % (330 // 16) for r in each.collect()]
    assert len(keys) == 330 and max(Counter(keys).values()) < 48


def test_pivot_keeps_words_and_expectation():
    size, x0 = np.array([5.0, 3, 8, 1, 1, 2]), np.array([0.3, 0.5, 0.25, 0.9, 0.1, 0.6])
    mean, r = np.zeros(6), np.random.default_rng(0)
    for _ in range(4000):
        x = x0.copy()
        at = mixing.pivot(size, x, r.random(6))
        assert abs(size @ x - size @ x0) < 1e-9
        assert all(v in (0.0, 1.0) for i, v in enumerate(x) if i != at)
        mean += x
    assert np.abs(mean / 4000 - x0).max() < 0.05


# quality


def test_quality_against_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r["keep"] for r in queries.op7_quality(spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in common.table(spark, sf, "labels").collect()}
    bad = [got[i] for i, q in labels.items() if q == 0]
    good = [got[i] for i, q in labels.items() if q == 1]
    assert len(got) == 1000 and np.mean(bad) < 0.05 and np.mean(good) > 0.98


def test_quality_odd_rows(spark):
    clean = "The river, that rose in the night, fell by noon. Then people went back to the fields. "
    texts = [(i, clean + " ".join(words(40, i)) + ".") for i in range(60)] + [(100 + i, "BUY NOW!! " * 20) for i in range(15)] + [(200, None), (201, ""), (202, clean * 3000), (None, clean), (1, clean)]
    d = docs(spark, texts)
    got = quality.classify(d).collect()
    assert len(got) == len(texts)
    keep = quality.drop_rejected(d)
    assert keep.columns == d.columns and {r["doc_id"] for r in got if r["keep"]} >= set(range(60))
    assert not {r["doc_id"] for r in got if r["keep"]} & set(range(100, 115))
    assert quality.classify(d.where("false")).count() == 0 and quality.drop_rejected(d.where("false")).count() == 0


def test_quality_sample_is_the_same_with_one_id(spark):
    texts = [(None if k % 2 else 7, " ".join(words(20, k // 3)) + ".") for k in range(300)]
    d = docs(spark, texts)
    a, b = (quality.fit(x, fit_rows=40) for x in (d, d.repartition(5)))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.labels.table, b.labels.table)


def _plain_statistics(text):
    """The labellers' figures from their description, a letter and a word at a time."""
    data = (text or "").encode()
    w = data.split()
    if not w:
        return [0, 0, 0, 1, 0, 1, 0, 0, 0]
    low, up, wide = (sum(f(c) for c in data) for f in (lambda c: 97 <= c <= 122, lambda c: 65 <= c <= 90, lambda c: c > 127))
    sym, space, marks = (sum(c in x for c in data) for x in (b"#$%&*+<=>@[\\]^_`{|}~!", b" \t\n\r\x0b\x0c", b".,"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    pairs = {(a, b) for a, b in zip(w, w[1:], strict=False)}
    return [up / max(1, low + up + wide // 2), sym / max(1, len(data) - space), len(set(w)) / len(w), Counter(w).most_common(1)[0][1] / len(w), sum(a == b for a, b in zip(w, w[1:], strict=False)) / len(w), len(set(lines)) / max(1, len(lines)), len(pairs) / (len(w) - 1) if len(w) > 1 else 1.0, marks / len(w), math.log(len(w))]


def _plain_em(patterns, rounds=200):
    """EM a document at a time, over dictionaries."""
    m = len(quality.LABELLERS)
    prior, table = 0.8, [[[0.3, 0.1, 0.6], [0.01, 0.3, 0.69]] for _ in range(m)]

    def good(p):
        g, b = prior, 1 - prior
        for j, v in enumerate(p):
            g, b = g * table[j][1][v], b * table[j][0][v]
        return g / (g + b)

    for _ in range(rounds):
        post = [good(p) for p in patterns]
        new = [[[0.5] * 3 for _ in range(2)] for _ in range(m)]
        for p, g in zip(patterns, post, strict=True):
            for j, v in enumerate(p):
                new[j][1][v] += g
                new[j][0][v] += 1 - g
        for j in range(m):
            for y in range(2):
                t = sum(new[j][y])
                new[j][y] = [x / t for x in new[j][y]]
            over = max(0.0, new[j][1][quality.JUNK] - quality.FALSE_ALARMS)
            new[j][1][quality.JUNK] -= over
            new[j][1][quality.ABSTAIN] += over
        moved = max(abs(a - b) for x, y in zip(new, table, strict=True) for r, s in zip(x, y, strict=True) for a, b in zip(r, s, strict=True))
        prior, table = min(0.99, max(0.01, sum(post) / len(post))), new
        if moved < 1e-6:
            break
    return [good(p) for p in patterns], table


def test_quality_against_brute_force(spark):
    d = common.table(spark, SF, "documents")
    texts = [r["text"] for r in d.collect()]
    assert np.allclose([quality.statistics(t) for t in texts], [_plain_statistics(t) for t in texts])
    patterns = [quality.votes(_plain_statistics(t)) for t in texts]
    post, table = _plain_em(patterns)
    model = quality.fit(d)
    assert np.allclose(model.labels.table, table, atol=1e-6)
    assert np.allclose(model.labels.posterior(np.array(patterns)), post, atol=1e-4)
    # the scorer: at the optimum of its loss, and as the query says
    x = np.stack([quality.features(t, quality.statistics(t)) for t in texts]).astype(float)
    p = np.array([1 / (1 + math.exp(-(sum(a * b for a, b in zip(row, model.weights, strict=False)) + model.weights[-1]))) for row in x])
    slope = np.append(x.T @ (p - post) / len(p), (p - post).mean())
    assert np.abs(slope).max() < 0.01
    got = {r["doc_id"]: r for r in quality.classify(d).collect()}
    assert all(abs(got[r["doc_id"]]["quality_score"] - p[k]) < 1e-6 and got[r["doc_id"]]["keep"] == (p[k] >= 0.5) for k, r in enumerate(d.collect()) if abs(p[k] - 0.5) > 1e-6)


def test_em_recovers_labellers():
    r = np.random.default_rng(0)
    y = r.random(20000) < 0.8
    votes = np.full((20000, len(quality.LABELLERS)), quality.ABSTAIN)
    for j in range(7):
        votes[:, j] = np.where(~y & (r.random(20000) < 0.4), quality.JUNK, quality.ABSTAIN)
    votes[:, 7] = np.where(y & (r.random(20000) < 0.9), quality.GOOD, quality.ABSTAIN)
    u, n = np.unique(votes, axis=0, return_counts=True)
    m = quality.fit_labels(u, n.astype(float))
    assert abs(m.prior - 0.8) < 0.02 and np.abs(m.table[:7, quality.JUNK, quality.JUNK] - 0.4).max() < 0.03


# chat


CHATS = "conv_id long, turn long, role string, text string, turns int, formatted string"


def test_chat_round_trip(spark):
    odd = ["", None, "</s>", "<s>", "[INST]", "[/INST]", "<\\s>", "[\\\\/INST]", "\\", "<", "a<s", "s>", "[/INST]</s><s>user[INST]", "<<s>>", "x" * 200000, "é\n\t ", "$1 \\2"]
    given = [(1, k, ["user", "assistant", "<s>", None][k % 4], t, 0, "") for k, t in enumerate(odd)]
    given += [(2, None, "assistant", "b", 0, ""), (2, 1, "assistant", "z", 0, ""), (2, 1, "assistant", "a", 0, ""), (2, 1, "assistant", "a", 0, ""), (None, 0, "user", "hi", 0, "")]
    df = spark.createDataFrame(given, CHATS)
    f = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.digests(f).collect()}
    by = defaultdict(list)
    for c, t, role, text, *_ in given:
        by[c].append(((t is not None, t or 0, role or "", text or "")))
    for c, turns in by.items():
        turns.sort()
        whole = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        assert (got[c]["n_turns"], got[c]["loss_chars"]) == (len(turns), len(loss))
        assert got[c]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest() and got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    for r in f.collect():
        shown, texts = r["formatted"], [x for _, _, who, x in by[r["conv_id"]] if who == "assistant"]
        assert len(shown) == got[r["conv_id"]]["formatted_chars"] and len(texts) == len(r["loss"])
        back = lambda x: re.sub(r"([<\[])\\(\\*)(/?(?:s>|INST\]))", r"\1\2\3", x)
        assert [back(shown[x["start"] : x["end"]]) for x in r["loss"]] == texts
        assert [back(shown.encode()[x["from"] : x["upto"]].decode()) for x in r["loss"]] == texts
    assert chat.format_conversations(df.where("false")).count() == 0


# tokens


ODD_TEXTS = [None, "", " ", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "<|endoftext|", "it's we'll I'M", "  two  spaces \n\n x\t\ty ", "中文 日本語 한국어", " nbsp　wide line", "é é ß İ", "😀👩‍👩‍👧 🇫🇷", "١٢٣ ½ ² Ⅷ", "a" * 50000, "\x00\x1c\x85", "ab " * 40000, "𞤀𞤁 ᲀ ꟊ", "'s's 'S", "<|startoftext|>a <|ENDOFTEXT|> b</w>", "▁a <s> </s> <unk>"]


def library_counts(path, texts):
    if path.endswith(".model"):
        import sentencepiece

        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    return [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k.json", "pattern"), ("word_bpe_49k.json", "library"), ("piece_bpe_32k.model", "whole")])
def test_token_counts_equal_the_library(spark, monkeypatch, name, kind):
    path = tokens.tokenizer_path(name)
    assert tokens.Splitter(path).kind == kind
    monkeypatch.setattr(tokens, "BLOCK", 5)
    texts = list(enumerate(ODD_TEXTS)) + [(3, "x"), (None, "y z"), (3, "x")]
    n = library_counts(path, [t or "" for _, t in texts])
    want = Counter((i, len((t or "").encode()), k, k > 1024) for (i, t), k in zip(texts, n, strict=True))
    d = docs(spark, texts).repartition(3)
    for held in (0, 200, 1 << 20):
        monkeypatch.setattr(tokens, "HEAD_BYTES", held)
        assert Counter(tuple(r) for r in tokens.token_counts(d, path=path).collect()) == want, held
    assert tokens.token_counts(d.where("false")).count() == 0


def test_token_counts_of_the_documents(spark, monkeypatch):
    monkeypatch.setattr(tokens, "SAMPLE_ROWS", 20)
    d = [(r["doc_id"], r["text"] or "") for r in common.table(spark, SF, "documents").collect()]
    want = Counter(zip((i for i, _ in d), library_counts(tokens.tokenizer_path(), [t for _, t in d]), strict=True))
    assert Counter((r["doc_id"], r["n_tokens"]) for r in queries.op9_tokens(spark, SF).collect()) == want


# SimHash


def brute_fingerprint(text):
    import xxhash

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    g = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    return [find(a) for a in range(len(fps))]


def check_simhash(got, texts):
    fps = [brute_fingerprint(t) for _, t in texts]
    root = brute_components(fps)
    least = {}
    for (i, _), r in zip(texts, root, strict=True):
        least[r] = min((x for x in (i, least.get(r)) if x is not None), default=None)
    want = Counter((i, f"{f:016x}", least[r]) for (i, _), f, r in zip(texts, fps, root, strict=True))
    assert Counter(got) == want


def near_texts():
    base = [" ".join(words(n, n)) for n in (30, 120, 400, 900)]
    texts = []
    for k in range(160):
        w = base[k % 4].split()
        if k % 3:
            w[k % len(w)] = f"new{k}"
        texts.append((1000 - k, " ".join(w)))
    return texts + [(5, None), (6, ""), (7, " \n"), (8, "One"), (9, "one"), (10, "a B"), (11, "É x y z"), (11, "É x y z"), (None, base[0]), (None, "lone words here now"), (12, "v " * 60000)]


def test_simhash_matches_brute_force(spark):
    texts = near_texts()
    got = simhash.near_duplicates(docs(spark, texts)).select("doc_id", simhash.hex_fingerprint(F.col("fingerprint")), "component_id")
    check_simhash([tuple(r) for r in got.collect()], texts)
    assert simhash.near_duplicates(docs(spark, []).where("false")).count() == 0


def test_simhash_spreads_common_fingerprints(spark, monkeypatch):
    """With every fingerprint common, and with none, the rows are the same."""
    texts = near_texts() + [(k, "one and the same text") for k in range(2000, 2300)] + [(None, "one and the same text")] * 40
    for few in (10**9, 1):
        monkeypatch.setattr(simhash, "HOT", few)
        got = simhash.near_duplicates(docs(spark, texts).repartition(3)).select("doc_id", simhash.hex_fingerprint(F.col("fingerprint")), "component_id")
        check_simhash([tuple(r) for r in got.collect()], texts)


def test_simhash_links_are_exact(spark):
    r = np.random.default_rng(5)
    base = r.integers(-(2**63), 2**63, 40)
    fps = set(base.tolist()) | {0, -1, 1, 7, 15, -(2**63)}
    for b in base.tolist():
        for n in (1, 2, 3, 4, 5):
            x = b & (2**64 - 1)
            for bit in r.choice(64, n, replace=False).tolist():
                x ^= 1 << bit
            fps.add(x - 2**64 if x >= 2**63 else x)
    fps = sorted(fps)
    want = {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    got = {tuple(x) for x in simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()}
    assert got == want and len(want) > 100


def test_simhash_drop_keeps_one_of_each(spark):
    texts = near_texts()
    d = docs(spark, texts)
    kept = simhash.drop_near_duplicates(d)
    assert kept.columns == d.columns
    want = {r["component_id"] for r in simhash.near_duplicates(d).collect()}
    got = [r["doc_id"] for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_simhash_drop_keeps_one_row_of_each_component(spark):
    a, b, c, e = (" ".join(words(60, k)) for k in (1, 2, 3, 4))
    d = docs(spark, [(3, a), (5, a), (5, b), (5, b), (5, c), (None, c), (None, e), (None, e), (None, None), (6, e + " ")])
    want = [(3, a), (5, b), (5, c), (6, e + " "), (None, None)]
    assert rows(simhash.drop_near_duplicates(d.repartition(3)), "doc_id", "text") == sorted(want, key=str)


# pipeline


def test_stages_keep_columns_of_any_name(spark):
    """Columns that are named like the operators' own helpers pass through as they are."""
    odd = ["__n", "__fp", "__score", "__bad", "__key", "quality_score", "kept_id", "Kept_Key", "text_key", "leak_id", "leak_key", "key", "row", "fp"]
    text = "The river, that rose in the night, fell by noon. Then people went back to the fields, and so on. "
    given = [(k, text + " ".join(words(30, k % 7)) + ".", "en", "s", 0, *range(k, k + len(odd))) for k in range(20)]
    d = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in odd))
    items = spark.createDataFrame([(1, " ".join(words(30, 3)))], "item_id long, text string")
    for out in (quality.drop_rejected(d), simhash.drop_near_duplicates(d), decontaminate.drop_contaminated(d, items)):
        assert out.columns == d.columns and out.count()
        assert {tuple(r) for r in out.collect()} <= set(given)
    assert decontaminate.drop_contaminated(d, items).count() == 17


def test_pipeline_stages(spark):
    import corpus_pipeline

    before = common.table(spark, SF, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        after = common.staged(stage(spark, before, SF), "test")
        seen[name] = (before, after)
        before = after
    names = [n for n, _ in corpus_pipeline.STAGES]
    for n in names[:-1]:
        assert seen[n][0].columns == seen[n][1].columns
    ids = lambda df: [r["doc_id"] for r in df.select("doc_id").collect()]
    a, b = seen[names[0]]
    assert set(ids(b)) == {r["doc_id"] for r in quality.classify(a).collect() if r["keep"]} and len(ids(b)) < len(ids(a))
    texts = [(r["doc_id"], r["text"]) for r in b.collect()]
    fps = [brute_fingerprint(t) for _, t in texts]
    least = {}
    for (i, _), r in zip(texts, brute_components(fps), strict=True):
        least[r] = min(i, least.get(r, i))
    assert sorted(ids(seen[names[1]][1])) == sorted(least.values())
    a, b = seen[names[2]]
    items = [(r["item_id"], r["text"]) for r in common.table(spark, SF, "benchmark").collect()]
    bad = {x[0] for x in brute_contamination([(r["doc_id"], r["text"]) for r in a.collect()], items)}
    assert set(ids(b)) == set(ids(a)) - bad
    a, b = seen[names[3]]
    r = a.collect()
    check_mix(b.collect(), [(x["doc_id"], x["text"]) for x in r], [x["source"] for x in r])
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, b.collect()))


# against SQL


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in "documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    r = c.execute(queries.oracle_sql()[name])
    cols = [x[0] for x in r.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(cols) == sorted(df.columns)
    text = lambda v: v if not isinstance(v, float) else f"{v:.9g}"
    assert sorted(str([text(v) for v in x]) for x in df.select(*cols).collect()) == sorted(str([text(v) for v in x]) for x in r.fetchall())


def test_op_queries_return_every_row(spark):
    n = {t: common.table(spark, SF, t).count() for t in ("pages", "documents")}
    for name in ("op1_warc", "op5_html_text"):
        assert queries.queries()[name](spark, SF).count() == n["pages"]
    for name in ("op6_mixing", "op9_tokens", "op10_simhash"):
        assert queries.queries()[name](spark, SF).count() == n["documents"]
    texts = [(r["doc_id"], r["text"]) for r in common.table(spark, SF, "documents").collect()]
    check_simhash([tuple(r) for r in queries.op10_simhash(spark, SF).select("doc_id", "fingerprint", "component_id").collect()], texts)
