"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard,
stored as flat neighbour arrays, whose results are merged.

Nodes enter a graph in batches: a batch is looked up in the graph that stands, by a descent
through the upper levels and a beam on its own, so a build costs about n log n. Nodes of
higher levels enter first; a level is then the first so many nodes, and its neighbours one
array of as many rows. Distances are of differences of unit vectors, which keep near copies
apart; what a beam ends with is scored in double precision on the original vectors before
anything is cut."""

from __future__ import annotations

import io
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_dir, open_store, staged

#: Bytes of unit vectors in a shard, and its nodes, at most.
SHARD_BYTES = 64 << 20
SHARD = 131072
#: A table is cut into at least as many shards as there are cores while they hold so many.
LEAST = 8192
#: Links of a node (twice as many on the ground), nodes a beam keeps when building, nodes
#: that enter together, and queries in a block.
LINKS = 16
WIDTH = 64
BATCH = 512
BLOCK = 4096
#: Nodes of a beam opened in one step.
STEP = 4
SEED = 3


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that neither very
    large nor very small ones lose it."""
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def levels(keys: np.ndarray, links: int = LINKS) -> np.ndarray:
    """Level of each node: geometric with ratio 1/links, drawn from its key's hash."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53
    return np.floor(-np.log(np.maximum(u, 1e-12)) / np.log(links)).astype(int)


def _apart(x: np.ndarray, q: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of each q to the nodes of its row; infinite where there is none."""
    d = x[np.maximum(at, 0)]
    d -= q[:, None, :]
    return np.where(at >= 0, np.einsum("ijk,ijk->ij", d, d), np.inf)


def _by_distance(x: np.ndarray, q: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = _apart(x, q, at)
    order = np.argsort(d, axis=1, kind="stable")
    return np.take_along_axis(at, order, 1), np.take_along_axis(d, order, 1)


def _choose(x: np.ndarray, at: np.ndarray, dist: np.ndarray, links: int) -> np.ndarray:
    """Of each row's candidates, nearest first, those nearer to the node than to any chosen
    one; the rest is filled up with the nearest."""
    m, c = at.shape
    v = x[np.maximum(at, 0)]
    sq = np.einsum("ijk,ijk->ij", v, v)
    between = sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    least = np.full((m, c), np.inf, x.dtype)
    chosen, count = np.zeros((m, c), bool), np.zeros(m, int)
    for j in range(c):
        ok = (at[:, j] >= 0) & (count < links) & (least[:, j] > dist[:, j])
        chosen[:, j], count = ok, count + ok
        r = np.flatnonzero(ok)
        least[r] = np.minimum(least[r], between[r, j])
    rank = np.arange(c) + np.where(chosen, 0, c) + np.where(at >= 0, 0, 4 * c)
    return np.take_along_axis(at, np.argsort(rank, axis=1, kind="stable")[:, :links], 1)


def _beam(x: np.ndarray, graph: np.ndarray, q: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """(nodes, looked at): the ``width`` nearest nodes that each query finds from its start,
    -1 where fewer, and how many nodes it took on the whole. All queries step together."""
    m, n = len(q), len(x)
    width = min(width, n)
    step = min(STEP, width)
    nodes, dist = np.full((m, width), -1, np.int32), np.full((m, width), np.inf, x.dtype)
    open_, seen = np.zeros((m, width), bool), np.zeros((m, n), bool)
    nodes[:, 0], dist[:, :1], open_[:, 0] = start, _apart(x, q, start[:, None]), True
    seen[np.arange(m), start] = True
    active, looked = np.arange(m), m
    while True:
        d = np.where(open_[active], dist[active], np.inf)
        j = np.argpartition(d, step - 1, axis=1)[:, :step]
        good = np.take_along_axis(d, j, 1) < np.inf
        going = good.any(1)
        active, j, good = active[going], j[going], good[going]
        if not len(active):
            return nodes, looked
        rows = active[:, None]
        open_[rows, j] = False
        near = graph[nodes[rows, j]]
        near[~good] = -1
        near = near.reshape(len(active), -1)
        near = np.sort(np.where((near >= 0) & ~seen[rows, near], near, -1), axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(fresh)
        at = near[r, c]
        seen[active[r], at] = True
        looked += len(r)
        diff = x[at]
        diff -= q[active[r]]
        more = np.full(near.shape, np.inf, x.dtype)
        more[r, c] = np.einsum("ij,ij->i", diff, diff)
        every = np.concatenate([dist[active], more], 1)
        keep = np.argpartition(every, width - 1, axis=1)[:, :width]
        dist[active] = np.take_along_axis(every, keep, 1)
        nodes[active] = np.take_along_axis(np.concatenate([nodes[active], np.where(fresh, near, -1)], 1), keep, 1)
        open_[active] = np.take_along_axis(np.concatenate([open_[active], fresh], 1), keep, 1)


def _descend(x: np.ndarray, graphs: list, q: np.ndarray, to: int) -> np.ndarray:
    """The node where each query's greedy walk down to above level ``to`` ends."""
    at = np.zeros(len(q), int)
    for l in range(len(graphs) - 1, to, -1):
        at = _beam(x[: len(graphs[l])], graphs[l], q, at, 1)[0][:, 0]
    return at


def _link_back(x: np.ndarray, graph: np.ndarray, new: np.ndarray, first: int) -> None:
    """Links from the chosen neighbours back to the nodes that entered; a full list is thinned."""
    most = graph.shape[1]
    r, c = np.nonzero(new >= 0)
    to, back = new[r, c], (first + r).astype(np.int32)
    diff = x[to] - x[back]
    order = np.lexsort((np.einsum("ij,ij->i", diff, diff), to))
    to, back = to[order], back[order]
    head = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
    group = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(to)]))
    place = np.arange(len(to)) - head[group]
    few = place < most
    more = np.full((len(head), most), -1, np.int32)
    more[group[few], place[few]] = back[few]
    for s in range(0, len(head), BATCH):
        hubs = to[head[s : s + BATCH]]
        both = np.sort(np.concatenate([graph[hubs], more[s : s + BATCH]], 1), axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        both, d = _by_distance(x, x[hubs], both)
        kept, full = both[:, :most].copy(), both[:, most] >= 0
        if full.any():
            kept[full] = _choose(x, both[full], d[full], most)
        graph[hubs] = kept


def build(x: np.ndarray, sizes: list[int], links: int = LINKS, width: int = WIDTH) -> list[np.ndarray]:
    """Neighbour arrays, one row a node (-1: none), of each level of the graph over unit
    vectors ``x``; level l holds the first sizes[l] nodes.

    A batch's candidates on a level are what its beam finds there and the nearest of the
    batch itself; they are thinned so that links spread, linked both ways, and thinned again
    to twice ``links`` on the ground and ``links`` above. The last two links of a node go
    to those that entered before and after it: no node is out of reach."""
    graphs: list = [None] * len(sizes)
    for l in range(len(sizes) - 1, -1, -1):
        n, most = sizes[l], 2 * links if l == 0 else links
        graph = np.full((n, most), -1, np.int32)
        upper = sizes[l + 1] if l + 1 < len(sizes) else 0
        a = 0
        while a < n:
            b = min(n, a + min(BATCH, max(64, a)))
            b = upper if a < upper < b else b
            q, m = x[a:b], b - a
            peers = q @ q.T
            np.fill_diagonal(peers, -9)
            k = min(m - 1, links)
            found = [a + np.argpartition(-peers, k - 1, axis=1)[:, :k]] if k else []
            if a:
                start = _descend(x, graphs, q, l) if a >= upper else np.zeros(m, int)
                found.append(_beam(x[:a], graph[:a], q, start, width)[0])
            if found:
                at, d = _by_distance(x, q, np.concatenate(found, 1).astype(np.int32))
                new = _choose(x, at, d, links - 2)
                graph[a:b, : new.shape[1]] = new
                _link_back(x, graph[:, : most - 2], new, a)
            graph[max(a, 1) : b, -1], graph[max(a, 1) - 1 : b - 1, -2] = np.arange(max(a, 1) - 1, b - 1), np.arange(max(a, 1), b)
            a = b
        graphs[l] = graph
    return graphs


def width_of(nodes: int) -> int:
    """Nodes a search's beam keeps: it grows as the root of the shard, which directions of
    many dimensions need for the same recall."""
    return max(WIDTH, int(1.25 * nodes**0.5))


def _put(root: str, name: str, **arrays: np.ndarray) -> str:
    """Write arrays as a file of the shared folder; its name is this attempt's own."""
    store, base = open_store(root)
    buffer = io.BytesIO()
    np.savez(buffer, **arrays)
    name = f"{name}-{os.urandom(12).hex()}.npz"
    with store.open_output_stream(f"{base}/{name}", compression=None) as f:
        f.write(buffer.getbuffer())
    return f"{root}/{name}"


def _get(path: str) -> dict[str, np.ndarray]:
    store, name = open_store(path)
    with store.open_input_file(name) as f, np.load(io.BytesIO(f.read())) as z:
        return {k: z[k] for k in z.files}


def _build(root: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v, ids = np.vstack(pdf["vec"].to_numpy()).astype(np.float64), pdf["id"].to_numpy("int64")
        u = unit(v)
        _, first, node = np.unique((u + 0.0).view(np.dtype((np.void, 8 * u.shape[1]))).ravel(), return_index=True, return_inverse=True)
        least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(least, node, ids)
        level = levels(least)
        order = np.lexsort((least, -level))
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        rows = np.lexsort((ids, place[node]))
        ends = np.cumsum(np.bincount(place[node], minlength=len(order)))
        x = u[first[order]].astype(np.float32)
        graphs = build(x, [int((level >= l).sum()) for l in range(int(level.max()) + 1)])
        path = _put(root, f"shard-{pdf['dim'].iloc[0]}-{pdf['shard'].iloc[0]}", x=x, vectors=v[rows], ids=ids[rows], ends=ends, sizes=np.array([len(g) for g in graphs]), neighbours=np.concatenate([g.ravel() for g in graphs]))
        return pd.DataFrame({"sdim": [int(pdf["dim"].iloc[0])], "spath": [path], "nodes": [len(x)]})

    return run


def _pack(root: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        path = _put(root, "queries", vectors=np.vstack(pdf["vec"].to_numpy()).astype(np.float64), ids=pdf["id"].to_numpy("int64"))
        return pd.DataFrame({"qdim": [int(pdf["dim"].iloc[0])], "qpath": [path]})

    return run


def _levels_of(shard: dict[str, np.ndarray]) -> list[np.ndarray]:
    out, at = [], 0
    for l, n in enumerate(shard["sizes"].tolist()):
        most = LINKS if l else 2 * LINKS
        out.append(shard["neighbours"][at : at + n * most].reshape(n, most))
        at += n * most
    return out


def search(shard: dict[str, np.ndarray], queries: np.ndarray, query_ids: np.ndarray, k: int, width: int | None = None) -> tuple[list[tuple[int, int, float]], int]:
    """((query, id, score) of the ``k`` best that each query finds in a shard, nodes looked
    at). The whole beam is scored in double precision on the original vectors and ordered
    by score, then id, before it is cut."""
    graphs, x = _levels_of(shard), shard["x"]
    v, ids, ends = shard["vectors"], shard["ids"], shard["ends"]
    starts, size = np.r_[0, ends[:-1]], np.sqrt((v**2).sum(1))
    out, looked = [], 0
    for s in range(0, len(queries), BATCH):
        q, own = queries[s : s + BATCH], query_ids[s : s + BATCH]
        u = unit(q)
        nodes, n = _beam(x, graphs[0], u.astype(np.float32), _descend(x, graphs, u.astype(np.float32), 0), max(k + 1, width or width_of(len(x))))
        looked += n
        for i in range(len(q)):
            at = nodes[i][nodes[i] >= 0]
            rows = np.concatenate([np.arange(starts[a], ends[a]) for a in at.tolist()])
            rows = rows[ids[rows] != own[i]]
            c = v[rows]
            with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                score = c @ q[i] / (size[rows] * np.sqrt((q[i] ** 2).sum()))
            odd = ~np.isfinite(score)
            if odd.any():  # lengths beyond the range of doubles
                score[odd] = unit(c[odd]) @ u[i]
            best = np.lexsort((ids[rows], -score))[:k]
            out += zip([int(own[i])] * len(best), ids[rows[best]].tolist(), score[best].tolist(), strict=True)
    return out, looked


def _search(k: int, width: int | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, shard = "", {}
        for pdf in batches:
            for spath, qpath in pdf[["spath", "qpath"]].itertuples(index=False):
                if spath != at:
                    at, shard = spath, _get(spath)
                q = _get(qpath)
                found, _ = search(shard, q["vectors"], q["ids"], k, width)
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<double>) of the vectors that take part: not null, not empty, no null,
    NaN or infinite component, not all zero; null ids don't, either."""
    v = F.col(vec_col).cast("array<double>")
    ok = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vec", lambda x: x != 0)
    return rows.select(F.col(id_col).cast("long").alias("id"), v.alias("vec")).where("id is not null and size(vec) > 0").where(F.coalesce(ok, F.lit(False)))


def _direction(vec) -> F.Column:
    """A hash of the unit vector; multiples of a vector by powers of two share it."""
    top = F.aggregate(vec, F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))
    scaled = F.transform(vec, lambda x: x / top)
    # -0.0 hashes as 0.0
    return F.xxhash64(F.transform(scaled, lambda x: x + F.lit(0.0)))


def index(rows: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """(sdim, spath, nodes): a file a shard in the shared folder, with vectors, ids and the
    graph as flat arrays. Vectors of one direction are one node, and of those with equal
    directions only the k + 1 smallest ids are kept, as no other can be among k results
    with ties to smaller ids; so a vector that a third of all rows share is one node. Shards
    are hashes of the direction and hold one dimension each."""
    spark = rows.sparkSession
    v = usable(rows, id_col, vec_col).distinct().withColumn("dim", F.size("vec")).withColumn("h", _direction(F.col("vec")))
    # equal directions only: a hash that two share costs nothing, as both are kept apart by their vectors' ratio
    top = F.aggregate("vec", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))
    v = v.withColumn("way", F.transform("vec", lambda x: x / top + F.lit(0.0)))
    few = v.withColumn("n", F.row_number().over(Window.partitionBy("h", "way").orderBy("id"))).where(F.col("n") <= k + 1)
    nodes = staged(few.select("id", "vec", "dim", "h"), "ann-nodes")
    n, dims = nodes.agg(F.count("*"), F.max("dim")).first()
    most = max(1, min(shard, SHARD_BYTES // (8 * (dims or 1))))
    shards = max(1, -(-n // most), min(spark.sparkContext.defaultParallelism, -(-n // LEAST)))
    parted = nodes.select("id", "vec", "dim", F.pmod("h", F.lit(shards)).cast("int").alias("shard"))
    root = fresh_dir(spark, "ann")
    store, path = open_store(root)
    store.create_dir(path, recursive=True)
    return staged(parted.groupBy("dim", "shard").applyInPandas(_build(root), "sdim int, spath string, nodes long"), "ann-index")


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", shard: int = SHARD, width: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found by cosine for each row of
    ``queries`` (id, vector) among ``rows`` without the query's own id, nearest first,
    ties to smaller ids; all of them if there are fewer. Vectors that are null or zero
    or hold null or non-finite components take no part on either side; vectors of other
    dimensions are no candidates. Repeated rows count once; empty tables give none.

    Every block of queries meets every shard of its dimension, each pair in a task of its
    own that reads both from the shared folder: no vector is shuffled for the search."""
    spark = rows.sparkSession
    shards = index(rows, k, id_col, vec_col, shard)
    q = usable(queries, id_col, vec_col).distinct()
    q = q.withColumn("dim", F.size("vec")).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-q.count() // BLOCK)))).cast("int"))
    root = fresh_dir(spark, "ann-queries")
    store, path = open_store(root)
    store.create_dir(path, recursive=True)
    blocks = staged(q.groupBy("dim", "block").applyInPandas(_pack(root), "qdim int, qpath string"), "ann-blocks")
    pairs = staged(blocks.join(shards, F.col("qdim") == F.col("sdim")).select("spath", "qpath"), "ann-pairs")
    work = pairs.repartition(max(1, min(pairs.count(), 100_000))).sortWithinPartitions("spath")
    found = work.mapInPandas(_search(k, width), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
