"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Vectors are dealt to shards by a hash of their id. Within a shard, equal
vectors share one node. Inner products are turned into distances by one more
coordinate, sqrt(longest**2 - |x|**2), which is zero for queries, so that the
graph is built in a metric space. Each layer is a flat array of neighbour
numbers (-1: none); layer l holds the first ``counts[l]`` nodes. Every query is
searched in every shard and the shards' results are merged: queries are written
once as files of vectors, and each task reads those files beside one shard.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import fsio
from .common import run_dir, spread, written


def _distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its own candidates: x is (queries, candidates, dims)."""
    d = x - q[:, None, :]
    return np.einsum("qcd,qcd->qc", d, d)


def _spread(cand: np.ndarray, dist: np.ndarray, x: np.ndarray, keep: int) -> np.ndarray:
    """Neighbour choice: nearest first, skipping one that is closer to a chosen neighbour than to the node; gaps are filled by the nearest skipped.

    ``cand`` (rows, candidates) sorted by ``dist``; -1 marks none.
    """
    rows, width = cand.shape
    vec = x[np.maximum(cand, 0)]
    norm = np.einsum("rcd,rcd->rc", vec, vec)
    apart = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(vec, vec.transpose(0, 2, 1))
    chosen = np.zeros((rows, width), bool)
    barred = cand < 0
    near = np.full((rows, width), np.inf, np.float32)  # distance to the closest chosen neighbour
    count = np.zeros(rows, np.int64)
    for j in range(width):
        ok = ~barred[:, j] & (dist[:, j] <= near[:, j]) & (count < keep)
        chosen[:, j] = ok
        count += ok
        np.minimum(near, np.where(ok[:, None], apart[:, j], np.inf), out=near)
    order = np.argsort(np.where(barred, 2, np.where(chosen, 0, 1)), axis=1, kind="stable")[:, :keep]
    out = np.take_along_axis(cand, order, 1)
    if out.shape[1] < keep:
        out = np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)
    return out


@dataclass
class Graph:
    """One shard's graph: search coordinates and flat neighbour arrays, top layer last."""

    x: np.ndarray
    counts: list[int]
    layers: list[np.ndarray]

    def _beam(self, layer: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int, at_once: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of a block of queries; returns node numbers and distances, nearest first."""
        rows, n = len(q), len(self.x)
        seen = np.zeros((rows, n), bool)
        ids = np.full((rows, width), -1, np.int64)
        dist = np.full((rows, width), np.inf, np.float32)
        opened = np.ones((rows, width), bool)
        ids[:, 0] = entry
        dist[:, 0] = _distances(self.x[entry][:, None, :], q)[:, 0]
        opened[:, 0] = False
        seen[np.arange(rows), entry] = True
        act = np.arange(rows)
        while len(act):
            closed = np.where(opened[act], np.inf, dist[act])
            pick = np.argpartition(closed, min(at_once, width) - 1, axis=1)[:, :at_once] if width > at_once else np.tile(np.arange(width), (len(act), 1))
            live = np.isfinite(np.take_along_axis(closed, pick, 1))
            go = live.any(1)
            act, pick, live = act[go], pick[go], live[go]
            if not len(act):
                break
            opened[act[:, None], pick] = True
            nodes = np.where(live, ids[act[:, None], pick], -1)
            near = np.where(nodes[:, :, None] >= 0, layer[np.maximum(nodes, 0)], -1).reshape(len(act), -1).astype(np.int64)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            fresh = (near >= 0) & ~seen[act[:, None], np.maximum(near, 0)]
            r, c = np.nonzero(fresh)
            got = near[r, c]
            seen[act[r], got] = True
            d = np.full(near.shape, np.inf, np.float32)
            diff = self.x[got] - q[act[r]]
            d[r, c] = np.einsum("nd,nd->n", diff, diff)
            all_d = np.concatenate((dist[act], d), 1)
            all_i = np.concatenate((ids[act], np.where(fresh, near, -1)), 1)
            all_o = np.concatenate((opened[act], ~fresh), 1)
            best = np.argpartition(all_d, width - 1, axis=1)[:, :width]
            ids[act], dist[act], opened[act] = (np.take_along_axis(a, best, 1) for a in (all_i, all_d, all_o))
        order = np.argsort(dist, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)

    def search(self, q: np.ndarray, width: int, down_to: int = 0, at_once: int = 4, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and distances found by each query, ``width`` of them, -1 and infinity where there are fewer."""
        out = []
        for a in range(0, len(q), block):
            part = q[a : a + block]
            entry = np.zeros(len(part), np.int64)
            for layer in self.layers[:down_to:-1]:
                entry = self._beam(layer, part, entry, 1, 1)[0][:, 0]
            out.append(self._beam(self.layers[down_to], part, entry, width, at_once))
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def build(x: np.ndarray, links: int = 16, width: int = 64, batch: int = 256) -> Graph:
    """Graph over the rows of ``x``, which are in insertion order (random order).

    Node i reaches layer l if i < n / links**l, so a layer is a prefix of the
    order. Layers are built from the top; a layer's first nodes (those of the
    layer above) are linked by exact distances, the others are inserted in
    batches, each found by a beam search of the nodes before it and compared
    with its own batch.
    """
    x = np.ascontiguousarray(x, np.float32)
    n = len(x)
    counts = [n]
    while counts[-1] > links:
        counts.append(max(1, counts[-1] // links))
    graph = Graph(x, counts, [])
    graph.layers = [np.zeros((0, 0), np.int32)] * len(counts)
    for level in range(len(counts) - 1, -1, -1):
        size, keep = counts[level], links * 2 if level == 0 else links
        layer = np.full((size, keep), -1, np.int32)
        graph.layers[level] = layer
        done = min(size, max(counts[level + 1] if level + 1 < len(counts) else size, min(size, batch)))
        for a in range(0, done, batch):
            own = x[a : min(a + batch, done)]
            d = (own**2).sum(1)[:, None] + (x[:done] ** 2).sum(1)[None] - 2 * own @ x[:done].T
            d[np.arange(len(d)), a + np.arange(len(d))] = np.inf
            top = min(done, width)
            pick = np.argpartition(d, top - 1, axis=1)[:, :top]
            pick = np.take_along_axis(pick, np.argsort(np.take_along_axis(d, pick, 1), axis=1), 1)
            dist = np.take_along_axis(d, pick, 1)
            layer[a : a + len(d)] = _spread(np.where(np.isfinite(dist), pick, -1), dist, x, keep)
        _link_back(layer, x, np.arange(done))
        while done < size:
            new = np.arange(done, min(size, done + batch))
            ids, dist = graph.search(x[new], width, level)
            own = (x[new] ** 2).sum(1)[:, None] + (x[new] ** 2).sum(1)[None] - 2 * x[new] @ x[new].T
            np.fill_diagonal(own, np.inf)
            some = min(len(new), keep)
            pick = np.argpartition(own, some - 1, axis=1)[:, :some]
            ids = np.concatenate((ids, new[pick]), 1)
            dist = np.concatenate((dist, np.take_along_axis(own, pick, 1)), 1)
            order = np.argsort(dist, axis=1, kind="stable")[:, : width]
            ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
            layer[new] = _spread(np.where(np.isfinite(dist), ids, -1), dist, x, keep)
            _link_back(layer, x, new)
            done = int(new[-1]) + 1
    return graph


def _link_back(layer: np.ndarray, x: np.ndarray, new: np.ndarray) -> None:
    """Add the reverse of the links of ``new``; nodes with too many links choose again."""
    keep = layer.shape[1]
    src = np.repeat(new, keep)
    dst = layer[new].ravel()
    src, dst = src[dst >= 0], dst[dst >= 0].astype(np.int64)
    if not len(dst):
        return
    # (node, neighbour) pairs, old and new, without repeats
    touched = np.unique(dst)
    old = layer[touched]
    a = np.concatenate((np.repeat(touched, keep)[old.ravel() >= 0], dst))
    b = np.concatenate((old.ravel()[old.ravel() >= 0].astype(np.int64), src))
    pair = np.unique(a * len(x) + b)
    a, b = pair // len(x), pair % len(x)
    diff = x[a] - x[b]
    d = np.einsum("nd,nd->n", diff, diff)
    order = np.lexsort((b, d, a))
    a, b, d = a[order], b[order], d[order]
    first = np.searchsorted(a, touched)
    place = np.arange(len(a)) - first[np.searchsorted(touched, a)]
    wide = min(int(place.max()) + 1, 2 * keep)
    for at in range(0, len(touched), 512):  # bounded memory
        rows = touched[at : at + 512]
        lo, hi = np.searchsorted(a, [rows[0], rows[-1] + 1])
        part = slice(lo, hi)
        ok = place[part] < wide
        r = np.searchsorted(rows, a[part][ok])
        cand = np.full((len(rows), wide), -1, np.int64)
        dist = np.full((len(rows), wide), np.inf, np.float32)
        cand[r, place[part][ok]] = b[part][ok]
        dist[r, place[part][ok]] = d[part][ok]
        fits = (cand >= 0).sum(1) <= keep
        out = np.full((len(rows), keep), -1, np.int64)
        out[fits, : min(wide, keep)] = cand[fits, :keep]
        if (~fits).any():
            out[~fits] = _spread(cand[~fits], dist[~fits], x, keep)
        layer[rows] = out


def _augmented(x: np.ndarray) -> np.ndarray:
    norm = np.einsum("nd,nd->n", x, x)
    longest = norm.max(initial=0.0)
    scale = math.sqrt(longest) or 1.0
    return np.concatenate((x, np.sqrt(np.maximum(longest - norm, 0))[:, None]), 1) / scale


INDEX = "shard int, dims int, ids binary, owners binary, vectors binary, counts binary, neighbours array<binary>"


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, dims): rows with a non-null id whose vector is not null, empty or zero and has only finite components."""
    good = "v is not null and forall(v, c -> c is not null and not isnan(c) and abs(c) < double('infinity')) and exists(v, c -> c <> 0)"
    out = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return out.where("id is not null").where(good).withColumn("dims", F.size("v"))


def build_index(rows: DataFrame, k: int, shards: int, links: int = 16, width: int = 64) -> DataFrame:
    """One row per shard and vector length: ids, vectors, layer sizes and flat neighbour arrays as packed binaries.

    ``rows`` is the result of ``usable``. Of equal vectors in a shard a node
    keeps the k + 1 smallest ids: with ties going to the smaller id, no other
    can be among a query's k nearest. ``owners`` is the node of each id.
    """

    def one(key, part):
        shard, dims = (c.as_py() for c in key)
        ids = part.column("id").to_numpy()
        x = part.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), dims)
        packed = np.ascontiguousarray(x + 0.0).view([("b", f"V{8 * dims}")]).ravel()
        _, code = np.unique(packed, return_inverse=True)
        order = np.lexsort((code, ids))
        ids, packed = ids[order], packed[order]
        first = np.concatenate(([True], ids[1:] != ids[:-1]))  # a repeated id counts once, with its first vector in byte order
        ids = ids[first]
        nodes, owner = np.unique(packed[first], return_inverse=True)
        x = nodes.view(np.float64).reshape(len(nodes), dims)
        shuffle = np.argsort([hashlib.blake2b(n.tobytes(), digest_size=8).digest() for n in nodes], kind="stable")
        place = np.empty(len(nodes), np.int64)
        place[shuffle] = np.arange(len(nodes))
        x, owner = x[shuffle], place[owner]
        by = np.lexsort((ids, owner))
        ids, owner = ids[by], owner[by]
        start = np.searchsorted(owner, np.arange(len(x)))
        held = np.arange(len(ids)) - start[owner] <= k
        ids, owner = ids[held], owner[held]
        g = build(_augmented(x), links, width)
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "dims": pa.array([dims], pa.int32()), "ids": [ids.astype("<i8").tobytes()], "owners": [owner.astype("<i8").tobytes()],
            "vectors": [x.astype("<f8").tobytes()], "counts": [np.array(g.counts, "<i8").tobytes()],
            "neighbours": pa.array([[layer.astype("<i4").tobytes() for layer in g.layers]], pa.list_(pa.binary())),
        })

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    return written(spread(dealt, "shard", "dims", rows=shards).groupBy("shard", "dims").applyInArrow(one, INDEX), "hnsw-index")


#: Files of queries that one task searches in a shard.
FILES_A_TASK = 4


def write_queries(queries: DataFrame, block: int = 16384) -> DataFrame:
    """Manifest (dims, uri, n) of files of at most about ``block`` queries of one vector length: ids, then vectors.

    ``queries`` is the result of ``usable``. A file is written once and read beside
    every shard, so vectors are not shuffled once a shard.
    """
    folder = f"{run_dir(queries.sparkSession)}/hnsw-queries"

    def one(key, part):
        dims = key[1].as_py()
        ids = part.column("id").to_numpy()
        x = part.column("v").combine_chunks().flatten().to_numpy()
        with fsio.create(folder, f"dims-{dims}", ".queries") as (uri, out):
            out.write(ids.astype("<i8").tobytes() + x.astype("<f8").tobytes())
        return pa.table({"dims": pa.array([dims], pa.int32()), "uri": [uri], "n": pa.array([len(ids)], pa.int64())})

    parts = max(1, -(-queries.count() // block))
    dealt = queries.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int"))
    files = spread(dealt, "part", "dims", rows=parts).groupBy("part", "dims").applyInArrow(one, "dims int, uri string, n long")
    return written(files, "hnsw-queries")


def search_index(index: DataFrame, files: DataFrame, k: int, shards: int, width: int = 128) -> DataFrame:
    """(query_id, vec_id, score): each shard's k nearest of every query, the query's own id excluded.

    ``files`` is the result of ``write_queries``. A work item is a shard and a few
    files of queries; only the shard's arrays and the files' names are shuffled.
    """

    def one(part):
        row = part.to_pylist()[0]
        dims = row["dims"]
        x = np.frombuffer(row["vectors"], "<f8").reshape(-1, dims)
        ids, owner = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["owners"], "<i8")
        first = np.searchsorted(owner, np.arange(len(x) + 1))
        counts = np.frombuffer(row["counts"], "<i8").tolist()
        layers = [np.frombuffer(b, "<i4").reshape(n, -1) for b, n in zip(row["neighbours"], counts, strict=True)]
        graph = Graph(_augmented(x).astype(np.float32), counts, layers)
        out = ([], [], [])
        for file in row["files"]:
            with fsio.reading(file["uri"]) as stream:
                raw = stream.read()
            qid = np.frombuffer(raw, "<i8", file["n"])
            q = np.frombuffer(raw, "<f8", file["n"] * dims, 8 * file["n"]).reshape(-1, dims)
            # a query's length does not change the order of its inner products: scale it to the data
            unit = q / np.sqrt(np.einsum("nd,nd->n", q, q))[:, None]
            flat = np.concatenate((unit, np.zeros((len(q), 1))), 1).astype(np.float32)
            found, _ = graph.search(flat, min(max(width, k + 1), len(x)))
            for i in range(len(q)):
                node = found[i][found[i] >= 0]
                s = np.einsum("nd,d->n", x[node], q[i])
                reps = first[node + 1] - first[node]
                at = np.repeat(first[node], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
                cid, cs = ids[at], np.repeat(s, reps)
                ok = cid != qid[i]
                cid, cs = cid[ok], cs[ok]
                top = np.lexsort((cid, -cs))[:k]
                out[0].append(np.full(len(top), qid[i]))
                out[1].append(cid[top])
                out[2].append(cs[top])
        return pa.table({"query_id": pa.array(np.concatenate(out[0])), "vec_id": pa.array(np.concatenate(out[1])), "score": pa.array(np.concatenate(out[2]))})

    n = files.count()
    groups = max(1, -(-n // FILES_A_TASK))
    by = files.groupBy("dims", F.pmod(F.xxhash64("uri"), F.lit(groups)).cast("int").alias("q_part")).agg(F.collect_list(F.struct("uri", "n")).alias("files"))
    items = index.join(by, "dims")
    return spread(items, "shard", "dims", "q_part", rows=shards * groups).groupBy("shard", "dims", "q_part").applyInArrow(one, "query_id long, vec_id long, score double")


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", links: int = 16, width: int = 160, shard_rows: int = 4096, min_shards: int = 12) -> DataFrame:
    """The k nearest candidates of every query by inner product.

    Returns (query_id, rank from 1, vec_id, score), ties in score to the
    smaller id; a query's own id is no candidate; fewer candidates than k give
    them all. Vectors that are null, empty, zero or hold null or non-finite
    components, and rows with a null id, take no part; vectors are compared
    with those of their own length. A repeated id counts once. Empty tables
    give an empty result; other columns are ignored.
    """
    rows = usable(candidates, id_col, vector_col)
    asked = usable(queries, id_col, vector_col).dropDuplicates(["id"])
    shards = max(min_shards, -(-rows.count() // shard_rows))
    found = search_index(build_index(rows, k, shards, links), write_queries(asked), k, shards, width)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
