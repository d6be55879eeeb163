"""Approximate nearest neighbours by largest inner product: a robust-pruned directed graph per shard.

Equal vectors are one point with its smallest ids, so that copies can't crowd a graph or a
result. Points are dealt to bands of like length (a factor of at most BAND) and, by a hash, to shards of bounded
size inside a band. In its shard, each point, scaled to length 1, is inserted in batches: greedy beam searches on the graph so far
propose neighbours, relaxed distance pruning keeps those not much nearer to a kept one than to the point, and kept links get their
reverse. A second pass goes over all points with the complete graph. Every query runs a
beam search on every shard, by the inner product itself (vectors scaled by the shard's longest one); each shard's nearest are merged
by exact scores.

A beam is as wide as the shard needs: when its graph is made, some of its own points are asked and compared with
all points, and the beam is doubled until it finds enough of their nearest.

Defined results: vectors that are null, all zero, or hold null or non-finite components take no
part; a null id neither asks nor is found; vectors of another length than the query's are
not compared with it; repeated rows of one id and vector are found once; fewer candidates than k give them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from qualia.llm.shared import ship, staged

#: Points in a shard; links of a point; width of the beam when building and when asking; slack of the pruning.
SHARD_POINTS = 16384
DEGREE, BUILD_BEAM, ALPHA = 32, 64, 1.2
#: Largest ratio of two lengths of a band; points asked to set a shard's beam, nearest that count, share of them to be found.
BAND, PROBES, PROBE_K, PROBE_RECALL = 1.25, 64, 20, 0.97
#: Queries searched side by side, and rows of the salted first ranking.
BATCH = 512
#: Queries that meet a graph in one task.
QUERY_BLOCK = 8192
SALTS = 64


def beam_search(vectors: np.ndarray, links: np.ndarray, norms: np.ndarray, entries: np.ndarray, queries: np.ndarray, width: int,
                expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances) of the ``width`` nearest points seen for each query, nearest first; -1 where none."""
    n, b = len(vectors), len(queries)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True
    q_norm = np.einsum("ij,ij->i", queries, queries)
    start = np.broadcast_to(entries, (b, len(entries)))
    seen[:, entries] = True
    dist = norms[entries][None, :] + q_norm[:, None] - 2 * queries @ vectors[entries].T
    ids = np.full((b, width + 1), n, np.int64)
    d = np.full((b, width + 1), np.inf, np.float32)
    m = min(len(entries), width)
    order = np.argsort(dist, axis=1)[:, :m]
    ids[:, :m] = np.take_along_axis(start, order, 1)
    d[:, :m] = np.take_along_axis(dist, order, 1)
    ids, d = ids[:, :width], d[:, :width]
    done = ~np.isfinite(d)
    live = np.arange(b)
    while len(live):
        open_ = ~done[live]
        some = open_.any(1)
        live = live[some]
        if not len(live):
            break
        open_ = open_[some]
        rank = np.cumsum(open_, 1)
        pick = open_ & (rank <= expand)
        done[live] |= pick
        row, col = np.nonzero(pick)
        nodes = np.full((len(live), expand), n, np.int64)
        nodes[row, rank[row, col] - 1] = ids[live[row], col]
        near = links[nodes].reshape(len(live), -1)
        near = np.sort(near, axis=1)
        twice = np.zeros(near.shape, bool)
        twice[:, 1:] = near[:, 1:] == near[:, :-1]
        near[twice | seen[live[:, None], near]] = n
        seen[live[:, None], near] = True
        dot = np.matmul(vectors[np.minimum(near, n - 1)], queries[live][:, :, None])[:, :, 0]
        new = norms[np.minimum(near, n - 1)] + q_norm[live][:, None] - 2 * dot
        new[near == n] = np.inf
        all_ids = np.concatenate([ids[live], near], 1)
        all_d = np.concatenate([d[live], new], 1)
        all_done = np.concatenate([done[live], ~np.isfinite(new)], 1)
        order = np.argpartition(all_d, width - 1, axis=1)[:, :width]
        part = np.take_along_axis(all_d, order, 1)
        order = np.take_along_axis(order, np.argsort(part, axis=1), 1)
        ids[live] = np.take_along_axis(all_ids, order, 1)
        d[live] = np.take_along_axis(all_d, order, 1)
        done[live] = np.take_along_axis(all_done, order, 1)
    return np.where(np.isfinite(d), ids, -1), d


def robust_prune(vectors: np.ndarray, norms: np.ndarray, point: np.ndarray, cand: np.ndarray, dist: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each point up to ``degree`` of its candidates (-1: none): the nearest left is kept, and those that it is nearer
    to, by the factor alpha, than the point are dropped."""
    n, m = cand.shape
    dist = np.where((cand < 0) | (cand == point[:, None]), np.inf, dist)
    v = vectors[np.maximum(cand, 0)]
    c_norm = norms[np.maximum(cand, 0)]
    kept = np.full((n, degree), len(vectors), np.int64)
    row = np.arange(n)
    for k in range(degree):
        best = dist.argmin(1)
        ok = np.isfinite(dist[row, best])
        if not ok.any():
            break
        kept[ok, k] = cand[row[ok], best[ok]]
        p = v[row, best]
        between = c_norm + c_norm[row, best][:, None] - 2 * np.matmul(v, p[:, :, None])[:, :, 0]
        drop = alpha * alpha * between <= dist
        dist[drop & ok[:, None]] = np.inf
        dist[row, best] = np.inf
    return kept


class Graph:
    """Directed graph over the rows of ``vectors`` (all different)."""

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 7):
        self._place(vectors)
        n = len(vectors)
        self.links = np.full((n + 1, degree), n, np.int64)
        self.degree = degree
        middle = self.vectors.mean(0) if n else np.zeros(1)
        self.entries = np.array([int(np.argmin(self.norms - 2 * self.vectors @ middle))] if n else [], np.int64)
        order = np.random.default_rng(seed).permutation(n)
        order = np.concatenate([self.entries, order[order != self.entries]]) if n else order
        for a in (1.0, alpha):
            at = 1 if a == 1.0 else 0
            while at < n:  # early batches are small: their points must find each other
                size = min(BATCH, max(1, at)) if a == 1.0 else BATCH
                self._insert(order[at:at + size], beam, a)
                at += size

    def _place(self, vectors: np.ndarray) -> None:
        """vectors: unit ones for the graph; scaled: those that are asked, the longest of length 1."""
        most = np.abs(vectors).max(1, initial=0, keepdims=True)  # first, so that no square overflows or vanishes
        length = most * np.sqrt(np.square(vectors / most).sum(1, keepdims=True))
        self.vectors = (vectors / most / np.sqrt(np.square(vectors / most).sum(1, keepdims=True))).astype(np.float32)
        self.scaled = (self.vectors * (length / length.max(initial=0))).astype(np.float32)
        self.norms = np.einsum("ij,ij->i", self.vectors, self.vectors)

    @classmethod
    def load(cls, vectors: np.ndarray, links: np.ndarray, entry: int) -> "Graph":
        g = cls.__new__(cls)
        g._place(vectors)
        g.links, g.degree, g.entries = links.astype(np.int64), links.shape[1], np.array([entry])
        return g

    def _insert(self, points: np.ndarray, beam: int, alpha: float) -> None:
        n = len(self.vectors)
        cand, dist = beam_search(self.vectors, self.links, self.norms, self.entries, self.vectors[points], beam)
        old = self.links[points]
        old_d = self._distances(points, old)
        near, near_d = np.concatenate([cand, np.where(old < n, old, -1)], 1), np.concatenate([dist, old_d], 1)
        self.links[points] = robust_prune(self.vectors, self.norms, points, near, near_d, self.degree, alpha)
        # reverse links: those of one target together
        got = self.links[points]
        src = np.repeat(points, self.degree)[(got < n).ravel()]
        dst = got[got < n]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        targets, first, count = np.unique(dst, return_index=True, return_counts=True)
        for lo in range(0, len(targets), BATCH):
            t, f, c = targets[lo:lo + BATCH], first[lo:lo + BATCH], count[lo:lo + BATCH]
            more = np.full((len(t), int(c.max())), n, np.int64)
            r = np.repeat(np.arange(len(t)), c)
            k = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            more[r, k] = src[np.repeat(f, c) + k]
            both = np.sort(np.concatenate([self.links[t], more], 1), axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = n
            both = np.sort(both, axis=1)
            size = (both < n).sum(1)
            fits = size <= self.degree
            width = min(self.degree, both.shape[1])
            self.links[t[fits], :width] = both[fits, :width]
            over = np.flatnonzero(~fits)
            if len(over):
                c2 = both[over][:, :int(size[over].max())]
                self.links[t[over]] = robust_prune(self.vectors, self.norms, t[over], np.where(c2 < n, c2, -1), self._distances(t[over], c2), self.degree, alpha)

    def _distances(self, points: np.ndarray, others: np.ndarray) -> np.ndarray:
        n = len(self.vectors)
        o = np.minimum(others, n - 1)
        d = self.norms[points][:, None] + self.norms[o] - 2 * np.matmul(self.vectors[o], self.vectors[points][:, :, None])[:, :, 0]
        return np.where(others < n, d, np.inf)

    def nearest(self, queries: np.ndarray, width: int) -> np.ndarray:
        """Rows of the ``width`` largest inner products found for each query (-1: none)."""
        out = []
        q = queries / np.abs(queries).max(1, initial=1e-300, keepdims=True)
        q = (q / np.sqrt(np.square(q).sum(1, keepdims=True))).astype(np.float32)  # a query's length changes no order
        for lo in range(0, len(q), BATCH):
            out.append(beam_search(self.scaled, self.links, np.zeros(len(self.scaled), np.float32), self.entries, q[lo:lo + BATCH], width)[0])
        return np.concatenate(out) if out else np.zeros((0, width), np.int64)

    def width(self, least: int, seed: int = 11) -> int:
        """The beam with which points of this graph find enough of their nearest, ``least`` at least."""
        n = len(self.vectors)
        asked = np.random.default_rng(seed).permutation(n)[:PROBES]
        exact = np.argsort(-(self.scaled[asked] @ self.scaled.T), axis=1, kind="stable")[:, :PROBE_K]
        width = least
        while width < n:
            found = self.nearest(self.scaled[asked], width)
            if np.mean([np.isin(e, f).mean() for e, f in zip(exact, found)]) >= PROBE_RECALL:
                break
            width *= 2
        return min(width, max(n, least))


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v: doubles) of the rows that take part."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = "id is not null and v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)"
    return v.where(fine).distinct()


def points(rows: DataFrame, k: int) -> DataFrame:
    """(digest, v, ids): different vectors with their k + 1 smallest ids, ascending."""
    rows = rows.withColumn("digest", F.xxhash64("v"))
    few = W.partitionBy("digest", "v", "salt").orderBy("id")
    some = rows.withColumn("salt", F.pmod("id", F.lit(SALTS))).withColumn("r", F.row_number().over(few)).where(f"r <= {k + 1}")
    return some.groupBy("digest", "v").agg(F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("ids"))  # at most SALTS * (k + 1) ids


GRAPH = "dim int, shard long, vectors binary, links binary, entry int, width int, ids array<array<long>>"


def _builder(k: int, width: int):
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        """The graph of one shard as one row."""
        v = np.stack(part["v"].to_numpy())
        g = Graph(v)
        return _row(key, part, v, g, g.width(max(width, k + 1)))
    return run


def _row(key: tuple, part: pd.DataFrame, v: np.ndarray, g: Graph, width: int) -> pd.DataFrame:
    return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "vectors": [v.tobytes()], "links": [g.links.astype(np.int32).tobytes()],
                         "entry": [int(g.entries[0])], "width": [width], "ids": [[list(map(int, x)) for x in part["ids"]]]})


def _searcher(k: int):
    def run(key: tuple, graphs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """One graph and one block of queries."""
        found = [pd.DataFrame({"query_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64"), "ids": pd.Series(dtype=object)})]
        if len(graphs) and len(asked):
            row = graphs.iloc[0]
            v = np.frombuffer(row["vectors"], np.float64).reshape(-1, int(row["dim"]))
            ids = np.empty(len(v), object)
            ids[:] = [list(x) for x in row["ids"]]
            least = np.array([x[0] for x in ids])
            g = Graph.load(v, np.frombuffer(row["links"], np.int32).reshape(len(v) + 1, -1), int(row["entry"]))
            q = np.stack(asked["v"].to_numpy())
            ask_id = asked["id"].to_numpy()
            for lo in range(0, len(q), BATCH):
                near = g.nearest(q[lo:lo + BATCH], int(row["width"]))
                r, c = np.nonzero(near >= 0)
                p = near[r, c]
                with np.errstate(over="ignore", invalid="ignore"):
                    score = np.einsum("ij,ij->i", v[p], q[lo + r])
                # best first; each query's first k + 1 points hold its first k answers of this shard
                by = np.lexsort((least[p], -score, r))
                r, p, score = r[by], p[by], score[by]
                most = np.arange(len(r)) - np.searchsorted(r, r) <= k
                found.append(pd.DataFrame({"query_id": ask_id[lo + r[most]], "score": score[most], "ids": ids[p[most]]}))
        return pd.concat(found)
    return run


def search(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, width: int = 128,
           shard_points: int = SHARD_POINTS) -> DataFrame:
    """(query_id, rank, id, score): for each row of ``queries`` its k nearest found in ``vectors``, itself left out."""
    spark = vectors.sparkSession
    ship(spark)
    base = staged(points(clean(vectors, id_col, vector_col), k), "ann-points")
    # bands of like length: the largest component first, so that no square overflows or vanishes
    most = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.col("_most")) * (x / F.col("_most")))
    base = base.withColumns({"dim": F.size("v"), "_most": most}).withColumn("band", F.floor((F.log("_most") + F.log(squares) / 2) / float(np.log(BAND)))).drop("_most")
    bands = base.groupBy("dim", "band").agg(F.expr(f"count(*) div {shard_points} + 1").alias("shards"))  # a row for each band
    dealt = base.join(bands, ["dim", "band"]).withColumn("shard", F.xxhash64("band", F.pmod(F.xxhash64("v", F.lit("shard")), F.col("shards"))))
    graphs = staged(dealt.select("dim", "shard", "v", "ids").groupBy("dim", "shard").applyInPandas(_builder(k, width), GRAPH), "ann-graphs")
    asked = clean(queries, id_col, vector_col)
    blocks = asked.count() // QUERY_BLOCK + 1
    asked = asked.withColumns({"dim": F.size("v"), "block": F.pmod(F.xxhash64("id"), F.lit(blocks))})
    asked = asked.join(graphs.selectExpr("dim _d", "shard _s"), F.col("dim") == F.col("_d")).selectExpr("id", "v", "dim", "_s shard", "block")
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    key = ["dim", "shard", "block"]
    found = held.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(_searcher(k), "query_id long, score double, ids array<long>")
    each = found.select("query_id", "score", F.explode("ids").alias("id")).where("id <> query_id")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return each.withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}").select("query_id", "rank", "id", "score")
