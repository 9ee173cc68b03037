"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

A shard is a hash class of the distinct vectors, small enough for one task.  Its graph is
grown in batches: a greedy search over the graph so far proposes neighbours for the new
points, relaxed distance pruning keeps a diverse few, and the edges are mirrored.  Queries
are searched by beam in every shard; distances are then exact, in double precision.

Equal vectors are one node with its smallest ids: no more of them than asked for can ever
be among the nearest, so nothing is lost and no group of copies crowds a graph.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footings.session import truncate_lineage


@dataclass(frozen=True)
class Settings:
    shard_rows: int = 4096      # distinct vectors of a shard, about
    degree: int = 32            # edges kept per node
    beam: int = 64              # width of the beam, building and searching
    relax: float = 1.2          # an edge goes if another neighbour is this factor closer to its end
    batch: int = 256            # points added at once
    starts: int = 12            # entry points besides the most central one
    query_block: int = 512      # queries that are searched at once
    most_tasks: int = 20_000    # partitions that shards are dealt to


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _distances(points: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each row (n, d) to its own ids (n, k); missing ids are infinitely far."""
    difference = points[np.maximum(ids, 0)] - rows[:, None, :]
    found = np.einsum("nkd,nkd->nk", difference, difference)
    found[ids < 0] = np.inf
    return found


def beam_search(points: np.ndarray, edges: np.ndarray, starts: np.ndarray, rows: np.ndarray, beam: int,
                among: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy beam search for all rows at once: ids and squared distances of the beams, and the nodes expanded."""
    count = len(rows)
    seen = np.zeros((count, len(points)), bool)
    width = max(beam, len(starts))
    ids = np.full((count, width), -1, np.int32)
    ids[:, :len(starts)] = starts
    seen[:, starts] = True
    near = _distances(points, rows, ids)
    order = np.argsort(near, axis=1, kind="stable")
    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
    done = ids < 0
    path = []
    active = np.arange(count)
    while len(active):
        open_at = np.argmin(np.where(done[active], np.inf, near[active]), axis=1)
        going = ~done[active, open_at]
        active, open_at = active[going], open_at[going]
        if not len(active):
            break
        done[active, open_at] = True
        node = ids[active, open_at]
        expanded = np.full(count, -1, np.int32)
        expanded[active] = node
        path.append(expanded)
        fresh = edges[node]
        known = seen[active[:, None], np.maximum(fresh, 0)] | (fresh < 0)
        fresh = np.where(known, -1, fresh)
        rows_at, cols_at = np.nonzero(fresh >= 0)
        seen[active[rows_at], fresh[rows_at, cols_at]] = True
        distance = _distances(points, rows[active], fresh)
        all_ids = np.concatenate([ids[active], fresh], 1)
        all_near = np.concatenate([near[active], distance], 1)
        all_done = np.concatenate([done[active], fresh < 0], 1)
        order = np.argsort(all_near, axis=1, kind="stable")[:, :width]
        ids[active] = np.take_along_axis(all_ids, order, 1)
        near[active] = np.take_along_axis(all_near, order, 1)
        done[active] = np.take_along_axis(all_done, order, 1)
    return ids, near, np.stack(path, 1) if path else np.empty((count, 0), np.int32)


def robust_prune(points: np.ndarray, owners: np.ndarray, candidates: np.ndarray, settings: Settings) -> np.ndarray:
    """For each owner, `degree` of its candidates: the nearest first, skipping those a kept one is closer to."""
    kept = np.full((len(owners), settings.degree), -1, np.int32)
    step = max(1, 2_000_000 // max(1, candidates.shape[1] ** 2))
    for lo in range(0, len(owners), step):
        own, some = owners[lo:lo + step], candidates[lo:lo + step].copy()
        some[some == own[:, None]] = -1
        near = _distances(points, points[own], some)
        order = np.argsort(near, axis=1, kind="stable")
        some, near = np.take_along_axis(some, order, 1), np.take_along_axis(near, order, 1)
        vectors = points[np.maximum(some, 0)]
        square = np.einsum("nkd,nkd->nk", vectors, vectors)
        pairs = square[:, :, None] + square[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
        alive = np.isfinite(near)
        rows = np.arange(len(own))
        for slot in range(settings.degree):
            best = np.argmin(np.where(alive, near, np.inf), axis=1)
            some_left = alive[rows, best]
            if not some_left.any():
                break
            kept[lo + rows[some_left], slot] = some[rows[some_left], best[some_left]]
            covered = settings.relax ** 2 * pairs[rows, best] <= near
            alive &= ~(covered & some_left[:, None])
            alive[rows, best] = False
    return kept


def build_graph(points: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Edges (n, degree; missing: -1) and entry points of one shard."""
    count = len(points)
    center = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
    # With no more points than a beam holds, every search begins everywhere and is exact.
    spread = count if count <= settings.beam else settings.starts
    starts = np.unique(np.append(np.linspace(0, count - 1, spread).astype(np.int32), center)).astype(np.int32)
    edges = np.full((count, settings.degree), -1, np.int32)
    order = np.random.default_rng(1).permutation(np.setdiff1d(np.arange(count), starts))
    order = np.concatenate([starts, order]).astype(np.int32)
    at, size = 0, len(starts)
    while at < count:
        new = order[at:at + size]
        if at == 0:
            found = np.broadcast_to(new, (len(new), len(new)))
        else:
            ids, _, path = beam_search(points, edges, starts, points[new], settings.beam)
            found = np.concatenate([ids, path], 1)
        edges[new] = robust_prune(points, new, found, settings)
        _mirror(points, edges, new, settings)
        at, size = at + size, min(settings.batch, max(16, at + size))
    return edges, starts


def _mirror(points: np.ndarray, edges: np.ndarray, new: np.ndarray, settings: Settings) -> None:
    """Add the reverse of the new points' edges; nodes with too many are pruned again."""
    sources = np.repeat(new, settings.degree)
    targets = edges[new].ravel()
    sources, targets = sources[targets >= 0], targets[targets >= 0]
    if not len(targets):
        return
    order = np.argsort(targets, kind="stable")
    sources, targets = sources[order], targets[order]
    nodes, first, incoming = np.unique(targets, return_index=True, return_counts=True)
    wide = np.full((len(nodes), settings.degree + int(incoming.max())), -1, np.int32)
    wide[:, :settings.degree] = edges[nodes]
    row = np.repeat(np.arange(len(nodes)), incoming)
    wide[row, settings.degree + np.arange(len(targets)) - np.repeat(first, incoming)] = sources
    # A mirrored edge may be there already.
    wide.sort(axis=1)
    wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = -1
    degree = (wide >= 0).sum(1)
    fits = degree <= settings.degree
    wide = -np.sort(-wide, axis=1)
    edges[nodes[fits]] = wide[fits, :settings.degree]
    full = ~fits
    if full.any():
        edges[nodes[full]] = robust_prune(points, nodes[full], wide[full, :int(degree.max())], settings)


def distinct_vectors(vectors: DataFrame, keep: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per distinct usable vector: vector, ids (its `keep` smallest, ascending)."""
    rows = (vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"))
            .filter(F.col("id").isNotNull() & usable(F.col("vector"))).dropDuplicates(["id", "vector"]))
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    return (rows.withColumn("_rank", rank).filter(F.col("_rank") <= keep)
            .groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")))


def build_index(vectors: DataFrame, keep: int, settings: Settings = Settings(), key: str = "vec_id",
                vector: str = "embedding") -> DataFrame:
    """The graphs of all shards as rows: dim, shard, place, vector, ids, edges, start; written to the shared folder."""
    nodes = truncate_lineage(distinct_vectors(vectors, keep, key, vector))
    shards = max(1, math.ceil(nodes.count() / settings.shard_rows))
    nodes = nodes.select(F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"),
                         F.col("vector").cast("array<double>").alias("vector"), "ids")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ids", key=lambda c: c.map(lambda ids: ids[0]), ignore_index=True)
        points = Frame(np.stack(pdf["vector"].to_numpy())).points
        edges, starts = build_graph(points, settings)
        return pdf.assign(place=np.arange(len(pdf), dtype=np.int32), edges=list(edges), start=np.isin(np.arange(len(pdf)), starts))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, parts = None, []
        for pdf in frames:
            for found, some in pdf.groupby(["dim", "shard"]):
                if found != key and parts:
                    yield grow(pd.concat(parts))
                    parts = []
                key = found
                parts.append(some)
        if parts:
            yield grow(pd.concat(parts))

    grown = _dealt(nodes, shards, settings, "dim", "shard").mapInPandas(
        run, "dim int, shard int, vector array<double>, ids array<bigint>, place int, edges array<int>, start boolean")
    return truncate_lineage(grown)


class Frame:
    """A shard's vectors moved to their middle and scaled, so that neither offsets nor sizes cost digits or overflow."""

    def __init__(self, vectors: np.ndarray):
        half = vectors * 0.5
        low, high = half.min(0), half.max(0)
        self.middle = low + (high - low) * 0.5
        self.size = float(np.abs(half - self.middle).max()) or 1.0
        self.points = self.placed(vectors)

    def placed(self, vectors: np.ndarray) -> np.ndarray:
        # Beyond this the squares of distances would overflow; it is farther than all of the shard, in the same direction.
        return np.clip((vectors * 0.5 - self.middle) / self.size, -1e150, 1e150)


def distance(gaps: np.ndarray) -> np.ndarray:
    """Lengths of the rows; where squares overflow or vanish, they are taken of parts of the largest component."""
    with np.errstate(over="ignore", under="ignore"):
        plain = np.sqrt((gaps * gaps).sum(1))
        odd = ~((plain > 1e-140) & (plain < np.inf))
        if odd.any():
            largest = np.maximum(np.abs(gaps[odd]).max(1), 5e-324)
            plain[odd] = largest * np.sqrt(((gaps[odd] / largest[:, None]) ** 2).sum(1))
    return plain


def _dealt(rows: DataFrame, shards: int, settings: Settings, *order: str) -> DataFrame:
    """Rows in partitions by their shard's number, sorted: no two shards meet in one task while others idle."""
    parts = min(shards, settings.most_tasks)
    return rows.repartitionById(parts, F.pmod(F.col("shard"), F.lit(parts)).cast("int")).sortWithinPartitions(*order)


def search(vectors: DataFrame, queries: DataFrame, k: int, settings: Settings = Settings(), key: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """The k nearest rows found for every query: query_id, rank, vec_id, score.

    * `score` is the Euclidean distance in double precision; ties go to the smaller id.
    * Null, zero and non-finite vectors and null ids take no part, as query or candidate;
      a query is no candidate of its own; repeated rows count once.  Vectors of another
      length are no candidates.  Fewer than k candidates are all returned; an empty table
      gives no rows; extra columns are ignored.
    * Queries stream through every shard; a task holds one shard's graph and one block of queries.
    """
    index = build_index(vectors, k + 1, settings, key, vector)
    asked = (queries.select(F.col(key).cast("bigint").alias("query_id"), F.col(vector).alias("query"))
             .filter(F.col("query_id").isNotNull() & usable(F.col("query"))).dropDuplicates(["query_id", "query"]))
    last = index.agg(F.max("shard")).first()[0] or 0
    asked = asked.select(F.size("query").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(last))).alias("shard"),
                         F.col("query").cast("array<double>").alias("vector"), F.array("query_id").alias("ids"))
    both = index.withColumn("query", F.lit(False)).unionByName(asked.withColumn("query", F.lit(True)), allowMissingColumns=True)
    columns = ["query_id", "vec_id", "score"]

    def meet(graph: pd.DataFrame) -> Callable[[pd.DataFrame], pd.DataFrame]:
        graph = graph.sort_values("place", ignore_index=True)
        exact, edges = np.stack(graph["vector"].to_numpy()), np.stack(graph["edges"].to_numpy())
        starts = np.flatnonzero(graph["start"].to_numpy().astype(bool)).astype(np.int32)
        frame, copies = Frame(exact), graph["ids"].to_numpy()

        def answer(some: pd.DataFrame) -> pd.DataFrame:
            rows, owns = np.stack(some["vector"].to_numpy()), [ids[0] for ids in some["ids"]]
            ids, _, _ = beam_search(frame.points, edges, starts, frame.placed(rows), settings.beam)
            out = []
            for q, (own, found) in enumerate(zip(owns, ids)):
                found = found[found >= 0]
                score, taken = distance(exact[found] - rows[q]), []
                for at in np.argsort(score, kind="stable"):
                    if len(taken) > k and score[at] > taken[k - 1][0]:
                        break
                    taken += [(score[at], i) for i in copies[found[at]] if i != own]
                taken.sort()
                out += [(own, i, s) for s, i in taken[:k]]
            return pd.DataFrame(out, columns=columns)

        return answer

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, parts, answer = None, [], None
        for pdf in frames:
            for (dim, shard, query), some in pdf.groupby(["dim", "shard", "query"]):
                if (dim, shard) != key:
                    key, parts, answer = (dim, shard), [], None
                if not query:
                    parts.append(some)
                elif parts:
                    answer = answer or meet(pd.concat(parts))
                    for lo in range(0, len(some), settings.query_block):
                        yield answer(some.iloc[lo:lo + settings.query_block])

    met = _dealt(both, last + 1, settings, "dim", "shard", "query").mapInPandas(run, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
