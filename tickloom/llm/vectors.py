"""Embedding near-duplicates by a robust-pruned flat graph, searched with a growing range.

Vectors link at cosine ``THRESHOLD`` or more, in double precision.  Equal vectors are one node with a count, so a
group of copies, however large, is searched once.

Build: nodes are dealt to overlapping cluster shards, each to its nearest centroid (its home) and to the second
nearest; a shard's task takes each node's nearest nodes and some random ones as candidates and prunes them by the
robust rule (a candidate goes if a kept neighbour is nearer to it by the factor ``ALPHA``), adds the reverse edges and
returns adjacency lists.  The lists of a node from its shards are united.

Search: every node is searched once, in its home.  The home's index holds the nodes that have this shard among their
``PROBES`` nearest, and those of other shards to which close edges of the united lists of its own nodes lead (at most
twice the range's angle, so that two linked nodes with one between them meet).  A greedy search
starts from the medoids and from the node itself; it keeps a list of the best nodes seen and a set of visited ones, and
the list widens as long as the range, all nodes that link, keeps growing.  Steps use single precision; every hit is
verified by its cosine in double precision.  Links are counted in the task and reduced to one edge a node for the
components; pairs are never written.  Indexes beyond ``SHARD_LIMIT`` nodes are cut by a hash of the node, and every
node of the home visits all parts, so no task's memory grows with the input.

The centroids are fitted on a sample of at most ``SAMPLE`` nodes and ``SAMPLE_BYTES`` bytes, chosen by hash; every node
is indexed.  Recall is always audited against all nodes: on ``AUDIT`` nodes that have found links, for the share of
their links that was found, and on ``AUDIT`` nodes that have not, for the share that has some; both give the mean share
of links found of a node that has links.  Below ``LEAST_RECALL`` the homes compare all their pairs instead of walking
the graph, and then twice as many probes are taken, until every home holds all nodes, which is exact.  The share
comes back as the column recall.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing and are
their own component; so are rows with a null id, which are kept; vectors of different lengths never link; repeated
rows are copies that link with each other; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, spread_join, written

THRESHOLD = 0.9
#: The cosine of twice the angle of THRESHOLD.
CLOSE = 2 * THRESHOLD**2 - 1
SAMPLE = 65_536
SHARD_TARGET = 2_000
SHARD_LIMIT = 6_000
MOST_SHARDS = 16_384
SAMPLE_BYTES = 64 << 20
PROBES = 2
DEGREE = 24
CANDIDATES = 40
RANDOM_CANDIDATES = 12
ALPHA = 1.2
MEDOIDS = 6
BEAM = 16
STRIDE = 6
BATCH = 256
AUDIT = 200
LEAST_RECALL = 0.97

NODE = "node long, dim int, copies long, first long, vector binary"


def nodes(rows: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(id, v) of each row, v null where it can't link, and the distinct vectors as (node, dim, copies, first, v).

    Vectors are one node only if all their components are equal; a node is a number given when they are written.
    """
    values = F.col(vector).cast("array<double>")
    fits = F.coalesce(F.forall(values, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))), F.lit(False))
    fits &= F.coalesce(F.exists(values, lambda x: x != 0), F.lit(False)) & F.col(key).isNotNull()
    # -0.0 and 0.0 are one value
    plain = F.when(fits, F.transform(values, lambda x: x + F.lit(0.0)))
    keyed = rows.select(F.col(key).cast("long").alias("id"), plain.alias("v"))
    distinct = keyed.filter("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first"))
    numbered = distinct.select(F.monotonically_increasing_id().alias("node"), F.size("v").alias("dim"), "copies", "first", "v")
    return keyed, written(numbered, "vectors")


def packed(distinct: DataFrame) -> DataFrame:
    """The distinct vectors as NODE rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.array(x, dtype=np.float64).tobytes() for x in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(raw, pa.binary())], ["node", "dim", "copies", "first", "vector"])

    return distinct.mapInArrow(pack, NODE)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Unit vectors, one a row."""
    x = np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly chosen starts."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        near = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 0, total / np.where(norm > 0, norm, 1), c)
    return c


def fit(found: DataFrame) -> dict[int, np.ndarray]:
    """Centroids for each vector length, from a bounded sample."""
    sizes = {r.dim: r.n for r in found.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    fits = {d: max(1, SAMPLE_BYTES // (8 * d * len(sizes))) for d in sizes}
    # beyond the bytes there are fewer centroids, whose shards are cut in parts
    k = {d: max(1, min(MOST_SHARDS, -(-n // SHARD_TARGET), fits[d])) for d, n in sizes.items()}
    room = {d: max(k[d], min(SAMPLE, fits[d], 64 * k[d])) for d in sizes}
    # nodes whose hash lies below their length's share: about as many as there is room for, in one pass
    share = F.create_map(*[F.lit(x) for d in sizes for x in (d, min(1.0, room[d] / sizes[d]))]) if sizes else None
    place = F.shiftrightunsigned(F.xxhash64("node", F.lit("sample")), 11) / F.lit(float(1 << 53))
    chosen = found.filter(place <= share[F.col("dim")]).select("dim", "node", "vector").collect() if sizes else []
    by_dim: dict[int, list] = {}
    for r in sorted(chosen, key=lambda r: r.node):
        by_dim.setdefault(r.dim, []).append(bytes(r.vector))
    out = {}
    for dim, raw in sorted(by_dim.items()):
        x = matrix(pa.array(raw), dim)
        out[dim] = centroids(x, min(k[dim], len(x)))
    for dim in set(sizes) - set(out):  # a length too rare for the sample: any centre will do
        out[dim] = np.eye(1, dim)
    return out


def _nearest(near: np.ndarray, p: int) -> np.ndarray:
    """The columns of the p largest values of each row, largest first."""
    some = np.argpartition(-near, p - 1, axis=1)[:, :p]
    return np.take_along_axis(some, np.argsort(-np.take_along_axis(near, some, 1), axis=1, kind="stable"), 1)


def route(found: DataFrame, shards: dict[int, np.ndarray], probes: int) -> DataFrame:
    """A row for each node and shard that it visits: (shard, rank, NODE columns), rank 0 being its home."""
    base, total = {}, 0
    for dim in sorted(shards):
        base[dim] = total
        total += len(shards[dim])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column(1))
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                c, x = shards[dim], matrix(part.column(4), dim)
                p = min(max(probes, 2), len(c))
                top = np.concatenate([_nearest(x[i : i + BATCH] @ c.T, p) for i in range(0, len(x), BATCH)])
                row = np.repeat(np.arange(len(part)), p)
                columns = [pa.array((base[dim] + top).ravel().astype(np.int32)), pa.array(np.tile(np.arange(p, dtype=np.int32), len(part)))]
                yield pa.RecordBatch.from_arrays(columns + part.take(pa.array(row)).columns, ["shard", "rank", *part.schema.names])

    return found.mapInArrow(run, f"shard int, rank int, {NODE}")


def prune(x: np.ndarray, own: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Robust pruning: up to DEGREE neighbours of each node out of its candidates (nearest first; -1: none)."""
    near = x[candidates]
    to_own = np.einsum("nd,ncd->nc", x[own], near)
    alive = (candidates >= 0) & (candidates != own[:, None])
    order = np.argsort(np.where(alive, -to_own, np.inf), axis=1)
    candidates, alive, to_own = (np.take_along_axis(a, order, 1) for a in (candidates, alive, to_own))
    near = x[candidates]
    between = np.einsum("nad,nbd->nab", near, near)
    far_own, far = np.sqrt(np.maximum(2 - 2 * to_own, 0)), np.sqrt(np.maximum(2 - 2 * between, 0))
    out = np.full((len(own), DEGREE), -1, dtype=np.int64)
    row = np.arange(len(own))
    for j in range(DEGREE):
        pick = alive.argmax(1)
        some = alive[row, pick]
        if not some.any():
            break
        out[some, j] = candidates[row, pick][some]
        covered = ALPHA * far[row, pick] <= far_own
        covered[row, pick] = True
        alive &= ~covered
    return out


def build(x: np.ndarray, seed: int) -> np.ndarray:
    """Adjacency of one shard: pruned lists with their reverse edges, -1 beyond a node's end."""
    n = len(x)
    rng = np.random.default_rng(seed)
    c = min(CANDIDATES, n)
    lists = []
    for a in range(0, n, 256):
        own = np.arange(a, min(a + 256, n))
        nearest = np.argpartition(-(x[own] @ x.T), c - 1, axis=1)[:, :c]
        lists.append(prune(x, own, np.concatenate([nearest, rng.integers(0, n, (len(own), RANDOM_CANDIDATES))], axis=1)))
    out = np.concatenate(lists)
    a, j = np.nonzero(out >= 0)
    to, source = out[a, j], a
    # reverse edges, as many as fit beside a node's own
    order = np.lexsort((rng.random(len(to)), to))
    to, source = to[order], source[order]
    nth = np.arange(len(to)) - np.searchsorted(to, to)
    fits = nth < DEGREE
    both = np.full((n, 2 * DEGREE), -1, dtype=np.int64)
    both[:, :DEGREE] = out
    both[to[fits], DEGREE + nth[fits]] = source[fits]
    return both


def medoids(x: np.ndarray) -> np.ndarray:
    """Starting nodes: those nearest to the means of a few rough clusters."""
    c = centroids(x, min(MEDOIDS, len(x)), 4)
    return np.unique((x @ c.T).argmax(0))


def search(x: np.ndarray, edges: np.ndarray, starts: np.ndarray, own: np.ndarray, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Range-expanding greedy search of a batch of queries: (query, node) of the hits, not yet verified.

    x and queries are unit vectors in single precision; own: each query's place in the index, -1 if it has none.
    """
    n, q = len(x), len(queries)
    threshold -= 1e-5
    seen = np.zeros((q, n + 1), dtype=bool)
    seen[:, n] = True  # where the filling -1 of the edges points
    row, node, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    open_ = np.zeros(0, dtype=bool)
    known = np.flatnonzero(own >= 0)
    fresh = np.union1d((np.arange(q)[:, None] * (n + 1) + starts[None, :]).ravel(), known * (n + 1) + own[known])
    beam = np.full(q, BEAM)
    while True:
        seen.ravel()[fresh] = True
        r, v = np.divmod(fresh, n + 1)
        found = np.concatenate([np.zeros(0, np.float32), *[np.einsum("id,id->i", queries[r[i : i + (1 << 15)]], x[v[i : i + (1 << 15)]]) for i in range(0, len(r), 1 << 15)]])
        row, node, score = np.concatenate([row, r]), np.concatenate([node, v]), np.concatenate([score, found])
        open_ = np.concatenate([open_, np.ones(len(r), dtype=bool)])
        # the list of each query is as long as its beam, which the range widens
        inside = np.bincount(row[score >= threshold], minlength=q)
        beam = np.maximum(beam, 2 * inside)
        order = np.lexsort((-score, row))
        row, node, score, open_ = row[order], node[order], score[order], open_[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < beam[row]
        row, node, score, open_ = row[kept], node[kept], score[kept], open_[kept]
        waiting = np.flatnonzero(open_)
        if not len(waiting):
            hit = score >= threshold
            return row[hit], node[hit]
        # the best few of each query that are not yet walked from, and all in the range
        nth = np.arange(len(waiting)) - np.searchsorted(row[waiting], row[waiting])
        go = waiting[(nth < STRIDE) | (score[waiting] >= threshold)]
        open_[go] = False
        to = edges[node[go]]
        keys = (row[go][:, None] * (n + 1) + np.where(to < 0, n, to)).ravel()
        fresh = np.unique(keys[~seen.ravel()[keys]])


def _edges(node: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Adjacency lists by place among the sorted nodes, -1 for nodes that are not there."""
    near = lists.values.to_numpy()
    size = np.diff(lists.offsets.to_numpy())
    at = np.minimum(np.searchsorted(node, near), len(node) - 1)
    at[node[at] != near] = -1
    edges = np.full((len(node), max([1, *size.tolist()])), -1, dtype=np.int64)
    row = np.repeat(np.arange(len(node)), size)
    edges[row, np.arange(len(near)) - np.repeat(np.cumsum(size) - size, size)] = at
    return edges


def _graph(table: pa.Table) -> pa.Table:
    table = table.combine_chunks().sort_by("node")
    node = table.column("node").to_numpy()
    x = matrix(table.column("vector"), table.column("dim")[0].as_py())
    edges = build(x, table.column("shard")[0].as_py())
    close = np.concatenate([np.einsum("nd,nkd->nk", x[i : i + BATCH], x[edges[i : i + BATCH]]) >= CLOSE for i in range(0, len(x), BATCH)])
    lists = [pa.array([np.unique(node[e[m]]) for e, m in zip(edges, mask)], pa.list_(pa.int64())) for mask in (edges >= 0, close & (edges >= 0))]
    return pa.table({"node": node, "near": lists[0], "close": lists[1]})


def _found(table: pa.Table, exact: bool) -> pa.Table:
    """Of one part of a home: per query how many rows it links with, and per node that links a representative."""
    table = table.combine_chunks().sort_by("node")
    dim = table.column("dim")[0].as_py()
    is_query = np.asarray(table.column("query"))
    index, asked = table.filter(pa.array(~is_query)), table.filter(pa.array(is_query))
    out = {"node": [], "links": [], "root": []}
    if index.num_rows and asked.num_rows:
        node, names, copies = (t.column(c).to_numpy() for t, c in ((index, "node"), (asked, "node"), (index, "copies")))
        x, queries = matrix(index.column("vector"), dim), matrix(asked.column("vector"), dim)
        own = np.minimum(np.searchsorted(node, names), len(node) - 1)
        own = np.where(node[own] == names, own, -1)
        if not exact:
            edges, starts = _edges(node, index.column("near").combine_chunks()), medoids(x)
            x32, queries32 = x.astype(np.float32), queries.astype(np.float32)
        everyone = np.union1d(node, names)
        place, asker = np.searchsorted(everyone, node), np.searchsorted(everyone, names)
        parent, links = np.arange(len(everyone)), np.zeros(len(names), dtype=np.int64)
        for i in range(0, len(names), BATCH):
            part = slice(i, i + BATCH)
            if exact:
                row, column = np.nonzero(queries[part] @ x.T >= THRESHOLD)
            else:
                row, column = search(x32, edges, starts, own[part], queries32[part], THRESHOLD)
                row, column = row[(good := _cosines(queries[part], x, row, column) >= THRESHOLD)], column[good]
            other = column != own[part][row]
            row, column = row[other], column[other]
            links[part] = np.bincount(row, copies[column], len(links[part])).astype(np.int64)
            parent = _unite(parent, asker[part][row], place[column])
        parent = _roots(parent)
        root = everyone[parent]
        linked = np.flatnonzero((parent != np.arange(len(everyone))))
        some = np.flatnonzero(links)
        out = {
            "node": np.concatenate([names[some], everyone[linked]]),
            "links": np.concatenate([links[some], np.zeros(len(linked), np.int64)]),
            "root": np.concatenate([root[asker[some]], root[linked]]),
        }
    return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})


def _cosines(queries: np.ndarray, x: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    parts = [np.einsum("id,id->i", queries[row[i : i + (1 << 15)]], x[column[i : i + (1 << 15)]]) for i in range(0, len(row), 1 << 15)]
    return np.concatenate([np.zeros(0), *parts])


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the sets of a[i] and b[i]; parents are the smallest places of their sets."""
    while True:
        parent = _roots(parent)
        high, low = np.maximum(parent[a], parent[b]), np.minimum(parent[a], parent[b])
        if (high == low).all():
            return parent
        np.minimum.at(parent, high, low)


def audit(found: DataFrame, links: DataFrame, threshold: float = THRESHOLD) -> float:
    """The mean share of its links that the search has found of a node that has links, from two samples by hash."""
    scored = written(found.join(links, "node", "left").withColumn("links", F.coalesce("links", F.lit(0))), "scored")
    some = F.col("links") > 0
    sizes = {r.some: r.n for r in scored.groupBy(some.alias("some")).agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = []
    for kind in (some, ~some):  # bounded: AUDIT vectors each
        chosen += scored.filter(kind).orderBy(F.xxhash64("node", F.lit("audit")), "node").limit(AUDIT).collect()
    by_dim: dict[int, list] = {}
    for r in chosen:
        by_dim.setdefault(r.dim, []).append(r)
    probes = {d: (np.array([r.node for r in rs]), matrix(pa.array([bytes(r.vector) for r in rs]), d)) for d, rs in by_dim.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim, (names, queries) in probes.items():
                part = batch.filter(pa.array(dims == dim))
                if part.num_rows:
                    hit = queries @ matrix(part.column("vector"), dim).T >= threshold
                    hit &= names[:, None] != np.asarray(part.column("node"))[None, :]
                    n = hit @ np.asarray(part.column("copies"))
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n.astype(np.int64))], ["node", "true_links"])

    truth = {r.node: r.n for r in found.mapInArrow(count, "node long, true_links long").groupBy("node").agg(F.sum("true_links").alias("n")).collect()}
    shares = [min(1.0, r.links / truth[r.node]) for r in chosen if r.links]
    lost = [truth[r.node] > 0 for r in chosen if not r.links]
    with_links = sizes.get(True, 0) + sizes.get(False, 0) * (sum(lost) / len(lost) if lost else 0)
    return sizes.get(True, 0) * sum(shares) / len(shares) / with_links if shares else float(not any(lost))


def link(found: DataFrame, shards: dict[int, np.ndarray], probes: int, exact: bool) -> tuple[DataFrame, DataFrame]:
    """(node, links) with the links to other vectors, and edges (a, b) that join the components."""
    visits = written(route(found, shards, probes), "visits")
    part = lambda n: F.pmod(F.xxhash64("node", F.lit("part")), n).cast("int")
    built = visits.filter(F.col("rank") < 2)
    # bounded here and below: a row for each shard, of which there are MOST_SHARDS for each vector length at most
    parts = built.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / SHARD_LIMIT).cast("int").alias("parts"))
    dealt = built.join(F.broadcast(parts), "shard").withColumn("part", part(F.col("parts")))
    graph = dealt.select("shard", "part", "node", "dim", "vector").groupBy("shard", "part").applyInArrow(_graph, "node long, near array<long>, close array<long>")
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    lists = written(graph.groupBy("node").agg(union("near"), union("close")), "graph")
    whole = written(found.join(lists, "node").select("node", "dim", "copies", "vector", "near"), "graph-nodes")
    held = visits.filter(F.col("rank") < probes).select("shard", "node")
    home = visits.filter(F.col("rank") == 0).select("shard", "node")
    if max([1, *map(len, shards.values())]) > probes:
        # the other ends of the edges that leave a home
        ends = home.join(lists, "node").select("shard", F.explode("close").alias("node"))
        held = held.union(ends).distinct()
    index = written(held.join(whole, "node"), "index")
    sizes = index.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / SHARD_LIMIT).cast("int").alias("parts"))
    rounds = home.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / SHARD_LIMIT).cast("int").alias("rounds"))
    sizes = sizes.join(rounds, "shard")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["shard", "part", "round", "node", "dim", "copies", "vector"]
    indexed = index.join(F.broadcast(sizes), "shard").withColumn("part", part(F.col("parts"))).withColumn("round", every("rounds"))
    asked = home.join(whole.drop("near"), "node").join(F.broadcast(sizes), "shard").withColumn("round", part(F.col("rounds"))).withColumn("part", every("parts"))
    both = indexed.select(*columns, F.lit(False).alias("query"), "near").unionByName(
        asked.select(*columns, F.lit(True).alias("query"), F.lit(None).cast("array<long>").alias("near"))
    )
    search_part = lambda table: _found(table, exact)
    hits = written(both.groupBy("shard", "part", "round").applyInArrow(search_part, "node long, links long, root long"), "hits")
    links = hits.groupBy("node").agg(F.sum("links").alias("links"))
    return links, hits.select(F.col("node").alias("a"), F.col("root").alias("b"))


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall) of every row; recall is the audited share, the same in all rows."""
    keyed, distinct = nodes(rows, key, vector)
    found = written(packed(distinct), "nodes")
    shards = fit(found)
    most = max([1, *map(len, shards.values())])
    steps = [(PROBES, False)] + [(PROBES << i, True) for i in range(1 + math.ceil(math.log2(max(1, most / PROBES))))]
    for probes, exact in steps:
        links, edges = link(found, shards, probes, exact)
        recall = audit(found, links)
        if recall >= LEAST_RECALL:
            break
    groups = components(edges).select("node", F.col("component").alias("group"))
    named = written(
        found.select("node", "first", "copies")
        .join(links, "node", "left")
        .join(groups, "node", "left")
        .select("node", "first", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("group", "node").alias("group")),
        "named",
    )
    firsts = written(named.groupBy("group").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n")), "firsts")
    result = spread_join(named, firsts, "group", F.col("node"), named.count())
    result = result.select("node", "n_links", "component_id", F.col("copies").alias("n")).join(distinct.select("node", "v"), "node").drop("node")
    return spread_join(keyed, written(result, "classes"), "v", F.col("id"), keyed.count(), "left").select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"),
        F.lit(recall).alias("recall"),
    )
