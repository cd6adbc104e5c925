"""Dimensionality reduction and density clustering.

The reducer is a principal component analysis and the clusterer an own density
hierarchy; both stand behind plain functions, so others can take their place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions import scalars as S

#: Bytes of coordinates, as doubles, up to which the density hierarchy is built: every executor holds them, and the driver the tree.
MOST_BYTES = 256 << 20
#: Rows of which trustworthiness is measured at most.
TRUST_ROWS = 1_000
#: Points in a leaf of the k-d tree that orders them.
LEAF = 256
#: Rows that a reducer is fitted on at most.
FIT_ROWS = 100_000


def hashing_encoder(texts: list[str], dim: int = 256) -> np.ndarray:
    """M01's built-in encoder: signed hashing of character trigrams to unit vectors; needs no model file."""
    out = np.zeros((len(texts), dim))
    for row, t in zip(out, texts):
        padded = f" {t.casefold()} "
        for i in range(len(padded) - 2):
            h = int.from_bytes(hashlib.blake2b(padded[i : i + 3].encode(), digest_size=8).digest(), "big")
            row[h % dim] += 1.0 if h >> 63 else -1.0
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    out[norms[:, 0] == 0, 0] = 1.0
    return out / np.where(norms == 0, 1.0, norms)


def embedded(df: DataFrame, text: str, encoder: Callable[[list[str]], np.ndarray] = hashing_encoder, batch: int = 64, out: str = "embedding") -> DataFrame:
    """``df`` with the encoder's vector for each text, in batches."""
    names = [c for c in df.columns if c != out]
    schema = df.select(*names).withColumn(out, F.array().cast("array<float>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, batch):
                part = b.slice(i, batch)
                vectors = encoder([t or "" for t in part.column(text).to_pylist()]).astype(np.float32)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(list(vectors), pa.list_(pa.float32()))], names=[*names, out])

    return df.select(*names).mapInArrow(run, schema)


def reduced(df: DataFrame, key: str, vector: str, dims: int, fit_rows: int = FIT_ROWS, seed: int = 42) -> DataFrame:
    """(key, coords). The reducer is fitted on the ``fit_rows`` lowest hash ranks and applied to every row."""
    rows = df.select(key, array_to_vector(F.transform(S.unit(F.col(vector)), lambda x: x)).alias("_v"))
    n = rows.count()
    sample = rows if n <= fit_rows else rows.orderBy(F.xxhash64(F.lit(seed), key)).limit(fit_rows)
    model = PCA(k=dims, inputCol="_v", outputCol="_c").fit(sample)
    return model.transform(rows).select(key, vector_to_array("_c").alias("coords"))


def reduction_quality(coords: DataFrame, key: str) -> DataFrame:
    """(axis, variance) and the share of repeated coordinates; an axis without variance is an error of the stage."""
    each = coords.select(F.posexplode("coords").alias("axis", "x")).groupBy("axis").agg(F.round(F.var_pop("x"), 6).alias("variance"))
    repeated = coords.agg(F.round(1 - F.count_distinct("coords") / F.count("*"), 6).alias("duplicate_share"))
    return each.crossJoin(repeated)  # one row


def trustworthiness(high: np.ndarray, low: np.ndarray, k: int) -> float:
    """How far neighbours in the reduced space are neighbours in the original one; for a bounded prefix of rows."""
    n = len(high)
    square = lambda m: (m * m).sum(axis=1)
    far = lambda m: square(m)[:, None] + square(m)[None] - 2 * m @ m.T + np.diag(np.full(n, np.inf))
    rank = np.argsort(np.argsort(far(high), axis=1, kind="stable"), axis=1) + 1
    near = np.argsort(far(low), axis=1, kind="stable")[:, :k]
    extra = np.maximum(np.take_along_axis(rank, near, axis=1) - k, 0).sum()
    return 1 - extra * 2 / (n * k * (2 * n - 3 * k - 1))


def trust(df: DataFrame, coords: DataFrame, key: str, vector: str, rows: int = TRUST_ROWS) -> DataFrame:
    """Trustworthiness with at most five neighbours over the first ``rows`` rows by key, as its rank matrix is quadratic."""
    first = df.select(key, vector).orderBy(key).limit(rows).join(coords, key).orderBy(key).toArrow()
    n = len(first)
    k = min(5, (n - 1) // 2)
    high, low = (np.array(first.column(c).to_pylist(), float) for c in (vector, "coords"))
    value = trustworthiness(high, low, k) if k > 0 else None
    return df.sparkSession.createDataFrame([(k, None if value is None else round(float(value), 6))], "neighbours int, trustworthiness double")


def _leaves(points: np.ndarray, most: int = LEAF) -> list[np.ndarray]:
    """Places of the points in the leaves of a k-d tree: each cut halves the widest side."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        at = todo.pop()
        if len(at) <= most:
            out.append(at)
            continue
        part = points[at]
        x = part[:, np.argmax(part.max(axis=0) - part.min(axis=0))]
        order = np.argpartition(x, len(at) // 2)
        todo += [at[order[: len(at) // 2]], at[order[len(at) // 2 :]]]
    return out


def _apart(low: np.ndarray, high: np.ndarray, i: int) -> np.ndarray:
    """Least distance of box i to each box."""
    gap = np.maximum(0, np.maximum(low - high[i], low[i] - high))
    return np.sqrt((gap * gap).sum(axis=1))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))


class _Space:
    """Points in leaves with their boxes; what a task needs to search among all."""

    def __init__(self, points: np.ndarray):
        self.points, self.leaves = points, _leaves(points)
        self.low = np.array([points[x].min(axis=0) for x in self.leaves])
        self.high = np.array([points[x].max(axis=0) for x in self.leaves])

    def neighbours(self, leaf: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(distances, places) of the k nearest other points of each point in a leaf, nearest first."""
        own = self.leaves[leaf]
        apart = _apart(self.low, self.high, leaf)
        best, of = np.full((len(own), k), np.inf), np.full((len(own), k), -1)
        for j in np.argsort(apart, kind="stable"):
            if apart[j] > best[:, -1].max():
                break
            other = self.leaves[j]
            d = _distances(self.points[own], self.points[other])
            if j == leaf:
                np.fill_diagonal(d, np.inf)
            d, o = np.concatenate([best, d], axis=1), np.concatenate([of, np.broadcast_to(other, (len(own), len(other)))], axis=1)
            top = np.argpartition(d, k - 1, axis=1)[:, :k]
            best, of = np.take_along_axis(d, top, 1), np.take_along_axis(o, top, 1)
        order = np.lexsort((of, best))
        return np.take_along_axis(best, order, 1), np.take_along_axis(of, order, 1)

    def crossings(self, leaf: int, core: np.ndarray, component: np.ndarray, bound: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(component, distance, point, other) of the shortest edge of mutual reachability that leaves each component with points in a leaf, if not above the component's ``bound``; ties to the lowest places."""
        own = self.leaves[leaf]
        mine, limit = component[own], bound[component[own]].copy()
        found: dict[int, tuple[float, int, int]] = {}
        apart = np.maximum(_apart(self.low, self.high, leaf), core[own].min())
        for j in np.argsort(apart, kind="stable"):
            open_ = np.flatnonzero(limit >= np.maximum(apart[j], core[own]))
            if not len(open_) or apart[j] > limit.max():
                break
            other = self.leaves[j]
            d = np.maximum(np.maximum(_distances(self.points[own[open_]], self.points[other]), core[own[open_], None]), core[other][None])
            d[mine[open_, None] == component[other][None]] = np.inf
            at = d.argmin(axis=1)
            for i, x, o in zip(open_.tolist(), d[np.arange(len(open_)), at].tolist(), other[at].tolist()):
                c = int(mine[i])
                edge = (x, min(int(own[i]), o), max(int(own[i]), o))
                if x < np.inf and x <= bound[c] and (c not in found or edge < found[c]):
                    found[c] = edge
            for c, (x, _, _) in found.items():
                limit[mine == c] = np.minimum(limit[mine == c], x)
        return [(c, *e) for c, e in found.items()]


def spanning_tree(coords: DataFrame, points: np.ndarray, k: int) -> list[tuple[float, int, int]]:
    """Edges (distance, a, b) of the minimum spanning tree of mutual reachability, shortest first; ``points`` in places 0 to n - 1.

    Boruvka's method: in each round every component finds its shortest edge out, which tasks look for leaf by leaf of a k-d tree;
    boxes farther than what is known are passed over. The number of rounds grows with the logarithm of n. ``coords`` gives the session only.
    """
    spark, n = coords.sparkSession, len(points)
    space = _Space(points)
    shared = spark.sparkContext.broadcast(space)
    leaves = spark.range(len(space.leaves)).repartition(max(1, min(len(space.leaves), 4 * spark.sparkContext.defaultParallelism)))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for leaf in b.column("id").to_pylist():
                d, o = shared.value.neighbours(leaf, k)
                yield pa.RecordBatch.from_arrays([pa.array(shared.value.leaves[leaf]), pa.array(list(d)), pa.array(list(o))], names=["at", "distances", "others"])

    found = leaves.mapInArrow(near, "at long, distances array<double>, others array<long>").toArrow()
    at = found.column("at").to_numpy()
    distance, other = np.empty((n, k)), np.empty((n, k), np.int64)
    distance[at] = found.column("distances").combine_chunks().flatten().to_numpy().reshape(-1, k)
    other[at] = found.column("others").combine_chunks().flatten().to_numpy().reshape(-1, k)
    core = distance[:, -1]
    reach = np.maximum(np.maximum(distance, core[:, None]), core[other])
    component, edges = np.arange(n), []
    while component.max() > 0:
        out = np.where(component[other] != component[:, None], reach, np.inf).min(axis=1)
        bound = np.full(component.max() + 1, np.inf)
        np.minimum.at(bound, component, out)  # no edge out is longer than the shortest to a near neighbour
        state = spark.sparkContext.broadcast((core, component, bound))

        def cross(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for leaf in b.column("id").to_pylist():
                    rows = shared.value.crossings(leaf, *state.value)
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["component", "distance", "a", "b"])

        best = leaves.mapInArrow(cross, "component long, distance double, a long, b long").groupBy("component").agg(F.min(F.struct("distance", "a", "b")).alias("e")).select("e.*").distinct().collect()  # an edge per component
        state.destroy()
        root = list(range(component.max() + 1))

        def top(x: int, root=root) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for d, a, b in sorted(map(tuple, best)):
            x, y = top(int(component[a])), top(int(component[b]))
            if x != y:
                root[max(x, y)] = min(x, y)
                edges.append((d, a, b))
        _, component = np.unique(np.array([top(x) for x in range(len(root))])[component], return_inverse=True)
    shared.destroy()
    return sorted(edges)


def density_clusters(n: int, edges: list[tuple[float, int, int]], min_size: int) -> tuple[np.ndarray, np.ndarray]:
    """(label, probability) of each of n points, from a spanning tree of mutual reachability: condensed tree, clusters by excess of mass; -1 is noise."""
    labels, probability = np.full(n, -1), np.zeros(n)
    if n < max(2, min_size):
        return labels, probability
    # single linkage: node n + i joins two earlier nodes at a distance
    parent, left, right, size, height = list(range(2 * n - 1)), {}, {}, [1] * n + [0] * (n - 1), [0.0] * (2 * n - 1)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (d, a, b) in enumerate(edges):
        a, b, node = root(a), root(b), n + i
        parent[a] = parent[b] = node
        left[node], right[node], size[node], height[node] = a, b, size[a] + size[b], d

    def leaves(x: int) -> list[int]:
        out, todo = [], [x]
        while todo:
            y = todo.pop()
            if y < n:
                out.append(y)
            else:
                todo += [left[y], right[y]]
        return out

    # condensed tree: cluster -> birth, members that left with their density, and child clusters
    birth, fallen, children = {0: 0.0}, {0: []}, {0: []}
    todo = [(2 * n - 2, 0)]
    while todo:
        node, c = todo.pop()
        if node < n:
            fallen[c].append((node, np.inf))
            continue
        density = 1 / height[node] if height[node] > 0 else np.inf
        sides = (left[node], right[node])
        big = [s for s in sides if size[s] >= min_size]
        if len(big) == 2:
            for s in big:
                new = len(birth)
                birth[new], fallen[new], children[new] = density, [], []
                children[c].append(new)
                todo.append((s, new))
        else:
            for s in sides:
                if s in big:
                    todo.append((s, c))
                else:
                    fallen[c] += [(x, density) for x in leaves(s)]
    inside = {c: len(fallen[c]) for c in birth}
    for c in sorted(birth, reverse=True):
        inside[c] += sum(inside[x] for x in children[c])
    finite = [d for f in fallen.values() for _, d in f if np.isfinite(d)] + [b for b in birth.values() if np.isfinite(b)]
    top = 2 * max(finite, default=1.0)
    capped = lambda d: min(d, top)
    mass, chosen = {}, {}
    for c in sorted(birth, reverse=True):
        own = sum(capped(d) - capped(birth[c]) for _, d in fallen[c]) + sum(inside[x] * (capped(birth[x]) - capped(birth[c])) for x in children[c])
        below = sum(mass[x] for x in children[c])
        chosen[c] = c != 0 and own >= below
        mass[c] = own if chosen[c] else below
    number, todo = 0, [0]
    while todo:
        c = todo.pop()
        if not chosen[c]:
            todo += children[c]
            continue
        members, inner = [], [c]
        while inner:
            x = inner.pop()
            members += fallen[x]
            inner += children[x]
        peak = max(capped(d) for _, d in members)
        for x, d in members:
            labels[x], probability[x] = number, capped(d) / peak if peak > 0 else 1.0
        number += 1
    return labels, probability


def clustered(coords: DataFrame, key: str, min_size: int, min_samples: int | None = None, most_bytes: int = MOST_BYTES) -> DataFrame:
    """M08 over a table of coordinates: (key, label, probability). Refuses coordinates of more than ``most_bytes``, which every executor holds."""
    n, dims = coords.agg(F.count("*"), F.max(F.size("coords"))).first()
    if n * (dims or 1) * 8 > most_bytes:
        raise ValueError(f"density clustering holds up to {most_bytes} bytes of coordinates")
    local = coords.select(key, "coords").orderBy(key).toArrow()
    points = local.column("coords").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1) if n else np.zeros((0, 1))
    edges = spanning_tree(coords, points, min(min_samples or min_size, n - 1)) if n >= max(2, min_size) else []
    labels, probability = density_clusters(n, edges, min_size)
    return coords.sparkSession.createDataFrame(pa.table({key: local.column(key), "label": labels.astype(np.int64), "probability": probability}))
