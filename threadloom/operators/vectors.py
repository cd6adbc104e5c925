"""Near-duplicate vectors: candidate pairs, components, groups, corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import scalars as S
from threadloom.sources.shared import materialise, remove

#: Rows that are broadcast at once to be compared with all, and their bytes as doubles; more go out in blocks of about so many.
EXHAUSTIVE, BLOCK_BYTES = 50_000, 128 << 20
#: Rows on the left and on the right that are multiplied at once, and pairs whose cosines are computed at once.
TILE, TOGETHER = (512, 4096), 65_536
#: Bits of a hash code, the recall that the tables are counted for, and the tables beyond which exact comparison takes over.
BITS, RECALL, MOST_TABLES = 12, 0.95, 64


def matrix(column: pa.Array) -> np.ndarray:
    """Arrays of one length as a matrix of doubles with rows at length one."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    m = whole.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(whole), -1)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def exact_pairs(df: DataFrame, key: str, vector: str, threshold: float, kind: str | None = None, ceiling: int = EXHAUSTIVE) -> DataFrame:
    """Pairs (left, right, similarity), left < right, of one kind and at least as alike as the threshold.

    The matrix goes to every executor, at most ``ceiling`` rows of it; each task
    multiplies its rows with it block by block and emits matches only.
    """
    names = [key, vector, *([kind] if kind else [])]
    rows = df.select(*names)
    if rows.limit(ceiling + 1).count() > ceiling or (rows.agg(F.sum(F.size(vector))).first()[0] or 0) * 8 > BLOCK_BYTES:
        raise ValueError(f"all pairs are compared at once up to {ceiling} rows and {BLOCK_BYTES} bytes; use block_pairs beyond")
    return _matches(rows, rows, key, vector, threshold, kind)[0]


def block_pairs(df: DataFrame, key: str, vector: str, threshold: float, kind: str | None = None, block: int = EXHAUSTIVE) -> DataFrame:
    """The pairs of ``exact_pairs`` for a table of any size.

    Rows fall by the hash of their key into blocks of about ``block`` rows; each
    block in turn goes to every executor and meets all rows, and its matches are
    written to the shared folder before the next, so that one block is held at a time.
    """
    return _blocks(df, key, vector, threshold, kind, block, False)


def block_links(df: DataFrame, key: str, vector: str, threshold: float, kind: str | None = None, block: int = EXHAUSTIVE) -> DataFrame:
    """Of the pairs of ``block_pairs`` (left, right) as many as leave the components as they are: a task keeps those of a block that join what it hadn't joined yet, fewer than the rows of both."""
    return _blocks(df, key, vector, threshold, kind, block, True)


def _blocks(df: DataFrame, key: str, vector: str, threshold: float, kind: str | None, block: int, links: bool) -> DataFrame:
    narrow = df.select(key, vector, *([kind] if kind else []))
    n, dims = narrow.agg(F.count("*"), F.max(F.size(vector))).first()
    block = max(1, min(block, BLOCK_BYTES // (8 * max(dims or 1, 1))))
    blocks = max(1, -(-n // block))
    rows, path = materialise(narrow.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 4 * blocks), key), "vectors")
    out = None
    for i in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64(key), F.lit(blocks)) == i)
        found, shared = _matches(rows, part, key, vector, threshold, kind, links)
        found, _ = materialise(found, "pairs")
        shared.destroy()
        out = found if out is None else out.union(found)
    remove(df.sparkSession, path)
    return out


def _plain(column: pa.Array) -> np.ndarray:
    """Arrays of one length as a matrix, in their own type."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def _norms(m: np.ndarray) -> np.ndarray:
    """Lengths of the rows, squares summed in index order."""
    total = np.zeros(len(m))
    for x in m.T:
        total += x.astype(float) ** 2
    return np.sqrt(total)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, summed in index order as ``scalars.cosine`` does."""
    total = np.zeros(len(a))
    for x, y in zip(a.T, b.T):
        total += x.astype(float) * y.astype(float)
    return total / (_norms(a) * _norms(b))


def _short(m: np.ndarray) -> np.ndarray:
    """Rows at length one, in single precision."""
    return (m / _norms(m)[:, None]).astype(np.float32)


class Joined:
    """Which of some vertices are joined so far."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def new(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the edges (a, b) that join what wasn't joined before, each in turn; and joins it."""
        ra, rb = self.root[a], self.root[b]
        at = np.flatnonzero(ra != rb)
        if not len(at):
            return at
        at = at[np.unique(np.minimum(ra[at], rb[at]) * len(self.root) + np.maximum(ra[at], rb[at]), return_index=True)[1]]
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := above.get(x, x)) != x:
                above[x] = x = above.get(y, y)
            return x

        kept = []
        for i, x, y in zip(at.tolist(), ra[at].tolist(), rb[at].tolist()):
            if (x := top(x)) != (y := top(y)):
                above[max(x, y)] = min(x, y)
                kept.append(i)
        named = np.arange(len(self.root))
        changed = list(above)
        named[changed] = [top(x) for x in changed]
        self.root = named[self.root]
        return np.array(kept, np.int64)


def _matches(rows: DataFrame, part: DataFrame, key: str, vector: str, threshold: float, kind: str | None, links: bool = False):
    """Pairs (left, right, similarity) of ``rows`` with those of ``part``, which are gathered and broadcast; with ``links`` (left, right), and only those that join; and the broadcast.

    Tiles are multiplied in single precision; what comes within its error of the threshold is computed again in double precision, in index order.
    Both sides are in the order of their keys, so that a tile whose left keys all are the larger ones is left out.
    """
    whole = part.toArrow()
    order = np.argsort(whole.column(key).to_numpy(), kind="stable")
    shared = rows.sparkSession.sparkContext.broadcast((whole.column(key).to_numpy()[order], _plain(whole.column(vector))[order] if len(whole) else None, np.array(whole.column(kind).to_pylist())[order] if kind else None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, m, kinds = shared.value
        if m is None:
            return
        short, least = _short(m), np.float32(threshold - (m.shape[1] + 8) * 2.0**-22)
        for b in batches:
            sort = np.argsort(b.column(key).to_numpy(), kind="stable")
            left, own = b.column(key).to_numpy()[sort], _plain(b.column(vector))[sort] if b.num_rows else m[:0]
            own_kinds = np.array(b.column(kind).to_pylist())[sort] if kind else None
            near = _short(own)
            joined = Joined(len(left) + len(ids)) if links else None
            for i in range(0, len(left), TILE[0]):
                for j in range(int(np.searchsorted(ids, left[i], "right")), len(ids), TILE[1]):
                    close = (near[i : i + TILE[0]] @ short[j : j + TILE[1]].T) >= least
                    r, c = np.divmod(np.flatnonzero(close), close.shape[1])
                    r, c = r + i, c + j
                    right = left[r] < ids[c] if own_kinds is None else (left[r] < ids[c]) & (own_kinds[r] == kinds[c])
                    r, c = r[right], c[right]
                    if links and len(r):  # what is joined already needs no exact cosine
                        apart = joined.root[r] != joined.root[c + len(left)]
                        r, c = r[apart], c[apart]
                    for k in range(0, len(r), TOGETHER):
                        x, y = r[k : k + TOGETHER], c[k : k + TOGETHER]
                        alike = _cosines(own[x], m[y])
                        good = alike >= threshold
                        x, y, alike = x[good], y[good], alike[good]
                        if links:
                            kept = joined.new(x, y + len(left))
                            yield pa.RecordBatch.from_arrays([pa.array(left[x[kept]]), pa.array(ids[y[kept]])], names=["left", "right"])
                        else:
                            yield pa.RecordBatch.from_arrays([pa.array(left[x]), pa.array(ids[y]), pa.array(alike)], names=["left", "right", "similarity"])

    return rows.mapInArrow(run, "left long, right long" + ("" if links else ", similarity double")), shared


def similar(pairs: DataFrame, df: DataFrame, key: str, vector: str) -> DataFrame:
    """Pairs with their cosine, summed in index order."""
    one = df.select(F.col(key).alias("left"), F.col(vector).alias("_a"))
    two = df.select(F.col(key).alias("right"), F.col(vector).alias("_b"))
    return pairs.join(one, "left").join(two, "right").select("left", "right", S.cosine(F.col("_a"), F.col("_b")).alias("similarity"))


def hashed_pairs(df: DataFrame, key: str, vector: str, threshold: float, bits: int = 12, tables: int = 16, seed: int = 42) -> DataFrame:
    """Candidates share a bucket of random hyperplanes in one of the tables; each is then verified exactly. Recall grows with ``tables``."""
    dim = df.select(F.max(F.size(vector))).first()[0] or 1
    planes = np.random.default_rng(seed).normal(size=(tables, bits, dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            m, ids = matrix(b.column(vector)), b.column(key).to_numpy()
            codes = ((np.einsum("tbd,nd->ntb", planes, m) > 0) * (1 << np.arange(bits))).sum(axis=2)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, tables)), pa.array(np.tile(np.arange(tables), len(ids))), pa.array(codes.ravel())], names=["id", "table", "code"])

    coded = df.select(key, vector).mapInArrow(run, "id long, table long, code long")
    pairs = coded.alias("a").join(coded.alias("b"), (F.col("a.table") == F.col("b.table")) & (F.col("a.code") == F.col("b.code")) & (F.col("a.id") < F.col("b.id")))
    pairs = pairs.select(F.col("a.id").alias("left"), F.col("b.id").alias("right")).distinct()
    return similar(pairs, df, key, vector).filter(F.col("similarity") >= threshold)


def tables_needed(threshold: float, bits: int = BITS, recall: float = RECALL) -> int:
    """Tables with which a pair right at the threshold shares a bucket with probability ``recall``; more alike pairs do so more often."""
    same_side = 1 - math.acos(threshold) / math.pi
    return 1 if same_side == 1 else math.ceil(math.log(1 - recall) / math.log(1 - same_side**bits))


def candidate_pairs(df: DataFrame, key: str, vector: str, threshold: float) -> DataFrame:
    """Pairs at the threshold by hashing with as many tables as ``RECALL`` asks for.

    Low thresholds need so many tables that buckets hold a large part of all pairs; there ``block_pairs`` finds all.
    """
    tables = tables_needed(threshold)
    if tables > MOST_TABLES:
        return block_pairs(df, key, vector, threshold, block=EXHAUSTIVE)
    return hashed_pairs(df, key, vector, threshold, BITS, tables)


def nearest(df: DataFrame, queries: DataFrame, key: str, vector: str, k: int, block: int = 4096) -> DataFrame:
    """for each query row its k most alike other rows, (query, id, similarity, rank).

    Queries go out in blocks of about ``block``, told by the hash of their key, each gathered and sent to every executor by itself; a
    task keeps the k best of its rows per query, so what is shuffled is k rows per query and task.
    """
    spark, out = df.sparkSession, None
    asked = queries.select(F.col(key).alias("q"), F.col(vector).alias("v"))
    blocks = -(-asked.count() // block)
    for i in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == i).orderBy("q").toArrow()
        if not len(part):
            continue
        shared = spark.sparkContext.broadcast((part.column("q").to_numpy(), matrix(part.column("v"))))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, m = shared.value
            best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids)
            for b in batches:
                if not b.num_rows:
                    continue
                own = b.column(key).to_numpy()
                for i, sims in enumerate(m @ matrix(b.column(vector)).T):
                    sims = np.where(own == ids[i], -np.inf, sims)
                    s, o = np.concatenate([best[i][0], sims]), np.concatenate([best[i][1], own])
                    top = np.lexsort((o, -s))[:k]
                    best[i] = s[top], o[top]
            q = np.repeat(ids, [len(x) for x, _ in best])
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(np.concatenate([o for _, o in best])), pa.array(np.concatenate([s for s, _ in best]))], names=["query", "id", "similarity"])

        found = df.select(key, vector).mapInArrow(run, "query long, id long, similarity double")
        out = found if out is None else out.union(found)
    if out is None:
        out = spark.createDataFrame([], "query long, id long, similarity double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "id"))
    return out.filter("similarity > '-Infinity'").withColumn("rank", rank).filter(F.col("rank") <= k)


def components(edges: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """(v, root), the smallest vertex of each vertex's component, by alternating large and small stars.

    Each round is written to the shared folder; rounds grow with the logarithm of a component's size. A round
    has two shuffles, both by ``u``, and no join, since the driver holds the plans of all of them.
    """
    spark, of_u = edges.sparkSession, Window.partitionBy("u")
    e, path = materialise(edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")), "edges")
    state = None
    while True:
        both = e.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        least = both.withColumn("m", F.least(F.min("v").over(of_u), F.col("u"))).filter(F.col("v") > F.col("u"))
        large = least.select(F.col("v").alias("u"), F.col("m").alias("v")).repartition("u").distinct()
        # an edge to the smallest neighbour stays, and each other neighbour gets one to it; what repeats goes in the next round
        small = large.withColumn("m", F.min("v").over(of_u)).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        done, new_path = materialise(small, "edges")
        remove(spark, path)
        e, path = done, new_path
        row = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (found := tuple(row)) == state:
            return e.select(F.col("u").alias("v"), F.col("v").alias("root")).union(e.select(F.col("v"), F.col("v"))).distinct()
        state = found


def grouped(df: DataFrame, key: str, roots: DataFrame) -> DataFrame:
    """``df`` with representative and semantic_duplicate_count (others in its group); rows without a pair stand alone."""
    out = df.join(roots.select(F.col("v").alias("_v"), "root"), F.col(key) == F.col("_v"), "left").withColumn("representative", F.coalesce("root", key)).drop("_v", "root")
    sizes = out.groupBy("representative").agg((F.count("*") - 1).alias("semantic_duplicate_count"))
    return out.join(sizes, "representative")


def sample_pairs(groups: DataFrame, df: DataFrame, key: str, vector: str, n: int = 8) -> DataFrame:
    """The first n (representative, member) pairs with their direct similarity."""
    pairs = groups.filter(F.col(key) != F.col("representative")).select(F.col("representative").alias("left"), F.col(key).alias("right")).orderBy("left", "right").limit(n)
    return similar(pairs, df, key, vector)


def corpus(groups: DataFrame, key: str) -> DataFrame:
    """The kept rows with corpus id and count."""
    return groups.filter(F.col(key) == F.col("representative")).withColumn("corpus_id", S.corpus_id(F.col(key).cast("string")))


def invalid_groups(groups: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Counts of violations: rows in no group or in two, representatives that aren't kept, and counts that don't cover what was removed."""
    rows = df.agg(F.count("*").alias("rows"))
    found = groups.agg(F.count("*").alias("grouped"), F.count_distinct(key).alias("distinct"), F.count_if(F.col(key) == F.col("representative")).alias("kept"), F.sum(F.when(F.col(key) == F.col("representative"), F.col("semantic_duplicate_count"))).alias("removed"))
    return found.crossJoin(rows).select((F.col("rows") - F.col("grouped")).alias("ungrouped"), (F.col("grouped") - F.col("distinct")).alias("repeated"), (F.col("rows") - F.col("kept") - F.coalesce("removed", F.lit(0))).alias("uncovered"))
