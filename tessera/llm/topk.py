"""Exact top-k by inner product: dual-tree search over cover trees.

Rows are dealt to blocks around a bounded set of centres, and a cover tree is
built in every block, of queries and of data alike: a node stands for the
points within its covering radius of its point, and its children cover them at
half that radius.  For a query node and a data node

    score <= cq.cd + |cq| Rd + |cd| Rq + Rq Rd

so a pair of nodes is dropped when that is below the smallest k-th score found
so far for the queries of the node.

A query block first meets the data block with the highest bound; the k-th
scores found there then prune the other pairs of blocks, before any of their
rows moves, and the pairs of nodes within those that remain.  No bound is
rounded down and ties go on, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, read_table, ship_by_value, written
from tessera.llm.shingles import sorted_groups

ship_by_value(__name__)

K = 20
QUERY_STEP = 20
SCALE = 64
#: Rows a block holds on average; a task holds two blocks.
BLOCK = 2048
#: At most so many centres shape the blocks, and so many block summaries are held at a time.
CENTRES, SUMMARIES = 1024, 4096
LEAF = 32
#: Tasks that share the data blocks of a query block.
HANDS = 4

BLOCKS = "block long, size int, width int, middle array<double>, norm double, radius double, ids binary, vectors binary, kind string, tree binary"
FOUND = "qblock long, query_no int, query_id long, vec_ids array<long>, scores array<long>"


class CoverTree:
    """Nodes over the rows of ``points``; ``order`` lists the rows so that every node holds a stretch."""

    def __init__(self, points: np.ndarray):
        self.order: list[int] = []
        self.nodes: list[list] = []  # point, radius, first and last place, children
        if len(points):
            self._grow(points.astype(np.float64), np.arange(len(points)))

    def _grow(self, points: np.ndarray, own: np.ndarray) -> int:
        far = np.sqrt(((points[own] - points[own[0]]) ** 2).sum(axis=1))
        radius = float(far.max())
        me = len(self.nodes)
        self.nodes.append([int(own[0]), radius * (1 + 1e-12), len(self.order), 0, []])
        if len(own) <= LEAF or radius == 0:  # equal points are one leaf, however many
            self.order.extend(own.tolist())
        else:
            shared: list[np.ndarray] = []  # children of a few points share leaves
            while len(own):
                near = far <= radius / 2
                part, own = own[near], own[~near]
                if len(part) > LEAF // 2:
                    self.nodes[me][4].append(self._grow(points, part))
                else:
                    shared.append(part)
                if shared and (sum(map(len, shared)) > LEAF // 2 or not len(own)):
                    self.nodes[me][4].append(self._grow(points, np.concatenate(shared)))
                    shared = []
                if len(own):
                    far = np.sqrt(((points[own] - points[own[0]]) ** 2).sum(axis=1))
        self.nodes[me][3] = len(self.order)
        return me


class Side:
    """A block with its tree, ready for a search."""

    def __init__(self, ids: bytes, vectors: bytes, kind: str, tree: bytes, width: int):
        import pickle

        self.ids = np.frombuffer(ids, np.int64)
        whole = np.frombuffer(vectors, kind).reshape(len(self.ids), -1)
        most = int(np.abs(whole.astype(np.float64)).max()) if whole.size else 0
        # products of doubles are exact while the sums stay below 2^53
        self.small = most * most * max(1, whole.shape[1]) < 1 << 52
        self.whole = whole
        points, radius, first, last, self.children = pickle.loads(tree)
        self.points = whole[points].astype(np.float64)
        self.norm = np.sqrt((self.points ** 2).sum(axis=1)) * (1 + 1e-12)
        self.radius, self.first, self.last = np.array(radius), np.array(first), np.array(last)


def _kind(low: int, high: int) -> str:
    return next(k for k in ("i1", "i2", "i4", "i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)


def _products(queries: np.ndarray, data: np.ndarray, small: bool) -> np.ndarray:
    if small:
        return np.rint(queries.astype(np.float64) @ data.astype(np.float64).T).astype(np.int64)
    return queries.astype(np.int64) @ data.astype(np.int64).T


def nothing_yet(queries: Side) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(queries.ids)


def dual_search(queries: Side, data: Side, k: int, least: np.ndarray, best: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Bring ``best``, per query of the block (ids, scores) of up to ``k`` rows, up to date with a data block.

    Only scores that reach a query's ``least`` (-inf where unknown) count;
    both rise as the search goes on.
    """
    small = queries.small and data.small
    if not len(queries.ids) or not len(data.ids):
        return

    def bounds(q: int, nodes: np.ndarray) -> np.ndarray:
        high = data.points[nodes] @ queries.points[q] + queries.norm[q] * data.radius[nodes] + queries.radius[q] * (data.norm[nodes] + data.radius[nodes])
        return high + np.abs(high) * 1e-9 + 1e-6

    def scan(lo: int, hi: int, nodes: np.ndarray) -> None:
        """A query leaf against data leaves, the most promising first."""
        own = queries.whole[lo:hi]
        at, many = 0, 2 * k
        while at < len(nodes):
            take, rows = at, []
            while take < len(nodes) and sum(map(len, rows)) < many:
                rows.append(np.arange(data.first[nodes[take]], data.last[nodes[take]]))
                take += 1
            cols = np.concatenate(rows)
            scores, ids = _products(own, data.whole[cols], small), data.ids[cols]
            for i in range(hi - lo):
                chosen = (scores[i] >= least[lo + i]) & (ids != queries.ids[lo + i])
                if not chosen.any():
                    continue
                all_ids = np.concatenate([best[lo + i][0], ids[chosen]])
                all_scores = np.concatenate([best[lo + i][1], scores[i][chosen]])
                first = np.lexsort((all_ids, -all_scores))[:k]
                best[lo + i] = all_ids[first], all_scores[first]
                if len(first) == k:
                    least[lo + i] = max(least[lo + i], all_scores[first[-1]])
            at, many = take, min(2 * many, 512)
            if at < len(nodes) and highs[nodes[at]] < least[lo:hi].min():
                break

    highs = np.empty(len(data.first))
    stack = [(0, np.zeros(1, np.int64))]
    while stack:
        q, nodes = stack.pop()
        lo, hi = queries.first[q], queries.last[q]
        leaf, ready = not queries.children[q], []
        while len(nodes):
            high = bounds(q, nodes)
            kept = high >= least[lo:hi].min()
            nodes = nodes[kept]
            highs[nodes] = high[kept]
            # the larger side is opened first; a query leaf goes down to data leaves
            open_ = np.array([bool(data.children[n]) and (leaf or data.radius[n] > queries.radius[q]) for n in nodes], bool)
            ready.append(nodes[~open_] if len(nodes) else nodes)
            nodes = np.array([c for n in nodes[open_] for c in data.children[n]], np.int64) if len(nodes) else nodes
        ready = np.concatenate(ready) if ready else np.empty(0, np.int64)
        ready = ready[np.argsort(-highs[ready], kind="stable")]
        if leaf:
            scan(lo, hi, ready)
        elif len(ready):
            stack.extend((c, ready) for c in queries.children[q])


def _deal(centres):
    """Each row's nearest centre; vectors of other lengths are compared as if filled with zeros."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = centres.value
        for batch in batches:
            points = _matrix(batch["vector"], known.shape[1]).astype(np.float64)[:, :known.shape[1]]
            near = ((known ** 2).sum(axis=1) - 2 * points @ known.T).argmin(axis=1) if len(batch) else np.empty(0, int)
            yield batch.assign(centre=near.astype(np.int32))

    return run


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    width = max([width, *map(len, vectors)])
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _plant(width: int):
    """A row per block: its points in the order of its cover tree, and the tree."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pickle

        for block, rows in sorted_groups(batches, "block"):
            rows = rows.sort_values("vec_id", kind="stable")
            points = _matrix(rows["vector"], width)
            tree = CoverTree(points)
            order = np.array(tree.order)
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            places, radius, first, last, children = zip(*tree.nodes, strict=True)
            points = points[order]
            kind = _kind(int(points.min(initial=0)), int(points.max(initial=0)))
            middle = points[back[places[0]]].astype(np.float64)
            yield pd.DataFrame({
                "block": [int(block)], "size": [len(order)], "width": [points.shape[1]], "middle": [middle.tolist()], "norm": [float(np.sqrt((middle ** 2).sum()))],
                "radius": [radius[0]], "ids": [rows["vec_id"].to_numpy(np.int64)[order].tobytes()], "vectors": [points.astype(kind).tobytes()], "kind": [kind],
                "tree": [pickle.dumps((back[list(places)].tolist(), radius, first, last, children))]})

    return run


def whole_vectors(rows: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, vector) with every component floor(scale * x), of the rows whose id and components are all there and finite."""
    x = F.col(vector)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == F.lit(float("inf"))))
    return (rows.filter(F.col(id_column).isNotNull() & x.isNotNull() & ~F.coalesce(odd, F.lit(False)))
            .select(F.col(id_column).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("vector")))


def _blocks(rows: DataFrame, centres, width: int, name: str) -> DataFrame:
    """``rows`` in blocks around the centres, a tree each, written.  A centre with many rows has many blocks."""
    spark = rows.sparkSession
    near = written(rows.mapInPandas(_deal(centres), "vec_id long, vector array<long>, centre int")
                   .withColumn("no", F.monotonically_increasing_id()), f"{name}-dealt")
    parts = near.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("parts"))
    # at most CENTRES rows
    block = F.col("centre").cast("long") * F.lit(1 << 32) + F.pmod(F.xxhash64("no"), F.col("parts"))
    dealt = near.join(F.broadcast(parts), "centre").select("vec_id", "vector", block.alias("block"))
    return written(dealt.repartition(partitions(spark), "block").sortWithinPartitions("block").mapInPandas(_plant(width), BLOCKS), name)


def _pairs(summaries):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, middles, norms, radii = summaries.value
        for batch in batches:
            rows = []
            for block, middle, norm, radius, worst in batch.itertuples(index=False):
                own = np.zeros(middles.shape[1])
                own[:min(len(middle), len(own))] = middle[:len(own)]
                high = middles @ own + norm * radii + radius * (norms + radii)
                high += np.abs(high) * 1e-9 + 1e-6
                keep = np.flatnonzero(high >= (-np.inf if worst is None or worst != worst else worst))
                rows.extend((int(block), int(ids[i]), float(high[i])) for i in keep)
            yield pd.DataFrame(rows, columns=["qblock", "dblock", "high"])

    return run


def _block_pairs(queries: DataFrame, data: DataFrame) -> DataFrame:
    """(qblock, dblock, high) of the pairs whose bound reaches the query block's worst k-th score (``worst``, may be null).

    The data blocks' summaries are held a bounded number at a time.
    """
    spark = queries.sparkSession
    slices = -(-data.count() // SUMMARIES)
    asked = queries.select("block", "middle", "norm", "radius", "worst")
    out = None
    for i in range(slices):
        rows = data.filter(F.pmod(F.xxhash64("block"), F.lit(slices)) == i).select("block", "middle", "norm", "radius").collect()
        if not rows:
            continue
        width = max(len(r.middle) for r in rows)
        middles = np.array([[*r.middle, *[0.0] * (width - len(r.middle))] for r in rows]).reshape(len(rows), width)
        shared = spark.sparkContext.broadcast((np.array([r.block for r in rows]), middles, np.array([r.norm for r in rows]), np.array([r.radius for r in rows])))
        pairs = asked.mapInPandas(_pairs(shared), "qblock long, dblock long, high double")
        out = pairs if out is None else out.unionAll(pairs)
    return out


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, queries, least, best = None, None, None, []

        def told() -> pd.DataFrame:
            return pd.DataFrame([(at[0], i, int(queries.ids[i]), ids.tolist(), scores.tolist()) for i, (ids, scores) in enumerate(best)],
                                columns=["qblock", "query_no", "query_id", "vec_ids", "scores"])

        for batch in batches:
            for r in batch.itertuples(index=False):
                if at != (r.qblock, r.hand):
                    if at is not None:
                        yield told()
                    at, queries = (r.qblock, r.hand), Side(r.q_ids, r.q_vectors, r.q_kind, r.q_tree, r.q_width)
                    least = np.full(len(queries.ids), -np.inf) if r.least is None else np.frombuffer(r.least, np.float64).copy()
                    best = nothing_yet(queries)
                dual_search(queries, Side(r.d_ids, r.d_vectors, r.d_kind, r.d_tree, r.d_width), k, least, best)
        if at is not None:
            yield told()

    return run


def _searched(pairs: DataFrame, queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """The best rows of each query block and hand: a hand meets its data blocks one after another, the best bound first."""
    spark = pairs.sparkSession
    side = lambda df, key, p, more=(): df.select(F.col("block").alias(key), *[F.col(c).alias(f"{p}_{c}") for c in ("ids", "vectors", "kind", "tree", "width")], *more)
    joined = (pairs.select("qblock", "dblock", "high", F.pmod(F.xxhash64("dblock"), F.lit(HANDS)).alias("hand"))
              .join(side(queries, "qblock", "q", ["least"]), "qblock").join(side(data, "dblock", "d"), "dblock"))
    return (joined.repartition(partitions(spark), "qblock", "hand").sortWithinPartitions("qblock", "hand", F.desc("high"), "dblock")
            .mapInPandas(_search(k), FOUND))


def _least(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, rows in sorted_groups(batches, "qblock"):
            kth = [s[k - 1] if len(s) >= k else -np.inf for s in rows.sort_values("query_no")["scores"]]
            yield pd.DataFrame({"block": [int(block)], "least": [np.array(kth, np.float64).tobytes()], "worst": [float(min(kth))]})

    return run


def top_k(queries: DataFrame, data: DataFrame, k: int = K, id_column: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for every query row the ``k`` rows of ``data`` with the highest inner product.

    Components count as floor(scale * x); ties go to the smaller id; rows with
    the query's id are its own and left out.  All are returned if there are
    fewer than ``k``.

    Rows with a null id, a null vector or a null or non-finite component take
    no part.  Vectors of different lengths: missing components are 0.
    Repeated rows are candidates each; queries equal in id and vector count
    once.  Empty tables: empty result.  Other columns are not read.  Scores
    are exact while they fit a long.
    """
    spark = data.sparkSession
    rows = written(whole_vectors(data, id_column, vector, scale), "vectors")
    asked = whole_vectors(queries, id_column, vector, scale).distinct()
    total, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not total:
        return empty
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(CENTRES, max(1, -(-total // BLOCK)))).collect()
    centres = spark.sparkContext.broadcast(_matrix(pd.Series([r.vector for r in sample]), width).astype(np.float64))
    data_blocks = _blocks(rows, centres, width, "data")
    query_blocks = _blocks(asked, centres, width, "queries").withColumn("worst", F.lit(None).cast("double")).withColumn("least", F.lit(None).cast("binary"))
    pairs = written(_block_pairs(query_blocks, data_blocks), "pairs")
    best = pairs.groupBy("qblock").agg(F.max_by("dblock", F.struct("high", "dblock")).alias("dblock"), F.max("high").alias("high"))
    first = written(_searched(best, query_blocks, data_blocks, k), "first")
    known = written(first.select("qblock", "query_no", "scores").repartition(partitions(spark), "qblock").sortWithinPartitions("qblock")
                    .mapInPandas(_least(k), "block long, least binary, worst double"), "least")
    bounded = query_blocks.drop("worst", "least").join(known, "block")
    worst = known.select(F.col("block").alias("qblock"), "worst")
    # what the bound of the first round's scores leaves, but for the pairs searched
    rest = pairs.join(worst, "qblock").filter("high >= worst").join(best.select("qblock", "dblock"), ["qblock", "dblock"], "left_anti")
    second = _searched(rest, bounded, data_blocks, k)
    found = first.unionAll(second).select("query_id", "qblock", "query_no", F.explode(F.arrays_zip("vec_ids", "scores")).alias("x"))
    place = Window.partitionBy("qblock", "query_no").orderBy(F.desc("score"), "vec_id")
    return (found.select("query_id", "qblock", "query_no", F.col("x.vec_ids").alias("vec_id"), F.col("x.scores").alias("score"))
            .withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return top_k(rows.filter(F.col("vec_id") % QUERY_STEP == 0), rows)


SQL = f"""
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
           FROM whole q JOIN whole d ON q.vec_id <> d.vec_id WHERE q.vec_id % {QUERY_STEP} = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= {K}
"""
