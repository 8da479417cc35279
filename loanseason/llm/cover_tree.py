"""Exact top-k search by inner product, with cover trees on queries and on data.

Vectors are integers, so scores are exact. For a query node with centre q and radius r and a data
node with centre p and radius s no pair below scores more than q.p + |q| s + |p| r + r s. Nodes also
know how long their vectors are and how far these turn from the centre, which bounds a score by the
lengths and the least angle between two cones. A pair of nodes is left out when the lower bound of
the two is below the worst k-th score of the queries under the query node. The first bound works
between cells as well, which are Spark's share; both work inside a task between the nodes of two
trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loanseason.session import stored

_LEAF = 16
#: Where this many centres in a row cover fewer rows than this, nothing is left to divide by distance;
#: what is left becomes leaves of rows of like length.
_SPARSE, _PATIENCE, _SCATTERED = 4, 8, 64
#: A cell is cut at up to this many distances from its centre.
_RINGS = 64
#: Slack of bounds, relative and in radians, far above the rounding of sums and angles.
_SLACK = 1e-6
#: Numbers of an array that is only needed for a moment.
_NUMBERS_AT_ONCE = 2_000_000
#: A search splits twice as many pairs of a query node after so many rounds, and takes never more than 2**_FASTEST.
_STEPS, _FASTEST = 4, 40


@dataclass
class Node:
    """A ball around a point of the data with everything below it, and the cone it fills.

    ``short`` and ``long`` are the least and greatest length of its vectors, ``turn`` the greatest
    angle between one of them and the centre.
    """

    centre: np.ndarray
    norm: float
    radius: float
    short: float
    long: float
    turn: float
    rows: np.ndarray
    children: list[Node]


def cover_tree(points: np.ndarray, leaf: int = _LEAF, scattered: int = _SCATTERED) -> Node:
    """Batch construction: every level halves the covering radius, centres of a level are apart by more.

    Works level by level on whole sets of rows. Equal points end up in one node of radius 0. Where
    points are so far apart that centres cover next to nothing but themselves, as in many
    dimensions, what is left is sorted by length and becomes leaves of ``scattered`` rows.
    """
    lengths = np.sqrt((points**2).sum(axis=1))

    def node(rows: np.ndarray, centre: int) -> tuple[Node, np.ndarray]:
        if len(rows) == 1:
            norm = float(lengths[centre])
            return Node(points[centre], norm, 0.0, norm, norm, 0.0 if norm > 0 else math.pi, rows, []), np.zeros(1)
        far = np.sqrt(((points[rows] - points[centre]) ** 2).sum(axis=1))
        norm, turn = float(lengths[centre]), math.pi
        least = float(lengths[rows].min())
        if norm > 0 and least > 0:
            cosine = (points[rows] @ points[centre]) / (lengths[rows] * norm)
            turn = float(np.arccos(np.clip(cosine.min(), -1.0, 1.0)))
        return Node(points[centre], norm, float(far.max()), least, float(lengths[rows].max()), turn, rows, []), far

    def build(rows: np.ndarray, centre: int, cover: float) -> Node:
        made, far = node(rows, centre)
        if len(rows) <= leaf or made.radius == 0:
            return made
        scale = min(cover, made.radius) / 2
        left, distance, sparse, thin = rows, far, 0, []
        while len(left):
            if sparse == _PATIENCE:
                thin.append(left)
                break
            # The centre itself covers first; after it the farthest row that nobody covers.
            pick = centre if left is rows else left[int(np.argmax(distance))]
            near = np.sqrt(((points[left] - points[pick]) ** 2).sum(axis=1)) <= scale
            near |= left == pick
            if near.sum() < _SPARSE:
                thin.append(left[near])
                sparse += 1
            else:
                made.children.append(build(left[near], pick, scale))
                sparse = 0
            left, distance = left[~near], distance[~near]
        if thin:
            alone = np.concatenate(thin)
            alone = alone[np.argsort(-lengths[alone], kind="stable")]
            for k in range(0, len(alone), scattered):
                part = alone[k : k + scattered]
                made.children.append(node(part, part[0])[0])
        return made

    return build(np.arange(len(points)), 0, np.inf)


def _ceiling(product, q: tuple, p: tuple):
    """No vector in one ball and cone scores more than this with one in the other, whose centres score ``product``.

    A side is norm, radius, short, long and turn, each a number or one for each pair.
    """
    norm, radius, short, long, turn = (np.asarray(x) for x in q)
    other_norm, other_radius, other_short, other_long, other_turn = (np.asarray(x) for x in p)
    ball = product + norm * other_radius + other_norm * radius + radius * other_radius
    lengths = norm * other_norm
    apart = np.arccos(np.clip(product / np.where(lengths > 0, lengths, 1.0), -1.0, 1.0))
    cosine = np.cos(np.maximum(0.0, apart - turn - other_turn - _SLACK))
    cone = cosine * np.where(cosine >= 0, long * other_long, short * other_short)
    top = np.where(lengths > 0, np.minimum(ball, cone), ball)
    return top + np.abs(top) * _SLACK + _SLACK


def _shape(node: Node) -> tuple[float, ...]:
    return node.norm, node.radius, node.short, node.long, node.turn


def bound(q: Node, p: Node) -> float:
    """No vector under one node scores more than this with one under the other."""
    return float(_ceiling(float(q.centre @ p.centre), _shape(q), _shape(p)))


class _Flat:
    """A tree as arrays, a node's children side by side, and the rows of all nodes one after another."""

    def __init__(self, root: Node) -> None:
        nodes, self.child, self.levels = [root], [], [0, 1]
        for k, node in enumerate(nodes):
            if k == self.levels[-1]:
                self.levels.append(len(nodes))
            self.child.append(len(nodes))
            nodes.extend(node.children)
        self.child = np.array(self.child)
        self.children = np.array([len(node.children) for node in nodes])
        self.parent = np.r_[0, np.repeat(np.arange(len(nodes)), self.children)]
        self.centres = np.array([node.centre for node in nodes])
        self.shapes = np.array([_shape(node) for node in nodes]).T
        self.radius = self.shapes[1]
        self.sizes = np.array([len(node.rows) for node in nodes])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.rows = np.concatenate([node.rows for node in nodes])

    def lowest(self, floors: np.ndarray) -> np.ndarray:
        """The worst floor below each node."""
        return np.minimum.reduceat(floors[self.rows], self.first)

    def above(self, best: np.ndarray) -> np.ndarray:
        """For each node the greatest of ``best`` among those it lies below."""
        out = np.full(len(best), -np.inf)
        for begin, end in zip(self.levels[1:], [*self.levels[2:], len(best)]):
            parent = self.parent[begin:end]
            out[begin:end] = np.maximum(out[parent], best[parent])
        return out


def _bounds(q: _Flat, at: np.ndarray, p: _Flat, other: np.ndarray) -> np.ndarray:
    """``bound`` of many pairs of nodes, so many at a time as bounded memory holds."""
    out = np.empty(len(at))
    some = max(1, _NUMBERS_AT_ONCE // max(1, q.centres.shape[1]))
    for k in range(0, len(at), some):
        a, b = at[k : k + some], other[k : k + some]
        product = np.einsum("ij,ij->i", q.centres[a], p.centres[b])
        out[k : k + some] = _ceiling(product, tuple(q.shapes[:, a]), tuple(p.shapes[:, b]))
    return out


def _spread(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of whole numbers: which range, and the number, for all of them one after another."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + first[which]


def _place_in_group(groups: np.ndarray) -> np.ndarray:
    """Place of each entry in its run of equal numbers, from 0."""
    begins = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else groups
    return np.arange(len(groups)) - np.repeat(begins, np.diff(np.r_[begins, len(groups)]))


class _Best:
    """The k best (score, smaller id) of each query so far, and the floor it began with."""

    def __init__(self, query_ids: np.ndarray, k: int, floors: np.ndarray) -> None:
        self.query_ids, self.k, self.floors = query_ids, k, floors.astype(np.float64)
        self.rows = self.scores = self.ids = np.zeros(0, dtype=np.int64)

    def offer(self, rows: list[np.ndarray], scores: list[np.ndarray], ids: list[np.ndarray]) -> None:
        """Take what is among the best; a query's own id is not, and a score counts once for an id."""
        row, score, number = (np.concatenate(x) for x in ([self.rows, *rows], [self.scores, *scores], [self.ids, *ids]))
        other = number != self.query_ids[row]
        row, score, number = row[other], score[other], number[other]
        order = np.lexsort((number, ~score, row))
        row, score, number = row[order], score[order], number[order]
        same = (row[1:] == row[:-1]) & (score[1:] == score[:-1]) & (number[1:] == number[:-1])
        fresh = np.r_[True, ~same][: len(row)]
        row, score, number = row[fresh], score[fresh], number[fresh]
        place = _place_in_group(row)
        kept = place < self.k
        self.rows, self.scores, self.ids = row[kept], score[kept], number[kept]
        last = place == self.k - 1
        self.floors[row[last]] = np.maximum(self.floors[row[last]], score[last])


def _multiplier(queries: np.ndarray, data: np.ndarray):
    """Exact inner products of rows; as floating-point numbers where no sum on the way leaves their whole numbers."""
    longest = [float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0))) for m in (queries, data)]
    if longest[0] * longest[1] < 2.0**52:
        as_query, as_float = queries.astype(np.float64), data.astype(np.float64)
        return lambda a, b: as_query[a] @ as_float[b].T
    return lambda a, b: queries[a] @ data[b].T


def dual_search(
    queries: np.ndarray,
    query_ids: np.ndarray,
    floors: np.ndarray,
    data: np.ndarray,
    ids: np.ndarray,
    k: int,
    scored: list[int] | None = None,
) -> Iterator[tuple[int, int, int]]:
    """Rows (query id, data id, score) that hold each query's k best of this data above its floor.

    Works in rounds, each on arrays of pairs. A round takes every query node's pairs of best bound,
    unless a node above has a pair of better bound, and splits or scores them; then what can no
    longer reach the floors goes. It takes one pair at first and twice as many whenever all queries
    below the node have been scored again; pairs to split also after every ``_STEPS`` rounds.
    The tree of queries goes down to single ones, as those
    far from each other share no bound; close ones meet a leaf of data together. Scores equal to a
    floor count, for ties go by id. ``scored``, where given, takes the number of pairs scored at each leaf of data.
    """
    best = _Best(query_ids, k, floors)
    product = _multiplier(queries, data)
    q = _Flat(cover_tree(queries.astype(np.float64), leaf=1, scattered=1))
    p = _Flat(cover_tree(data.astype(np.float64)))
    at = other = np.zeros(1, dtype=np.int64)
    top = _bounds(q, at, p, other)
    times, rounds, in_order = np.zeros(len(queries), dtype=np.int64), 0, False
    while len(at):
        pace = np.minimum(q.lowest(times), _FASTEST)
        haste = np.minimum(pace + rounds // _STEPS, _FASTEST)
        rounds += 1
        if not in_order:
            order = np.lexsort((-top, at))
            at, other, top = at[order], other[order], top[order]
        place = _place_in_group(at)
        greatest = np.full(len(pace), -np.inf)
        greatest[at[place == 0]] = top[place == 0]

        together = (q.children[at] == 0) | ((q.sizes[at] <= _LEAF) & (q.radius[at] <= p.radius[other]))
        meet = together & (p.children[other] == 0)
        taken = (place < 2 ** np.where(meet, pace[at], haste[at])) & (top >= q.above(greatest)[at])
        a, b, meet = at[taken], other[taken], meet[taken]
        at, other, top = at[~taken], other[~taken], top[~taken]
        if meet.any():
            times += _score(q, a[meet], p, b[meet], product, ids, best, scored)
        a, b = a[~meet], b[~meet]
        in_order = not len(a)
        if len(a):
            by_query = (q.children[a] > 0) & ((p.children[b] == 0) | (q.radius[a] > p.radius[b]))
            of_query, q_child = _spread(q.child[a[by_query]], q.children[a[by_query]])
            of_data, p_child = _spread(p.child[b[~by_query]], p.children[b[~by_query]])
            a, b = np.r_[q_child, a[~by_query][of_data]], np.r_[b[by_query][of_query], p_child]
            at, other, top = np.r_[at, a], np.r_[other, b], np.r_[top, _bounds(q, a, p, b)]
        open_still = top >= q.lowest(best.floors)[at]
        at, other, top = at[open_still], other[open_still], top[open_still]
    yield from zip(query_ids[best.rows].tolist(), best.ids.tolist(), best.scores.tolist())


def _score(
    q: _Flat, a: np.ndarray, p: _Flat, b: np.ndarray, product, ids: np.ndarray, best: _Best, scored: list[int] | None
) -> np.ndarray:
    """Score pairs of query nodes and leaves of data, all queries of a leaf at once; marks these queries."""
    of_pair, at = _spread(q.first[a], q.sizes[a])
    asked, leaves = q.rows[at], b[of_pair]
    order = np.argsort(leaves, kind="stable")
    asked, leaves = asked[order], leaves[order]
    edges = np.r_[np.flatnonzero(np.r_[True, leaves[1:] != leaves[:-1]]), len(leaves)]
    rows, values, numbers = [], [], []
    for begin, end in zip(edges, edges[1:]):
        leaf = leaves[begin]
        of_leaf = p.rows[p.first[leaf] : p.first[leaf] + p.sizes[leaf]]
        some = max(1, _NUMBERS_AT_ONCE // len(of_leaf))
        for start in range(begin, end, some):
            meeting = asked[start : min(end, start + some)]
            scores = product(meeting, of_leaf)
            if scored is not None:
                scored.append(scores.size)
            x, y = np.nonzero(scores >= best.floors[meeting][:, None])
            rows.append(meeting[x])
            values.append(scores[x, y].astype(np.int64))
            numbers.append(ids[of_leaf[y]])
    best.offer(rows, values, numbers)
    met = np.zeros(len(best.floors), dtype=np.int64)
    met[asked] = 1
    return met


def integer_components(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    """Not NULL, and nothing in it that is NULL, NaN or infinite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & finite


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    merged = column.combine_chunks()
    flat = merged.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(merged), -1) if len(merged) else flat.reshape(0, 0)


def _to_nearest(centres: dict[int, np.ndarray]):
    """Number of the nearest centre among those of the same dimension."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros(batch.num_rows, dtype=np.int64)
            far = np.zeros(batch.num_rows)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                among = centres.get(dim)
                if among is None or not dim:
                    continue
                rows, squares = np.flatnonzero(dims == dim), (among**2).sum(axis=1)
                some = max(1, _NUMBERS_AT_ONCE // max(dim, len(among)))
                for k in range(0, len(rows), some):
                    part = rows[k : k + some]
                    flat = batch.column("vector").take(pa.array(part)).flatten().to_numpy(zero_copy_only=False)
                    vectors = flat.reshape(len(part), dim).astype(np.float64)
                    cells[part] = np.argmin(squares - 2 * (vectors @ among.T), axis=1)
                    far[part] = np.sqrt(((vectors - among[cells[part]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells), pa.array(far)], names=[*batch.schema.names, "cell", "far"]
            )

    return assign


def _searcher(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list = []
        if left.num_rows and right.num_rows:
            rows = list(
                dual_search(
                    _matrix(left["vector"]),
                    left["id"].to_numpy(),
                    left["floor"].to_numpy(),
                    _matrix(right["vector"]),
                    right["id"].to_numpy(),
                    k,
                )
            )
        return pa.table(
            {
                "query_id": pa.array([r[0] for r in rows], pa.int64()),
                "vec_id": pa.array([r[1] for r in rows], pa.int64()),
                "score": pa.array([r[2] for r in rows], pa.int64()),
            }
        )

    return search


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def smallest_of_equal(rows: DataFrame, most: int) -> DataFrame:
    """Distinct rows, of equal vectors those with the ``most`` smallest ids; each task sends no more than that."""
    place = F.row_number().over(W.partitionBy("vector").orderBy("id"))
    return rows.distinct().withColumn("place", place).filter(F.col("place") <= most).drop("place")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cells: int = 1024,
    block: int = 4096,
    query_block: int = 2048,
    seed: int = 7,
) -> DataFrame:
    """The k best other rows of every query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Rows that repeat an id and its vector count once. Of equal vectors only the k + 1 smallest
    ids can ever be among the best, so the others go before anything else; a vector that a third
    of all rows share becomes a handful of rows per task before they meet. Up to ``cells``
    vectors, drawn by the hash of their ids, are the upper level of both trees, as many of them as
    the rows fill blocks; every row goes to the nearest. Cells are cut by distance from their
    centre into blocks of about ``block`` rows, or ``query_block`` queries, so that inner blocks
    have smaller radii, and each pair of blocks that can matter is searched in a task of its own.

    First every block of queries meets the one data block with the greatest bound. Its k-th
    scores then rule out pairs of blocks, and the search floor of what is left is set by them.

    Vectors that are NULL or hold NULL or non-finite components take no part, neither do rows
    with a NULL id. Vectors of different dimension never meet. Rows that repeat an id are
    different vectors under one name, equal scores of which count once; a query never finds its own id. Components must be small
    enough for an inner product to fit in 64 bits. Without queries or data there are no rows.
    """
    good = (
        vectors.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
        .select(
            F.col(id_col).cast("long").alias("id"),
            is_query.alias("is_query"),
            integer_components(F.col(vector_col)).alias("vector"),
        )
        .withColumn("dim", F.size("vector"))
    )
    data, seen = stored(smallest_of_equal(good.select("id", "vector", "dim"), k + 1), "cover-data")
    drawn = (
        data.withColumn("draw", F.row_number().over(W.partitionBy("dim").orderBy(F.xxhash64("id", F.lit(seed)), "id")))
        .filter(F.col("draw") <= cells)
        .select("dim", "vector")
    )
    centres: dict[int, list] = {}
    for row in drawn.collect():
        centres.setdefault(row["dim"], []).append(row["vector"])
    points = {dim: np.array(rows, dtype=np.float64) for dim, rows in centres.items()}

    def celled(rows: DataFrame, name: str, total: int, most: int) -> tuple[DataFrame, DataFrame]:
        """Rows in blocks, and for each block its centre's number and its radius."""
        used = {dim: among[: math.ceil(total / most) or 1] for dim, among in points.items()}
        placed, _ = stored(
            rows.select("id", "vector", "dim").mapInArrow(
                _to_nearest(used), "id long, vector array<long>, dim int, cell long, far double"
            ),
            f"cover-{name}-cells",
        )
        marks = [ring / _RINGS for ring in range(1, _RINGS)]
        edges = placed.groupBy("dim", "cell").agg(
            F.count("*").alias("n"), F.percentile_approx("far", marks).alias("edges")
        )
        parts = F.least(F.ceil(F.col("n") / most), F.lit(_RINGS))
        inside = F.size(F.filter("edges", lambda edge: edge < F.col("far")))
        # What is known of cells and rings is small, so rows stay where they are.
        ringed = placed.join(F.broadcast(edges), ["dim", "cell"]).withColumn("ring", F.floor(inside * parts / _RINGS)).drop("edges", "n")
        # Rows at equal distances share a ring; where that makes it large, the hash of their ids cuts it.
        sizes = ringed.groupBy("dim", "cell", "ring").agg(F.count("*").alias("n"))
        cut = ringed.join(F.broadcast(sizes), ["dim", "cell", "ring"]).withColumn(
            "part", F.pmod(F.xxhash64("id", F.lit(seed)), F.ceil(F.col("n") / (2 * most)))
        )
        cut = cut.withColumn("block", F.concat_ws("-", "dim", "cell", "ring", "part")).select(
            "id", "vector", "dim", "cell", "far", "block"
        )
        cut, _ = stored(cut, f"cover-{name}")
        return cut, cut.groupBy("block", "dim", "cell").agg(F.max("far").alias("radius"))

    queries, asked_for = stored(good.filter("is_query").select("id", "vector", "dim").distinct(), "cover-asked")
    data_rows, data_blocks = celled(data, "data", seen["rows"], block)
    query_rows, query_blocks = celled(queries, "queries", asked_for["rows"], query_block)

    centre_rows = vectors.sparkSession.createDataFrame(
        [(dim, c, p.tolist()) for dim, among in points.items() for c, p in enumerate(among)],
        "dim int, cell long, centre array<double>",
    )
    product = F.aggregate(F.zip_with("qc", "pc", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    squared = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, b: a + b * b))
    queries_at = query_blocks.join(centre_rows, ["dim", "cell"]).select(
        "dim", F.col("block").alias("qb"), F.col("radius").alias("qr"), F.col("centre").alias("qc")
    )
    data_at = data_blocks.join(centre_rows, ["dim", "cell"]).select(
        "dim", F.col("block").alias("pb"), F.col("radius").alias("pr"), F.col("centre").alias("pc")
    )
    top = product + squared("qc") * F.col("pr") + squared("pc") * F.col("qr") + F.col("qr") * F.col("pr")
    pairs, _ = stored(
        queries_at.join(data_at, "dim").select("qb", "pb", (top + F.abs(top) * 1e-6 + 1e-6).alias("top")), "cover-pairs"
    )
    first = W.partitionBy("qb").orderBy(F.desc("top"), "pb")
    begin = pairs.withColumn("place", F.row_number().over(first)).filter("place = 1").select("qb", "pb")

    def searched(chosen: DataFrame, floors: DataFrame, name: str) -> DataFrame:
        asked = query_rows.withColumnRenamed("block", "qb").join(chosen, "qb").join(floors, "id")
        asked = asked.select("qb", "pb", "id", "vector", "floor")
        offered = data_rows.withColumnRenamed("block", "pb").join(chosen, "pb").select("qb", "pb", "id", "vector")
        both = asked.groupBy("qb", "pb").cogroup(offered.groupBy("qb", "pb"))
        return stored(both.applyInArrow(_searcher(k), "query_id long, vec_id long, score long"), name)[0]

    lowest = -(2.0**62)
    none = query_rows.select("id").distinct().withColumn("floor", F.lit(lowest))
    early = searched(begin, none, "cover-early")
    reached = _ranked(early.distinct(), k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor"))
    floors, _ = stored(
        none.select("id").join(reached, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(lowest))), "cover-floors"
    )
    worst = query_rows.join(floors, "id").groupBy(F.col("block").alias("qb")).agg(F.min("floor").alias("worst"))
    rest = pairs.join(worst, "qb").filter("top >= worst").join(begin, ["qb", "pb"], "left_anti").select("qb", "pb")
    late = searched(stored(rest, "cover-rest")[0], floors, "cover-late")
    best = _ranked(early.union(late).distinct(), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
