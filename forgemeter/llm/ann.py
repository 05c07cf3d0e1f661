"""Approximate nearest neighbours by inner product over balanced posting lists.

Index. Centroids come from halving a bounded sample again and again at the
median between two means, then a few rounds of k-means, so lists are of about
equal length. Largest inner products become smallest distances by one more
coordinate, sqrt(M^2 - |x|^2) with M the largest norm (zero for queries, which
are scaled to norm M). Every vector goes to the list of its nearest centroid; a
boundary vector is replicated to the next nearest too. What a boundary is, is
measured: the ratio of the second distance to the first that a share of
``REPLICATED`` of ``BOUNDARY_ROWS`` vectors of the sample does not exceed, but no
more than ``RATIO``, beyond which vectors stand clearly in one cluster.

Search. The centroids form a graph of nearest neighbours, small enough for the
memory of a task. A search starts at a few spread entries and goes on from every
centroid within a ratio of its reach so far; the lists kept are those within that
ratio of the reach. The reach is the distance of the nearest lists that together
hold enough vectors for an answer: the nearest centroid's, but for a query that
stands alone in its list, at no distance from it, that of the lists around. The
ratio is read off the fitted index: the true answers of ``SAMPLE_QUERIES`` query
rows are found by brute force, copies and ties as in the result, and the ratio is
raised from ``RATIO`` until the lists it opens for these queries hold ``RECALL``
of the answers. So a query in a clear cluster reads a few lists, one between all
clusters many; nothing is capped.

Ties. Equal scores go by id before any cut, so where many vectors are equally
near (whole-number or sparse entries) those with the smallest ids are kept.

Hot vectors. Equal vectors are one row of the index with their smallest ids (no
more than k + 1 of them can be in any answer). Lists are dealt to groups; a
group with too many vectors is split by a salt, one with too many queries into
blocks, so a task holds ``GROUP_VECTORS`` vectors and ``GROUP_QUERIES`` queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgemeter.session import settle

K = 20
LIST_VECTORS = 128
FIT_VECTORS = 32_768
FIT_VECTORS_A_LIST = 16
MOST_CENTROIDS = 8_192
GROUP_VECTORS = 8_192
GROUP_QUERIES = 4_096
REPLICATED = 0.3
LISTS_A_VECTOR = 2
BOUNDARY_ROWS = 2_048
RATIO = 1.22
RECALL = 0.97
SAMPLE_QUERIES = 256
DEGREE = 24
ENTRIES = 16
ROWS_AT_ONCE = 64
PAIRS_AT_ONCE = 100_000
NEAREST_LISTS = 32
# A reach is at least this share of the queries' norm, so that a ratio always widens it.
LEAST_REACH = 1e-6


# The index in memory --------------------------------------------------------


def _halves(rows: np.ndarray, members: np.ndarray, depth: int) -> list[np.ndarray]:
    if depth == 0 or len(members) < 2:
        return [members]
    own = rows[members]
    a = own[0]
    b = own[((own - a) ** 2).sum(axis=1).argmax()]
    half = len(members) // 2
    for _ in range(6):
        order = np.argsort(((own - a) ** 2).sum(axis=1) - ((own - b) ** 2).sum(axis=1), kind="stable")
        a, b = own[order[:half]].mean(axis=0), own[order[half:]].mean(axis=0)
    return _halves(rows, members[order[:half]], depth - 1) + _halves(rows, members[order[half:]], depth - 1)


def balanced_centroids(rows: np.ndarray, wanted: int) -> np.ndarray:
    depth = max(0, math.ceil(math.log2(max(1, min(wanted, len(rows) // 4)))))
    centroids = np.array([rows[part].mean(axis=0) for part in _halves(rows, np.arange(len(rows)), depth)])
    for _ in range(4):
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids))
        for at in range(0, len(rows), 1_024):
            part = rows[at : at + 1_024]
            nearest = ((centroids**2).sum(axis=1) - 2 * part @ centroids.T).argmin(axis=1)
            np.add.at(sums, nearest, part)
            counts += np.bincount(nearest, minlength=len(centroids))
        filled = counts > 0
        centroids[filled] = sums[filled] / counts[filled, None]
    return centroids


def reach_of(far: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
    """Per row of distances to lists: within which the lists hold ``least`` vectors; infinite if all hold fewer."""
    some = min(NEAREST_LISTS, far.shape[1])
    near = np.argpartition(far, some - 1, axis=1)[:, :some]
    reach = _reach_among(far, near, sizes, least)
    short = np.flatnonzero(np.isinf(reach))
    if some < far.shape[1] and len(short):
        every = np.broadcast_to(np.arange(far.shape[1]), (len(short), far.shape[1]))
        reach[short] = _reach_among(far[short], every, sizes, least)
    return reach


def _reach_among(far: np.ndarray, lists: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
    own = np.take_along_axis(far, lists, axis=1)
    order = np.argsort(own, axis=1, kind="stable")
    own = np.take_along_axis(own, order, axis=1)
    enough = np.cumsum(sizes[np.take_along_axis(lists, order, axis=1)], axis=1) >= least
    return np.where(enough.any(axis=1), own[np.arange(len(own)), enough.argmax(axis=1)], np.inf)


class CentroidGraph:
    """Centroids, each linked to its nearest ones and a few others."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        n = len(centroids)
        degree = min(DEGREE, n - 1)
        near = np.zeros((n, degree), np.int64)
        for at in range(0, n, 1_024):
            part = centroids[at : at + 1_024]
            far = (centroids**2).sum(axis=1) - 2 * part @ centroids.T
            far[np.arange(len(part)), np.arange(at, at + len(part))] = np.inf
            near[at : at + len(part)] = np.argsort(far, axis=1, kind="stable")[:, :degree]
        # A ring and a stride keep the graph connected and short.
        ring = np.arange(n)
        self.links = np.concatenate(
            [near, ((ring + 1) % n)[:, None], ((ring + max(1, math.isqrt(n))) % n)[:, None]], axis=1
        )
        self.entries = np.unique(np.linspace(0, n - 1, min(n, ENTRIES)).astype(np.int64))

    def distances(
        self, rows: np.ndarray, ratio: float, sizes: np.ndarray | None = None, least: int = 0
    ) -> tuple[np.ndarray, np.ndarray]:
        """To each centroid that the search met, infinite elsewhere; and each row's reach.

        Without ``sizes`` the reach is the distance of the nearest centroid.
        """
        met = np.full((len(rows), len(self.centroids)), np.inf)
        who = np.repeat(np.arange(len(rows)), len(self.entries))
        where = np.tile(self.entries, len(rows))
        floor = LEAST_REACH * np.linalg.norm(rows, axis=1)
        done = np.zeros(met.shape, bool)
        while True:
            for at in range(0, len(who), PAIRS_AT_ONCE):
                a, b = who[at : at + PAIRS_AT_ONCE], where[at : at + PAIRS_AT_ONCE]
                met[a, b] = np.sqrt(((rows[a] - self.centroids[b]) ** 2).sum(axis=1))
            reach = met.min(axis=1) if sizes is None else np.maximum(reach_of(met, sizes, least), floor)
            open_who, open_where = np.nonzero((met <= ratio * reach[:, None]) & np.isfinite(met) & ~done)
            if not open_who.size:
                return met, reach
            done[open_who, open_where] = True
            fresh = np.zeros(met.shape, bool)
            fresh[np.repeat(open_who, self.links.shape[1]), self.links[open_where].ravel()] = True
            who, where = np.nonzero(fresh & np.isinf(met))

    def nearest(
        self, rows: np.ndarray, ratio: float, sizes: np.ndarray | None = None, least: int = 0
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each row the centroids within ``ratio`` of its reach, nearest first, and their distances."""
        for at in range(0, len(rows), ROWS_AT_ONCE):
            for met, reach in zip(*self.distances(rows[at : at + ROWS_AT_ONCE], ratio, sizes, least), strict=True):
                found = np.flatnonzero((met <= ratio * reach) & np.isfinite(met))
                found = found[np.argsort(met[found], kind="stable")]
                yield found, met[found]


def with_norm(rows: np.ndarray, norm: float) -> np.ndarray:
    """Rows with the coordinate that gives all of them the same norm."""
    extra = np.sqrt(np.maximum(0, norm**2 - (rows**2).sum(axis=1)))
    return np.concatenate([rows, extra[:, None]], axis=1)


class Index:
    """The graph, the largest norm, and how many vectors have each centroid as nearest."""

    def __init__(self, graph: CentroidGraph, norm: float, sizes: np.ndarray | None = None, boundary: float = 1.0):
        self.graph, self.norm, self.sizes, self.boundary = graph, norm, sizes, boundary

    def stored(self, rows: np.ndarray) -> np.ndarray:
        return with_norm(rows, self.norm)

    def asked(self, rows: np.ndarray) -> np.ndarray:
        scaled = rows * (self.norm / np.linalg.norm(rows, axis=1))[:, None]
        return np.concatenate([scaled, np.zeros((len(rows), 1))], axis=1)

    def lists_of(self, rows: np.ndarray) -> Iterator[list[int]]:
        """The lists that hold each vector, nearest centroid first."""
        for found, _ in self.graph.nearest(self.stored(rows), self.boundary):
            yield found[:LISTS_A_VECTOR].tolist()

    def measure_boundary(self, rows: np.ndarray) -> None:
        """Set the boundary so that ``REPLICATED`` of the rows have a second list."""
        stored, centroids = self.stored(rows[:BOUNDARY_ROWS]), self.graph.centroids
        if len(centroids) < 2 or not len(stored):
            return
        ratios = []
        for at in range(0, len(stored), 256):
            part = stored[at : at + 256]
            squares = (part**2).sum(axis=1)[:, None] + (centroids**2).sum(axis=1) - 2 * part @ centroids.T
            two = np.sqrt(np.maximum(0, np.partition(squares, 1, axis=1)[:, :2]))
            ratios.append(two[:, 1] / np.maximum(two[:, 0], 1e-300))
        self.boundary = float(np.clip(np.quantile(np.concatenate(ratios), REPLICATED), 1.0, RATIO))

    def lists_for(self, rows: np.ndarray, ratio: float, least: int) -> Iterator[np.ndarray]:
        """The lists to read for each query; together they hold ``least`` vectors if there are so many."""
        asked = self.asked(rows)
        for i, (found, _) in enumerate(self.graph.nearest(asked, ratio, self.sizes, least)):
            if self.sizes[found].sum() < least:
                far = ((self.graph.centroids - asked[i]) ** 2).sum(axis=1)
                order = np.argsort(far, kind="stable")
                enough = int(np.searchsorted(np.cumsum(self.sizes[order]), least)) + 1
                found = np.union1d(found, order[:enough])
            yield found

    def enough(
        self, rows: np.ndarray, near: list[tuple[np.ndarray, np.ndarray]], ratio: float, least: int, recall: float
    ) -> float:
        """The smallest ratio from ``ratio`` on whose lists hold ``recall`` of each row's answers.

        ``near`` has per row the different vectors of its answers and how many answers each is.
        """
        weights = np.concatenate([counts for _, counts in near]) if near else np.zeros(0)
        total = weights.sum()
        if not total:
            return ratio
        holding = [[set(lists) for lists in self.lists_of(some)] if len(some) else [] for some, _ in near]
        # By exact distances first: how far the nearest list that holds a vector is, beside the reach.
        needed = []
        for row, vectors in zip(self.asked(rows), holding, strict=True):
            far = np.sqrt(((self.graph.centroids - row) ** 2).sum(axis=1))
            reach = max(float(reach_of(far[None], self.sizes, least)[0]), LEAST_REACH * self.norm)
            needed += [far[list(lists)].min() / reach for lists in vectors]
        order = np.argsort(needed, kind="stable")
        held = np.cumsum(weights[order])
        last = order[min(len(order) - 1, int(np.searchsorted(held, recall * total)))]
        ratio = max(ratio, float(needed[last]))
        # Then by the search itself, which may not meet every list within the ratio.
        while True:
            opened = [set(found.tolist()) for found in self.lists_for(rows, ratio, least)]
            found = [bool(own & lists) for own, vectors in zip(opened, holding, strict=True) for lists in vectors]
            if weights[found].sum() >= recall * total or all(len(own) == len(self.graph.centroids) for own in opened):
                return ratio
            ratio *= 1.02


# Operators ------------------------------------------------------------------


def _usable(vector: Column) -> Column:
    """No null, no null or non-finite component, not zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(vectors: DataFrame, k: int = K) -> DataFrame:
    """``least``, ``ids`` (its k + 1 smallest), ``vector``: one row per different usable vector, stored.

    Vectors of another length than the commonest (the shorter of two) take no part.
    """
    usable = vectors.select(
        F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").cast("array<double>").alias("vector")
    ).filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    # -0.0 and 0.0 are one number.
    usable = usable.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    lengths = usable.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), "length").first()
    length = common["length"] if common else 0
    # Ranks up to a limit are cut off before the shuffle, so a common vector is k + 1 rows a task.
    place = Window.partitionBy("vector").orderBy("id")
    smallest = (
        usable.filter(F.size("vector") == length)
        .groupBy("vector", "id")
        .agg(F.lit(1).alias("one"))
        .withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= k + 1)
    )
    return settle(
        smallest.groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.col("ids")[0].alias("least"), "ids", "vector"),
        "vectors",
    )


def _matrix(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _postings(index: Index):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = list(index.lists_of(_matrix(batch.column(1))))
                rows = np.repeat(np.arange(len(lists)), [len(some) for some in lists])
                first = np.concatenate([np.arange(len(some)) == 0 for some in lists])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(lists).astype(np.int32)),
                        pa.array(first),
                        batch.column(0).take(pa.array(rows)),
                        batch.column(1).take(pa.array(rows)),
                    ],
                    names=["list", "first", "least", "vector"],
                )

    return run


def _routes(index: Index, groups: int, ratio: float, least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, group, lists = [], [], []
            if batch.num_rows:
                for i, found in enumerate(index.lists_for(_matrix(batch.column(1)), ratio, least)):
                    for number in np.unique(found % groups):
                        rows.append(i)
                        group.append(int(number))
                        lists.append(found[found % groups == number].tolist())
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group, pa.int32()),
                    pa.array(lists, pa.list_(pa.int32())),
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                ],
                names=["group", "lists", "query", "vector"],
            )

    return run


def _first(row: np.ndarray, ids: np.ndarray, scores: np.ndarray, count: int) -> np.ndarray:
    """Places of each row's first ``count`` by falling score and ascending id."""
    order = np.lexsort((ids, -scores, row))
    starts = np.searchsorted(row[order], row[order])
    return order[np.arange(len(order)) - starts < count]


def _leading(
    near: np.ndarray, wanted: np.ndarray, stored: np.ndarray, ids: np.ndarray, count: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and scores of each row's first ``count`` finite entries, equal scores by ascending id.

    ``near`` holds the products by matrix multiplication, whose last digits depend
    on the order of the sums; whatever may be equal to the last wanted one is
    scored again, row by row.
    """
    some = min(near.shape[1], count)
    last = -np.partition(-near, some - 1, axis=1)[:, some - 1]
    largest = np.sqrt((stored**2).sum(axis=1).max(initial=0) * (wanted**2).sum(axis=1))
    row, column = np.nonzero((near >= (last - 1e-13 * stored.shape[1] * largest)[:, None]) & np.isfinite(near))
    scores = np.empty(len(row))
    for at in range(0, len(row), PAIRS_AT_ONCE):
        a, b = row[at : at + PAIRS_AT_ONCE], column[at : at + PAIRS_AT_ONCE]
        scores[at : at + PAIRS_AT_ONCE] = (wanted[a] * stored[b]).sum(axis=1)
    kept = _first(row, ids[column], scores, count)
    return row[kept], column[kept], scores[kept]


def _best(k: int):
    names = ["query", "least", "score"]

    def run(asked: pa.Table, posted: pa.Table) -> pa.Table:
        queries, least, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if asked.num_rows and posted.num_rows:
            wanted = _matrix(asked["vector"])
            lists, place = np.unique(posted["list"].to_numpy(), return_inverse=True)
            # Postings of one vector are one candidate, which any of its lists opens.
            ids, first, copy = np.unique(posted["least"].to_numpy(), return_index=True, return_inverse=True)
            stored = _matrix(posted["vector"])[first]
            order = np.argsort(copy, kind="stable")
            place, starts = place[order], np.searchsorted(copy[order], np.arange(len(ids)))
            who, chosen = asked["query"].to_numpy(), asked["lists"].to_pylist()
            for at in range(0, len(who), 256):
                part = wanted[at : at + 256]
                open_lists = np.array([np.isin(lists, some) for some in chosen[at : at + 256]])
                reached = np.logical_or.reduceat(open_lists[:, place], starts, axis=1)
                near = np.where(reached, part @ stored.T, -np.inf)
                # A few more than needed; any k + 1 would do.
                row, column, score = _leading(near, part, stored, ids, k + 9)
                queries.append(who[at + row])
                least.append(ids[column])
                scores.append(score)
        arrays = [pa.array(np.concatenate(x)) for x in (queries, least, scores)]
        return pa.table(dict(zip(names, arrays, strict=True)))

    return run


def _true_answers(distinct: DataFrame, sample: pa.Table, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each sampled query row the different vectors of its answer, and how many of the k answers each is.

    By brute force over all rows of ``distinct``; the k + 1 first of these hold every answer.
    """
    wanted = _matrix(sample["vector"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The best of a task so far: k + 1 for each sampled row.
        rows, least, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP_VECTORS):
                part = batch.slice(at, GROUP_VECTORS)
                own, stored = part.column(0).to_numpy(zero_copy_only=False), _matrix(part.column(1))
                row, column, score = _leading(wanted @ stored.T, wanted, stored, own, k + 1)
                rows, scores = np.concatenate([rows, row]), np.concatenate([scores, score])
                least = np.concatenate([least, own[column]])
                kept = _first(rows, least, scores, k + 1)
                rows, least, scores = rows[kept], least[kept], scores[kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.astype(np.int32)), pa.array(least), pa.array(scores)], names=["row", "least", "score"]
        )

    place = Window.partitionBy("row").orderBy(F.desc("score"), "least")
    found = (
        distinct.select("least", "vector")
        .mapInArrow(run, "row int, least bigint, score double")
        .withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= k + 1)
        .join(distinct, "least")
        .select("row", "score", "ids", "vector")
        .toArrow()
    )
    rows, scores = found["row"].to_numpy(), found["score"].to_numpy()
    ids = found["ids"].to_pylist()
    stored = _matrix(found["vector"]) if len(rows) else np.zeros((0, wanted.shape[1]))
    answers = []
    for row, query in enumerate(sample["query_id"].to_pylist()):
        own = np.flatnonzero(rows == row)
        hits = sorted((-scores[i], number, i) for i in own.tolist() for number in ids[i] if number != query)[:k]
        different, counts = np.unique(np.array([i for _, _, i in hits], np.int64), return_counts=True)
        answers.append((stored[different], counts))
    return answers


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    k: int = K,
    ratio: float = RATIO,
    seed_rows: int = FIT_VECTORS,
    recall: float = RECALL,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found to each row that ``queries`` selects.

    ``vectors`` has ``vec_id`` and ``embedding``. Nearness is the inner product
    in double precision; ties go to the smaller vec_id; a query's own id is no
    candidate, equal vectors of other ids are. Null ids and unusable vectors
    (``distinct_vectors``) take no part; repeated rows count once. With k or
    fewer candidates all are returned; extra columns are ignored; an empty
    table gives an empty result. The index is fitted on ``seed_rows`` vectors, or
    ``FIT_VECTORS_A_LIST`` a list if that is more, chosen by hash, and holds every
    vector. ``ratio`` is the least one; it is raised until ``SAMPLE_QUERIES``
    query rows, chosen by hash, find ``recall`` of their true answers. Runs jobs.
    """
    spark = vectors.sparkSession
    distinct = distinct_vectors(vectors, k)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    n, most = distinct.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")

    wanted = min(MOST_CENTROIDS, math.ceil(n / LIST_VECTORS))
    rows = max(seed_rows, FIT_VECTORS_A_LIST * wanted)
    sample = _matrix(
        distinct.select(F.xxhash64("vector").alias("h"), "vector").orderBy("h").limit(rows).toArrow()["vector"]
    )
    index = Index(CentroidGraph(balanced_centroids(with_norm(sample, most), wanted)), most)
    index.measure_boundary(sample)
    lists = len(index.graph.centroids)
    postings = settle(
        distinct.select("least", "vector").mapInArrow(
            _postings(index), "list int, first boolean, least bigint, vector array<double>"
        ),
        "postings",
    )
    # One short row per list: at most MOST_CENTROIDS.
    index.sizes = np.zeros(lists, np.int64)
    total = 0
    for row in postings.groupBy("list").agg(F.count_if("first").alias("n"), F.count(F.lit(1)).alias("all")).collect():
        index.sizes[row["list"]] = row["n"]
        total += row["all"]
    groups = max(1, min(lists, math.ceil(total / GROUP_VECTORS)))

    asked_ids = settle(_classes_of(vectors.filter(queries), distinct), "queries")
    asked = distinct.join(asked_ids.select("least").distinct(), "least", "left_semi").select("least", "vector")
    # By another hash than the fit's, so that these queries are no more likely to be fitted on.
    order = F.xxhash64(F.lit("calibration"), "query_id")
    tried = asked_ids.orderBy(order, "query_id", "least").limit(SAMPLE_QUERIES)
    tried = tried.join(distinct.select("least", "vector"), "least").select("query_id", "vector").toArrow()
    if tried.num_rows:
        near = _true_answers(distinct, tried, k)
        ratio = index.enough(_matrix(tried["vector"]), near, ratio, k + 1, recall)
    routes = settle(
        asked.mapInArrow(
            _routes(index, groups, ratio, k + 1),
            "group int, lists array<int>, query bigint, vector array<double>",
        ),
        "routes",
    )
    group = F.col("list") % groups
    salts = postings.groupBy(group.alias("group")).agg(F.ceil(F.count(F.lit(1)) / GROUP_VECTORS).cast("int").alias("salts"))
    blocks = routes.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / GROUP_QUERIES).cast("int").alias("blocks"))
    shape = settle(salts.join(blocks, "group"), "groups")
    left = routes.join(shape, "group").select(
        "group",
        F.explode(F.sequence(F.lit(1), F.col("salts"))).alias("salt"),
        (F.pmod(F.xxhash64("query"), F.col("blocks")) + 1).cast("int").alias("block"),
        "query",
        "lists",
        "vector",
    )
    right = postings.withColumn("group", group).join(shape, "group").select(
        "group",
        (F.pmod(F.xxhash64("least"), F.col("salts")) + 1).cast("int").alias("salt"),
        F.explode(F.sequence(F.lit(1), F.col("blocks"))).alias("block"),
        "list",
        "least",
        "vector",
    )
    keys = ["group", "salt", "block"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(_best(k), "query bigint, least bigint, score double")
        .distinct()
    )
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "least")
    best = found.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= k + 1)
    hits = F.struct((-F.col("score")).alias("far"), F.col("vec_id"))
    answers = (
        best.select("query", "least", "score")
        .join(distinct.select("least", F.explode("ids").alias("vec_id")), "least")
        .groupBy("query")
        .agg(F.slice(F.sort_array(F.collect_list(hits)), 1, k + 1).alias("hits"))
    )
    others = F.slice(F.filter("hits", lambda hit: hit["vec_id"] != F.col("query_id")), 1, k)
    return (
        asked_ids.join(answers, F.col("least") == F.col("query"))
        .select("query_id", F.posexplode(others).alias("at", "hit"))
        .select(
            "query_id",
            (F.col("at") + 1).cast("int").alias("rank"),
            F.col("hit.vec_id").alias("vec_id"),
            (-F.col("hit.far")).alias("score"),
        )
    )


def _classes_of(rows: DataFrame, distinct: DataFrame) -> DataFrame:
    """``query_id`` and ``least``, the row of the index that holds its vector."""
    named = rows.select(
        F.col("vec_id").cast("bigint").alias("query_id"),
        F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vector"),
    ).filter(F.col("query_id").isNotNull())
    return named.join(distinct.select("least", "vector"), "vector").select("query_id", "least").distinct()
