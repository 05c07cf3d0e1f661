"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

A vector's entries become whole numbers x = floor(256 * c); the components are
those of the distinct x-vectors, the *fit list*, of which no task or driver
holds more than a block. Sums, counts and deviations are exact whole numbers.

Bidiagonalisation. With Y the fit list centred on its mean, the steps alternate
u = Yv and w = Yᵀu. Each step is one Spark job over the stored blocks of Y. A
left vector u has an entry per row, so it is not kept but for the vector p with
u = Yp (``left``): a task makes its rows' entries of all earlier u from it, takes the
inner products that full reorthogonalisation needs, and returns sums of a few
numbers per dimension. The right vectors are short and reorthogonalised on the
driver, twice. The singular values of the small bidiagonal matrix over sqrt(n)
are the deviations, its right vectors give the components.

Steps go on until the wanted components have converged and what variance is not
yet spanned (trace minus that of the bidiagonal matrix) is below the least of
them, so that no direction, a repeated eigenvalue's second one say, can be
missed. That takes as many steps as dimensions at most. Where a step finds
nothing new a fresh direction goes on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemeter.session import settle

COMPONENTS = 4
SCALE = 256.0
ROWS_A_BLOCK = 4_096
CONVERGED = 1e-13
# Variance below this share of the trace is rounding, not variance.
NOTHING = 1e-12
MOST_LONG = 2**63 - 1

ROW_COLUMNS = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is neither null nor empty and holds no null or non-finite entry."""
    entry = F.col(column)
    finite = F.forall(
        entry,
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))),
    )
    return vectors.filter(entry.isNotNull() & (F.size(entry) > 0) & F.coalesce(finite, F.lit(False)))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows; all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if not len(column):
        return flat.reshape(0, 0)
    if len(flat) % len(column) or len(set(np.diff(column.offsets.to_numpy()).tolist())) != 1:
        raise ValueError("the vectors differ in length")
    return flat.reshape(len(column), -1)


def whole_numbers(entries: np.ndarray) -> np.ndarray:
    scaled = np.floor(SCALE * entries.astype(np.float64))
    if scaled.size and np.abs(scaled).max() >= 2.0**62:
        raise ValueError("an entry times 256 does not fit a long")
    return scaled.astype(np.int64)


# Exact sums -----------------------------------------------------------------


def column_sums(x: np.ndarray) -> list[int]:
    """Per column, exact whatever the size: the halves of the numbers are summed apart."""
    low, high = x & 0xFFFFFFFF, x >> 32
    return [(int(h) << 32) + int(l) for h, l in zip(high.sum(axis=0), low.sum(axis=0), strict=True)]


def squared_lengths(offsets: np.ndarray) -> list[int]:
    """Sum of squares of each row of whole numbers, exact."""
    rough = (offsets.astype(np.float64) ** 2).sum(axis=1)
    if not len(rough) or rough.max() < 2.0**62:
        return (offsets * offsets).sum(axis=1).tolist()
    return [sum(v * v for v in row) for row in offsets.tolist()]


def exact_offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S as longs, as Python integers where a long is too short."""
    largest = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    if largest <= MOST_LONG:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


@dataclass(frozen=True)
class Centre:
    """Number of vectors in the fit list and their exact sums."""

    n: int
    sums: tuple[int, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return exact_offsets(x, self.n, list(self.sums)).astype(np.float64) / self.n


def _batch_of(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(types)]
    return pa.RecordBatch.from_arrays(columns, names=names)


# The fit list ---------------------------------------------------------------


def _as_whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = whole_numbers(_matrix(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in x], pa.binary())], names=["x"])


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Many vectors a row: later passes read them without taking rows apart."""
    held: list[bytes] = []

    def flush() -> pa.RecordBatch:
        x = _numbers(b"".join(held), len(held))
        sums = [str(s) for s in column_sums(x)]
        types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary()]
        return _batch_of([(len(held), x.shape[1], sums, x.tobytes())], ["rows", "width", "sums", "x"], types)

    for batch in batches:
        for value in batch.column(0).to_pylist():
            held.append(value)
            if len(held) == ROWS_A_BLOCK:
                yield flush()
                held = []
    if held:
        yield flush()


def _numbers(data: bytes, rows: int) -> np.ndarray:
    if len(data) % (8 * rows):
        raise ValueError("the vectors differ in length")
    return np.frombuffer(data, np.int64).reshape(rows, -1)


def fit_blocks(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """The distinct x-vectors of usable rows in blocks (rows, width, sums, x). Writes the vectors.

    Copies of a vector collapse before the shuffle, so a vector that fills a
    third of the table is one row a task there. The written vectors are read by
    their bytes, so there are as many blocks as these need, not as many as the
    shuffle has partitions.
    """
    distinct = settle(rows.select(column).mapInArrow(_as_whole, "x binary").distinct(), "fit-list")
    return distinct.mapInArrow(_blocks, "rows bigint, width bigint, sums array<string>, x binary")


def centre_of(blocks: DataFrame) -> Centre:
    per_dimension = (
        blocks.select("rows", F.posexplode("sums").alias("at", "part"))
        .groupBy("at")
        .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("rows").alias("n"))
        .orderBy("at")
        .collect()
    )
    if len({row["n"] for row in per_dimension}) > 1:
        raise ValueError("the vectors differ in length")
    return Centre(per_dimension[0]["n"] if per_dimension else 0, tuple(int(row["total"]) for row in per_dimension))


# One pass -------------------------------------------------------------------


def _summed(blocks: DataFrame, centre: Centre, measure) -> np.ndarray:
    """``measure`` of each block's centred rows, a short array, added up over all blocks.

    Only its entries leave a task, and they are added in a shuffle, so the
    driver gets as many numbers as ``measure`` has, however many tasks there are.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for rows, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = measure(centre.centred(_numbers(data, rows)))
                total = own if total is None else total + own
        if total is not None:
            at = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([at, pa.array(total)], names=["at", "value"])

    # A few numbers a task: one task adds them up, where a grouping's tasks would cost more than the pass.
    parts = blocks.select("rows", "x").mapInArrow(run, "at int, value double").repartition(1)
    found = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()
    return np.array([row["value"] for row in sorted(found, key=lambda row: row["at"])])


def _step(direction: np.ndarray, left: np.ndarray):
    """Of u = Y direction: its squared length, its products with the earlier left vectors, and Yᵀu."""

    def measure(rows: np.ndarray) -> np.ndarray:
        u = rows @ direction
        return np.concatenate([[u @ u], (rows @ left).T @ u, rows.T @ u])

    return measure


# Bidiagonalisation ----------------------------------------------------------


@dataclass(frozen=True)
class Components:
    """Unit vectors as rows by falling variance, their variances, and the trace."""

    vectors: np.ndarray
    variances: np.ndarray
    trace: float
    steps: int


def _fresh(rng: np.random.Generator, right: np.ndarray) -> np.ndarray:
    direction = rng.standard_normal(len(right))
    for _ in range(3):
        direction -= right @ (right.T @ direction)
        direction /= np.linalg.norm(direction)
    return direction


def principal_components(blocks: DataFrame, centre: Centre, wanted: int = COMPONENTS, seed: int = 0) -> Components:
    """The ``wanted`` leading components of the fit list; fewer if it has fewer with any variance. Runs jobs.

    The sign of a component makes its largest entry positive.
    """
    width = len(centre.sums)
    energy = float(_summed(blocks, centre, lambda rows: np.array([(rows * rows).sum()]))[0]) if width else 0.0
    none = Components(np.zeros((0, width)), np.zeros(0), energy / max(centre.n, 1), 0)
    if energy == 0:
        return none
    rng = np.random.default_rng(seed)
    right = np.zeros((width, 0))  # v, one a column
    left = np.zeros((width, 0))  # p with u = Yp
    images = np.zeros((width, 0))  # Yᵀu
    alphas: list[float] = []
    betas: list[float] = []  # betas[i] stands right of alphas[i]
    v, beta = _fresh(rng, right), 0.0
    floor = CONVERGED * np.sqrt(energy)
    while True:
        right = np.column_stack([right, v])
        p = v - beta * left[:, -1] if beta else v
        found = _summed(blocks, centre, _step(p, left))
        overlap, image = found[1 : 1 + left.shape[1]], found[1 + left.shape[1] :]
        p, image = p - left @ overlap, image - images @ overlap
        alpha = float(np.sqrt(max(0.0, found[0] - overlap @ overlap)))
        if alpha > floor:
            p, image = p / alpha, image / alpha
            w = image - alpha * v
        else:
            # The direction holds no variance beyond that of earlier ones.
            alpha, p, image, w = 0.0, np.zeros(width), np.zeros(width), np.zeros(width)
        left, images = np.column_stack([left, p]), np.column_stack([images, image])
        alphas.append(alpha)
        for _ in range(2):
            w = w - right @ (right.T @ w)
        beta = float(np.linalg.norm(w))
        if beta <= floor:
            beta = 0.0
        small = np.diag(alphas) + np.diag(betas, 1)
        rotation, sigmas, turned = np.linalg.svd(small)
        unspanned = max(0.0, energy - float((small**2).sum()) - beta**2)
        leading = sigmas[:wanted]
        residuals = beta * np.abs(rotation[-1, : len(leading)])
        least = leading[-1] ** 2 if len(leading) == wanted else 0.0
        whole = bool((residuals <= CONVERGED * sigmas[0]).all()) and unspanned + beta**2 <= max(
            0.5 * least, NOTHING * energy
        )
        if whole or len(alphas) == width:
            break
        v = w / beta if beta else _fresh(rng, right)
        betas.append(beta)
    leading = leading[leading**2 > NOTHING * energy]
    vectors = (right @ turned[: len(leading)].T).T
    vectors *= np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])[:, None]
    return Components(vectors, leading**2 / centre.n, energy / centre.n, len(alphas))


# Whitening ------------------------------------------------------------------


def _whitener(found: Components) -> np.ndarray:
    return (found.vectors / np.sqrt(found.variances)[:, None]).T


def identity_error(blocks: DataFrame, centre: Centre, found: Components) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity. Runs two jobs."""
    across = _whitener(found)
    k = across.shape[1]
    mean = _summed(blocks, centre, lambda rows: (rows @ across).sum(axis=0)) / centre.n

    def products(rows: np.ndarray) -> np.ndarray:
        z = rows @ across - mean
        return (z.T @ z).ravel()

    covariance = _summed(blocks, centre, products).reshape(k, k) / centre.n
    return float(np.abs(covariance - np.eye(k)).max())


def _rows_out(centre: Centre, found: Components, error: float):
    across = _whitener(found)
    k = across.shape[1]
    explained = found.variances / found.trace

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            offsets = exact_offsets(whole_numbers(_matrix(batch.column(1))), centre.n, list(centre.sums))
            lengths = [v if v <= MOST_LONG else None for v in squared_lengths(offsets)]
            z = (offsets.astype(np.float64) / centre.n) @ across
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, centre.n, np.int64)),
                    pa.array(lengths, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(z.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=[part.split()[0] for part in ROW_COLUMNS.split(", ")],
            )

    return run


def whiten(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error per usable row and component. Runs jobs.

    Rows whose vector is null, empty or holds a null or non-finite entry take no
    part. Repeated rows and rows without a vec_id are returned each; equal
    vectors count once in the fit. Components without variance are left out, so
    a table with fewer than two different vectors, like an empty one, gives no
    row. ``deviation`` is null where it does not fit a long. Vectors of unequal
    length are an error. Extra columns are ignored.
    """
    spark = vectors.sparkSession
    rows = usable(vectors).select("vec_id", "embedding")
    blocks = settle(fit_blocks(rows), "fit-blocks")
    centre = centre_of(blocks)
    found = principal_components(blocks, centre, wanted)
    if not len(found.variances):
        return spark.createDataFrame([], ROW_COLUMNS)
    return rows.mapInArrow(_rows_out(centre, found, identity_error(blocks, centre, found)), ROW_COLUMNS)
