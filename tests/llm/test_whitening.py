"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from forgemeter.llm import whitening
from forgemeter.llm.shipping import ship_package
from forgemeter.session import settle

SF = "/root/testdata/sf0.001"
VECTOR = "vec_id bigint, embedding array<float>, label int"
CLASH = VECTOR + ", x string, component string, rows string, at string, n string, deviation string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def table(spark, vectors, schema=VECTOR):
    width = len(schema.split(", "))
    rows = [(i, v) + (None,) * (width - 2) for i, v in vectors]
    return spark.createDataFrame(rows, schema)


def direct(vectors, wanted=4):
    """(component, n, deviation, |whitened|, explained) per vector, from the whole matrix at once."""
    x = np.array([np.floor(256 * np.array(v, np.float32).astype(np.float64)) for v in vectors]).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    variances, vectors = np.linalg.eigh(centred.T @ centred / n)
    variances, vectors = variances[::-1], vectors[:, ::-1]
    k = min(wanted, int((variances > 1e-12 * variances.sum()).sum()))
    z = np.abs((x - sums / n) @ vectors[:, :k]) / np.sqrt(variances[:k])
    deviations = ((n * x - sums) ** 2).sum(axis=1)
    return n, deviations, z, variances[:k] / variances.sum()


def check(spark, vectors, wanted=4):
    out = whitening.whiten(table(spark, list(enumerate(vectors))), wanted).collect()
    n, deviations, z, explained = direct(vectors, wanted)
    assert len(out) == len(vectors) * z.shape[1]
    for row in out:
        assert (row.n, row.deviation) == (n, deviations[row.vec_id])
        assert abs(abs(row.whitened) - z[row.vec_id, row.component - 1]) < 1e-8
        assert abs(row.explained - explained[row.component - 1]) < 1e-10
        assert row.identity_error < 1e-9
    return out


def test_whitening_equals_the_eigenvectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(spark, [row.embedding for row in rows])


def test_repeated_rows_count_once_and_low_rank_ends_early(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 7)).tolist()
    check(spark, base + base[:1] * 60 + base)
    # Three directions of variance among nine dimensions, on whole numbers.
    low = (rng.integers(-3, 4, (50, 3)) @ rng.integers(-2, 3, (3, 9))).astype(float).tolist()
    out = check(spark, low)
    assert {row.component for row in out} == {1, 2, 3}


def test_equal_variances_are_all_found(spark):
    # A cross: each axis has the same variance, so a single Krylov space sees one direction only.
    axes = [[s * (i == j) for j in range(6)] for i in range(6) for s in (1.0, -1.0)]
    out = whitening.whiten(table(spark, list(enumerate(axes)))).collect()
    assert {row.component for row in out} == {1, 2, 3, 4}
    assert all(abs(row.explained - 1 / 6) < 1e-12 and row.identity_error < 1e-10 for row in out)


def test_rows_without_a_usable_vector_take_no_part(spark):
    good = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [-0.25, 0.0]), (3, [0.0, -0.0])]
    bad = [(4, None), (5, []), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 0.0])]
    plain = whitening.whiten(table(spark, good + bad)).collect()
    clashing = whitening.whiten(table(spark, good + bad, CLASH)).collect()
    assert sorted(map(repr, plain)) == sorted(map(repr, clashing))
    assert [row.vec_id for row in plain].count(1) == 4 and [row.vec_id for row in plain].count(None) == 2
    assert {row.vec_id for row in plain} == {1, None, 3} and {row.n for row in plain} == {3}
    for nothing in ([], bad, [(1, [0.5, 1.0])] * 3):
        assert whitening.whiten(table(spark, nothing)).collect() == []
    with pytest.raises(Exception, match="differ in length"):
        whitening.whiten(table(spark, [(1, [1.0]), (2, [1.0, 2.0])])).collect()


def test_exact_sums_beyond_a_long():
    big = np.array([[2**61, -5], [2**61, 2**61], [2**61, 7], [2**61, 1], [2**61, 0]])
    assert whitening.column_sums(big) == [5 * 2**61, 2**61 + 3]
    offsets = whitening.exact_offsets(big, 5, whitening.column_sums(big))
    assert offsets[0].tolist() == [0, -25 - 2**61 - 3]
    assert whitening.squared_lengths(offsets)[0] == (2**61 + 28) ** 2


def test_shuffle_partitions_cost_no_step_tasks(spark):
    rng = np.random.default_rng(7)
    rows = table(spark, list(enumerate(rng.standard_normal((400, 6)).tolist())))
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    context = spark.sparkContext
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        blocks = settle(whitening.fit_blocks(rows), "blocks")
        centre = whitening.centre_of(blocks)
        context.setJobGroup("whitening-steps", "")
        found = whitening.principal_components(blocks, centre)
        stages = context.statusTracker()
        jobs = [stages.getJobInfo(job) for job in stages.getJobIdsForGroup("whitening-steps")]
        tasks = sum(stages.getStageInfo(stage).numTasks for job in jobs for stage in job.stageIds)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for key, value in before.items():
            spark.conf.set(key, value)
    # A pass for the trace and one a step, each with at most a task a core and one that adds up.
    assert blocks.agg({"rows": "sum"}).first()[0] == 400 and blocks.count() <= 20
    assert tasks <= 20 * (found.steps + 1)
