"""The projection forest against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.llm import vector_dups


def groups(dims=32, seed=1):
    """Single vectors, small groups of near copies, a group with a third of all rows, a chain."""
    draw = np.random.default_rng(seed)
    rows = [draw.standard_normal(dims) for _ in range(400)]
    for size, noise in [(2, 0.1), (3, 0.2), (5, 0.15)] * 12:
        base = draw.standard_normal(dims)
        base /= np.linalg.norm(base)
        rows += [base + noise * draw.standard_normal(dims) / math.sqrt(dims) for _ in range(size)]
    base = draw.standard_normal(dims)
    base /= np.linalg.norm(base)
    rows += [base + 0.08 * draw.standard_normal(dims) / math.sqrt(dims) for _ in range(250)]
    rows += [base + 0.3 * draw.standard_normal(dims) / math.sqrt(dims) for _ in range(20)]
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(rows)]


def brute(rows):
    usable = [
        (i, np.array(v)) if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) else None for i, v in rows
    ]
    n = len(rows)
    links = [set() for _ in range(n)]
    by_length = {}
    for at, found in enumerate(usable):
        if found:
            by_length.setdefault(len(found[1]), []).append(at)
    for members in by_length.values():
        x = np.array([usable[at][1] for at in members])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(x @ x.T >= 0.95), strict=True):
            if a != b:
                links[members[a]].add(members[b])
    component = list(range(n))
    for start in range(n):
        stack = [start]
        while stack:
            at = stack.pop()
            for other in links[at]:
                if component[other] > component[start]:
                    component[other] = component[start]
                    stack.append(other)
    least = {}
    for at, c in enumerate(component):
        if rows[at][0] is not None:
            least[c] = min(least.get(c, rows[at][0]), rows[at][0])
    return [(rows[at][0], len(links[at]), least.get(component[at]), rows[at][0] in (None, least.get(component[at]))) for at in range(n)]


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    clashing = {name: F.lit(7) for name in ("node", "cap", "vector", "n", "first", "length", "component", "a", "b", "tree", "leaf")}
    return sorted((tuple(row) for row in vector_dups.near_vectors(df.withColumns(clashing), **options).collect()), key=str)


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"leaf": 16, "depth": 3, "oversize": 60, "sample": 200, "block": 32},  # several rounds, blocks
        {"block": 64, "leaf": 10_000},  # one leaf, all in blocks of caps and of the rest
    ],
)
def test_links_of_all_pairs_are_found(spark, options):
    rows = groups()
    got, want = run(spark, rows, **options), sorted(brute(rows), key=str)
    linked = sum(n for _, n, _, _ in want)
    assert linked > 30_000
    by_id = {row[0]: row[1] for row in got}
    assert all(by_id[i] <= n for i, n, _, _ in want)  # none below the threshold
    # 0.9 is promised; the deep trees of leaves of 16 lose a few pairs near the threshold
    assert sum(row[1] for row in got) >= 0.99 * linked
    if not options:
        assert [row[2:] for row in got] == [row[2:] for row in want]


def test_awkward_vectors(spark):
    one = [1.0, 2.0, 2.0]
    rows = [
        (5, one), (3, one), (9, [2.0, 4.0, 4.0]), (9, [-1.0, 0.0, 0.0]), (11, [1e300, 2e300, 2e300]), (12, [1e-300, 2e-300, 2e-300]),
        (20, [0.0, 0.0, 0.0]), (21, None), (22, []), (23, [1.0, None, 2.0]), (24, [math.nan, 1.0, 1.0]), (25, [math.inf, 1.0, 1.0]),
        (None, one), (30, [1.0, 2.0]), (31, [1.0, 2.0]), (40, [-0.0, 1.0, 0.0]), (41, [0.0, 1.0, 0.0]),
    ]
    got = run(spark, rows)
    want = [
        (5, 4, 3, False), (3, 4, 3, True), (9, 4, 3, False), (9, 0, 9, True), (11, 4, 3, False), (12, 4, 3, False),
        (20, 0, 20, True), (21, 0, 21, True), (22, 0, 22, True), (23, 0, 23, True), (24, 0, 24, True), (25, 0, 25, True),
        (None, 0, None, True), (30, 1, 30, True), (31, 1, 30, False), (40, 1, 40, True), (41, 1, 40, False),
    ]
    assert got == sorted(want, key=str)
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert vector_dups.near_vectors(empty).count() == 0


def test_caps_hold_only_linked_vectors():
    rows = np.array([v for _, v in groups()])
    x = vector_dups.normalized(rows)
    centres = vector_dups.caps(x, 0.95)
    assert len(centres)
    for centre in centres:
        inside = x[x @ centre >= vector_dups.cap_cosine(0.95)]
        assert (inside @ inside.T >= 0.95).all()


def test_most_copies_are_not_listed_as_pairs(spark):
    """The links inside a cap are counted, not emitted."""
    draw = np.random.default_rng(2)
    base = draw.standard_normal(16)
    base /= np.linalg.norm(base)
    rows = [(i, [float(x) for x in base + 0.02 * draw.standard_normal(16)]) for i in range(300)]
    from adlake.llm.common import Staging

    df = spark.createDataFrame(rows, "node long, v array<double>")
    packed = df.select("node", "v").mapInArrow(vector_dups._packed, "vec_id long, length int, vector binary").withColumnRenamed("vec_id", "node")
    sizes = {"leaf": 64, "oversize": 8192, "depth": 4, "sample": 1024, "block": 128}
    staging = Staging(spark, "test")
    pairs, capped = vector_dups._links(staging.keep(packed), staging, 16, 0.95, 2, 0.1, sizes)
    assert capped.where("cap >= 0").count() == 300 and pairs.count() == 0
    assert {row[1] for row in run(spark, rows)} == {299}
