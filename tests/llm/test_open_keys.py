"""Keys whose members lie in several components: every pair of different components meets once at least."""

import itertools
import random

from pyspark.sql import functions as F

from adlake.llm import neardup
from adlake.llm.common import Staging


def test_all_pairs_of_different_components_meet(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    draw = random.Random(6)
    members = {1: [(i, 7 if i < 60 else i) for i in range(75)], 2: [(i, i % 3) for i in range(40)], 3: [(i, i) for i in range(8)], 4: [(i, i) for i in range(20)]}
    rows = [(key, i, c, len(each)) for key, each in members.items() for i, c in each]
    draw.shuffle(rows)
    left = spark.createDataFrame(rows, "key long, id long, component long, n long")
    placed = neardup._groups_to_compare(left, Staging(spark, "test")).collect()
    groups = {}
    for row in placed:
        groups.setdefault((row.key, row.low, row.high), []).append(row)
    met = set()
    for (key, low, high), each in groups.items():
        assert {row.block for row in each} <= {low, high}
        for a, b in itertools.combinations(each, 2):
            if a.component != b.component and (low == high or a.block != b.block):
                met.add((key, min(a.id, b.id), max(a.id, b.id)))
    want = {(k, a, b) for k, each in members.items() for (a, c), (b, d) in itertools.combinations(each, 2) if c != d}
    assert met == want
    # the 60 members of the largest component of key 1 are not placed once per block of all
    copies = sum(row.key == 1 and row.component == 7 for row in placed)
    assert copies == 60 * 2


def test_groups_do_not_depend_on_the_block(spark, monkeypatch):
    draw = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for group in range(6):
        words = base[: 40 - group] + [f"g{group}_{i}" for i in range(25 + group)]
        for _ in range(15):
            copy = list(words)
            for _ in range(draw.randrange(3)):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(10**6)}"
            texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    results = []
    for block in (512, 4):
        monkeypatch.setattr(neardup, "BLOCK", block)
        found = neardup.near_duplicates(df)
        results.append(sorted((r.doc_id, r.component_id) for r in found.select("doc_id", "component_id", F.lit(1)).collect()))
    assert results[0] == results[1]
