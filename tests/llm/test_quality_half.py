"""Outliers that fill nearly half of a group."""

import numpy as np
from pyspark.sql import functions as F

from adlake.llm import quality


def test_outliers_of_nearly_half_a_group_go(spark):
    draw = np.random.default_rng(7)

    def plain():
        return ["".join(draw.choice(list("abcdefgh"), draw.integers(3, 9))) for _ in range(int(draw.integers(80, 300)))]

    def junk():
        return [w + "###$$$" for w in plain()]

    rows = []
    for share in (35, 45):
        for kind, one in (("equal", junk()), ("loose", None)):
            for i in range(200):
                out = i % 100 < share
                rows.append((len(rows), " ".join((one or junk()) if out else plain()), "en", f"{kind}{share}", out))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, out boolean")
    kept = {row.doc_id for row in quality.quality_rules(df).where(F.col("kept")).collect()}
    for kind in sorted({row[3] for row in rows}):
        assert {r[0] for r in rows if r[3] == kind} & kept == {r[0] for r in rows if r[3] == kind and not r[4]}, kind
