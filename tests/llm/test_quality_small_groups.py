"""Sources with few documents are judged by their language."""

import numpy as np

from adlake.llm import quality


def test_few_documents_of_a_large_language_are_judged(spark):
    draw = np.random.default_rng(8)
    rows = []
    for i in range(310):
        words = ["".join(draw.choice(list("abcdefgh"), draw.integers(3, 9))) for _ in range(int(draw.integers(80, 300)))]
        if i in (300, 301):
            words = [w + "###$$$" for w in words]
        rows.append((i, " ".join(words), "en", "big" if i < 300 else "few"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {row.doc_id: row for row in quality.quality_rules(df).collect()}
    assert len(got) == 310 and all(row.outlier_distance is not None for row in got.values())
    assert {i for i in got if not got[i].kept} == {300, 301}
