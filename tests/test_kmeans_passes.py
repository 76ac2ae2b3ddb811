"""k-means makes the vectors once for its passes, and its rounds read them as arrays."""

import numpy as np

from corpusprep.operators import cluster as cu


def test_vectors_are_made_once_for_all_rounds(spark):
    seen = spark.sparkContext.accumulator(0)
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 0.3, (20, 3)) for c in (0.0, 4.0, 9.0)])
    rows = [("w", "a" if i % 2 else None, i, v.tolist()) for i, v in enumerate(x)]

    def made(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    df = spark.createDataFrame(rows, "workbook string, sheet string, row_idx bigint, v array<double>")
    df = df.mapInPandas(made, df.schema)
    out, cents = cu.kmeans(df, "v", 3)
    assert seen.value == 60                       # the rows of the result are made when they are read
    got = {(r.sheet, r.row_idx): r.cluster for r in out.collect()}
    for sheet in ("a", None):
        mine = [i for i in range(60) if ("a" if i % 2 else None) == sheet]
        assert len({got[sheet, i] for i in mine}) == 3
        assert all(len({got[sheet, i] for i in mine if i // 20 == g}) == 1 for g in range(3))
    assert cents.where("converged").count() == 6
