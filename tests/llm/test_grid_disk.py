"""op10: what the meetings of intervals cost does not grow with their number."""

import numpy as np
from pyspark.sql import functions as F

from ventana.llm import grid_join


def on_disk(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()))


def test_meetings_shuffle_no_vectors(spark, monkeypatch):
    monkeypatch.setattr(grid_join, "INTERVAL", 100)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 32))  # no interval can be skipped: 465 meetings of 30 intervals
    x[2900:] = x[:100] + 0.01
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").cache()
    rows.count()
    before = on_disk(spark)
    got = grid_join.join(spark, rows, 0.95).agg(F.sum("n_links"), F.count_if("kept"), F.count(F.lit(1))).first()
    written = on_disk(spark) - before
    u = x.astype(np.float32).astype(np.float64)
    u /= np.sqrt((u * u).sum(axis=1))[:, None]
    links = (u @ u.T >= 0.95).sum() - len(u)
    assert tuple(got) == (links, 2900, 3000) and links == 200
    # the distinct vectors are shuffled twice, to be counted and to be put in order
    assert written < 4 * 3000 * 32 * 4
