import pyarrow as pa
from pyspark.sql import functions as F

from ventana.llm.common import smallest, split_words


def test_smallest_keeps_the_smallest_and_few_more(spark):
    df = spark.range(50_000).select("id", F.xxhash64("id").alias("h"), (F.col("id") % 10 == 0).alias("g"))
    some = smallest(df, F.col("h"), 100, F.col("g"))
    unsigned = lambda h: h % (1 << 64)
    for g in (True, False):
        want = sorted(unsigned(r.h) for r in df.where(F.col("g") == g).collect())
        got = sorted(unsigned(r.h) for r in some.where(F.col("g") == g).collect())
        assert 100 <= len(got) < 400 and got == want[:len(got)]
    assert smallest(df, F.col("h"), 10 ** 6).count() == 50_000
    assert smallest(df.limit(0), F.col("h"), 5).count() == 0
    edge = spark.createDataFrame([(0,), (-1,), (1 << 62,)], "h long")
    assert [r.h for r in smallest(edge, F.col("h"), 1).collect()] == [0]


def test_split_words():
    words, number, ends = split_words(pa.array([" a b\t\na ", None, "", "\x1cb b"]))
    flat = [words[i].as_py() for i in number]
    assert flat == ["a", "b", "a", "\x1cb", "b"] and ends.tolist() == [3, 3, 3, 5]
