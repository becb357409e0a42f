import numpy as np
import pytest

from ventana.functions import quantiles as Q


@pytest.mark.parametrize("bins", [256, 3])
def test_equal_to_interpolated_quantiles(spark, monkeypatch, bins):
    monkeypatch.setattr(Q, "BINS", bins)
    rng = np.random.default_rng(1)
    groups = {"normal": rng.normal(size=301), "ties": rng.integers(0, 4, 200).astype(float), "one": np.array([7.5]),
              "wide": 10.0 ** rng.uniform(-300, 300, 120), "same": np.full(50, 2.0), "tiny": 1 + np.arange(60) * 2.0 ** -52,
              "ends": np.array([-np.inf, -1.0, 0.0, 2.0, 3.0, np.inf, np.inf, 5.0])}
    rows = [(g, float(x)) for g, v in groups.items() for x in v]
    rows += [("holes", None), ("holes", float("nan")), ("holes", 3.0), ("none", None), (None, 1.0), (None, 2.0)]
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = dict(Q.exact_quantiles(spark.createDataFrame(rows, "g string, v double").repartition(5), ["g"], "v", probs))
    for g, v in groups.items():
        s = np.sort(v)
        h = np.array(probs) * (len(s) - 1)
        a, b = s[np.floor(h).astype(int)], s[np.ceil(h).astype(int)]
        with np.errstate(invalid="ignore"):
            want = np.where(a == b, a, a + (b - a) * (h - np.floor(h)))
        assert np.allclose(got[(g,)], want, rtol=1e-12, atol=0, equal_nan=True), g
    assert got[("holes",)] == [3.0] * 7 and got[("none",)] == [None] * 7 and got[(None,)][3] == 1.5


def test_no_rows(spark):
    assert Q.exact_quantiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", [0.5]) == []
