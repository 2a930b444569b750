import random

import pandas as pd

from ledgerloom.operators import fill
from conftest import rows


def test_fill_within_year_fixture(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 1.0), (1, 3, None), (2, 1, None), (2, 2, 3.0)],
                               "year int, q int, v double")
    for split in (False, True):
        out = fill.forward_fill(df, ["v"], ["year"], ["q"], split_hot_groups=split)
        assert rows(out) == [(1, 1, None), (1, 2, 1.0), (1, 3, 1.0), (2, 1, None), (2, 2, 3.0)]


def test_split_fill_matches_brute_force_with_hot_group(spark):
    rnd = random.Random(5)
    data = []
    for i in range(4000):
        g = 0 if i < 2500 else rnd.randint(1, 40)  # group 0 holds most rows
        v = rnd.random() if rnd.random() < 0.15 else None
        data.append((g, i, v))
    df = spark.createDataFrame(data, "g int, o int, v double")
    out = fill.forward_fill(df, ["v"], ["g"], ["o"], split_hot_groups=True, segments=16)
    pdf = pd.DataFrame(data, columns=["g", "o", "v"]).sort_values(["g", "o"])
    pdf["v"] = pdf.groupby("g")["v"].ffill()
    want = sorted(((int(a), int(b), None if pd.isna(c) else float(c)) for a, b, c in pdf.itertuples(index=False)),
                  key=repr)
    assert rows(out) == want


def test_split_fill_carries_across_empty_segments(spark):
    # Values so sparse that many segments of the hot group hold none: the
    # carry must reach past them.  Two columns, a NULL group, 32 segments.
    rnd = random.Random(11)
    data = []
    for i in range(3000):
        g = 0 if i < 2400 else (None if i % 7 == 0 else rnd.randint(1, 9))
        a = float(i) if rnd.random() < 0.01 else None
        b = rnd.randint(0, 99) if rnd.random() < 0.05 else None
        data.append((g, i, a, b))
    df = spark.createDataFrame(data, "g int, o int, a double, b int")
    out = fill.forward_fill(df, ["a", "b"], ["g"], ["o"], split_hot_groups=True, segments=32)
    pdf = pd.DataFrame(data, columns=["g", "o", "a", "b"]).astype({"g": "Int64", "b": "Int64"})
    pdf = pdf.sort_values(["g", "o"], na_position="first")
    pdf[["a", "b"]] = pdf.groupby("g", dropna=False)[["a", "b"]].ffill()

    def norm(x):
        return None if pd.isna(x) else x

    want = sorted(((norm(g) if norm(g) is None else int(g), int(o), norm(a), norm(b) if norm(b) is None else int(b))
                   for g, o, a, b in pdf.itertuples(index=False)), key=repr)
    assert rows(out) == want
