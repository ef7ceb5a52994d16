"""Hard negatives against brute force and the oracle, on odd rows and ties."""

import math
import random

import duckdb
import numpy as np
import pytest

from ampere.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    taken = set()
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v]
        taken.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2]))

    out = set()
    for a in taken:
        if a[0] % 100:
            continue
        others = sorted((r for r in taken if r != a), key=lambda r: (-score(a, r), r[0]))
        for p in [r for r in others if r[1] == a[1]][:5]:
            top = score(a, p)
            window = [r for r in others if r[1] != a[1] and 80 * top <= 100 * score(a, r) <= 100 * top]
            out |= {(a[0], p[0], k, n[0], top, score(a, n)) for k, n in enumerate(window[:5], 1)}
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 2), (64, 64, 64), (65, 129, 66), (130, 64, 200), (7, 0, 3), (0, 4, 4), (257, 70, 131)])
def test_strassen(shape):
    r = np.random.default_rng(sum(shape))
    a, b = r.integers(-(2**20), 2**20, shape[:2]), r.integers(-(2**20), 2**20, shape[1:])
    for leaf in (1 if sum(shape) < 20 else 16, 64):
        assert (N.strassen(a, b, leaf) == a @ b).all()


def test_scores_beyond_the_safe_range():
    a = np.array([[2**40, 1], [3, -(2**40)]])
    c = np.array([[2**21, 5], [-(2**20), 2**22], [2**22, -1]])
    want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in c] for u in a]
    assert N.scores(a, c).tolist() == want
    with pytest.raises(ValueError):
        N.scores(a, c * 2**20)


def test_first_keeps_the_order_of_ties():
    x = np.array([3, 9, 9, 1, 9, 3, 9, 9, 9, 9, 9, 2] * 3)
    assert N._first(x, 5).tolist() == np.argsort(-x, kind="stable")[:5].tolist()
    assert N._first(x[:3], 5).tolist() == [1, 2, 0] and N._first(x[:0], 5).tolist() == []


@pytest.fixture(scope="module")
def table(spark):
    r = random.Random(4)
    base = [[r.gauss(0, 1) for _ in range(6)] for _ in range(6)]
    rows = [(i, [x + r.gauss(0, 0.3) for x in base[i % 6]], r.randrange(4)) for i in range(420)]
    rows += [(1000 + i, list(base[0]), i % 3) for i in range(300)]  # a vector that many rows hold
    rows += [(2000, list(base[0]), 1), (2000, list(base[0]), 1), (2100, None, 1), (2200, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1)]
    rows += [(2300, [float("nan")] * 6, 1), (2400, [float("inf")] * 6, 2), (2500, list(base[1]), None), (None, list(base[1]), 1), (None, None, None)]
    rows += [(2600, [0.0] * 6, 2), (2700, [], 3), (2800, [1.0, 2.0], 3), (2900, [-x for x in base[2]], 0), (3000, [0.5, 2.5, 1.0], 3)]
    return rows


def test_against_brute_force(spark, table, monkeypatch):
    df = spark.createDataFrame(table, SCHEMA).selectExpr("*", "1 AS id", "2 AS key", "3 AS tile", "4 AS q", "5 AS rank")
    want = brute(table)
    got = rows_of(N.op13_hard_negatives(df))
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 60
    monkeypatch.setattr(N, "TILE", 50)
    monkeypatch.setattr(N, "BLOCK", 4)
    monkeypatch.setattr(N, "ROWS_AT_ONCE", 2)
    assert set(rows_of(N.op13_hard_negatives(df.repartition(3)))) == want


def test_empty_and_lone(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert N.op13_hard_negatives(none).collect() == []
    lone = spark.createDataFrame([(100, [1.0, 2.0], 3), (101, [1.0, 2.0], 4)], SCHEMA)
    assert N.op13_hard_negatives(lone).collect() == []  # no positive


def test_parameters(spark):
    rows = [(i, [1.0, i / 10], i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = N.hard_negatives(df, N.F.col("id") == 9, positives=1, negatives=2, least=0, scale=10).collect()
    assert [(r.anchor_id, r.positive_id, r.negative_id) for r in out] == [(9, 7, 6), (9, 7, 4)]


def test_oracle(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}')")
    con.execute("SELECT count(*) FROM embeddings")
    got = sorted(tuple(r) for r in N.op13_hard_negatives(spark.read.parquet(path)).collect())
    assert got == sorted(con.execute(N.ORACLE).fetchall()) and got
