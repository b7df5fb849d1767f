import numpy as np
from pyspark.sql import functions as F

from railyard.llm import neighbours


def exact(rows, query, k):
    (vec,) = [v for i, v in rows if i == query]
    best = {}
    for i, v in rows:
        if i != query and len(v) == len(vec):
            score = float(np.dot(v, vec) / np.linalg.norm(v) / np.linalg.norm(vec))
            best[i] = max(best.get(i, -2.0), score)
    return sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]


def test_recall_over_shards(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=16)]) for i in range(1500)]
    rows += [(i, rows[7][1]) for i in range(1500, 1600)]  # a vector that many share
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    exact_rows = [(r[0], [float(x) for x in r[1]]) for r in df.collect()]
    out = neighbours.nearest(df, F.col("vec_id") % 50 == 0, rows_per_shard=300, queries_per_block=10).collect()
    hit = total = 0
    for query in range(0, 1600, 50):
        mine = sorted((r for r in out if r["query_id"] == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        want = dict(exact(exact_rows, query, 5))
        hit += len(want.keys() & {r["vec_id"] for r in mine})
        total += 5
    assert hit / total >= 0.9
    shared = sorted(r["vec_id"] for r in out if r["query_id"] == 1550)
    assert shared == [7, 1500, 1501, 1502, 1503]


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "x"), (0, [1.0, 0.0], "x"), (1, [2.0, 0.0], "x"), (2, [0.0, 1.0], "x"), (3, None, "x"),
        (4, [0.0, 0.0], "x"), (5, [nan, 1.0], "x"), (6, [inf, 1.0], "x"), (7, [None, 1.0], "x"), (8, [], "x"),
        (9, [1.0, 0.0, 0.0], "x"), (None, [1.0, 0.0], "x"), (50, [0.0, 0.0], "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string")
    out = neighbours.nearest(df, F.col("vec_id") % 50 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(out, key=lambda r: r["rank"])] == [(0, 1, 1), (0, 2, 2)]
    assert [round(r["score"], 12) for r in sorted(out, key=lambda r: r["rank"])] == [1.0, 0.0]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
