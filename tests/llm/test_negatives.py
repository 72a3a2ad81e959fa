from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talkatlas.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id long, rank int, anchor boolean, parts string, dim int"


def tenth():
    return F.col("vec_id") % 10 == 0


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, None, "x", 3) for i, v, label in rows], SCHEMA)


def brute(rows, k=5, top=10, low=30, high=90):
    ok = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        one = (label, len(v), [math.floor(256 * float(np.float32(x))) for x in v])
        ok[i] = min(ok.get(i, one), one, key=lambda r: (r[0], r[1], np.array(r[2], "<i8").tobytes()))
    out = set()
    for a, (label, dim, q) in ok.items():
        if a % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, same) for i, (same, d, v) in ok.items() if d == dim and i != a)
        for p, positive, _ in [s for s in scored if s[2] == label][:k]:
            inside = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p][:top]
            out |= {(a, positive, r, i, -p, -n) for r, (n, i, _) in enumerate(inside, 1)}
    return out


def planted():
    rng = np.random.default_rng(5)
    rows = []
    centres = rng.normal(size=(6, 24))
    for i in range(700):
        c = centres[rng.integers(6)] if rng.random() < 0.6 else 0
        rows.append((i, [float(np.float32(x)) for x in c + rng.normal(size=24) * 0.7], int(rng.integers(3))))
    for i in range(700, 760):  # many equal vectors, as positives and as negatives
        rows.append((i, rows[3][1], i % 3))
    rows += [(i, [float(x) for x in rng.normal(size=4)], i % 2) for i in range(760, 800)]  # another length
    rows += [(i, [0.0] * 24, 1) for i in range(800, 811)]
    rows += [(820, None, 1), (830, [None] + [1.0] * 23, 1), (840, [float("nan")] * 24, 1), (850, [float("inf")] * 24, 2)]
    rows += [(None, rows[0][1], 1), (860, rows[0][1], None), (870, [], 1), (880, [], 1), (881, [], 2)]
    rows += [rows[10], rows[20], (40, rows[41][1], 2), (40, rows[42][1], 2)]  # repeated ids
    return rows


@pytest.mark.parametrize("blocks", [(16_384, 1_024), (60, 7)])
def test_against_brute_force(spark, blocks):
    rows = planted()
    df = negatives.hard_negatives(frame(spark, rows), tenth(), block_rows=blocks[0], anchor_rows=blocks[1])
    got = [tuple(r) for r in df.collect()]
    want = brute(rows)
    assert len(got) == len(set(got))
    assert set(got) == want and len(want) > 1000


def test_scan_shuts_candidates_out_before_the_last_dimension():
    rng = np.random.default_rng(2)
    matrix = (rng.normal(size=(3000, 64)) * 256).astype("<i8")
    matrix[:40] += 600
    rows = pa.table(
        {"id": np.arange(3000), "label": np.arange(3000) % 2, "dim": pa.array([64] * 3000, pa.int32()),
         "parts": [r.tobytes() for r in matrix], "block": pa.array([0] * 3000, pa.int32())}
    )
    block = negatives.Block(negatives._columnar(rows))
    left = []
    scan = block.scan
    block.scan = lambda query, bitmap, shut_out: scan(
        query, bitmap, lambda a, b: (left.append(len(a)), shut_out(a, b))[1]
    )
    ids, score = block.positives(matrix[0].tolist(), 0, 0, 5)
    exact = matrix @ matrix[0]
    want = sorted((-s, i) for i, s in enumerate(exact.tolist()) if i and i % 2 == 0)[:5]
    assert list(zip((-score).tolist(), ids.tolist())) == want
    assert left[-1] < 200 < left[0] == 1499


def test_windows_are_exact_at_their_ends(spark):
    """30 % and 90 % of a positive's score belong to the window."""
    one = 1 / 256
    rows = [(0, [10 * one], 1), (1, [100 * one], 1)]
    rows += [(10 + k, [n * one], 2) for k, n in enumerate((29, 30, 31, 60, 89, 90, 91))]
    got = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.negative_id, r.negative_score, r.rank) for r in got] == [
        (15, 900, 1), (14, 890, 2), (13, 600, 3), (12, 310, 4), (11, 300, 5)
    ]


def test_huge_components_and_negative_scores(spark):
    rows = [(0, [3e38, 1.0], 1), (1, [3e38, 2.0], 1), (2, [1e38, 0.0], 2), (3, [-1.0, 0.0], 2)]
    got = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") == 0).collect()
    assert all(r.positive_id == 1 and r.positive_score == 2**63 - 1 for r in got)
    rows = [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2), (3, [0.0], 2)]
    assert negatives.hard_negatives(frame(spark, rows), F.col("vec_id") == 0).collect() == []


def test_empty_tables(spark):
    df = negatives.hard_negatives(frame(spark, []), tenth())
    assert df.collect() == []
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert negatives.hard_negatives(frame(spark, [(1, [1.0], 1)]), tenth()).collect() == []
    assert negatives.hard_negatives(frame(spark, [(10, [1.0], 1), (11, [1.0], 2)]), tenth()).collect() == []
