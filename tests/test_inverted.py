from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkatlas.operators import inverted as I
from talkatlas.operators.knn import nearest

SCHEMA = "vec_id long, embedding array<float>, category string, list int, cell int"
DIM = 6


def clustered(n=1500, groups=12, copies=400, seed=5):
    """Tight groups of very different size; copies of one vector, zero vectors and faulty rows among them."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, DIM))
    m = centres[np.minimum(rng.geometric(0.3, size=n) - 1, groups - 1)] + 0.1 * rng.normal(size=(n, DIM))
    m[:copies] = m[0]
    m[copies : copies + 5] = 0
    rows = [(i, [float(x) for x in v], "abc"[i % 3], i, -i) for i, v in enumerate(m.astype(np.float32))]
    bad = [(None, rows[0][1], "a", 0, 0), (9001, None, "a", 0, 0), (9002, [1.0], "a", 0, 0), (9003, [float("nan")] * DIM, "a", 0, 0)]
    return rows + bad


def indexed(spark, tmp_path, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    I.build_index(frame, str(tmp_path / "index"), row_id="vec_id", vector="embedding", dim=DIM, columns=("category",), **options)
    return frame, I.open_index(spark, str(tmp_path / "index"), row_id="vec_id", dim=DIM, columns=("category",))


def plain(frame, k):
    return nearest(frame, frame, k, row_id="vec_id", vector="embedding", dim=DIM, query_columns=("category",), columns=("category",))


def as_set(df):
    return {tuple(r) for r in df.select(*sorted(df.columns)).collect()}


@pytest.mark.parametrize("crowded", [False, True])
def test_exact_search_equals_the_plain_one(spark, tmp_path, monkeypatch, crowded):
    if crowded:
        monkeypatch.setattr(I, "CELL_ROWS", 40)
        monkeypatch.setattr(I, "QUERY_ROWS", 150)
    frame, index = indexed(spark, tmp_path, clustered())
    if crowded:
        assert index.cells.size.max() < 120  # parts are dealt by a hash
    found, work = I.exact(index, frame, 7, vector="embedding", query_columns=("category",))
    assert as_set(found) == as_set(plain(frame, 7))
    n_compared, n_pairs = work.first()
    assert n_pairs == 1500 * 1500 and n_compared < 0.7 * n_pairs


def test_exact_search_with_fewer_rows_than_asked_for(spark, tmp_path):
    rows = clustered()[:3] + clustered()[400:402] + clustered()[900:903]
    frame, index = indexed(spark, tmp_path, rows)
    found, _ = I.exact(index, frame, 20, vector="embedding", query_columns=("category",), probes=1)
    assert as_set(found) == as_set(plain(frame, 20))


def test_probed_search_reaches_the_recall_it_states(spark, tmp_path):
    rng = np.random.default_rng(1)  # no groups at all: the hard case
    rows = [(i, [float(x) for x in rng.normal(size=DIM)], "a", 0, 0) for i in range(2000)]
    frame, index = indexed(spark, tmp_path, rows)
    probes, stated = I.tuned_probes(index, frame, 9, vector="embedding")
    assert 0.95 <= stated <= 1 and 1 < probes < index.cells.lists
    truth = plain(frame, 9).select("query_vec_id", "vec_id")

    def recall(p):
        found = I.probe(index, frame, 9, vector="embedding", probes=p, query_columns=("category",))
        return truth.join(found.select("query_vec_id", "vec_id"), ["query_vec_id", "vec_id"], "left_semi").count() / truth.count()

    assert abs(recall(probes) - stated) < 0.03
    assert recall(1) < recall(probes) and recall(index.cells.lists) == 1


def test_every_row_is_indexed_once_and_the_file_is_sorted(spark, tmp_path):
    rows = clustered()
    _, index = indexed(spark, tmp_path, rows, lists=9)
    ids = [r._id for r in index.rows.select("_id").collect()]
    assert sorted(ids) == [r[0] for r in rows[:1500]] and index.cells.size.sum() == 1500
    assert {r._id for r in index.rows.where(F.col("list") == I.ZERO).collect()} == set(range(400, 405))
    files = index.rows.select("cell", F.input_file_name().alias("file")).distinct()
    assert files.count() == files.select("cell").distinct().count()


def test_nothing_to_index_and_nothing_to_ask(spark, tmp_path):
    rows = clustered()
    frame, index = indexed(spark, tmp_path, rows[-4:])
    found, work = I.exact(index, frame, 3, vector="embedding")
    assert found.count() == 0 and work.first()[0] == 0
    whole, index = indexed(spark, tmp_path / "b", rows)
    assert I.exact(index, whole.limit(0), 3, vector="embedding")[0].count() == 0
    assert I.probe(index, whole.limit(0), 3, vector="embedding", probes=2).count() == 0
    zeros, index = indexed(spark, tmp_path / "c", rows[400:405])
    found, _ = I.exact(index, zeros, 2, vector="embedding", query_columns=("category",))
    assert as_set(found) == as_set(plain(zeros, 2))


def test_wide_searches_meet_blocks_of_rows_and_not_cells(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    rows = clustered(300, copies=40) + [(5000 + i, [float(x) for x in rng.normal(size=DIM)], "a", 0, 0) for i in range(300)]
    frame, index = indexed(spark, tmp_path, rows + rows[50:60])
    met = []
    monkeypatch.setattr(I, "_scan", lambda asked, *a, scan=I._scan, **b: met.append(asked.count()) or scan(asked, *a, **b))

    def found(share):
        monkeypatch.setattr(I, "SCAN_SHARE", share)
        exact, work = I.exact(index, frame, 5, vector="embedding", query_columns=("category",))
        probed = [I.probe(index, frame, 5, vector="embedding", probes=p, query_columns=("category",)) for p in (index.cells.lists - 2, index.cells.lists)]
        return [sorted(map(tuple, df.select(*sorted(df.columns)).collect())) for df in (exact, *probed)], work.first()

    visited, work = found(2.0)
    assert met == []
    scanned, more = found(0.25)
    assert scanned == visited and len(met) == 3 and met[1:] == [610, 610] and 0 < met[0] < 610
    assert work.n_compared <= more.n_compared <= more.n_pairs == 610 * 610
