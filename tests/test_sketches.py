from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from talkatlas.operators import sketches as S
from talkatlas.session import scratch_path

SCHEMA = "part long, g string, s string, n int"


def counts(sketches, *by):
    rows = S.counted(sketches).collect()
    return {(*[r[b] for b in by], r.column_name): (r.n_rows, r.n_null, r.n_empty, r.n_distinct) for r in rows}


@pytest.fixture()
def rows(spark):
    """One hot value and group, NULLs, empty strings, repeated rows."""
    data = [(i % 3, "hot" if i % 3 else f"g{i % 7}", "same" if i % 2 else f"v{i % 50}", i % 11) for i in range(900)]
    data += [(0, None, None, None), (1, "g1", "", 0), (2, "g1", "", None), (2, "g1", "", None)]
    return spark.createDataFrame(data, SCHEMA).repartition(6)


def test_small_counts_are_exact(rows):
    data = rows.collect()
    got = counts(S.distinct_sketches(rows, ["s", "n"], ("g",)), "g")
    for g in {r.g for r in data}:
        for c in ("s", "n"):
            values = [r[c] for r in data if r.g == g]
            known = {v for v in values if v is not None}
            assert got[g, c] == (len(values), values.count(None), values.count(""), len(known))
    assert len(got) == 2 * len({r.g for r in data})


def test_parts_merge_to_the_whole(spark, rows):
    path = scratch_path(spark, "sketches")
    for p in (0, 1, 2):
        S.store_sketches(S.distinct_sketches(rows.where(F.col("part") == p), ["s", "n"], ("part", "g")), path, "part")
    whole = counts(S.distinct_sketches(rows, ["s", "n"]))
    assert counts(S.merge(S.stored_sketches(spark, path))) == whole
    assert counts(S.merge(S.stored_sketches(spark, path), ("g",)), "g") == counts(S.distinct_sketches(rows, ["s", "n"], ("g",)), "g")
    again = S.distinct_sketches(rows.where(F.col("part") == 1), ["s", "n"], ("part", "g"))
    S.store_sketches(again, path, "part")
    assert counts(S.merge(S.stored_sketches(spark, path))) == whole


def test_large_counts_keep_the_stated_error(spark):
    n = 200_000
    table = spark.range(n).select((F.col("id") % 8).alias("part"), (F.col("id") % 150_000).alias("a"), F.lit(1).alias("b"))
    merged = counts(S.merge(S.distinct_sketches(table, ["a", "b"], ("part",))))
    assert merged["b",] == (n, 0, 0, 1)
    assert abs(merged["a",][3] / 150_000 - 1) < 4 * S.standard_error()
    fine = counts(S.distinct_sketches(table, ["a"], bits=18))
    assert fine["a",][3] == 150_000


def test_size_does_not_grow_with_the_values(spark):
    few, many = (
        S.distinct_sketches(spark.range(n).select(F.col("id").alias("a")), ["a"]).select(F.octet_length("sketch")).first()[0]
        for n in (20_000, 400_000)
    )
    assert max(few, many) <= 8 * 2 ** (S.BITS + 1) + 64


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert counts(S.distinct_sketches(none, ["s"])) == {("s",): (0, 0, 0, 0)}
    assert counts(S.merge(S.distinct_sketches(none, ["s"], ("g",)), ("g",)), "g") == {}
