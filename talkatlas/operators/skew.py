"""Lookups that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkatlas.session import stored

LOOKUP_BYTES = 8 << 20


def _row_bytes(lookup: DataFrame) -> Column:
    """Bytes of a row in memory: 16 for each value and what its strings, arrays and the like hold besides."""
    wide = [c for c, kind in lookup.dtypes if kind in ("string", "binary") or not kind.isalpha()]
    extra = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in wide]
    return sum(extra, F.lit(16 * len(lookup.columns)))


def measured_bytes(lookup: DataFrame) -> int:
    """Bytes of a written table in memory."""
    return lookup.agg(F.coalesce(F.sum(_row_bytes(lookup)), F.lit(0))).first()[0]


def skew_join(
    df: DataFrame, lookup: DataFrame, key: str | list[str], how: str = "inner", lookup_bytes: int = LOOKUP_BYTES
) -> DataFrame:
    """Join ``df`` to ``lookup``, the smaller side, mostly with one row per key.

    The lookup is written once and measured. Up to ``lookup_bytes`` it is broadcast and ``df`` is not shuffled. A larger one is
    never broadcast: it meets ``df`` in a sort-merge join whose two sides both come from an exchange of their own, the form in
    which adaptive execution splits a partition that is too large by bytes, so a hot key (or the NULL key of a
    left join) is spread over many tasks.
    """
    written = stored(lookup, "lookup")
    if measured_bytes(written) <= lookup_bytes:
        return df.join(F.broadcast(written), key, how)
    return df.join(written.hint("merge"), key, how)


def frequent_join(df: DataFrame, lookup: DataFrame, key: str, count: str, lookup_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """Inner join of ``df``, a written table, to ``lookup``, whose ``count`` says how many rows of ``df`` hold its ``key``.

    The most frequent keys, as many as ``lookup_bytes`` hold, are broadcast, and their rows of ``df`` stay where they are. Only rows
    with other keys meet the rest of the lookup in a sort-merge join.
    """
    written = stored(lookup, "lookup")
    digits = F.length(F.bin(count))
    sizes = {r.digits: r.held for r in written.groupBy(digits.alias("digits")).agg(F.sum(_row_bytes(written)).alias("held")).collect()}
    held, least = 0, max(sizes, default=0) + 1
    for d in sorted(sizes, reverse=True):
        held += sizes[d]
        if held > lookup_bytes:
            break
        least = d
    if held <= lookup_bytes:
        return df.join(F.broadcast(written), key)
    frequent, rest = written.where(digits >= least), written.where(digits < least)
    far = df.join(F.broadcast(frequent.select(key)), key, "left_anti").join(rest.hint("merge"), key)
    return df.join(F.broadcast(frequent), key).unionByName(far)
