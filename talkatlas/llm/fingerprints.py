"""One-permutation MinHash fingerprints with optimal densification. Column expressions only.

A text is lower-cased and cut into words at ASCII white space; five neighbouring words are a shingle (a text
of fewer words is one shingle). Every shingle is hashed once: the top bits of the hash are its
bin, and each of the ``BINS`` bins keeps its least hash. A bin that stays empty borrows from a bin found by
its own sequence of universal-hash attempts, the same for every text, until one is filled. Of each
bin the lowest four bits are kept, so a fingerprint is ``BINS`` hex digits. The share m of equal digits of two
fingerprints estimates the shingle sets' Jaccard similarity j, as m = j + (1 - j) / 16; ``likeness`` solves
for j and cuts at 0.

A text without words has the empty fingerprint, which is like (1.0) another empty one and unlike (0.0)
all others. NULL texts are empty texts. NULL ids sort first. Repeated rows (same id and text) are one
document among the neighbours and come back as often as they come in.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkatlas.llm.tables import kept
from talkatlas.operators.ranking import global_rank

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
CODE_BITS = 4
SEED = 11
NO_ID = -(1 << 63)
BLANKS = " \t\n\x0b\f\r"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often the expression reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.split(F.btrim(F.lower(text), F.lit(BLANKS)), "[ \\t-\\r]+")


def _hashes(w: Column) -> Column:
    """56-bit shingle hashes, not negative; the bin is on top."""
    n = F.size(w)
    many = F.transform(
        F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE)))
    )
    return F.transform(F.when(n >= SHINGLE, many).otherwise(F.array(F.xxhash64(w))), lambda h: F.shiftrightunsigned(h, 8))


def _bin(x: Column) -> Column:
    return F.shiftright(x, 56 - BIN_BITS).cast("int")


def _slots(least: Column) -> Column:
    """One byte per bin from the sorted least hashes: 0 for an empty bin, else 16 plus the low four bits."""
    parts = F.transform(
        least,
        lambda x, i: F.concat(
            F.repeat(F.lit("00"), _bin(x) - F.when(i == 0, -1).otherwise(_bin(F.get(least, F.greatest(i - 1, F.lit(0))))) - 1),
            F.lit("1"),
            F.hex(x.bitwiseAND(F.lit((1 << CODE_BITS) - 1))),
        ),
    )
    rest = F.repeat(F.lit("00"), BINS - 1 - _bin(F.element_at(least, -1)))
    return F.unhex(F.concat(F.array_join(parts, ""), rest))


def _attempts() -> Column:
    """For every bin the start and the (odd) step of its attempts, from a seed."""
    rng = np.random.default_rng(SEED)
    start, step = rng.integers(0, BINS, BINS), rng.integers(0, BINS // 2, BINS) * 2 + 1
    rows = [F.struct(F.lit(i).alias("i"), F.lit(int(a)).alias("a"), F.lit(int(d)).alias("d")) for i, (a, d) in enumerate(zip(start, step, strict=True))]
    return F.array(*rows)


def _densified(slots: Column) -> Column:
    """The digits of all bins; an odd step visits every bin, so one attempt always succeeds."""

    def digit(bin_: Column) -> Column:
        def at(place: Column) -> Column:
            held = F.substring(slots, place + 1, F.lit(1))
            return F.when(held != F.lit(b"\x00"), held)

        tries = [at((bin_.a + bin_.d * t).bitwiseAND(F.lit(BINS - 1))) for t in range(BINS)]
        return F.substring(F.hex(F.coalesce(at(bin_.i), *tries)), 2, 1)

    return F.lower(F.array_join(F.transform(_attempts(), digit), ""))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as ``BINS`` hex digits; empty for a text without words."""
    filled = _let(
        words(text),
        lambda w: _let(
            F.sort_array(_hashes(w)),
            lambda s: _let(
                F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, F.greatest(i - 1, F.lit(0)))))),
                lambda least: _let(_slots(least), _densified),
            ),
        ),
    )
    return F.when(F.btrim(text, F.lit(BLANKS)) == "", F.lit("")).otherwise(filled)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the texts of two fingerprints."""

    def equal_digits(k: int) -> Column:
        x, y = (F.conv(F.substring(f, 16 * k + 1, 16), 16, -10).cast("long") for f in (a, b))
        z = x.bitwiseXOR(y)
        for shift in (1, 2):
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
        return F.lit(16) - F.bit_count(z.bitwiseAND(F.lit(0x1111111111111111)))

    same = sum((equal_digits(k) for k in range(1, BINS // 16)), equal_digits(0))
    chance = 1 / (1 << CODE_BITS)
    estimate = F.greatest((same / F.lit(float(BINS)) - chance) / (1 - chance), F.lit(0.0))
    return F.when((a == "") | (b == ""), F.when(a == b, 1.0).otherwise(0.0)).otherwise(estimate)


def with_neighbours(docs: DataFrame) -> DataFrame:
    """``id, digest, n_chars, copies`` of every different document, and ``next_id, next_digest`` of the next one."""
    sizes = docs.groupBy("id", "digest").agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    ranked = kept(global_rank(sizes, [F.col("id"), F.col("digest")], "place"), "ranked")
    n = ranked.count()
    following = ranked.select(
        F.col("id").alias("next_id"), F.col("digest").alias("next_digest"), F.pmod(F.col("place") - 1, F.lit(max(n, 1))).alias("place")
    )
    return kept(ranked.join(following, "place").drop("place"), "neighbours")


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness; see the module and ``edited``.

    The edited text has its last quarter of code points (rounded down) replaced by the first as many, or all, of the
    next document. Whole texts are shuffled once; of a next text only the borrowed head travels on.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(body, F.lit(SEED)).alias("digest"),
        body.alias("text"),
    )
    near = with_neighbours(rows.select("id", "digest", F.length("text").cast("long").alias("n_chars")))
    wanted = near.select(
        F.col("next_id").alias("id"),
        F.col("next_digest").alias("digest"),
        F.floor(F.col("n_chars") / 4).cast("int").alias("take"),
        F.col("id").alias("for_id"),
        F.col("digest").alias("for_digest"),
    )
    heads = rows.join(wanted.hint("shuffle_hash"), ["id", "digest"]).select(
        F.col("for_id").alias("id"), F.col("for_digest").alias("digest"), "take", F.substring("text", F.lit(1), F.col("take")).alias("head")
    )
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - F.col("take")), "head")
    both = rows.join(heads.hint("shuffle_hash"), ["id", "digest"]).select("id", "digest", "text", edited.alias("edited"))
    prints = kept(
        both.select(
            "id",
            "digest",
            F.sha2("edited", 256).alias("edited_sha256"),
            fingerprint(F.col("text")).alias("fingerprint"),
            fingerprint(F.col("edited")).alias("edited_fingerprint"),
        ).dropDuplicates(["id", "digest"]),
        "prints",
    )
    nexts = prints.select(
        F.col("id").alias("next_id"), F.col("digest").alias("next_digest"), F.col("fingerprint").alias("next_fingerprint")
    )
    own, next_ = F.col("fingerprint"), F.col("next_fingerprint")
    return (
        prints.join(near, ["id", "digest"])
        .join(nexts, ["next_id", "next_digest"])
        .select(
            F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
            likeness(own, next_).alias("near_next"),
            F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        )
        .drop("copy")
    )
