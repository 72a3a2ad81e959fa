from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from corpus import frame, odd_texts, words
from pyspark.sql import functions as F

from talkatlas.llm import fingerprints


def shingles(text: str) -> set[tuple]:
    w = [x for x in re.split("[ \t-\r]+", text.lower()) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_edited_texts_and_neighbours(spark):
    rng = random.Random(12)
    texts = odd_texts(rng) + [(20 + k, " ".join(words(rng, rng.randint(1, 400)))) for k in range(60)]
    rows = fingerprints.edited_fingerprints(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    # Different documents in order; NULL ids first. Documents of one id may come in any order, so leave those out.
    ids = [i for i, _ in texts]
    alone = {i: t or "" for i, t in texts if i is not None and (ids.count(i) == 1 or i == 9)}
    order = sorted(alone)
    by_id = {r.doc_id: r for r in rows}
    errors = []
    for i, nxt in zip(order, order[1:]):
        t, n = alone[i], alone[nxt]
        m = len(t) // 4
        edited = t[: len(t) - m] + n[:m]
        r = by_id[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for estimate, other in ((r.near_edited, edited), (r.near_next, n)):
            a, b = shingles(t), shingles(other)
            errors.append(estimate - (len(a & b) / len(a | b) if a | b else 1.0))
        assert (r.fingerprint == r.edited_fingerprint) >= (t == edited)
    assert abs(np.mean(errors)) < 0.02 and np.mean(np.abs(errors)) < 0.05
    assert {r.fingerprint for r in rows if r.doc_id in (1, 2, 3)} == {""}
    assert by_id[6].fingerprint == by_id[7].fingerprint and len(by_id[6].fingerprint) == fingerprints.BINS
    assert by_id[6].near_next == 1.0 and by_id[1].near_next == 1.0


def test_estimates_are_unbiased_for_sparse_and_dense_texts(spark):
    rng = random.Random(2)
    pairs = []
    for n in (12, 40, 200, 1500):
        for _ in range(60):
            w = words(rng, n)
            keep = rng.randint(5, n)
            pairs.append((n, " ".join(w), " ".join([*w[:keep], *words(rng, n - keep)])))
    df = spark.createDataFrame(pairs, "n int, a string, b string")
    rows = df.select("*", fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))).alias("j")).collect()
    for n in (12, 40, 200, 1500):
        error = []
        for r in rows:
            if r.n == n:
                a, b = shingles(r.a), shingles(r.b)
                error.append(r.j - len(a & b) / len(a | b))
        assert abs(np.mean(error)) < 0.04 and np.std(error) < (0.2 if n == 12 else 0.1)


def test_plan_is_native_and_empty_table(spark):
    docs = frame(spark, [(1, "a b")])
    plan = fingerprints.edited_fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert fingerprints.edited_fingerprints(docs.limit(0)).count() == 0
