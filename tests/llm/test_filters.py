from __future__ import annotations

import random
import re
from itertools import permutations

import pytest
from corpus import frame, odd_texts, words

from talkatlas.llm import filters

LABELS = "doc_id long, quality int, toxic int, text string"


def brute(rows, labels):
    """Every order applied document by document."""
    good = {i for i, q, _, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, _ in labels if t == 1 and i is not None}
    docs = []
    for doc_id, text, source in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        fails |= {"A"} if len(w) < 50 else set()
        fails |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        if doc_id is not None and any(i is not None and i < doc_id and (u or "") == t for i, u, _ in rows):
            fails.add("E")
        docs.append((source or "", fails, doc_id in good, doc_id in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        share = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, name in enumerate(order, 1):
                lost = [d for d in left if name in d[1]]
                gone = len([d for d in mine if name in d[1]]) - len(lost)
                left = [d for d in left if name not in d[1]]
                share[name] += len(lost)
                out[part, "".join(order), step] = [
                    len(left), len(lost), gone, sum(d[1] == {name} for d in mine), sum(d[2] for d in lost), sum(d[3] for d in lost)
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(share[order[step - 1]])
    return {key: tuple(row) for key, row in out.items()}


def found(df):
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = odd_texts(rng)
    for i in range(20, 140):
        one = words(rng, rng.choice([5, 49, 50, 80]), "abcABC#$" if rng.random() < 0.2 else "abcdefgh")
        if rng.random() < 0.3:
            one = [rng.choice(one[:6]) for _ in one]
        text = rng.choice([" ", "\n", "\t \x0b", " "]).join(one)
        texts.append((i, rng.choice(texts)[1] if rng.random() < 0.25 else text))
    texts += [(141, " ".join(["Ab"] * 50)), (142, "A" + "b" * 19), (143, "A" + "b" * 18), (20, "again")]
    return [(i, t, rng.choice([None, "", "s1", "s2", "s2", "s2"])) for i, t in texts]


def test_every_order_against_brute_force(spark, rows):
    rng = random.Random(4)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for i in range(0, 150, 2)]
    labels += [(None, 1, 1, "x"), (20, 0, 1, "x"), (20, 1, 0, "x"), (999, 1, 1, "x")]
    docs = frame(spark, [(i, t) for i, t, _ in rows], sources=[s for _, _, s in rows])
    docs = docs.selectExpr("*", "1 AS mask", "2 AS n", "'x' AS part", "0 AS words", "true AS first")
    got = found(filters.audit(docs, spark.createDataFrame(labels, LABELS)))
    want = brute(rows, labels)
    assert got == want
    assert len(got) == 600 * len({s or "" for _, _, s in rows})


def test_kept_and_removed_add_up(spark, rows):
    docs = frame(spark, [(i, t) for i, t, _ in rows], sources=[s for _, _, s in rows])
    got = found(filters.audit(docs, spark.createDataFrame([], LABELS)))
    n = {}
    for _, _, s in rows:
        n[s or ""] = n.get(s or "", 0) + 1
    for part, total in n.items():
        for order in filters.ORDERS:
            assert sum(got[part, order, k][1] for k in range(1, 6)) + got[part, order, 5][0] == total
        one = filters.ORDERS[0]
        assert sum(got[part, one, k][6] for k in range(1, 6)) == 120 * (total - got[part, one, 5][0])
        assert all(got[part, one, k][4:6] == (0, 0) for k in range(1, 6))


def test_fields_hold_large_counts_without_running_over():
    many = 2**61
    total = sum(filters.packed(m) * many for m in (0, 1, 31))
    fields = filters.unpacked(total)
    one = sum(filters.unpacked(filters.packed(m)) for m in (0, 1, 31))
    assert (fields == one * many).all()
    assert filters.unpacked(filters.packed(0)).sum(axis=0).tolist() == [600, 0, 0, 0]
    assert filters.unpacked(filters.packed(31)).sum(axis=0).tolist() == [0, 120, 480, 0]


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert filters.audit(docs, spark.createDataFrame([], LABELS)).collect() == []
    one = filters.audit(frame(spark, [(1, None)]), spark.createDataFrame([], LABELS))
    assert one.count() == 600
    assert one.columns == [c.split()[0] for c in filters.SCHEMA.split(", ")]
