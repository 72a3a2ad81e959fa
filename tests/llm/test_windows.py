from __future__ import annotations

import hashlib
import random
import re

import pytest
from corpus import frame, odd_texts, words

from talkatlas.llm import texts, windows


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def stays(rows, passage=50):
    """For every row the words that stay, window by window."""
    least: dict[tuple, int] = {}
    cut = [split(t) for _, t in rows]
    for (i, _), w in zip(rows, cut, strict=True):
        for s in range(len(w) - passage + 1) if i is not None else []:
            key = tuple(w[s : s + passage])
            least[key] = min(least.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, cut, strict=True):
        gone = set()
        for s in range(len(w) - passage + 1) if i is not None else []:
            if least[tuple(w[s : s + passage])] < i:
                gone.update(range(s, s + passage))
        out.append([x for k, x in enumerate(w) if k not in gone])
    return out


def expected(rows, passage=50):
    left = stays(rows, passage)
    return sorted(
        (i is not None, i or 0, len(split(t)), len(split(t)) - len(w), hashlib.sha256(" ".join(w).encode()).hexdigest())
        for (i, t), w in zip(rows, left, strict=True)
    )


def found(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = odd_texts(rng)
    passages = [words(rng, n) for n in (49, 50, 51, 60, 75, 130, 400, 900)]
    ids = list(range(20, 420))
    rng.shuffle(ids)
    for i in ids:
        one = words(rng, rng.randint(0, 60))
        for _ in range(rng.choice([0, 1, 1, 2])):
            p = rng.choice(passages)
            a = rng.choice([0, 0, rng.randrange(len(p))])
            one += p[a:] + words(rng, rng.choice([0, 0, 5, 30]))
        if rng.random() < 0.1:
            one = ["w"] * rng.choice([30, 60, 200]) + one
        out.append((i, rng.choice([" ", "\n", " \t\x0b"]).join(one)))
    base = words(rng, 700)
    for i in range(500, 540):  # near copies
        own = list(base)
        for _ in range(rng.choice([0, 1, 4])):
            own[rng.randrange(len(own))] = "changed"
        out.append((i, " ".join(own)))
    out += [(540, " ".join(["x", "y"] * 400)), (541, " ".join(["x", "y"] * 100)), (541, " ".join(["x", "y"] * 100))]
    out += [(541, "Other text " * 40), (542, "Other text " * 41), (543, " ".join(base) + "\n"), (544, " ".join(base))]
    return out


@pytest.mark.parametrize("group_rows", [windows.GROUP_ROWS, 3])
def test_against_brute_force(spark, rows, group_rows):
    got = found(windows.removals(frame(spark, rows), group_rows=group_rows))
    want = expected(rows)
    assert len(got) == len(want)
    assert [(a, b) for a, b in zip(got, want) if a != b] == []
    assert sum(r[3] > 0 for r in want) > 200 and sum(r[3] == 0 for r in want) > 50


def test_texts_without_repeats(spark, rows):
    docs = frame(spark, rows)
    left = windows.without_repeated_windows(docs)
    assert left.columns == docs.columns
    want = sorted(
        (repr(i), t if len(w) == len(split(t)) else " ".join(w)) for (i, t), w in zip(rows, stays(rows), strict=True) if t is not None
    )
    assert sorted((repr(r.doc_id), r.text) for r in left.collect() if r.text is not None) == want
    assert left.where("text IS NULL").count() == sum(t is None for _, t in rows)
    assert left.where("bits = 7 AND score = 0.5").count() == len(rows)


def test_other_lengths(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))) for i in range(120)]
    for passage in (2, 6):
        assert found(windows.removals(frame(spark, rows), passage=passage)) == expected(rows, passage)


def test_levels_double_until_no_candidate_survives(spark, rows):
    repeats = windows.Repeats(frame(spark, rows))
    settled = repeats.sharing(repeats.shared()).selectExpr("explode(settled.words) AS words")
    levels = {r.words for r in settled.distinct().collect()}
    assert {50, 100, 200} <= levels <= {50 << k for k in range(8)}


def test_settled_windows_are_not_judged_again(spark):
    rng = random.Random(2)
    base = words(rng, 1500)
    rows = [(i, " ".join([f"own{i}", *base, f"end{i}"])) for i in range(30)]
    repeats = windows.Repeats(frame(spark, rows))
    sharing = repeats.sharing(repeats.shared())
    judged = sharing.mapInArrow(windows._passages(50), "doc_id long, digest long, window long, groups int")
    assert judged.where("doc_id = 0").count() > 1400
    assert judged.where("doc_id = 7").count() < 700
    assert found(windows.removals(frame(spark, rows))) == expected(rows)


def test_a_very_long_text(spark):
    rng = random.Random(5)
    long = words(rng, 60_000)
    rows = [(1, " ".join(long)), (2, " ".join(long[20_000:] + words(rng, 100))), (3, " ".join(long))]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in windows.removals(frame(spark, rows)).collect()}
    assert got == {1: (60_000, 0), 2: (40_100, 40_000), 3: (60_000, 60_000)}


def test_empty_tables(spark):
    assert windows.removals(frame(spark, [])).collect() == []
    assert windows.without_repeated_windows(frame(spark, [])).collect() == []
    assert found(windows.removals(frame(spark, [(None, None)]))) == expected([(None, None)])


def test_every_repeated_window_selects_a_listed_half():
    import numpy as np

    rng = np.random.default_rng(3)
    hashes, row = texts.mix(rng.integers(0, 5, 400).astype(np.uint64)), np.repeat([0, 1, 2], [150, 49, 201])
    halves = windows._windows(hashes, row, 25)
    least = windows._least(halves, 25)
    at = windows._chosen(halves, least, 25)
    for s in np.flatnonzero(windows._windows(hashes, row, 50)):
        inside = [p for p in at if s <= p <= s + 25]
        assert inside and least[s] == halves[inside].min() == halves[s : s + 26].min()
