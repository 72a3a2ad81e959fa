from __future__ import annotations

import random

import pytest
from corpus import frame, odd_texts, words

from talkatlas.llm import suffixes

N = suffixes.PASSAGE


def slow_spans(texts):
    """First places of all windows by plain comparison; exact copies point to the first copy."""
    first_copy: dict[str, int] = {}
    for i, t in sorted((x for x in texts if x[0] is not None), key=lambda x: x[0]):
        first_copy.setdefault(t or "", i)
    seen: dict[tuple, tuple] = {}
    spans = set()
    for i, t in sorted({(i, t or "") for i, t in texts if i is not None}):
        w = t.split()
        if first_copy[t] != i:
            if len(w) >= N:
                spans.add((i, 0, len(w), first_copy[t]))
            continue
        found = []
        for s in range(len(w) - N + 1):
            place = seen.setdefault(tuple(w[s : s + N]), (i, s))
            if place != (i, s):
                found.append((s, place[0]))
        run = None
        for s, source in found:
            if run and s <= run[1]:
                run = [run[0], s + N, min(run[2], source)]
            else:
                if run:
                    spans.add((i, run[0], run[1] - run[0], run[2]))
                run = [s, s + N, source]
        if run:
            spans.add((i, run[0], run[1] - run[0], run[2]))
    return spans


def planted():
    rng = random.Random(11)
    texts = odd_texts(rng)
    passages = [words(rng, n) for n in (49, 50, 51, 120, 400)]
    for k in range(60):
        w = words(rng, rng.randint(0, 200))
        for p in rng.sample(passages, rng.randint(0, 3)):
            at = rng.randint(0, len(w))
            cut = rng.randint(0, 20)
            w = [*w[:at], *p[cut:], *w[at:]]
        if k % 7 == 0:
            w += w  # repeats inside one document
        texts.append((200 + k, " ".join(w)))
    return texts


@pytest.fixture(params=[suffixes.GROUP_ROWS, 5])
def group_rows(request, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP_ROWS", request.param)
    return request.param


def test_spans_match_brute_force(spark, group_rows):
    texts = planted()
    got = {tuple(r) for r in suffixes.repeated_spans(frame(spark, texts)).drop("digest").collect()}
    want = slow_spans(texts)
    assert got == want and len(want) > 30
    assert all(first <= i for i, _, _, first in got)


def test_cut_texts_keep_the_first_copy(spark):
    texts = planted()
    docs = frame(spark, texts)
    out = suffixes.without_repeats(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len(texts)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[6].text == dict(texts)[6] and by_id[7].text == "" and by_id[7].n_chars == 0
    assert by_id[1].text is None and by_id[1].n_chars is None and by_id[3].text == " \n\t "
    gone = {}
    for i, _, n, _ in slow_spans(texts):
        gone[i] = gone.get(i, 0) + n
    for i, t in texts:
        if i is not None and t is not None:
            assert len(by_id[i].text.split()) == len(t.split()) - gone.get(i, 0)
            assert by_id[i].n_chars == len(by_id[i].text)
            assert i in gone or by_id[i].text == t


def test_empty_table(spark):
    docs = frame(spark, [(1, "a")]).limit(0)
    assert suffixes.repeated_spans(docs).count() == suffixes.without_repeats(docs).count() == 0


def test_no_task_holds_all_copies_of_a_short_passage(spark, monkeypatch):
    rows, seen, by_windows = 20, {}, suffixes._by_windows

    def watched(contexts):
        seen.update({r["gram"]: r["count"] for r in contexts.groupBy("gram").count().collect()})
        return by_windows(contexts)

    monkeypatch.setattr(suffixes, "GROUP_ROWS", rows)
    monkeypatch.setattr(suffixes, "_by_windows", watched)
    rng = random.Random(3)
    licence = words(rng, 60)
    texts = [(k, " ".join(words(rng, 40) + licence + words(rng, 40))) for k in range(400)]
    got = {tuple(r) for r in suffixes.repeated_spans(frame(spark, texts)).drop("digest").collect()}
    assert got == slow_spans(texts) and len(got) == 399
    assert max(seen.values()) == 400 and min(seen.values()) > rows


def test_a_line_that_a_document_repeats_is_one_suffix(spark, monkeypatch):
    kept, sizes = suffixes.kept, {}

    def watched(df, name):
        out = kept(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(suffixes, "kept", watched)
    rng = random.Random(4)
    line = words(rng, 12)
    texts = [(k, " ".join(words(rng, 60) + line * 200 + words(rng, 60))) for k in range(30)]
    got = {tuple(r) for r in suffixes.repeated_spans(frame(spark, texts)).drop("digest").collect()}
    assert got == slow_spans(texts)
    assert sizes["suffixes"] > 30 * 180 and sizes["contexts"] < 30 * 40
