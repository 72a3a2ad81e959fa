from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus import frame, odd_texts, words
from hypothesis import given, settings
from hypothesis import strategies as st

from talkatlas.llm import quality


def labelled(spark):
    rng = random.Random(2)
    texts, labels = odd_texts(rng), [(None, 1, 0, "y"), (999999, 0, 0, "y"), (4, None, 0, "y"), (5, 7, 0, "y")]
    for k in range(400):
        good = rng.random() < 0.7
        w = words(rng, rng.randint(5, 80))
        texts.append((100 + k, " ".join(w).capitalize() + "." if good else " ".join(x.upper() + "%%" for x in w)))
        labels.append((100 + k, int(good), 0, "y"))
    return texts, frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_held_out_accuracy_and_defined_scores(spark):
    texts, docs, labels = labelled(spark)
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == len(texts)
    want = {r.doc_id: r.quality for r in labels.collect()}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    unseen = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id >= 100]
    assert sum(r.predicted == want[r.doc_id] for r in unseen) / len(unseen) > 0.95
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1  # NULL and empty texts


def test_held_out_labels_are_never_used(spark):
    _, docs, labels = labelled(spark)
    flipped = labels.selectExpr(
        "doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - quality, quality) AS quality"
    )
    a = sorted(quality.quality_scores(docs, labels).collect(), key=str)
    assert a == sorted(quality.quality_scores(docs, flipped).collect(), key=str)


def test_accepted_keeps_clean_documents(spark):
    _, docs, labels = labelled(spark)
    out = quality.accepted(docs, labels)
    assert out.columns == docs.columns
    left = {r.doc_id for r in out.collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()} - {None}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(good - left) <= 0.03 * len(good) and len(bad & left) <= 0.1 * len(bad) and None in left


def test_without_labels_and_without_rows(spark):
    _, docs, labels = labelled(spark)
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(docs.limit(0), labels).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 10), st.integers(1, 5)), min_size=1, max_size=12, unique_by=lambda x: x[0]))
def test_isotonic_is_the_best_rising_fit(points):
    x, y, w = (np.array(c, float) for c in zip(*sorted(points), strict=True))
    knots, values = quality.isotonic(x, y, w)
    assert (np.diff(values) > -1e-9).all() and (np.diff(knots) > 0).all()
    # min-max formula of the isotonic fit
    mean = lambda i, j: np.average(y[i : j + 1], weights=w[i : j + 1])
    n = len(x)
    best = [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]
    assert np.isclose(sorted(set(np.round(best, 9))), sorted(set(np.round(values, 9)))).all()


def test_statistics_see_the_whole_text():
    data = np.frombuffer(("good words here. " * 4000 + "!" * 4000).encode(), np.uint8)
    stats = quality.statistics(data, np.array([0, len(data)]))
    assert stats[0, 8] == pytest.approx(4000 / len(data))


def slow_statistics(text: str) -> list[float]:
    """The statistics of one text, counted one by one."""
    data = text.encode()
    kinds = [range(97, 123), range(65, 91), range(48, 58), b" ", b"\n", b"\t\r\x0b\x0c", b".", b",", b"!?", b"|", b"'\"-:;()", b"#$%&*+/<=>@[\\]^_`{}~", range(128, 256)]
    shares = [sum(b in kind for b in data) for kind in kinds]
    shares.append(len(data) - sum(shares))
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    sizes = [len(w) for w in words] or [0]
    lines = [x for x in re.findall(rb"[^\n]*\n|[^\n]+$", data)]
    n, m = max(1, len(words)), max(1, len(lines))
    most = lambda items: max(Counter(items).values(), default=0)
    plain = re.compile(rb"[a-zA-Z0-9.,\x80-\xff]")
    upper, lower = range(65, 91), range(97, 123)
    return [x / max(1, len(data)) for x in shares] + [
        np.log1p(len(data)), np.log1p(len(words)), np.mean(sizes), np.log1p(np.mean(sizes)), np.std(sizes), len({*words}) / n, most(words) / n,
        len({*zip(words, words[1:], strict=False)}) / max(1, len(words) - 1), np.log1p(len(lines)), np.log1p(len(data) / m), len({*lines}) / m, most(lines) / m,
        sum(not plain.match(w[-1:]) for w in words) / n, sum(w[0] in upper and w[min(1, len(w) - 1)] in upper for w in words) / n,
        sum(w[0] in upper and w[min(1, len(w) - 1)] in lower for w in words) / n, sum(len(w) == 1 for w in words) / n, sum(len(w) > 15 for w in words) / n,
    ]


def test_statistics_match_plain_counting():
    rng = random.Random(11)
    some = ["", "a", "\n\n", "One line.\nOne line.\nTWO |x| 3\t!?\r\n", "é" * 30 + " ü", "A B c 1 # $ " + "w" * 20, "end\x00 \x0b x"]
    some += ["".join(rng.choices("abC D.\n1|é#", k=rng.randint(1, 300))) for _ in range(40)]
    data = [t.encode() for t in some]
    offsets = np.cumsum([0, *map(len, data)])
    got = quality.statistics(np.frombuffer(b"".join(data), np.uint8), offsets)
    assert np.allclose(got, [slow_statistics(t) for t in some])


def test_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(0)
    d, n = 12, 4000
    fourier = quality.Fourier(np.zeros(d), np.ones(d), rng.normal(size=(d, n)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, n))
    x = rng.normal(size=(30, d))
    z = fourier(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * d))
    assert np.abs(z @ z.T - kernel).max() < 0.08


def test_scores_match_a_dense_fit(spark):
    """All rows in one matrix, least squares over stacked penalty rows, and the min-max formula of the isotonic fit."""
    _, docs, labels = labelled(spark)
    stats = quality.document_statistics(docs).distinct()
    fold = "CAST(pmod(xxhash64(doc_id, 'fold'), 5) AS INT) AS fold"
    rows = stats.where("doc_id >= 100").selectExpr("doc_id", "stats", fold).orderBy("doc_id").collect()
    label = {r.doc_id: r.quality for r in labels.where("quality IN (0, 1)").collect()}
    train = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5]
    x, y = np.array([r.stats for r in train], float), np.array([label[r.doc_id] for r in train], float)
    folds = np.array([r.fold for r in train])
    scale = x.std(axis=0)
    rng = np.random.default_rng(quality.SEED)
    waves = rng.normal(size=(x.shape[1], 300)) / np.sqrt(x.shape[1])
    fourier = quality.Fourier(x.mean(axis=0), np.where(scale < 1e-6, 1, scale), waves, rng.uniform(0, 2 * np.pi, 300))
    z = fourier(x)

    def ridge(own, penalty):
        root = np.sqrt(np.append(np.full(300, penalty * own.sum()), 1e-9))
        return np.linalg.lstsq(np.concatenate([z[own], np.diag(root)]), np.concatenate([y[own], np.zeros(301)]), rcond=None)[0]

    tried = []
    for penalty in quality.RIDGES:
        unseen = np.zeros(len(y))
        for k in range(5):
            unseen[folds == k] = z[folds == k] @ ridge(folds != k, penalty)
        tried.append((((unseen - y) ** 2).sum(), penalty, unseen))
    _, penalty, unseen = min(tried, key=lambda t: t[0])
    bins = np.floor(np.clip(unseen, -1, 2) * quality.BINS)
    groups = [bins == b for b in np.unique(bins)]
    at, mean, n = (np.array(c) for c in zip(*[(unseen[g].mean(), y[g].mean(), g.sum()) for g in groups], strict=True))
    level = [max(min(np.average(mean[i : j + 1], weights=n[i : j + 1]) for j in range(k, len(n))) for i in range(k + 1)) for k in range(len(n))]
    pools = [np.isclose(level, v) for v in sorted({round(v, 9) for v in level})]
    knots = [np.average(at[p], weights=n[p]) for p in pools]
    values = [np.average(mean[p], weights=n[p]) for p in pools]
    everything = fourier(np.array([r.stats for r in rows], float)) @ ridge(np.ones(len(y), bool), penalty)
    want = dict(zip([r.doc_id for r in rows], np.clip(np.interp(everything, knots, values), 0, 1), strict=True))
    # the odd texts have no usable label, so the fit is that of the rows above
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect() if r.doc_id in want}
    assert max(abs(got[i] - want[i]) for i in want) < 1e-4 and len(want) == 400
