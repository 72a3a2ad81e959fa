from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from corpus import frame, odd_texts, words

from talkatlas.llm import simhash
from talkatlas.llm.components import connected


def slow_fingerprint(text: str | None) -> int:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints: list[int]) -> list[int]:
    label = list(range(len(prints)))
    while True:
        new = [min(label[j] for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 4) for i in range(len(prints))]
        if new == label:
            return label
        label = new


def near_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(3)
    base = words(rng, 400)
    out = odd_texts(rng)
    for k in range(40):
        edited = list(base)
        for _ in range(rng.randint(0, 3)):
            edited[rng.randrange(len(edited))] = "edit"
        out.append((100 + k, " ".join(edited).upper() if k % 5 == 0 else " ".join(edited)))
    return out


def test_fingerprints_and_components_match_brute_force(spark):
    texts = near_texts()
    got = simhash.near_components(frame(spark, texts)).collect()
    assert len(got) == len(texts)
    prints = [slow_fingerprint(t) for _, t in texts]
    assert sorted(r.fingerprint for r in got) == sorted(f"{p:016x}" for p in prints)
    label = slow_components(prints)
    least: dict[int, int] = {}
    for (i, _), c in zip(texts, label, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted((str(i), least.get(c)) for (i, _), c in zip(texts, label, strict=True))
    assert sorted((str(r.doc_id), r.component_id) for r in got) == want
    assert len({r.component_id for r in got if r.doc_id and r.doc_id >= 100}) < 40


def test_crowded_cells_are_dealt_without_losing_links(spark):
    rng = np.random.default_rng(5)
    near = [0x0123456789ABCDEF]
    for _ in range(150):
        near.append(near[-1] ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    bits = [int(np.uint64(x).astype(np.int64)) for x in {*near, *rng.integers(0, 1 << 63, 200).tolist()}]
    prints = spark.createDataFrame([(b,) for b in bits], "bits long")

    def sets(links):
        rows = connected(links, "a", "b").collect()
        roots = {r.node: r.root for r in rows}
        return {b: roots.get(b, b) for b in bits}

    whole, dealt = sets(simhash.near_links(prints)), sets(simhash.near_links(prints, cell_rows=3))
    label = slow_components([b & (1 << 64) - 1 for b in bits])
    groups = {}
    for b, c in zip(bits, label, strict=True):
        groups.setdefault(c, []).append(b)
    assert whole == dealt == {b: min(g) for g in groups.values() for b in g}


def test_one_document_of_each_group_stays(spark):
    docs = frame(spark, near_texts())
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 6 in ids and 7 not in ids and ids.count(9) == 2 and ids.count(None) == 2


def test_empty_table(spark):
    docs = frame(spark, [(1, "a")]).limit(0)
    assert simhash.near_components(docs).count() == simhash.one_of_each(docs).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + k) for k in range(1, 300)]
    links = spark.createDataFrame([*path, *star, (5, 5), (None, 3)], "a long, b long")
    roots = {r.node: r.root for r in connected(links, "a", "b").collect()}
    assert roots == {**{i: 0 for i in range(61)}, **{1000 + k: 1000 for k in range(300)}}
