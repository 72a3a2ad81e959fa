from __future__ import annotations

import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from corpus import frame, words
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Documents and labels with bad texts, copies, boilerplate lines and shared passages."""
    folder = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(21)
    lines = ["All rights are kept here.", "Sign up for more of this"]
    passage = " ".join(words(rng, 70))
    texts, labels, sources = [], [], []
    for k in range(160):
        bad = k % 5 == 0
        w = words(rng, rng.randint(30, 150))
        text = " ".join(x.upper() + "%%" for x in w) if bad else " ".join(w) + "."
        if not bad and k % 9 == 1:
            text += " " + passage
        if not bad and k % 2:
            text = f"{lines[0]}\n{text}\n{lines[1]}"
        texts.append((k, text))
        sources.append(f"site{k % 13}")
        labels.append((k, int(not bad), 0))
    for k in range(12):  # copies of documents 2 and 3
        texts.append((500 + k, texts[2 + k % 2][1] + (" end" if k > 5 else "")))
        sources.append(f"site{k}")
    texts += [(900, None), (901, "")]
    sources += ["site1", None]
    frame(spark, texts, sources=sources).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, dict(texts)


def test_stages_take_effect(spark, small):
    folder, texts = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, folder)
        assert docs.columns == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = before, {r.doc_id: r.text for r in docs.collect()}
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in docs.collect())
    before, after = seen["quality classifier"]
    assert not any("%%" in (t or "") for t in after.values()) and len(after) >= 0.98 * sum("%%" not in (t or "") for t in before.values())
    before, after = seen["line dedup"]
    assert after.keys() == before.keys() and sum("All rights" in (t or "") for t in after.values()) == 1
    before, after = seen["SimHash near-dedup"]
    assert not any(500 <= i < 512 for i in after) and {2, 3} <= after.keys()
    before, after = seen["suffix-array dedup"]
    assert after.keys() == before.keys()
    tail = " ".join(texts[28].split()[-70:])
    assert sum(tail in (t or "") for t in before.values()) > 5 and sum(tail in (t or "") for t in after.values()) == 1
    name, stage = corpus_pipeline.STAGES[-1]
    check_packed(stage(spark, docs, folder).collect(), after)


def check_packed(rows, texts):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, t in texts.items():
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            want[(i, k)] = zlib.crc32(ids[at : at + 2048].tobytes())
    assert {(r.doc_id, r.piece): r.ids_crc32 for r in rows} == want and len(rows) == len(want)


def test_run_equals_the_stages_one_by_one(spark, small):
    folder, _ = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        docs = spark.createDataFrame(out.collect(), out.schema)
    check_packed(corpus_pipeline.run(spark, folder).collect(), {r.doc_id: r.text for r in docs.collect()})
