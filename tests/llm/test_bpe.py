from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
from corpus import frame, odd_texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from talkatlas.llm import bpe
from talkatlas.llm.registry import BYTE_BPE

PATH = public_tokenizers.path(BYTE_BPE)
LIB = Tokenizer.from_file(PATH)
OWN = bpe.ByteBpe(PATH)


def test_ids_and_decoded_texts_match_the_library(spark):
    texts = odd_texts(random.Random(6)) + [(20, "  it's  a\n\n\ttest 12345 " + "ab" * 3000), (21, "\x00\x1c\x85　 z"), (22, "a" * 20000)]
    rows = bpe.encoded(frame(spark, texts), PATH).collect()
    assert len(rows) == len(texts)
    want = {}
    for i, t in texts:
        ids = LIB.encode(t or "", add_special_tokens=False).ids
        decoded = LIB.decode(ids, skip_special_tokens=False)
        want.setdefault((i, t or ""), (ids, decoded))
    for r in rows:
        ids, decoded = want[(r.doc_id, r.decoded)]
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text_matches_the_library(texts):
    for text, ids in zip(texts, OWN.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == LIB.encode(text, add_special_tokens=False).ids
        assert OWN.decode(np.frombuffer(ids, "<u4")) == text


def test_merge_rounds_follow_ranks_on_random_words():
    rng = random.Random(3)
    words = [bytes(rng.choice(b"abthe in\xc3\xa9") for _ in range(rng.randint(1, 30))) for _ in range(500)]
    rank = {(int(p >> 20), int(p & (1 << 20) - 1)): (int(r), int(OWN.merged[r])) for p, r in zip(OWN.pair, OWN.rank, strict=True)}
    for word, ids in zip(words, OWN.merge(words), strict=True):
        s = [int(OWN.of_byte[b]) for b in word]
        while True:
            pairs = [(rank[p][0], p) for p in zip(s, s[1:]) if p in rank]
            if not pairs:
                break
            best, out, i = min(pairs)[1], [], 0
            while i < len(s):
                hit = i + 1 < len(s) and (s[i], s[i + 1]) == best
                out.append(rank[best][1] if hit else s[i])
                i += 2 if hit else 1
            s = out
        assert ids.tolist() == s


def test_empty_table(spark):
    assert bpe.encoded(frame(spark, [(1, "a")]).limit(0), PATH).count() == 0
