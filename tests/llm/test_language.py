from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import zstandard
from corpus import frame, odd_texts, words

from talkatlas.llm import language


VOCABULARY = {
    name: words(random.Random(name), 250, letters)
    for name, letters in {"aa": "abcdeio", "bb": "stuvwéü", "cc": "klmnopa"}.items()
}


def labelled(spark):
    rng = random.Random(4)
    texts, langs = odd_texts(rng), []
    langs = [None] * len(texts)
    for k in range(300):
        lang = rng.choice(["aa", "bb", "cc"])
        texts.append((100 + k, " ".join(rng.choices(VOCABULARY[lang], k=rng.randint(20, 200))).upper()))
        langs.append(lang)
    return texts, langs, frame(spark, texts, langs)


def test_held_out_accuracy_and_unknown(spark):
    texts, langs, docs = labelled(spark)
    rows = language.identify(docs).collect()
    assert len(rows) == len(texts)
    assert all(0 <= r.score <= 1 and r.lang_pred in ("aa", "bb", "cc", "und") for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    want = {i: lang for (i, _), lang in zip(texts, langs, strict=True)}
    unseen = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id >= 100]
    right = [r for r in unseen if r.lang_pred == want[r.doc_id]]
    assert len(unseen) > 40 and len(right) >= 0.95 * len(unseen)
    assert sum(r.rejected for r in right) <= 0.05 * len(unseen)
    assert all(r.rejected for r in unseen if r.lang_pred != want[r.doc_id])  # short texts that tie
    no_letter = {i for i, t in texts if not any(map(str.isalpha, t or ""))}
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == no_letter
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")


def test_held_out_labels_are_never_used(spark):
    _, _, docs = labelled(spark)
    hidden = docs.selectExpr(
        "doc_id", "text", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 'zz', lang) AS lang"
    )
    assert sorted(language.identify(docs).collect(), key=str) == sorted(language.identify(hidden).collect(), key=str)


def test_mixed_texts_have_narrow_margins(spark):
    _, _, docs = labelled(spark)
    judge = language.Judge(language.dictionaries(docs))
    rng = random.Random(8)
    half = " ".join(rng.choices(VOCABULARY["aa"], k=150) + rng.choices(VOCABULARY["bb"], k=150))
    pure = " ".join(rng.choices(VOCABULARY["aa"], k=300))
    assert judge(half)[2] < judge(pure)[2]
    assert judge(pure * 400)[0] == "aa"


def test_nothing_learned_and_empty_table(spark):
    _, _, docs = labelled(spark)
    blank = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in language.identify(blank).collect()} == {"und"}
    assert language.identify(docs.limit(0)).count() == 0


def plain_identify(rows, learned):
    """Every text with every dictionary, by a plain loop; ``learned`` has the text and language of the labelled rows."""

    def bare(text):
        return re.sub(r"[\W\d_]+", " ", text.lower()).encode()

    compress = {}
    for lang in sorted({lang for _, lang in learned}):
        words = Counter(w for text, x in learned if x == lang for w in bare(text).split())
        body = b" ".join(sorted(words, key=lambda w: (words[w], w)))
        held = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        options = zstandard.ZstdCompressionParameters.from_level(
            6, dict_size=len(body), window_log=max(12, (len(body) + 2048).bit_length()), write_content_size=False, write_dict_id=False
        )
        held.precompute_compress(compression_params=options)
        compress[lang] = zstandard.ZstdCompressor(dict_data=held, compression_params=options)
    found = {}
    for i, text in rows:
        sizes = []
        for lang, c in compress.items():
            data, total = bare(text or ""), 0
            while data:
                total, data = total + len(c.compress(data[:2048])), data[2048:]
            sizes.append((total, lang))
        sizes.sort()
        letter = any(map(str.isalpha, text or ""))
        found[i] = (sizes[0][1], round(1 - sizes[0][0] / sizes[1][0], 9)) if letter else ("und", 0.0)
    return found


def test_same_as_a_plain_loop(spark):
    texts, langs, docs = labelled(spark)
    learned = [
        (t, lang) for (i, t), lang in zip(texts, langs, strict=True) if lang and i is not None and zlib.crc32(str(i).encode()) % 4 != 2
    ]
    rows = [r for r in language.identify(docs).collect() if r.doc_id is not None]
    want = plain_identify([(i, t) for i, t in texts if i is not None], learned)
    once = [i for i, n in Counter(i for i, _ in texts).items() if n == 1 and i is not None]
    assert len(once) > 300
    got = {r.doc_id: (r.lang_pred, round(r.margin, 9)) for r in rows}
    assert {i: got[i] for i in once} == {i: want[i] for i in once}


def test_every_word_of_the_longest_text_is_learned(spark):
    first, last = ("zq" + "".join(random.Random(k).choices("abcd", k=9)) for k in (1, 2))
    long = f"{first} " + "common words of the text " * 200_000 + last
    docs = spark.createDataFrame([(1, long, "aa"), (3, "other words", "bb")], "doc_id long, text string, lang string")
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for i in (1, 3))
    body = language.dictionaries(docs)["aa"]
    assert first.encode() in body and last.encode() in body and len(body) < 100
