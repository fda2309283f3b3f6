"""Language ID against a plain version; no language is lost, whatever repeats."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.llm import language
from tests.llm.conftest import DOC

WORDS = {
    "de": "der die das und nicht ist ein zwischen schon würde größer immer haben worden gegen straße",
    "en": "the and that with which would through another there being house should water people",
    "es": "que los para como está también porque años cuando desde nosotros mañana señor donde",
}


def texts_of(lang, n, seed, size=40):
    maker = np.random.default_rng(seed)
    words = WORDS[lang].split()
    return [" ".join(maker.choice(words, size)) for _ in range(n)]


def plain_grams(text):
    """Grams of letters and single spaces, hashed one by one."""
    clean = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    found = Counter()
    for i, c in enumerate(clean):
        pair, triple = clean[i : i + 2], clean[i - 1 : i + 2]
        if len(pair) == 2 and pair.strip():
            found[sum(ord(x) * int(k) for x, k in zip(pair, language._K)) % 2**64 >> 64 - language.BITS] += 1
        if i and len(triple) == 3 and c != " ":
            found[sum(ord(x) * int(k) for x, k in zip(triple, language._K)) % 2**64 >> 64 - language.BITS] += 1
    return found


def plain_model(known):
    n = len([t for _, t in known if any(c.isalpha() for c in t)])
    having = Counter(g for _, t in known for g in plain_grams(t))
    weight = {g: math.log((1 + n) / (1 + having[g])) + 0.1 for g in range(language.GRAMS)}

    def vector(text):
        raw = {g: math.log1p(m) * weight[g] for g, m in plain_grams(text).items()}
        norm = math.sqrt(sum(v * v for v in raw.values())) or 1.0
        return {g: v / norm for g, v in raw.items()}

    return vector


def cosine(a, b):
    return sum(v * b.get(g, 0.0) for g, v in a.items())


def plain_centroids(vectors):
    """Spherical k-means from the vector nearest to the mean, then ever the farthest."""
    mean = Counter()
    for v in vectors:
        mean.update(v)
    chosen = [max(vectors, key=lambda v: cosine(v, mean))]
    while len(chosen) < min(language.CENTROIDS, len(vectors)):
        far = min(vectors, key=lambda v: max(cosine(v, c) for c in chosen))
        if max(cosine(far, c) for c in chosen) > 1 - 1e-6:
            break
        chosen.append(far)
    for _ in range(language.ROUNDS):
        owner = [max(range(len(chosen)), key=lambda c: cosine(v, chosen[c])) for v in vectors]
        for c in range(len(chosen)):
            total = Counter()
            for v, o in zip(vectors, owner):
                if o == c:
                    total.update(v)
            norm = math.sqrt(sum(x * x for x in total.values()))
            if norm:
                chosen[c] = {g: x / norm for g, x in total.items()}
    return chosen


def test_report_is_the_plain_one(spark):
    """Weights, vectors, centroids, choice and limits, on few texts."""
    known = [(lang, t) for k, lang in enumerate(WORDS) for t in texts_of(lang, 12, k, 30)]
    asked = [t for k, lang in enumerate(WORDS) for n in (2, 5, 40) for t in texts_of(lang, 3, 10 + k, n)]
    asked += ["zzq xkw vvp", "хорошо будет завтра", "x", "12 34", "", "Straße " * 20_000]
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    rows = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(known)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.predict_language(docs, rows).collect()}
    vector = plain_model(known)
    centroids = {lang: plain_centroids([vector(t) for one, t in known if one == lang]) for lang in WORDS}
    own = {lang: [] for lang in WORDS}
    for lang, t in known:
        for part in [t, *(language.beginning(t, n) for n in (5, *language.CLASSES[:-1]))]:
            size = sum(c.isalpha() for c in part)
            own[lang].append((sum(size >= n for n in language.CLASSES), max(cosine(vector(part), c) for c in centroids[lang])))
    for i, text in enumerate(asked):
        letters = sum(c.isalpha() for c in text)
        best, lang = max(((cosine(vector(text), c), lang) for lang in sorted(WORDS, reverse=True) for c in centroids[lang]), key=lambda x: x[0])
        if not letters:
            assert (got[i]._lang_pred, got[i]._score, got[i]._rejected) == ("und", 0.0, True)
            continue
        size = sum(letters >= n for n in language.CLASSES)
        near = [c for k, c in own[lang] if k == max(k for k, _ in own[lang] if k <= size)]
        limit = language.REJECT_SHARE * float(np.quantile(near, language.OWN_TEXTS))
        assert math.isclose(got[i]._score, best, abs_tol=1e-4)
        if best > 0.01:
            assert got[i]._lang_pred == lang
        if abs(best - limit) > 1e-3:
            assert got[i]._rejected == (best < limit)
    assert got[asked.index("хорошо будет завтра")]._rejected
    assert not any(got[i]._rejected for i in range(27))


@pytest.mark.parametrize("seed", range(6))
def test_no_language_is_forgotten(spark, seed):
    """One text of a language, thousands of times, beside many texts of others."""
    lone = texts_of("es", 1, 100 + seed)[0]
    rows = [(i, t, lang, "s", 1) for lang in ("de", "en") for i, t in enumerate(texts_of(lang, 30, seed))]
    known = spark.createDataFrame(rows, DOC).select("text", "lang")
    copies = spark.range(3000).select(F.lit(lone).alias("text"), F.lit("es").alias("lang"))
    table = known.unionByName(copies)
    drawn = language.sampled_texts(table, 20).collect()
    counts = Counter(r.lang for r in drawn)
    assert counts["es"] == 1 and counts["de"] == counts["en"] == 20
    asked = spark.createDataFrame([(1, texts_of("es", 1, 7)[0])], "doc_id long, text string")
    found = language.predict_language(asked, table.withColumn("doc_id", F.lit(1)), 20).first()
    assert found._lang_pred == "es" and not found._rejected


def test_sample_is_bounded_and_of_different_texts(spark):
    rows = [(t, "de") for t in texts_of("de", 400, 1)] + [(texts_of("en", 1, 1)[0], "en")] * 50 + [("12", "fr"), (None, "it")]
    drawn = language.sampled_texts(spark.createDataFrame(rows, "text string, lang string"), 25).collect()
    by_lang = Counter(r.lang for r in drawn)
    assert by_lang == {"de": 25, "en": 1} and len({r.text for r in drawn}) == 26
    assert sorted(r.place for r in drawn if r.lang == "de") == list(range(1, 26))


def test_long_texts_have_all_their_grams_and_no_others():
    text = " ".join(texts_of("de", 1, 3, 30_000)) + " " + "ä" * 200_000
    counts, letters = language.gram_counts([text])
    plain = plain_grams(text)
    assert letters[0] == sum(c.isalpha() for c in text)
    assert {g: int(n) for g, n in enumerate(counts[0]) if n} == dict(plain)
