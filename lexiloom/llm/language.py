"""Language ID by nearest centroid.

A text becomes the normalised TF-IDF vector of its hashed two- and three-letter
grams. Every language has a few centroids, from spherical k-means over a bounded
sample of its labelled texts; a text gets the language of the centroid with the
largest cosine. A text further from all centroids than texts of that language and of
about its length are from theirs is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.calibration import fold_of
from lexiloom.llm.words import longs, pieces, set_aside
from lexiloom.session import stage

FOLDS = 3
HELD_OUT = 1
BITS = 12
GRAMS = 1 << BITS
CENTROIDS = 4
ROUNDS = 8
# Different labelled texts a language is learned from at most, those of least hashes.
SAMPLE = 1_500
# A text is rejected below this share of the cosine that all but one in a hundred of
# the language's own texts of its class of length reach.
REJECT_SHARE = 0.5
OWN_TEXTS = 0.01
# Letters from which on a text is in the next class of length. What own short texts
# reach is seen on beginnings, of these many letters or a few, of sampled texts.
CLASSES = (8, 16, 32, 64, 128)
# Fewer texts in a class cannot tell what texts of the language reach.
LEAST_OWN = 10
BEGINNINGS = 300
UNKNOWN = "und"
# Texts whose vectors are in memory at a time, and their characters.
TEXTS = 128
CHARACTERS = 1 << 16

_SPACE = 32
_NO_LETTER = re.compile(r"[\W\d_]")
_LETTER = np.array([chr(c).isalpha() for c in range(0x10000)])
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _is_letter(points: np.ndarray) -> np.ndarray:
    marked = _LETTER[np.minimum(points, 0xFFFF)]
    for c in np.unique(points[points > 0xFFFF]):
        marked[points == c] = chr(c).isalpha()
    return marked


def _gram_counts(part: str) -> tuple[np.ndarray, int]:
    points = np.frombuffer(part.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter(points)
    if not letter.any():
        return np.zeros(GRAMS), 0
    clean = np.concatenate([[_SPACE], np.where(letter, points, _SPACE), [_SPACE]]).astype(np.uint64)
    inside = np.concatenate([[False], letter, [False]])
    two = (clean[:-1] * _K[0] + clean[1:] * _K[1]) >> np.uint64(64 - BITS)
    three = (clean[:-2] * _K[0] + clean[1:-1] * _K[1] + clean[2:] * _K[2]) >> np.uint64(64 - BITS)
    counts = np.bincount(two[inside[:-1] | inside[1:]].astype(np.int64), minlength=GRAMS)
    counts += np.bincount(three[inside[1:-1]].astype(np.int64), minlength=GRAMS)
    return counts.astype(float), int(letter.sum())


def _parts(text: str) -> Iterator[str]:
    """A long text cut before characters that are no letters, where no gram is cut."""
    at = 0
    while len(text) - at > CHARACTERS:
        end = _NO_LETTER.search(text, at + CHARACTERS)
        if not end:
            break
        yield text[at : end.start()]
        at = end.start()
    yield text[at:]


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """How often each hashed gram is in each text, and how many letters it has.

    Anything but a letter is a space, and grams of spaces do not count.
    """
    counts = np.zeros((len(texts), GRAMS))
    letters = np.zeros(len(texts), np.int64)
    for row, text in enumerate(texts):
        for part in _parts(text or ""):
            found, many = _gram_counts(part)
            counts[row] += found
            letters[row] += many
    return counts, letters


def length_class(letters: np.ndarray) -> np.ndarray:
    return np.searchsorted(CLASSES, letters, side="right")


def beginning(text: str, letters: int) -> str:
    """The first so many letters of a text, and what lies between them."""
    found = 0
    for at, c in enumerate(text):
        found += c.isalpha()
        if found == letters:
            return text[: at + 1]
    return text


def vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Unit vectors of damped counts times gram weights; zeros stay zeros."""
    out = (np.log1p(counts) * weights).astype(np.float32)
    norm = np.sqrt(np.einsum("ij,ij->i", out, out))
    return out / np.where(norm > 0, norm, 1)[:, None]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        for at in range(0, piece.num_rows, TEXTS):
            yield piece.slice(at, TEXTS)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    having, n = np.zeros(GRAMS, np.int64), 0
    for part in _slices(batches):
        counts, letters = gram_counts(part.column("text").to_pylist())
        having += (counts > 0).sum(axis=0)
        n += int((letters > 0).sum())
    yield pa.RecordBatch.from_arrays(
        [longs(np.arange(-1, GRAMS)), longs(np.concatenate([[n], having]))], ["gram", "n"]
    )


def gram_weights(texts: DataFrame) -> np.ndarray:
    """Inverse document frequencies over all ``texts``; a fixed number of sums."""
    sums = texts.select("text").mapInArrow(_document_frequencies, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    having = np.zeros(GRAMS + 1)
    for row in sums.collect():
        having[row["gram"] + 1] = row["n"]
    return np.log((1 + having[0]) / (1 + having[1:])) + 0.1


def _vector_rows(weights: np.ndarray):
    """Vectors of sampled texts, and of beginnings of some of them, with their class of length."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            texts, langs = part.column("text").to_pylist(), part.column("lang").to_pylist()
            for size in (None, 5, *CLASSES[:-1]):
                if size is None:
                    rows = list(zip(langs, texts))
                else:
                    few = zip(langs, texts, part.column("place").to_pylist())
                    rows = [(lang, beginning(text, size)) for lang, text, place in few if place <= BEGINNINGS]
                counts, letters = gram_counts([text for _, text in rows])
                made = pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang for lang, _ in rows], pa.string()),
                        pa.array([v.tobytes() for v in vectors(counts, weights)], pa.binary()),
                        pa.array(length_class(letters).astype(np.int32)),
                        pa.array([size is None] * len(rows), pa.bool_()),
                    ],
                    ["lang", "vector", "length", "whole"],
                )
                yield made.filter(pa.array(letters > 0))

    return make


def spherical_k_means(rows: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """``k`` unit centroids, or fewer; the start takes the row farthest from those
    chosen, so equal rows make one centroid."""
    centroids = [rows.mean(axis=0)]
    nearest = rows @ centroids[0] / max(np.linalg.norm(centroids[0]), 1e-9)
    centroids = []
    while len(centroids) < min(k, len(rows)):
        far = int(np.argmin(nearest)) if centroids else int(np.argmax(nearest))
        if centroids and nearest[far] > 1 - 1e-6:
            break
        centroids.append(rows[far])
        nearest = np.max(rows @ np.stack(centroids).T, axis=1)
    chosen = np.stack(centroids)
    for _ in range(rounds):
        owner = np.argmax(rows @ chosen.T, axis=1)
        for c in range(len(chosen)):
            mine = rows[owner == c]
            if len(mine):
                total = mine.sum(axis=0)
                chosen[c] = total / max(float(np.linalg.norm(total)), 1e-9)
    return chosen


def least_cosines(best: np.ndarray, classes: np.ndarray, share: float, own: float) -> list[float]:
    """The cosine below which a text is rejected, for each class of length.

    Classes of fewer than ``LEAST_OWN`` texts take the limit of the next shorter one
    that has them, as longer texts only come nearer to their centroids; if there is
    none, no text is too far.
    """
    out, last = [], 0.0
    for c in range(len(CLASSES) + 1):
        mine = best[classes == c]
        if len(mine) >= LEAST_OWN:
            last = share * float(np.quantile(mine, own))
        out.append(last)
    return out


def _learn(k: int, rounds: int, share: float, own: float):
    def learn(table: pa.Table) -> pa.Table:
        # Sorted: whatever order they come in.
        found = sorted(zip(table.column("vector").to_pylist(), table.column("length").to_pylist(), table.column("whole").to_pylist()))
        rows = np.stack([np.frombuffer(v, np.float32) for v, _, _ in found])
        classes, whole = np.array([c for _, c, _ in found]), np.array([w for _, _, w in found])
        chosen = spherical_k_means(rows[whole], k, rounds)
        least = least_cosines(np.max(rows @ chosen.T, axis=1), classes, share, own)
        n = len(chosen)
        return pa.table(
            {
                "lang": pa.array([table.column("lang")[0].as_py()] * n, pa.string()),
                "vector": pa.array([c.tobytes() for c in chosen], pa.binary()),
                "least": pa.array([least] * n, pa.list_(pa.float64())),
            }
        )

    return learn


def sampled_texts(known: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, text, place): at most ``sample`` different texts of each language that
    have a letter, those of least hashes, numbered from 1; of each language with
    such a text at least one.

    Copies are folded, so they neither fill a sample nor decide by chance whether
    their language is in it. Hashes are spread evenly, so a bound on them that about
    ``sample`` texts pass is known from how many different ones there are; only
    those under it, or the least one, come together.
    """
    hashed = known.filter(F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text").alias("hash"))
    # A row per language, read back from a table: Spark knows its size then, and
    # broadcasts it below its threshold.
    of = F.approx_count_distinct("hash", 0.02).alias("texts"), F.min("hash").alias("least")
    totals = stage(hashed.groupBy("lang").agg(*of), "languages")
    share = (sample * 1.1 + 10 * sample**0.5 + 20) / F.col("texts")
    low = (F.col("hash").cast("double") / 2.0**63 + 1) / 2 < share
    under = hashed.join(totals, "lang").filter(low | (F.col("hash") == F.col("least")))
    folded = under.groupBy("lang", "hash").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    return folded.withColumn("place", place).filter(F.col("place") <= sample).select("lang", "text", "place")


def learn_centroids(known: DataFrame, weights: np.ndarray, sample: int = SAMPLE) -> list:
    """Centroids (lang, vector, least) from ``known`` (text, lang); ``least`` by class of length.

    A language's vectors fit into one task and the model onto the driver.
    """
    shape = "lang string, vector binary, length int, whole boolean"
    rows = sampled_texts(known, sample).mapInArrow(_vector_rows(weights), shape)
    learnt = rows.groupBy("lang").applyInArrow(
        _learn(CENTROIDS, ROUNDS, REJECT_SHARE, OWN_TEXTS), "lang string, vector binary, least array<double>"
    )
    return learnt.orderBy("lang", "vector").collect()


def _predict(weights: np.ndarray, model: list):
    langs = np.array([m["lang"] for m in model], object)
    least = np.array([m["least"] for m in model]).reshape(len(model), len(CLASSES) + 1)
    centroids = np.stack([np.frombuffer(m["vector"], np.float32) for m in model]) if model else np.zeros((0, GRAMS), np.float32)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            counts, letters = gram_counts(part.column("text").to_pylist())
            lettered = letters > 0
            best, lang, far = np.zeros(part.num_rows), np.full(part.num_rows, UNKNOWN, object), np.ones(part.num_rows, bool)
            if len(model):
                cosines = vectors(counts, weights) @ centroids.T
                place = np.argmax(cosines, axis=1)
                best = np.clip(cosines[np.arange(part.num_rows), place].astype(float), 0, 1) * lettered
                lang = np.where(lettered, langs[place], UNKNOWN)
                far = ~lettered | (best < least[place, length_class(letters)])
            columns = {name: part.column(name) for name in part.schema.names}
            columns |= {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(best), "rejected": pa.array(far)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return predict


RESULTS = ("lang_pred", "score", "rejected")


def predict_language(docs: DataFrame, known: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Every column of ``docs`` and ``_lang_pred``, ``_score``, ``_rejected``; columns
    that have these names already are replaced.

    ``known`` (doc_id, text, lang) is what is learned from; rows without a language
    are left out. A text that is null or has no letter is ``und`` with score 0 and
    rejected, and so is every text when nothing is known. Every language with a text
    that has a letter can be predicted, however often its or other texts repeat. A
    repeated row is predicted alike; ties go to the first language in order; a text
    of any length is read as a whole, in parts. No rows give no rows.
    """
    renamed, back = set_aside(docs.drop(*(f"_{c}" for c in RESULTS)))
    found = _with_prediction(renamed, known, sample)
    return found.select(*back, *(F.col(c).alias(f"_{c}") for c in RESULTS))


def _with_prediction(renamed: DataFrame, known: DataFrame, sample: int) -> DataFrame:
    known = known.select("doc_id", "text", "lang").filter("lang IS NOT NULL")
    weights = gram_weights(known)
    model = learn_centroids(known, weights, sample)
    shape = renamed.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")).schema
    return renamed.mapInArrow(_predict(weights, model), shape)


def learnable(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` outside the held-out fold; a null id is in no fold."""
    return docs.filter(F.coalesce(fold_of("doc_id", FOLDS) != HELD_OUT, F.lit(False)))


def language_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    rows = docs.select("doc_id", "text")
    found = predict_language(rows, learnable(docs))
    return found.select(
        "doc_id",
        F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("_lang_pred").alias("lang_pred"),
        F.col("_score").alias("score"),
        F.col("_rejected").alias("rejected"),
    )


def with_known_language(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` without those that the distance rejects.

    Null texts and texts without a letter go too; repeated rows stay or go alike;
    columns of any name are kept. Without any labelled text every row goes, without
    rows there is nothing to keep.
    """
    renamed, back = set_aside(docs)
    return _with_prediction(renamed, learnable(docs), SAMPLE).filter("NOT rejected").select(*back)
