"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

Folding lower-cases, takes letters apart from their marks, drops marks and invisible
characters, replaces homoglyphs, and inside tokens that mix letters with digits or
signs also the digits and signs that stand for letters. Entries are whole
words or beginnings of words. The lexicon starts from a short list and learns
weights, log odds of toxic against other documents, from a bounded sample of
labelled documents. A document's score is the summed weight of its words over the
root of its length, calibrated on labels that the lexicon has not seen.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from math import sqrt

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.calibration import Calibration, calibrate, fold_of
from lexiloom.llm.sampling import least_by_hash
from lexiloom.llm.words import pieces
from lexiloom.session import stage

FOLDS = 4
HELD_OUT = 2
CALIBRATION = 1
# Labelled documents the lexicon is learned from at most, by hash order of the id.
SAMPLE = 40_000
ENTRIES = 5_000
BEGINNINGS = (4, 5, 6)
LEAST_DOCUMENTS = 4
LEAST_WEIGHT = 1.5
THRESHOLD = 0.3



def _ranges(points: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring numbers, first and last."""
    first = last = None
    for p in points:
        if last is not None and p == last + 1:
            last = p
            continue
        if first is not None:
            yield first, last
        first = last = p
    if first is not None:
        yield first, last


# Insults known beforehand, with a weight like a learned one.
KNOWN = {
    "idiot": 4.0, "moron": 4.0, "stupid": 3.0, "loser": 3.0, "pathetic": 3.0, "worthless": 3.0,
    "disgusting": 3.0, "scum": 4.0, "trash": 2.5, "clown": 2.0, "imbecile": 4.0, "dumbass": 4.5,
    "asshole": 4.5, "bastard": 4.0, "bitch": 4.5, "retard": 4.5, "filth": 3.0, "vermin": 3.5,
}
# Phrases in which such a word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "idiot proof", "sore loser", "rodeo clown")

# Letters that look like Latin ones and stay what they are when taken
# apart, by the letter they look like.
LOOKALIKES = {
    "a": "аɑα", "b": "вьɓβ", "c": "сϲᴄ", "d": "ԁɗđ", "e": "еєɛε", "f": "ƒ", "g": "ɡԍ", "h": "нһħ", "i": "іıιɩ", "j": "јϳ",
    "k": "кκ", "l": "ⅼӏłǀ", "m": "мᴍ", "n": "пηո", "o": "оοσøօ", "p": "рρþ", "q": "ԛ", "r": "гᴦ", "s": "ѕꜱ", "t": "тτŧ",
    "u": "υսʋ", "v": "νѵ", "w": "ωԝшɯ", "x": "хχ", "y": "уүγ", "z": "ᴢʐ",
}
HOMOGLYPHS = {look: letter for letter, looks in LOOKALIKES.items() for look in looks}
# Digits and signs that stand for letters.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

# 1 stands for i and for l, so these two are one letter in folded text.
_LETTERS = str.maketrans(HOMOGLYPHS | {look: "i" for look in (*LOOKALIKES["l"], "l")})
# Marks and invisible characters, which folding drops: the general categories say which.
_DROPPED = re.compile("[" + "".join(
    f"{chr(a)}-{chr(b)}" for a, b in _ranges(c for c in range(0x80, 0xF0000) if unicodedata.category(chr(c)) in ("Mn", "Me", "Cf"))
) + "]+")
_SIGNS = str.maketrans(DIGITS)
# Tokens with a digit or sign; begun at their first character and never given back,
# so that a token of any length is read once.
_MIXED = re.compile(r"(?<![a-z0-9@$])[a-z]*+[0-9@$][a-z0-9@$]*+")
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _spelled(match: re.Match) -> str:
    """Digits and signs up to the last letter as letters."""
    end = len(match[0].rstrip("0123456789@$"))
    return match[0][:end].translate(_SIGNS) + match[0][end:]


def fold(text: str) -> str:
    """Words of folded letters, each with one space before and after."""
    if not text.isascii():
        text = _DROPPED.sub("", unicodedata.normalize("NFKD", text))
    text = text.lower().translate(_LETTERS)
    text = _MIXED.sub(_spelled, text)
    return f" {_NOT_LETTERS.sub(' ', text).strip()} "


def entries_of(folded: str) -> set[str]:
    """Entries that match somewhere: ``" word "`` and ``" beginn"``."""
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in BEGINNINGS if len(word) > n)
    return found


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for text, label in zip(piece.column("text").to_pylist(), piece.column("label").to_pylist()):
            seen[label].update(entries_of(fold(text or "")))
        names = sorted(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([c[e] for e in names], pa.int64()) for c in seen)],
            ["entry", "other", "toxic"],
        )


def known_entries() -> dict[str, float]:
    return {fold(word): weight for word, weight in KNOWN.items()}


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Weights of entries from ``sample`` (text, label); at most ``ENTRIES`` learned."""
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = totals.get(1, 0), totals.get(0, 0)
    counts = (
        sample.mapInArrow(_count_entries, "entry string, other long, toxic long")
        .groupBy("entry")
        .agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    )
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1.0) * (other + 1.0) / (F.col("other") + 0.5))
    kept = (
        counts.filter(F.col("toxic") >= LEAST_DOCUMENTS)
        .withColumn("weight", weight)
        .filter(F.col("weight") >= LEAST_WEIGHT)
        .orderBy(F.desc(F.col("weight") * F.log1p("toxic")), "entry")
        .limit(ENTRIES)
    )
    return known_entries() | {r["entry"]: r["weight"] for r in kept.collect()}


class Matcher:
    """Sums the weights of a folded text's words, each by its heaviest entry."""

    def __init__(self, lexicon: dict[str, float]):
        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in EXCEPTIONS:
            folded = fold(phrase)
            self.automaton.add_word(folded, (len(folded), None))
        self.automaton.make_automaton()

    def rate(self, folded: str) -> float:
        heaviest: dict[int, float] = {}
        harmless: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                harmless.append((start, end))
            elif weight > heaviest.get(start, 0.0):
                heaviest[start] = weight
        for first, last in harmless:
            for start in [s for s in heaviest if first <= s < last]:
                del heaviest[start]
        return sum(heaviest.values()) / sqrt(folded.count(" ")) if heaviest else 0.0


def _rate(lexicon: dict[str, float], scores: Calibration | None = None):
    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for piece in pieces(batches, "text"):
            raw = [matcher.rate(fold(t)) if t else 0.0 for t in piece.column("text").to_pylist()]
            squeezed = pa.array([r / (1 + r) for r in raw], pa.float64())
            kept = [c for c in piece.schema.names if c != "text"]
            arrays = [piece.column(c) for c in kept]
            if scores:
                squeezed = pa.array(scores(squeezed.to_numpy()))
            yield pa.RecordBatch.from_arrays([*arrays, squeezed], [*kept, "score" if scores else "raw"])

    return rate


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Learns from rows of ``labels`` (doc_id, toxic) with a label whose fold is not
    ``HELD_OUT``, ``most`` of them for the lexicon and as many for the calibration,
    chosen by hash of the id; their ids are what is broadcast. Null and empty texts
    have no words and the score of texts without a match; a null id is in no fold;
    a repeated row is scored alike; without labels the known list alone rates and
    every score is one half. No rows give no rows.
    """
    fold_number = fold_of("doc_id", FOLDS)
    known = labels.filter("toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("label"))

    def sample(wanted) -> DataFrame:
        rows = known.filter(wanted).withColumn("digest", F.md5(F.col("doc_id").cast("string")))
        chosen = least_by_hash(rows, "digest", most, rows.count(), "doc_id", "label").drop("digest")
        return docs.select("doc_id", "text").join(F.broadcast(stage(chosen, "labels")), "doc_id").select("text", "label")

    lexicon = learn_lexicon(sample((fold_number != HELD_OUT) & (fold_number != CALIBRATION)))
    unseen = sample(fold_number == CALIBRATION).mapInArrow(_rate(lexicon), "label int, raw double")
    calibration = calibrate(stage(unseen, "toxic-rates"), 0.0, 1.0)
    ids = docs.schema["doc_id"].dataType.simpleString()
    rated = docs.select("doc_id", "text").mapInArrow(_rate(lexicon, calibration), f"doc_id {ids}, score double")
    return rated.select(
        "doc_id",
        F.coalesce(fold_number == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
