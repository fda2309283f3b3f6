"""Translation engines: how a list of texts becomes a list of translations.

An engine turns an ``array<string>`` column into
``struct<texts array<string>, error string>``. NULL texts stay NULL. ``error``
is NULL for a row that went well; ``texts`` is NULL for one that did not.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = T.StructType().add("texts", T.ArrayType(T.StringType())).add("error", T.StringType())
# With a clock: when the row was taken up and left, and the wait since the row before.
TIMED = T.StructType([*RESULT.fields]).add("started", "double").add("ended", "double").add("waited", "double")

# A literal map is searched entry by entry, so larger ones go to Python instead.
LITERAL_GLOSSARY = 256


class Translator(Protocol):
    def translate(self, texts: list[str]) -> list[str]: ...


class Engine(Protocol):
    def __call__(self, texts: Column) -> Column: ...


class RowRejected(ValueError):
    """A translator cannot take this text. Never retried."""


class GaveUp(RuntimeError):
    """Every attempt failed. Stops the job, whatever the row policy."""


class Glossary:
    """Each space-separated word through a fixed map, as a native expression while
    the map is small; the same answers either way. For a map that is a table, see
    ``translation.translate_by_glossary_table``."""

    def __init__(self, words: Mapping[str, str]):
        if not words:
            raise ValueError("a glossary has at least one word")
        self.words = dict(words)

    def text(self, text: Column) -> Column:
        if len(self.words) > LITERAL_GLOSSARY:
            return F.get(self(F.array(text))["texts"], F.lit(0))
        table = F.create_map(*[F.lit(part) for pair in self.words.items() for part in pair])
        return F.array_join(
            F.transform(F.split(text, " "), lambda w: F.coalesce(F.try_element_at(table, w), w)), " "
        )

    def __call__(self, texts: Column) -> Column:
        if len(self.words) > LITERAL_GLOSSARY:
            words = self.words
            return TranslatorEngine(lambda: WordSwap(words))(texts)
        return F.struct(
            F.transform(texts, self.text).alias("texts"), F.lit(None).cast("string").alias("error")
        )


class WordSwap:
    """The glossary as a plain Python translator, with an optional length limit."""

    def __init__(self, words: Mapping[str, str], max_words: int | None = None):
        self.words = dict(words)
        self.max_words = max_words

    def translate(self, texts: list[str]) -> list[str]:
        return [self._one(text) for text in texts]

    def _one(self, text: str) -> str:
        tokens = text.split(" ")
        if self.max_words is not None and len(tokens) > self.max_words:
            raise RowRejected(f"more than {self.max_words} words")
        return " ".join(self.words.get(token, token) for token in tokens)


class Retrying:
    """Repeats a failing call with doubling pauses, then gives up."""

    def __init__(
        self,
        inner: Translator,
        attempts: int = 3,
        first_delay: float = 1.0,
        sleep: Callable[[float], None] = time.sleep,
    ):
        self.inner = inner
        self.attempts = max(1, attempts)
        self.first_delay = first_delay
        self.sleep = sleep

    def translate(self, texts: list[str]) -> list[str]:
        failure: Exception | None = None
        for attempt in range(self.attempts):
            if attempt:
                self.sleep(self.first_delay * 2 ** (attempt - 1))
            try:
                return self.inner.translate(texts)
            except RowRejected:
                raise
            except Exception as exc:
                failure = exc
        raise GaveUp(f"{self.attempts} attempts failed, the last with {failure!r}") from failure


def _translate_texts(
    translator: Translator, texts: list[str], call_size: int, isolate: bool
) -> tuple[dict[str, str], dict[str, str]]:
    """Translations and errors by text. A failing call is redone text by text."""
    done: dict[str, str] = {}
    failed: dict[str, str] = {}
    for start in range(0, len(texts), call_size):
        part = texts[start : start + call_size]
        try:
            done.update(zip(part, translator.translate(part), strict=True))
        except GaveUp:
            raise
        except Exception:
            if not isolate:
                raise
            for text in part:
                try:
                    (done[text],) = translator.translate([text])
                except GaveUp:
                    raise
                except Exception as exc:
                    failed[text] = f"{type(exc).__name__}: {exc}"
    return done, failed


class TranslatorEngine:
    """Outside engine: a ``Translator`` built once per partition.

    Texts cross to Python in Arrow batches, each distinct text of a batch once.
    ``on_error="fail"`` stops the job at the first error; ``"quarantine"``
    reports it in ``error`` for the rows concerned and goes on. Spark may run a
    task again, so a translator must give the same answer when asked twice.

    With a ``clock`` (of the translator, in seconds; ``wall_clock``) each row is a
    call of its own, and the result also tells when it began and ended.
    """

    def __init__(
        self,
        factory: Callable[[], Translator],
        on_error: str = "fail",
        call_size: int = 256,
        clock: Callable[[Translator], float] | None = None,
    ):
        if on_error not in ("fail", "quarantine"):
            raise ValueError("on_error is 'fail' or 'quarantine'")
        self.factory = factory
        self.isolate = on_error == "quarantine"
        self.call_size = call_size
        self.clock = clock

    def __call__(self, texts: Column) -> Column:
        factory, isolate, call_size = self.factory, self.isolate, self.call_size
        if self.clock:
            return _timed(factory, isolate, call_size, self.clock).asNondeterministic()(texts)

        @F.pandas_udf(RESULT)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            translator = factory()
            for rows in batches:
                wanted = dict.fromkeys(
                    text for row in rows if row is not None for text in row if text is not None
                )
                done, failed = _translate_texts(translator, list(wanted), call_size, isolate)
                yield _collect(rows, done, failed)

        # Spark may copy a deterministic function into filters; this one is costly.
        return run.asNondeterministic()(texts)


def wall_clock(translator: Translator) -> float:
    return time.time()


def _timed(factory: Callable[[], Translator], isolate: bool, call_size: int, clock: Callable[[Translator], float]):
    """Row by row, with the times; the wait is counted inside a partition."""

    @F.pandas_udf(TIMED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        translator, last = factory(), None
        for rows in batches:
            told, times = [], []
            for row in rows:
                started = clock(translator)
                wanted = dict.fromkeys(text for text in (row if row is not None else ()) if text is not None)
                done, failed = _translate_texts(translator, list(wanted), call_size, isolate)
                ended = clock(translator)
                told.append(_collect([row], done, failed))
                times.append((started, ended, 0.0 if last is None else started - last))
                last = ended
            columns = pd.DataFrame(times, columns=["started", "ended", "waited"], dtype="float64")
            texts = pd.concat(told, ignore_index=True) if told else _collect([], {}, {})
            yield pd.concat([texts, columns], axis=1)

    return run


def _collect(
    rows: Sequence[Sequence[str | None] | None], done: dict[str, str], failed: dict[str, str]
) -> pd.DataFrame:
    texts, errors = [], []
    for row in rows:
        error = next((failed[t] for t in row if t in failed), None) if row is not None else None
        errors.append(error)
        texts.append(None if row is None or error else [None if t is None else done[t] for t in row])
    return pd.DataFrame({"texts": texts, "error": errors}, dtype="object")
