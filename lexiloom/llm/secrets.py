"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

A candidate is a run of at least ``WINDOW`` characters that tokens are made of. It
belongs to the narrowest class that holds all its characters (hex, lower case and
digits, any). A window of 20 characters slides over it; the counts of its
characters change by one in and one out, and so does the sum that gives Shannon's
entropy. Windows at or above the entropy of their class, with a letter and a digit
in them, are hot; touching hot windows make one span, which goes on to the end of
the token. Candidates on the allow-list, and spans inside what a pattern has found,
are left out. What may be in an address is told by its part: hosts are no secrets,
the user's part and query values may well be.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.words import pieces, set_aside

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
# Least entropy in bits a character. Random windows of 20 have about 3.4, 3.8 and
# 4.0; words have 3.3 at most in 20 letters, and rarely a digit.
LEAST_ENTROPY = {"hex": 2.9, "lower": 3.3, "any": 3.5}
MASK = "[SECRET]"

# The patterns asked for.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{WINDOW},}}")
CLASSES = (("hex", re.compile(r"[0-9a-fA-F]+")), ("lower", re.compile(r"[a-z0-9]+")))
# Not secrets: UUIDs; paths and compounds whose parts are plain words or numbers.
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"(?:[+/_-]*(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+))(?:[+/_-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+))*[+/_-]*"),
)
# Stands in for a secret; what is left beside it has to be hot on its own.
PLACEHOLDER = re.compile(r"example|x{4,}", re.IGNORECASE)
# Runs of letters of one case, and numbers. In an identifier most characters are in
# words of this many letters or more; more are asked for where nothing but digits
# parts the words.
RUN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
WORD, WORD_IN_LOWER, IN_WORDS = 3, 5, 0.75
# Hexadecimal digits of usual digests, of 96 bits and more, and what
# such a digest is announced by.
DIGESTS = (24, 32, 40, 48, 56, 64, 96, 128)
DIGEST_NAMES = ("sha1", "sha224", "sha256", "sha384", "sha512", "md5", "commit", "digest", "etag", "checksum")
BETWEEN = "-:= \t\n\r\"'"
ADDRESS = re.compile(r"""[A-Za-z][A-Za-z0-9+.-]*+://(?P<rest>[^\s<>"']*+)""")

HOST = re.compile(r"(?:[^:\[\]]*|\[[0-9A-Fa-f:.]*\])(?::[0-9]*)?")


def assigned(text: str) -> list[tuple[int, int]]:
    """Matches of ``ASSIGN``, left to right, looked for only where a keyword is."""
    lower = text.lower()
    if len(lower) != len(text):  # a few letters grow when lower-cased
        lower = "".join(c.lower() if c.isascii() else c for c in text)
    places = []
    for word in KEYWORDS:
        at = lower.find(word)
        while at >= 0:
            places.append(at)
            at = lower.find(word, at + 1)
    found, past = [], 0
    for at in sorted(places):
        if at >= past and (match := ASSIGN.match(text, at)):
            past = match.end()
            if len(match[2]) >= 8:
                found.append(match.span())
    return found


def hot_windows(candidate: str, least: float, window: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Spans of touching windows whose entropy is ``least`` or more."""
    term = [0.0] + [n * log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, letters, digits = 0.0, 0, 0
    begin = end = -1
    for i, c in enumerate(candidate):
        n = counts.get(c, 0)
        total += term[n + 1] - term[n]
        counts[c] = n + 1
        letters += c.isalpha()
        digits += c.isdigit()
        if i >= window:
            out = candidate[i - window]
            n = counts[out]
            total += term[n - 1] - term[n]
            counts[out] = n - 1
            letters -= out.isalpha()
            digits -= out.isdigit()
        if i >= window - 1 and letters and digits and log2(window) - total / window >= least - 1e-9:
            if i - window + 1 > end:
                if end >= 0:
                    yield begin, end
                begin = i - window + 1
            end = i + 1
    if end >= 0:
        yield begin, end


def is_identifier(word: str) -> bool:
    """Whether nearly all of it is in words, as in ``someLongName2``."""
    least = WORD_IN_LOWER if CLASSES[1][1].fullmatch(word) else WORD
    return sum(len(run) for run in RUN.findall(word) if len(run) >= least and run.isalpha()) >= IN_WORDS * len(word)


def is_digest(word: str) -> bool:
    return len(word) in DIGESTS and CLASSES[0][1].fullmatch(word) is not None


def announced(text: str, at: int) -> bool:
    """Whether what begins at ``at`` is named as a digest right before."""
    while at and text[at - 1] in BETWEEN:
        at -= 1
    return text[max(0, at - 8) : at].lower().endswith(DIGEST_NAMES)


def address_parts(text: str) -> Iterator[tuple[int, int, int]]:
    """Where the host of each address begins and ends, and where its path ends."""
    if "://" not in text:
        return
    for match in ADDRESS.finditer(text):
        start, rest = match.start("rest"), match["rest"]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = rest.rfind("@", 0, cut) + 1
        if HOST.fullmatch(rest, host, cut):  # else a password with a slash in it
            end = min((at for at in (rest.find(c, cut) for c in "?#") if at >= 0), default=len(rest))
            yield start + host, start + cut, start + end


def _hot(word: str) -> list[tuple[int, int]]:
    """Hot spans of a token, each up to a slash or the token's end on both sides."""
    kind = next((name for name, pattern in CLASSES if pattern.fullmatch(word)), "any")
    out: list[tuple[int, int]] = []
    for begin, end in hot_windows(word, LEAST_ENTROPY[kind]):
        begin, end = word.rfind("/", 0, begin) + 1, word.find("/", end)
        end = len(word) if end < 0 else end
        if out and begin <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def is_allowed(word: str) -> bool:
    """Whether a token's own shape tells that it is no secret."""
    if any(p.fullmatch(word) for p in ALLOWED) or is_identifier(word):
        return True
    parts = PLACEHOLDER.split(word)
    return len(parts) > 1 and not any(len(p) >= WINDOW and _hot(p) for p in parts)


def entropy_spans(text: str) -> Iterator[tuple[int, int]]:
    addresses, at = list(address_parts(text)), 0
    for match in CANDIDATE.finditer(text):
        word, begin = match[0], match.start()
        if word.isalpha() or word.isdigit():
            continue
        while at < len(addresses) and addresses[at][2] <= begin:
            at += 1
        host, path, end = addresses[at] if at < len(addresses) else (len(text),) * 3
        if host <= begin < path:  # what is left of the host
            word, begin = word[path - begin :], min(path, match.end())
        if path <= begin < end and all(is_digest(part) or is_allowed(part) for part in word.split("/")):
            continue
        if not (hot := _hot(word)) or is_allowed(word) or (is_digest(word) and announced(text, begin)):
            continue
        yield from ((begin + a, begin + b) for a, b in hot)


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, in order; kind is a place in ``KINDS``."""
    base = [(a, 0, b) for a, b in assigned(text)]
    base += [(*m.span()[:1], 1, m.end()) for m in ACCESS.finditer(text)]
    base += [(*m.span()[:1], 2, m.end()) for m in HEX.finditer(text)]
    base.sort()
    spans, at = list(base), 0
    for a, b in entropy_spans(text):
        while at < len(base) and base[at][2] <= a:
            at += 1
        if not any(x <= a and b <= y for x, _, y in base[at : at + len(KINDS)]):
            spans.append((a, 3, b))
    return sorted(spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.array(KINDS)
    for piece in pieces(batches, "text"):
        first, flat = [0], []
        for text in piece.column("text").to_pylist():
            if text:
                flat += find_spans(text)
            first.append(len(flat))
        spans = pa.StructArray.from_arrays(
            [
                kinds.take(pa.array([k for _, k, _ in flat], pa.int32())),
                pa.array([a for a, _, _ in flat], pa.int32()),
                pa.array([b for _, _, b in flat], pa.int32()),
            ],
            ["kind", "start", "end"],
        )
        columns = {name: piece.column(name) for name in piece.schema.names}
        columns["spans"] = pa.ListArray.from_arrays(pa.array(first, pa.int32()), spans)
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _with_spans(renamed: DataFrame) -> DataFrame:
    shape = "array<struct<kind: string, start: int, end: int>>"
    return renamed.mapInArrow(_scan, renamed.withColumn("spans", F.lit(None).cast(shape)).schema)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Every column of ``docs`` and ``_spans``: array of (kind, start, end), places
    in code points, end exclusive, ordered by start and then by kind. A column that
    has this name already is replaced.

    A null or empty text has no spans; equal rows have equal spans; no rows give
    no rows. Texts are handled one by one, so their length bounds the memory.
    """
    renamed, back = set_aside(docs.drop("_spans"))
    return _with_spans(renamed).select(*back, F.col("spans").alias("_spans"))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is(kind: str):
    return lambda span: span["kind"] == kind


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = find_secrets(docs.select("doc_id", "text"))
    spans = F.col("_spans")
    base = F.filter(spans, lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id",
        *(
            F.size(F.filter(spans, _is(kind))).cast("bigint").alias(f"n_{kind}") for kind in KINDS[:3]
        ),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(spans).alias("spans"),
    )


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for r, spans in enumerate(batch.column("spans").to_pylist()):
            if not spans:
                continue
            text, out, past = texts[r], [], 0
            for s in spans:
                if s["start"] >= past:
                    out += [text[past : s["start"]], MASK]
                past = max(past, s["end"])
            texts[r] = "".join([*out, text[past:]])
        columns = {name: batch.column(name) for name in batch.schema.names}
        columns["text"] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by ``MASK``; ``n_chars``, where it is a
    column, is counted anew for texts that changed.

    Overlapping spans are one mask. Null and empty texts stay as they are; repeated
    rows change alike; a text of any length is looked at as a whole, one at a time;
    columns of any name are kept. No rows give no rows.
    """
    renamed, back = set_aside(docs)
    shaped = _with_spans(renamed).select(F.struct(*back).alias("row"), "text", "spans")
    masked = shaped.mapInArrow(_mask, shaped.schema)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text"))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            columns.append(F.when(F.size("spans") > 0, F.length("text").cast(kind)).otherwise(F.col("row.n_chars")).alias(c))
        else:
            columns.append(F.col(f"row.`{c}`").alias(c))
    return masked.select(*columns)
