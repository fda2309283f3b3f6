"""Input schemas and output column contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Input layouts.
DICTIONARY = (
    "word STRING, lang_code STRING, pos STRING, "
    "senses ARRAY<STRUCT<glosses: ARRAY<STRING>, tags: ARRAY<STRING>, "
    "form_of: ARRAY<STRUCT<word: STRING>>>>"
)
PROMPTS = "prompt STRING, response STRING, instruction STRING, output STRING"
PAIRS = "index BIGINT, set ARRAY<STRING>"
TRIPLETS = "index BIGINT, set STRUCT<query: STRING, pos: ARRAY<STRING>, neg: ARRAY<STRING>>"
IMAGE_ROWS = "id STRING, images ARRAY<BINARY>, problem STRING, answer STRING, pass STRING"
SCORED_PAIRS = (
    "idx1 BIGINT, idx2 BIGINT, sentence1 STRING, sentence2 STRING, similarity DOUBLE"
)

# Output columns, in order.
DEFINITION_COLUMNS = ["word", "definition"]
FORM_COLUMNS = ["word", "original form"]
MANIFEST_COLUMNS = ["id", "image_filenames", "problem", "answer", "pass"]
PAIR_COLUMNS = ["index", "Q_original", "A_original", "Q_traducida", "A_traducida"]
TRIPLET_COLUMNS = [
    "index",
    "Q_original",
    "POS_original",
    "NEGs_original",
    "Q_traducida",
    "POS_traducida",
    "NEGs_traducidas",
]
REASONING_COLUMNS = [
    "prompt",
    "response_thoughts",
    "response_salida",
    "original_prompt",
    "original_response",
]
SCORED_PAIR_COLUMNS = ["idx1", "idx2", "sentence1", "sentence2", "similarity"]


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly ``columns`` in that order; a missing one is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for this output: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def lists_as_json(df: DataFrame) -> DataFrame:
    """Array columns as JSON text, for formats without arrays."""
    return df.select(
        *[
            F.to_json(F.col(f"`{name}`")).alias(name) if kind.startswith("array") else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )
