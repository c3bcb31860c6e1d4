"""Review tokenizer as native Spark expressions (no Python UDF, stays in
whole-stage codegen): lower-case, strip every character outside the kept
letter class and whitespace, split on whitespace runs, keep tokens of at
least ``TOKEN_MIN_LENGTH`` characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionlens.schema import TOKEN_LETTERS, TOKEN_MIN_LENGTH

STRIP_PATTERN = f"[^{TOKEN_LETTERS}\\s]"


def tokens(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    cleaned = F.regexp_replace(F.lower(c), STRIP_PATTERN, "")
    return F.filter(F.split(cleaned, "\\s+"), lambda t: F.length(t) >= TOKEN_MIN_LENGTH)
