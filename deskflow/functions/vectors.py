"""Vectors as array columns."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

TERM_BUCKETS = 64


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """NULL when either vector has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def round6(x: Column) -> Column:
    """Rounded to six decimals, half up."""
    return F.floor(x * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def vector_literal(v: Column) -> Column:
    """Components in whole millionths, comma separated."""
    return F.concat_ws(
        ",",
        F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(1e6) + F.lit(0.5)).cast("string")),
    )


def term_counts(text: Column, buckets: int = TERM_BUCKETS) -> Column:
    """How many words of the text hash to each bucket, as an array of doubles; NULL for a NULL text.

    One pass over the words of a batch; a word is hashed once however often the batch has it.
    """

    @F.pandas_udf("array<double>")
    def count(texts: pd.Series) -> pd.Series:
        slots: dict[str, int] = {}

        def slot(word: str) -> int:
            if word not in slots:
                slots[word] = int(hashlib.md5(word.encode()).hexdigest()[:6], 16) % buckets
            return slots[word]

        def row(t):
            if t is None:
                return None
            return np.bincount([slot(w) for w in t.split(" ") if w], minlength=buckets).astype(float)

        return pd.Series([row(t) for t in texts], dtype=object)

    return count(F.lower(text))


def unit(v: Column) -> Column:
    """The vector at length one; a zero vector stays zero."""
    return let(
        norm(v),
        lambda length: F.transform(v, lambda x: F.when(length > 0, x / length).otherwise(F.lit(0.0))),
    )
