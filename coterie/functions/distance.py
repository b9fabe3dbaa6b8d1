"""Distances between two strings as column expressions. Both are metrics."""

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def levenshtein(a: Column, b: Column) -> Column:
    """Insertions, deletions and replacements that turn one string into the other."""
    return F.levenshtein(a, b)


def subsequence_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table at a time.

    A row's steps are the zero bits of one whole number as long as ``a``, and a character of ``b``
    moves all of them with one addition, whose carries run through as many words as it takes.
    """
    holds = {}
    for place, character in enumerate(a):
        holds[character] = holds.get(character, 0) | 1 << place
    every = (1 << len(a)) - 1
    row = every
    for character in b:
        if met := row & holds.get(character, 0):
            row = (row + met | row - met) & every
    return len(a) - row.bit_count()


@F.pandas_udf(IntegerType())
def _subsequence_lengths(a: pd.Series, b: pd.Series) -> pd.Series:
    missing = a.isna() | b.isna()
    pairs = zip(a, b, missing, strict=True)
    found = [None if none else subsequence_length(x, y) for x, y, none in pairs]
    return pd.Series(found, dtype="Int32")


def common_subsequence_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of characters; null if either string is."""
    return _subsequence_lengths(a, b)


def insert_delete_distance(a: Column, b: Column) -> Column:
    """Insertions and deletions that turn one string into the other."""
    return F.length(a) + F.length(b) - 2 * common_subsequence_length(a, b)
