"""Column expressions on text shared by the operators that stay inside the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: White space between words, and the letters that are lower-cased.
BLANKS = "[\\x20\\x09-\\x0D]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_words(text: Column, separators: str = BLANKS, ends: str = "\t\n\x0b\x0c\r ") -> Column:
    """Words between runs of ``separators``; an empty array for null and blank texts.

    ``ends`` are the characters of ``separators``.
    """
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(ends))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, separators))


def lower_ascii(word: Column) -> Column:
    """A-Z lower-cased, all other letters as they are."""
    plain = F.octet_length(word) == F.char_length(word)
    return (F.when(plain, F.lower(word))
            .when(word.rlike("[A-Z]"), F.translate(word, UPPER, SMALL)).otherwise(word))


def let(value: Column, body) -> Column:
    """``body`` of ``value``, worked out once: inside a lambda a value is a variable that the optimiser cannot replace by its steps."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_fields(rows: DataFrame, fields: Column) -> DataFrame:
    """``rows`` with the fields of a struct as columns, worked out once a row whatever is filtered or sorted on them later.

    The fields come out of a generator of one row: filters on them stay above it.
    """
    return rows.select("*", F.inline(F.array(fields)))
