"""Tokens of a text column."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokenize(df: DataFrame, text: str, words: str = "words") -> DataFrame:
    """Lower-case tokens, split at each white-space character.

    A null text counts as empty. Repeated blanks give empty tokens.
    """
    source = f"_{words}_text"
    prepared = df.withColumn(source, F.coalesce(F.col(text).cast("string"), F.lit("")))
    return Tokenizer(inputCol=source, outputCol=words).transform(prepared).drop(source)


def remove_stop_words(df: DataFrame, words: str = "words", filtered: str = "filtered_words") -> DataFrame:
    """Drop the English default stop words; empty tokens stay."""
    return StopWordsRemover(inputCol=words, outputCol=filtered).transform(df)


def filtered_tokens(df: DataFrame, text: str, filtered: str = "filtered_words") -> DataFrame:
    """:func:`tokenize` and :func:`remove_stop_words` in one step."""
    words = f"_{filtered}_words"
    return remove_stop_words(tokenize(df, text, words), words, filtered).drop(words)


def joined_tokens(words: str) -> Column:
    """The tokens as one blank-separated text."""
    return F.array_join(F.col(words), " ")


def non_blank(words: str) -> Column:
    """The tokens without empty ones, as embedders want them."""
    return F.filter(F.col(words), lambda word: word != "")
