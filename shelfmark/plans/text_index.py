"""Positional inverted index: full-text search by term lookup instead of a scan of all texts.

Three tables, each the result of one Spark job:

* ``vocabulary`` (token, lexeme): the distinct tokens and their stems.  Python sees every distinct
  token once, in Arrow batches, however often it occurs.
* ``postings`` (lexeme, <key>, positions): one row per lexeme and document with the sorted token
  positions, range-partitioned and sorted by lexeme, so a lookup reads the files and pages that hold
  the lexeme and skips the rest.  The key behind it spreads a frequent lexeme over several ranges.
* ``documents`` (<key>): documents whose text is not NULL, the universe of negations.

A query is set algebra on keys: a term is a lookup, a phrase joins its terms' postings by document
and intersects their shifted positions, AND is a semi join, NOT an anti join and OR a union.  All
sides are unique per key, so no document can be hot.  Stop words (under 'english') are not stored but
keep their position.  Results equal the scan of :mod:`shelfmark.functions.text_search`, row for row;
``<key>`` must be unique and not NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text_search import (CONFIGS, ENGLISH_STOP_WORDS, And, Not, Or, Phrase, Term, parse_websearch, stem_words,
                                             tokens)

# (table, name, sort columns or None) -> the table as it is read back
Writer = Callable[[DataFrame, str, list[str] | None], DataFrame]


def token_rows(docs: DataFrame, key: str, text: Column, config: str) -> DataFrame:
    """(<key>, token, positions): the distinct tokens of every document with their positions, without stop words."""
    rows = docs.select(F.col(key), F.posexplode(tokens(text)).alias("position", "token"))
    if config == "english":
        rows = rows.where(~F.col("token").isin(ENGLISH_STOP_WORDS))
    return rows.groupBy(key, "token").agg(F.sort_array(F.collect_list("position")).alias("positions"))


def vocabulary(docs: DataFrame, text: Column) -> DataFrame:
    """(token, lexeme): the distinct tokens of all texts and their 'english' stems."""
    words = docs.select(F.explode(tokens(text)).alias("token")).where(~F.col("token").isin(ENGLISH_STOP_WORDS)).distinct()
    return words.select("token", stem_words("token").alias("lexeme"))


def postings(docs: DataFrame, key: str, text: Column, config: str, words: DataFrame | None = None) -> DataFrame:
    """(lexeme, <key>, positions); ``words`` is the vocabulary under 'english'."""
    rows = token_rows(docs, key, text, config)
    if config == "simple":
        return rows.select(F.col("token").alias("lexeme"), key, "positions")
    # The vocabulary holds a token once: a frequent token's rows can be split against it.
    merged = rows.join(words, "token").groupBy("lexeme", key).agg(F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"))
    return merged.select("lexeme", key, "positions")


def _minus(offset: int, position: Column) -> Column:
    return position - offset


@dataclass(frozen=True)
class TextIndex:
    """An index over documents identified by ``key``."""

    key: str
    config: str
    documents: DataFrame
    postings: DataFrame

    @classmethod
    def build(cls, docs: DataFrame, key: str, text: Column, config: str = "english", write: Writer = lambda df, name, order: df) -> "TextIndex":
        """Index ``docs``; ``write`` stores each table and reads it back (by default nothing is stored)."""
        if config not in CONFIGS:
            raise ValueError(f"unknown text configuration {config!r}; expected one of {CONFIGS}")
        words = write(vocabulary(docs, text), "vocabulary", None) if config == "english" else None
        found = write(postings(docs, key, text, config, words), "postings", ["lexeme", key])
        return cls(key, config, write(docs.where(text.isNotNull()).select(key), "documents", None), found)

    def search(self, query: str | None) -> DataFrame:
        """(<key>) of the documents that satisfy a web-search query; a query without a lexeme matches nothing."""
        tree = parse_websearch(query, self.config)
        return self.documents.where(F.lit(False)) if tree is None else self._keys(tree)

    def _lookup(self, lexeme: str) -> DataFrame:
        return self.postings.where(F.col("lexeme") == F.lit(lexeme)).drop("lexeme")

    def _keys(self, node) -> DataFrame:
        if isinstance(node, Term):
            return self._lookup(node.lexeme).select(self.key)
        if isinstance(node, Phrase):
            return self._phrase(node)
        if isinstance(node, Not):
            return self.documents.join(self._keys(node.arg), self.key, "left_anti")
        if isinstance(node, Or):
            return reduce(DataFrame.unionByName, [self._keys(a) for a in node.args]).distinct()
        if isinstance(node, And):
            wanted = [self._keys(a) for a in node.args if not isinstance(a, Not)] or [self.documents]
            both = reduce(lambda rows, more: rows.join(more, self.key, "left_semi"), wanted)
            return reduce(lambda rows, a: rows.join(self._keys(a.arg), self.key, "left_anti"),
                          [a for a in node.args if isinstance(a, Not)], both)
        raise TypeError(node)

    def _phrase(self, node: Phrase) -> DataFrame:
        (first, _), *rest = node.parts
        rows = self._lookup(first).withColumnRenamed("positions", "starts")
        for lexeme, offset in rest:
            begins = F.transform("positions", partial(_minus, offset))
            rows = rows.join(self._lookup(lexeme), self.key).select(self.key, F.array_intersect("starts", begins).alias("starts"))
            rows = rows.where(F.size("starts") > 0)
        return rows.select(self.key)
