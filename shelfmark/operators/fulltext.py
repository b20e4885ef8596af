"""Full-text match over any text column (FT1/FT2 applied to a document table).

The match is a per-row predicate (tokenise -> lexeme array -> compiled query), so it
runs inside the scan stage with no shuffle and scales with the text volume.  Whole
texts are tokenised; nothing is truncated.  For many queries over one table, or a few
selective ones, :func:`index_documents` builds a positional index first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text_search import filter_matching
from shelfmark.plans.text_index import TextIndex
from shelfmark.session import checkpoint_dir


def text_match(df: DataFrame, text_col: str, query: str, config: str = "simple") -> DataFrame:
    """Rows of ``df`` whose ``text_col`` matches the web-search style ``query``."""
    return filter_matching(df, F.col(text_col), query, config)


def text_match_documents(documents: DataFrame, query: str, config: str = "simple") -> DataFrame:
    """Matching documents with their id, language, source and length."""
    return text_match(documents, "text", query, config).select("doc_id", "lang", "source", "n_chars")


def index_documents(documents: DataFrame, config: str = "simple", key: str = "doc_id", text_col: str = "text") -> TextIndex:
    """A positional index of ``documents``, written under the shared folder.  ``key`` must be unique and not NULL."""
    spark = documents.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/text-index-{uuid.uuid4().hex}"

    def write(df: DataFrame, name: str, order: list[str] | None) -> DataFrame:
        if order:
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    return TextIndex.build(documents, key, F.col(text_col), config, write)


def index_match_documents(documents: DataFrame, query: str, config: str = "simple", index: TextIndex | None = None) -> DataFrame:
    """The rows of :func:`text_match_documents`, found through an index (built here unless given)."""
    hits = (index or index_documents(documents, config)).search(query)
    return documents.join(hits, "doc_id", "left_semi").select("doc_id", "lang", "source", "n_chars")
