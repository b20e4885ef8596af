"""SentencePiece encoding and decoding by distinct marked words.

A text is normalised to marks (each space becomes the mark U+2581, one mark is put in front)
and cut before every run of marks.  If no piece of the model has a mark after another
character (checked when the model is loaded), no merge crosses a cut, so each distinct marked
word is segmented once and the ids are joined back by position.  The table of distinct words
is kept per task and bounded; words beyond the bound start a new table, which costs time, never
results.  Texts are not shuffled: the table of a task settles nearly all of its words, and a
table for all tasks would have to be joined to every word occurrence.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, unused

MARK = "▁"
TABLE_WORDS = 200_000
TABLE_CHARS = 8_000_000
_CUT = re.compile(f"{MARK}+[^{MARK}]*")


class WordTable:
    """ids and decoded text of distinct marked words under one model, a bounded number at a time."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("the model has pieces that cross word marks")
        if self.model.encode("a  b ") != self.model.encode(f"a{MARK}{MARK}b{MARK}") or self.model.decode(self.model.encode(" a\t b")) != " a\t b":
            raise ValueError("the model's normalisation is not the plain one (mark for space, one mark in front)")
        self.clear()

    def clear(self):
        self.ids: dict[str, list[int]] = {}
        self.odd: dict[str, str] = {}  # decoded text of words that do not decode to themselves
        self.chars = 0

    def learn(self, found: set[str]):
        """Segment the words of a batch of texts that the table does not hold yet, each once."""
        new = [w for w in found if w not in self.ids]
        size = sum(map(len, new))
        if self.ids and (len(self.ids) + len(new) > TABLE_WORDS or self.chars + size > TABLE_CHARS):
            self.clear()
            new = list(found)
            size = sum(map(len, new))
        if not new:
            return
        self.chars += size
        # the model puts the first mark in front itself
        segmented = self.model.encode([w[1:] for w in new], num_threads=1)
        for i, word in enumerate(new):
            if word == MARK:  # a lone mark: the empty text encodes to nothing, so it is taken from a pair
                segmented[i] = self.model.encode(f"a{MARK}")[len(self.model.encode("a")):]
        self.ids.update(zip(new, segmented))
        for word, text in zip(new, self.model.decode(segmented)):
            if text != word[1:].replace(MARK, " "):
                self.odd[word] = " " + text

    def encode(self, texts: list[str]) -> list[tuple[list[int], str]]:
        """The ids of every text and the text that they decode to."""
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        cut = [_CUT.findall(m) for m in marked]
        self.learn(set().union(*cut))
        out, table, odd = [], self.ids, self.odd
        for mark, found in zip(marked, cut):
            ids: list[int] = []
            for word in found:
                ids += table[word]
            if odd and not odd.keys().isdisjoint(found):
                text = "".join([odd.get(w) or w.replace(MARK, " ") for w in found])[1:]
            else:
                text = mark[1:].replace(MARK, " ")
            out.append((ids, text))
        return out


def _encoder(model: bytes, names: list[str]):
    def run(batches):
        table = WordTable(model)
        for whole in batches:
            for first in range(0, whole.num_rows, 64):
                batch = whole.slice(first, 64)
                pairs = table.encode([t.as_py() or "" for t in batch.columns[-1]])
                ends = np.cumsum([0] + [len(p[0]) for p in pairs])
                flat = np.fromiter(chain.from_iterable(p[0] for p in pairs), np.int32, ends[-1])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids, pa.array([p[1] for p in pairs], pa.string())], names)
    return run


def encode_decode(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None,
                  names: tuple[str, str] = ("piece_ids", "decoded")) -> DataFrame:
    """``keep`` columns plus the ids (array<int>) and the text they decode to, called ``names``, as the library gives them.

    The ids equal ``encode(text)`` without begin or end ids, the text equals ``decode(ids)``.  A null or
    empty text has no ids and decodes to ''.  Every row gives one row; other columns than ``keep``
    are dropped (default: doc_id), and kept columns called like one of ``names`` are replaced.
    """
    prepare(docs.sparkSession)
    with open(model_path, "rb") as f:
        model = f.read()
    kept = [c for c in keep or ["doc_id"] if c.lower() not in names]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(unused(kept, "text")))
    schema = T.StructType(rows.schema.fields[:-1] + [T.StructField(names[0], T.ArrayType(T.IntegerType())), T.StructField(names[1], T.StringType())])
    return rows.mapInArrow(_encoder(model, schema.names), schema)
