"""Language identification with segmentation-marginalised unigram models.

Every language has a probability for each piece of a fixed public vocabulary, from the
pieces that the vocabulary's own segmentation of training words gives, with additive smoothing.
A word's probability under a language is the sum over all its segmentations into pieces of the
product of their probabilities, by the forward algorithm.  A text's score is the sum over its
words, whole text, all words.

The fit reads a sample of at most about ``FIT_DOCS`` distinct labelled texts a language, taken by a
hash of the text, and its counts (vocabulary x languages) are the only data sent around.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, unused, with_defaults

FIT_DOCS = 3000
SMOOTH = 0.5
LONGEST = 32  # letters of a word scored at once; a longer word is scored as runs of this many
TABLE_WORDS = 250_000
MARK = "▁"


_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str) -> list[str]:
    """Lower-case runs of letters of a whole text; signs that are no letters (``²``, vowel signs) part runs."""
    out = []
    for run in _LETTERS.findall(text.lower()):
        if run.isalpha():
            out.append(run)
        else:
            out += "".join(c if c.isalpha() else " " for c in run).split()
    return out


def _parts(word: str) -> list[str]:
    return [MARK + word[:LONGEST], *[word[i:i + LONGEST] for i in range(LONGEST, len(word), LONGEST)]]


class Scorer:
    """Log-probabilities of words under every language, for batches of new words.

    The pieces form a trie whose steps (node, letter) are one sorted array, so a batch of words
    of one length walks it together.
    """

    def __init__(self, pieces: list[str], counts: np.ndarray):
        p = counts + SMOOTH
        self.probs = p / p.sum(axis=0)  # piece x language
        self.unknown = float(self.probs.min()) * 0.1  # a letter that is no piece, the same in all languages
        steps: dict[int, int] = {}
        ends = {}
        for i, piece in enumerate(pieces):
            node = 0
            for c in piece:
                node = steps.setdefault(node << 21 | ord(c), len(steps) + 1)
            ends[node] = i
        order = sorted(steps)
        self.steps = np.array(order, np.int64)
        self.goes = np.array([steps[k] for k in order], np.int64)
        self.piece = np.full(len(steps) + 1, -1, np.int64)
        self.piece[list(ends)] = list(ends.values())
        self.table: dict[str, int] = {}
        self.rows = np.zeros((1024, counts.shape[1]))

    def log_probs(self, words: list[str]) -> np.ndarray:
        """One row per word: ln of the sum over all segmentations, by the forward algorithm."""
        out = np.empty((len(words), self.probs.shape[1]))
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for n, which in by_length.items():
            for a in range(0, len(which), 8192):
                out[which[a:a + 8192]] = self._forward([words[i] for i in which[a:a + 8192]], n)
        return out

    def _forward(self, words: list[str], n: int) -> np.ndarray:
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n).T.astype(np.int64)
        alpha = np.zeros((n + 1, len(words), self.probs.shape[1]))
        alpha[0] = 1.0
        for begin in range(n):
            live, node = np.arange(len(words)), np.zeros(len(words), np.int64)
            for end in range(begin + 1, n + 1):
                step = node << 21 | letters[end - 1, live]
                at = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
                on = self.steps[at] == step
                walked, node = live[on], self.goes[at[on]]
                piece = self.piece[node]
                hit = piece >= 0
                who = walked[hit]
                alpha[end, who] += alpha[begin, who] * self.probs[piece[hit]]
                if end == begin + 1:
                    rest = np.ones(len(words), bool)
                    rest[who] = False
                    alpha[end, rest] += alpha[begin, rest] * self.unknown
                live = walked
                if not len(live):
                    break
        return np.log(alpha[n])

    def learn(self, words: list[str]):
        """Score the distinct words of a batch of texts that the table does not hold."""
        new = [w for w in words if w not in self.table]
        if len(self.table) + len(new) > TABLE_WORDS:
            self.table.clear()
            new = words
        if not new:
            return
        parts, owner = [], []
        for i, w in enumerate(new):
            for part in _parts(w):
                parts.append(part)
                owner.append(i)
        rows = np.zeros((len(new), self.probs.shape[1]))
        np.add.at(rows, owner, self.log_probs(parts))
        first = len(self.table)
        if first + len(new) > len(self.rows):
            more = max(len(new), len(self.rows))
            self.rows = np.concatenate([self.rows[:first], np.zeros((more, self.rows.shape[1]))])
        self.rows[first:first + len(new)] = rows
        self.table.update(zip(new, range(first, first + len(new))))

    def score(self, count: Counter) -> np.ndarray:
        """ln P of a bag of learned words under every language."""
        where = np.fromiter(map(self.table.__getitem__, count), np.int64, len(count))
        return np.fromiter(count.values(), np.float64, len(count)) @ self.rows[where]


def _counter(model: bytes):
    def run(batches):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        total: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words = Counter(letter_words(text))
                for (w, n), ids in zip(words.items(), sp.encode(list(words))):
                    for i in ids:
                        total[lang, i] += n
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([total[k] for k in keys], pa.int64())], ["lang", "piece", "n"])
    return run


def fit(labelled: DataFrame, model_path: str) -> tuple[list[str], list[str], np.ndarray]:
    """(languages, pieces, counts) from rows (text, lang) with neither null.

    At most about ``FIT_DOCS`` distinct texts a language, those with the smallest hash; copies count once.
    """
    prepare(labelled.sparkSession)
    with open(model_path, "rb") as f:
        model = f.read()
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.select("lang", F.xxhash64("text")).distinct().groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return [], [], np.zeros((0, 0))
    share = F.create_map(*[x for g in langs for x in (F.lit(g), F.lit(min(1.0, FIT_DOCS / sizes[g])))])
    sample = rows.where((F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1_000_000.0) < share[F.col("lang")]).distinct()
    found = (sample.mapInArrow(_counter(model), "lang string, piece int, n long")
             .groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect())  # at most vocabulary x languages
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [sp.id_to_piece(i) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) else "" for i in range(sp.get_piece_size())]
    usable = [i for i, p in enumerate(pieces) if p and p == p.lower() and all(c.isalpha() for c in p.removeprefix(MARK)) and p != MARK * len(p) or p == MARK]
    place = {p: j for j, p in enumerate(usable)}
    counts = np.zeros((len(usable), len(langs)))
    for r in found:
        if r["piece"] in place:
            counts[place[r["piece"]], langs.index(r["lang"])] += r["n"]
    return langs, [pieces[i] for i in usable], counts


def _predictor(shared, names: list[str]):
    def run(batches):
        langs, pieces, counts = shared.value
        scorer = Scorer(pieces, counts) if langs else None
        for batch in batches:
            best, score = [], []
            bags = [Counter(letter_words(t.as_py() or "")) if scorer else Counter() for t in batch.columns[-1]]
            if scorer:
                scorer.learn(list(set().union(*bags)))
            for bag in bags:
                if not bag:
                    best.append("und")
                    score.append(0.0)
                    continue
                total = scorer.score(bag)
                top = int(total.argmax())
                best.append(langs[top])
                score.append(float(1.0 / np.exp(total - total[top]).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(best, pa.string()), pa.array(score, pa.float64())], names)
    return run


def predict(docs: DataFrame, fitted, text: str = "text", keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns (default doc_id) plus the language and its score (the posterior, 0 to 1), called ``names``.

    A null text, one without letters, or a fit without languages gives ``und`` with score 0.
    Ties go to the language that sorts first.  Every row gives one row.  Kept columns called like one of
    ``names`` are replaced; no other name clashes.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(fitted)  # vocabulary x languages numbers
    kept = [c for c in keep or ["doc_id"] if c.lower() not in names]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(unused(kept, "text")))
    schema = T.StructType(rows.schema.fields[:-1] + [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return rows.mapInArrow(_predictor(shared, schema.names), schema)


def held_out(column: str = "doc_id"):
    """crc32 of the id as text is divisible by 5.  A null id is held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def identify(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text, lang).

    Fitted on the rows that are not held out and have a lang; lang and doc_id never
    reach a prediction.
    """
    fitted = fit(with_defaults(docs.where(~held_out()), {"text": "string", "lang": "string"}), model_path)
    return predict(docs, fitted).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
