"""Kernels and driver-side helpers against plain Python."""

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm import kernels as K
from shelfmark.llm.langid import Scorer
from shelfmark.llm.pieces import WordTable

MODEL = public_tokenizers.path("piece_bpe_32k.model")
texts = st.lists(st.text(alphabet="aB \t\n\x0bé日.|", max_size=30) | st.none(), min_size=1, max_size=6)


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(deadline=None)
@given(texts, st.integers(1, 4), st.sampled_from([8, 1 << 20]))
def test_shingle_sets(rows, k, most):
    seen, per_row = {}, []
    for first, count, data, offs in K.slices(pa.array(rows, pa.string()), most):
        starts, ends, at = K.words(data, offs)
        flat, where = K.gram_sets(K.word_hashes(data, starts, ends, lower=True), at, k)
        per_row += [set(flat[where[d]:where[d + 1]].tolist()) for d in range(count)]
    for row, got in zip(rows, per_row, strict=True):
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in plain_words(row)]
        want = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
        assert len(got) == len(want)
        for gram in want:  # equal shingles have equal hashes across rows
            seen.setdefault(len(want) == 1 and gram, got if len(want) == 1 else None)
            if len(want) == 1:
                assert seen[gram] == got


def test_long_word_spans_slices():
    text = "x" * 5000 + " tail " + "y" * 3000
    (_, _, data, offs), = K.slices(pa.array([text]))
    s, e, at = K.words(data, offs)
    assert (e - s).tolist() == [5000, 4, 3000] and at.tolist() == [0, 3]


@settings(deadline=None, max_examples=200)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab  ▁\n\té日😀<s>\x00")) | st.characters(codec="utf-8"), max_size=60), max_size=4))
def test_pieces_equal_library(rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    table = test_pieces_equal_library.__dict__.setdefault("table", WordTable(open(MODEL, "rb").read()))
    for row, (ids, text) in zip(rows, table.encode(rows), strict=True):
        assert ids == sp.encode(row)
        assert text == sp.decode(ids)


def test_pieces_table_is_bounded(monkeypatch):
    import shelfmark.llm.pieces as P

    monkeypatch.setattr(P, "TABLE_WORDS", 3)
    table = WordTable(open(MODEL, "rb").read())
    sp = table.model
    for row in ("a b c", "d e f g h", "", "a b"):
        assert table.encode([row])[0][0] == sp.encode(row)
    assert len(table.ids) <= 5


def test_forward_sums_all_segmentations():
    pieces, counts = ["▁", "a", "b", "▁a", "ab", "▁ab"], np.array([[5., 1], [3, 2], [2, 2], [4, 1], [1, 6], [2, 3]])
    s = Scorer(pieces, counts)

    def total(word, lang):
        if not word:
            return 1.0
        p = sum(s.probs[i, lang] * total(word[len(x):], lang) for i, x in enumerate(pieces) if word.startswith(x))
        return p if word[0] in pieces else p + s.unknown * total(word[1:], lang)

    for word in ("▁ab", "▁a", "▁abab", "▁zab", "▁"):
        for got, want in zip(s.log_probs([word])[0], (total(word, 0), total(word, 1))):
            assert np.isclose(got, np.log(want))
