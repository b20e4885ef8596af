"""Full-text match (FT1/FT2): ``to_tsvector(config, text) @@ websearch_to_tsquery(config, q)``.

Design (one row in, one boolean out -- no shuffle):

* A document becomes a *lexeme array*: lower-cased runs of letters/digits, in order.
  Array index = token position.  Under the 'english' configuration stop words are
  replaced by ``''`` (they keep their position, so a phrase across a stop word needs
  the gap) and the other tokens are stemmed.  Under 'simple' tokens stay as they are.
* The query string is compiled on the driver into a Column over that array:
  term -> ``array_contains``; phrase -> a start position whose followers match;
  AND / OR / NOT -> ``&`` ``|`` ``~``.  A query with no lexeme matches nothing.
* Tokenising and matching are JVM expressions.  Stemming is the only Python step.

This is the scan: it suits one query over a table that is read anyway.  Under 'english' it
stems every token array; :mod:`shelfmark.plans.text_index` stems each distinct token
once and answers selective queries by lookup, which is what the reports use.

Query language (web-search style): words are ANDed; ``"a b"`` is a phrase; ``or``
between operands is OR (binds weaker than AND); ``-`` before a word or phrase negates
it; other punctuation separates words.  A word that splits into several tokens is
treated as a phrase of them.

Fidelity limit: the source database's default parser also knows hyphenated compounds,
hosts, e-mails and signed numbers; this tokenizer splits on every non-alphanumeric.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


from shelfmark.functions.stemmer import stem

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"

# English stop words of the Snowball list used by the 'english'
# configuration, in their published order.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what "
    "which who whom this that these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for "
    "with about against between into through during before after above below to from up "
    "down in out on off over under again further then once here there when where why how "
    "all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don should now"
).split()
_STOP = frozenset(ENGLISH_STOP_WORDS)

CONFIGS = ("english", "simple")


# ---------------------------------------------------------------------------- documents
def tokens(text: Column) -> Column:
    """Lower-cased alphanumeric runs of ``text`` in order (no empty strings)."""
    return words_of(F.lower(text))


def words_of(lowered: Column) -> Column:
    """Alphanumeric runs of a text that is in lower case already."""
    return F.filter(F.split(lowered, TOKEN_SPLIT), lambda t: t != F.lit(""))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _stem_arrays(arrays: pd.Series) -> pd.Series:
    def one(arr):
        if arr is None:
            return None
        return [stem(w) if w else w for w in arr]

    return arrays.map(one)


@F.pandas_udf(T.StringType())
def stem_words(words: pd.Series) -> pd.Series:
    """Stem of every word; for a vocabulary, where each word stands once."""
    return words.map(stem, na_action="ignore")


def lexemes(text: Column, config: str = "english") -> Column:
    """Lexeme array of a document; index = position, ``''`` marks a dropped stop word."""
    if config == "simple":
        return tokens(text)
    if config == "english":
        stops = F.array(*[F.lit(w) for w in ENGLISH_STOP_WORDS])
        marked = F.transform(tokens(text), lambda t: F.when(F.array_contains(stops, t), F.lit("")).otherwise(t))
        return _stem_arrays(marked)
    raise ValueError(f"unknown text configuration {config!r}; expected one of {CONFIGS}")


# ---------------------------------------------------------------------------- queries
@dataclass(frozen=True)
class Term:
    lexeme: str


@dataclass(frozen=True)
class Phrase:
    # (lexeme, offset from the first lexeme); offsets grow, gaps are stop words
    parts: tuple[tuple[str, int], ...]


@dataclass(frozen=True)
class Not:
    arg: object


@dataclass(frozen=True)
class And:
    args: tuple


@dataclass(frozen=True)
class Or:
    args: tuple


def _normalise(word: str, config: str) -> list[str]:
    """Lexemes of one query word or phrase text ('' marks a stop word)."""
    out = []
    for tok in re.split(r"[\W_]+", word.lower()):
        if not tok:
            continue
        if config == "english":
            out.append("" if tok in _STOP else stem(tok))
        else:
            out.append(tok)
    return out


def _operand(text: str, config: str):
    lex = _normalise(text, config)
    while lex and lex[0] == "":
        lex.pop(0)
    while lex and lex[-1] == "":
        lex.pop()
    if not lex:
        return None
    if len(lex) == 1:
        return Term(lex[0])
    parts = tuple((w, i) for i, w in enumerate(lex) if w)
    return Phrase(parts)


_QUERY_TOKEN = re.compile(r'(-?)"([^"]*)"?|(-?)([^\s"]+)')


def parse_websearch(query: str, config: str = "english"):
    """Parse a web-search style query into a small expression tree (None = no lexeme)."""
    groups: list[list] = [[]]  # OR of ANDs
    pending_or = False
    for m in _QUERY_TOKEN.finditer(query or ""):
        neg_q, quoted, neg_w, word = m.groups()
        if quoted is not None:
            negate, text = bool(neg_q), quoted
        else:
            negate, text = bool(neg_w), word
            if not negate and text.lower() == "or":
                pending_or = bool(groups[-1])
                continue
            text = text.lstrip("-")
        node = _operand(text, config)
        if node is None:
            continue
        if negate:
            node = Not(node)
        if pending_or:
            groups.append([])
            pending_or = False
        groups[-1].append(node)
    ands = [g[0] if len(g) == 1 else And(tuple(g)) for g in groups if g]
    if not ands:
        return None
    return ands[0] if len(ands) == 1 else Or(tuple(ands))


def _compile(node, lx: Column) -> Column:
    if isinstance(node, Term):
        return F.array_contains(lx, F.lit(node.lexeme))
    if isinstance(node, Phrase):
        # Align the array with copies of itself shifted by each part's offset; a row of
        # the zip is (lexeme at p, lexeme at p + off2, ...).  No lambda refers to the
        # array itself, so the document is tokenised once, not once per position.
        n = F.size(lx)
        shifted = [(F.slice(lx, off + 1, n) if off else lx).alias(f"p{i}") for i, (_, off) in enumerate(node.parts)]
        zipped = F.arrays_zip(*shifted)
        words = [w for w, _ in node.parts]
        return F.exists(zipped, lambda z: reduce(
            lambda a, b: a & b,
            [F.coalesce(z.getField(f"p{i}") == F.lit(w), F.lit(False)) for i, w in enumerate(words)]))
    if isinstance(node, Not):
        return ~_compile(node.arg, lx)
    if isinstance(node, And):
        return reduce(lambda a, b: a & b, [_compile(a, lx) for a in node.args])
    if isinstance(node, Or):
        return reduce(lambda a, b: a | b, [_compile(a, lx) for a in node.args])
    raise TypeError(node)


def matches(lexeme_array: Column, query: str, config: str = "english") -> Column:
    """Boolean Column: does the document's lexeme array satisfy the web-search query?

    NULL document -> NULL (not a match); empty document -> only negations match.
    """
    tree = parse_websearch(query, config)
    if tree is None:
        return F.lit(False)
    # "let lx = lexeme_array in <query>": binding the array to a lambda variable of a
    # one-element array evaluates the tokeniser once per row, however many terms the
    # query has (an inlined expression would be re-evaluated at every reference).
    return F.exists(F.array(lexeme_array), lambda lx: _compile(tree, lx))


def _required(node, lowered: Column) -> Column | None:
    """A condition on the lower-cased text that every matching 'simple' document meets, without tokenising; None: any may match."""
    if isinstance(node, Term):
        return F.contains(lowered, F.lit(node.lexeme))
    if isinstance(node, Phrase):
        return reduce(lambda a, b: a & b, [F.contains(lowered, F.lit(w)) for w, _ in node.parts])
    if isinstance(node, And):
        known = [c for c in (_required(a, lowered) for a in node.args) if c is not None]
        return reduce(lambda a, b: a & b, known) if known else None
    if isinstance(node, Or):
        known = [_required(a, lowered) for a in node.args]
        return reduce(lambda a, b: a | b, known) if all(c is not None for c in known) else None
    return None


def filter_matching(df, text: Column, query: str, config: str = "english"):
    """Rows of ``df`` where ``to_tsvector(config, text) @@ websearch_to_tsquery(config, query)``.

    The lexeme array is computed once per row (see :func:`matches`); under 'english'
    the stemmer UDF stays outside the query's lambdas.  Under 'simple' a text that lacks a
    required word as a substring is rejected before it is tokenised.
    """
    tree = parse_websearch(query, config)
    if config != "simple" or tree is None:
        return df.filter(matches(lexemes(text, config), query, config))

    def test(lowered: Column) -> Column:
        whole = F.exists(F.array(words_of(lowered)), lambda lx: _compile(tree, lx))
        required = _required(tree, lowered)
        return whole if required is None else required & whole

    return df.filter(F.exists(F.array(F.lower(text)), test))
