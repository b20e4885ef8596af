"""Web-search query parsing, stemming and matching semantics (FT1/FT2)."""

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.stemmer import stem
from shelfmark.functions.text_search import And, Not, Or, Phrase, Term, lexemes, matches, parse_websearch

# Published Porter2 examples.
STEMS = {
    "consign": "consign", "consigned": "consign", "consigning": "consign", "consignment": "consign",
    "consistency": "consist", "consistently": "consist", "generate": "generat", "generously": "generous",
    "knackeries": "knackeri", "running": "run", "happily": "happili", "caresses": "caress", "ponies": "poni",
    "ties": "tie", "cries": "cri", "agreed": "agre", "hopping": "hop", "hoping": "hope", "relational": "relat",
    "conditional": "condit", "rational": "ration", "digitizer": "digit", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "texas": "texa", "history": "histori", "united": "unit",
    "states": "state", "skies": "sky", "news": "news", "gas": "gas", "gaps": "gap", "by": "by", "say": "say",
    "cry": "cri", "succeeded": "succeed", "arsenal": "arsenal", "communication": "communic",
    "economies": "economi", "economy": "economi", "widgets": "widget",
}


@pytest.mark.parametrize("word,expected", sorted(STEMS.items()))
def test_porter2(word, expected):
    assert stem(word) == expected


def test_parse_precedence_phrase_and_negation():
    tree = parse_websearch('widgets or "small gear" -red', "english")
    assert tree == Or((Term("widget"), And((Phrase((("small", 0), ("gear", 1))), Not(Term("red"))))))


def test_parse_stop_words():
    assert parse_websearch("the of", "english") is None
    assert parse_websearch('"history of texas"', "english") == Phrase((("histori", 0), ("texa", 2)))
    assert parse_websearch("the of", "simple") == And((Term("the"), Term("of")))
    assert parse_websearch("-the cat", "english") == Term("cat")


def _match(spark, texts, query, config="english"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.i for r in df.filter(matches(lexemes(F.col("t"), config), query, config)).orderBy("i").collect()]


def test_phrase_across_two_subjects(spark):
    assert _match(spark, ["Texas history, United States", "United history"], '"history united"') == [0]


def test_exclusion_only_matches_empty_document_not_null(spark):
    assert _match(spark, ["", None, "Texas", "Ohio"], "-texas") == [0, 3]


def test_stop_words_only_query_matches_nothing(spark):
    assert _match(spark, ["the of", "cat"], "the of") == []


def test_stop_word_gap_in_phrase(spark):
    texts = ["history of texas", "history texas", "history big texas"]
    assert _match(spark, texts, '"history of texas"') == [0, 2]


def test_stemmed_match_and_or(spark):
    assert _match(spark, ["running dogs", "a cat ran", "dog"], "run dog or cat") == [0, 1]


def test_simple_config_keeps_words(spark):
    assert _match(spark, ["Running Dogs", "the run"], "running", "simple") == [0]
    assert _match(spark, ["of the", "the of"], '"of the"', "simple") == [0]
