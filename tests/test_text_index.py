"""The positional index returns the rows of the scan on random texts and queries."""

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions.text_search import filter_matching, lexemes, matches
from shelfmark.operators.fulltext import index_documents
from shelfmark.plans.text_index import TextIndex

WORDS = ["running", "runs", "the", "of", "economy", "economies", "red", "small", "gear", "éclair", "x1"]
text = st.lists(st.sampled_from([*WORDS, "The", "RED,", "small-gear", "—", "\n"]), max_size=7).map(" ".join)
quoted = st.lists(st.sampled_from(WORDS), min_size=1, max_size=4).map(lambda w: '"' + " ".join(w) + '"')
piece = st.tuples(st.sampled_from(["", "-"]), st.one_of(st.sampled_from(WORDS), quoted, st.just("small-gear"))).map("".join)
query = st.lists(st.one_of(piece, st.just("or")), min_size=1, max_size=5).map(" ".join)


def _ids(df):
    return sorted(r[0] for r in df.select("i").collect())


@settings(max_examples=6, deadline=None, phases=[Phase.generate])
@given(st.lists(st.one_of(st.none(), text), min_size=1, max_size=12), st.lists(query, min_size=4, max_size=4))
@pytest.mark.parametrize("config", ["english", "simple"])
def test_index_equals_scan(spark, config, texts, queries):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    index = index_documents(df, config, "i", "t")
    for q in queries:
        scan = _ids(df.filter(matches(lexemes(F.col("t"), config), q, config)))
        assert _ids(index.search(q)) == scan, q
        assert _ids(filter_matching(df, F.col("t"), q, config)) == scan, q


def test_repeated_words_in_phrases(spark):
    df = spark.createDataFrame([(1, "a b a b c"), (2, "a b c"), (3, "b a b a"), (4, ""), (5, None), (6, "a a")], "i int, t string")
    index = TextIndex.build(df, "i", F.col("t"), "simple")
    assert _ids(index.search('"a b a"')) == [1, 3]
    assert _ids(index.search('"a a"')) == [6]
    assert _ids(index.search("-a")) == [4] and _ids(index.search("")) == [] and _ids(index.search(None)) == []
    assert _ids(index.search('-"a b" or c')) == [1, 2, 4, 6]


def test_a_frequent_token_meets_the_vocabulary_in_a_split_join(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k) for k in conf}
    docs = spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.concat(F.lit("hot w"), F.col("id") % 400).alias("t")).repartition(8)
    index = index_documents(docs, "english", "id", "t")
    assert index.search("hot").count() == 20000
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        from shelfmark.plans.text_index import token_rows, vocabulary
        folder = index.postings.inputFiles()[0].rsplit("/", 2)[0]
        rows = token_rows(docs, "id", F.col("t"), "english").join(spark.read.parquet(f"{folder}/vocabulary"), "token")
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert vocabulary(docs, F.col("t")).where("token = 'hot'").count() == 1


def test_unknown_configuration_is_refused(spark):
    with pytest.raises(ValueError, match="configuration"):
        TextIndex.build(spark.createDataFrame([(1, "a")], "i int, t string"), "i", F.col("t"), "french")


def test_an_instance_without_a_document_matches_nothing(cat):
    docs = cat.subject_index().documents
    assert docs.count() == cat.doc("instance").where("j IS NOT NULL").count()
