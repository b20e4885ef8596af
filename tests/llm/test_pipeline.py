"""The pipeline against brute force on the smallest tables."""

import re

import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece

import corpus_pipeline
from test_operators import without_repeated_lines

DIR = "/root/testdata/sf0.001"


def shingles(t):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", t)]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_stage_names_and_run(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, DIR).collect()}
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{DIR}/documents.parquet").to_pylist()}
    texts = {i: t for i, t in docs.items() if t and any(c.isalpha() for c in t)}
    cut = {i: text for (i, _), (text, gone) in without_repeated_lines(texts.items()).items() if not gone or text.strip()}
    sets = {i: shingles(t) for i, t in cut.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    items = [shingles(r["text"]) for r in pq.read_table(f"{DIR}/benchmark.parquet").to_pylist() if len(r["text"].split()) >= 5]
    want = {i for i in sets if find(i) == i and not any(100 * len(x & sets[i]) >= 80 * len(x) for x in items)}
    assert set(got) == want
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i in want:
        assert got[i]["text"] == cut[i] and list(got[i]["piece_ids"]) == sp.encode(cut[i]) and got[i]["round_trip"]


def test_near_dedup_keeps_every_text_of_an_id(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a, "y"), (1, b, "x"), (1, a, "x"), (2, a, "x"), (None, a, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.near_dedup(spark, docs, DIR).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, a, "x"), (1, b, "x"), (None, a, "x")], key=str)


CLASH = ["score", "lang_pred", "piece_ids", "decoded", "n_tokens", "round_trip", "lines_removed", "cuts", "cut_doc", "rest", "tkey", "component_id", "kept", "node"]


def rows_of(docs):
    return sorted((str(r[0]), str(r["text"]), *[r[c] for c in CLASH if c in r.__fields__ and c not in ("piece_ids", "n_tokens", "round_trip")]) for r in docs.collect())


def test_every_stage_passes_columns_called_like_its_own(spark):
    plain = spark.read.parquet(f"{DIR}/documents.parquet")
    docs = plain.select("*", *[(plain.doc_id + i).cast("string").alias(c) for i, c in enumerate(CLASH)])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DIR)
        same = stage(spark, plain, DIR)
        if name != "sentencepiece":
            assert out.columns == docs.columns and same.columns == plain.columns
        else:
            assert out.columns == [c for c in docs.columns if c not in ("piece_ids", "n_tokens", "round_trip")] + ["piece_ids", "n_tokens", "round_trip"]
            assert sorted(map(tuple, out.select("doc_id", "n_tokens", "round_trip").collect())) == sorted(map(tuple, same.select("doc_id", "n_tokens", "round_trip").collect()))
        got = {r.doc_id: r for r in out.collect()}
        assert {i: r.text for i, r in got.items()} == {r.doc_id: r.text for r in same.collect()}
        for i, r in got.items():
            assert all(r[c] == str(i + n) for n, c in enumerate(CLASH) if c not in ("piece_ids", "n_tokens", "round_trip")), name


def test_every_stage_takes_empty_tables_and_null_texts(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    none = spark.createDataFrame([], schema)
    nulls = spark.createDataFrame([(1, None, None, None, None), (None, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0)], schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, DIR)
        assert out.collect() == [] and out.columns[:5] == none.columns
        kept = stage(spark, nulls, DIR).count()
        assert kept == {"language_id": 0, "near_dedup": 3}.get(name, 4), name
