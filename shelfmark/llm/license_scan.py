"""License scan with DataFrame functions only: MinHash over overlapping windows, exact verification.

Template shingles (k words) are cut into pieces of at most ``PIECE`` shingles, equal but for one; the
text is covered by windows of ``WINDOW`` shingles, one every ``STEP``, so any stretch of PIECE
shingles lies whole in one of them.  A piece of p shingles, c of them in the text, and a window over
that stretch have a Jaccard similarity of J = c / (WINDOW + p - c) at least.  With bands of one row,
as many minhashes are taken for a template as find one that is held to ``percent`` % with a
probability of 1 - ``MISS`` (``bands_for``; at 80 % 16 for five shingles, 20 for three, few for long
ones, of which many pieces can be met).  Shingles that stand apart
from each other lie in more windows, each with its own chance.  A template of one shingle is met by
that shingle itself, with certainty.  Each meeting is verified by the exact share of the template's
shingles in the whole document.

Templates are a small parameter (at most ``MOST_PIECES`` pieces, checked), so their keys are
broadcast; the documents are never shuffled, only the found pairs are aggregated.  The windows'
rows hold a position and a key; the text's hash list is read in place, not copied into them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, with_defaults

PIECE = 5
WINDOW = 8
STEP = 4
MISS = 1e-4
MOST_PIECES = 20_000

# fixed values: the customary short notices of public licenses
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# fixed values: full texts of short public licenses, without their copyright lines
FULL_TEXTS = {
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" "
        "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
}
TEMPLATES = NOTICES | FULL_TEXTS


def _with_words(df: DataFrame) -> DataFrame:
    """``words``: a text's lower-case runs of letters and digits."""
    return df.withColumn("words", F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def _with_shingles(df: DataFrame, k: int) -> DataFrame:
    """``h`` for ``words``: the hashes of its runs of k words, in text order; rows of fewer words go."""
    grams = F.transform(F.sequence(F.lit(0), F.size("words") - k),
                        lambda i: F.xxhash64(*[F.get(F.col("words"), i + j) for j in range(k)]))
    return df.where(F.size("words") >= k).withColumn("h", grams).drop("words", "text")


def bands_for(n: int, percent: int) -> int:
    """Minhashes that find a template of ``n`` shingles in a text that holds ``percent`` % of them, but for ``MISS``.

    If c of a piece's shingles make it count, the share leaves m pieces at least that count; every
    one of them misses a band with probability 1 - J(c).  The c that needs fewest bands is taken.
    """
    pieces = -(-n // PIECE)
    size = -(-n // pieces)
    need = -(-percent * n // 100)
    best = None
    for c in range(1, size + 1):
        sure = -(-(need - pieces * (c - 1)) // (size - c + 1))  # the others hold c - 1 each at most
        if sure > 0:
            bands = math.ceil(math.log(MISS) / (sure * math.log(1 - c / (WINDOW + size - c))))
            best = bands if best is None else min(best, bands)
    return best


def _low(hashes: list[Column], function: Column) -> Column:
    """The smallest hash of the given ones, nulls aside, under a numbered function."""
    return F.least(*[F.when(h.isNotNull(), F.xxhash64(h, function)) for h in hashes])


def _pairs(docs: DataFrame, known: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, license_id, n_shingles, n_found) of (doc_id, words) and templates (license_id, words) by k-word shingles."""
    own = _with_shingles(known, k).select("license_id", F.array_distinct("h").alias("own"))
    count = F.ceil(F.size("own") / F.lit(PIECE)).cast("int")
    cut = "transform(sequence(0, n - 1), i -> slice(own, int(i * size(own) div n) + 1, int((i + 1) * size(own) div n - i * size(own) div n)))"
    pieces = own.withColumn("n", count).withColumn("w", F.explode(F.expr(cut)))
    total, sizes = pieces.agg(F.count("*"), F.collect_set(F.size("own"))).first()  # at most as many sizes as templates
    if total > MOST_PIECES:
        raise ValueError(f"{total} template pieces, at most {MOST_PIECES}: scan with parts of the templates")
    needed = {n: bands_for(n, percent) for n in sizes if n > 1}
    bands = max(needed.values(), default=0)
    per = bands + (STEP if 1 in sizes else 0)  # keys a window: its minhashes, and the shingles of its first STEP places
    if not per:  # no templates
        return docs.where("false").select("doc_id", F.lit("").alias("license_id"), F.lit(0).alias("n_shingles"), F.lit(0).alias("n_found"))

    last = F.create_map(*[F.lit(x) for n, b in {**needed, 1: 1}.items() for x in (n, b - 1)])
    keys = pieces.select("license_id", "own", "w", F.explode(F.sequence(F.lit(0), last[F.size("own")])).alias("f"))
    keys = keys.select("license_id", "own", F.when(F.size("own") == 1, F.get("w", F.lit(0))).otherwise(
        _low([F.get("w", F.lit(j)) for j in range(PIECE)], F.col("f"))).alias("key")).distinct()

    windows = F.ceil(F.size("h") / F.lit(STEP)).cast("int")
    # one generator over (window, function), free of lambdas, so that it is compiled and ``h`` stays where it is
    spread = _with_shingles(docs, k).select("doc_id", "h", F.explode(F.sequence(F.lit(0), windows * per - 1)).alias("slot"))
    spread = spread.withColumn("start", F.expr(f"int(slot div {per}) * {STEP}")).withColumn("f", F.col("slot") % per)
    single = F.get("h", F.col("start") + F.col("f") - bands)
    many = _low([F.get("h", F.col("start") + j) for j in range(WINDOW)], F.col("f")) if bands else single
    # never null, so the join adds no filter that would work the key out a second time
    spread = spread.select("doc_id", "h", F.coalesce(F.when(F.col("f") < bands, many).otherwise(single), F.lit(0)).alias("key"))
    hits = spread.join(F.broadcast(keys), "key")  # at most MOST_PIECES pieces' keys
    return hits.select("doc_id", "license_id", F.size("own").alias("n_shingles"), F.size(F.array_intersect("own", "h")).alias("n_found"))


def license_scan(docs: DataFrame, templates: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Pairs (doc_id, license_id, n_shingles, n_found): the document holds the template.

    A document (doc_id, text) holds a template (license_id, text) if at least ``percent`` % (1 to 100) of the
    template's distinct k-word shingles occur in the text.  A template of fewer than k words is one
    shingle, its whole sequence, and is searched at its own length.  Templates and texts without words,
    null texts and rows with a null id take no part.  Repeated rows give one pair; if a
    license_id has several texts, the counts are of the best.  Other columns are ignored.
    """
    if not 1 <= percent <= 100:
        raise ValueError(f"percent is from 1 to 100, not {percent}")
    prepare(docs.sparkSession)
    docs = _with_words(with_defaults(docs, {"doc_id": "long", "text": "string"}).where("doc_id IS NOT NULL"))
    known = _with_words(with_defaults(templates, {"license_id": "string", "text": "string"}).where("license_id IS NOT NULL"))
    lengths = sorted(r.n for r in known.select(F.least(F.size("words"), F.lit(k)).alias("n")).where("n > 0").distinct().collect())  # at most k
    found = None
    for n in lengths or [k]:
        part = _pairs(docs, known.where(F.size("words") == n) if n < k else known, n, percent)
        found = part if found is None else found.unionAll(part)
    return (found.where(f"100 * n_found >= {percent} * n_shingles")
            .groupBy("doc_id", "license_id").agg(F.max(F.struct("n_found", "n_shingles")).alias("best"))
            .select("doc_id", "license_id", F.col("best.n_shingles").alias("n_shingles"), F.col("best.n_found").alias("n_found")))
