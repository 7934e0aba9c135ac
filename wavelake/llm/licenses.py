"""License scan by diagonal voting (operator 8, built-ins only).

Every rolling pair of words (k = 2, the length of the shortest phrase) of
every document is joined to the same pairs of the templates by hash; the
words themselves must be equal too.  A match at document word p and template
word q votes for the diagonal p - q.

* A base phrase of m words stands at a place exactly if its diagonal there
  has m - 1 votes.
* The longer templates tolerate edits.  Votes are summed per diagonal; the
  diagonals of one document and template within ``NEAR`` of each other merge
  (an inserted or lost word moves the rest of a copy by one).  A merged span is
  verified by the share of distinct template pairs that it holds; of one that
  runs on over more than twice the template, because pairs of it are repeated
  beside the copy, each window of as many diagonals as the template has words
  is verified for itself.

The templates are notices and whole license texts of any length.  Their table
is fixed in this module, some thousand rows, and is broadcast.  Votes are counted in the task that reads a document before
anything is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower

#: base phrases and their labels (fixed values)
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: opening sentences of public licenses and their labels (fixed values)
TEMPLATES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files": "mit-text",
    "licensed under the apache license version 2 0": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "released under the mit license": "mit-notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met": "bsd-text",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc-text",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation": "gpl-text",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
}
#: whole texts of public licenses by their labels (fixed values)
TEXTS = {
    "mit-whole": """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc-whole": """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "bsd-2-whole": """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "zlib-whole": """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution.""",
}
#: pairs that one mask holds
MASK = 62
#: diagonals at most this far apart merge
NEAR = 2
#: share of a template's pairs that a merged span must hold
SHARE = 0.75


def _phrases() -> list[tuple[int, str, bool, list[str]]]:
    """tid, label, whether it is a base phrase, and words of every template."""
    every = [*((label, True, phrase) for phrase, label in BASE.items()),
             *((label, False, phrase) for phrase, label in TEMPLATES.items()),
             *((label, False, text) for label, text in TEXTS.items())]
    return [(tid, label, base, re.findall("[0-9a-z]+", text.lower())) for tid, (label, base, text) in enumerate(every)]


def masks() -> int:
    """Masks that hold the pairs of the longest template."""
    return 1 + max(len(w) - 2 for *_, w in _phrases()) // MASK


def templates(spark: SparkSession) -> DataFrame:
    """tid, label, base, pairs (their number), q, part and bit (mask of the
    pair and its place in it), w1, w2: one row per pair."""
    rows = [(tid, label, base, len(w) - 1, q, q // MASK, 1 << q % MASK, a, b) for tid, label, base, w in _phrases()
            for q, (a, b) in enumerate(zip(w, w[1:], strict=False))]
    return spark.createDataFrame(rows, "tid int, label string, base boolean, pairs int, q int, part int, bit bigint, "
                                       "w1 string, w2 string")


def votes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Votes per row, template and diagonal; a row without any has one line
    with a null template.  ``row`` tells rows of one id apart."""
    text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    spaced = F.trim(F.regexp_replace(text, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))  # one blank between words
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
                       spaced.alias("s"))
    base = base.select("row", "doc_id", F.when(F.col("s") != "", F.split("s", " ")).otherwise(
        F.array().cast("array<string>")).alias("w"))
    base = base.select("row", "doc_id", F.size("w").cast("bigint").alias("n_words"), F.posexplode_outer(
        F.zip_with("w", F.slice("w", F.lit(2), F.greatest(F.size("w"), F.lit(1))),
                   lambda a, b: F.struct(a.alias("w1"), b.alias("w2")))).alias("p", "g"))
    grams = base.select("row", "doc_id", "n_words", "p", "g.w1", "g.w2",
                        F.xxhash64("g.w1", "g.w2").alias("h"))
    t = templates(docs.sparkSession).withColumn("h", F.xxhash64("w1", "w2"))
    t = t.select("h", "tid", "label", "base", "pairs", "q", "part", "bit", F.col("w1").alias("t1"), F.col("w2").alias("t2"))
    joined = grams.join(F.broadcast(t), (grams["h"] == t["h"]) & (grams["w1"] == t["t1"]) & (grams["w2"] == t["t2"]),
                        "left")
    return joined.groupBy("row", "doc_id", "n_words", "tid", "label", "base", "pairs",
                          (F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.count("tid").alias("votes"), F.min("q").alias("first_q"), F.max("q").alias("last_q"),
        *[F.coalesce(F.bit_or(F.when(F.col("part") == k, F.col("bit"))), F.lit(0)).alias(f"seen_{k}")
          for k in range(masks())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score and spans (label, first word, end, share of the
    template) of what was verified.

    score is the largest share of any template's pairs found on merged
    diagonals (1 for a whole phrase).  Null and empty texts and texts of one
    word have no pairs: zero counts, null places, empty labels.  Repeated rows
    are scanned each for itself; other columns are not read."""
    found = votes(docs, id_col, text_col)
    # neighbouring diagonals of one document and template share a run number
    w = Window.partitionBy("row", "tid").orderBy("diagonal")
    jump = F.when((F.col("diagonal") - F.lag("diagonal").over(w) <= NEAR) & ~F.col("base"), 0).otherwise(1)
    runs = found.withColumn("jump", jump).withColumn("run", F.sum("jump").over(w))
    # windows of as many diagonals as the template has words; their span is at most twice the template
    runs = runs.withColumn("place", F.col("diagonal") / (F.col("pairs") + 1))
    window = "(PARTITION BY row, tid, run ORDER BY place RANGE BETWEEN CURRENT ROW AND 1.000001D FOLLOWING)"
    parts = range(masks())
    runs = runs.withColumn("window", F.struct(
        F.expr("+".join(f"bit_count(bit_or(seen_{k}) OVER {window})" for k in parts)).alias("held"),
        F.expr(f"-min(diagonal + first_q) OVER {window}").cast("bigint").alias("start"),
        F.expr(f"max(diagonal + last_q + 2) OVER {window}").cast("bigint").alias("stop")))
    spans = runs.groupBy("row", "tid", "run").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "n_words", "label", "base", "pairs")],
        F.struct(sum((F.bit_count(F.bit_or(f"seen_{k}")) for k in parts), F.lit(0)).alias("held"),
                 (-F.min(F.col("diagonal") + F.col("first_q"))).cast("bigint").alias("start"),
                 F.max(F.col("diagonal") + F.col("last_q") + 2).cast("bigint").alias("stop")).alias("all"),
        F.max("window").alias("window"))
    # the whole span where it is short enough, else the window that holds most
    whole = F.col("all.stop") + F.col("all.start") <= 2 * (F.col("pairs") + 1)
    spans = spans.withColumn("span", F.when(whole, F.col("all")).otherwise(F.col("window")))
    spans = spans.select("row", "doc_id", "n_words", "label", "base", (-F.col("span.start")).alias("start"),
                         F.col("span.stop").alias("stop"), (F.col("span.held") / F.col("pairs")).alias("share"))
    spans = spans.withColumn("ok", F.col("share") >= F.when(F.col("base"), 1.0).otherwise(SHARE))
    is_base = F.col("ok") & F.col("base")
    return spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.count_if(is_base).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("ok"), F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(F.col("ok"), F.col("share"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_set(F.when(F.col("ok"), F.struct("start", "stop", "label", "share")))).alias("spans"),
    ).drop("row")


def oracle_sql() -> str:
    """The same counts and labels as DuckDB SQL over ``documents``."""
    rows = [f"({tid}, '{label}', {base}, {len(w) - 1}, {q}, '{a}', '{b}')" for tid, label, base, w in _phrases()
            for q, (a, b) in enumerate(zip(w, w[1:], strict=False))]
    return f"""
WITH t(tid, label, base, pairs, q, w1, w2) AS (VALUES {", ".join(rows)}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
g AS (SELECT r, p, w[p + 1] AS w1, w[p + 2] AS w2
      FROM (SELECT r, w, unnest(range(0, len(w) - 1)) AS p FROM d)),
v AS (SELECT r, tid, label, base, pairs, p - q AS diagonal, q FROM g JOIN t USING (w1, w2)),
j AS (SELECT *, CASE WHEN NOT base AND diagonal - lag(diagonal) OVER (PARTITION BY r, tid ORDER BY diagonal)
        <= {NEAR} THEN 0 ELSE 1 END AS jump FROM (SELECT DISTINCT r, tid, label, base, pairs, diagonal FROM v)),
c AS (SELECT *, sum(jump) OVER (PARTITION BY r, tid ORDER BY diagonal) AS run FROM j),
x AS (SELECT r, tid, run, c.label, c.base, c.pairs, diagonal, q FROM c JOIN v USING (r, tid, diagonal)),
s AS (SELECT r, tid, run, label, base, pairs, count(DISTINCT q) AS held, min(diagonal + q) AS start,
        max(diagonal + q + 2) AS stop FROM x GROUP BY ALL),
m AS (SELECT c.r, c.tid, c.run, c.diagonal, count(DISTINCT x.q) AS held FROM c JOIN s USING (r, tid, run)
      JOIN x ON x.r = c.r AND x.tid = c.tid AND x.run = c.run
        AND x.diagonal BETWEEN c.diagonal AND c.diagonal + c.pairs + 1
      WHERE s.stop - s.start > 2 * (c.pairs + 1) GROUP BY ALL),
k AS (SELECT r, tid, run, label, base, pairs, start, coalesce(best, s.held) AS held,
        coalesce(best, s.held) >= CASE WHEN base THEN pairs ELSE pairs * {SHARE} END AS ok
      FROM s LEFT JOIN (SELECT r, tid, run, max(held) AS best FROM m GROUP BY ALL) USING (r, tid, run)),
a AS (SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
        max(start) FILTER (base) AS last_word, array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',')
        AS base_labels, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(held / pairs) AS score
      FROM k WHERE ok GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN a USING (r)
"""
