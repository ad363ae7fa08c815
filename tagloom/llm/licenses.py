"""License scan: MinHash bands over overlapping windows, then exact shingle containment. DataFrame expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import ALNUM, lower_az, words
from tagloom.session import materialize

_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
          "documentation files (the Software), to deal in the Software without restriction")
_MIT = (_GRANT + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_REDISTRIBUTION = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
                   "provided that the following conditions are met")
_BSD = (_REDISTRIBUTION + ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission. ")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
            "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
            "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
            "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
            "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
            "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
           "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
           "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
           "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.")
_MPL = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at http://mozilla.org/MPL/2.0/.")


def _gnu(what: str, license: str, version: str) -> str:
    """The header that the GNU licenses give for source files."""
    return (f"{what} is free software; you can redistribute it and/or modify it under the terms of the GNU {license} as published by the Free "
            f"Software Foundation; either version {version} of the License, or (at your option) any later version. {what} is distributed in "
            "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
            f"PARTICULAR PURPOSE. See the GNU {license} for more details. You should have received a copy of the GNU {license} along with "
            f"{what.lower()}.")


def _cc(kind: str) -> str:
    return f"This work is licensed under a Creative Commons {kind} 4.0 International License."


# Short notices, standard headers of source files, and whole texts of the short licenses.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("mit", "Released under the MIT License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("mit-grant", _GRANT),
    ("bsd-redistribution", _REDISTRIBUTION),
    ("mit-text", _MIT),
    ("bsd-2-clause-text", _BSD + _BSD_END),
    ("bsd-3-clause-text", _BSD + _BSD_THIRD + _BSD_END),
    ("isc-text", _ISC),
    ("apache-2.0-header", _APACHE),
    ("mpl-2.0-header", _MPL),
    ("gpl-2.0-header", _gnu("This program", "General Public License", "2")),
    ("gpl-3.0-header", _gnu("This program", "General Public License", "3")),
    ("lgpl-2.1-header", _gnu("This library", "Lesser General Public License", "2.1")),
    ("lgpl-3.0-header", _gnu("This program", "Lesser General Public License", "3")),
    ("agpl-3.0-header", _gnu("This program", "Affero General Public License", "3")),
    ("cc-by-4.0-notice", _cc("Attribution")),
    ("cc-by-sa-4.0-notice", _cc("Attribution-ShareAlike")),
    ("cc-by-nd-4.0-notice", _cc("Attribution-NoDerivatives")),
    ("cc-by-nc-4.0-notice", _cc("Attribution-NonCommercial")),
    ("cc-by-nc-sa-4.0-notice", _cc("Attribution-NonCommercial-ShareAlike")),
    ("cc-by-nc-nd-4.0-notice", _cc("Attribution-NonCommercial-NoDerivatives")),
]


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "template_id string, text string")


def _shingles(w: Column, k: int) -> Column:
    """Hashes of the k-word shingles of ``w``; of the whole when it is shorter; none of an empty one."""
    return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(F.slice(w, i + 1, k)))) \
        .when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<long>"))


def _bands(shingles: Column, n_bands: int) -> Column:
    """One min-hash for each band: the smallest of the shingles hashed with the band's number."""
    return F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda b: F.struct(
        b.alias("band"), F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, b))).alias("sig")))


def bands_for(containment: float, widest: float, miss: float) -> int:
    """Bands of one row so that a window that holds ``containment`` of a template, and is ``widest`` times as long,
    shares a band with it but with probability ``miss``: each band meets with the Jaccard similarity of the two sets."""
    jaccard = containment / (1 + widest - containment)
    return math.ceil(math.log(miss) / math.log(1 - jaccard))


def scan(docs: DataFrame, templates: DataFrame, shingle: int = 5, containment: float = 0.8, miss: float = 1e-6) -> DataFrame:
    """``doc_id, template_id, start_word, containment``: the best window of each document for each template.

    Templates fall into classes by their number of shingles (a class is [2^c, 2^(c+1))); a class scans the text in
    windows of 2 * 2^(c+1) shingles, each beginning half a window after the last, so every run as long as a template
    lies in one window whole. Windows and templates meet where a MinHash band agrees; the number of bands follows from
    ``containment`` and ``miss``. Each candidate is then verified exactly: the share of the template's shingles that
    the window holds.

    A window that passes holds a share ``containment`` of a template's shingles, so it holds one of any larger rest.
    Texts and windows without any of the chosen words (greedily, the longest that hit more than ``1 - containment`` of the
    shingles) are left out before hashing: nothing is lost by it. Case (A-Z) and punctuation do not count. Null and
    empty texts match nothing; a template without words is ignored; rows that share a ``doc_id`` share matches."""
    spark = docs.sparkSession
    lists = templates.select(F.col("template_id").cast("string").alias("template_id"),
                             words(lower_az(F.col("text").cast("string")), ALNUM).alias("w")).where(F.size("w") > 0)
    rows = lists.collect()  # the template list is a parameter of the scan, not corpus data
    empty = "doc_id long, template_id string, start_word int, containment double"
    if not rows:
        return spark.createDataFrame([], empty)
    anchors = set()
    for r in rows:
        runs = list({tuple(r.w[i:i + shingle]) for i in range(max(1, len(r.w) - shingle + 1))})
        least = containment * len(runs) - 1e-9  # so many of them are in any window that passes
        while runs and len(runs) >= least:
            best = max({x for run in runs for x in run}, key=lambda x: (sum(x in run for run in runs) * len(x) ** 4, x))
            anchors.add(best)
            runs = [run for run in runs if best not in run]
    held = F.array(*[F.lit(x) for x in sorted(anchors)])
    known = lists.select("template_id", _shingles(F.col("w"), shingle).alias("ts")) \
        .withColumn("ts", F.array_distinct("ts")).withColumn("class", F.floor(F.log2(F.size("ts").cast("double"))).cast("int"))
    classes = sorted(r[0] for r in known.select("class").distinct().collect())
    n_bands = bands_for(containment, 4, miss)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # cheap test of the whole text first; the word test after it decides
    low, some = F.lower("text"), F.lit(False)
    for x in sorted(anchors):
        some = some | F.contains(F.col("low"), F.lit(x.lower()))
    texts = texts.withColumn("low", low).where(some) \
        .select("doc_id", words(lower_az(F.col("text")), ALNUM).alias("w")).where(F.arrays_overlap("w", held))
    texts = materialize(texts, "license-texts")  # read once, however many classes there are
    out = None
    for c in classes:
        width = 2 << (c + 1)  # shingles in a window
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - shingle), F.lit(width // 2))
        window = texts.select("doc_id", "w", F.explode(starts).alias("at")) \
            .select("doc_id", "at", F.slice("w", F.col("at") + 1, F.lit(width + shingle - 1)).alias("part")) \
            .where(F.arrays_overlap("part", held)) \
            .select("doc_id", "at", F.array_distinct(_shingles(F.col("part"), shingle)).alias("ws")) \
            .select("doc_id", "at", "ws", F.explode(_bands(F.col("ws"), n_bands)).alias("b"))
        wanted = known.where(F.col("class") == c).select("template_id", "ts", F.explode(_bands(F.col("ts"), n_bands)).alias("t"))
        met = window.join(F.broadcast(wanted), F.col("b") == F.col("t"))
        share = F.size(F.array_intersect("ws", "ts")) / F.size("ts")
        part = met.select("doc_id", "template_id", F.col("at").alias("start_word"), share.alias("containment")) \
            .where(F.col("containment") >= containment)
        out = part if out is None else out.union(part)
    return out.groupBy("doc_id", "template_id").agg(F.max(F.struct("containment", (-F.col("start_word")).alias("s"))).alias("m")) \
        .select("doc_id", "template_id", (-F.col("m.s")).alias("start_word"), F.col("m.containment").alias("containment"))


def license_report(docs: DataFrame, templates: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_licenses, license_ids`` (sorted, comma-joined), ``best_containment``."""
    found = scan(docs, templates, **options).groupBy(F.col("doc_id").alias("_id")).agg(
        F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("template_id")), ",").alias("ids"),
        F.max("containment").alias("best"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left") \
        .select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_licenses"), F.coalesce("ids", F.lit("")).alias("license_ids"),
                F.coalesce("best", F.lit(0.0)).alias("best_containment"))
