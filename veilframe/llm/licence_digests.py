"""Licence scan by canonical digest: a text is a known licence if its canonical form has a known digest.

Canonical form: lower case, copyright lines gone, equivalent spellings made one,
every run of other characters than letters and digits one space. All of it is
SQL functions; whole texts are hashed and joined by digest.
"""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm.common import saved

# Spellings that licence texts use for the same word.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("licencing", "licensing"),
    ("sublicence", "sublicense"), ("sub license", "sublicense"), ("whilst", "while"), ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("favour", "favor"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labour", "labor"),
    ("merchantibility", "merchantability"), ("non infringement", "noninfringement"), ("organisation", "organization"),
    ("per cent", "percent"), ("programme", "program"), ("recognised", "recognized"), ("redistributions", "redistribution"),
    ("utilisation", "utilization"), ("wilful", "willful"), ("https", "http"), ("copyright owner", "copyright holder"),
)
#: A notice line, not a line of terms that happens to begin with the word. To Java's engine d makes \n the only line end.
COPYRIGHT_LINE = r"(?md)^[ \t*#/;-]*(copyright[ \t:]*(\(c\)|©|[0-9]{4}|by |<|\[)|\(c\)|©|all rights reserved)[^\n]*$"
OTHER = r"[^\p{L}\p{N}]+"

#: Digests of canonical whole texts by SPDX identifier.
DIGESTS = Path(__file__).with_name("licence_digests.csv")
# Public licence texts and notices, by SPDX identifier.
MIT_TERMS = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_TERMS = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
KNOWN = (
    ("MIT", MIT_TERMS), ("MIT", "MIT License\n\n" + MIT_TERMS), ("MIT", "The MIT License (MIT)\n\n" + MIT_TERMS),
    ("ISC", ISC_TERMS), ("ISC", "ISC License\n\n" + ISC_TERMS), ("Apache-2.0", APACHE_NOTICE),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "Released into the public domain under CC0 1.0."),
)


def plain_words(text: Column) -> Column:
    """Lower case words with one space around each; copyright lines are gone, null is ' '."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    return F.regexp_replace(F.concat(F.lit(" "), out, F.lit(" ")), OTHER, " ")


def one_spelling(words: Column) -> Column:
    for other, one in SPELLINGS:
        words = F.replace(words, F.lit(f" {other} "), F.lit(f" {one} "))
    return words


def with_digest(df: DataFrame, text: str) -> DataFrame:
    """Adds canonical and key, the digest of the canonical form; for null they are '' and its digest.

    Few texts have a spelling to change, and one search for all of them finds those.
    Each step is a column of its own, as an expression used twice would be worked out
    twice; and key cannot be null, as a join on it would else filter by it first.
    """
    words = F.col("__words")
    other = f" ({'|'.join(other for other, _ in SPELLINGS)}) "
    out = df.withColumn("__words", plain_words(F.col(text)))
    out = out.withColumn("canonical", F.trim(F.when(words.rlike(other), one_spelling(words)).otherwise(words))).drop("__words")
    return out.withColumn("key", F.sha2("canonical", 256))


def known_digests(path: Path = DIGESTS) -> list[tuple[str, str]]:
    """(licence, digest) of the canonical forms of further whole texts, from a file of a fixed size."""
    with path.open(newline="") as file:
        return [(row["licence"], row["digest"]) for row in csv.DictReader(file)]


def known_licences(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN, digests: Path = DIGESTS) -> DataFrame:
    """licence, digest: one row for each known canonical text; its size is that of the given list and the file ``digests``."""
    texts = with_digest(spark.createDataFrame(list(known), "licence string, body string"), "body").select("licence", F.col("key").alias("digest"))
    further = spark.createDataFrame(known_digests(digests), "licence string, digest string")
    return texts.union(further).groupBy("digest").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """doc_id, digest, licence of every document, and the licences that whole lines of it name.

    ``docs`` (doc_id, text; further columns are ignored), ``known`` (digest, licence).
    ``licence`` is null where the entire text is no known licence; a null, empty or
    all-punctuation text has a null digest and matches nothing. ``line_licences``
    holds, sorted and each once, the licences whose entire canonical text is a line
    of the document; '' if none. Repeated rows give repeated results. A table of
    known digests of at most ``broadcast_rows`` rows is broadcast, a larger one shuffled.
    """
    table = saved(known.select(F.col("digest").alias("key"), "licence").groupBy("key").agg(F.min("licence").alias("licence")))
    small = table.limit(broadcast_rows + 1).count() <= broadcast_rows
    table = F.broadcast(table) if small else table
    # two hashes of id and text name a row: of one alone, ten thousand million rows would have equal ones
    base = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text")).withColumn("row", F.xxhash64("doc_id", "text")).withColumn("check", F.xxhash64(F.lit(1), "text", "doc_id"))
    lines = with_digest(base.select("row", "check", F.explode(F.split("text", "\n")).alias("line")), "line").select("row", "check", "key")
    named = lines.join(table, "key").groupBy("row", "check").agg(F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("line_licences"))
    own = with_digest(base, "text").select("doc_id", "row", "check", "key", F.when(F.col("canonical") != "", F.col("key")).alias("digest"))
    whole = own.join(table, "key", "left")
    return whole.join(named, ["row", "check"], "left").select("doc_id", "digest", "licence", F.coalesce("line_licences", F.lit("")).alias("line_licences"))
