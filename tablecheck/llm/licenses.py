"""Licence scan by the digest of a canonical text.

A text is made canonical (case, punctuation, copyright lines, equivalent spellings, white
space) and hashed; the digests are joined with those of known licences. A whole text is
looked up as such, and each of its lines against the same table, which holds the usual
one-line notices beside the licence texts. Long licences lie in ``license_texts`` as files
named by their identifier; those with an appendix on their use are known without it too.

Rules for odd input: NULL and texts without a letter or digit have the digest of the
empty text and no licence; a licence named twice is listed once; rows that repeat an
identifier share the licences of their lines; a NULL identifier is one like any other.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Known licences beyond this number are joined by a shuffle.
MOST_BROADCAST = 100_000

# Pairs of spellings that licences use for the same word, after lower case.
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
    ("non-commercial", "noncommercial"), ("per cent", "percent"), ("whilst", "while"),
    ("acknowledgement", "acknowledgment"), ("organisation", "organization"),
    ("favour", "favor"), ("fulfilment", "fulfillment"), ("judgement", "judgment"),
    ("copyright holder", "copyright owner"), ("http://", "https://"), ("&", " and "),
    ("©", " copyright "), ("(c)", " copyright "),
]

# Texts of licences and their usual notices.
DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
    "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    'software and associated documentation files (the "Software"), to deal in the Software '
    "without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
    "to whom the Software is furnished to do so, subject to the following conditions: The above "
    "copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software. " + DISCLAIMER
)
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted"
)
ISC_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO '
    "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
    "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
    "OR PERFORMANCE OF THIS SOFTWARE."
)
BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: 1. Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution."
)
BSD_THIRD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used "
    "to endorse or promote products derived from this software without specific prior written "
    "permission."
)
BSD_DISCLAIMER = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY '
    "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event "
    "will the authors be held liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial "
    "applications, and to alter it and redistribute it freely, subject to the following "
    "restrictions: 1. The origin of this software must not be misrepresented; you must not claim "
    "that you wrote the original software. If you use this software in a product, an "
    "acknowledgment in the product documentation would be appreciated but is not required. 2. "
    "Altered source versions must be plainly marked as such, and must not be misrepresented as "
    "being the original software. 3. This notice may not be removed or altered from any source "
    "distribution."
)
#: Ends the terms of a licence; what follows says how to apply it.
LAST_TERM = "END OF TERMS AND CONDITIONS"


def _long_texts() -> list[tuple[str, str]]:
    found = []
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text = path.read_text("utf-8")
        terms, end, _ = text.partition(LAST_TERM)
        found.append((path.stem, text))
        if end:
            found += [(path.stem, terms), (path.stem, terms + end)]
    return found


KNOWN_TEXTS = _long_texts() + [
    ("MIT", MIT),
    ("MIT", "MIT License " + MIT),
    ("MIT", "The MIT License (MIT) " + MIT),
    ("ISC", ISC_GRANT + ", provided that the above copyright notice and this permission notice "
     "appear in all copies. " + ISC_DISCLAIMER),
    ("0BSD", ISC_GRANT + ". " + ISC_DISCLAIMER),
    ("BSD-2-Clause", BSD_GRANT + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_GRANT + BSD_THIRD + BSD_DISCLAIMER),
    ("Zlib", ZLIB),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
]

#: A line that only says who holds the copyright: the sign or word, then a year.
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©)[^\n]*[0-9]{4}[^\n]*$"
#: All white space, punctuation and signs of ASCII, and the usual typographic ones.
SEPARATORS = r"[\x00-\x2f\x3a-\x60\x7b-\x7f“”‘’«»–—…·•\x{00a0}]+"


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, one spelling, words and digits joined by one space."""
    value = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    value = F.regexp_replace(value, COPYRIGHT_LINE, " ")
    for other, usual in SPELLINGS:
        value = F.replace(value, F.lit(other), F.lit(usual))
    return F.trim(F.regexp_replace(value, SEPARATORS, " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_licenses(spark: SparkSession, texts: list[tuple[str, str]] = KNOWN_TEXTS) -> DataFrame:
    """(license, digest) of known texts, each digest once."""
    known = spark.createDataFrame(texts, "license string, text string")
    return known.select("license", digest(F.col("text")).alias("digest")).dropDuplicates(["digest"])


def find_licenses(
    df: DataFrame, id_column: str, text_column: str, known: DataFrame
) -> DataFrame:
    """One row for each row: digest, licence of the whole text, licences of its lines.

    ``known`` has one row for each digest. Lines travel only if they match: they are
    joined with the known digests before anything is shuffled.
    """
    small = known.count() <= MOST_BROADCAST
    lookup = F.broadcast(known) if small else known
    texts = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    whole = texts.select("id", digest(F.col("text")).alias("text_digest"))
    whole = whole.join(
        lookup.select(F.col("digest").alias("text_digest"), "license"), "text_digest", "left"
    )
    lines = texts.select("id", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.where(F.trim("line") != "").select("id", digest(F.col("line")).alias("digest"))
    found = (
        lines.join(lookup, "digest")
        .groupBy(F.col("id").alias("found_id"))
        .agg(F.array_sort(F.collect_set("license")).alias("line_licenses"))
    )
    none = F.array().cast("array<string>")
    return whole.join(found, F.col("id").eqNullSafe(F.col("found_id")), "left").select(
        "id",
        "text_digest",
        "license",
        F.coalesce("line_licenses", none).alias("line_licenses"),
    )
