"""License scans: canonical digests of whole texts, hash-joined to the digests of known licenses.

Everything here is column expressions: the scan is one pass over the texts, and the join keeps one row per text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtab.llm.common import packed

# Spellings that license matching treats as the same word.
SPELLINGS = {
    "licence": "license",
    "organisation": "organization",
    "authorisation": "authorization",
    "recognise": "recognize",
    "analyse": "analyze",
    "favour": "favor",
    "honour": "honor",
    "behaviour": "behavior",
    "labour": "labor",
    "centre": "center",
    "fulfil ": "fulfill ",
    "non commercial": "noncommercial",
    "sub license": "sublicense",
    "per cent": "percent",
    "copyright holder": "copyright owner",
}
# License texts and notices, by SPDX identifier.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
KNOWN = {
    "MIT": "MIT License\nCopyright (c) the authors\n"
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software.\n" + _AS_IS,
    "MIT-0": "MIT No Attribution\nCopyright (c) the authors\n"
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so.\n" + _AS_IS,
    "ISC": "ISC License\nCopyright (c) the authors\n"
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_END,
    "0BSD": "BSD Zero Clause License\nCopyright (c) the authors\n"
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted.\n" + _ISC_END,
    "BSD-2-Clause": "BSD 2-Clause License\nCopyright (c) the authors\n" + _BSD_START + _BSD_END,
    "BSD-3-Clause": "BSD 3-Clause License\nCopyright (c) the authors\n"
    + _BSD_START
    + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n" + _BSD_END,
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
}

# A line that begins with a copyright mark, with the line break before it.
_COPYRIGHT = r"(^|\n)[ \t]*(?:copyright|\(c\)|©)[^\n]*"
_SEPARATORS = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Lower case, copyright lines gone, runs of anything but letters and digits as one space, one spelling per word.

    Null stays null; a text of only punctuation becomes empty.
    """
    out = F.regexp_replace(F.lower(text), _COPYRIGHT, "$1")
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(out, _SEPARATORS, " ")), F.lit(" "))
    for variant, word in SPELLINGS.items():
        out = F.replace(out, F.lit(variant), F.lit(word))
    return F.trim(out)


def canonical_sql(text: str) -> str:
    """The same rule as DuckDB SQL."""
    out = f"regexp_replace(lower({text}), '{_COPYRIGHT.replace('?:', '?:')}', '\\1', 'g')"
    out = f"' ' || trim(regexp_replace({out}, '{_SEPARATORS}', ' ', 'g')) || ' '"
    for variant, word in SPELLINGS.items():
        out = f"replace({out}, '{variant}', '{word}')"
    return f"trim({out})"


def known_licenses(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """(license_id, digest) of known texts; of texts with one digest the smallest identifier stands."""
    listed = spark.createDataFrame(sorted((texts or KNOWN).items()), "license_id string, text string")
    return listed.groupBy(F.sha2(canonical(F.col("text")), 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `license_digest`, `canonical_chars` and `license_id` (null: not a known license).

    One row out per row in, repeated rows included. A null text has no digest and matches nothing; an empty or
    punctuation-only text has the digest of the empty string and matches nothing unless an empty text is listed. Columns of
    `docs` with these names are replaced. `known` is not hinted: Spark broadcasts it when its size allows, and a hot digest in a
    shuffled join is split by adaptive execution.
    """
    made = ("license_digest", "canonical_chars", "license_id")
    rows = packed(docs.drop(*made), clean=canonical(F.col(f"`{text}`")))
    rows = rows.select("row", F.sha2("clean", 256).alias("license_digest"), F.length("clean").cast("long").alias("canonical_chars"))
    found = known.select(F.col("digest").alias("license_digest"), "license_id")
    return rows.join(found, "license_digest", "left").select("row.*", *made)
