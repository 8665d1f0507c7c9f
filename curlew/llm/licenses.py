"""Licence scan by canonical digests.

A text is brought to a canonical form: copyright notices go (``RIGHTS``: whole lines, also
behind marks of a comment; a name without a capital, sign or year is no notice), case, punctuation and
white space are levelled, equivalent spellings become one. The SHA-256 of the
form is hash-joined to the digests of known licence texts. Looked up are the whole
document, each of its lines, and each run of lines that begins with the first word
of a known form and has its length, as entire texts of their own, so a licence that
is the document, a notice that is one of its lines and a licence that spans some of
its lines are all found; nothing is matched in part of a line. A text is levelled
once for all: its form is its lines' forms, one after the other. Lines and runs whose
form has another length than every known form cannot have a known digest and are not
hashed. Long licences are known by the digests of their full texts alone.

Defined results: null and empty texts have the digest of the empty form and no
licence; repeated rows of one doc_id share what is found in any of them; an empty
table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.llm.common import stored

# A notice is a line that begins, after marks of a comment, with "copyright" and a year,
# a sign or a holder's name, with a sign and a year or a name, or with the words on all
# rights. Lines of a licence's body may begin with the word as well ("copyright notice",
# "COPYRIGHT HOLDERS"): they stay, wherever the text is wrapped.
RIGHTS = re.compile(r"""(?mx) ^ [^\w(©\n]* (?:
    (?i:copyright) [^\w\n]*? (?: \([cC]\) | © | \d{4}\b | [<\[{][ ]*(?i:y) )
  | (?i:copyright) [^\w\n]+ (?:(?i:by)[^\w\n]+)?
      (?! (?i:and|disclaimers?|holders?|interests?|laws?|licen[cs]es?|notices?|or|owners?|statements?) \b ) [A-Z]
  | \([cC]\) [ \t]* (?: © | \d{4}\b | (?i:copyright)\b )
  | © [ \t]* (?: \d{4}\b | [A-Z<\[] )
  | (?i:all[ ]rights[ ]reserved)
) [^\n]* $""")
RIGHTS_MARKS = ("copyright", "(c)", "©", "all rights reserved")
NULL_SALTS = 64
MARKS = re.compile(r"[^\w\s]+")

# Spellings that count as equal in licence texts.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("catalogue", "catalog"), ("favour", "favor"), ("fulfil", "fulfill"),
    ("initialise", "initialize"), ("labour", "labor"), ("licence", "license"), ("licenced", "licensed"),
    ("licences", "licenses"), ("merchantable", "merchantability"), ("noncommercial", "non commercial"),
    ("organisation", "organization"), ("owner", "holder"), ("programme", "program"), ("sublicence", "sublicense"),
    ("utilise", "utilize"), ("whilst", "while"), ("https", "http"),
]

# Licence texts and the short notices that stand for them.
KNOWN: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
}

# Full texts, by (licence, length of the form, its first word, its digest).
# The digests are those of ``canonical`` over the texts as Debian's base-files package
# ships them (Apache-2.0, BSD, GPL-2, GPL-3, LGPL-2.1, LGPL-3, MPL-2.0). They hold for every
# wrap that leaves the copyright notices in them on lines of their own.
FULL: list[tuple[str, int, str, str]] = [
    ("Apache-2.0", 9887, "apache", "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b"),
    ("BSD-3-Clause", 1361, "redistribution", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("GPL-2.0", 17118, "gnu", "331b500eb3c5ee796906547305df82fff4a35b3aa03c1d3ea84d32078292b2e6"),
    ("GPL-3.0", 33406, "gnu", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.1", 25217, "gnu", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", 7104, "gnu", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-2.0", 14344, "mozilla", "3599de37bcef5820a1933fc9b0c5b5389b95fa5dc39cb6e05f4764ef1c2f2439"),
]


_SPELLED = dict(SPELLINGS)


def canonical_lines(text: str | None) -> Iterator[str]:
    """The canonical forms of the lines of a text that have one."""
    text = text or ""
    low = text.lower()
    if any(mark in low for mark in RIGHTS_MARKS):
        low = RIGHTS.sub("", text).lower()
    for line in MARKS.sub(" ", low).replace("_", " ").split("\n"):
        words = line.split()
        if words:
            if not _SPELLED.keys().isdisjoint(words):
                words = [_SPELLED.get(w, w) for w in words]
            yield " ".join(words)


def canonical(text: str | None) -> str:
    return " ".join(canonical_lines(text))


def known_digests(known: Mapping[str, list[str]] = KNOWN) -> tuple[list[tuple[str, str]], dict[str, list[int]]]:
    """(digest, licence) of the known texts, and the lengths of their forms by first word."""
    forms = [(name, canonical(text)) for name, texts in known.items() for text in texts]
    rows = [(name, len(form), form.partition(" ")[0], hashlib.sha256(form.encode()).hexdigest()) for name, form in forms]
    found: dict[str, str] = {}
    lengths: dict[str, set[int]] = {}
    for name, length, first, digest in rows + FULL * (known is KNOWN):
        found[digest] = min(name, found.get(digest, name))
        lengths.setdefault(first, set()).add(length)
    return sorted(found.items()), {first: sorted(x) for first, x in lengths.items()}


def runs(forms: list[str], lengths: Mapping[str, list[int]]) -> Iterator[str]:
    """The runs of one or more lines that begin with a known first word and have one of its lengths."""
    first = [(i, at) for i, form in enumerate(forms) if (at := lengths.get(form.partition(" ")[0]))]
    if first:
        ends = list(accumulate((len(form) + 1 for form in forms)))  # each with a space after it
        for i, known in first:
            start = ends[i] - len(forms[i]) - 1
            for length in known:
                j = bisect_left(ends, start + length + 1, i)
                if j < len(ends) and ends[j] == start + length + 1:
                    yield " ".join(forms[i:j + 1])


def _digests(lengths: Mapping[str, list[int]]):
    def run(batches):
        for batch in batches:
            whole, lines = [], []
            for text in batch.column(1):
                forms = list(canonical_lines(text.as_py()))
                whole.append(hashlib.sha256(" ".join(forms).encode("utf-8", "surrogatepass")).hexdigest())
                lines.append([hashlib.sha256(body.encode("utf-8", "surrogatepass")).hexdigest() for body in runs(forms, lengths)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(whole, pa.string()), pa.array(lines, pa.list_(pa.string()))], ["doc_id", "text_sha256", "lines"])
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: Mapping[str, list[str]] = KNOWN) -> DataFrame:
    """id, text_sha256, license (of the whole text), n_lines (lines, and runs
    of lines, that are a known text), line_licenses (their licences, sorted, comma-joined)."""
    rows, lengths = known_digests(known)
    # the catalogue is a parameter: a few rows
    catalog = F.broadcast(docs.sparkSession.createDataFrame(rows, "digest string, license string"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    found = stored(texts.mapInArrow(_digests(lengths), f"doc_id {id_type}, text_sha256 string, lines array<string>"), "license-digests")
    hits = found.select("doc_id", F.explode("lines").alias("digest")).join(catalog, "digest")
    per = hits.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.concat_ws(",", F.sort_array(F.collect_set("license"))).alias("line_licenses"))
    # the one row of the null id is repeated, so that rows without an id are dealt over tasks
    lost = F.col("doc_id").isNull()
    per = per.withColumn("k", F.explode(F.when(lost, F.sequence(F.lit(0), F.lit(NULL_SALTS - 1))).otherwise(F.array(F.lit(0))))).withColumnRenamed("doc_id", "d")
    dealt = found.drop("lines").withColumn("salt", F.when(lost, F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SALTS)).cast("int")).otherwise(0))
    return (dealt.join(catalog, F.col("text_sha256") == F.col("digest"), "left").drop("digest")
            .join(per, F.expr("doc_id <=> d AND salt = k"), "left")
            .select(F.col("doc_id").alias(id_col), "text_sha256", "license", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce("line_licenses", F.lit("")).alias("line_licenses")))
