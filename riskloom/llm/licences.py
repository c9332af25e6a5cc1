"""Licence scan by canonical digests, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Equivalent spellings, British stems to American ones.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authoris", "authoriz"),
    ("behaviour", "behavior"), ("cancelled", "canceled"), ("capitalis", "capitaliz"), ("catalogue", "catalog"), ("categoris", "categoriz"),
    ("centre", "center"), ("defence", "defense"), ("favour", "favor"), ("fulfill", "fulfil"), ("initialis", "initializ"), ("judgement", "judgment"),
    ("labell", "label"), ("labour", "labor"), ("licence", "license"), ("maximis", "maximiz"), ("modell", "model"), ("offence", "offense"),
    ("optimis", "optimiz"), ("organis", "organiz"), ("per cent", "percent"), ("programme", "program"), ("realis", "realiz"), ("recognis", "recogniz"),
    ("utilis", "utiliz"), ("whilst", "while"), ("willful", "wilful"),
]
COPYRIGHT = r"(^|\n)[^a-z0-9\n]*(?:copyright|\(c\)|©)[^\n]*(?:[0-9]{4}|<year>|\[year\]|\[yyyy\])[^\n]*"
RESERVED = r"(^|\n)[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*"
MARKS = r"[^\p{L}\p{N}]+"

#: Texts of short public licences, by SPDX identifier.
LICENCES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
}
#: One-line notices that name a licence.
NOTICES = {
    "Licensed under the Apache License, Version 2.0": "Apache-2.0",
    "Released under the MIT License": "MIT",
    "Licensed under the MIT License": "MIT",
    "This work is licensed under the GNU General Public License, version 3": "GPL-3.0-only",
    "Licensed under CC BY-NC 4.0": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0": "CC-BY-4.0",
}


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines and punctuation, one spelling, single spaces; nulls are empty."""
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.regexp_replace(F.regexp_replace(t, COPYRIGHT, "$1"), RESERVED, "$1")
    t = F.trim(F.regexp_replace(t, MARKS, " "))
    for one, other in SPELLINGS:
        t = F.replace(t, F.lit(one), F.lit(other))
    return t


def known_licences(spark: SparkSession) -> DataFrame:
    """The licences and notices above: license_id and text, notices with whole = false."""
    whole = [(k, v, True) for k, v in LICENCES.items()]
    return spark.createDataFrame(whole + [(v, k, False) for k, v in NOTICES.items()], "license_id string, text string, whole boolean")


def digests(known: DataFrame) -> DataFrame:
    """license_id by canonical digest; of several licences with one digest the first by name."""
    return known.groupBy(F.sha2(canonical(F.col("text")), 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, text_digest, license_id and notice_ids of every row.

    text_digest is the SHA-256 of the canonical whole text; license_id the known licence with that digest, else null: a hash join
    of all digests, which Spark splits by itself where one digest is frequent. notice_ids names the known notices that a whole
    line of the text is, sorted and joined by commas, empty if none; of notices with one canonical text the first name counts. Null texts are empty texts; these match no licence unless
    an empty one is known. Repeated rows each give a row.
    """
    lines = digests(known.where("NOT whole"))
    table = F.create_map(*[F.lit(x) for r in lines.orderBy("license_id").collect() for x in (r["digest"], r["license_id"])])  # a fixed list of notices
    naming = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.lower(x).rlike("licen[cs]e"))
    found = F.transform(naming, lambda x: F.try_element_at(table, F.sha2(canonical(x), 256)))
    notices = F.array_join(F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull()))), ",")
    rows = docs.select(id, F.sha2(canonical(F.col(text)), 256).alias("text_digest"), notices.alias("notice_ids"))
    whole = digests(known.where("whole"))
    return rows.join(whole, F.col("text_digest") == F.col("digest"), "left").select(id, "text_digest", "license_id", "notice_ids")
