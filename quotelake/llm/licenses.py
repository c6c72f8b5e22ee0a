"""Licence texts, recognised by the digest of their canonical form.

The canonical form has no case, punctuation, copyright lines or differences of
spelling. Digests of whole texts, and of each of their lines as a text of its own
(a notice below a document is one), are joined with those of known licences.

A null text is an empty one; neither it nor a text without letters or digits has
a digest or a licence. Known texts with one digest are one licence, the smallest
name. Repeated rows get a row each. Null ids and other columns pass unused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Known digests are 32 bytes and a name: a table of so many is below 20 MB.
BROADCAST_ROWS = 100_000

# Spellings that mean the same in a licence.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("non-infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("organisation", "organization"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("fulfilment", "fulfillment"),
    ("judgement", "judgment"),
    ("acknowledgement", "acknowledgment"),
    ("per cent", "percent"),
    ("https:", "http:"),
    ("&", " and "),
)

COPYRIGHT_LINE = r"^[^\p{L}\p{N}(©]*(copyright|\(c\)|©)[^\p{L}\p{N}]*(\(c\)|©|\bc\b|[0-9]{4}|<|\[|by\b).*$|^[^\p{L}\p{N}]*all rights reserved[^\p{L}\p{N}]*$"

# Usual titles of whole licence files; a file may have one or none.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "MIT-0": ("MIT No Attribution", "MIT-0"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD License"),
    "Zlib": ("zlib License", "The zlib License", "The zlib/libpng License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}

# Short public licence texts and the usual one-line notices.
KNOWN_TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "MIT-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>""",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released under CC0 1.0.",
}


def canonical_lines(text: Column) -> Column:
    """The lines of a text in canonical form, without empty and copyright lines."""
    plain = F.lower(text)
    for other, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(other), F.lit(usual))
    lines = F.filter(F.split(plain, "\n"), lambda line: ~line.rlike(COPYRIGHT_LINE))
    clean = F.transform(lines, lambda line: F.trim(F.regexp_replace(line, r"[^\p{L}\p{N}]+", " ")))
    return F.filter(clean, lambda line: line != "")


def with_titles(texts: dict[str, str] = KNOWN_TEXTS) -> list[tuple[str, str]]:
    """Each text by itself, and below each of its usual titles."""
    titled = [(name, f"{title}\n{text}") for name, text in texts.items() for title in TITLES.get(name, ())]
    return [*texts.items(), *titled]


def known_licenses(spark: SparkSession, texts: dict[str, str] = KNOWN_TEXTS) -> DataFrame:
    """``license_id, text``; any table of this form can stand in, or be added."""
    rows = [F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("text")) for name, text in with_titles(texts)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def license_digests(known: DataFrame) -> DataFrame:
    """``digest, license_id`` of the texts that have a canonical form."""
    body = F.array_join(canonical_lines(F.col("text").cast("string")), " ")
    digests = known.select("license_id", body.alias("body")).where("body <> ''")
    return digests.groupBy(F.sha2("body", 256).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan_licenses(documents: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, canonical_sha256, license_id, n_notices, notices`` per document.

    ``license_id`` is that of the whole text. ``n_notices`` counts its lines that
    are a known text by themselves and ``notices`` lists their licences, sorted.
    """
    digests = license_digests(known)
    if digests.count() <= BROADCAST_ROWS:
        digests = F.broadcast(digests)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = documents.select("doc_id", canonical_lines(text).alias("lines"))
    texts = lines.select(
        "doc_id",
        F.sha2(F.array_join("lines", "\n"), 256).alias("lines_sha"),
        F.when(F.size("lines") > 0, F.sha2(F.array_join("lines", " "), 256)).alias("canonical_sha256"),
        F.posexplode_outer(F.transform("lines", lambda line: F.sha2(line, 256))).alias("place", "digest"),
    )
    first = F.coalesce("place", F.lit(0)) == 0
    # Beyond the first line of each document only known ones go on to the shuffle.
    found = texts.join(digests, "digest", "left").where(first | F.col("license_id").isNotNull())
    # Rows with one id and the same lines meet in a group and are told apart below.
    grouped = found.groupBy("doc_id", "lines_sha", "canonical_sha256").agg(
        F.count_if(first).alias("copies"),
        F.count("license_id").alias("lines_known"),
        F.array_sort(F.collect_set("license_id")).alias("notices"),
    )
    whole = digests.select(F.col("digest").alias("canonical_sha256"), "license_id")
    return grouped.join(whole, "canonical_sha256", "left").select(
        "doc_id",
        "canonical_sha256",
        "license_id",
        F.expr("lines_known div copies").alias("n_notices"),
        F.array_join("notices", ",").alias("notices"),
        F.explode(F.expr("sequence(1L, copies)")).alias("copy"),
    ).drop("copy")
