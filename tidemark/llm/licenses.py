"""Licence scans by digests of canonical texts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from importlib.resources import files

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released

#: Known digests that may be sent to every task; a larger table is joined by a shuffle.
MOST_SENT = 100_000

#: Spellings that count as equal, the second standing for both.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "licencing": "licensing", "licencee": "licensee", "sub-license": "sublicense", "sublicence": "sublicense",
    "non-commercial": "noncommercial", "acknowledgement": "acknowledgment", "acknowledgements": "acknowledgments", "analogue": "analog", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "centre": "center", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "modelled": "modeled", "modelling": "modeling", "organisation": "organization",
    "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
    "copyright owner": "copyright holder", "copyright owners": "copyright holders", "per cent": "percent", "https": "http", "merchantibility": "merchantability",
}
_SPACED = {re.sub(r"\W+", " ", a): b for a, b in SPELLINGS.items()}
_SPELT = re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, _SPACED), key=len, reverse=True)) + r")\b")
_HINT = re.compile("|".join(sorted({re.escape(k[:5]) for k in _SPACED})))
#: Lines that name who holds rights, and since when: not lines of a sentence that happens to break before "copyright" or "(c)".
_HOLDER = r"(?:\(c\)|©|&copy;|[0-9]{4}|[<\[{]|year\b|by\b)"
_COPYRIGHT = re.compile(rf"^[^\w\n(©]*(?:(?:portions )?copyright:?[ \t]*{_HOLDER}|(?:\(c\)|©)[ \t]*(?:copyright|[0-9]{{4}}|[<\[{{])|all rights reserved\W*$).*$", re.M)
_TERMS_END = re.compile(r"end of (?:the )?terms and conditions\W*", re.I)
_OTHER = re.compile(r"[^\w\n]+|_+")

#: Notices and short licences, as their stewards publish them.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n"
_BSD_TAIL = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
KNOWN_TEXTS: list[tuple[str, str]] = [
    ("MIT", _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License\n" + _MIT), ("ISC", _ISC), ("ISC", "ISC License\n" + _ISC),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-3-Clause", _BSD_HEAD + _BSD_3 + _BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_HEAD + _BSD_TAIL), ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_HEAD + _BSD_3 + _BSD_TAIL),
    ("Zlib", _ZLIB), ("Zlib", "zlib License\n" + _ZLIB), ("Apache-2.0", _APACHE_NOTICE),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"), ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"), ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"), ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
]


def spelt(words: str) -> str:
    return _SPELT.sub(lambda m: _SPACED[m.group()], words) if _HINT.search(words) else words


def canonical(text: str) -> list[str]:
    """The text's lines that have words: in lower case, letters and digits with one space between words, lines of copyright left out."""
    t = text.lower()
    if "copyright" in t or "(c)" in t or "©" in t or "all rights" in t:
        t = _COPYRIGHT.sub("", t)
    return [joined for line in _OTHER.sub(" ", t).split("\n") if (joined := " ".join(line.split()))]


def digest(words: str) -> str:
    return hashlib.blake2b(words.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def unit_digests(text: str | None) -> tuple[str | None, list[str]]:
    """Digest of the whole canonical text, None where it has no words, and those of its lines that have words. Equal spellings
    are made one in the text as a whole, so that it doesn't matter where its lines break."""
    lines = canonical(text or "")
    if not lines:
        return None, []
    return digest(spelt(" ".join(lines))), [digest(spelt(x)) for x in lines] if len(lines) > 1 else []


def whole_texts() -> list[tuple[str, str]]:
    """(license, text) of the files in license_texts, each whole and without the advice on its use that follows the terms."""
    out = []
    for file in sorted((f for f in files(__package__).joinpath("license_texts").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        out.append((name, text))
        if cut := _TERMS_END.search(text):
            out += [(name, text[: cut.end()]), (name, text[: cut.start()])]
    return out


def known_licenses(spark: SparkSession, more: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license) of the built-in notices and whole texts, and of more (license, text)."""
    found = {unit_digests(text)[0]: name for name, text in [*KNOWN_TEXTS, *whole_texts(), *(more or [])]}
    return spark.createDataFrame(sorted((d, n) for d, n in found.items() if d), "digest string, license string")


def licenses_of(table: DataFrame, license_col: str = "license", text_col: str = "text") -> DataFrame:
    """(digest, license) of a table of known texts of any size, for license_scan; texts that are null or without words are left out."""

    @F.pandas_udf("string")
    def whole(texts: pd.Series) -> pd.Series:
        return pd.Series([unit_digests(t)[0] for t in texts], dtype=object)

    return table.select(whole(F.col(text_col)).alias("digest"), F.col(license_col).cast("string").alias("license")).where("digest is not null")


def license_scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, digest, license, n_lines, line_licenses.

    digest is that of the entire canonical text and license the known one with that digest; line_licenses are those of
    entire lines, sorted and joined by commas, empty if none. n_lines counts lines with words. Texts that are null, empty or without
    words have a null digest. Known digests with several names give the smallest. Repeated rows each return.
    Lines are looked up where they are read while the known table has at most MOST_SENT rows; only a row for each
    document is shuffled.
    """

    @F.pandas_udf("whole string, lines array<string>")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([unit_digests(t) for t in texts], columns=["whole", "lines"])
        released()

    table = known.where(F.col("digest").isNotNull()).groupBy(F.col("digest").alias("_k")).agg(F.min("license").alias("_license"))
    if table.limit(MOST_SENT + 1).count() <= MOST_SENT:
        table = F.broadcast(table)
    units = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
        .withColumn("_uid", F.monotonically_increasing_id())
        .select("_uid", "_id", digests("_t").alias("_d"))
        .select("_uid", "_id", F.col("_d.whole").alias("_whole"), F.size("_d.lines").alias("_n"), F.posexplode(F.concat(F.array("_d.whole"), F.col("_d.lines"))).alias("_at", "_unit"))
    )
    joined = units.join(table, units["_unit"] == table["_k"], "left")
    return (
        joined.groupBy("_uid", "_id", "_whole", "_n")
        .agg(F.max(F.when(F.col("_at") == 0, F.col("_license"))).alias("license"), F.array_join(F.sort_array(F.collect_set(F.when((F.col("_at") > 0) | (F.col("_n") == 0), F.col("_license")))), ",").alias("line_licenses"))
        .select(F.col("_id").alias(id_col), F.col("_whole").alias("digest"), "license", F.when(F.col("_whole").isNull(), 0).otherwise(F.greatest(F.col("_n"), F.lit(1))).cast("long").alias("n_lines"), "line_licenses")
    )
