"""License scan by canonical digest: whole texts are normalised and hash-joined to digests of known licences."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, save

#: Spellings that licence texts may vary, and the form they are brought to.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "catalogue": "catalog", "centre": "center", "copyright holder": "copyright owner", "copyright holders": "copyright owners",
    "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment",
    "labelling": "labeling", "labour": "labor", "licence": "license", "licenced": "licensed", "licences": "licenses", "licencing": "licensing", "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "offence": "offense",
    "optimise": "optimize", "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "sub-license": "sublicense", "sublicence": "sublicense", "sublicences": "sublicenses", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
}

#: Short notices and licences, by identifier, whose whole texts are known.
KNOWN = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-or-later-notice": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "GPL-3.0-or-later-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "MIT-notice": "Released under the MIT License.",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>""",
}

#: Title lines that may stand above the text of a licence.
TITLES = {
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD"), "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License"), "BSL-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License"),
    "ISC": ("ISC License", "The ISC License"), "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "Expat License"), "MIT-0": ("MIT No Attribution", "MIT No Attribution License"),
    "Unlicense": ("The Unlicense", "Unlicense"), "Zlib": ("zlib License", "The zlib License"),
}

_MARK = r"(?:copyright|\(c\))"
#: A copyright statement: a line of a mark and a year or a second mark, or of a mark and the reservation of rights, or of the latter alone.
#: Other lines that begin with a mark are text, as "copyright notice", or items of a list, as "(c)".
_COPYRIGHT = rf"(?md)^[^a-z0-9\n(]*(?:(?:portions )?{_MARK}[^a-z0-9\n]*(?:{_MARK}|[12][0-9][0-9][0-9]|year|yyyy)[^\n]*|{_MARK}[^\n]*all rights reserved[^a-z0-9\n]*|all rights reserved[^a-z0-9\n]*)$"
#: Runs of what is no letter or digit: ASCII marks and white space, quotation marks, dashes and bullets.
_MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\x{A0}\x{AB}\x{B7}\x{BB}\x{2000}-\x{206F}\x{FEFF}]+"
_WORDS = sorted(x for x in SPELLINGS if not re.search("[ -]", x))
_PAIRS = sorted(x for x in SPELLINGS if re.search("[ -]", x))


def _respell(x: Column, spellings: list[str]) -> Column:
    """x, whose words are parted by blanks or line ends, with words or pairs of words in their other spelling."""
    x = F.concat(F.lit(" "), F.replace(F.replace(x, F.lit(" "), F.lit("  ")), F.lit("\n"), F.lit(" \n ")), F.lit(" "))  # a blank of its own on either side of each word
    for old in spellings:
        x = F.replace(x, F.lit(f" {re.sub('[ -]', '  ', old)} "), F.lit(f" {re.sub('[ -]', '  ', SPELLINGS[old])} "))
    return F.trim(F.replace(F.replace(x, F.lit("  "), F.lit(" ")), F.lit(" \n "), F.lit("\n")))


def canonical(df: DataFrame, text: str, whole: str, lines: str) -> DataFrame:
    """df with the canonical form of a text column and an array of those of its lines: lower-cased, copyright statements
    gone, punctuation and white space as one blank, spellings unified. A null text is empty.

    The text goes through the patterns once, with its line ends; respelling is only done where there is something to respell.
    """
    x = F.lower(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("©"), F.lit("(c)")))
    x = F.when(x.contains("copyright") | x.contains("(c)") | x.contains("all rights reserved"), F.regexp_replace(x, _COPYRIGHT, " ")).otherwise(x)
    x = F.regexp_replace(F.replace(x, F.lit("https:"), F.lit("http:")), _MARKS.replace("\\x00-\\x2F", "\\x00-\\x09\\x0B-\\x2F"), " ")
    df = df.withColumn("_plain", x)
    words = lambda c: F.filter(F.split(F.replace(c, F.lit("\n"), F.lit(" ")), " "), lambda w: w != "")
    df = df.withColumn("_plain", F.when(F.arrays_overlap(F.split(F.replace("_plain", F.lit("\n"), F.lit(" ")), " "), F.array(*map(F.lit, _WORDS))), _respell(F.col("_plain"), _WORDS)).otherwise(F.col("_plain")))
    df = df.withColumn(whole, F.array_join(words(F.col("_plain")), " "))
    pairs = lambda c: F.when(functools.reduce(Column.__or__, [c.contains(re.sub("-", " ", y)) for y in _PAIRS]), _respell(c, _PAIRS)).otherwise(c)
    return df.withColumn(whole, pairs(F.col(whole))).withColumn(lines, F.transform(F.split("_plain", "\n"), lambda x: pairs(F.trim(x)))).drop("_plain")


def known_licenses(spark: SparkSession, texts: dict[str, str] = KNOWN, titles: dict[str, tuple[str, ...]] = TITLES) -> DataFrame:
    """license_id, digest of the known texts, alone and under each of their titles; of equal digests the first identifier stays."""
    rows = [(k, v) for k, v in sorted(texts.items())] + [(k, f"{t}\n\n{texts[k]}") for k, ts in sorted(titles.items()) if k in texts for t in ts]
    rows = canonical(spark.createDataFrame(rows, "license_id string, text string"), "text", "whole", "lines")
    return rows.filter("whole <> ''").select("license_id", F.sha2("whole", 256).alias("digest")).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def _looked_up(docs: DataFrame, known: DataFrame) -> DataFrame:
    """row, doc_id, at, digest, license_id: the whole text of each row of docs (at = 0, license_id null if unknown), and
    each line of it (at = 1 + line) that is a known text. Stored, so that one scan serves both."""
    side = known.filter(F.col("digest") != F.sha2(F.lit(""), 256)).select("digest", "license_id")
    side = F.broadcast(side) if side.count() <= BROADCAST_ROWS else side
    rows = canonical(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text")), "text", "whole", "lines")
    digests = F.transform(F.concat(F.array("whole"), F.col("lines")), lambda x: F.sha2(x, 256))
    rows = rows.select("row", "doc_id", F.posexplode(digests).alias("at", "digest"))
    return save(rows.join(side, "digest", "left").filter("at = 0 or license_id is not null").select("row", "doc_id", "at", "digest", "license_id"), "licences")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, digest (of the canonical whole text), license_id (null: unknown).

    docs has doc_id and text, known has digest (unique) and license_id; other columns are ignored, whatever their names.
    Null and empty texts have the digest of the empty text, which is no licence. Rows repeat as docs repeats them, also
    those of a null or repeated doc_id; an empty table gives no rows.
    """
    return _looked_up(docs, known).filter("at = 0").select("doc_id", "digest", "license_id")


def license_lines(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, line (from 0), license_id: lines of any length whose canonical form is a whole known text, as in file headers.

    Null and empty texts have none; rows of a null or repeated doc_id give their lines each; other columns are ignored.
    """
    return _looked_up(docs, known).filter("at > 0").select("doc_id", (F.col("at") - 1).alias("line"), "license_id")


def scan_with_lines(docs: DataFrame, known: DataFrame) -> DataFrame:
    """scan with n_lines, the known licence lines of each text, and line_licenses, their distinct identifiers in order, comma-joined."""
    found = _looked_up(docs, known)
    lines = found.filter("at > 0").groupBy("row").agg(F.count("*").alias("n_lines"), F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("line_licenses"))
    out = found.filter("at = 0").join(lines, "row", "left")
    return out.select("doc_id", "digest", "license_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.coalesce("line_licenses", F.lit("")).alias("line_licenses"))
