"""License scans: whole texts, in canonical form, looked up by digest among known licences."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# fixed values: texts of widely used licences and notices
BSD_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n\n"
)
BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)
GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {short} as published by the Free Software Foundation, "
    "either version {version} of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful, but "
    "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {short} for more details.\n\n"
    "You should have received a copy of the {short} along with this program. If not, see <https://www.gnu.org/licenses/>."
)
KNOWN = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
        "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES "
        "WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
        "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND '
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING "
        "FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
        "from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
        "the original software.\n3. This notice may not be removed or altered from any source distribution."
    ),
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain '
        "a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
        "the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": BSD_CLAUSES + BSD_WARRANTY,
    "BSD-3-Clause": BSD_CLAUSES + (
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.\n\n"
    ) + BSD_WARRANTY,
    "MIT-0": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
        "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
        "means.\n\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
        "software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and "
        "successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software "
        'under copyright law.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nFor more information, please refer to <https://unlicense.org>"
    ),
    "BSL-1.0": (
        "Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted, free of charge, to any person or organization obtaining "
        'a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do "
        "so, all subject to the following:\n\nThe copyright notices in the Software and this entire statement, including the above license grant, this "
        "restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the "
        "Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language "
        'processor.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING "
        "THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You "
        "can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    **{f"{short}-{v}.0-or-later-notice": GNU.format(name=name, version=v, short=f"GNU {name} General Public License".replace("  ", " ")) for short, name, v in (
        ("GPL", "", 2), ("GPL", "", 3), ("LGPL", "Lesser", 3), ("AGPL", "Affero", 3),
    )},
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
}

# fixed values: a line that only states a copyright, and spellings that count as one
COPYRIGHT = r"(?m)^[^\n\p{L}\p{N}]*(copyright[ \t]*(\(c\)|©|[0-9<\[])|\(c\)[ \t]|©|all rights reserved)[^\n]*$"
# fixed values: words behind "copyright" that go on with a sentence of a licence, in a line that was wrapped there
GOES_ON = (
    r"(?i)(copyright[ \t]+)(holder|owner|notice|law|licen[sc]e|statement|act\b|and\b|or\b|in\b|is\b|treat|interest|protect|infring|disclaim|claim|right|permission)"
)
#: A line that states a copyright by a name alone, when GOES_ON is marked.
NAMED = r"(?m)^[^\n\p{L}\p{N}]*([Cc]opyright|COPYRIGHT)[ \t]+\p{Lu}[^\n]*$"
#: Title lines ahead of a text, in lower case.
TITLE = (
    r"^([^\p{L}\p{N}]*((the )?(mit|expat|x11|isc|zlib|apache|0bsd|(bsd )?zero[ -]clause( bsd)?|bsd|(new|simplified|revised|modified) bsd|bsd[ -][0-4][ -]clause|"
    r"[0-4][ -]clause bsd|mit no attribution|mit-0)( [\"“'(]*(new|simplified|revised|original|modified)[\"”')]*( or [\"“'(]*(new|revised|simplified)[\"”')]*)?)?( licen[cs]e)?([ \t]*\([^()\n]{1,20}\))?|licen[cs]e)"
    r"[^\n\p{L}\p{N}]*\n)+"
)
OTHER = r"[^\p{L}\p{N}]+"
SPELLINGS = {
    "licence": "license", "copyright owner": "copyright holder", "organisation": "organization", "acknowledgement": "acknowledgment", "favour": "favor",
    "per cent": "percent", "sub license": "sublicense", "non commercial": "noncommercial", "http www": "https www", "behaviour": "behavior",
}


def canonical(text: Column, headed: bool = False) -> Column:
    """Lower case, without copyright lines, one space for all that is no letter or digit, one spelling; null without any word.

    ``headed`` also leaves out title lines, as long as something follows them, and copyrights of a name
    without year or sign.
    """
    out = F.regexp_replace(F.regexp_replace(text, GOES_ON, "$1\u0001$2"), NAMED, "") if headed else text
    out = F.regexp_replace(F.lower(out), COPYRIGHT, "")
    if headed:
        bare = F.regexp_replace(out, TITLE, "")
        out = F.when(bare.rlike(r"[\p{L}\p{N}]"), bare).otherwise(out)
    out = F.regexp_replace(out, OTHER, " ")
    for other, one in SPELLINGS.items():
        out = F.replace(out, F.lit(other), F.lit(one))
    return F.nullif(F.btrim(out), F.lit(""))


def digest(text: Column, headed: bool = False) -> Column:
    return F.sha2(canonical(text, headed), 256)


def _listed() -> list[tuple[str, str]]:
    """KNOWN, and texts with numbered clauses once more without the numbers, as with bullets."""
    bare = {k: re.sub(r"(?m)^[0-9]\. ", "", v) for k, v in KNOWN.items()}
    return sorted({*KNOWN.items(), *bare.items()})


def known_texts(spark: SparkSession, folder: str | None = None) -> DataFrame:
    """(license, text) of KNOWN, and of a folder that Spark can read with one full text a file, named by the licence."""
    known = spark.createDataFrame(_listed(), "license string, text string")
    if not folder:
        return known
    name = F.regexp_replace(F.url_decode(F.replace(F.regexp_extract(F.input_file_name(), r"([^/]*)$", 1), F.lit("+"), F.lit("%2B"))), r"(?i)\.(txt|md)$", "")
    return known.unionByName(spark.read.text(folder, wholetext=True).select(name.alias("license"), F.col("value").alias("text")))


def scanned(docs: DataFrame, known: DataFrame, key: str = "doc_id", headed: bool = False) -> DataFrame:
    """(key, digest, licenses) of every row: the SHA-256 of the canonical whole text, and the known licences that have it.

    ``known`` holds license and text; texts that share a canonical form give a sorted list.
    Licences are joined by digest; as many documents as there are may have one, since Spark
    broadcasts a small list and splits hot keys of a large one. Null texts and texts without a
    letter or digit have a null digest and no licence, and such known texts match nothing.
    Repeated rows each keep their result; extra columns are ignored. ``headed``: see canonical().
    """
    names = known.select(digest(F.col("text"), headed).alias("digest"), F.col("license")).where("digest IS NOT NULL AND license IS NOT NULL")
    names = names.groupBy("digest").agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"))
    return docs.select(F.col(key), digest(F.col("text"), headed).alias("digest")).join(names, "digest", "left").select(key, "digest", "licenses")


def oracle(headed: bool = False) -> str:
    """The same scan in SQL."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    gone = lambda text, pattern, by="''": f"regexp_replace({text}, {quoted(pattern)}, {by}, 'g')"

    def forms(rows: str) -> str:
        named = gone(gone("text", GOES_ON, r"'\1' || chr(1) || '\2'"), NAMED) if headed else "text"
        whole = f"SELECT *, {gone(f'lower({named})', COPYRIGHT)} AS whole FROM {rows}"
        bare = f"CASE WHEN regexp_matches({gone('whole', TITLE)}, '[\\p{{L}}\\p{{N}}]') THEN {gone('whole', TITLE)} ELSE whole END" if headed else "whole"
        out = gone(bare, OTHER, "' '")
        for other, one in SPELLINGS.items():
            out = f"replace({out}, {quoted(other)}, {quoted(one)})"
        return f"SELECT *, sha256(nullif(trim({out}), '')) AS digest FROM ({whole}) w"

    rows = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in _listed())
    return f"""
    WITH listed AS ({forms(f"(VALUES {rows}) v(license, text)")}), own AS ({forms("documents")}),
    known AS (SELECT digest, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM listed GROUP BY digest)
    SELECT doc_id, own.digest, licenses FROM own LEFT JOIN known ON own.digest = known.digest
    """
