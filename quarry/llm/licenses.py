"""License scan by canonical digests.

A text is normalised (case, punctuation, copyright lines, equivalent spellings),
its SHA-256 taken, and the digest hash-joined to the digests of known texts.
The same normal form serves the whole text and each single line, so a document
that *is* a licence and a document that carries a one-line notice are both found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Public licence texts (without their copyright lines) and the
# usual one-line notices, by SPDX identifier.
KNOWN: list[tuple[str, str, str]] = [
    ("MIT", "text", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", "text", """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("0BSD", "text", """BSD Zero Clause License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", "text", """BSD 2-Clause License

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Zlib", "text", """zlib License

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("BSD-3-Clause", "text", """BSD 3-Clause License

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "notice", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "notice", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "notice", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "notice", "SPDX-License-Identifier: BSD-3-Clause"),
]

# Canonical digests of further public licences, whole texts as their
# stewards publish them (Apache-2.0 with and without its appendix).
KNOWN_DIGESTS: list[tuple[str, str]] = [
    ("Apache-2.0", "036b5ff6d47b44974c624da95e5bf0ac7ddfe5030e41dfa7ff8ac0c1daa9f32b"),
    ("Apache-2.0", "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b"),
    ("GFDL-1.3", "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
]

# Spellings that mean the same in licence texts (replaced inside words too).
SPELLINGS: list[tuple[str, str]] = [
    ("licence", "license"), ("noninfringement", "non infringement"), ("acknowledgement", "acknowledgment"),
    ("merchantibility", "merchantability"), ("organisation", "organization"), ("favour", "favor"),
    ("per cent", "percent"), ("copyright owner", "copyright holder"), ("https", "http"),
]

# A line that only states a copyright: the word or sign, then a year, a sign, or a
# placeholder, and the holder. (A wrapped line of a licence may begin with
# "copyright holders be liable"; it stays.)
COPYRIGHT_LINE = (r"^[ \t#/*;-]*(?:(?:copyright|\(c\)|©)[ \t]*(?:\(c\)|©|&copy;|<year>|\[year\]|\[yyyy\]|[0-9]{4})[^\n]*"
                  r"|(?:all )?rights reserved[. \t\r]*)$")
PUNCTUATION = r"""[ \t\r\f!-/:-@\[-`{-~“”‘’«»–—…©]+"""
# Title lines that stand before a licence or are left out (in normal form).
TITLES = ["mit license", "the mit license", "the mit license mit", "mit license mit", "expat license", "isc license", "the isc license",
          "bsd zero clause license", "zero clause bsd", "bsd 2 clause license", "the bsd 2 clause license", "bsd 2 clause simplified license",
          "simplified bsd license", "bsd 3 clause license", "the bsd 3 clause license", "new bsd license", "zlib license", "the zlib license",
          "unlicense", "the unlicense", "boost software license version 1 0"]


def canonical(c: Column) -> Column:
    """Normal form with line breaks kept: lower case, copyright lines emptied,
    punctuation and blanks folded to one space, spellings unified."""
    x = F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), "(?md)" + COPYRIGHT_LINE, "")
    x = F.regexp_replace(x, PUNCTUATION, " ")
    for a, b in SPELLINGS:
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def _title_pattern() -> str:
    return "^(?:" + "|".join(sorted(TITLES, key=len, reverse=True)) + ") "


def whole_form(canon: Column) -> Column:
    """The normal form of a whole text: on one line, without a title."""
    return F.regexp_replace(F.trim(F.regexp_replace(canon, r"[ \n]+", " ")), _title_pattern(), "")


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def known_digests(spark: SparkSession, known=None, digests=None) -> DataFrame:
    """(digest, license_id) of the known texts, and of those known by digest alone."""
    rows = known if known is not None else KNOWN
    listed = digests if digests is not None else KNOWN_DIGESTS if known is None else []
    known_rows = F.array(*[F.struct(F.lit(i).alias("license_id"), F.lit(b).alias("body")) for i, _, b in rows])
    df = spark.range(1).select(F.inline(known_rows))
    out = df.select(digest(whole_form(canonical(F.col("body")))).alias("digest"), "license_id")
    if listed:
        more = F.array(*[F.struct(F.lit(d).alias("digest"), F.lit(i).alias("license_id")) for i, d in listed])
        out = out.unionByName(spark.range(1).select(F.inline(more)))
    return out.groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan_licenses(df: DataFrame, key: str = "doc_id", text: str = "text", known=None, digests=None) -> DataFrame:
    """One row per input row: ``key, text_digest, license_id, notice_ids, n_notice_lines``.

    ``text_digest`` is the SHA-256 of the canonical whole text and ``license_id``
    the known licence with that digest (null: none), found by a hash join. How the
    text is wrapped, a title line before it and lines that state a copyright make
    no difference.
    ``notice_ids`` are the distinct licences whose canonical text is one line of
    this text, sorted, ``n_notice_lines`` the number of such lines.

    Both sides of the lookup are bounded by the number of known texts: they are
    broadcast for the join and a literal map for the lines, so no row of the
    input is shuffled.

    Null text is an empty text and matches nothing; empty lines match nothing;
    repeated rows each get their result; extra columns are ignored.
    """
    listed = known_digests(df.sparkSession, known, digests)
    pairs = [F.lit(v) for r in listed.collect() for v in (r["digest"], r["license_id"])]  # one per known text
    by_digest = F.create_map(*pairs)
    rows = df.select(F.col(key).alias("__k"), canonical(F.col(text)).alias("__c"))
    lines = F.filter(F.transform(F.split("__c", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    hits = F.filter(F.transform(lines, lambda x: F.element_at(by_digest, digest(x))), lambda x: x.isNotNull())
    found = rows.select("__k", digest(whole_form(F.col("__c"))).alias("text_digest"), hits.alias("__hits"))
    return found.join(F.broadcast(listed.select(F.col("digest").alias("text_digest"), "license_id")),
                      "text_digest", "left").select(
        F.col("__k").alias(key), "text_digest", "license_id",
        F.array_join(F.array_sort(F.array_distinct("__hits")), ",").alias("notice_ids"),
        F.size("__hits").cast("long").alias("n_notice_lines"))


def _sql(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def canonical_sql(c: str) -> str:
    """The same normal form for DuckDB."""
    x = f"regexp_replace(lower(coalesce({c}, '')), {_sql('(?m)' + COPYRIGHT_LINE)}, '', 'g')"
    x = f"regexp_replace({x}, {_sql(PUNCTUATION)}, ' ', 'g')"
    for a, b in SPELLINGS:
        x = f"replace({x}, {_sql(a)}, {_sql(b)})"
    return x


def oracle_sql(table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    whole = f"regexp_replace(trim(regexp_replace(c, '[ \\n]+', ' ', 'g')), {_sql(_title_pattern())}, '')"
    values = ", ".join(f"({_sql(i)}, {_sql(b)})" for i, _, b in KNOWN)
    listed = ", ".join(f"({_sql(i)}, {_sql(d)})" for i, d in KNOWN_DIGESTS)
    return f"""
WITH known AS (
  SELECT digest, min(license_id) AS license_id FROM (
    SELECT sha256({whole}) AS digest, license_id
    FROM (SELECT license_id, {canonical_sql('body')} AS c FROM (VALUES {values}) v(license_id, body)) t
    UNION ALL SELECT digest, license_id FROM (VALUES {listed}) w(license_id, digest)) u GROUP BY 1
), rows_ AS (SELECT {key}, {canonical_sql(text)} AS c FROM {table}),
lined AS (SELECT {key}, row_number() OVER () AS rid, c FROM rows_),
hit AS (
  SELECT l.rid, k.license_id FROM (SELECT rid, trim(unnest(string_split(c, chr(10)))) AS line FROM lined) l
  JOIN known k ON l.line <> '' AND sha256(l.line) = k.digest
), per AS (SELECT rid, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids, count(*) AS n FROM hit GROUP BY 1)
SELECT l.{key}, sha256({whole}) AS text_digest, k.license_id, coalesce(p.ids, '') AS notice_ids,
       coalesce(p.n, 0)::BIGINT AS n_notice_lines
FROM lined l LEFT JOIN per p USING (rid) LEFT JOIN known k ON k.digest = sha256({whole})"""
