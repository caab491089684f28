"""Licence scans by canonical digests of entire texts.

A text is brought to a canonical form: lower case, equivalent spellings in one
form, copyright lines left out, and nothing but letters, digits and single
spaces. Its digest is then looked up among those of known licences and notices
by a hash join. Entire texts are taken at three levels: the document, each of its
lines, since notices stand on lines of their own, and runs of as many paragraphs
as a known text has, since licences stand inside longer documents and notices go
over several lines.

Everything is built from column functions; the known digests, one row per known
text, are the side that is broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known texts, by licence. Their copyright lines are left out.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)
LICENSES = (
    (
        "MIT",
        """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    ),
    (
        "ISC",
        """ISC License

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    ),
)
_BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
"""
_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission.
"""
_BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS
OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN
IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
HEADERS = (
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    ),
    ("BSD-2-Clause", _BSD + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_WARRANTY),
)
# Licences also stand without their title.
UNTITLED = tuple((name, text.split("\n\n", 1)[1]) for name, text in LICENSES)
KNOWN = NOTICES + UNTITLED + HEADERS + LICENSES

# Digests of the canonical form of long licences, whole texts as published,
# with their title and appendix.
LONG_DIGESTS = (
    ("Apache-2.0", "e32aea965561f41a8390221b29af2726"),
    ("Artistic-1.0", "2fe792d1191a708e71b9beca097682bd"),
    ("BSD-3-Clause", "a2a671f577cbf1292faaee2c8edc149f"),
    ("CC0-1.0", "93a180096f6cfcf2c0dd24f75c2eec48"),
    ("GFDL-1.2", "0ddc974af2022d1eb483df77268fc903"),
    ("GFDL-1.3", "6dcd514fc8d59959d92fedf319737026"),
    ("GPL-1.0", "b37a688f44419d3168b23775b65749eb"),
    ("GPL-2.0", "422f821c6c0b1812cbde7c1c3be04922"),
    ("GPL-3.0", "f8de4ee042e7af7040c9c77af4e24d6f"),
    ("LGPL-2.0", "ebf358251bfe9161668a8c8251261977"),
    ("LGPL-2.1", "1ff066c677365f47fea81c911a7c822e"),
    ("LGPL-3.0", "b31b7335bc37919e8cdd79154e04d88d"),
    ("MPL-1.1", "252dfbcf46f9012c7c356a9252f1c30c"),
    ("MPL-2.0", "b5b7a0cf4994910cd0204fba4637d6ec"),
)

# Spellings that count as equal, and the form they get.
SPELLINGS = (
    ("©", "(c)"),
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("non-commercial", "noncommercial"),
    ("copyright holder", "copyright owner"),
    ("merchantibility", "merchantability"),
    ("&", " and "),
)
# A line that states a holder or year rather than a rule, once marks are gone.
COPYRIGHT_LINE = r"^(copyright( c)?|c) ([0-9]{4}|by )|^all rights reserved$"
# So does a short line with a holder alone, unless it goes on as a sentence does.
HOLDER_LINE = r"^copyright( c)?( [^ ]+){1,8}$"
SENTENCE_LINE = (
    r"^copyright( c)? (notices?|owners?|holders?|laws?|license|statement|and|or|of|in|is|the|to|this)( |$)"
)
_OTHER = r"[^\p{L}\p{N}\n]+"


def _marked_lines(text: Column) -> Column:
    """Lines in canonical form, blank ones too, without copyright lines."""
    plain = F.lower(text)
    for spelling, form in SPELLINGS:
        plain = F.replace(plain, F.lit(spelling), F.lit(form))
    lines = F.split(F.regexp_replace(plain, _OTHER, " "), "\n")
    lines = F.transform(lines, lambda x: F.trim(x))
    holder = lambda x: x.rlike(HOLDER_LINE) & ~x.rlike(SENTENCE_LINE)
    return F.filter(lines, lambda x: ~(x.rlike(COPYRIGHT_LINE) | holder(x)))


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text, without blank and copyright lines; null for null."""
    return F.filter(_marked_lines(text), lambda x: x != "")


def canonical_paragraphs(text: Column) -> Column:
    """The canonical lines between blank lines, as one text each; null for null."""
    joined = F.array_join(_marked_lines(text), "\n")
    parts = F.transform(F.split(joined, "\n{2,}"), lambda x: F.btrim(x, F.lit("\n")))
    return F.filter(parts, lambda x: x != "")


def run_lengths(known) -> list[int]:
    """How many paragraphs known texts have."""
    return sorted({len(re.split(r"\n\s*\n", text.strip())) for _, text in known})


def _runs(paragraphs: Column, n: int) -> Column:
    """Runs of n paragraphs that are neither the whole document nor a single line."""
    starts = F.sequence(F.lit(1), F.size(paragraphs) - n)
    starts = F.when(F.size(paragraphs) > n, F.concat(starts, F.array(F.size(paragraphs) - n + 1)))
    runs = F.transform(starts, lambda i: F.array_join(F.slice(paragraphs, i, n), "\n"))
    runs = F.filter(runs, lambda x: F.contains(x, F.lit("\n")))
    digest = F.transform(runs, lambda x: F.md5(F.replace(x, F.lit("\n"), F.lit(" ")).cast("binary")))
    return F.coalesce(digest, F.array().cast("array<string>"))


def canonical_digest(lines: Column) -> Column:
    return F.md5(F.array_join(lines, " ").cast("binary"))


def _known_rows(known) -> list[tuple[str, str, bool]]:
    """(license, text, inside): a text that is known without its title is not looked for inside."""
    texts = {text for _, text in known}
    untitled = [text.partition("\n\n")[2] for _, text in known]
    return [(name, text, rest not in texts) for (name, text), rest in zip(known, untitled, strict=True)]


def known_digests(documents: DataFrame, known=KNOWN, long_digests=LONG_DIGESTS) -> DataFrame:
    """(digest, license, inside) of the known texts, each digest once.

    `long_digests` has licences of which the digest alone is known; they are not
    looked for inside documents.
    """
    spark = documents.sparkSession
    schema = "license string, text string, inside boolean"
    rows = spark.createDataFrame(_known_rows(known), schema)
    digest = canonical_digest(canonical_lines(F.col("text")))
    rows = rows.select("license", "inside", digest.alias("digest"))
    whole = [(name, False, digest) for name, digest in long_digests]
    rows = rows.union(spark.createDataFrame(whole, "license string, inside boolean, digest string"))
    return rows.groupBy("digest").agg(
        F.min("license").alias("license"), F.bool_or("inside").alias("inside")
    )


def scan_licenses(documents: DataFrame, known=KNOWN) -> DataFrame:
    """doc_id, license, notices and n_notices, one row per row of `documents`.

    `license` is the known text that the whole document is, or null; `notices`
    has the licences, in order and joined by commas, of lines that are a known
    text ("" if none), and, unless the document is one, of runs of paragraphs that
    are a known text and not a line; `n_notices` counts these lines and runs. A null
    or empty text matches nothing. Repeated rows have equal results, also without doc_id.
    """
    lines = canonical_lines(F.col("text"))
    key = F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key")
    paragraphs = canonical_paragraphs(F.col("text")).alias("paragraphs")
    rows = documents.select(F.col("doc_id").alias("id"), key, lines.alias("lines"), paragraphs)
    rows = rows.where(F.size("lines") > 0)
    whole = F.struct(F.lit(-1).alias("line"), canonical_digest(F.col("lines")).alias("digest"))
    own = F.transform(
        "lines", lambda x, i: F.struct(i.alias("line"), F.md5(x.cast("binary")).alias("digest"))
    )
    runs = F.concat(*[_runs(F.col("paragraphs"), n) for n in run_lengths(known)])
    # Lines are numbered from 0, runs from -2 down.
    runs = F.transform(runs, lambda x, i: F.struct((-2 - i).alias("line"), x.alias("digest")))
    units = rows.select("id", "key", F.explode(F.concat(F.array(whole), own, runs)).alias("unit"))
    line = F.col("line")
    in_line = F.when(line >= 0, F.struct("line", "license"))
    in_run = F.when((line < -1) & F.col("inside"), F.struct("line", "license"))
    found = (
        units.select("id", "key", "unit.*")
        .join(F.broadcast(known_digests(documents, known)), "digest")
        .groupBy("id", "key")
        .agg(
            F.min(F.when(line == -1, F.col("license"))).alias("license"),
            F.collect_set(in_line["license"]).alias("in_lines"),
            F.countDistinct(in_line["line"]).alias("n_lines"),
            F.collect_set(in_run["license"]).alias("in_runs"),
            F.countDistinct(in_run["line"]).alias("n_runs"),
        )
    )
    unknown = F.col("license").isNull()
    names = F.when(unknown, F.array_union("in_lines", "in_runs")).otherwise(F.col("in_lines"))
    found = found.select(
        "id",
        "key",
        "license",
        F.array_join(F.array_sort(names), ",").alias("notices"),
        (F.col("n_lines") + F.when(unknown, F.col("n_runs")).otherwise(0)).alias("n_notices"),
    )
    ids = documents.select("doc_id", key.alias("own_key"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("key"))
    return ids.join(found, same, "left").select(
        "doc_id",
        "license",
        F.coalesce("notices", F.lit("")).alias("notices"),
        F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
    )


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle_sql() -> str:
    """The same scan in SQL."""
    plain = "lower(text)"
    for spelling, form in SPELLINGS:
        plain = f"replace({plain}, {_sql_text(spelling)}, {_sql_text(form)})"
    pattern = r"[^\p{L}\p{N}" + "' || chr(10) || '" + "]+"
    lines = f"string_split(regexp_replace({plain}, '{pattern}', ' ', 'g'), chr(10))"
    values = ", ".join(f"({_sql_text(k)}, {_sql_text(t)}, {i})" for k, t, i in _known_rows(KNOWN))
    digests = ", ".join(f"({_sql_text(d)}, {_sql_text(k)}, false)" for k, d in LONG_DIGESTS)

    marked = f"""[trim(x) FOR x IN {lines}
                  IF NOT (regexp_matches(trim(x), '{COPYRIGHT_LINE}')
                          OR (regexp_matches(trim(x), '{HOLDER_LINE}')
                              AND NOT regexp_matches(trim(x), '{SENTENCE_LINE}')))]"""
    runs = " UNION ALL ".join(
        f"""SELECT doc_id, unnest([array_to_string(p[i : i + {n - 1}], chr(10))
                                   FOR i IN range(1, len(p) - {n} + 2)]) AS run
            FROM docs WHERE len(p) > {n}
              AND md5(array_to_string(lines, ' ')) NOT IN (SELECT digest FROM known)"""
        for n in run_lengths(KNOWN)
    )

    def canonical(source: str) -> str:
        return f"""
          SELECT * EXCLUDE marked, [x FOR x IN marked IF x <> ''] AS lines,
                 [trim(x, chr(10)) FOR x IN
                    string_split_regex(array_to_string(marked, chr(10)), '\\n{{2,}}')
                  IF trim(x, chr(10)) <> ''] AS p
          FROM (SELECT *, {marked} AS marked FROM {source})"""

    return f"""
        WITH given(license, text, inside) AS (VALUES {values}),
        long(digest, license, inside) AS (VALUES {digests}), known AS (
          SELECT digest, min(license) AS license, bool_or(inside) AS inside
          FROM (SELECT md5(array_to_string(lines, ' ')) AS digest, license, inside
                FROM ({canonical("given")})
                UNION ALL SELECT digest, license, inside FROM long)
          GROUP BY 1
        ), docs AS MATERIALIZED ({canonical("documents")}),
        by_line AS (
          SELECT doc_id, unnest(lines) AS line, false AS run FROM docs
          UNION ALL
          SELECT doc_id, replace(run, chr(10), ' '), true FROM ({runs}) WHERE contains(run, chr(10))
        ), notices AS (
          SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices,
                 count(*) AS n_notices
          FROM by_line JOIN known ON md5(line) = digest AND (inside OR NOT run) GROUP BY doc_id
        )
        SELECT doc_id, known.license, coalesce(notices, '') AS notices,
               coalesce(n_notices, 0)::BIGINT AS n_notices
        FROM docs
        LEFT JOIN known ON len(lines) > 0 AND md5(array_to_string(lines, ' ')) = digest
        LEFT JOIN notices USING (doc_id)
    """
