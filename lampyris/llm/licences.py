"""Licence texts by the digest of their canonical form, as DataFrame expressions only.

Canonical form: the copyright sign becomes (c), other non-ASCII is a space, case is folded, copyright lines and "all
rights reserved" go, equivalent spellings become one, and what is left are words of [a-z0-9] with one space between.
A text is known if the SHA-256 of its canonical form is in the table of known texts; each line of a document is looked
up the same way, which finds notices inside other prose.

Defined results: a null text is empty; an empty canonical form is never known. Every row gives one row, also rows that
repeat or lack a doc_id. Of known texts with one canonical form the smallest licence id counts; known texts with an
empty form are left out. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import pkgutil
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import broadcast_up_to, stored

SMALL_ROWS = 20_000  # known texts: up to here their digests are broadcast

# Equivalent spellings, left to right, in canonical words.
SPELLINGS = [
    ("licenc", "licens"),
    ("sub licens", "sublicens"),
    ("non infring", "noninfring"),
    ("non commercial", "noncommercial"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("authoris", "authoriz"),
    ("favour", "favor"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("http www", "www"),
    ("https www", "www"),
]

# Public licence texts and notices.
SHORT = [
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    ),
    (
        "BSD-2-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("MIT-notice", "Released under the MIT License."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0-notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0-notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
]

# The published texts in licence_texts, and the headings that short texts bear or lack.
PUBLISHED = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0", "CC0-1.0", "Unlicense"]
HEADINGS = {
    "MIT": ["MIT", "MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)", "The Expat License", "License (MIT)"],
    "ISC": [
        "ISC", "ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)",
        "ISC License\nThis license is approved by the OSI and FSF as GPL-compatible.\nhttp://opensource.org/licenses/isc-license.txt",
    ],
    "BSD-2-Clause": [
        "BSD 2-Clause License", "The BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License", "The Simplified BSD License",
        "BSD 2-Clause Simplified License", "FreeBSD License", "BSD License", "The BSD License", "License",
    ],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", "BSD-3-Clause", "New BSD License", "The New BSD License", "Modified BSD License",
        "BSD 3-Clause New or Revised License", "Revised BSD License", "BSD License", "The BSD License", "License",
    ],
}
THIRD = """
3. Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.
"""
HOLDERS = ["the copyright holder", "the copyright holders", "copyright holder", "the University", "the author", "the organization", "the project", "the company"]
STREETS = [
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA", "675 Mass Ave, Cambridge, MA 02139, USA",
]


def _marks(text: str) -> list[str]:
    """A list with its numbers, and with bullets."""
    return [text, re.sub(r"(?m)^[0-9]\. ", "* ", text)]


def _short_variants() -> Iterator[tuple[str, str]]:
    body = dict(SHORT)
    two = body["BSD-2-Clause"]
    after = two.index("THIS SOFTWARE")
    bodies = {
        "MIT": [body["MIT"]],
        "ISC": [body["ISC"], body["ISC"].replace("and/or distribute", "and distribute")],
        "BSD-2-Clause": _marks(two),
        "BSD-3-Clause": [x for name in HOLDERS for x in _marks(two[:after] + THIRD.format(name) + "\n" + two[after:])],
    }
    regents = bodies["BSD-3-Clause"][2 * HOLDERS.index("the University") :][:2]
    bodies["BSD-3-Clause"] += [x.replace("COPYRIGHT HOLDERS AND", "REGENTS AND").replace("COPYRIGHT HOLDER OR", "REGENTS OR") for x in regents]
    for licence_id, texts in bodies.items():
        for text in texts:
            yield from ((licence_id, f"{heading}\n\n{text}") for heading in HEADINGS[licence_id])
            yield licence_id, text


def _published_variants(licence_id: str, text: str) -> Iterator[str]:
    """The text as published, and as it stands in repositories: other addresses, without heading, without appendix."""
    forms = [text]
    if "Franklin" in text:
        street = r"51 Franklin Street, Fifth Floor, Boston, MA\s+02110-1301,?\s+USA"
        forms = [re.sub(street, x, text) for x in STREETS]
        forms.append(re.sub(r"(?m)^ *" + street + r"\n", "", text, count=1))
    forms += [x.replace("licenses/why-not-lgpl", "philosophy/why-not-lgpl") for x in forms if "why-not-lgpl" in x]
    if licence_id == "Apache-2.0":
        filled = re.sub(r"(?m)^ *Copyright \[yyyy\].*\n", "", text)
        forms += [filled, text.replace("Version 2.0, January 2004", "Version 2.0, January 2004\nhttps://www.apache.org/licenses/", 1)]
    end = "END OF TERMS AND CONDITIONS"
    forms += [x[: x.index(end) + keep] for x in forms if end in x for keep in (0, len(end))]
    if licence_id == "MPL-2.0":
        forms += [x.replace(" Version 2.0", ", version 2.0", 1) for x in forms]
    # canonical() makes addresses at www alike, no others
    forms += [re.sub(r"https?://(?!www)", scheme, x) for x in forms if re.search(r"https?://(?!www)", x) for scheme in ("http://", "https://")]
    first = {"Apache-2.0": "1. Definitions", "MPL-2.0": "1. Definitions", "MPL-1.1": "1. Definitions", "CC0-1.0": "CC0 1.0 Universal"}.get(licence_id)
    forms += [x[x.index(first) :] for x in forms if first and first in x]
    return iter(dict.fromkeys(forms))


def _known() -> list[tuple[str, str]]:
    """All known texts; the short ones stand last as they are."""
    found = list(_short_variants())
    for licence_id in PUBLISHED:
        text = pkgutil.get_data(__package__, f"licence_texts/{licence_id}.txt").decode()
        found += [(licence_id, x) for x in _published_variants(licence_id, text)]
    return found + SHORT


KNOWN = _known()

COPYRIGHT = r"(^|\n)[^a-z0-9\n(]*(copyright[ \t]*(\(c\)|:|[0-9]{4}|<year>|\[year\])|\(c\)[ \t]*[0-9<\[])[^\n]*"
RESERVED = r"(^|\n)[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*(\n|$)"


def _lines(text: Column) -> Column:
    """Lines of [a-z0-9] words, copyright lines gone, before spellings are made one; the costly steps run where needed."""
    c = F.coalesce(text, F.lit(""))
    ascii_ = F.regexp_replace(F.replace(c, F.lit("©"), F.lit("(c)")), r"[^\x00-\x7F]+", " ")
    c = F.lower(F.when(F.octet_length(c) == F.length(c), c).otherwise(ascii_))
    marked = F.contains(c, F.lit("copyright")) | F.contains(c, F.lit("(c)")) | F.contains(c, F.lit("all rights reserved"))
    without = F.regexp_replace(F.regexp_replace(c, COPYRIGHT, "$1"), RESERVED, "\n")
    words = F.regexp_replace(F.when(marked, without).otherwise(c), r"[^a-z0-9\n]+", " ")
    return F.filter(F.transform(F.split(words, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def _spelt(c: Column) -> Column:
    for old, new in SPELLINGS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def canonical(text: Column) -> Column:
    return _spelt(F.array_join(_lines(text), " "))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "licence_id string, text string")


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, canonical_sha256, licence_id, n_notices, notices) of each row.

    ``licence_id``: the whole text is this known text (null if none). ``notices``: ids of the known texts that stand on a
    line of their own, sorted and comma-joined; ``n_notices`` counts such lines. ``known`` has (licence_id, text).
    """
    table = known.select("licence_id", canonical(F.col("text")).alias("c")).where("c <> ''")
    table = stored(table.groupBy("c").agg(F.min("licence_id").alias("licence_id")), "known")
    # a line can only be a known text if it is as long as one: at most as many lengths as the longest text has
    lengths = [r.n for r in table.select(F.length("c").alias("n")).distinct().collect()]
    table = table.select(digest(F.col("c")).alias("known"), "licence_id")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("row"), _lines(F.col("text")).alias("lines"))
    spelt = F.filter(F.transform("lines", _spelt), lambda x: F.length(x).isin(lengths)) if lengths else F.array().cast("array<string>")
    rows = rows.select(
        "doc_id", "row", digest(_spelt(F.array_join("lines", " "))).alias("canonical_sha256"), F.transform(spelt, digest).alias("likely")
    )
    rows = stored(rows, "digests")
    table = broadcast_up_to(table, SMALL_ROWS)
    # rows that are alike in id and text have the same lines; they are looked up once
    once = rows.where("size(likely) > 0").dropDuplicates(["doc_id", "row"])
    found = once.select("doc_id", "row", F.explode("likely").alias("known")).join(table, "known")
    notices = found.groupBy(F.col("doc_id").alias("n_doc"), F.col("row").alias("n_row")).agg(
        F.count("*").alias("n_notices"), F.array_join(F.array_sort(F.collect_set("licence_id")), ",").alias("notices")
    )
    out = rows.drop("likely").join(table.withColumnRenamed("known", "canonical_sha256"), "canonical_sha256", "left")
    same = F.col("doc_id").eqNullSafe(F.col("n_doc")) & (F.col("row") == F.col("n_row"))
    return out.join(notices, same, "left").select(
        "doc_id", "canonical_sha256", "licence_id", F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices")
    )
