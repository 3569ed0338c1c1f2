"""License scans: canonical digest lookup.

Entire texts are brought to a canonical form and their SHA-256 is hash-joined
to the digests of known licence texts. Units looked up are the whole document
and each of its lines, since a notice often stands as a line of its own. The
form: A-Z lower-cased; lines that state a copyright dropped; punctuation and
white space to single spaces; equivalent spellings to one of them. How a text
is wrapped makes no difference.

A line states a copyright if it begins with the word or the sign and goes on
with a sign, a year, a placeholder or "by", or if it is a paragraph of its own
that begins with the word; an "all rights reserved" line after it goes too.
Lines of running text that happen to begin with "copyright" stay.

Known are the texts of ``TEXTS`` and ``NOTICES`` and the digests of
``LONG_TEXTS``; a caller may pass any other table of texts. Every line is
looked up by its digest, whatever words it has.

Defined cases: a null or empty text has the digest of the empty form and
matches nothing; repeated rows and null ids each give their own row; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockmap.llm.common import lower_ascii, table

_LEAD = r"[ \t/*#;-]*+"
#: Lines that state a copyright, in lower case: with a sign, year, placeholder or "by"; or a paragraph of their own.
SIGNED = (rf"(?m)^{_LEAD}(?:copyright[ \t]*+(?:\(c\)|©|[0-9\[<{{]|by )|©|\(c\)[ \t]*+(?:copyright|[0-9]{{4}}))[^\n]*+"
          rf"(?:\n{_LEAD}all rights reserved\.?[ \t\r]*+$)?")
ALONE = rf"(^|\n[ \t\r]*+\n){_LEAD}copyright [^\n]*+(?=\n[ \t\r]*+\n|\s*$)"
#: What becomes one space; a line feed stays until lines have been cut.
BREAKS = r"[\x09\x0B-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E‘’“”–—©]+"
#: Equivalent spellings, taken in this order after punctuation is gone.
SPELLINGS = (("licenc", "licens"), ("sub licens", "sublicens"), ("non commercial", "noncommercial"), ("https", "http"),
             ("merchantibility", "merchantability"), ("acknowledgement", "acknowledgment"), ("favour", "favor"),
             ("wilful", "willful"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
             ("third party", "thirdparty"))

#: One-line notices.
NOTICES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\");"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3."],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "Released under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License."],
    "ISC": ["Licensed under the ISC License.", "Released under the ISC License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Released into the public domain under CC0 1.0.", "Dedicated to the public domain under CC0 1.0."],
}

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

#: Whole licence texts, with and without their title.
TEXTS = {
    "MIT": [_MIT_GRANT, "MIT License\n\n" + _MIT_GRANT, "The MIT License (MIT)\n\n" + _MIT_GRANT],
    "ISC": [f"{t}{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_END}" for t in ("", "ISC License\n\n")],
    "0BSD": [f"{t}{_ISC_GRANT}.\n\n{_ISC_END}" for t in ("", "Zero-Clause BSD\n\n", "BSD Zero Clause License\n\n")],
    "BSD-2-Clause": [f"{t}{_BSD_START}\n\n{_BSD_END}" for t in ("", "BSD 2-Clause License\n\n")],
    "BSD-3-Clause": [f"{t}{_BSD_START}\n\n{_BSD_THIRD}\n\n{_BSD_END}" for t in ("", "BSD 3-Clause License\n\n")],
    "Zlib": [_ZLIB, "zlib License\n\n" + _ZLIB],
}


#: SHA-256 of the canonical form of long licence texts as they are published, whole and without the
#: instructions for use at their end.
LONG_TEXTS = {
    "Apache-2.0": ["b0a2dab3ce68eb7c1f121bf890789e792dfc4e81090faa8a6da8071e7556015c",
                   "ea26a3cd60656c046ac835621f2e72a47d2451ffaf16444cde8df4800537139d",
                   "14e24c037329b9c34e609174998e9b9ee44eeecad8f46ba41c1136f7ca7f8e59"],
    "Artistic-1.0": ["e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"],
    "CC0-1.0": ["96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"],
    "GFDL-1.2": ["15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b",
                 "1dbd72b6f124a1058e786b52a9d4afe44543b834a3aa44faf6c18b747c9de8e2"],
    "GFDL-1.3": ["2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d",
                 "911b9e1b02471fa9b19ec482d019380acd7e0fef00ffbd4395e8813b06533fe7"],
    "GPL-1.0": ["15a090d3b2dce1610cf78de541f782893c006a72a2cf1d41bc4dc2c2b21d7d9c",
                "1f502d4d22d5c158ffe9d77163a11fe4e5ea60251614d2db9275fd4db335821a",
                "f03eb01e3dec898d2df3f08c8fe604557941dadf7d49fd2814cbec8053af14b5",
                "a0e3cfb4938b6e7afd7b81c2b532de5e3b32eb2ea551d51d63f2bf135b8ff71b"],
    "GPL-2.0": ["00d1bdfff6eb75de263bd9b57fbecbda62b20e2edd9f05b0e6af5916bd17c600",
                "682e501a92253121c695532452838b532b29e148160d0c47da7ca9e677065134",
                "de481ce2c6b105a2ab6c850e6d89ce530c921f63852dc5371a53a2c4a2f1412f"],
    "GPL-3.0": ["d00fcd93f37b60bf6e681c2cfd8fa0f2ff6aa27bcdf3aca8795f7868da932d45",
                "b5af3bf26fd02344270931d1f57a2d61bb2de970cb598a2468728e4617ccd991",
                "ddcbd01234639db7802e814958dac8df0a2984a8224079a390a094333e441d8f"],
    "LGPL-2.0": ["61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908",
                 "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2",
                 "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"],
    "LGPL-2.1": ["4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891",
                 "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df",
                 "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"],
    "LGPL-3.0": ["aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"],
    "MPL-1.1": ["c2905659e59dcffa390070bbbc9d3988b5c4c0a0a3461c3905ce96eff32323b1"],
    "MPL-2.0": ["561de4bd870b8a96128e2476d5d4a50f4a2aca16288ea6f3456cf0fde909f621"],
}


def canonical_lines(text: Column) -> Column:
    """The canonical form of a text (null: empty) with its line feeds, before equivalent spellings."""
    s = lower_ascii(F.coalesce(text, F.lit("")))
    s = F.regexp_replace(F.regexp_replace(s, SIGNED, ""), ALONE, "$1")
    return F.regexp_replace(s, BREAKS, " ")


def _spelled(s: Column) -> Column:
    for variant, one in SPELLINGS:
        s = F.replace(s, F.lit(variant), F.lit(one))
    return s


def joined(lines: Column) -> Column:
    """One canonical form of canonical lines."""
    return _spelled(F.trim(F.regexp_replace(lines, r"[ \n]+", " ")))


def canonical(text: Column) -> Column:
    """The canonical form of a text (null: empty)."""
    return joined(canonical_lines(text))


def known_texts(spark: SparkSession) -> DataFrame:
    """``license``, ``text`` of the built-in licences; a caller may pass a larger table of this form."""
    rows = [(k, t) for known in (NOTICES, TEXTS) for k, texts in known.items() for t in texts]
    return spark.createDataFrame(rows, "license string, text string")


def digests(known: DataFrame) -> DataFrame:
    """``digest``, ``license``: one licence for each digest (the first by name, should two have the same text); long texts included."""
    long = known.sparkSession.createDataFrame([(d, k) for k, found in LONG_TEXTS.items() for d in found], "digest string, license string")
    return known.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license").unionByName(long).groupBy("digest").agg(
        F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, canonical_sha256, license, notices, n_notice_lines.

    ``license`` names the licence that the whole text is, or null; ``notices``
    the licences of its lines, sorted and comma-joined, empty if none.
    """
    lines = F.split("lines", "\n")
    units = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), canonical_lines(F.col("text")).alias("lines"))
             .withColumn("_uid", F.monotonically_increasing_id())
             .select("_uid", "doc_id", F.posexplode(F.concat(F.array(joined(F.col("lines"))), F.when(F.size(lines) > 1, F.transform(
                 lines, lambda x: _spelled(F.trim(x)))).otherwise(F.array().cast("array<string>")))).alias("pos", "unit")))
    # Lines of nothing but breaks have no words to know.
    units = units.filter("pos = 0 OR unit <> ''").select("_uid", "doc_id", "pos", F.sha2("unit", 256).alias("digest"))
    # Only whole texts and known lines go on to the shuffle.
    found = units.join(digests(known), "digest", "left").filter("pos = 0 OR license IS NOT NULL")
    whole = F.col("pos") == 0
    return found.groupBy("_uid", "doc_id").agg(
        F.max(F.when(whole, F.col("digest"))).alias("canonical_sha256"),
        F.max(F.when(whole, F.col("license"))).alias("license"),
        F.array_join(F.array_sort(F.collect_set(F.when(~whole, F.col("license")))), ",").alias("notices"),
        F.count(F.when(~whole, F.col("license"))).alias("n_notice_lines")).drop("_uid")


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licences of every whole text of ``documents`` and of its lines."""
    return scan(table(spark, sf_dir, "documents"), known_texts(spark))
