"""Licence scan by canonical digests (DataFrame functions only).

A text is brought to canonical form: lower case, copyright lines out, one space
for anything that is neither letter nor digit, equivalent spellings made one.
The SHA-256 of the canonical form is joined with the digests of known licence
texts and notices, which are normalised by the same expression.  Whole texts are
looked up, and so is every line, as notices stand on lines of their own.

The table of known digests is a literal of this module (or the caller's,
counted before it is broadcast; a larger one is joined by shuffle).

Edge cases: null or empty texts, and texts of punctuation only, have the empty
canonical form, which is no licence; of several known texts with one digest the
smallest name counts; repeated rows are separate rows; rows of one id share
their notices; a null id works as any other; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, bounded, id_and_text

MAX_BROADCAST = 100_000

# What a copyright line begins with, what counts as punctuation,
# and words that are spelt in two ways.
COPYRIGHT = (r"(^|\n)[\x00-\x09\x0B-\x27\x2A-\x2F\x3A-\x60\x7B-\x7F]*"
             r"(copyright[ \t:,]*(\(c\)|©|[0-9]|\[|<|\{)|©|\(c\)|all rights reserved)[^\n]*")
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPELLINGS = [("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("organisation", "organization"),
             ("organisations", "organizations"), ("authorisation", "authorization"), ("authorised", "authorized"),
             ("acknowledgement", "acknowledgment"), ("merchantibility", "merchantability"), ("favour", "favor"),
             ("non commercial", "noncommercial"), ("sub license", "sublicense"), ("analogue", "analog"),
             ("judgement", "judgment"), ("behaviour", "behavior"), ("modelling", "modeling"), ("whilst", "while"),
             ("wilful", "willful"), ("programme", "program"), ("v 2 0", "version 2 0")]

# Licence texts and notices by name.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted"""
_ISC_REST = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""
_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_REST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
KNOWN = [
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("0BSD", f"{_ISC_GRANT}.\n{_ISC_REST}"), ("0BSD", f"BSD Zero Clause License\n{_ISC_GRANT}.\n{_ISC_REST}"),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_REST}"),
    ("ISC", f"ISC License\n{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_REST}"),
    ("BSD-2-Clause", f"{_BSD_2}\n{_BSD_REST}"), ("BSD-2-Clause", f"BSD 2-Clause License\n{_BSD_2}\n{_BSD_REST}"),
    ("BSD-3-Clause", f"{_BSD_2}\n{_BSD_3}\n{_BSD_REST}"), ("BSD-3-Clause", f"BSD 3-Clause License\n{_BSD_2}\n{_BSD_3}\n{_BSD_REST}"),
    ("Zlib", _ZLIB), ("Zlib", "zlib License\n" + _ZLIB),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"), ("ISC", "SPDX-License-Identifier: ISC"),
]

# SPDX ids and names in notices, by licence.
_GNU = [(short, long, v) for short, long, versions in (
    ("GPL", "GNU General Public License", "1.0 2.0 3.0"), ("LGPL", "GNU Lesser General Public License", "2.1 3.0"),
    ("LGPL", "GNU Library General Public License", "2.0"), ("AGPL", "GNU Affero General Public License", "3.0"),
    ("GFDL", "GNU Free Documentation License", "1.1 1.2 1.3")) for v in versions.split()]
_CC = [("-".join(kind), v) for kind in (["BY"], ["BY", "SA"], ["BY", "ND"], ["BY", "NC"], ["BY", "NC", "SA"], ["BY", "NC", "ND"])
       for v in ("2.0", "2.5", "3.0", "4.0")]
NAMED = [
    ("MIT", ["MIT"], ["MIT License", "MIT"]), ("ISC", ["ISC"], ["ISC License"]), ("0BSD", ["0BSD"], ["BSD Zero Clause License"]),
    ("Zlib", ["Zlib"], ["zlib License"]), ("Unlicense", ["Unlicense"], ["Unlicense"]), ("BSL-1.0", ["BSL-1.0"], ["Boost Software License, Version 1.0"]),
    ("BSD-2-Clause", ["BSD-2-Clause"], ["BSD 2-Clause License", "Simplified BSD License"]),
    ("BSD-3-Clause", ["BSD-3-Clause"], ["BSD 3-Clause License", "New BSD License"]),
    ("Apache-2.0", ["Apache-2.0"], ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"]),
    ("MPL-1.1", ["MPL-1.1"], ["Mozilla Public License, Version 1.1", "Mozilla Public License 1.1"]),
    ("MPL-2.0", ["MPL-2.0"], ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"]),
    ("EPL-1.0", ["EPL-1.0"], ["Eclipse Public License 1.0"]), ("EPL-2.0", ["EPL-2.0"], ["Eclipse Public License 2.0"]),
    ("Artistic-1.0-Perl", ["Artistic-1.0-Perl"], []), ("Artistic-2.0", ["Artistic-2.0"], ["Artistic License 2.0"]),
    ("CC0-1.0", ["CC0-1.0"], ["CC0 1.0", "CC0 1.0 Universal"]),
    *((f"CC-{k}-{v}", [f"CC-{k}-{v}"], [f"CC {k} {v}"]) for k, v in _CC),
    *((f"{s}-{v}", [f"{s}-{v}", f"{s}-{v}-only", f"{s}-{v}-or-later"],
       [f"{name}{sep}version {n}{later}" for name in (long, f"{long} ({s})") for sep in (" ", ", ")
        for n in {v, v.removesuffix(".0")} for later in ("", " only", " or later", " or any later version")])
      for s, long, v in _GNU),
]
KNOWN += sorted({(licence, f"SPDX-License-Identifier: {i}") for licence, ids, _ in NAMED for i in ids}
                | {(licence, f"{start} {the}{name}.") for licence, _, names in NAMED for name in names for the in ("the ", "")
                   for start in ("Licensed under", "Released under", "Distributed under", "This work is licensed under")})

# Digests of whole texts, those of Debian's common-licenses; the
# ones with an appendix also without it, with and without the line that ends
# the terms.
DIGESTS = [
    ("Apache-2.0", "045649cdaf85384ba827242062f2f3b36409835c98d297e25177cb1faf7c2847"),
    ("Apache-2.0", "108490d21e2d3edc9128233e48fabc169818d0c7c5f0bbdd58231a367d2d6c87"),
    ("Apache-2.0", "6ed232a1aaf66db92997c53c056b853f2a64b9f74585489f71cbae1bb4d6d166"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "1cfb6cca26abe2169c9c61164807107b2d4a0b64955a2cf2de46fad3483acda1"),
    ("MPL-2.0", "de0e0bad5657ae87b52462bd6dcfbfa29b0e1c9cdb1af2703a8760bce580dd61"),
]


def canonical(text: Column) -> Column:
    """Canonical form of a text."""
    out = F.regexp_replace(ascii_lower(text), COPYRIGHT, "\n")
    # Two spaces between words, so that neighbouring words don't share one.
    out = F.concat(F.lit("  "), F.regexp_replace(out, PUNCTUATION, "  "), F.lit("  "))
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """``(digest, licence)`` of known ``(licence, text)`` rows; by default those
    of :data:`KNOWN`, and :data:`DIGESTS`."""
    rows = known if isinstance(known, DataFrame) else spark.createDataFrame(known or KNOWN, "licence string, text string")
    rows = rows.select("licence", canonical(F.col("text")).alias("c")).filter("c <> ''") \
               .select("licence", F.sha2("c", 256).alias("digest"))
    if not isinstance(known, DataFrame) and not known:
        rows = rows.unionByName(spark.createDataFrame(DIGESTS, "licence string, digest string"))
    return (rows.groupBy("digest").agg(F.min("licence").alias("licence")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         known: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """Per row of ``docs``: ``(id, digest, licence, notices, n_notice_lines)``:
    the whole text's digest and licence (null: unknown), the sorted licences
    that its lines are notices of, and how many lines are."""
    table = known_digests(docs.sparkSession, known)
    table = F.broadcast(table) if bounded(table, MAX_BROADCAST) else table
    src = id_and_text(docs, id_col, text_col)
    lines = src.select("_id", F.explode(F.split("_text", "\n")).alias("line")) \
               .filter(F.length("line") > 0).select("_id", digest(F.col("line")).alias("digest"))
    notices = (lines.join(table, "digest").groupBy("_id", "licence").agg(F.count(F.lit(1)).alias("n"))
                    .groupBy("_id").agg(F.sort_array(F.collect_set("licence")).alias("notices"),
                                        F.sum("n").alias("n_notice_lines"))
                    .withColumnRenamed("_id", "_nid"))
    whole = src.select("_id", digest(F.col("_text")).alias("digest")).join(table, "digest", "left")
    return (whole.join(notices, F.col("_id").eqNullSafe(F.col("_nid")), "left")
                 .select(F.col("_id").alias(id_col), "digest", "licence",
                         F.coalesce("notices", F.array().cast("array<string>")).alias("notices"),
                         F.coalesce("n_notice_lines", F.lit(0).cast("long")).alias("n_notice_lines")))
