"""Licence scan by Dice coefficient over word bigrams; DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import ascii_lower, table

# Licence texts and notices, as published.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
_ISC_REST = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"""
_BSD_TWO = """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THREE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_REST = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GPL_FIRST = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""
_UNLICENSE_HEAD = """This is free and unencumbered software released into the public domain."""
_APACHE_HEAD = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""
TEMPLATES = {
    "MIT": f"""{_MIT_GRANT}

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT-grant": _MIT_GRANT,
    "MIT-notice": "Released under the MIT License.",
    "ISC": f"{_ISC_GRANT}\n\n{_ISC_REST}",
    "ISC-grant": _ISC_GRANT,
    "0BSD": f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n{_ISC_REST}",
    "Apache-2.0-head": _APACHE_HEAD,
    "Apache-2.0": f"""{_APACHE_HEAD}

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-first": _GPL_FIRST,
    "GPL-3.0": f"""{_GPL_FIRST}

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-head": _BSD_HEAD,
    "BSD-2-Clause": f"{_BSD_HEAD}\n\n{_BSD_TWO}\n\n{_BSD_REST}",
    "BSD-3-Clause": f"{_BSD_HEAD}\n\n{_BSD_TWO}\n{_BSD_THREE}\n\n{_BSD_REST}",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense-head": _UNLICENSE_HEAD,
    "Unlicense": f"""{_UNLICENSE_HEAD}

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org/>""",
}
#: Words that are in much other text too; anchors are sought among the others first.
COMMON = set("0 2 3 a above all an and any are as at be by can do following for from general in included including is it its made may must name not of on or other public provided terms that the this to under use version we whether will with without work you your".split())
#: Lines apart up to which lines with licence words belong to one run.
GAP = 3


def words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def bigrams(text: str) -> list[str]:
    w = words(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})


def anchors(least: float) -> list[str]:
    """Words of which a unit must hold one to reach the least Dice with any template: at that value a unit shares
    least / (2 - least) of a template's bigrams, and the words chosen for it occur in more than the rest. Words that are
    anchors already, then uncommon ones of many bigrams, come first."""
    out: set[str] = set()
    for text in sorted(TEMPLATES.values(), key=len):
        own, left = bigrams(text), set(bigrams(text))
        while len(left) >= least / (2 - least) * len(own):
            held = {w: sum(w in b.split(" ") for b in left) for w in set(words(text)) - COMMON} or dict.fromkeys(words(text), 1)
            word = max((w for w in held if held[w]), key=lambda w: (w in out, held[w], len(w), w), default=None) or max(set(words(text)), key=lambda w: (sum(w in b.split(" ") for b in left), w))
            out.add(word)
            left = {b for b in left if word not in b.split(" ")}
    return sorted(out)


def vocabulary() -> list[str]:
    """The templates' words of six letters and more, but for common ones."""
    return sorted({w for text in TEMPLATES.values() for w in words(text) if len(w) >= 6} - COMMON)


def _runs(places: str, gap: int) -> str:
    """SQL: ascending places as structs (a, b) of the runs in which neighbours are at most gap apart."""
    edge = "transform(filter(sequence(0, size({p}) - 1), k -> {test}), k -> {p}[k])"
    first = edge.format(p=places, test=f"k = 0 OR {places}[k] - {places}[k - 1] > {gap}")
    last = edge.format(p=places, test=f"k = size({places}) - 1 OR {places}[k + 1] - {places}[k] > {gap}")
    both = f"zip_with({first}, {last}, (a, b) -> struct(a, b))"
    return f"CASE WHEN size({places}) = 0 THEN cast(array() AS array<struct<a:int,b:int>>) ELSE {both} END"


def licence_units(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id, first_line, last_line, license, dice: stretches of lines whose bigram set reaches the least Dice with a template.

    The stretches tried are each line, each paragraph (lines up to a blank one), each run of lines with licence words (words of
    the vocabulary, at most GAP lines apart), and the whole text; each once, from line 0. So a licence is found on one line,
    wrapped, in several paragraphs, and inside other text. Sizes prune templates: sets a and b reach the least only if
    a >= b * least / (2 - least) and the other way round. Texts without an anchor word are left out first. Null and empty texts
    give no row; repeated rows give theirs each; an empty table gives none; other columns are not read."""
    hit = f"(?i)\\\\b({'|'.join(anchors(least))})\\\\b"
    low = docs.where(f"text RLIKE '{hit}'").selectExpr("doc_id", f"split({ascii_lower()}, '\n') AS lines")
    known = ", ".join(f"'{w}'" for w in vocabulary())
    numbers = "filter(sequence(0, size(lines) - 1), i -> {})"
    low = low.selectExpr(
        "doc_id", "lines", numbers.format(f"lines[i] RLIKE '{hit}'") + " AS hits", numbers.format("lines[i] RLIKE '[^ \\t\\r\\f]'") + " AS full",
        numbers.format(f"arrays_overlap(regexp_extract_all(lines[i], '[a-z0-9]+', 0), array({known}))") + " AS worded",
    ).where("size(hits) > 0")
    spans = f"concat(array(struct(0 AS a, size(lines) - 1 AS b)), transform(hits, i -> struct(i AS a, i AS b)), {_runs('full', 1)}, {_runs('worded', GAP)})"
    units = low.selectExpr("doc_id", "lines", "hits", f"explode(array_distinct({spans})) AS s").where("exists(hits, i -> i BETWEEN s.a AND s.b)")
    units = units.selectExpr("doc_id", "s.a AS first_line", "s.b AS last_line", "regexp_extract_all(array_join(slice(lines, s.a + 1, s.b - s.a + 1), ' '), '[a-z0-9]+', 0) AS w")
    units = units.where("size(w) > 1").selectExpr("doc_id", "first_line", "last_line", "array_distinct(transform(sequence(1, size(w) - 1), i -> concat(w[i - 1], ' ', w[i]))) AS b")
    ratio = least / (2 - least)
    tests = []
    for name, text in TEMPLATES.items():
        own = bigrams(text)
        literal = ", ".join(f"'{b}'" for b in own)
        dice = f"2D * size(array_intersect(b, array({literal}))) / (size(b) + {len(own)})"
        tests.append(f"CASE WHEN size(b) >= {len(own) * ratio!r}D AND size(b) <= {len(own) / ratio!r}D THEN struct('{name}' AS license, {dice} AS dice) END")
    found = units.select("doc_id", "first_line", "last_line", F.explode(F.expr(f"array({', '.join(tests)})")).alias("m"))
    return found.select("doc_id", "first_line", "last_line", "m.license", "m.dice").where(F.col("dice") >= least)


def op7_licenses(spark, sf_dir):
    return licence_units(table(spark, sf_dir, "documents"))


def sql(least: float = 0.8) -> str:
    """By rows instead of arrays: lines and words are unnested, runs are islands of line numbers, shared bigrams are counted
    through an inverted index of the templates."""
    rows = ", ".join("('%s', '%s')" % (n, b) for n, t in TEMPLATES.items() for b in bigrams(t))
    known = "|".join(vocabulary())
    runs = "SELECT r, min(i) AS a, max(i) AS b FROM (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS run FROM (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= {} THEN 0 ELSE 1 END AS opens FROM l WHERE {})) GROUP BY r, run"
    return f"""
WITH tpl(license, g) AS (VALUES {rows}),
n AS (SELECT license, count(*) AS tn FROM tpl GROUP BY license),
d AS (SELECT doc_id, row_number() OVER () AS r, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d2 AS (SELECT r, doc_id, string_split(t, chr(10)) AS ls FROM d),
l AS MATERIALIZED (SELECT r, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM d2),
s AS (SELECT r, 0 AS a, max(i) AS b FROM l GROUP BY r UNION SELECT r, i, i FROM l
      UNION {runs.format(1, "regexp_matches(line, '[^ \t\r\f]')")}
      UNION {runs.format(GAP, f"regexp_matches(line, '(^|[^a-z0-9])({known})($|[^a-z0-9])')")}),
u AS (SELECT s.r, a, b, regexp_extract_all(string_agg(line, ' ' ORDER BY i), '[a-z0-9]+') AS w FROM s JOIN l ON l.r = s.r AND i BETWEEN a AND b GROUP BY s.r, a, b),
g AS MATERIALIZED (SELECT r, a, b, unnest(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM u WHERE len(w) > 1),
m AS (SELECT r, a, b, count(*) AS un FROM g GROUP BY ALL),
x AS (SELECT r, a, b, license, count(*) AS shared FROM g JOIN tpl USING (g) GROUP BY ALL)
SELECT doc_id, CAST(a AS INTEGER) AS first_line, CAST(b AS INTEGER) AS last_line, license, 2.0::DOUBLE * shared / (un + tn) AS dice
FROM x JOIN m USING (r, a, b) JOIN n USING (license) JOIN d USING (r) WHERE 2.0::DOUBLE * shared / (un + tn) >= {least}
"""
