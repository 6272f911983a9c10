"""Operator 5: licence scans by Dice coefficient over word bigrams, with DataFrame operations only.

Units of a text are its lines, the sentences of lines that have several, its paragraphs of several lines (parted by empty
lines), runs of two to RUN consecutive paragraphs, and the whole text where it has several. A unit is normalised (A-Z
lowered, all but a-z and 0-9 to spaces) and compared, as a set of word bigrams, to the templates, normalised alike. Dice is
twice the common bigrams over the sum of both sizes, so that a template of b bigrams can only reach t with a unit of
t / (2 - t) b to (2 - t) / t b of them. A unit outside the bounds of every template, by its words, is never cut into
bigrams; the table of template bigrams has a fixed size and is broadcast.

Defined results: a null or empty text has no matches; a unit of fewer than two words has none; rows are told apart by key
and text, so that rows of equal or null keys keep their own matches and repeated rows give theirs once; texts of any length
are scanned whole; templates that reach the same value are all listed; an empty table gives an empty table; further
columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections import Counter
from fractions import Fraction
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = Fraction(8, 10)
#: Paragraphs in a run, at most; the templates' own texts have up to five.
RUN = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Public licence notices, as their licences word them.
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-notice-licensed": "Licensed under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Unlicense-notice": "This is free and unencumbered software released into the public domain.",
    "BSD-2-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "BSD-3-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "0BSD": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
}


def normal_words(text: str) -> list[str]:
    """The words of a normalised text, as the column expressions give them."""
    return "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in text.translate(str.maketrans(UPPER, LOWER))).split()


def template_rows(templates: dict[str, str] = TEMPLATES) -> list[tuple[str, int, str]]:
    """(template, its number of distinct bigrams, bigram)."""
    out = []
    for name, text in templates.items():
        words = normal_words(text)
        pairs = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
        out += [(name, len(pairs), p) for p in pairs]
    return out


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: Fraction = THRESHOLD, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, unit, unit_no, template, n_common, n_bigrams, n_template, dice) of each unit that reaches the threshold."""
    rows = template_rows(templates)
    num, den = threshold.numerator, threshold.denominator
    sizes = sorted({n for _, n, _ in rows})
    fits = lambda n, words: f"({words} - 1 >= {-(-num * n // (2 * den - num))})"
    # A unit has at most one distinct bigram less than words; repeated ones only lower the number, so that no upper bound
    # holds for words alone but the exact one is tested on the bigrams.
    lines = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    firsts = sorted({p for name in templates for p in _needed([r[2] for r in rows if r[0] == name], num, den)})
    # A text without any of these words, in letters of either case, has no unit that matches.
    words = _key_words({name: [r[2] for r in rows if r[0] == name] for name in templates}, num, den)
    # As an element of an array the lowered text is made once and not for each word.
    long = [w for w in words if len(w) > 4]
    short = "(?i)(?:^|[^a-zA-Z0-9])(?:" + "|".join(w for w in words if len(w) <= 4) + ")(?:$|[^a-zA-Z0-9])"

    def has_word(c: Column) -> Column:
        has_long = F.exists(F.array(F.lower(c)), lambda low: reduce(or_, [F.contains(low, F.lit(w)) for w in long], F.lit(False)))
        return has_long | c.rlike(short) if len(long) < len(words) else has_long

    lines = lines.where(has_word(F.col("text"))).withColumn("row", F.md5(F.col("text").cast("binary")))
    unit = lambda name, parts: F.transform(parts, lambda u, i: F.struct(F.lit(name).alias("unit"), i.alias("unit_no"), u.alias("u")))
    lines = lines.withColumn("blocks", F.split("text", r"\n[\x20\x09-\x0D]*\n")).withColumn("marked", F.transform("blocks", has_word))
    run = lambda i, k: F.struct(F.concat(F.lit("run"), k.cast("string")).alias("unit"), i.alias("unit_no"), F.array_join(F.slice("blocks", i + 1, k), "\n").alias("u"), F.exists(F.slice("marked", i + 1, k), lambda m: m).alias("marked"))
    runs = F.flatten(F.transform(F.sequence(F.lit(0), F.size("blocks") - 2), lambda i: F.transform(F.sequence(F.lit(2), F.least(F.lit(RUN), F.size("blocks") - i)), lambda k: run(i, k))))
    plain = lambda x: F.struct(x["unit"].alias("unit"), x["unit_no"].alias("unit_no"), x["u"].alias("u"))
    several = F.size("blocks") > 1
    sentences = F.flatten(F.filter(F.transform(F.split("text", "\n"), lambda x: F.split(x, r"[.!?]+[\x20\x09]+")), lambda x: F.size(x) > 1))
    units = F.concat(
        unit("line", F.split("text", "\n")),
        unit("sentence", sentences),
        F.filter(unit("paragraph", F.col("blocks")), lambda x: F.instr(F.trim(F.translate(x["u"], "\r\t", "  ")), "\n") > 0),
        F.when(several, F.transform(F.filter(runs, lambda x: x["marked"]), plain)).otherwise(F.array()),
        F.when(several, unit("text", F.array("text"))).otherwise(F.array()),
    )
    # Bigrams beyond the largest template's bound can't be undone by repeats in a unit whose words are that many more, so
    # long units are kept only if distinct bigrams may still be few; the letters bound the words from above cheaply.
    most = max((2 * den - num) * n // num for n in sizes)
    least = min(-(-num * n // (2 * den - num)) for n in sizes)
    u = lines.select("key", "row", F.inline(units)).where(F.length("u") >= 2 * least + 1)
    u = u.withColumn("u", F.trim(F.regexp_replace(F.translate("u", UPPER, LOWER), "[^a-z0-9]+", " ")))
    u = u.where(F.concat(F.lit(" "), F.col("u"), F.lit(" ")).rlike(" (?:" + "|".join(firsts) + ") "))
    u = u.withColumn("w", F.split("u", " ")).where(F.size("w") - 1 >= least)
    pairs = F.array_distinct(F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b)))
    u = u.select("key", "row", "unit", "unit_no", pairs.alias("p")).withColumn("n_bigrams", F.size("p")).where(F.col("n_bigrams").between(least, most)).distinct()
    bigrams = docs.sparkSession.createDataFrame(rows, "template string, n_template int, pair string")
    hits = u.select("key", "row", "unit", "unit_no", "n_bigrams", F.explode("p").alias("pair")).join(F.broadcast(bigrams), "pair")
    hits = hits.where(f"n_bigrams * {2 * den - num} >= {num} * n_template AND n_bigrams * {num} <= {2 * den - num} * n_template")
    found = hits.groupBy("key", "row", "unit", "unit_no", "template", "n_bigrams", "n_template").agg(F.count("*").alias("n_common"))
    found = found.where(f"2 * {den} * n_common >= {num} * (n_bigrams + n_template)")
    dice = 2.0 * F.col("n_common") / (F.col("n_bigrams") + F.col("n_template"))
    return found.select(F.col("key").alias(key), "unit", "unit_no", "template", "n_common", "n_bigrams", "n_template", dice.alias("dice"))


def _key_words(pairs: dict[str, list[str]], num: int, den: int) -> list[str]:
    """A few words of which every matching unit has one: those of more bigrams of each template than may be missing.

    Long words come first, as they are rare in other texts, then those that most templates gain bigrams by.
    """
    own = {name: [set(p.split()) for p in of] for name, of in pairs.items()}
    need = {name: len(of) - -(-num * len(of) // (2 * den - num)) + 1 for name, of in own.items()}
    taken: set[str] = set()
    while True:
        gain: dict[str, int] = {}
        for name, of in own.items():
            open_ = [w for w in of if not w & taken]
            short = need[name] - (len(of) - len(open_))
            if short > 0:
                for x, n in Counter(x for w in open_ for x in w).items():
                    gain[x] = gain.get(x, 0) + min(n, short)
        if not gain:
            return sorted(w for w in taken if not any(x != w and len(x) > 4 and x in w for x in taken))
        taken.add(max(gain, key=lambda x: (min(len(x), 7), gain[x], x)))


def _needed(pairs: list[str], num: int, den: int) -> list[str]:
    """Bigrams of a template of which every unit that reaches the threshold has one: all but as many as may be missing.

    A unit has at least num / (2 den - num) of the template's bigrams in common. Those with long words come first.
    """
    common = -(-num * len(pairs) // (2 * den - num))
    return sorted(pairs, key=lambda p: (-len(p), p))[: len(pairs) - common + 1]


def oracle() -> str:
    values = ", ".join(f"('{t}', {n}, '{p}')" for t, n, p in template_rows())
    return rf"""
WITH tb(template, n_template, pair) AS (VALUES {values}),
d AS (SELECT doc_id, text, regexp_split_to_array(text, '\n[\x20\x09-\x0D]*\n') AS blocks FROM documents WHERE text IS NOT NULL),
units AS (
  SELECT doc_id, 'line' AS unit, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS unit_no, unnest(l) AS u FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM d)
  UNION ALL SELECT * FROM (SELECT doc_id, 'paragraph', CAST(generate_subscripts(blocks, 1) - 1 AS INTEGER), unnest(blocks) AS u FROM d) WHERE instr(trim(translate(u, chr(13) || chr(9), '  '), ' '), chr(10)) > 0
  UNION ALL SELECT doc_id, 'sentence', CAST(generate_subscripts(l, 1) - 1 AS INTEGER), unnest(l) FROM (SELECT doc_id, flatten(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_split_to_array(x, '[.!?]+[\x20\x09]+')), lambda x: len(x) > 1)) AS l FROM d)
  UNION ALL SELECT doc_id, 'run' || k, CAST(i AS INTEGER), array_to_string(blocks[i + 1:i + k], chr(10)) FROM (SELECT doc_id, blocks, k, unnest(range(0, len(blocks) - k + 1)) AS i FROM d, range(2, {RUN + 1}) t(k))
  UNION ALL SELECT doc_id, 'text', 0, text FROM d WHERE len(blocks) > 1),
w AS (SELECT doc_id, unit, unit_no, string_split(trim(regexp_replace(translate(u, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'), ' '), ' ') AS w FROM units),
p AS (SELECT DISTINCT doc_id, unit, unit_no, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pair FROM w WHERE len(w) > 1),
n AS (SELECT *, CAST(count(*) OVER (PARTITION BY doc_id, unit, unit_no) AS INTEGER) AS n_bigrams FROM p),
hits AS (SELECT doc_id, unit, unit_no, template, n_bigrams, n_template, count(*) AS n_common FROM n JOIN tb USING (pair) GROUP BY ALL)
SELECT doc_id, unit, unit_no, template, n_common, n_bigrams, n_template, 2.0::DOUBLE * n_common / (n_bigrams + n_template) AS dice
FROM hits WHERE 10 * n_common >= 4 * (n_bigrams + n_template)
"""
