"""License scans by the Dice coefficient of word bigrams, on DataFrame functions only.

A text is scanned as a whole, by paragraphs, lines and sentences, and by the
paragraphs that are left when the marks of comments are taken off. A unit of a text is
compared with a template only if their sizes allow the threshold. Before
that, a text must hold one of a few words or bigrams of the templates: a unit
that reaches the threshold lacks at most ``spare`` bigrams of its template, so
it holds at least one of any spare + 1 of them.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: Marks that comments put before each line.
MARKS = r"(^|\n)[ \t]*[*/#;%-]+"
SENTENCE = r"[.!?:;][ \t\r\n]+"
PARAGRAPH = r"\n[ \t\r]*\n"
#: Words of so many letters are looked for by themselves.
LONG_WORD = 6

# Notices of public licences, as projects print them.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "Apache-2.0-notice": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License."],
    "MIT-text": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC-text": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."],
    "BSD-2-Clause-text": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License version 3."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
}


def normal_words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    w = normal_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))


def bounds(size: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """The numbers of bigrams that can reach the threshold with a template of that size."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9), math.floor(size * (2 - threshold) / threshold + 1e-9)


def pivots(known: list[list[str]], threshold: float = THRESHOLD) -> tuple[list[str], list[str]]:
    """(words, bigrams) of which any unit that reaches the threshold with any template holds at least one.

    A template needs spare + 1 of its bigrams to hold one of the words or to
    be among the bigrams. Long words are taken first, greedily by how many
    needs they meet; where they do not suffice, whole bigrams are added.
    """
    need = [len(b) - bounds(len(b), threshold)[0] + 1 for b in known]
    left = [set(b) for b in known]
    words: list[str] = []
    gain = lambda w: sum(min(n, sum(w in g.split() for g in rest)) for n, rest in zip(need, left) if n > 0)
    while True:
        long = {w for n, rest in zip(need, left) if n > 0 for g in rest for w in g.split() if len(w) >= LONG_WORD}
        if not long:
            break
        best = min(long, key=lambda w: (-gain(w), -len(w), w))
        words.append(best)
        for i, rest in enumerate(left):
            met = {g for g in rest if best in g.split()}
            need[i] -= len(met)
            left[i] = rest - met
    bigrams = {g for n, rest in zip(need, left) if n > 0 for g in sorted(rest, key=lambda g: (-len(g), g))[:n]}
    return words, sorted(bigrams)


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull()))


def scan(docs: DataFrame, key: list[str], text: str = "text", templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The key columns and license, dice, n_units of each row of docs.

    license is the template that the text's best unit is nearest to, of equals
    the smaller name; n_units counts the different units, as normalised, that
    reach the threshold. A text that does so nowhere, a null or empty one too,
    has null license and dice and 0 units. Repeated rows are scanned each for
    itself; other columns are left out; an empty table gives no rows; texts of
    any length are scanned whole, one in a task. A notice that shares a sentence with
    many other words is not found.
    """
    known = [(name, template_bigrams(t)) for name, texts in (TEMPLATES if templates is None else templates).items() for t in texts]
    known = [(name, b) for name, b in known if b]
    span = [bounds(len(b), threshold) for _, b in known]
    words, pairs_ = pivots([b for _, b in known], threshold)
    some = "|".join(g.replace(" ", "[^a-z0-9]+") for g in pairs_) or "(?!)"
    t, keys = F.col("__wl_t"), [F.col(f"`{k}`") for k in key]

    def near(x: Column) -> Column:
        found = x.rlike(some)
        for w in words:
            found = F.contains(x, F.lit(w)) | found
        return found

    rows = docs.select(*keys, F.lower(F.col(f"`{text}`")).alias("__wl_t"), F.monotonically_increasing_id().alias("__wl_row"))
    units = F.concat(F.array(t), F.split(t, PARAGRAPH), F.split(t, "\n"), F.split(t, SENTENCE), F.split(F.regexp_replace(t, MARKS, "$1"), PARAGRAPH))
    each = rows.select(*keys, "__wl_row", F.explode_outer(F.when(near(t), F.filter(units, near))).alias("u"))
    each = each.withColumn("w", F.array_remove(F.split(F.regexp_replace("u", "[^a-z0-9]+", " "), " "), "")).withColumn("b", _bigrams(F.col("w")))
    sizes = [(n, name, b, len(b)) for (name, b), (low, high) in zip(known, span) for n in range(low, high + 1)]
    sized = docs.sparkSession.createDataFrame(sizes, "n int, license string, tb array<string>, tn int")
    pairs = each.join(F.broadcast(sized), F.size("b") == F.col("n"), "left")  # templates are arguments, not data
    dice = 2.0 * F.size(F.array_intersect("b", "tb")) / (F.size("b") + F.col("tn"))
    good = F.when(dice >= threshold, F.struct((-dice).alias("d"), F.col("license").alias("license")))
    by_unit = pairs.withColumn("good", good).groupBy(*keys, "__wl_row", F.array_join("w", " ").alias("u")).agg(F.min("good").alias("good"))
    best = by_unit.groupBy(*keys, "__wl_row").agg(F.min("good").alias("good"), F.count("good").alias("n_units"))
    return best.select(*keys, F.col("good.license").alias("license"), (-F.col("good.d")).alias("dice"), "n_units")


def sql(table: str = "documents", key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> str:
    """The same scan for DuckDB, without the pruning."""
    rows = ", ".join(f"('{name}', [{', '.join(repr(b) for b in template_bigrams(t))}])" for name, texts in TEMPLATES.items() for t in texts)
    return rf"""
with tpl as (select * from (values {rows}) as v(license, tb)),
d as (select {key}, lower(coalesce({text}, '')) as t, row_number() over () as r from {table}),
u as (select r, unnest(list_distinct(list_concat([t], string_split_regex(t, '{PARAGRAPH}'), string_split(t, chr(10)), string_split_regex(t, '{SENTENCE}'), string_split_regex(regexp_replace(t, '{MARKS}', '\1', 'g'), '{PARAGRAPH}')))) as u from d),
w as (select distinct r, list_filter(string_split(regexp_replace(u, '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') as w from u),
b as (select r, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as b, w from w),
p as (select r, w, license, 2.0::double * len(list_intersect(b, tb)) / (len(b) + len(tb)) as dice from b join tpl on len(b) between ceil(len(tb) * {threshold} / (2 - {threshold}) - 1e-9) and floor(len(tb) * (2 - {threshold}) / {threshold} + 1e-9)),
g as (select r, w, min(struct_pack(d := -dice, l := license)) as best from p where dice >= {threshold} group by r, w),
f as (select r, min(best) as best, count(*) as n_units from g group by r)
select {key}, best.l as license, round(-best.d, 6) as dice, coalesce(n_units, 0)::bigint as n_units from d left join f using (r)
"""
