"""Licence scans: normalised text against licence templates by the Dice coefficient of their word bigrams.

A text's units are the text as a whole, its paragraphs (parted by lines without a word) and its lines; each unit and each
template is the set of its distinct bigrams of words (A-Z lower-cased; ASCII letters and digits and all non-ASCII
characters form words). Dice is twice the overlap over the sum of the sizes. At a threshold t an overlap is at least
t * size / (2 - t) of either size, so most units are left out by a count of template bigrams, and a unit is compared
only with templates whose size is within t / (2 - t) of its own.

A null or empty text, or one of a single word, has no bigram and no licence. Of several matches the highest Dice counts,
then the smaller licence name. A paragraph that several licences of one family share is a template of the family, whose
name follows theirs: it counts only where none of them reaches as much.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import map_arrow
from .textbuf import LOWER, U, blocks, keyed_hashes, mix, spans, utf8

THRESHOLD = 0.8


def _gnu(name: str, family: str, kind: str, work: str, version: str, comma: str, titles: tuple[str, ...]) -> list[tuple[str, str]]:
    """The notice of a GNU licence, by paragraphs and as a whole, and the licence's title."""
    grant = f"This {work} is free software{comma} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
    waiver = f"This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details."
    copies = [f"You should have received a copy of the GNU {kind}General Public License along with this {work}{x}" for x in (". If not, see <https://www.gnu.org/licenses/>.", "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.")]
    own = [grant, f"{grant} {waiver}", *[f"{grant} {waiver} {x}" for x in copies], *titles]
    return [(name, x) for x in own] + [(family, x) for x in (waiver, *copies)]


_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
)
#: Wording of public licences and of the notices that name them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("isc", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'),
    ("mit", "Released under the MIT License."),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("0bsd", _ISC[0].split(", provided")[0] + "."),
    ("0bsd", _ISC[0].split(", provided")[0] + ". " + _ISC[1]),
    *[("isc", x) for x in (*_ISC, " ".join(_ISC))],
    *[("mit", x) for x in (*_MIT, " ".join(_MIT))],
    *[("bsd-2-clause", " ".join(x)) for x in (_BSD[:3], (*_BSD[:3], _BSD[4]))],
    *[("bsd-3-clause", " ".join(x)) for x in (_BSD[3:4], _BSD[:4], _BSD)],
    *[("bsd-family", x) for x in (*_BSD[:3], _BSD[4])],
    *[("apache-2.0", x) for x in (*_APACHE, "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/")],
    *_gnu("gpl-2.0", "gpl-family", "", "program", "2", ";", ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991",)),
    *_gnu("gpl-3.0", "gpl-family", "", "program", "3", ":", ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "The GNU General Public License is a free, copyleft license for software and other kinds of works.")),
    *_gnu("lgpl-2.1", "lgpl-family", "Lesser ", "library", "2.1", ";", ("GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",)),
    *_gnu("lgpl-3.0", "lgpl-family", "Lesser ", "program", "3", ":", ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",)),
    *_gnu("agpl-3.0", "agpl-3.0", "Affero ", "program", "3", ":", ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",)),
    ("mpl-2.0", "Mozilla Public License Version 2.0"),
    ("cc0-1.0", "CC0 1.0 Universal"),
    ("cc0-1.0", "Licensed under CC0 1.0."),
    ("cc0-1.0", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work."),
)
#: Bytes that part words.
APART = np.zeros(256, bool)
APART[:128] = [not (48 <= b <= 57 or 97 <= b <= 122) for b in range(128)]


def _bigrams(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * U(0x9E3779B97F4A7C15) + words[1:])


class Matcher:
    def __init__(self, templates: tuple[tuple[str, str], ...], threshold: float):
        self.threshold, self.names, self.sets = threshold, [], []
        for name, text in sorted(templates):
            own = LOWER[np.frombuffer(text.encode(), np.uint8)]
            starts, ends, _ = spans(APART[own], np.array([0, len(own)]))
            grams = np.unique(_bigrams(keyed_hashes(own, starts, ends)))
            if len(grams):
                self.names.append(name)
                self.sets.append(grams)
        self.sizes = np.array([len(s) for s in self.sets])
        every = np.unique(np.concatenate([*self.sets, np.zeros(0, U)]))
        self.known = every
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(every & U(0xFFFF)).astype(np.int64)] = True
        self.least = threshold * (self.sizes.min() if len(self.sizes) else 1) / (2 - threshold)

    def best(self, buf: np.ndarray, offs: np.ndarray) -> list[tuple[float, str] | None]:
        """For each row the best match, if any."""
        out: list[tuple[float, str] | None] = [None] * (len(offs) - 1)
        own = LOWER[buf]
        starts, ends, bounds = spans(APART[own], offs)
        if len(starts) < 2 or not len(self.known):
            return out
        grams = _bigrams(keyed_hashes(own, starts, ends))
        row = np.repeat(np.arange(len(offs) - 1), np.diff(bounds))
        line = np.cumsum(own == 10)[starts]
        # a line without words, whatever else stands in it, parts paragraphs
        part = np.cumsum(np.concatenate([[0], np.diff(line) > 1]))
        hit = self.maybe[(grams & U(0xFFFF)).astype(np.int64)]
        at = np.flatnonzero(hit)
        hit[at] = self.known[np.minimum(np.searchsorted(self.known, grams[at]), len(self.known) - 1)] == grams[at]
        for unit in (row, row + part, row + line):
            inside = unit[:-1] == unit[1:]
            number, held = np.unique(unit[:-1][hit & inside], return_counts=True)
            for u in number[held >= self.least]:
                a, b = np.searchsorted(unit, [u, u + 1])
                got = self._compare(np.unique(grams[a : b - 1]))
                if got and (out[row[a]] is None or (-got[0], got[1]) < (-out[row[a]][0], out[row[a]][1])):
                    out[row[a]] = got
        return out

    def _compare(self, grams: np.ndarray) -> tuple[float, str] | None:
        bound, best = self.threshold / (2 - self.threshold), None
        size = len(grams)
        for k in np.flatnonzero((np.minimum(self.sizes, size) >= bound * np.maximum(self.sizes, size))):
            dice = 2 * len(np.intersect1d(grams, self.sets[k], assume_unique=True)) / (size + int(self.sizes[k]))
            if dice >= self.threshold and (best is None or (-dice, self.names[k]) < (-best[0], best[1])):
                best = (dice, self.names[k])
        return best


def scan(df: DataFrame, id_col: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """For each row: its id, the best ``license`` (null if none) and its ``dice`` (0 if none)."""
    matcher = Matcher(templates, threshold)

    def run(batches):
        for batch in batches:
            buf, offs = utf8(batch.column(1))
            found = [m for a, b in blocks(offs) for m in matcher.best(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m and m[1] for m in found], pa.string()), pa.array([m[0] if m else 0.0 for m in found], pa.float64())], names=[id_col, "license", "dice"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_arrow(df.select(id_col, text), run, f"`{id_col}` {kind}, license string, dice double")


def oracle(templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same scan as SQL."""
    quoted = ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in t) + ")" for t in templates)
    upper, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = f"regexp_extract_all(translate({{}}, '{upper}', '{small}'), '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"
    words = words.replace("{{", "{").replace("}}", "}")
    split = lambda x: words.replace("{}", x, 1)
    gap = r"\n(?:[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n)+"
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH t AS (SELECT name, {pairs} AS b FROM (SELECT name, {split('body')} AS w FROM (VALUES {quoted}) v(name, body))),
lines AS (
  SELECT doc_id, unnest(list_distinct(list_concat([text], regexp_split_to_array(text, '{gap}'), string_split(text, chr(10))))) AS u FROM documents WHERE text IS NOT NULL),
units AS (SELECT doc_id, {pairs} AS b FROM (SELECT doc_id, {split('u')} AS w FROM lines) WHERE len(w) > 1),
scored AS (
  SELECT doc_id, name, 2 * len(list_intersect(units.b, t.b)) / (len(units.b) + len(t.b))::DOUBLE AS dice FROM units, t),
best AS (
  SELECT doc_id, name, dice, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, name) AS k FROM scored WHERE dice >= {threshold})
SELECT d.doc_id, best.name AS license, coalesce(best.dice, 0.0)::DOUBLE AS dice FROM documents d LEFT JOIN best ON best.doc_id = d.doc_id AND best.k = 1
"""
