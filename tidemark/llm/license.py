"""License scans by conditional compression.

Candidate blocks are windows of the words of a whole text around the key words
of a template, whatever line breaks, comment marks or punctuation are between
them. A block of at most some two template lengths is compressed by zstandard
alone and with the template as raw dictionary, under the same parameters; what
the block leaves unexplained of the template is the size of the template
compressed with the block as dictionary. Templates are ranked by bytes saved
less bytes unexplained. Winners are confirmed by the exact word differences; a
wording whose version, clause or name words differ is another license and wins
nothing, and an exact wording stands before an inexact one of the same words.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from difflib import SequenceMatcher
from typing import NamedTuple

import pandas as pd
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Names and wordings of common license statements.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

#: Full wordings and notices of the same and of further licenses: "license:part".
NOTICES = {
    "mit:title": "The MIT License (MIT)",
    "mit:text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "isc:text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-2-clause:conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-3-clause:conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-2.0:header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "gpl-2.0:notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0:notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-2.1:notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-3.0:notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-3.0:notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl-2.0:header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "cc-by-4.0:deed": "https://creativecommons.org/licenses/by/4.0/",
    "cc-by-sa-4.0:deed": "https://creativecommons.org/licenses/by-sa/4.0/",
    "cc-by-nc-4.0:deed": "https://creativecommons.org/licenses/by-nc/4.0/",
    "cc-by-nd-4.0:deed": "https://creativecommons.org/licenses/by-nd/4.0/",
    "cc-by-nc-sa-4.0:deed": "https://creativecommons.org/licenses/by-nc-sa/4.0/",
    "cc-by-nc-nd-4.0:deed": "https://creativecommons.org/licenses/by-nc-nd/4.0/",
}
#: SPDX identifiers, each found by the line that names it.
SPDX = ["MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", *(f"{k}-{v}" for k, vs in {"GPL": ("2.0", "3.0"), "LGPL": ("2.1", "3.0"), "AGPL": ("3.0",)}.items() for v in (f"{x}{y}" for x in vs for y in ("-only", "-or-later"))), *(f"CC-{k}-4.0" for k in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")), "CC0-1.0"]
NOTICES |= {f"{k.lower()}:spdx": f"SPDX-License-Identifier: {k}" for k in SPDX}

#: Words that tell one license from another. A wording without one of its own, or with one more, is not that license.
NAMES = frozenset("mit isc bsd apache mozilla mpl gnu gpl lgpl agpl lesser affero cc cc0 nc nd sa noncommercial noderivatives sharealike".split())
#: The same, but ordinary words elsewhere, so only missing ones count.
CLAUSES = frozenset("by only later clause library attribution general".split())

_WORD = regex.compile(r"[\p{L}\p{N}]+")
_DIGIT = regex.compile(r"\p{N}")
ROW = "block int, start long, license_id string, rank int, saved_bytes long, saved_share double, template_words int, differences int, missing string, added string, exact boolean, unexplained_bytes long, same_license boolean"


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


class Claim(NamedTuple):
    """A template found in words[first:end]."""

    first: int
    end: int
    name: str
    differences: int
    missing: str
    added: str
    same: bool


class LicenseScanner:
    """Scans texts for a set of templates (name -> wording)."""

    def __init__(self, templates: dict[str, str], max_difference: float = 0.2, level: int = 3):
        self.level, self.max_difference = level, max_difference
        self.words = {k: w for k, t in sorted(templates.items()) if (w := _words(t))}
        self.data, self.how, self.plain, self.given = {}, {}, {}, {}
        self.cost, self.need, self.marks, self.keys = {}, {}, {}, {}
        for name, w in self.words.items():
            data = self.data[name] = " ".join(w).encode("utf-8", "surrogatepass")
            raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            # the same parameters with and without the template, for windows of some two template lengths
            how = zstandard.ZstdCompressionParameters.from_level(level, source_size=3 * len(data), dict_size=len(data), write_content_size=False, write_dict_id=False)
            self.how[name] = how
            self.plain[name] = zstandard.ZstdCompressor(compression_params=how)
            self.given[name] = zstandard.ZstdCompressor(compression_params=how, dict_data=raw)
            self.cost[name] = max(1, len(self.plain[name].compress(data)) - len(self.given[name].compress(data)))
            self.need[name] = Counter(w)
            self.marks[name] = Counter(x for x in w if x in NAMES or x in CLAUSES or _DIGIT.search(x))
            # a wording with at most this many words changed still holds one of so many key words and one more
            for key in sorted(set(w), key=lambda x: (-len(x), x))[: self._slack(name) + 1]:
                self.keys.setdefault(key, []).append(name)

    def _slack(self, name: str) -> int:
        return int(self.max_difference * len(self.words[name]))

    def _align(self, name: str, got: list[str]) -> tuple[int, int, int, list[str], list[str], bool] | None:
        """(differences, first and end of the words used, missing, added, same license) of the template against these words."""
        want = self.words[name]
        match = SequenceMatcher(None, want, got, autojunk=False).get_matching_blocks()[:-1]
        if not match:
            return None
        first, end = match[0].b, match[-1].b + match[-1].size
        same = sum(m.size for m in match)
        miss, a = [], 0
        for m in match:
            miss += want[a : m.a]
            a = m.a + m.size
        miss += want[a:]
        alike = not any(w in self.marks[name] for w in miss)
        extra, b = [], first
        for m in match:
            more = got[b : m.b]
            extra += more
            # a number beside a number or the word version makes another version; elsewhere it may be a page or line
            beside = [got[b - 1], got[m.b]] if more else []
            alike &= not any(w in NAMES for w in more)
            alike &= not (any(map(_DIGIT.search, more)) and any(w == "version" or _DIGIT.search(w) for w in beside))
            b = m.b + m.size
        return max(len(want) - same, end - first - same), first, end, miss, extra, alike

    def _starts(self, name: str, words: list[str], lo: int, hi: int) -> list[int]:
        """Places in words[lo:hi] from where a window of the template's length and a fifth holds enough of its words."""
        need, size, slack = self.need[name], len(self.words[name]), self._slack(name)
        have: Counter = Counter()
        held, end, out = 0, lo, []
        for i in range(lo, hi - (size - slack) + 1):
            while end < min(hi, i + size + slack):  # words of the template in the window, each as often as it needs it
                w = words[end]
                end += 1
                if w in need:
                    have[w] += 1
                    held += have[w] <= need[w]
            w = words[i]
            if w not in need:
                continue
            if held >= size - slack:
                out.append(i)
            held -= have[w] <= need[w]
            have[w] -= 1
        return out

    def _blocks(self, name: str, words: list[str], starts: list[int]) -> list[tuple[int, int, int, int]]:
        """(first start, last start, bytes saved, bytes of the template unexplained) of blocks that hold all windows between them."""
        width, how = len(self.words[name]) + self._slack(name), self.how[name]
        out, k = [], 0
        while k < len(starts):
            last = bisect_right(starts, starts[k] + width - 1) - 1
            data = " ".join(words[starts[k] : starts[last] + width]).encode("utf-8", "surrogatepass")
            saved = len(self.plain[name].compress(data)) - len(self.given[name].compress(data))
            block = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            rest = len(zstandard.ZstdCompressor(compression_params=how, dict_data=block).compress(self.data[name]))
            out.append((starts[k], starts[last], saved, rest))
            k = last + 1
        return out

    def _exact(self, name: str, words: list[str], starts: list[int]) -> list[Claim]:
        """The template as it stands; statements do not overlap."""
        want, free, out = self.words[name], 0, []
        for i in starts:
            if i >= free and words[i : i + len(want)] == want:
                free = i + len(want)
                out.append(Claim(i, free, name, 0, "", "", True))
        return out

    def _inexact(self, name: str, words: list[str], starts: list[int], exact: list[Claim], firsts: list[int]) -> list[Claim]:
        """The template with up to a fifth of its words changed, beside its exact statements; closest first, none overlap."""
        slack, width = self._slack(name), len(self.words[name]) + self._slack(name)
        out = []
        for i in starts:
            k = bisect_right(firsts, i) - 1
            if k >= 0 and i < exact[k].end:
                continue
            stop = firsts[k + 1] if k + 1 < len(firsts) else len(words)
            r = self._align(name, words[i : min(stop, i + width)])
            if r and r[0] <= slack:
                out.append(Claim(i + r[1], i + r[2], name, r[0], " ".join(r[3]), " ".join(r[4]), r[5]))
        return _apart(sorted(set(out), key=lambda c: (not c.same, c.differences, c.first, c.end)))

    def statements(self, words: list[str], near: bool = True) -> list[tuple[Claim, int, int, int]]:
        """(claim, rank, bytes saved, bytes unexplained) of the statements in a sequence of words.

        Only stretches within a template's length and a fifth of its key words
        are looked at, and of these only such as hold enough of its words; both
        lose nothing that the word differences would confirm.
        """
        spots: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            for name in self.keys.get(w, ()):
                spots.setdefault(name, []).append(i)
        ranked, exact, firsts = [], {}, {}
        for name, at in spots.items():
            width = len(self.words[name]) + self._slack(name)
            runs: list[list[int]] = []
            for i in at:
                if runs and i - width < runs[-1][1]:
                    runs[-1][1] = i + width
                else:
                    runs.append([max(0, i - width + 1), i + width])
            starts = [i for lo, hi in runs for i in self._starts(name, words, lo, min(hi, len(words)))]
            if starts:
                exact[name] = self._exact(name, words, starts)
                firsts[name] = [c.first for c in exact[name]]
                ranked += [(rest - saved, name, starts[bisect_left(starts, lo) : bisect_right(starts, hi)], saved, rest) for lo, hi, saved, rest in self._blocks(name, words, starts)]
        # exact statements stand, the longest first; then the blocks that saved most are confirmed
        ranked.sort(key=lambda r: r[:3])
        worth = {(r[1], i): r for r in ranked for i in r[2]}
        firm = _apart(sorted((c for cs in exact.values() for c in cs), key=lambda c: (c.first - c.end, c.first, c.name)))
        loose: dict[str, list[Claim]] = {}
        for block in ranked:
            name, starts = block[1:3]
            have = words[starts[0] : starts[-1] + len(self.words[name]) + self._slack(name)]
            if near or not self.marks[name] - Counter(have):
                for c in self._inexact(name, words, starts, exact[name], firsts[name]):
                    worth.setdefault((c.name, c.first), block)
                    loose.setdefault(name, []).append(c)
        loose_claims = [c for cs in loose.values() for c in _apart(sorted(cs, key=lambda c: (not c.same, c.differences, c.first, c.end)))]
        order = sorted((c for c in loose_claims if c.same), key=lambda c: (worth[c.name, c.first][0], c.name, c.first))
        winners = _settle(firm, order)
        rows = [(c, 1, *worth[c.name, c.first][3:]) for c in winners]
        if not near:
            return sorted(rows)
        held = set(winners)
        claims = sorted([*loose_claims, *(c for cs in exact.values() for c in cs)])
        out: list[tuple[Claim, int, int, int]] = []
        run: list[Claim] = []
        reach = 0
        for c in [*claims, None]:
            if run and (c is None or c.first >= reach):
                run.sort(key=lambda x: (x not in held, x.differences > 0, worth[x.name, x.first][0], x.name, x.first))
                out += [(x, k, *worth[x.name, x.first][3:]) for k, x in enumerate(run, 1)]
                run, reach = [], 0
            if c:
                run.append(c)
                reach = max(reach, c.end)
        return out

    def scan(self, text: str | None, near: bool = True) -> list[tuple]:
        """Confirmed statements of a whole text; lines only tell where they begin."""
        if not text:
            return []
        low = text.lower()
        if not any(k in low for k in self.keys):
            return []
        rows = self.statements(_words(text), near)
        if not rows:
            return []
        begin = [m.start() for m in _WORD.finditer(text)]
        lines = [0, *(i + 1 for i, c in enumerate(text) if c == "\n")]
        out = []
        for c, rank, saved, rest in rows:
            number = bisect_right(lines, begin[c.first]) - 1
            out.append((number, lines[number], c.name, rank, saved, saved / self.cost[c.name], len(self.words[c.name]), c.differences, c.missing, c.added, c.differences == 0, rest, c.same))
        return out


def _apart(claims: list[Claim]) -> list[Claim]:
    """Claims in the given order that share no word with one taken before, sorted by place."""
    firsts: list[int] = []
    taken: list[Claim] = []
    for c in claims:
        k = bisect_left(firsts, c.end)
        if k == 0 or taken[k - 1].end <= c.first:
            firsts.insert(k, c.first)
            taken.insert(k, c)
    return taken


def _settle(firm: list[Claim], order: list[Claim]) -> list[Claim]:
    """Exact claims, and of the others, in order, those that share no word with one taken or hold all exact ones they meet and more."""
    taken, firsts = list(firm), [c.first for c in firm]
    for c in order:
        hi = lo = bisect_left(firsts, c.end)
        while lo and taken[lo - 1].end > c.first:
            lo -= 1
        met = taken[lo:hi]
        if all(x.differences == 0 and c.first <= x.first and x.end <= c.end and x.end - x.first < c.end - c.first for x in met):
            taken[lo:hi], firsts[lo:hi] = [c], [c.first]
    return taken


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", near: bool = True) -> DataFrame:
    """License statements in every whole text.

    One row for each confirmed statement of a template, which may run over any
    number of lines: (id_col, block = number from 0 of the line in which it
    begins, start = first character of that line, license_id, rank among the templates
    that claim the same words, saved_bytes and saved_share of the conditional
    compression, template_words, differences, missing and added words, exact,
    unexplained_bytes = what the block does not tell of the template,
    same_license = no version, clause or name word differs).
    A template that a text states twice gives two rows. At most a fifth of a template's words may differ.
    With ``near`` false only winners are returned: one license for the same words, none whose
    version, clause or name differs; an exact wording wins unless a longer one
    holds it. With ``near`` true the other wordings follow as ranks 2 and up, and a wording
    that no license has (same_license false) may stand at rank 1.
    Null and empty texts give no rows;
    repeated rows give theirs each; null ids are carried; ties in saved bytes
    are ranked by name. An empty table gives an empty result. Other columns
    are ignored.
    """
    held = TEMPLATES | NOTICES if templates is None else dict(templates)

    @pandas_udf(f"array<struct<{', '.join(f.replace(' ', ':') for f in ROW.split(', '))}>>")
    def found(texts: pd.Series) -> pd.Series:
        scanner = LicenseScanner(held)
        names = [f.split(" ")[0] for f in ROW.split(", ")]
        return pd.Series([[dict(zip(names, r, strict=True)) for r in scanner.scan(t, near)] for t in texts], dtype=object)

    rows = docs.select(F.col(id_col), found(F.col(text_col)).alias("__f")).where(F.size("__f") > 0)
    return rows.select(F.col(id_col), F.explode("__f").alias("__r")).select(id_col, "__r.*")
