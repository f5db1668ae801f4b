"""License scans by conditional compression.

A license cue anchors candidate blocks: for every known wording that has the cue, a block of that wording's length whose
cue lies where the wording's does, or up to SHIFT words off, whatever line breaks or words stand before it. Blocks that have
too few of the wording's words to be confirmed are passed over; the others are compressed twice: alone, and with the wording
as a raw dictionary. The wordings are ranked by how much smaller the dictionary makes the block, and those that pass are confirmed
by comparing words: the report names every word that is missing or added, so near wordings (another version, another name)
stay apart. Of those confirmed the one with the most words found stays.

Defined cases: null and empty texts, and an empty table, give no rows; a text of any length is read whole; a document gives one
row for each confirmed block, in order, blocks don't overlap; of wordings with equally many words found the exact one stays, then the
block nearest to its cue's place, then the first by gain; repeated documents each give theirs; ids pass as they are, null ones too;
other columns, whatever their names, are not read. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame

from tidewright.llm.common import per_text

#: Public license wordings and notices, by SPDX identifier.
WORDINGS = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LicenseRef-BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. This software is provided by the copyright holders and contributors \"as is\""),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)
_CUE = re.compile(r"licen[sc]|rights[\s*#/;>|%-]+reserved|permission|redistribution|redistribute|creative[\s*#/;>|%-]+commons|unencumbered", re.IGNORECASE)
#: Every cue has one of these.
_HINTS = ("licens", "licenc", "reserved", "permission", "redistribut", "creative", "unencumbered")
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
SHIFT = 3  # words that a block may begin before or after the place that its cue gives
LEAST_SHARE = 0.85  # of the wording's words that the block must have, in order
LEAST_GAIN = 0.2


def _cues(text: str, starts: list[int]):
    """(kind, index of the word it is in, start) of every cue; starts are those of the text's words."""
    for m in _CUE.finditer(text):
        yield m[0][:4].lower(), bisect.bisect_right(starts, m.start()) - 1, m.start()


@lru_cache(maxsize=1)
def _templates():
    import zstandard

    out = []
    for name, text in WORDINGS:
        found = list(_WORD.finditer(text))
        words = [m[0].lower() for m in found]
        cues: dict[str, list[int]] = {}
        for kind, at, _ in _cues(text, [m.start() for m in found]):
            cues.setdefault(kind, []).append(at)
        shared = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        out.append((name, words, Counter(words), cues, zstandard.ZstdCompressor(level=9, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False)))
    plain = zstandard.ZstdCompressor(level=9, write_content_size=False, write_checksum=False)
    return out, plain


def word_differences(template: list[str], block: list[str]) -> tuple[float, list[str]]:
    """The share of the template's words found in order, and the wording differences: -word missing, +word added."""
    match = difflib.SequenceMatcher(None, template, block, autojunk=False)
    diffs = []
    for op, a, b, c, d in match.get_opcodes():
        if op != "equal":
            diffs += [f"-{w}" for w in template[a:b]] + [f"+{w}" for w in block[c:d]]
    return sum(m.size for m in match.get_matching_blocks()) / len(template), diffs


def _reaches(template: list[str], block: list[str], at: int) -> bool:
    """Whether a word of the block lies between those found in the template: a block isn't taken for a cue before or after it."""
    met = [m for m in difflib.SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks() if m.size]
    return bool(met) and met[0].b <= at < met[-1].b + met[-1].size


def licenses_in(text: str | None) -> list[tuple[int, int, str, float, float, bool, str]]:
    """(start, end, license, gain, share, exact, differences) of each confirmed block."""
    if not text or not any(c in (low := text.lower()) for c in _HINTS):
        return []
    templates, plain = _templates()
    at = list(_WORD.finditer(text))
    words = [m[0].lower() for m in at]
    found, done = [], 0
    for kind, cue, _ in _cues(text, [m.start() for m in at]):
        if cue < done:
            continue
        ranked = []
        for name, wording, count, cues, conditional in templates:
            least, blocks = LEAST_SHARE * len(wording), {}
            for begin in (cue - k for k in cues.get(kind, ())):
                if (Counter(words[max(done, begin - SHIFT) : begin + SHIFT + len(wording)]) & count).total() >= least:
                    for off in range(-SHIFT, SHIFT + 1):
                        block = max(done, begin + off), min(len(words), begin + off + len(wording))
                        blocks[block] = min(abs(off), blocks.get(block, SHIFT))
            blocks = [(a, b, off) for (a, b), off in sorted(blocks.items()) if a <= cue < b and (Counter(words[a:b]) & count).total() >= least]
            gains = []
            for a, b, _ in blocks:
                block = text[at[a].start() : at[b - 1].end()].lower().encode("utf-8", "surrogatepass")
                alone = len(plain.compress(block))
                gains.append((alone - len(conditional.compress(block))) / alone)
            if blocks:
                ranked.append((max(gains), len(wording), name, wording, list(zip(gains, blocks, strict=True))))
        ranked.sort(key=lambda x: (-round(x[0], 3), -x[1], x[2]))
        best = None
        for _, _, name, wording, blocks in ranked:
            for gain, (a, b, off) in blocks:
                share, diffs = word_differences(wording, words[a:b])
                if gain >= LEAST_GAIN and share >= LEAST_SHARE and _reaches(wording, words[a:b], cue - a):
                    candidate = (round(share * len(wording)), not diffs, -off, b, at[a].start(), at[b - 1].end(), name, gain, share, not diffs, " ".join(diffs))
                    best = max(best, candidate, key=lambda x: x[:3]) if best else candidate
        if best:
            found.append(best[4:])
            done = best[3]
    return found


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per confirmed block: id_col, block_start, block_end, license_id, gain, share, exact, differences."""
    return per_text(docs, id_col, text_col, "block_start long, block_end long, license_id string, gain double, share double, exact boolean, differences string", licenses_in)
