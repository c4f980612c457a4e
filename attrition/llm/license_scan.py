"""Licence scan: normalised text compared to licence templates by the Dice coefficient over word bigrams.

The units compared are the lines, the sentences, the paragraphs (blocks between blank lines) and the whole of a text, so
that a notice inside prose is found as well as a licence file. A notice of several sentences that runs into other text without
a blank line is found by those of its sentences that tell the licence. Long notices are templates as a whole and, where a paragraph
tells the licence, by paragraph; paragraphs that several licences share (the BSD disclaimer, the GPL warranty notice)
are none of their own. Two sets of ``a`` and ``b`` distinct bigrams can reach a Dice
coefficient ``t`` only if ``2 * min(a, b) >= t * (a + b)``: templates outside that bound are pruned before any bigram
is compared, which loses nothing. The same bound says that a match shares at least ``t * b / (2 - t)`` of a template's
bigrams, so each template has a few words of which every match must contain one; a text without any of these words
is not cut into units at all.

DataFrame functions only, no shuffle: the templates are literals (a fixed list, a few kilobytes), every text is read
whole, where it is stored.

Defined results: null is an empty text; a unit with fewer than two words has no bigrams and matches nothing; a unit
has the licence that it matches best (several on a tie), and a text with the same unit twice counts it once; extra columns do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import let

# Licence names and the words of their notices and short texts (public licence texts).
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
        "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
        "implied. See the License for the specific language governing permissions and limitations under the "
        "License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this "
        "program. If not, see <https://www.gnu.org/licenses/>.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will "
        "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have "
        "received a copy of the GNU General Public License along with this program; if not, write to the Free "
        "Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it will "
        "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have "
        "received a copy of the GNU General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE "
        "IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "BSD-3-Clause": [
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither "
        "the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither "
        "the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. THIS SOFTWARE IS "
        "PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
        "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
        "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ],
}


FOUND = "array<struct<licence:string,dice:double>>"


def template_bigrams(text: str) -> list[str]:
    ws = re.sub(r"[^A-Za-z0-9]+", " ", text).lower().split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(ws, ws[1:])))


#: Words found in many texts, which make poor anchors.
COMMON = frozenset("a all and any are as at be by for from have if in including is it may must no not of on or other out provided "
                   "see should so that the this to under use used was way which will with without work you your".split())


def anchors(templates: Mapping[str, list[str]], least: float) -> list[str]:
    """Words of which every text that matches some template contains at least one."""
    chosen: set[str] = set()
    for text in (t for ts in templates.values() for t in ts):
        grams = [g.split() for g in template_bigrams(text)]
        needed = len(grams) * least / (2 - least) - 1e-9
        left = [g for g in grams if not chosen.intersection(g)]
        while len(left) >= needed:
            touches = Counter(w for g in left for w in set(g))
            word = max(touches, key=lambda w: (w not in COMMON, touches[w], w))
            chosen.add(word)
            left = [g for g in left if word not in g]
    return sorted(chosen)


#: Stands for the end of a sentence in a normalised text.
STOP = "\x02"


def normalised(text: Column) -> Column:
    """Runs of anything but ASCII letters, digits and line ends become one space; ends of sentences are marked."""
    stopped = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), STOP, " "), r"[.!?;:]+(?=[\x20\x09-\x0D])", STOP)
    return F.regexp_replace(stopped, r"[^A-Za-z0-9\n\x02]+", " ")


def units(kept: Column) -> Column:
    """The distinct lines, sentences, paragraphs and the whole of a normalised text."""
    flat = lambda u: F.btrim(F.regexp_replace(u, r"[ \n]+", " "))

    def parts(t: Column) -> Column:
        # spaces are made single once for all lines and once for all sentences, not in each of them
        plain = F.regexp_replace(F.translate(t, STOP, " "), " +", " ")
        sentences = F.split(F.regexp_replace(t, r"[ \n]+", " "), STOP)
        return let(plain, lambda p: F.array_distinct(F.concat(
            F.transform(F.concat(F.split(p, "\n"), sentences), lambda u: F.btrim(u)),
            F.transform(F.concat(F.split(p, r"\n[ \n]*\n"), F.array(p)), flat))))

    return let(F.lower(kept), parts)


def bigrams(unit: Column) -> Column:
    pairs = lambda w: F.array_distinct(F.transform(F.slice(w, 1, F.size(w) - 1), lambda x, i: F.concat_ws(
        " ", x, F.element_at(w, i + 2))))
    return let(F.split(unit, " "), lambda w: F.when(F.size(w) < 2, F.array().cast("array<string>")).otherwise(pairs(w)))


def best_matches(unit: Column, templates: Mapping[str, list[str]] = TEMPLATES, least: float = 0.8) -> Column:
    """(licence, dice) of the licence that the unit matches best; several where they tie."""
    def compared(u: Column) -> Column:
        found = []
        for name, texts in templates.items():
            scores = []
            for text in texts:
                grams = template_bigrams(text)
                b = len(grams)
                literal = F.split(F.lit("|".join(grams)), r"\|")  # folded to a constant
                low, high = b * least / (2 - least), b * (2 - least) / least
                scores.append(F.when(F.size(u).between(int(low), int(high) + 1),
                                     F.lit(2.0) * F.size(F.array_intersect(u, literal)) / (F.size(u) + b)).otherwise(F.lit(0.0)))
            best = scores[0] if len(scores) == 1 else F.greatest(*scores)
            found.append(F.struct(F.lit(name).alias("licence"), best.alias("dice")))
        top = lambda xs: F.array_max(F.transform(xs, lambda x: x["dice"]))
        return let(F.array(*found), lambda xs: let(top(xs), lambda t: F.filter(
            xs, lambda x: (x["dice"] >= least) & (x["dice"] == t))))

    sizes = [len(template_bigrams(t)) for ts in templates.values() for t in ts]
    low, high = int(min(sizes) * least / (2 - least)), int(max(sizes) * (2 - least) / least) + 1
    nothing = F.array().cast(FOUND)
    return let(bigrams(unit), lambda u: F.when(F.size(u).between(low, high), compared(u)).otherwise(nothing))


def license_report(docs: DataFrame, templates: Mapping[str, list[str]] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """Per document: units with a licence, the licences found (sorted) and the best coefficient (0 without one)."""
    wanted = F.split(F.lit(" ".join(anchors(templates, least))), " ")

    def searched(kept: Column) -> Column:
        # a unit, too, can match only with an anchor in it; most have none and are not cut into bigrams
        some = F.filter(units(kept), lambda u: F.arrays_overlap(F.split(u, " "), wanted))
        hits = F.filter(F.transform(some, lambda u: best_matches(u, templates, least)), lambda m: F.size(m) > 0)
        words = F.split(F.lower(F.translate(kept, "\n" + STOP, "  ")), " ")
        return F.when(F.arrays_overlap(words, wanted), hits).otherwise(F.array().cast(f"array<{FOUND}>"))

    flat = docs.select("doc_id", let(normalised(F.col("text")), searched).alias("hits")).withColumn("found", F.flatten("hits"))
    return flat.select(
        "doc_id", F.size("hits").cast("long").alias("n_units"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["licence"]))), ",").alias("licences"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["dice"])), F.lit(0.0)).alias("best_dice"))
