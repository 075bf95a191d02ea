"""Licence recognition from sentences and ordered rules, with built-in functions only.

Every sentence of a text is normalised and looked up among known licence sentences.  What remains
of a text is the sequence of their identifiers, in text order; a rule names identifiers that must
occur in that order.  Unknown sentences between them do not matter.

Line ends are ambiguous: they end a sentence in a list of lines and mean nothing in wrapped text.
Both readings are made.  Notices mix the two: a title, a copyright line or a URL stands above wrapped
sentences.  So a third reading takes every known sentence that begins and ends at a sentence end, a
line end or a blank line, and may be wrapped within.  The licences of all three are reported.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences as they read after normalisation, by identifier.
SENTENCES: dict[str, str] = {
    "apache2-short": "licensed under the apache license version 2.0",
    "apache2-the-license": "licensed under the apache license version 2.0 the license",
    "apache2-compliance": "you may not use this file except in compliance with the license",
    "apache2-copy": "you may obtain a copy of the license at http",
    "apache2-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache2-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-short": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-and": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3-short": "this work is licensed under the gnu general public license version 3",
    "gpl3-licensed": "licensed under the gnu general public license version 3",
    "gpl2-licensed": "licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software",
    "gpl3-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "lgpl-library": "this library is free software",
    "gpl-published": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "lgpl-published": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "lgpl2-published": "you can redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation",
    "agpl-published": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "gnu-2-or-later": "either version 2 of the license or at your option any later version",
    "gnu-21-or-later": "either version 2.1 of the license or at your option any later version",
    "gnu-3-or-later": "either version 3 of the license or at your option any later version",
    "lgpl2-terms": "you can redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "lgpl21-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version",
    "lgpl3-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl3-terms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "mpl2-subject": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "mpl2-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http",
    "mpl2-licensed": "licensed under the mozilla public license version 2.0",
    "cc-by-nc-4": "licensed under cc by nc 4.0",
    "cc-by-4": "licensed under cc by 4.0",
    "cc-by-sa-4": "licensed under cc by sa 4.0",
    "cc-by-4-long": "this work is licensed under a creative commons attribution 4.0 international license",
    "cc-by-sa-4-long": "this work is licensed under a creative commons attribution sharealike 4.0 international license",
    "cc-by-nc-4-long": "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    "cc0-dedicated": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "cc0-authors": "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "unlicense-public": "this is free and unencumbered software released into the public domain",
    "bsd-endorse-tail": "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl2-only": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl3-only": "you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation",
    "spdx": "spdx license identifier",
}

# What may stand before "licensed under", and the licences named in such a sentence or an SPDX line.
LEADS = ("this project is", "this software is", "this file is", "this code is", "this work is")
NAMED: dict[str, str] = {
    "the apache license version 2.0": "Apache-2.0",
    "the mit license": "MIT",
    "the isc license": "ISC",
    "the gnu general public license version 2": "GPL-2.0",
    "the gnu general public license version 3": "GPL-3.0",
    "the mozilla public license version 2.0": "MPL-2.0",
    "cc by 4.0": "CC-BY-4.0",
    "cc by sa 4.0": "CC-BY-SA-4.0",
    "cc by nc 4.0": "CC-BY-NC-4.0",
}
SPDX: dict[str, str] = {
    "apache 2.0": "Apache-2.0",
    "mit": "MIT",
    "isc": "ISC",
    "bsd 2 clause": "BSD-2-Clause",
    "bsd 3 clause": "BSD-3-Clause",
    "gpl 2.0 only": "GPL-2.0",
    "gpl 2.0 or later": "GPL-2.0-or-later",
    "gpl 3.0 only": "GPL-3.0",
    "gpl 3.0 or later": "GPL-3.0-or-later",
    "lgpl 2.1 or later": "LGPL-2.1-or-later",
    "lgpl 3.0 or later": "LGPL-3.0-or-later",
    "mpl 2.0": "MPL-2.0",
    "cc by 4.0": "CC-BY-4.0",
    "cc by sa 4.0": "CC-BY-SA-4.0",
    "cc0 1.0": "CC0-1.0",
    "unlicense": "Unlicense",
}
_LED = {f"{lead} licensed under {said}": licence for said, licence in NAMED.items() for lead in LEADS}
_LED = {said: licence for said, licence in _LED.items() if said not in SENTENCES.values()}
SENTENCES |= {f"led-{i}": said for i, said in enumerate(_LED)} | {f"spdx-{i}": said for i, said in enumerate(SPDX)}

# Licence, then the sentence identifiers that must occur in this order.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache2-short",)),
    ("Apache-2.0", ("apache2-the-license", "apache2-compliance", "apache2-basis")),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("ISC", ("isc-grant", "isc-as-is")),
    ("ISC", ("isc-grant-and", "isc-as-is")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("GPL-2.0", ("gpl2-licensed",)),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-terms")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-published", "gnu-2-or-later")),
    ("GPL-3.0", ("gpl3-short",)),
    ("GPL-3.0", ("gpl3-licensed",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-terms")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-published", "gnu-3-or-later")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl3-terms")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl-published", "gnu-3-or-later")),
    ("LGPL-2.0-or-later", ("lgpl-library", "lgpl2-terms")),
    ("LGPL-2.0-or-later", ("lgpl-library", "lgpl2-published", "gnu-2-or-later")),
    ("LGPL-2.1-or-later", ("lgpl-library", "lgpl21-terms")),
    ("LGPL-2.1-or-later", ("lgpl-library", "lgpl-published", "gnu-21-or-later")),
    ("LGPL-3.0-or-later", ("lgpl-library", "lgpl3-terms")),
    ("LGPL-3.0-or-later", ("lgpl-library", "lgpl-published", "gnu-3-or-later")),
    ("LGPL-3.0-or-later", ("gpl-free", "lgpl3-terms")),
    ("LGPL-3.0-or-later", ("gpl-free", "lgpl-published", "gnu-3-or-later")),
    ("MPL-2.0", ("mpl2-subject", "mpl2-copy")),
    ("MPL-2.0", ("mpl2-licensed",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-4.0", ("cc-by-4-long",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-long",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-long",)),
    ("CC0-1.0", ("cc0-dedicated",)),
    ("CC0-1.0", ("cc0-authors",)),
    ("Unlicense", ("unlicense-public",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-tail")),
    ("GPL-2.0", ("gpl-free", "gpl2-only")),
    ("GPL-3.0", ("gpl-free", "gpl3-only")),
    *[(licence, (f"led-{i}",)) for i, licence in enumerate(_LED.values())],
    *[(licence, ("spdx", f"spdx-{i}")) for i, licence in enumerate(SPDX.values())],
]

#: What a sentence cannot hold becomes one space; then a sentence ends at these marks or, in the
#: reading by lines, at a line end.
NOISE = r"[^\p{L}\p{N}.!?;:\n]+"
ENDS = r"[.!?;:]+([ \n]+|$)"
ENDS_OR_LINE = r"[.!?;:]+([ \n]+|$)|\n"

#: Where a known sentence may begin and end in the mixed reading, and what may stand between its words:
#: a line end, but no blank line.
BEGIN = r"(?:^|\n|[.!?;:][ \n]) ?"
END = r"(?= ?(?:$|\n|[.!?;:]+(?:[ \n]|$)))"
WRAP = r"(?: ?\n ?| )"


def _flat(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOISE, " ")


def sentences(text: Column, by_line: bool) -> Column:
    """Normalised sentences in text order; a null text has none."""
    flat = _flat(text)
    if by_line:
        parts = F.split(flat, ENDS_OR_LINE)
    else:
        parts = F.split(F.regexp_replace(flat, r" *\n *", " "), ENDS)
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")


def _wrapped(said: str) -> str:
    """A known sentence as a pattern; the dot of ``v.`` ends nothing, and http stands for https too."""
    words = [re.escape(w) for w in said.split(" ")]
    words = [r"v\.?" if w == "v" else w for w in words]
    return WRAP.join(words) + ("s?" if words[-1] == "http" else "")


def mixed_sentences(text: Column, known: Mapping[str, str]) -> Column:
    """The known sentences in text order that begin and end at any boundary, wrapped or not."""
    longest_first = sorted(known.values(), key=len, reverse=True)
    found = F.regexp_extract_all(_flat(text), F.lit(f"{BEGIN}({'|'.join(map(_wrapped, longest_first))}){END}"), F.lit(1))
    bare = lambda s: F.regexp_replace(F.regexp_replace(s, r"(?<=\bv)\.|(?<=\bhttp)s$", ""), r"[ \n]+", " ")
    return F.transform(found, bare)


def pattern(steps: Sequence[str]) -> str:
    """A rule as a pattern over ``|a|b|c|``."""
    return r"\|" + r"\|(.*\|)?".join(steps) + r"\|"


def _sequence(parts: str, known: Mapping[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for name, said in known.items() for x in (said, name)])
    return F.filter(F.transform(parts, lambda s: F.try_element_at(table, s)), lambda name: name.isNotNull())


def _licences(sequence: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    line = F.concat(F.lit("|"), F.array_join(sequence, "|"), F.lit("|"))
    met = [F.when(F.rlike(line, F.lit(pattern(steps))), F.lit(name)) for name, steps in rules]
    return F.when(F.size(sequence) > 0, F.array_compact(F.array(*met))).otherwise(F.array().cast("array<string>"))


def license_scan(
    docs: DataFrame,
    known: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] = tuple(RULES),
) -> DataFrame:
    """(doc_id, n_sentences, line_ids, wrapped_ids, mixed_ids, licenses), one row a document.

    ``line_ids``, ``wrapped_ids`` and ``mixed_ids`` are the identifiers found reading by lines,
    reading wrapped text and reading both at once, in text order; ``licenses`` the sorted licences
    whose rules any of them meets.  A null or
    empty text has no sentence.  Repeated rows and null ids stay; other columns are ignored.

    One pass, no shuffle: the known sentences and rules are constants of the plan.
    """
    parts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        sentences(F.col("text"), True).alias("lines"),
        sentences(F.col("text"), False).alias("wrapped"),
        mixed_sentences(F.col("text"), known).alias("mixed"),
    )
    found = parts.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_sentences"),
        _sequence("lines", known).alias("line_ids"),
        _sequence("wrapped", known).alias("wrapped_ids"),
        _sequence("mixed", known).alias("mixed_ids"),
    )
    readings = [_licences(F.col(c), rules) for c in ("line_ids", "wrapped_ids", "mixed_ids")]
    return found.withColumn("licenses", F.sort_array(F.array_distinct(F.concat(*readings))))
