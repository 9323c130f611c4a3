"""Licence recognition by sentence rules, in Spark SQL functions only.

A text is cut into sentences (at line ends and after ``. ! ? ;`` and a blank), a
sentence is normalised (lower case, everything but letters, digits and inner
full stops to one blank) and mapped to the identifier of a known licence
sentence.  A line that is no known sentence by itself is also read together with
the lines after it, up to a sentence end or a blank line, without definitions in
quotes and brackets such as (the "License"); so hard-wrapped notices, also
behind comment signs, are found.  The document's identifiers, in order, are then matched against the
licence rules: a rule is a sequence of identifiers that must stand together in
that order (sentences that are not known, such as copyright lines, may stand
between).  Rules are tried in their order, longer ones first, and identifiers
that one has used are gone for those after it.

Null and empty texts have no sentences and no licences.  Texts are read whole;
a known sentence that repeats counts each time; repeated rows give equal
results; input columns named like an output column are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import replace_columns

# Known licence sentences, normalised, by identifier.
SENTENCES: dict[str, str] = {
    "apache-2-notice": "licensed under the apache license version 2.0",
    "apache-2-comply": "you may not use this file except in compliance with the license",
    "apache-2-obtain": "you may obtain a copy of the license at http www.apache.org licenses license 2.0",
    "apache-2-disclaim": "unless required by applicable law or agreed to in writing software distributed under the "
    "license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-2-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction including without "
    "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
    "and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-include": "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not "
    "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl-3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-3-licensed": "licensed under the gnu general public license version 3",
    "gpl-2-work": "this work is licensed under the gnu general public license version 2",
    "gpl-2-licensed": "licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software",
    "gpl-3-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license "
    "as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-2-redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license "
    "as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "lgpl-3-work": "this work is licensed under the gnu lesser general public license version 3",
    "agpl-3-work": "this work is licensed under the gnu affero general public license version 3",
    "mpl-2-form": "this source code form is subject to the terms of the mozilla public license v. 2.0",
    "mpl-2-licensed": "licensed under the mozilla public license version 2.0",
    "bsd-released": "released under the bsd license",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
    "bsd-licensed": "licensed under the bsd license",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the "
    "following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission",
    "lgpl-free": "this library is free software",
    "lgpl-2.1-redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license "
    "as published by the free software foundation either version 2.1 of the license or at your option any later version",
    "lgpl-3-redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license "
    "as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-3-redistribute": "you can redistribute it and or modify it under the terms of the gnu affero general public license "
    "as published by the free software foundation either version 3 of the license or at your option any later version",
    "epl-2-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0",
    "epl-2-licensed": "licensed under the eclipse public license version 2.0",
    "eupl-1.2": "licensed under the eupl version 1.2",
    "boost": "distributed under the boost software license version 1.0",
    "zlib-altered": "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc0": "licensed under cc0 1.0",
    "cc-by": "licensed under cc by 4.0",
    "cc-by-sa": "licensed under cc by sa 4.0",
    "cc-by-nc": "licensed under cc by nc 4.0",
    "cc-by-nd": "licensed under cc by nd 4.0",
    "cc-by-nc-sa": "licensed under cc by nc sa 4.0",
    "cc-by-nc-nd": "licensed under cc by nc nd 4.0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4.0 international license",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4.0 international license",
    "cc-by-nc-work": "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
}

# Licence identifiers that a line ``SPDX-License-Identifier: ...`` may name, and older names of some.
SPDX_IDS = (
    "0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 "
    "CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC "
    "LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-2.0 MS-PL OFL-1.1 PostgreSQL "
    "Unlicense WTFPL Zlib").split()
SPDX_OLD = {"AGPL-3.0": "AGPL-3.0-only", "GPL-2.0": "GPL-2.0-only", "GPL-2.0+": "GPL-2.0-or-later", "GPL-3.0": "GPL-3.0-only",
            "GPL-3.0+": "GPL-3.0-or-later", "LGPL-2.1": "LGPL-2.1-only", "LGPL-2.1+": "LGPL-2.1-or-later", "LGPL-3.0": "LGPL-3.0-only",
            "LGPL-3.0+": "LGPL-3.0-or-later"}


def _spdx_lines() -> dict[str, tuple[str, str]]:
    """Sentence identifier of each SPDX line, with the line, normalised, and its licence.

    A plus sign is lost in normalising, so an older name with one reads like the name without; the plain one holds.
    """
    lines = {}
    for name, meant in {**{n: n for n in SPDX_IDS}, **{n: m for n, m in SPDX_OLD.items() if "+" not in n}}.items():
        lines[f"spdx-{name.lower()}"] = (f"spdx license identifier {' '.join(re.split('[^a-z0-9.]+', name.lower()))}", meant)
    return lines


SENTENCES |= {key: line for key, (line, _) in _spdx_lines().items()}

# Ordered rules, licence by identifier sequence; longer sequences are put first.
_ORDERED: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("Apache-2.0", ("apache-2-notice", "apache-2-comply", "apache-2-obtain", "apache-2-disclaim", "apache-2-see")),
    ("MIT", ("mit-grant", "mit-include", "mit-warranty")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-redistribute", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-redistribute", "gpl-hope")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl-2.1-redistribute")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl-3-redistribute")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl-3-redistribute")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-2-notice", "apache-2-comply")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-redistribute")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-redistribute")),
    ("MIT", ("mit-grant", "mit-include")),
    ("Apache-2.0", ("apache-2-notice",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("GPL-3.0-only", ("gpl-3-work",)),
    ("GPL-3.0-only", ("gpl-3-licensed",)),
    ("GPL-2.0-only", ("gpl-2-work",)),
    ("GPL-2.0-only", ("gpl-2-licensed",)),
    ("LGPL-3.0-only", ("lgpl-3-work",)),
    ("AGPL-3.0-only", ("agpl-3-work",)),
    ("MPL-2.0", ("mpl-2-form",)),
    ("MPL-2.0", ("mpl-2-licensed",)),
    ("BSD", ("bsd-released",)),
    ("BSD", ("bsd-licensed",)),
    ("BSD", ("bsd-redistribution",)),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-ND-4.0", ("cc-by-nd",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd",)),
    ("CC-BY-4.0", ("cc-by-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-work",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-work",)),
    ("EPL-2.0", ("epl-2-terms",)),
    ("EPL-2.0", ("epl-2-licensed",)),
    ("EUPL-1.2", ("eupl-1.2",)),
    ("BSL-1.0", ("boost",)),
    ("Zlib", ("zlib-altered",)),
    *((meant, (key,)) for key, (_, meant) in _spdx_lines().items()),
)
RULES = tuple(sorted(_ORDERED, key=lambda r: -len(r[1])))

#: Every known sentence holds one of these; texts without any are not cut into sentences.
ANCHOR = r"(?i)licen|permi|warrant|free\W+software|public\W+domain|redistribut|eupl|altered source"
SENTENCE_END = "([.!?;])[ \\t]+"
#: A semicolon that older notices have inside a sentence.
INNER = "(?i);(\\s+(?:[^\\p{L}\\p{N}\\s]+\\s+)?either\\s+(?:[^\\p{L}\\p{N}\\s]+\\s+)?version)"
NOISE = "[^\\p{L}\\p{N}.]+"

# Wrapped text.  Signs around a definition in brackets and quotes; a text's own are taken out first.
OPEN, CLOSE = "\x01", "\x02"
DEFINITION = r"\\(([^\\p{L}\\p{N}()]*(?:the[^\\p{L}\\p{N}()]+)?[\"“”‘’\\x{27}][\\p{L}\\p{N}\\s#*/]+[\"“”‘’\\x{27}][^\\p{L}\\p{N}()]*)\\)"
#: The address follows in its own paragraph, often after a blank line.
AT_ADDRESS = r"(\\blicense[^\\p{L}\\p{N}]+at)[^\\p{L}\\p{N}]+(?=https?:)"
#: Lines are not joined over a sentence end; the full stop of ``v. 2.0`` is none.
HARD_END = r"(?<!\\bv)([.!?;])(?:[ \\t]+|[ \\t]*(?=[\\r\\n]))"
KEPT_NOISE = rf"[^\\p{{L}}\\p{{N}}.{OPEN}{CLOSE}]+"


def _wrapped() -> dict[str, str]:
    """Known sentences as they read over several lines, to identifiers: without definitions, and those that a colon joins."""
    forms = {}
    for name, sentence in SENTENCES.items():
        forms[sentence] = f"<{name}>"
        forms[sentence.replace("files the software to deal", "files to deal")] = f"<{name}>"
    for free, names in (("gpl-free", ("gpl-3-redistribute", "gpl-2-redistribute", "agpl-3-redistribute")),
                        ("lgpl-free", ("lgpl-2.1-redistribute", "lgpl-3-redistribute"))):
        for name in names:
            forms[f"{SENTENCES[free]} {SENTENCES[name]}"] = f"<{free}><{name}>"
    return forms


def _over_lines(sentence: str) -> str:
    """Pattern of a sentence whose blanks may be line ends, where a full stop has been trimmed."""
    words = [re.escape(w.rstrip(".")) + (r"\.?" if w.endswith(".") else "") for w in sentence.split()]
    return "[ \\n]".join(words).replace("\\", "\\\\")


def _literals(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def sentence_ids(text: str) -> Column:
    """Identifiers of the known sentences of a text column, in order, as ``<id><id>...``."""
    known, ids = _literals(SENTENCES.values()), _literals(SENTENCES)
    forms = _wrapped()
    plain = _literals(f.replace(". ", " ") for f in forms)
    found = _literals(forms.values())
    pattern = "(?<=\\n)(?:<[^>]*>|" + "|".join(_over_lines(f) for f in forms) + ")(?=\\n)"
    marked = f"""
        regexp_replace(regexp_replace(regexp_replace(translate({text}, '{OPEN}{CLOSE}', '\x03\x03'), r'{INNER}', ',$1'), '(?i){AT_ADDRESS}', '$1 '),
            '(?i){DEFINITION}', '{OPEN}$1{CLOSE}')"""
    cut = f"""
        split(regexp_replace(regexp_replace({marked}, '(?i){HARD_END}', '$1\n\n'), r'{SENTENCE_END}', '$1\n'), '\\r\\n?|\\n')"""
    # A known sentence becomes its identifier, which no run of lines crosses.
    lines = f"""
        array_join(transform(transform({cut},
                s -> named_struct('s', s, 'p', array_position({known}, btrim(regexp_replace(lower(s), r'{NOISE}', ' '), ' .')))),
            s -> CASE WHEN s.p > 0 THEN concat('<', element_at({ids}, CAST(s.p AS INT)), '>')
                ELSE btrim(regexp_replace(lower(s.s), '{KEPT_NOISE}', ' '), ' .') END), '\n')"""
    bare = f"""
        regexp_replace(concat('\n', {lines}, '\n'), '[ ]?{OPEN}[^{CLOSE}]*{CLOSE}[ .]*(?=\n)|[ ]?{OPEN}[^{CLOSE}]*{CLOSE}', '')"""
    return F.expr(f"""
        CASE WHEN {text} RLIKE r'{ANCHOR}' THEN array_join(
            transform(
                regexp_extract_all({bare}, '{pattern}', 0),
                m -> CASE WHEN startswith(m, '<') THEN m ELSE element_at({found},
                    CAST(array_position({plain}, regexp_replace(m, '\\\\.?[ \\n]', ' ')) AS INT)) END), '')
        ELSE '' END""")


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with sentence_ids (``<id>`` each, in order), licenses (sorted, distinct) and n_licensed_sentences."""
    rules = ", ".join(f"named_struct('name', '{n}', 'ids', '{''.join(f'<{i}>' for i in ids)}')" for n, ids in RULES)
    base = replace_columns(docs, "sentence_ids", "licenses", "n_licensed_sentences")
    source = f"`{text_col}`"
    out = docs.select(*[F.col(f"`{c}`") for c in base.columns],
                      F.coalesce(sentence_ids(source), F.lit("")).alias("sentence_ids"))
    found = F.expr(f"""
        CASE WHEN sentence_ids = '' THEN CAST(array() AS array<string>) ELSE array_sort(array_distinct(
            aggregate(array({rules}),
                named_struct('left', sentence_ids, 'found', CAST(array() AS array<string>)),
                (acc, r) -> CASE WHEN contains(acc.left, r.ids)
                    THEN named_struct('left', replace(acc.left, r.ids, '<>'), 'found', array_append(acc.found, r.name))
                    ELSE acc END,
                acc -> acc.found))) END""")
    return out.select("*", found.alias("licenses"),
                      F.expr("CAST(length(sentence_ids) - length(replace(sentence_ids, '<', '')) AS BIGINT)")
                      .alias("n_licensed_sentences"))


def oracle(table: str = "documents") -> str:
    """The same in DuckDB SQL, with the columns of the registered query."""
    known = "[" + ", ".join(f"'{v}'" for v in SENTENCES.values()) + "]"
    ids = "[" + ", ".join(f"'<{v}>'" for v in SENTENCES) + "]"
    steps, names = [], []
    for k, (name, rule) in enumerate(RULES):
        pattern = "".join(f"<{i}>" for i in rule)
        steps.append(f"replace(s{k}, '{pattern}', '<>') AS s{k + 1}")
        names.append(f"CASE WHEN s{k} <> s{k + 1} THEN '{name}' END")
    return f"""
WITH cut AS (
  SELECT doc_id, string_split_regex(regexp_replace(regexp_replace(text, '{INNER}', E',\\\\1', 'g'), '{SENTENCE_END}', E'\\\\1\\n', 'g'), '[\\r\\n]+') AS parts
  FROM documents),
known AS (
  SELECT doc_id, coalesce(array_to_string(list_transform(
      list_filter(list_transform(parts, lambda s: list_position({known},
          trim(regexp_replace(lower(s), '{NOISE}', ' ', 'g'), ' .'))), lambda p: p > 0),
      lambda p: {ids}[p]), ''), '') AS s0 FROM cut),
ruled AS (SELECT doc_id, s0, {", ".join(steps)} FROM known)
SELECT doc_id, s0 AS sentence_ids,
  array_to_string(list_sort(list_distinct(list_filter([{", ".join(names)}], lambda x: x IS NOT NULL))), ',') AS licenses,
  CAST(length(s0) - length(replace(s0, '<', '')) AS BIGINT) AS n_licensed_sentences
FROM ruled""".replace("documents", table)
