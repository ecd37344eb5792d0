"""License scan by sentence rules.

A text is cut into sentences and each is normalised to lower-case letters and digits. Sentences known from licences become
identifiers; the rest fall away. A licence is found where the identifiers of its rule follow each other in the text. A
rule that is part of a longer rule that matched at the same place (two of the three BSD clauses) does not count there.

Built-in functions only, row by row: no shuffle, so no hot keys. The known sentences travel in the plan as one pattern.

Sentence ends: ``. ! ? ; :`` before white space, and line ends, but for a line that goes on with a letter, a digit, a quote
or a bracket, which may be a wrapped one. A known sentence is found where it is a whole sentence, a whole line, or a run of
lines (what stands before a line's first letter or digit, such as comment marks, is not looked at), in a longer sentence
too: a notice below a heading or above code needs no stop. Runs end at blank lines and at sentence ends. Its place is that
of the sentence in which it starts; of known sentences that overlap the first counts, of those that start alike the longest.

Defined results
    * a null, empty or blank text has no sentences, no identifiers and no licences;
    * rows are scanned one by one: repeated rows give repeated results, a null id stays null, no rows give no rows;
    * licences come in alphabetical order, each once; columns of the added names are replaced, others are kept.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import columns

#: Licence sentences, normalised. The identifier of a sentence is its name.
SENTENCES = {
    "apache-short": "licensed under the apache license version 2 0",
    "apache-grant": "licensed under the apache license version 2 0 the license",
    "apache-may": "you may not use this file except in compliance with the license",
    "apache-unless": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-short": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liable": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "gpl-short": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software",
    "gpl-3-later": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "cc-nc-short": "licensed under cc by nc 4 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "spdx": "spdx license identifier",
    "spdx-mit": "mit",
    "spdx-apache": "apache 2 0",
    "spdx-gpl": "gpl 3 0 only",
    "spdx-cc-nc": "cc by nc 4 0",
}

#: The sentences of each rule, in the order in which they must follow each other.
RULES = (
    ("Apache-2.0", ("apache-short",)),
    ("Apache-2.0", ("apache-grant", "apache-may")),
    ("Apache-2.0", ("spdx", "spdx-apache")),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("spdx", "spdx-mit")),
    ("GPL-3.0", ("gpl-short",)),
    ("GPL-3.0", ("gpl-free", "gpl-3-later")),
    ("GPL-3.0", ("spdx", "spdx-gpl")),
    ("CC-BY-NC-4.0", ("cc-nc-short",)),
    ("CC-BY-NC-4.0", ("spdx", "spdx-cc-nc")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name")),
    ("ISC", ("isc-grant",)),
)


#: More known sentences.
MORE_SENTENCES = {
    "gpl-2-later": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-2-only": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl-3-only": "you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation",
    "lgpl-free": "this library is free software",
    "lgpl-21-later": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-3-later": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-3-later": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "mpl-2-form": "this source code form is subject to the terms of the mozilla public license v",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
}
#: The licences of short notices: name of the sentence, licence, and what the notice may call it.
SHORT = (
    ("mit-short", "MIT", ("mit", "mit license", "expat license")),
    ("apache-short", "Apache-2.0", ("apache 2 0", "apache 2 0 license", "apache license 2 0", "apache license v2 0", "apache license version 2 0", "apache software license version 2 0")),
    ("bsd-2-short", "BSD-2-Clause", ("bsd 2 clause", "bsd 2 clause license", "2 clause bsd license", "simplified bsd license")),
    ("bsd-3-short", "BSD-3-Clause", ("bsd 3 clause", "bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license")),
    ("isc-short", "ISC", ("isc", "isc license")),
    ("mpl-2-short", "MPL-2.0", ("mpl 2 0", "mozilla public license 2 0", "mozilla public license version 2 0")),
    ("unlicense-short", "Unlicense", ("unlicense",)),
    *(
        (f"{short}-{version[0]}{'1' if ' ' in version else ''}-short", f"{short.upper()}-{licence}", tuple(
            n.format(v=v) for v in {version, licence.replace(".", " ")} for n in (f"{short} {{v}}", f"{short} v{{v}}", f"{short}v{{v}}", f"gnu {short} v{{v}}", f"gnu {full} {{v}}", f"gnu {full} v{{v}}", f"gnu {full} version {{v}}")))
        for short, full, version, licence in (
            ("gpl", "general public license", "2", "2.0"), ("gpl", "general public license", "3", "3.0"), ("lgpl", "lesser general public license", "2 1", "2.1"),
            ("lgpl", "lesser general public license", "3", "3.0"), ("agpl", "affero general public license", "3", "3.0"))
    ),
    *(
        (f"cc-{kind.replace(' ', '-')}-short" if kind != "by nc" else "cc-nc-short", f"CC-{kind.upper().replace(' ', '-')}-4.0", (f"cc {kind} 4 0", f"creative commons {full} 4 0 international license", f"creative commons {full} 4 0 license"))
        for kind, full in (("by", "attribution"), ("by sa", "attribution sharealike"), ("by nc", "attribution noncommercial"))
    ),
)
#: The openings of short notices; before them may stand what is licensed, between them and the name "the terms of".
_SUBJECT = "(?:(?:this|the) (?:[a-z0-9]+ )?(?:project|software|file|work|program|code|library|package|module|repository|document|text|content|data|dataset) (?:is|are) )?"
_OPENING = _SUBJECT + "(?:dual )?(?:licensed|released|distributed|published|provided|available|made available) under (?:the terms of )?(?:an? |the )?"
#: SPDX identifiers, normalised, behind "spdx license identifier".
SPDX = {
    "spdx-gpl-later": ("GPL-3.0", "gpl 3 0 or later"), "spdx-gpl-3": ("GPL-3.0", "gpl 3 0"), "spdx-gpl-2": ("GPL-2.0", "gpl 2 0"), "spdx-gpl-2-only": ("GPL-2.0", "gpl 2 0 only"), "spdx-gpl-2-later": ("GPL-2.0", "gpl 2 0 or later"),
    "spdx-lgpl-21-only": ("LGPL-2.1", "lgpl 2 1 only"), "spdx-lgpl-21-later": ("LGPL-2.1", "lgpl 2 1 or later"), "spdx-lgpl-3-only": ("LGPL-3.0", "lgpl 3 0 only"), "spdx-lgpl-3-later": ("LGPL-3.0", "lgpl 3 0 or later"),
    "spdx-agpl-only": ("AGPL-3.0", "agpl 3 0 only"), "spdx-agpl-later": ("AGPL-3.0", "agpl 3 0 or later"), "spdx-mpl": ("MPL-2.0", "mpl 2 0"), "spdx-unlicense": ("Unlicense", "unlicense"),
    "spdx-bsd-2": ("BSD-2-Clause", "bsd 2 clause"), "spdx-bsd-3": ("BSD-3-Clause", "bsd 3 clause"), "spdx-isc": ("ISC", "isc"), "spdx-cc-by": ("CC-BY-4.0", "cc by 4 0"), "spdx-cc-by-sa": ("CC-BY-SA-4.0", "cc by sa 4 0"),
}
MORE_RULES = (
    ("GPL-2.0", ("gpl-free", "gpl-2-later")), ("GPL-2.0", ("gpl-free", "gpl-2-only")), ("GPL-3.0", ("gpl-free", "gpl-3-only")), ("LGPL-2.1", ("lgpl-free", "lgpl-21-later")), ("LGPL-3.0", ("lgpl-free", "lgpl-3-later")),
    ("LGPL-3.0", ("gpl-free", "lgpl-3-later")), ("LGPL-2.1", ("gpl-free", "lgpl-21-later")), ("AGPL-3.0", ("gpl-free", "agpl-3-later")), ("MPL-2.0", ("mpl-2-form",)), ("Unlicense", ("unlicense-free",)),
    *((licence, (name,)) for name, licence, _ in SHORT if (licence, (name,)) not in RULES), *((licence, ("spdx", name)) for name, (licence, _) in SPDX.items()),
)
_ALL = SENTENCES | MORE_SENTENCES | {name: s for name, (_, s) in SPDX.items()}

#: Marks: a line end that ends a sentence, one that does not, and the two sides of a name.
_ENDS, _GOES_ON, _OPEN, _CLOSE = "\x01", "\x02", "\x03", "\x04"


def marked(text: Column) -> Column:
    """The normalised text, with a line end behind each sentence and a mark for each line end in between."""
    s = F.translate(F.lower(F.coalesce(text, F.lit(""))), _ENDS + _GOES_ON + _OPEN + _CLOSE, "\x05" * 4)
    s = F.regexp_replace(s, "\\n([a-z0-9(\"'])", f"{_GOES_ON}$1")
    s = F.regexp_replace(s, f"\\n[^a-z0-9\\n{_GOES_ON}]*+(?=[a-z0-9])", _ENDS)
    s = F.regexp_replace(s, f"[.!?;:]+[ \\t\\r\\n{_ENDS}{_GOES_ON}]", "\n")
    return F.regexp_replace(s, f"[^a-z0-9\\n{_ENDS}{_GOES_ON}]+", " ")


def sentences(found: Column) -> Column:
    """The sentences of a marked text, blank ones left out."""
    return F.filter(F.transform(F.split(F.translate(found, _ENDS + _GOES_ON, "\n "), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def _pattern(known: dict[str, str], short: tuple) -> str:
    """Any known sentence between two line or sentence ends, longer ones first, or a short notice."""
    blank = f"[ {_ENDS}{_GOES_ON}]++"
    words = [s.replace(" ", blank) for s in sorted(known.values(), key=lambda s: (-len(s), s))]
    called = sorted({n for _, _, names in short for n in names}, key=lambda n: (-len(n), n))
    if called:
        words.append(f"{_OPENING}(?:{'|'.join(called)})(?: license)?".replace(" ", blank))
    return f"(^|[\\n{_ENDS}{_GOES_ON}]) ?({'|'.join(words)}) ?(?=[\\n{_ENDS}{_GOES_ON}]|\\z)"


def _named(found: Column, known: dict[str, str], short: tuple) -> Column:
    """The sentences of a marked text, each with the names of the known ones that start in it put before them."""
    lookup = F.from_json(F.lit(json.dumps({s: name for name, s in known.items()} | {f"under {n}": name for name, _, names in short for n in names})), "map<string,string>")  # folded to one literal
    parts = F.split(F.regexp_replace(found, _pattern(known, short), f"$1{_OPEN}$2{_CLOSE}"), _OPEN)

    def put(part: Column) -> Column:
        sentence = F.substring_index(part, _CLOSE, 1)
        plain = F.regexp_replace(sentence, f"[ {_ENDS}{_GOES_ON}]+", " ")
        called = F.concat(F.lit("under "), F.regexp_replace(plain, f"^{_OPENING}", ""))
        name = F.coalesce(F.try_element_at(lookup, plain), F.try_element_at(lookup, called), F.try_element_at(lookup, F.regexp_replace(called, " license$", "")))
        return F.concat(F.lit(_OPEN), name, F.lit(_CLOSE), F.replace(part, F.lit(_CLOSE), F.lit("")))

    return sentences(F.concat(parts[0], F.concat_ws("", F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), put))))


def _path(names: tuple[str, ...]) -> str:
    return "".join(f"<{n}>" for n in names)


def _times(found: Column, path: str) -> Column:
    """How often the identifiers of ``path`` follow each other in ``found``."""
    return (F.length(found) - F.length(F.replace(found, F.lit(path), F.lit("")))) / len(path)


def scan_licences(docs: DataFrame, text: str = "text", known: dict[str, str] | None = None, rules: tuple = RULES + MORE_RULES, short: tuple | None = None) -> DataFrame:
    """``docs`` with ``n_sentences``, ``found`` (place in the text, counted in sentences, and identifier) and ``licences``.

    Columns of these three names that ``docs`` already has are replaced.
    """
    docs, back = columns.apart(docs, ("_marked", "_path"))
    text = {old: new for new, old in back.items()}.get(text, text)
    short = short or (() if known else SHORT)
    known = known or _ALL
    place = F.struct(F.lit(0).alias("place"), F.lit("").alias("sentence"))
    names = lambda s, i: F.transform(F.regexp_extract_all(s, F.lit(f"{_OPEN}([^{_CLOSE}]*){_CLOSE}"), F.lit(1)), lambda n: F.struct((i + 1).alias("place"), n.alias("sentence")))
    out = docs.withColumn("_marked", marked(F.col(text))).withColumn("n_sentences", F.size(sentences(F.col("_marked"))).cast("long"))
    # few texts hold a known sentence: only these are looked at by sentence
    out = out.withColumn("found", F.when(F.col("_marked").rlike(_pattern(known, short)), F.flatten(F.transform(_named(F.col("_marked"), known, short), names))).otherwise(F.slice(F.array(place), 1, 0)))
    out = out.withColumn("_path", F.concat_ws("", F.transform("found", lambda p: F.concat(F.lit("<"), p["sentence"], F.lit(">")))))
    hits = []
    for licence, names in rules:
        own, longer = _path(names), {_path(more) for _, more in rules if _path(names) in _path(more) and more != names}
        covered = sum((_times(F.col("_path"), p) for p in sorted(longer)), F.lit(0.0))
        hits.append(F.when(_times(F.col("_path"), own) > covered, F.lit(licence)))
    licences = F.when(F.col("_path") == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.array_compact(F.array(*hits)))))
    return out.withColumn("licences", licences).drop("_marked", "_path").withColumnsRenamed(back)


def licence_digest(documents: DataFrame) -> DataFrame:
    found = scan_licences(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return found.select(
        "doc_id", "n_sentences", F.concat_ws(",", F.transform("found", lambda p: F.concat(p["place"].cast("string"), F.lit(":"), p["sentence"]))).alias("found"), F.concat_ws(",", "licences").alias("licences")
    )
