"""Licence recognition from known sentences and ordered rules.

A text is cut at newlines and after a full stop, exclamation or question mark
before white space. A normalised piece, or a run of neighbouring pieces, that is
a known licence sentence has an identifier; so hard-wrapped sentences are found.
A run does not go over a blank line, comment signs apart. A text's identifiers in order form a sequence, and
the rules are tried on it one after another: each is a run of identifiers that
must stand next to each other, and where it matches it names a licence and uses
up that run, so that a later, weaker rule does not see it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Normalised sentences of common licences and notices, and their identifiers.
SENTENCES = {
    "released under the mit license": "mit-name",
    "licensed under the mit license": "mit-name",
    "this project is licensed under the mit license": "mit-name",
    "the mit license mit": "mit-name",
    "the mit license": "mit-name",
    "mit license": "mit-name",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "licensed under the apache license version 2 0": "apache-2-name",
    "licensed under the apache license version 2 0 the license": "apache-2-name",
    "apache license version 2 0": "apache-2-name",
    "you may not use this file except in compliance with the license": "apache-2-use",
    "you may obtain a copy of the license at": "apache-2-copy",
    "this work is licensed under the gnu general public license version 3": "gpl-3-name",
    "licensed under the gnu general public license version 3": "gpl-3-name",
    "licensed under the gnu general public license version 2": "gpl-2-name",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2-later",
    "licensed under the gnu lesser general public license version 3": "lgpl-3-name",
    "licensed under the gnu lesser general public license version 2 1": "lgpl-2-1-name",
    "licensed under the gnu affero general public license version 3": "agpl-3-name",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "released under the bsd license": "bsd-name",
    "licensed under the bsd license": "bsd-name",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2-name",
    "licensed under the mozilla public license version 2 0": "mpl-2-name",
    "licensed under cc by 4 0": "cc-by-4",
    "licensed under cc by sa 4 0": "cc-by-sa-4",
    "licensed under cc by nc 4 0": "cc-by-nc-4",
    "licensed under cc by nd 4 0": "cc-by-nd-4",
    "licensed under cc by nc sa 4 0": "cc-by-nc-sa-4",
    "licensed under cc by nc nd 4 0": "cc-by-nc-nd-4",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this work is in the public domain": "public-domain",
    "all rights reserved": "reserved",
}

# Runs of identifiers and what they mean, strongest first.
RULES = [
    ("mit-name mit-grant mit-notice", "MIT"),
    ("mit-grant mit-notice", "MIT"),
    ("mit-grant", "MIT"),
    ("mit-name", "MIT"),
    ("apache-2-name apache-2-use apache-2-copy", "Apache-2.0"),
    ("apache-2-name apache-2-use", "Apache-2.0"),
    ("apache-2-name", "Apache-2.0"),
    ("gpl-3-later", "GPL-3.0-or-later"),
    ("gpl-2-later", "GPL-2.0-or-later"),
    ("gpl-3-name", "GPL-3.0-only"),
    ("gpl-2-name", "GPL-2.0-only"),
    ("lgpl-3-name", "LGPL-3.0-only"),
    ("lgpl-2-1-name", "LGPL-2.1-only"),
    ("agpl-3-name", "AGPL-3.0-only"),
    ("reserved bsd-grant bsd-source bsd-binary bsd-names", "BSD-3-Clause"),
    ("bsd-grant bsd-source bsd-binary bsd-names", "BSD-3-Clause"),
    ("reserved bsd-grant bsd-source bsd-binary", "BSD-2-Clause"),
    ("bsd-grant bsd-source bsd-binary", "BSD-2-Clause"),
    ("bsd-name", "BSD"),
    ("isc-grant", "ISC"),
    ("mpl-2-name", "MPL-2.0"),
    ("cc-by-4", "CC-BY-4.0"),
    ("cc-by-sa-4", "CC-BY-SA-4.0"),
    ("cc-by-nc-4", "CC-BY-NC-4.0"),
    ("cc-by-nd-4", "CC-BY-ND-4.0"),
    ("cc-by-nc-sa-4", "CC-BY-NC-SA-4.0"),
    ("cc-by-nc-nd-4", "CC-BY-NC-ND-4.0"),
    ("unlicense", "Unlicense"),
    ("public-domain", "Public-Domain"),
    ("reserved", "All-Rights-Reserved"),
]

_SENTENCE_END = r"(?<=[.!?])[ \t\r]+\n?"
# Whole pieces only, longest sentence first; a cut may take the place of a blank.
_KNOWN = r"(?<![^\n])(?:" + "|".join(s.replace(" ", r"[ \n]") for s in sorted(SENTENCES, key=len, reverse=True)) + r")(?![^\n])"


def normalised(text: Column) -> Column:
    """Lower case, every run of other characters than letters and digits a blank, and every cut a newline."""
    words = F.regexp_replace(F.lower(F.regexp_replace(text, _SENTENCE_END, "\n")), r"[^a-z0-9\n]+", " ")
    return F.trim(F.replace(F.replace(words, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n")))


def scan_licenses(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, identifiers, licenses, n_sentences.

    `identifiers` are those of the known sentences in order, joined by blanks;
    `licenses` the names the rules give, in the order of the rules, joined by
    blanks; `n_sentences` counts the known sentences. All are empty or 0 for a
    text without any, and for a null or empty text. Repeated rows each keep a
    row; a null id is kept. Other columns are not read.
    """
    known = F.map_from_arrays(F.array(*[F.lit(s) for s in SENTENCES]), F.array(*[F.lit(i) for i in SENTENCES.values()]))
    whole = F.regexp_extract_all(normalised(F.coalesce(F.col(text_column), F.lit(""))), F.lit(_KNOWN), F.lit(0))
    found = F.transform(whole, lambda s: F.element_at(known, F.replace(s, F.lit("\n"), F.lit(" "))))
    rows = docs.select(F.col(id_column).alias("id"), found.alias("found"))
    rows = rows.select("id", F.size("found").cast("long").alias("n_sentences"), F.array_join("found", " ").alias("identifiers"))
    rows = rows.select("*", F.concat(F.lit(" "), F.regexp_replace("identifiers", " ", "  "), F.lit(" ")).alias("left"), F.array().cast("array<string>").alias("names"))
    for run, name in RULES:
        mark = " " + run.replace(" ", "  ") + " "
        rows = rows.select(
            "id", "n_sentences", "identifiers",
            F.replace("left", F.lit(mark), F.lit(" | ")).alias("left"),
            F.when(F.contains("left", F.lit(mark)), F.array_union("names", F.array(F.lit(name)))).otherwise(F.col("names")).alias("names"),
        )
    return rows.select(F.col("id").alias(id_column), "identifiers", F.array_join("names", " ").alias("licenses"), "n_sentences")
