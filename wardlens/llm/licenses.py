"""Licence recognition by sentence rules.

A text is cut into passages at marks that blank space follows and at blank lines
(lines without letters and digits, so also those of a comment). A passage is
normalised (lower case, letters, digits, dots and brackets only, single blanks,
none inside brackets, line breaks and semicolons kept as breaks), and the known
sentences in it become their identifiers. A known sentence begins and ends at a break or an end of the
passage, list numbers aside; within it a break is a blank, so wrapped lines do no
harm. The identifiers of a document, in order, are matched against ordered
rules: a rule is a sequence of identifiers that must follow one another, other
text aside, and the first rule that matches at a place takes its identifiers, so
a longer rule stands before the shorter ones it contains. Passages that only
look like a licence's are counted as unknown; they do not part a sequence.

Known sentences are exact texts or patterns with variable parts (versions,
names); both tables are parameters of fixed size. All is done within the row:
nothing is shuffled.

Defined cases: null, empty and blank texts have no sentence and no licence; very
long texts are cut whole; a sentence may occur any number of times and each
occurrence counts; rows are independent, and extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Identifiers of a machine-readable licence line (fixed values).
SPDX = ["0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause",
        "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only",
        "GPL-2.0-or-later", "GPL-2.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-3.0", "ISC",
        "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0",
        "Unlicense", "Zlib"]


def _as_normalised(name: str) -> str:
    return re.sub(r"[^a-z0-9.()]+", " ", name.lower())


def _free(kind: str, version: str) -> str:
    """The notice of the GNU licences: which one, and from which version on."""
    return (r"this .{1,60} is free software you can redistribute it and or modify it under the terms of the gnu "
            rf"{kind} public licen[sc]e as published by the free software foundation {version} of the licen[sc]e "
            r"or \(?at your option\)? any later version")


def _commons(terms: str) -> str:
    return (r"(?:this .{1,60} is )?licensed under (?:a|the) creative commons "
            rf"{terms} 4\.0 international(?: public)? licen[sc]e")


# Known licence sentences, normalised: identifier and pattern (fixed values).
SENTENCES = [
    ("mit-released", r"released under the mit licen[sc]e"),
    ("mit-licensed", r"(?:this .{1,60} is )?(?:licensed|distributed) under the (?:terms of the )?mit licen[sc]e"),
    ("mit-title", r"(?:the )?mit licen[sc]e(?: \(mit\))?"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software .*"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included in all .*"),
    ("as-is", r"the software is provided as is without warranty of any kind .*"),
    ("apache2-licensed", r"(?:this .{1,60} is )?licensed under the apache licen[sc]e,? version 2\.0(?: \(the licen[sc]e\))?"),
    ("apache2-comply", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache2-copy", r"you may obtain a copy of the licen[sc]e at .*"),
    ("apache2-asis", r"unless required by applicable law or agreed to in writing software .*"),
    ("gpl3-licensed", r"this (?:work|program|software|document) is licensed under the gnu general public licen[sc]e,? version 3"),
    ("gpl2-licensed", r"this (?:work|program|software|document) is licensed under the gnu general public licen[sc]e,? version 2"),
    ("gpl3-later", _free("general", r"either version 3")),
    ("gpl2-later", _free("general", r"either version 2")),
    ("lgpl21-later", _free("lesser general", r"either version 2\.1")),
    ("lgpl3-later", _free("lesser general", r"either version 3")),
    ("agpl3-later", _free("affero general", r"either version 3")),
    ("gpl-free", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e .*"),
    ("bsd-redistribution", r"redistribution and use in source and binary forms with or without modification are permitted .*"),
    ("bsd-source", r"(?:[1-9]\.? ?)?redistributions of source code must retain the above copyright notice .*"),
    ("bsd-binary", r"(?:[1-9]\.? ?)?redistributions in binary form must reproduce the above copyright notice .*"),
    ("bsd-endorse", r"(?:[1-9]\.? ?)?neither the name of .*"),
    ("cc-by-nc4", r"licensed under cc by nc 4\.0"),
    ("cc-by-nc-sa4", r"licensed under cc by nc sa 4\.0"),
    ("cc-by-nc-nd4", r"licensed under cc by nc nd 4\.0"),
    ("cc-by-sa4", r"licensed under cc by sa 4\.0"),
    ("cc-by4", r"licensed under cc by 4\.0"),
    ("cc0", r"(?:licensed under|dedicated to the public domain under) cc0(?: 1\.0)?"),
    ("cc-by-sa4-named", _commons("attribution sharealike")),
    ("cc-by-nc-sa4-named", _commons("attribution noncommercial sharealike")),
    ("cc-by-nc-nd4-named", _commons("attribution noncommercial noderivatives")),
    ("cc-by-nc4-named", _commons("attribution noncommercial")),
    ("cc-by-nd4-named", _commons("attribution noderivatives")),
    ("cc-by4-named", _commons("attribution")),
    ("mpl2-subject", r"this source code form is subject to the terms of the mozilla public licen[sc]e v(?:ersion)?(?:\.? ?2\.0)?"),
    ("isc-grant", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that .*"),
    ("0bsd-grant", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("apache2-or-mit", r"(?:this .{1,60} is )?(?:dual )?licensed under (?:either (?:of )?)?the apache licen[sc]e version 2\.0 or the mit licen[sc]e"),
    ("apache2-and-mit", r"(?:this .{1,60} is )?(?:dual )?licensed under (?:both )?the apache licen[sc]e version 2\.0 and the mit licen[sc]e"),
    ("reserved", r"all rights reserved"),
    *[(f"spdx-{i.lower()}", "spdx licen[sc]e identifier " + re.escape(_as_normalised(i)).replace(r"\ ", " "))
      for i in SPDX],
]
# Rules in order: licence and the identifiers that follow one another (fixed values).
RULES = [
    ("MIT", ["mit-title", "mit-grant", "mit-notice", "as-is"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("Apache-2.0", ["apache2-licensed", "apache2-comply", "apache2-copy", "apache2-asis"]),
    ("Apache-2.0", ["apache2-licensed", "apache2-comply"]),
    ("Apache-2.0", ["apache2-licensed"]),
    ("GPL-3.0", ["gpl3-licensed"]),
    ("GPL-2.0", ["gpl2-licensed"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl2-later"]),
    ("LGPL-2.1-or-later", ["lgpl21-later"]),
    ("LGPL-3.0-or-later", ["lgpl3-later"]),
    ("AGPL-3.0-or-later", ["agpl3-later"]),
    ("GPL", ["gpl-free"]),
    ("ISC", ["isc-grant"]),
    ("0BSD", ["0bsd-grant"]),
    ("MPL-2.0", ["mpl2-subject"]),
    ("Unlicense", ["unlicense"]),
    ("Apache-2.0 OR MIT", ["apache2-or-mit"]),
    ("Apache-2.0 AND MIT", ["apache2-and-mit"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("CC-BY-NC-4.0", ["cc-by-nc4"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa4"]),
    ("CC-BY-NC-ND-4.0", ["cc-by-nc-nd4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa4"]),
    ("CC-BY-4.0", ["cc-by4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc4-named"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa4-named"]),
    ("CC-BY-NC-ND-4.0", ["cc-by-nc-nd4-named"]),
    ("CC-BY-ND-4.0", ["cc-by-nd4-named"]),
    ("CC-BY-SA-4.0", ["cc-by-sa4-named"]),
    ("CC-BY-4.0", ["cc-by4-named"]),
    ("CC0-1.0", ["cc0"]),
    ("All-Rights-Reserved", ["reserved"]),
    *[(i, [f"spdx-{i.lower()}"]) for i in SPDX],
]
# Words that a licence sentence holds; only such passages are compared.
HINT = (r"(?i)licen[sc]|rights\W{1,40}reserved|permission|redistribution|warranty|free\W{1,40}software|notice"
        r"|public\W{1,40}domain|neither\W{1,40}the\W{1,40}name|applicable\W{1,40}law")
# Lines without letters and digits; a passage ends there, unless an address
# follows, or at a mark that blank space follows.
BLANK_LINES = r"\n(?:[^\p{L}\p{N}\n]*+\n)++"
PASSAGE_END = r"(?<=[.!?])\s+|\n\n(?![^\p{L}\p{N}]{0,40}https?://)"
UNKNOWN = "unknown"


def normalised(passage: Column) -> Column:
    plain = F.regexp_replace(F.lower(passage), r";(?=\s)", "\n")
    plain = F.regexp_replace(plain, r"[^\p{L}\p{N}.()\n]+", " ")
    plain = F.regexp_replace(plain, r"(?:^| ?\n(?: ?\n)*+) ?(?:(?:dnl|rem) )?", "\n")
    plain = F.regexp_replace(plain, r"(?<=\()[ \n]+|[ \n]+(?=\))", "")
    return F.regexp_replace(plain, r"^[ .\n]+|(?<![ .\n])[ .\n]+$", "")


def _broken(pattern: str) -> str:
    """The pattern of a sentence whose blanks may be line breaks; what may
    follow its known words ends with a line."""
    return re.sub(r"\.\*$", ".*?", pattern).replace(" ", r"[ \n]")


def sentence_id(sentence: Column, sentences: list[tuple[str, str]] = SENTENCES) -> Column:
    """The identifier of a normalised known sentence."""
    chain = F.lit(None).cast("string")
    for name, pattern in reversed(sentences):
        chain = F.when(sentence.rlike(f"(?s)^(?:{_broken(pattern)})$"), name).otherwise(chain)
    return chain


def passage_ids(passage: Column, sentences: list[tuple[str, str]] = SENTENCES) -> Column:
    """The identifiers of the known sentences of a passage, "unknown" if it has
    none."""
    known = "|".join(f"(?:{_broken(pattern)})" for _, pattern in sentences)
    found = F.regexp_extract_all(normalised(passage), F.lit(
        rf"(?s)(?<![^\n])(?:\(?[0-9a-z]{{1,2}}[.)]+[ \n])?({known})(?![^\n])"), F.lit(1))
    return F.transform(F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(UNKNOWN))),
                       lambda s: F.when(s == UNKNOWN, s).otherwise(sentence_id(s, sentences)))


def identifiers(text: Column, sentences: list[tuple[str, str]] = SENTENCES) -> Column:
    """The identifiers of a text's licence sentences, in order."""
    lines = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), BLANK_LINES, "\n\n")
    hinted = F.filter(F.split(lines, PASSAGE_END), lambda s: s.rlike(HINT))
    ids = F.flatten(F.transform(hinted, lambda s: passage_ids(s, sentences)))
    return F.when(text.rlike(HINT), ids).otherwise(F.array().cast("array<string>"))


def _matches(ids: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """The rule numbers that match, in order: an alternation tries the rules
    in their order at every place of the joined identifiers."""
    known = F.filter(ids, lambda i: i != UNKNOWN)
    joined = F.array_join(F.transform(known, lambda i: F.concat(i, F.lit(";"))), "")
    alternation = "|".join("".join(f"{i};" for i in sequence) for _, sequence in rules)
    return F.regexp_extract_all(joined, F.lit(f"(?:^|(?<=;))(?:{alternation})"), F.lit(0))


def recognise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              sentences: list[tuple[str, str]] = SENTENCES,
              rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """Per row: doc_id, sentence_ids, licenses (in order of their first
    occurrence), n_matches and n_unknown."""
    known = F.create_map(*[F.lit(x) for name, sequence in rules
                           for x in ("".join(f"{i};" for i in sequence), name)])
    ids = docs.select(F.col(id_col).alias("doc_id"),
                      F.coalesce(identifiers(F.col(text_col), sentences),
                                 F.array().cast("array<string>")).alias("sentence_ids"))
    matched = ids.withColumn("found", F.transform(
        _matches(F.col("sentence_ids"), rules), lambda m: F.element_at(known, m)))
    return matched.select(
        "doc_id", "sentence_ids", F.array_distinct("found").alias("licenses"),
        F.size("found").cast("long").alias("n_matches"),
        F.size(F.filter("sentence_ids", lambda i: i == UNKNOWN)).cast("long").alias("n_unknown"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return recognise(docs).select(
        "doc_id", F.array_join("licenses", ",").alias("licenses"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"), "n_matches", "n_unknown")
