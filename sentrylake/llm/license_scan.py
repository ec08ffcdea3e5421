"""Licence recognition by sentence rules (built-in functions only).

A text is cut into sentences (at line ends and after ``.``, ``!``, ``?`` or ``;`` before white space); each is
normalised (lower case, letters, digits and dots inside numbers kept, white space and punctuation to
one space). A normalised sentence becomes the identifier that ``DICTIONARY`` has for it, else that of
the first pattern of ``SENTENCES`` that matches it whole. Any other sentence is a gap, but for those of
``FILLERS``, which stand inside notices and count as not there. The sequence of a text's identifiers and
gaps is then matched against the ordered ``RULES``: the first rule whose sequence occurs, in order and
next to each other without a gap, names the licence at that place, and its sentences serve no later rule.

The published notices of the same licences are found too. Lines that no pattern matches alone are joined
with the rest of their sentence (to its end or a blank line), and such sentences, wrapped or not, are
also held against ``PUBLISHED`` and, if wrapped, may start with other words. The registered SQL knows
lines, ``DICTIONARY``, ``SENTENCES`` and ``FILLERS`` only; ``n_sentences`` counts as it does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values: (sentence identifier, pattern of the whole normalised sentence).
SENTENCES: tuple[tuple[str, str], ...] = (
    ("apache-2.0-grant", r"licensed under (the )?apache license,? (version )?2\.0"),
    ("apache-2.0-use", r"you may not use this file except in compliance with the license"),
    ("apache-2.0-asis", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("mit-grant", r"(released|licensed|distributed) under (the )?mit license"),
    ("mit-permission", r"permission is hereby granted free of charge to any person obtaining a copy.*"),
    ("mit-asis", r"the software is provided as is without warranty of any kind.*"),
    ("gpl-3.0-grant", r"this (work|program|software) is licensed under the gnu general public license (version )?3(\.0)?"),
    ("gpl-2.0-grant", r"this (work|program|software) is licensed under the gnu general public license (version )?2(\.0)?"),
    ("gpl-redistribute", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license.*"),
    ("lgpl-grant", r"licensed under the gnu lesser general public license.*"),
    ("bsd-redistribution", r"redistribution and use in source and binary forms with or without modification are permitted.*"),
    ("mpl-2.0-grant", r".*subject to the terms of the mozilla public license v(ersion)? ?2\.0"),
    ("cc-by-nc-4.0-grant", r"licensed under (cc|creative commons) (by nc|attribution noncommercial) 4\.0( international)?"),
    ("cc-by-sa-4.0-grant", r"licensed under (cc|creative commons) (by sa|attribution sharealike) 4\.0( international)?"),
    ("cc-by-4.0-grant", r"licensed under (cc|creative commons) (by|attribution) 4\.0( international)?"),
    ("cc0-1.0-grant", r"(released|dedicated) (under|to) (cc0|the public domain).*"),
    ("agpl-grant", r"(.* is free software )?you can redistribute it and or modify it under the terms of the gnu affero general public license.*"),
    ("isc-permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted.*"),
    ("zlib-permission", r"permission is granted to anyone to use this software for any purpose including commercial applications.*"),
    ("epl-2.0-grant", r"this program and the accompanying materials are made available under the terms of the eclipse public license (v|version) ?2\.0.*"),
    ("all-rights-reserved", r"all rights reserved"),
    ("copyright", r"copyright( c)? ([0-9]{4}.*|by .*)"),
)

_WORK, _CC, _END = r"(?:.* )?(?:is|are) ", r"(?:an? |the )?(?:cc|creative commons) ", r"(?: licen[cs]e)?(?: .*)?"

#: Fixed values: (identifier of SENTENCES, pattern of the whole normalised sentence), tried after SENTENCES.
PUBLISHED: tuple[tuple[str, str], ...] = (
    ("apache-2.0-grant", rf"(?:{_WORK})?licensed under (?:the )?apache license (?:version )?2\.0(?: the license)?"),
    ("apache-2.0-use", r"you may not use (?:this|these) (?:file|files|work|software) except in compliance with the license"),
    ("apache-2.0-asis", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis.*"),
    ("mit-grant", rf"(?:{_WORK})?(?:released|licensed|distributed) under (?:the )?(?:terms of the )?mit license"),
    ("lgpl-grant", r"(?:this (?:library|program) is free software )?you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license.*"),
    ("lgpl-grant", rf"{_WORK}licensed under the gnu lesser general public license.*"),
    ("gpl-redistribute", r"(?:.* is free software )?you can redistribute it and or modify it under the terms of the gnu general public license.*"),
    ("mpl-2.0-grant", r".*subject to the terms of the mozilla public license v(?:ersion)? ?2\.0.*"),
    ("cc-by-nc-4.0-grant", rf"(?:{_WORK})?licensed under {_CC}(?:by nc|attribution non ?commercial) 4\.0(?: international)?{_END}"),
    ("cc-by-sa-4.0-grant", rf"(?:{_WORK})?licensed under {_CC}(?:by sa|attribution share ?alike) 4\.0(?: international)?{_END}"),
    ("cc-by-4.0-grant", rf"(?:{_WORK})?licensed under {_CC}(?:by|attribution) 4\.0(?: international)?{_END}"),
    ("cc0-1.0-grant", r"to the extent possible under law .*waived all copyright and related or neighbou?ring rights.*"),
    ("cc0-1.0-grant", rf"{_WORK}(?:released|dedicated) (?:under|to) (?:cc0|the public domain).*"),
)

#: Fixed values: (SPDX identifier, category), the licences that a tag line may name.
SPDX: tuple[tuple[str, str], ...] = (
    ("0BSD", "permissive"), ("AFL-3.0", "permissive"), ("AGPL-3.0", "copyleft"), ("Apache-1.1", "permissive"), ("Apache-2.0", "permissive"), ("APSL-2.0", "copyleft"), ("Artistic-2.0", "permissive"),
    ("BSD-2-Clause", "permissive"), ("BSD-3-Clause", "permissive"), ("BSD-4-Clause", "permissive"), ("BSL-1.0", "permissive"), ("BUSL-1.1", "restricted"), ("CC-BY-4.0", "permissive"), ("CC-BY-NC-4.0", "restricted"),
    ("CC-BY-NC-ND-4.0", "restricted"), ("CC-BY-NC-SA-4.0", "restricted"), ("CC-BY-ND-4.0", "restricted"), ("CC-BY-SA-4.0", "copyleft"), ("CC0-1.0", "permissive"), ("CDDL-1.0", "copyleft"), ("EPL-1.0", "copyleft"), ("EPL-2.0", "copyleft"),
    ("EUPL-1.2", "copyleft"), ("GFDL-1.3", "copyleft"), ("GPL-2.0", "copyleft"), ("GPL-3.0", "copyleft"), ("ISC", "permissive"), ("LGPL-2.0", "copyleft"), ("LGPL-2.1", "copyleft"), ("LGPL-3.0", "copyleft"), ("MIT", "permissive"),
    ("MIT-0", "permissive"), ("MPL-1.1", "copyleft"), ("MPL-2.0", "copyleft"), ("MS-PL", "permissive"), ("NCSA", "permissive"), ("ODbL-1.0", "copyleft"), ("OFL-1.1", "permissive"), ("PostgreSQL", "permissive"), ("PSF-2.0", "permissive"),
    ("SSPL-1.0", "restricted"), ("Unlicense", "permissive"), ("UPL-1.0", "permissive"), ("WTFPL", "permissive"), ("Zlib", "permissive"), ("ZPL-2.1", "permissive"),
)

#: Fixed values: (sentence identifier, normalised sentences) of notices and titles without variable parts.
FIXED: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("agpl-3.0-title", ("gnu affero general public license", "gnu affero general public license version 3 19 november 2007", "gnu affero general public license version 3")),
    ("gpl-2.0-title", ("gnu general public license version 2 june 1991", "gnu general public license version 2")),
    ("gpl-3.0-title", ("gnu general public license version 3 29 june 2007", "gnu general public license version 3")),
    ("lgpl-title", ("gnu lesser general public license", "gnu library general public license")),
    ("apache-2.0-title", ("apache license version 2.0", "apache license version 2.0 january 2004")),
    ("mit-title", ("mit license", "the mit license", "the mit license mit")),
    ("bsd-2-title", ("bsd 2 clause license", "the bsd 2 clause license", "bsd 2 clause")),
    ("bsd-3-title", ("bsd 3 clause license", "the bsd 3 clause license", "bsd 3 clause", "new bsd license")),
    ("mpl-2.0-title", ("mozilla public license version 2.0", "mozilla public license 2.0")),
    ("epl-2.0-title", ("eclipse public license v 2.0", "eclipse public license version 2.0")),
    ("isc-title", ("isc license", "the isc license")),
    ("unlicense-title", ("this is free and unencumbered software released into the public domain",)),
    ("wtfpl-title", ("do what the fuck you want to public license",)),
    ("bsl-1.0-title", ("boost software license version 1.0", "boost software license version 1.0 august 17th 2003")),
)

#: Patterns of whole normalised sentences that stand inside notices and decide nothing.
FILLERS = (
    r"you may obtain a copy of the license at.*",
    r"https? (www\.)?apache\.org licenses license 2\.0",
    r"the above copyright notice and this permission notice .*shall be included in all copies.*",
    r"see the license for the specific language governing permissions and limitations under the license",
)
_FILLER = "~"
#: A sentence without a letter or a digit, such as an empty comment line, is no gap either.
_WORDS = r"[\p{L}\p{N}]"


def spdx_sentences() -> dict[str, str]:
    """Normalised tag lines and their sentence identifiers: each identifier plain, ``-only`` and ``-or-later``."""
    plain = lambda name: name.lower().replace("-", " ")
    ends = ("", " only", " or later")
    return {f"spdx license identifier {plain(name)}{end}": f"spdx-{name}" for name, _ in SPDX for end in (ends if "GPL" in name or "GFDL" in name else ends[:1])}


#: Normalised sentence -> sentence identifier.
DICTIONARY: dict[str, str] = spdx_sentences() | {text: name for name, texts in FIXED for text in texts}

#: Fixed values: (licence, category, sequence of sentence identifiers); earlier rules go first.
NOTICES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("Apache-2.0", "permissive", ("apache-2.0-grant", "apache-2.0-use", "apache-2.0-asis")),
    ("MIT", "permissive", ("mit-grant", "mit-permission", "mit-asis")),
    ("MIT", "permissive", ("mit-permission", "mit-asis")),
    ("Apache-2.0", "permissive", ("apache-2.0-grant",)),
    ("MIT", "permissive", ("mit-grant",)),
    ("MIT", "permissive", ("mit-permission",)),
    ("GPL-3.0", "copyleft", ("gpl-3.0-grant",)),
    ("GPL-2.0", "copyleft", ("gpl-2.0-grant",)),
    ("GPL", "copyleft", ("gpl-redistribute",)),
    ("LGPL", "copyleft", ("lgpl-grant",)),
    ("BSD", "permissive", ("bsd-redistribution",)),
    ("MPL-2.0", "copyleft", ("mpl-2.0-grant",)),
    ("CC-BY-NC-4.0", "restricted", ("cc-by-nc-4.0-grant",)),
    ("CC-BY-SA-4.0", "copyleft", ("cc-by-sa-4.0-grant",)),
    ("CC-BY-4.0", "permissive", ("cc-by-4.0-grant",)),
    ("CC0-1.0", "permissive", ("cc0-1.0-grant",)),
    ("Proprietary", "restricted", ("copyright", "all-rights-reserved")),
    ("Proprietary", "restricted", ("all-rights-reserved",)),
    ("AGPL-3.0", "copyleft", ("agpl-grant",)),
    ("ISC", "permissive", ("isc-permission",)),
    ("Zlib", "permissive", ("zlib-permission",)),
    ("EPL-2.0", "copyleft", ("epl-2.0-grant",)),
    ("AGPL-3.0", "copyleft", ("agpl-3.0-title",)),
    ("GPL-2.0", "copyleft", ("gpl-2.0-title",)),
    ("GPL-3.0", "copyleft", ("gpl-3.0-title",)),
    ("LGPL", "copyleft", ("lgpl-title",)),
    ("Apache-2.0", "permissive", ("apache-2.0-title",)),
    ("MIT", "permissive", ("mit-title",)),
    ("BSD-2-Clause", "permissive", ("bsd-2-title",)),
    ("BSD-3-Clause", "permissive", ("bsd-3-title",)),
    ("MPL-2.0", "copyleft", ("mpl-2.0-title",)),
    ("EPL-2.0", "copyleft", ("epl-2.0-title",)),
    ("ISC", "permissive", ("isc-title",)),
    ("Unlicense", "permissive", ("unlicense-title",)),
    ("WTFPL", "permissive", ("wtfpl-title",)),
    ("BSL-1.0", "permissive", ("bsl-1.0-title",)),
)
#: The notices' rules, then one a tag line.
RULES = NOTICES + tuple((name, kind, (f"spdx-{name}",)) for name, kind in SPDX)

#: A text without any of these words, in any case, has no sentence that a pattern matches.
TRIGGER = "(?i)licen|permission|as is|redistribut|rights reserved|copyright|public domain|cc0|bsd"

#: The same in sentences whose words any run of white space or punctuation parts.
_WIDE_TRIGGER = r"(?i)licen|permission|as\W+is|redistribut|rights\W+reserved|copyright|public\W+domain|cc0|bsd"

_NO = "CAST(array() AS array<string>)"
_BREAK = r"[\n\r]+|(?<=[.!?;])\s+"

#: Sentences over wrapped lines end at a blank line or after a stop that is not that of "v. 2.0"; so each holds whole pieces of _BREAK.
_LONG_BREAK = r"(?>\r\n|\n|\r)[^\S\n\r]*[\n\r]\s*|(?<=[.!?;])(?<!\bv\.)\s+"


def normalised(sentence: Column) -> Column:
    """Lower case; runs of anything but letters, digits and dots between digits become one space."""
    kept = F.regexp_replace(F.lower(sentence), r"(?<![0-9])\.|\.(?![0-9])", " ")
    return F.trim(F.regexp_replace(kept, r"[^\p{L}\p{N}.]+", " "))


def _dictionary() -> Column:
    return F.create_map(*[F.lit(x) for pair in sorted(DICTIONARY.items()) for x in pair])


def sentence_id(sentence: Column, start: str = "") -> Column:
    """The identifier of a normalised sentence, null where nothing has it; ``start`` is what may stand before."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(SENTENCES + PUBLISHED + tuple((_FILLER, pattern) for pattern in FILLERS)):
        out = F.when(sentence.rlike(f"^{start}(?:{pattern})$"), F.lit(name)).otherwise(out)
    return F.coalesce(F.try_element_at(_dictionary(), sentence), out)


def _long_ids(long: Column) -> Column:
    """Identifiers of a sentence over lines, null for a gap: those of its lines up to the last that has one, then that of the others joined, or a gap each."""
    lines = F.filter(F.split(long, _BREAK), lambda s: F.trim(s) != "")
    tried = F.transform(lines, lambda s: F.when(~s.rlike(_WORDS), F.lit(_FILLER)).when(s.rlike(_WIDE_TRIGGER), sentence_id(normalised(s))))
    # a title stands at the start of a sentence, not at the end of a wrapped one
    tried = F.transform(tried, lambda name, i: F.when((i == 0) | ~F.coalesce(name.endswith("-title"), F.lit(False)), name))

    def both(x: Column) -> Column:
        last = F.array_max(F.transform(x["ids"], lambda name, i: F.when(name != _FILLER, i + 1).otherwise(0)))
        rest = F.array_join(F.slice(x["lines"], last + 1, F.greatest(F.size(x["lines"]) - last, F.lit(0))), "\n")
        wrapped = F.when((F.size(x["lines"]) - last > 1) & rest.rlike(_WIDE_TRIGGER), sentence_id(normalised(rest), "(?:.* )?(?<!not )"))
        return F.when(wrapped.isNull(), x["ids"]).otherwise(F.array_append(F.slice(x["ids"], 1, last), wrapped))

    return F.element_at(F.transform(F.array(F.struct(lines.alias("lines"), tried.alias("ids"))), both), 1)


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_sentences, sentence_ids, licences, categories.

    ``licences`` are the names found, in the order of the rules, without repeats; of rules that fit the
    same sentences the earlier has them. A null or empty text has no sentence. Sentences and texts of
    any length are read whole. Null ids and rows that repeat are met each by itself; other columns are
    ignored whatever their names. An empty table gives an empty result. Everything is a projection: no
    shuffle, no group, so hot sources and long texts only cost their own size.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    frame = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    raw = F.filter(F.split("text", _BREAK), lambda s: F.trim(s) != "")
    # only the sentences that hold a trigger are normalised and tested; any other is a gap, blank ones are nothing
    long = F.when(F.col("text").rlike(_WIDE_TRIGGER), F.filter(F.split("text", _LONG_BREAK), lambda s: F.trim(s) != ""))
    frame = frame.select("doc_id", F.size(raw).cast("bigint").alias("n_sentences"), F.coalesce(long, F.expr(_NO)).alias("long"))
    other = lambda s: F.array(F.when(~s.rlike(_WORDS), F.lit(_FILLER)))
    told = F.flatten(F.transform("long", lambda s: F.when(s.rlike(_WIDE_TRIGGER), _long_ids(s)).otherwise(other(s))))
    # fillers go; a run of gaps is one, as an empty text
    kept = F.transform(F.filter(told, lambda i: ~i.eqNullSafe(F.lit(_FILLER))), lambda i: F.coalesce(i, F.lit("")))
    frame = frame.select("doc_id", "n_sentences", kept.alias("kept"))
    frame = frame.withColumn("sentence_ids", F.filter("kept", lambda i: i != ""))
    # identifiers are joined as ",a,,b,", with a gap ",a,,,,b,": a rule takes its places out, later rules see a gap there
    line = F.regexp_replace(F.concat(F.lit(","), F.array_join("kept", ",,"), F.lit(",")), ",{4,}", ",,,,")
    frame = frame.withColumn("line", F.when(F.size("sentence_ids") > 0, line).otherwise(F.lit(""))).drop("kept")
    found = []
    for k, (_, _, sequence) in enumerate(RULES):
        needle = F.lit("," + ",,".join(sequence) + ",")
        frame = frame.withColumn(f"hit{k}", F.contains("line", needle)).withColumn("line", F.replace("line", needle, F.lit("|")))
        found.append(F.col(f"hit{k}"))
    names = F.array_compact(F.array(*[F.when(h, F.lit(r[0])) for h, r in zip(found, RULES)]))
    kinds = F.array_compact(F.array(*[F.when(h, F.lit(r[1])) for h, r in zip(found, RULES)]))
    return frame.select("doc_id", "n_sentences", "sentence_ids", F.array_distinct(names).alias("licences"), F.array_sort(F.array_distinct(kinds)).alias("categories"))


def licence_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_matched, sentence_ids, licences, categories, restricted; lists joined by commas."""
    return scan_licences(docs).select(
        "doc_id",
        "n_sentences",
        F.size("sentence_ids").cast("bigint").alias("n_matched"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
        F.array_join("categories", ",").alias("categories"),
        F.array_contains("categories", "restricted").alias("restricted"),
    )
