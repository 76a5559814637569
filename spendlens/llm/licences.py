"""Licence recognition by sentences: known sentences become identifiers, identifier sequences become licences.

Comment marks at the start of a line are taken away. A text is cut at blank lines and at `.`, `;`, `!`, `?` or `:` before
white space or the end, so sentences that were wrapped over several lines are whole again; every piece is lower-cased
(A-Z) with all runs of other characters than a-z and 0-9 turned into one space. A piece equal to a known sentence stands;
else its lines, if one of them is known by itself; else the longest known notice inside it, unless it says `not`; else
its lines, which are not known. A known sentence becomes its identifier; others vanish. The ordered rules are
then matched against what is left, longest first; a match uses up its identifiers, so the sentences of a full licence
text are not reported again as notices.

Defined results: a null or empty text has 0 sentences and no licence; any other column may be null or repeated;
equal rows give equal rows; an empty table gives an empty table. Everything runs inside one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import lower_ascii

#: Normalised licence sentences and their identifiers.
SENTENCES = {
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "this project is licensed under the mit license": "mit-notice",
    "the mit license mit": "mit-title",
    "mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-keep-notice",
    "the software is provided as is without warranty of any kind express or implied": "as-is",
    "licensed under the apache license version 2 0": "apache2-notice",
    "licensed under the apache license version 2 0 the license": "apache2-notice",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "you may obtain a copy of the license at": "apache2-copy-at",
    "apache license": "apache2-title",
    "this work is licensed under the gnu general public license version 3": "gpl3-notice",
    "gnu general public license": "gpl-title",
    "version 3 29 june 2007": "gpl3-date",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-terms",
    "licensed under cc by nc 4 0": "cc-by-nc4-notice",
    "licensed under cc by 4 0": "cc-by4-notice",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc4-notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by4-notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-notice",
    "all rights reserved": "all-rights-reserved",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "as-is",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-terms",
    "either version 2 of the license or at your option any later version": "gpl2-or-later",
    "either version 3 of the license or at your option any later version": "gpl3-or-later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-terms",
    "version 2 june 1991": "gpl2-date",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-notice",
    "spdx license identifier": "spdx",
    "mit": "spdx-mit",
    "apache 2 0": "spdx-apache2",
    "bsd 2 clause": "spdx-bsd2",
    "bsd 3 clause": "spdx-bsd3",
    "gpl 2 0 or later": "spdx-gpl2-or-later",
    "gpl 3 0 only": "spdx-gpl3",
    "gpl 3 0 or later": "spdx-gpl3-or-later",
    "isc": "spdx-isc",
    "mpl 2 0": "spdx-mpl2",
    "cc by 4 0": "spdx-cc-by4",
    "cc by nc 4 0": "spdx-cc-by-nc4",
}

#: Notices that also count inside a longer sentence.
NOTICES = {
    "licensed under the mit license": "mit-notice",
    "released under the mit license": "mit-notice",
    "distributed under the mit license": "mit-notice",
    "available under the mit license": "mit-notice",
    "under the terms of the mit license": "mit-notice",
    "licensed under the apache license version 2 0": "apache2-notice",
    "released under the apache license version 2 0": "apache2-notice",
    "under the terms of the apache license version 2 0": "apache2-notice",
    "licensed under the apache license 2 0": "apache2-notice",
    "licensed under the bsd 2 clause license": "bsd2-notice",
    "licensed under the bsd 3 clause license": "bsd3-notice",
    "under the terms of the bsd 3 clause license": "bsd3-notice",
    "licensed under the gnu general public license version 3": "gpl3-notice",
    "released under the gnu general public license version 3": "gpl3-notice",
    "under the terms of the gnu general public license version 3": "gpl3-notice",
    "licensed under the gnu gpl v3": "gpl3-notice",
    "licensed under the mozilla public license 2 0": "mpl2-notice",
    "subject to the terms of the mozilla public license v 2 0": "mpl2-notice",
    "licensed under cc by nc 4 0": "cc-by-nc4-notice",
    "licensed under cc by 4 0": "cc-by4-notice",
    "licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc4-notice",
    "licensed under a creative commons attribution 4 0 international license": "cc-by4-notice",
}
KNOWN = NOTICES | SENTENCES

#: Licence, kind, and the identifiers that make it up, in order; earlier rules win.
RULES = (
    ("MIT", "permissive", ("mit-title", "mit-grant", "mit-keep-notice", "as-is")),
    ("MIT", "permissive", ("mit-grant", "mit-keep-notice", "as-is")),
    ("BSD-3-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("Apache-2.0", "permissive", ("apache2-notice", "apache2-comply", "apache2-copy-at")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free", "gpl3-terms")),
    ("BSD-2-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0", "copyleft", ("gpl-title", "gpl3-date")),
    ("MIT", "permissive", ("mit-title", "mit-grant")),
    ("GPL-3.0", "copyleft", ("gpl3-notice",)),
    ("Apache-2.0", "permissive", ("apache2-notice",)),
    ("MIT", "permissive", ("mit-notice",)),
    ("CC-BY-NC-4.0", "noncommercial", ("cc-by-nc4-notice",)),
    ("CC-BY-4.0", "permissive", ("cc-by4-notice",)),
    ("MPL-2.0", "copyleft", ("mpl2-notice",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free", "gpl-terms", "gpl3-or-later")),
    ("GPL-2.0-or-later", "copyleft", ("gpl-free", "gpl-terms", "gpl2-or-later")),
    ("GPL-2.0-or-later", "copyleft", ("gpl-free", "gpl2-terms")),
    ("GPL-2.0", "copyleft", ("gpl-title", "gpl2-date")),
    ("ISC", "permissive", ("isc-grant",)),
    ("BSD-2-Clause", "permissive", ("bsd2-notice",)),
    ("BSD-3-Clause", "permissive", ("bsd3-notice",)),
    ("MIT", "permissive", ("spdx", "spdx-mit")),
    ("Apache-2.0", "permissive", ("spdx", "spdx-apache2")),
    ("BSD-2-Clause", "permissive", ("spdx", "spdx-bsd2")),
    ("BSD-3-Clause", "permissive", ("spdx", "spdx-bsd3")),
    ("GPL-2.0-or-later", "copyleft", ("spdx", "spdx-gpl2-or-later")),
    ("GPL-3.0", "copyleft", ("spdx", "spdx-gpl3")),
    ("GPL-3.0-or-later", "copyleft", ("spdx", "spdx-gpl3-or-later")),
    ("ISC", "permissive", ("spdx", "spdx-isc")),
    ("MPL-2.0", "copyleft", ("spdx", "spdx-mpl2")),
    ("CC-BY-4.0", "permissive", ("spdx", "spdx-cc-by4")),
    ("CC-BY-NC-4.0", "noncommercial", ("spdx", "spdx-cc-by-nc4")),
)

LINE_END = r"\r\n?"
COMMENT_MARK = r"\n[ \t]*(?:/\*+|\*+/|//+|\*+|#+|;+|--+|%+|<!--+|-->)[ \t]?"
SENTENCE_END = r"\n[ \t]*\n[ \t\n]*|[.;!?:]+([ \t\n\f]|\z)"
OTHER = "[^a-z0-9]+"


def _plain(piece: Column) -> Column:
    return F.trim(F.regexp_replace(piece, OTHER, " "))


def _notice(piece: Column, notices: dict[str, str]) -> Column:
    """The longest of the notices that stand inside a normalised sentence; null if none does, or it says `not`."""
    framed = F.concat(F.lit(" "), piece, F.lit(" "))
    found = F.lit(None).cast("string")
    for notice in sorted(notices, key=lambda n: (-len(n), n))[::-1]:
        found = F.when(F.contains(framed, F.lit(f" {notice} ")), notice).otherwise(found)
    return F.when(F.contains(piece, F.lit("licen")) | F.contains(piece, F.lit("under")), F.when(~F.contains(framed, F.lit(" not ")), found))


def _sentences(text: Column, known: dict[str, str], notices: dict[str, str]) -> Column:
    """Normalised sentences of a text, as the module says; none is empty."""
    lines = F.regexp_replace(F.concat(F.lit("\n"), lower_ascii(F.coalesce(text, F.lit("")))), LINE_END, "\n")
    pieces = F.split(F.regexp_replace(lines, COMMENT_MARK, "\n"), SENTENCE_END)
    names = list(known)

    def parts(piece: Column) -> Column:
        whole = _plain(piece)
        single = F.filter(F.transform(F.split(piece, "\n"), _plain), lambda line: line != "")
        notice = _notice(whole, notices)
        return F.when(whole.isin(names), F.array(whole)).when(F.exists(single, lambda line: line.isin(names)), single).when(
            notice.isNotNull(), F.array(notice)).otherwise(single)

    return F.flatten(F.transform(pieces, parts))


def _known(sentences: Column, known: dict[str, str]) -> Column:
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.transform(F.filter(sentences, lambda s: s.isin(list(known))), lambda s: F.try_element_at(names, s))


def rule_text(identifiers) -> str:
    """A run of identifiers as it stands in a sequence; ` x;` can only match whole identifiers."""
    return "".join(f" {x};" for x in identifiers)


def _matched(identifiers: Column, rules) -> Column:
    """array<struct<name, kind>> of the rules that matched, in rule order."""
    entry = "struct<name:string,kind:string>"
    table = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind"), F.lit(rule_text(i)).alias("run")) for n, k, i in rules])
    start = F.struct(
        F.concat_ws("", F.transform(identifiers, lambda s: F.concat(F.lit(" "), s, F.lit(";")))).alias("rest"),
        F.array().cast(f"array<{entry}>").alias("found"),
    )

    def use_up(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["run"])
        named = F.array_append(state["found"], F.struct(rule["name"], rule["kind"]))
        return F.struct(F.replace(state["rest"], rule["run"], F.lit(" |")).alias("rest"),
                        F.when(hit, named).otherwise(state["found"]).alias("found"))

    none = F.array().cast(f"array<{entry}>")
    return F.when(F.size(identifiers) > 0, F.aggregate(table, start, use_up, lambda state: state["found"])).otherwise(none)


def scan_licences(docs: DataFrame, known: dict[str, str] | None = None, rules=RULES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """doc_id, n_sentences, sentence_ids (array, in text order), licences and kinds (arrays, rule order, each once)."""
    every = notices | (SENTENCES if known is None else known)
    sentences = docs.select("doc_id", _sentences(F.col("text"), every, notices).alias("sentences"))
    found = sentences.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"), _known(F.col("sentences"), every).alias("sentence_ids"))
    matched = found.withColumn("matched", _matched(F.col("sentence_ids"), rules))
    return matched.select(
        "doc_id", "n_sentences", "sentence_ids",
        F.array_distinct(F.col("matched")["name"]).alias("licences"),
        F.array_distinct(F.col("matched")["kind"]).alias("kinds"),
    )
