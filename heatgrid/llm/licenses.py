"""Licence recognition by sentence rules. Columns only.

A text is cut into sentences, twice: within its lines, and across line ends inside paragraphs, since
licences are often wrapped. For the second, comment signs at line starts are taken away, a line without
letters and digits ends a paragraph, and so do a list mark and the colon before a list of conditions.
Sentences in lower case and without punctuation are looked up in a table of known licence sentences, which
gives each an identifier. Names of holders and years in a few of them count as the usual word. An SPDX line is
as many sentences as its expression has licences; exceptions after WITH are passed over. The
sequence of identifiers is then held against ordered rules; a rule names a licence and matches a run of
identifiers. ``licence`` is that of the first rule that matches, ``licences`` those of all.

Only texts that contain a word without which no known sentence can be, in any case, are cut at all.

Defined cases: a NULL text counts as empty, and a text without known sentences has the licence '' and an
empty sequence; repeated rows give repeated rows; columns other than doc_id and text are neither read nor
returned.
"""

import re
from functools import reduce
from itertools import product
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.llm.shared import text_or_empty

CC_PARTS = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")

# Sentences of published licences and licence notices, by identifier.
SENTENCES = {
    "mit-name": ["MIT License", "The MIT License", "The MIT License (MIT)", "Released under the MIT License",
                 "Licensed under the MIT License", "This project is licensed under the MIT License"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "mit-condition": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "mit-warranty": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "apache-name": ["Licensed under the Apache License, Version 2.0", "Apache License, Version 2.0",
                    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"],
    "apache-copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "apache-warranty": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "gpl2-only": ["This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public License, version 2"],
    "gpl3-only": ["This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3"],
    "gpl2-later": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"],
    "gpl3-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "gpl-warranty": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"],
    "mpl2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, version 2.0"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "unlicense": ["This is free and unencumbered software released into the public domain without copyright"],
    "reserved": ["All rights reserved", "Copyright, all rights reserved"],
}
#: Names of licences by identifier, from which notices and SPDX lines are built.
NAMES = {
    "apache-name": ("Apache-2.0", ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"]),
    "gpl2-only": ("GPL-2.0-only", ["GNU General Public License, version 2", "GNU General Public License v2.0"]),
    "gpl3-only": ("GPL-3.0-only", ["GNU General Public License, version 3", "GNU General Public License v3.0"]),
    "agpl3-only": ("AGPL-3.0-only", ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0"]),
    "lgpl2-only": ("LGPL-2.1-only", ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1"]),
    "lgpl3-only": ("LGPL-3.0-only", ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0"]),
    "mpl2": ("MPL-2.0", ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"]),
    "cc0": ("CC0-1.0", ["CC0 1.0", "CC0 1.0 Universal", "CC0 1.0 Universal License"]),
    "epl1": ("EPL-1.0", ["Eclipse Public License, version 1.0", "Eclipse Public License v1.0", "Eclipse Public License 1.0"]),
    "epl2": ("EPL-2.0", ["Eclipse Public License, version 2.0", "Eclipse Public License v2.0", "Eclipse Public License 2.0"]),
    "bsl1": ("BSL-1.0", ["Boost Software License, Version 1.0", "Boost Software License 1.0"]),
    "zlib": ("Zlib", ["zlib License"]),
    "0bsd": ("0BSD", ["Zero-Clause BSD License", "BSD Zero Clause License"]),
    "isc-name": ("ISC", ["ISC License"]),
    "mit-name": ("MIT", ["MIT License"]),
    "bsd2-name": ("BSD-2-Clause", ["BSD 2-Clause License", "Simplified BSD License"]),
    "bsd3-name": ("BSD-3-Clause", ["BSD 3-Clause License", "New BSD License", "Modified BSD License"]),
    "unlicense": ("Unlicense", ["Unlicense"]),
    "gpl2-later": ("GPL-2.0-or-later", ["GNU General Public License, version 2 or later", "GNU General Public License v2.0 or later"]),
    "gpl3-later": ("GPL-3.0-or-later", ["GNU General Public License, version 3 or later", "GNU General Public License v3.0 or later"]),
    "agpl3-later": ("AGPL-3.0-or-later", ["GNU Affero General Public License, version 3 or later"]),
    "lgpl": ("LGPL-2.1-or-later", ["GNU Lesser General Public License, version 2.1 or later"]),
    "lgpl3-later": ("LGPL-3.0-or-later", ["GNU Lesser General Public License, version 3 or later"]),
}
NOTICES = ("Licensed under", "Released under", "Distributed under", "This work is licensed under", "This project is licensed under",
           "This program is licensed under", "This software is licensed under", "This software is released under")
for key, (spdx, names) in NAMES.items():
    SENTENCES.setdefault(key, [])
    SENTENCES[key] += [f"{start} {the}{name}" for start in NOTICES for the in ("the ", "") for name in names]
    SENTENCES[key] += [f"{start} {the}{spdx}{end}" for start in NOTICES for the, end in (("", ""), ("the ", " license"))]
    SENTENCES[key] += [f"SPDX-License-Identifier: {spdx.removesuffix('-only')}", f"SPDX-License-Identifier: {spdx}"]
    SENTENCES[key] += [f"SPDX-License-Identifier: {spdx.removesuffix('-or-later')}+"] * spdx.endswith("-or-later")
FREE = "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"
SENTENCES["agpl3-later"] += [FREE.format("This program", "Affero")]
SENTENCES["lgpl3-later"] += [FREE.format(start, "Lesser") for start in ("This library", "This program")]
SENTENCES["cc0"] += ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"]
SENTENCES["zlib"] += ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"]
SENTENCES["bsl1"] += ["Distributed under the Boost Software License, Version 1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"]
SENTENCES["0bsd"] += ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"]
SENTENCES["epl1"] += ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"]
SENTENCES["epl2"] += ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"]
SENTENCES["bsd-endorse"] += ["The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission"]
for parts in CC_PARTS:
    SENTENCES["cc " + parts] = [
        f"{start} {name}{version}{end}"
        for version in CC_VERSIONS
        for start, name, end in (
            ("Licensed under", f"CC {parts.upper().replace(' ', '-')} ", ""),
            ("This work is licensed under", f"CC {parts.upper().replace(' ', '-')} ", ""),
            ("Licensed under a Creative Commons", f"{parts.upper().replace(' ', '-')} ", " License"),
        )
    ]
    SENTENCES["cc " + parts] += [f"SPDX-License-Identifier: CC-{parts.upper().replace(' ', '-')}-{version}" for version in CC_VERSIONS]

# Names of the Creative Commons licences and the heads of licence texts.
CC_WORDS = {"by": ["Attribution"], "sa": ["ShareAlike", "Share Alike"], "nd": ["NoDerivatives", "NoDerivs"], "nc": ["NonCommercial", "Noncommercial"]}
CC_PORTS = {"2.0": ("Generic",), "2.5": ("Generic",), "3.0": ("Unported",), "4.0": ("International",)}
HEADS = {
    "apache-name": ["Apache License Version 2.0, January 2004", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "gpl2-only": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "gpl3-only": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "agpl3-only": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "lgpl2-only": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "lgpl3-only": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "mpl2": ["Mozilla Public License Version 2.0"],
    "epl1": ["Eclipse Public License - v 1.0"],
    "epl2": ["Eclipse Public License - v 2.0"],
    "bsl1": ["Boost Software License - Version 1.0 - August 17th, 2003"],
}
for key, heads in HEADS.items():
    SENTENCES[key] += heads
for parts in CC_PARTS:
    for spelled in product(*(CC_WORDS[part] for part in parts.split())):
        for version, ports in CC_PORTS.items():
            for port in ("", *(f" {port}" for port in ports)):
                name = f"Creative Commons {'-'.join(spelled)} {version}{port}"
                SENTENCES["cc " + parts] += [
                    f"{start}{the}{name}{end}"
                    for start in ("This work is licensed under ", "Licensed under ", "Released under ")
                    for the in ("a ", "the ")
                    for end in (" License", " Public License")
                ]
                SENTENCES["cc " + parts] += [name, f"{name} License", f"{name} Public License"]

#: Names that stand in a known sentence, on the normalised sentence: (pattern, what it becomes).
SLOTS = [
    (r"^neither the names? of (?!the copyright holder nor ).+? nor the names of (?:its|their|the|any)( other)? contributors may be used",
     "neither the name of the copyright holder nor the names of its contributors may be used"),
    (r"^the names? of (?!the author may ).+? may not be used to endorse", "the name of the author may not be used to endorse"),
    (r"^copyright (?:c )?(?:[0-9]{4} )+(?:by )?.+? all rights reserved$", "copyright all rights reserved"),
    (r"^to the extent possible under law .+? has waived all copyright", "to the extent possible under law the author has waived all copyright"),
]

#: (licence, run of identifiers as a pattern over " a b c "); the first that matches decides.
RULES = [
    # The endorsement may be known by the other way to cut only.
    ("BSD-3-Clause", r" bsd-grant( reserved)* bsd-source bsd-binary ([^|]*\| ([^|]* )?bsd-binary )?bsd-endorse "),
    ("BSD-2-Clause", " bsd-grant( reserved)* bsd-source bsd-binary "),
    ("MIT", " mit-grant mit-condition( mit-warranty)? "),
    ("ISC", " isc-grant "),
    ("0BSD", " 0bsd "),
    ("Zlib", " zlib "),
    ("BSL-1.0", " bsl1 "),
    ("AGPL-3.0-or-later", " agpl3-later "),
    ("AGPL-3.0-only", " agpl3-only "),
    ("LGPL-3.0-or-later", " lgpl3-later "),
    ("GPL-3.0-or-later", " gpl3-later "),
    ("GPL-2.0-or-later", " gpl2-later "),
    ("LGPL-2.1-or-later", " lgpl "),
    ("LGPL-3.0-only", " lgpl3-only "),
    ("LGPL-2.1-only", " lgpl2-only "),
    ("GPL-3.0-only", " gpl3-only "),
    ("GPL-2.0-only", " gpl2-only "),
    ("Apache-2.0", " apache-name( apache-copy)?( apache-warranty)? "),
    ("MPL-2.0", " mpl2 "),
    ("EPL-2.0", " epl2 "),
    ("EPL-1.0", " epl1 "),
    ("BSD-3-Clause", " bsd3-name "),
    ("BSD-2-Clause", " bsd2-name "),
    ("ISC", " isc-name "),
    ("MIT", " mit-name "),
    ("CC0-1.0", " cc0 "),
    ("Unlicense", " unlicense "),
    *((f"CC-{parts.upper().replace(' ', '-')}", f" cc-{parts.replace(' ', '-')} ") for parts in reversed(CC_PARTS)),
    ("all-rights-reserved", " reserved "),
]

#: Each known sentence contains one of these in lower case.
ANCHORS = ("creative commons", "licen", "copyright", "rights reserved", "warrant", "permission", "redistribut", "free software", "released under", "distributed under")


CUT = r"([.!?])[ \t\r]+"
# What is taken away or ends a paragraph before line ends become spaces, in this order, with what replaces it.
COMMENT = r"(^|\n)[ \t]*(?:/\*+!?|\*+/|\*+|//+!?|#+|;+|--+|%+|<!--|>+|\|)[ \t]*"
LIST_MARK = r"(?:^|\n)[ \t]*\(?(?:[0-9]{1,2}|[a-h])[.)][ \t]+"
BEFORE_LIST = r"(?i)(conditions|following|met|restrictions):[ \t\r]*\n"
PARAGRAPH = r"\n[^\p{L}\p{N}\n]*\n"
SPDX_LINE = r"(?i)^.*spdx-license-identifier:"
SPDX_EXCEPTION = r"(?i)[ \t]+with[ \t]+[^ \t()]+"
SPDX_BETWEEN = r"(?i)[ \t]+(?:or|and)[ \t]+"


def known_sentences() -> dict[str, str]:
    """Identifier by normalised sentence. A sentence that is itself cut is known by its first part."""
    table = {}
    for name, known in SENTENCES.items():
        for sentence in known:
            first = re.split(CUT, sentence)[0].lower()
            table[re.sub(r"[^a-z0-9]+", " ", first).strip()] = name.replace(" ", "-")
    lost = [sentence for sentence in table if not any(anchor in sentence for anchor in ANCHORS)]
    if lost:
        raise ValueError(f"no anchor in {lost}")
    return table


def rules_by_name() -> list[tuple[str, str, str]]:
    """(licence, any of its rules, what must not match): a licence that is part of another does not stand beside it."""
    rules: dict[str, list[str]] = {}
    for name, rule in RULES:
        rules.setdefault(name, []).append(rule)
    whole = {name: "|".join(f"(?:{rule})" for rule in known) for name, known in rules.items()}
    never = "^$"  # sequences are never empty
    # A reservation of rights says nothing where a licence is given.
    unless = {"BSD-2-Clause": whole["BSD-3-Clause"], "all-rights-reserved": "|".join(whole[n] for n in whole if n != "all-rights-reserved")}
    return [(name, whole[name], unless.get(name, never)) for name in whole]


def sentences(text: Column) -> Column:
    """Cut after . ! or ? before white space, and at line ends."""
    return F.split(F.regexp_replace(text, CUT, "$1\n"), "\n", -1)


def unwrapped_sentences(text: Column) -> Column:
    """The same, but line ends inside a paragraph are spaces, and comment signs go."""
    text = F.regexp_replace(text, COMMENT, "$1")
    text = F.regexp_replace(text, LIST_MARK, "\n\n")
    text = F.regexp_replace(text, BEFORE_LIST, "$1:\n\n")
    paragraphs = F.split(text, PARAGRAPH, -1)
    return F.flatten(F.transform(paragraphs, lambda p: sentences(F.regexp_replace(p, r"\n", " "))))


def spdx_parted(cut: Column) -> Column:
    """Sentences, with an SPDX line for each licence of an expression."""

    def parted(sentence: Column) -> Column:
        expression = F.regexp_replace(F.regexp_replace(sentence, SPDX_LINE, ""), SPDX_EXCEPTION, "")
        each = F.transform(F.split(expression, SPDX_BETWEEN, -1), lambda part: F.concat(F.lit("SPDX-License-Identifier: "), part))
        return F.when(sentence.rlike(SPDX_LINE), each).otherwise(F.array(sentence))

    return F.flatten(F.transform(cut, parted))


def normalised(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def named(sentence: Column) -> Column:
    """A normalised sentence with the usual word for the names in it; only few sentences can hold one."""
    out = sentence
    for pattern, usual in SLOTS:
        out = F.regexp_replace(out, pattern, usual)
    return F.when(sentence.rlike("^(neither the|the name|copyright|to the extent)"), out).otherwise(sentence)


def anchored(text: Column) -> Column:
    return reduce(or_, (F.lower(text).contains(anchor) for anchor in ANCHORS))


def recognise(docs: DataFrame) -> DataFrame:
    """(doc_id, licence, licences, sentence_ids, wrapped_ids) of every row.

    ``licences`` are joined by a comma in the order of the rules; the two sequences are those of the two ways
    to cut.
    """
    table = F.create_map(*(F.lit(x) for pair in known_sentences().items() for x in pair))

    def sequence(cut: Column) -> Column:
        found = F.transform(spdx_parted(F.filter(cut, anchored)), lambda s: F.element_at(table, named(normalised(s))))
        return F.array_join(F.filter(found, lambda i: i.isNotNull()), " ")

    ids = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(anchored(text_or_empty()), text_or_empty()).otherwise("").alias("text"),
    ).select(
        "doc_id",
        sequence(sentences(F.col("text"))).alias("sentence_ids"),
        sequence(unwrapped_sentences(F.col("text"))).alias("wrapped_ids"),
    )
    both = F.concat(F.lit(" "), F.col("sentence_ids"), F.lit(" | "), F.col("wrapped_ids"), F.lit(" "))
    licence = F.coalesce(*(F.when(both.rlike(rule), F.lit(name)) for name, rule in RULES), F.lit(""))
    every = F.concat_ws(",", *(F.when(both.rlike(rule) & ~both.rlike(unless), F.lit(name)) for name, rule, unless in rules_by_name()))
    return ids.select("doc_id", licence.alias("licence"), every.alias("licences"), "sentence_ids", "wrapped_ids")
