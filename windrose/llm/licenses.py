"""License scans by ordered signature rules (operator 7).

A rule is a regular expression over the text in lower case, a keyword that must
occur for the expression to run at all, and a priority.  Rules for the wording
of license bodies, file headers and notices are written one by one; those for
mentions come from a table of license names and a list of sentence forms.
Detections that lie inside one of higher priority, or inside a longer one of the
same, are suppressed.

Defined cases: a null text counts as empty: no words, no places, no labels,
score 0; text of any length is scanned whole; rows repeat as they are; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from windrose.llm.common import ASCII_LOWER, WORD_BYTES, prepare, texts

# base phrases and their labels (fixed values)
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# label, keyword, expression of the license's name (fixed values: public license names)
LICENSES = [
    ("mit", "mit", r"(?:the )?mit(?:/x11)?"),
    ("apache-1.1", "apache", r"(?:the )?apache(?: software)? license,? (?:version |v)?1\.1"),
    ("apache-2", "apache", r"(?:the )?apache(?: software)?(?: license)?[ ,-]*(?:version |v)?2(?:\.0)?"),
    ("bsd-2-clause", "bsd", r"(?:the )?(?:simplified|freebsd|2-clause|two-clause) bsd|bsd[ -]2-clause"),
    ("bsd-3-clause", "bsd", r"(?:the )?(?:new|modified|revised|3-clause|three-clause) bsd|bsd[ -]3-clause"),
    ("bsd-4-clause", "bsd", r"(?:the )?(?:original|4-clause) bsd|bsd[ -]4-clause"),
    ("0bsd", "bsd", r"(?:the )?(?:zero-clause bsd|bsd zero clause|0bsd)"),
    ("gpl-2", "gpl|gnu general", r"(?:the )?(?:gnu )?(?:gpl|general public license)[ ,-]*(?:version |v)?2(?:\.0)?"),
    ("gpl-3", "gpl|gnu general", r"(?:the )?(?:gnu )?(?:gpl|general public license)[ ,-]*(?:version |v)?3(?:\.0)?"),
    ("lgpl-2.1", "lgpl|lesser", r"(?:the )?(?:gnu )?(?:lgpl|lesser general public license)[ ,-]*(?:version |v)?2\.1"),
    ("lgpl-3", "lgpl|lesser", r"(?:the )?(?:gnu )?(?:lgpl|lesser general public license)[ ,-]*(?:version |v)?3(?:\.0)?"),
    ("agpl-3", "agpl|affero", r"(?:the )?(?:gnu )?(?:agpl|affero general public license)[ ,-]*(?:version |v)?3(?:\.0)?"),
    ("fdl-1.3", "documentation|fdl", r"(?:the )?gnu (?:free documentation license|fdl)[ ,-]*(?:version |v)?1\.3"),
    ("mpl-1.1", "mozilla|mpl", r"(?:the )?(?:mozilla public license|mpl)[ ,-]*(?:version |v)?1\.1"),
    ("mpl-2", "mozilla|mpl", r"(?:the )?(?:mozilla public license|mpl)[ ,-]*(?:version |v)?2(?:\.0)?"),
    ("epl-1", "eclipse|epl", r"(?:the )?(?:eclipse public license|epl)[ ,-]*(?:version |v)?1(?:\.0)?"),
    ("epl-2", "eclipse|epl", r"(?:the )?(?:eclipse public license|epl)[ ,-]*(?:version |v)?2(?:\.0)?"),
    ("cddl-1", "cddl|common development", r"(?:the )?(?:common development and distribution license|cddl)[ ,-]*(?:version |v)?1(?:\.0)?"),
    ("artistic-2", "artistic", r"(?:the )?artistic license[ ,-]*(?:version |v)?2(?:\.0)?"),
    ("isc", "isc", r"(?:the )?isc"),
    ("zlib", "zlib", r"(?:the )?zlib(?:/libpng)?"),
    ("boost-1", "boost", r"(?:the )?boost software license[ ,-]*(?:version |v)?1(?:\.0)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"(?:the )?wtfpl"),
    ("postgresql", "postgresql", r"(?:the )?postgresql"),
    ("psf-2", "python software", r"(?:the )?python software foundation(?: license)?"),
    ("ofl-1.1", "open font|ofl", r"(?:the )?(?:sil )?(?:open font license|ofl)[ ,-]*(?:version |v)?1\.1"),
    ("eupl-1.2", "eupl|european union", r"(?:the )?(?:european union public licen[cs]e|eupl)[ ,-]*(?:version |v)?1\.2"),
    ("ms-pl", "microsoft public|ms-pl", r"(?:the )?(?:microsoft public license|ms-pl)"),
    ("cc0-1", "cc0|creative commons zero", r"(?:the )?(?:cc0|creative commons zero)(?:[ -]*(?:v)?1\.0)?"),
    ("cc-by", "cc[ -]by|attribution", r"(?:a |the )?(?:cc[ -]by|creative commons attribution)(?![ -](?:nc|nd|sa|non|no|share))(?: ?[1-4]\.0)?"),
    ("cc-by-sa", "cc[ -]by|attribution", r"(?:a |the )?(?:cc[ -]by[ -]sa|creative commons attribution[ -]+share[ -]?alike)(?: ?[1-4]\.0)?"),
    ("cc-by-nd", "cc[ -]by|attribution", r"(?:a |the )?(?:cc[ -]by[ -]nd|creative commons attribution[ -]+no[ -]?deriv\w*)(?: ?[1-4]\.0)?"),
    ("cc-by-nc", "cc[ -]by|attribution", r"(?:a |the )?(?:cc[ -]by[ -]nc|creative commons attribution[ -]+non[ -]?commercial)(?![ -](?:nd|sa|no|share))(?: ?[1-4]\.0)?"),
    ("cc-by-nc-sa", "cc[ -]by|attribution", r"(?:a |the )?(?:cc[ -]by[ -]nc[ -]sa|creative commons attribution[ -]+non[ -]?commercial[ -]+share[ -]?alike)(?: ?[1-4]\.0)?"),
    ("cc-by-nc-nd", "cc[ -]by|attribution", r"(?:a |the )?(?:cc[ -]by[ -]nc[ -]nd|creative commons attribution[ -]+non[ -]?commercial[ -]+no[ -]?deriv\w*)(?: ?[1-4]\.0)?"),
    ("public-domain", "public domain", r"(?:the )?public domain"),
    ("proprietary", "rights|proprietary", r"(?:an? |the )?(?:proprietary|commercial) license"),
]

# label, priority, keyword, expression: wording of license bodies, headers and notices
# (fixed values: phrases of public licenses; one blank stands for any gap)
_BODY, _HEADER, _NOTICE, _LINK = 98, 95, 88, 78
SIGNATURES = [
    ("mit", _BODY, "permission is hereby granted", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", _BODY, "the above copyright notice", r"the above copyright notice and this permission notice(?: \(including the next paragraph\))? shall be included in all copies or substantial portions of the software"),
    ("mit", _NOTICE, "mit-style", r"\bgoverned by an? mit-style licen[cs]e\b"),
    ("mit", _LINK, "opensource.org", r"opensource\.org/licenses?/mit\b"),
    ("mit-0", _BODY, "permission is hereby granted", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files [^.]{0,40}to deal in the software without restriction, including without limitation the rights to [^.]{0,120}and to permit persons to whom the software is furnished to do so\. the software is provided"),
    ("x11", _BODY, "except as contained in this notice", r"except as contained in this notice, the name[^.]{0,80} shall not be used in advertising or otherwise to promote the sale"),
    ("hpnd", _BODY, "permission to use", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("isc", _BODY, "permission to use", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted, provided that"),
    ("0bsd", _BODY, "permission to use", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted\."),
    ("bsd", _BODY, "redistribution and use", r"redistribution and use in source and binary forms,? with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", _BODY, "redistributions of source code", r"redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", _BODY, "redistributions in binary form", r"redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd-3-clause", _BODY, "neither the name", r"neither the names? of [^.]{1,120} nor the names of (?:its|their|the|any) [^.]{0,40}contributors may be used to endorse or promote products"),
    ("bsd-4-clause", _BODY, "all advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", _NOTICE, "bsd-style", r"\b(?:governed by|under|licensed under) an? bsd-style licen[cs]e\b"),
    ("bsd-2-clause", _LINK, "opensource.org", r"opensource\.org/licenses?/bsd-2-clause\b"),
    ("bsd-3-clause", _LINK, "opensource.org", r"opensource\.org/licenses?/bsd-3-clause\b"),
    ("bsd-3-clause-clear", _BODY, "no express or implied licenses", r"no express or implied licenses to any party's patent rights are granted by this license"),
    ("apache-2", _HEADER, "apache license, version 2", r"licensed under the apache license, version 2\.0 \(the \"license\"\); you may not use this file except in compliance with the license"),
    ("apache-2", _HEADER, "licensed to the apache", r"licensed to the apache software foundation \(asf\) under one or more contributor license agreements"),
    ("apache-2", _NOTICE, "you may obtain a copy", r"you may obtain a copy of the license at:? https?://www\.apache\.org/licenses/license-2\.0"),
    ("apache-2", _LINK, "apache.org/licenses", r"apache\.org/licenses/license-2\.0\b"),
    ("apache-2", _BODY, "apache license", r"apache license version 2\.0, january 2004"),
    ("apache-2", _BODY, "grant of patent license", r"grant of patent license\. subject to the terms and conditions of this license, each contributor hereby grants to you a perpetual, worldwide"),
    ("apache-1.1", _BODY, "this product includes software", r"this product includes software developed by the apache software foundation \(https?://www\.apache\.org/\)"),
    ("gpl-2-or-later", _HEADER, "general public license", r"under the terms of (?:version 2 of )?the gnu general public license as published by the free software foundation[;,] either version 2(?: of the license)?,? or \(?at your option\)? any later version"),
    ("gpl-3-or-later", _HEADER, "general public license", r"under the terms of the gnu general public license as published by the free software foundation[;,] either version 3(?: of the license)?,? or \(?at your option\)? any later version"),
    ("gpl-2", _HEADER, "general public license", r"under the terms of the gnu general public license,? version 2(?: only)?,? as published by the free software foundation"),
    ("gpl-2", _HEADER, "general public license", r"under the terms of version 2 of the gnu general public license as published by the free software foundation"),
    ("gpl-3", _HEADER, "general public license", r"under the terms of (?:version 3 of the gnu general public license|the gnu general public license,? version 3,?) as published by the free software foundation"),
    ("gpl", _NOTICE, "general public license", r"you should have received a copy of the gnu general public license along with this (?:program|file|library|package|software)"),
    ("gpl", _NOTICE, "general public license", r"see the gnu general public license for more details"),
    ("gpl-2", _BODY, "general public license", r"gnu general public license version 2, june 1991"),
    ("gpl-3", _BODY, "general public license", r"gnu general public license version 3, 29 june 2007"),
    ("gpl", _BODY, "guarantee your freedom", r"the gnu general public license is intended to guarantee your freedom to share and change"),
    ("gpl-2", _LINK, "gnu.org/licenses", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0\b"),
    ("gpl-3", _LINK, "gnu.org/licenses", r"gnu\.org/licenses/gpl-3\.0\b"),
    ("lgpl-2.1-or-later", _HEADER, "lesser general", r"under the terms of the gnu lesser general public license as published by the free software foundation[;,] either version 2\.1(?: of the license)?,? or \(?at your option\)? any later version"),
    ("lgpl-3-or-later", _HEADER, "lesser general", r"under the terms of the gnu lesser general public license as published by the free software foundation[;,] either version 3(?: of the license)?,? or \(?at your option\)? any later version"),
    ("lgpl-2-or-later", _HEADER, "library general", r"under the terms of the gnu library general public license as published by the free software foundation[;,] either version 2(?: of the license)?,? or \(?at your option\)? any later version"),
    ("lgpl", _NOTICE, "lesser general", r"you should have received a copy of the gnu lesser general public license along with this"),
    ("lgpl-2.1", _BODY, "lesser general", r"gnu lesser general public license version 2\.1, february 1999"),
    ("lgpl-3", _BODY, "lesser general", r"gnu lesser general public license version 3, 29 june 2007"),
    ("agpl-3-or-later", _HEADER, "affero", r"under the terms of the gnu affero general public license as published by the free software foundation[;,] either version 3(?: of the license)?,? or \(?at your option\)? any later version"),
    ("agpl-3", _BODY, "affero", r"gnu affero general public license version 3, 19 november 2007"),
    ("agpl", _NOTICE, "affero", r"you should have received a copy of the gnu affero general public license along with this"),
    ("fdl-1.3-or-later", _HEADER, "free documentation license", r"under the terms of the gnu free documentation license, version 1\.3 or any later version published by the free software foundation"),
    ("fdl-1.2-or-later", _HEADER, "free documentation license", r"under the terms of the gnu free documentation license, version 1\.2 or any later version published by the free software foundation"),
    ("mpl-2", _HEADER, "mozilla public license", r"this source code form is subject to the terms of the mozilla public license, v\. 2\.0"),
    ("mpl-2", _NOTICE, "mozilla.org/mpl", r"mozilla\.org/mpl/2\.0\b"),
    ("mpl-1.1", _HEADER, "mozilla public license", r"the contents of this file are subject to the mozilla public license version 1\.1"),
    ("mpl-2", _BODY, "incompatible with secondary licenses", r"this source code form is \"incompatible with secondary licenses\", as defined by the mozilla public license"),
    ("epl-2", _HEADER, "eclipse public license", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v\.? ?)?2\.0"),
    ("epl-1", _HEADER, "eclipse public license", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1\.0"),
    ("cddl-1", _HEADER, "common development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("boost-1", _HEADER, "boost software license", r"distributed under the boost software license, version 1\.0\.? \(?see accompanying file"),
    ("boost-1", _BODY, "machine-executable object code", r"unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor"),
    ("zlib", _BODY, "this software is provided 'as-is'", r"this software is provided 'as-is', without any express or implied warranty\. in no event will the authors be held liable"),
    ("zlib", _BODY, "must not be misrepresented", r"the origin of this software must not be misrepresented; you must not claim that you wrote the original software"),
    ("unlicense", _BODY, "unencumbered software", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", _LINK, "unlicense.org", r"\bunlicense\.org\b"),
    ("wtfpl", _BODY, "do what the fuck", r"do what the fuck you want to public license"),
    ("artistic-2", _BODY, "artistic license", r"the artistic license 2\.0 copyright \(c\) 2000-2006, the perl foundation"),
    ("perl", _HEADER, "perl itself", r"redistribute it and/or modify it under the same terms as perl itself"),
    ("psf-2", _BODY, "python software foundation", r"this license agreement is between the python software foundation"),
    ("postgresql", _BODY, "permission to use", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted"),
    ("ofl-1.1", _HEADER, "sil open font", r"this font software is licensed under the sil open font license, version 1\.1"),
    ("ofl-1.1", _LINK, "scripts.sil.org", r"scripts\.sil\.org/ofl\b"),
    ("eupl-1.2", _HEADER, "eupl", r"licensed under the eupl(?:, version 1\.2|-1\.2)(?: or - as soon they will be approved)?"),
    ("ms-pl", _BODY, "microsoft public license", r"this license governs use of the accompanying software\. if you use the software, you accept this license"),
    ("cc0-1", _HEADER, "cc0", r"(?:has|have) waived all copyright and related or neighboring rights"),
    ("cc0-1", _LINK, "creativecommons.org", r"creativecommons\.org/publicdomain/zero/1\.0\b"),
    ("cc-by", _LINK, "creativecommons.org", r"creativecommons\.org/licenses/by/[1-4]\.[05]\b"),
    ("cc-by-sa", _LINK, "creativecommons.org", r"creativecommons\.org/licenses/by-sa/[1-4]\.[05]\b"),
    ("cc-by-nd", _LINK, "creativecommons.org", r"creativecommons\.org/licenses/by-nd/[1-4]\.[05]\b"),
    ("cc-by-nc", _LINK, "creativecommons.org", r"creativecommons\.org/licenses/by-nc/[1-4]\.[05]\b"),
    ("cc-by-nc-sa", _LINK, "creativecommons.org", r"creativecommons\.org/licenses/by-nc-sa/[1-4]\.[05]\b"),
    ("cc-by-nc-nd", _LINK, "creativecommons.org", r"creativecommons\.org/licenses/by-nc-nd/[1-4]\.[05]\b"),
    ("cc-by", _HEADER, "creative commons", r"this work is licensed under (?:a|the) creative commons attribution (?:[1-4]\.[05] )?(?:international |unported |generic )?licen[cs]e"),
    ("cc-by-sa", _HEADER, "creative commons", r"this work is licensed under (?:a|the) creative commons attribution-sharealike (?:[1-4]\.[05] )?(?:international |unported |generic )?licen[cs]e"),
    ("cc-by-nc", _HEADER, "creative commons", r"this work is licensed under (?:a|the) creative commons attribution-noncommercial (?:[1-4]\.[05] )?(?:international |unported |generic )?licen[cs]e"),
    ("public-domain", _NOTICE, "public domain", r"(?:is|are|has been|have been) (?:hereby )?(?:placed|dedicated|released) (?:in|into|to) the public domain"),
    ("public-domain", _NOTICE, "no copyright", r"the author(?:s|\(s\))? (?:hereby )?disclaims? copyright to this source code"),
    ("bsl-1.1", _HEADER, "business source license", r"use of this software is governed by the business source license"),
    ("sspl-1", _BODY, "server side public license", r"server side public license version 1, october 16, 2018"),
    ("elastic-2", _NOTICE, "elastic license", r"licensed under the elastic license 2\.0"),
    ("beerware", _BODY, "beer", r"if we meet some day, and you think this stuff is worth it, you can buy me a beer"),
    ("ncsa", _BODY, "university of illinois", r"university of illinois/ncsa open source license"),
    ("openssl", _BODY, "openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("curl", _BODY, "permission to use", r"permission to use, copy, modify,? and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies\. the software is provided \"as is\", without warranty of any kind, express or implied, including but not limited"),
    ("proprietary", _NOTICE, "all rights reserved", r"(?:unauthori[sz]ed (?:copying|use|reproduction|distribution)[^.]{0,80} is strictly prohibited)"),
    ("proprietary", _NOTICE, "confidential", r"\b(?:proprietary and confidential|confidential and proprietary)\b"),
]

# sentence forms around a license's name {n}; the first has the highest priority
FORMS = [
    ("identifier", 100, "spdx", r"spdx-license-identifier:\s*{n}\b"),
    ("grant", 90, "licen[cs]ed", r"\b(?:is |are |be )?(?:dual[- ])?licen[cs]ed (?:to you )?(?:under|with|by)(?: the terms of)? {n}\b(?: licen[cs]e)?"),
    ("release", 85, "released|distributed|available|published",
     r"\b(?:released|distributed|made available|available|published) under(?: the terms of)? {n}\b(?: licen[cs]e)?"),
    ("terms", 80, "terms", r"\bunder the terms of {n}\b(?: licen[cs]e)?"),
    ("field", 75, "licen[cs]e", r"\blicen[cs]e\s*[:=]\s*[\"']?{n}\b"),
    ("subject", 70, "subject", r"\bsubject to {n}\b(?: licen[cs]e)?"),
    ("named", 60, "licen[cs]e", r"\b{n} licen[cs]e\b"),
    ("copyright", 50, "copyright", r"\bcopyright\b[^.\n]{{0,80}}\b{n} licen[cs]e\b"),
]
# what a form is worth as evidence, per hundred of its priority
SCORE_SCALE = 100.0


@functools.cache
def rules() -> list[tuple[str, int, re.Pattern | str, re.Pattern | str, re.Pattern]]:
    """(label, priority, form's keyword, license's keyword, expression), best first; the
    keyword of a signature is plain text."""
    out = [(label, priority, re.compile(gate), re.compile(keyword), re.compile(form.format(n=f"(?:{name})"), re.ASCII))
           for _, priority, gate, form in FORMS for label, keyword, name in LICENSES]
    out += [(label, priority, keyword, keyword, re.compile(expression, re.ASCII)) for label, priority, keyword, expression in SIGNATURES]
    return sorted(out, key=lambda r: -r[1])


# white space with the comment marks that lead the next lines
_GAP = re.compile(r"(?:\s*\n\s*(?:#+|//+!?|/\*+!?|\*+/?|;+|--+|%+|!+|>+|(?:rem|dnl)\b)?)+\s*|\s+")


def one_line(lower: str) -> tuple[str, list[int], list[int]]:
    """The text with each gap as one blank; places in it after a gap of another
    length, and what to add from there on to get the place in the text."""
    parts, at, add, last, shift = [], [], [], 0, 0
    for m in _GAP.finditer(lower):
        if m[0] != " ":
            parts += [lower[last:m.start()], " "]
            last = m.end()
            shift += last - m.start() - 1
            at.append(last - shift)
            add.append(shift)
    return "".join([*parts, lower[last:]]), at, add


def detections(text: str) -> list[tuple[str, int, int, int]]:
    """(label, priority, start, end) that survive, in order of the text (in lower
    case); the rules see wrapped and commented lines as one."""
    lower, at, add = one_line(text)

    def place(x: int) -> int:
        i = bisect.bisect_right(at, x)
        return x + add[i - 1] if i else x

    found = []
    gates: dict[re.Pattern | str, bool] = {}

    def open_(keyword: re.Pattern | str) -> bool:
        if keyword not in gates:
            gates[keyword] = keyword in lower if isinstance(keyword, str) else keyword.search(lower) is not None
        return gates[keyword]

    for label, priority, gate, keyword, expression in rules():
        if open_(gate) and open_(keyword):
            found += [(label, priority, place(m.start()), place(m.end() - 1) + 1) for m in expression.finditer(lower)]
    # a sweep by start: whatever contains a detection comes before it, so the
    # furthest end of each priority so far tells whether one does
    reach = dict.fromkeys((rule[1] for rule in rules()), -1)
    kept = []
    for d in sorted(set(found), key=lambda d: (d[2], -d[3], -d[1], d[0])):
        if all(end < d[3] for priority, end in reach.items() if priority >= d[1]):
            kept.append(d)
        reach[d[1]] = max(reach[d[1]], d[3])
    return kept


_PHRASES = [(p.encode().split(), label) for p, label in BASE.items()]
# a text without any of these has no detection (base phrases are looked for in every text)
_MAY = "(?i:" + "|".join(["licen", "spdx", "copyright", "terms", "subject", "released", "distributed", "available", "published"]
                         + [r"[^0-9A-Za-z]+".join(map(re.escape, k.split())) for k in sorted({k for _, _, k, _ in SIGNATURES})]) + ")"


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a base phrase stands."""
    out = []
    for phrase, label in _PHRASES:
        at = -1
        try:
            while True:
                at = words.index(phrase[0], at + 1)
                if words[at:at + len(phrase)] == phrase:
                    out.append((at, label))
        except ValueError:
            pass
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    detections): ``score`` is 1 - product of (1 - priority / 100 of the surviving
    detections, at most 0.95 each), base places counting as grants."""
    prepare(docs.sparkSession)
    base = texts(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            column = b.column(1)
            may = pc.match_substring_regex(column, _MAY).to_pylist()
            rows = []
            for i, text in enumerate(column.to_pylist()):
                data = text.encode()
                normal = data.translate(WORD_BYTES)
                words = normal.split()
                places, found = base_places(words), []
                if may[i]:
                    found = detections(data.translate(ASCII_LOWER).decode())
                own = {label for _, label in places}
                doubt = 1.0
                for p in [*(d[1] for d in found), *[90] * len(places)]:
                    doubt *= 1 - min(0.95, p / SCORE_SCALE)
                first = [at for at, _ in places]
                rows.append((len(words), len(places), min(first, default=None), max(first, default=None),
                             ",".join(sorted(own)), ",".join(sorted(own | {d[0] for d in found})), 1 - doubt,
                             [{"label": d[0], "priority": d[1], "start": d[2], "end": d[3]} for d in found]))
            cols = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _FOUND]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], _NAMES)

    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
                                "base_labels string, labels string, score double, "
                                "detections array<struct<label:string,priority:bigint,start:bigint,end:bigint>>")


_FOUND = pa.list_(pa.struct([("label", pa.string()), ("priority", pa.int64()), ("start", pa.int64()),
                             ("end", pa.int64())]))
_NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
