"""License scans: ordered signature rules behind a keyword gate, overlaps resolved by priority and containment.

The gate and each rule's own keywords follow from the rules: they save work and never decide.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from syncloom.llm.rows import per_text
from syncloom.llm.textops import ALNUM, LOWER, chunks, word_spans

#: The base phrases and their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Names of licences as (label, regex over words joined by one space, words one of which stands in every match, weight).
#: Special names come before general ones.
FAMILIES: tuple[tuple[str, str, tuple[str, ...], float], ...] = (
    ("agpl-3", r"(?:gnu )?(?:affero general public licen[sc]e|agpl)(?: ?v(?:ersion)?)? ?3(?: 0)?", ("affero", "agpl"), 0.95),
    ("agpl", r"(?:gnu )?(?:affero (?:general public licen[sc]e|gpl)|agpl)", ("affero", "agpl"), 0.8),
    ("lgpl-2.1", r"(?:gnu )?(?:lesser general public licen[sc]e|lgpl)(?: ?v(?:ersion)?)? ?2 1", ("lesser", "lgpl"), 0.95),
    ("lgpl-3", r"(?:gnu )?(?:lesser general public licen[sc]e|lgpl)(?: ?v(?:ersion)?)? ?3(?: 0)?", ("lesser", "lgpl"), 0.95),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[sc]e|(?:gnu )?lgpl|(?:gnu )?lesser gpl", ("lesser", "library", "lgpl"), 0.8),
    ("gpl-2", r"(?:gnu )?(?:general public licen[sc]e|gpl)(?: ?v(?:ersion)?)? ?2(?: 0)?", ("general", "gpl"), 0.95),
    ("gpl-3", r"(?:gnu )?(?:general public licen[sc]e|gpl)(?: ?v(?:ersion)?)? ?3(?: 0)?", ("general", "gpl"), 0.95),
    ("gpl", r"(?:gnu )?(?:general public licen[sc]e|gpl)", ("general", "gpl"), 0.8),
    ("gfdl", r"gnu free documentation licen[sc]e|gfdl", ("documentation", "gfdl"), 0.9),
    ("apache-2", r"apache(?: software)? (?:license )?(?:v(?:ersion)? ?)?2(?: 0)?", ("apache",), 0.95),
    ("apache-1.1", r"apache(?: software)? (?:license )?(?:v(?:ersion)? ?)?1 1", ("apache",), 0.9),
    ("apache", r"apache(?: software)? licen[sc]e", ("apache",), 0.7),
    ("mit", r"(?:mit|expat|x11)(?: x11| expat)? licen[sc]e", ("mit", "expat", "x11"), 0.9),
    ("mit-0", r"mit (?:no attribution|0) licen[sc]e", ("mit",), 0.9),
    ("bsd-2-clause", r"(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?", ("bsd", "freebsd"), 0.9),
    ("bsd-3-clause", r"(?:bsd (?:3|three) clause|(?:3|three) clause bsd|(?:new|modified|revised) bsd)(?: licen[sc]e)?", ("bsd", "freebsd"), 0.9),
    ("bsd-4-clause", r"(?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd)(?: licen[sc]e)?", ("bsd", "freebsd"), 0.9),
    ("bsd", r"bsd(?: style)? licen[sc]e", ("bsd", "freebsd"), 0.7),
    ("isc", r"isc licen[sc]e", ("isc",), 0.9),
    ("mpl-1.1", r"(?:mozilla public licen[sc]e|mpl)(?: ?v(?:ersion)?)? ?1 1", ("mozilla", "mpl"), 0.95),
    ("mpl-2", r"(?:mozilla public licen[sc]e|mpl)(?: ?v(?:ersion)?)? ?2(?: 0)?", ("mozilla", "mpl"), 0.95),
    ("epl-1", r"(?:eclipse public licen[sc]e|epl)(?: ?v(?:ersion)?)? ?1(?: 0)?", ("eclipse", "epl"), 0.9),
    ("epl-2", r"(?:eclipse public licen[sc]e|epl)(?: ?v(?:ersion)?)? ?2(?: 0)?", ("eclipse", "epl"), 0.9),
    ("cddl", r"common development and distribution licen[sc]e|cddl(?: 1 [01])?", ("development", "cddl"), 0.9),
    ("artistic-2", r"artistic licen[sc]e(?: ?v(?:ersion)?)? ?2(?: 0)?", ("artistic",), 0.9),
    ("artistic", r"artistic licen[sc]e", ("artistic",), 0.7),
    ("zlib", r"zlib(?: libpng)? licen[sc]e", ("zlib",), 0.9),
    ("boost", r"boost software licen[sc]e(?: v(?:ersion)? ?1(?: 0)?)?", ("boost",), 0.95),
    ("unlicense", r"the unlicense|unlicense(?: 1 0)?", ("unlicense",), 0.8),
    ("wtfpl", r"wtfpl", ("wtfpl",), 0.9),
    ("ofl", r"(?:sil )?open font licen[sc]e(?: v(?:ersion)? ?1 1)?", ("font",), 0.95),
    ("eupl", r"european union public licen[sc]e|eupl(?: 1 2)?", ("european", "eupl"), 0.9),
    ("osl-3", r"open software licen[sc]e(?: ?v(?:ersion)?)? ?3(?: 0)?", ("open",), 0.9),
    ("ms-pl", r"microsoft public licen[sc]e|ms pl", ("microsoft", "ms"), 0.8),
    ("cc-by-nc-nd", r"(?:creative commons|cc)(?: attribution| by)(?: non ?commercial| nc)(?: no ?deriv(?:ative|ativ)e?s?| nd)", ("creative", "cc"), 0.95),
    ("cc-by-nc-sa", r"(?:creative commons|cc)(?: attribution| by)(?: non ?commercial| nc)(?: share ?alike| sa)", ("creative", "cc"), 0.95),
    ("cc-by-nc", r"(?:creative commons|cc)(?: attribution| by)(?: non ?commercial| nc)", ("creative", "cc"), 0.9),
    ("cc-by-nd", r"(?:creative commons|cc)(?: attribution| by)(?: no ?derivatives?| nd)", ("creative", "cc"), 0.9),
    ("cc-by-sa", r"(?:creative commons|cc)(?: attribution| by)(?: share ?alike| sa)", ("creative", "cc"), 0.9),
    ("cc-by", r"(?:creative commons|cc)(?: attribution| by)(?: [1-4] 0)?", ("creative", "cc"), 0.7),
    ("cc0", r"cc0(?: 1 0)?|cc zero|creative commons zero", ("cc0", "cc", "creative"), 0.9),
    ("public-domain", r"public domain", ("domain",), 0.5),
    ("psf-2.0", r"(?:psf|python software foundation) licen[sc]e(?: agreement)?(?: ?v(?:ersion)?)?(?: ?2(?: 0)?)?", ("psf", "python"), 0.9),
    ("afl-3.0", r"academic free licen[sc]e(?: ?v(?:ersion)?)? ?3(?: 0)?", ("academic",), 0.9),
    ("afl", r"academic free licen[sc]e", ("academic",), 0.8),
    ("cpl-1.0", r"common public licen[sc]e", ("common",), 0.85),
    ("cpal-1.0", r"common public attribution licen[sc]e", ("common",), 0.9),
    ("ipl-1.0", r"ibm public licen[sc]e", ("ibm",), 0.9),
    ("busl-1.1", r"business source licen[sc]e(?: ?v(?:ersion)?)?(?: ?1 1)?", ("business",), 0.9),
    ("sspl-1.0", r"server side public licen[sc]e(?: ?v(?:ersion)?)?(?: ?1)?", ("server",), 0.9),
    ("elastic-2.0", r"elastic licen[sc]e(?: ?v(?:ersion)?)?(?: ?2(?: 0)?)?", ("elastic",), 0.85),
    ("odbl-1.0", r"open database licen[sc]e", ("database",), 0.9),
    ("odc-by-1.0", r"open data commons attribution licen[sc]e", ("commons",), 0.9),
    ("pddl-1.0", r"public domain dedication and licen[sc]e", ("dedication",), 0.9),
    ("upl-1.0", r"universal permissive licen[sc]e", ("universal",), 0.9),
    ("hpnd", r"historical permission notice and disclaimer", ("historical",), 0.9),
    ("npl-1.1", r"netscape public licen[sc]e(?: ?v(?:ersion)?)? ?1 1", ("netscape",), 0.9),
    ("npl", r"netscape public licen[sc]e", ("netscape",), 0.8),
    ("qpl-1.0", r"q public licen[sc]e", ("q",), 0.85),
    ("lppl", r"latex project public licen[sc]e", ("latex",), 0.9),
    ("mulanpsl-2.0", r"mulan (?:psl|permissive software licen[sc]e)(?: ?v(?:ersion)?)? ?2(?: 0)?", ("mulan",), 0.9),
    ("mulanpsl", r"mulan (?:psl|permissive software licen[sc]e)", ("mulan",), 0.8),
    ("apsl-2.0", r"apple public source licen[sc]e(?: ?v(?:ersion)?)? ?2(?: 0)?", ("apple",), 0.9),
    ("apsl", r"apple public source licen[sc]e", ("apple",), 0.8),
    ("cecill", r"cecill(?: [bc])? (?:free software )?licen[sc]e", ("cecill",), 0.9),
    ("ecl-2.0", r"educational community licen[sc]e(?: ?v(?:ersion)?)?(?: ?2(?: 0)?)?", ("educational",), 0.9),
    ("ncsa", r"(?:university of illinois )?ncsa open source licen[sc]e|university of illinois open source licen[sc]e", ("ncsa", "illinois"), 0.9),
    ("rpl-1.5", r"reciprocal public licen[sc]e", ("reciprocal",), 0.9),
    ("ms-rl", r"microsoft reciprocal licen[sc]e|ms rl", ("microsoft", "ms"), 0.85),
    ("cern-ohl", r"cern open hardware licen[sc]e", ("cern",), 0.9),
    ("blueoak-1.0.0", r"blue oak model licen[sc]e", ("oak",), 0.9),
    ("zpl", r"zope public licen[sc]e", ("zope",), 0.9),
    ("sissl", r"sun industry standards source licen[sc]e", ("sun",), 0.9),
    ("beerware", r"beer ?ware licen[sc]e", ("beer", "beerware"), 0.9),
    ("ogl-uk", r"open government licen[sc]e", ("government",), 0.85),
    ("openrail", r"(?:(?:creativeml )?open |bigscience )?rail(?: [sm])? licen[sc]e|(?:creativeml )?openrail(?: [sm])?(?: licen[sc]e)?", ("rail", "openrail"), 0.8),
    ("polyform", r"polyform (?:noncommercial|shield|strict|perimeter|small business|internal use|free trial) licen[sc]e", ("polyform",), 0.9),
    ("proprietary", r"proprietary licen[sc]e|all rights reserved", ("proprietary", "reserved"), 0.5),
)

#: Sentences of licences' headers and bodies, which need not name the licence: (label, regex, words one of which must occur, weight).
SIGNATURES: tuple[tuple[str, str, tuple[str, ...], float], ...] = (
    *(
        (f"{label}-{v}", rf"(?:either )?version {v}(?: 0)?(?: or (?:at your option )?(?:any )?later(?: version)?)? of the (?:gnu )?{name}", ("general", "gpl", "lgpl"), 0.95)
        for label, name in (("agpl", "affero general public licen[sc]e"), ("gpl", "(?:general public licen[sc]e|gpl)"))
        for v in ("2", "3")
        if (label, v) != ("agpl", "2")
    ),
    ("lgpl-2.1", r"version 2 1(?: or (?:at your option )?(?:any )?later(?: version)?)? of the (?:gnu )?(?:lesser general public licen[sc]e|lgpl)", ("general", "gpl", "lgpl"), 0.95),
    ("lgpl-3", r"version 3(?: 0)?(?: or (?:at your option )?(?:any )?later(?: version)?)? of the (?:gnu )?(?:lesser general public licen[sc]e|lgpl)", ("general", "gpl", "lgpl"), 0.95),
    *(
        (f"{label}-{v}", rf"under the terms of the gnu {name} as published by the free software foundation (?:either )?version {v.replace('.', ' ')}", ("foundation",), 1.0)
        for label, name, versions in (("agpl", "affero general public licen[sc]e", ("3",)), ("lgpl", "lesser general public licen[sc]e", ("2.1", "3")), ("gpl", "general public licen[sc]e", ("2", "3")))
        for v in versions
    ),
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("hereby",), 0.95),
    ("mit", r"the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software", ("substantial",), 0.9),
    ("boost", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", ("hereby",), 0.95),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that", ("hereby",), 0.95),
    ("0bsd", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted(?! provided)", ("hereby",), 0.95),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution",), 0.9),
    ("bsd-3-clause", r"neither the names? of (?:[^ ]+ ){1,20}?may be used to endorse or promote products derived from this software", ("endorse",), 0.9),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment", ("advertising",), 0.95),
    ("apache-2", r"terms and conditions for use reproduction and distribution", ("reproduction",), 0.8),
    ("apache-2", r"apache org licenses license 2 0", ("apache",), 0.95),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", ("express",), 0.9),
    ("unlicense", r"this is free and unencumbered software released into the public domain", ("unencumbered",), 0.95),
    ("wtfpl", r"do what the fuck you want to(?: public licen[sc]e)?", ("fuck",), 0.9),
    ("gpl-3", r"the gnu general public licen[sc]e is a free copyleft licen[sc]e", ("copyleft",), 0.9),
    ("artistic", r"the intent of this document is to state the conditions under which a package may be copied", ("intent",), 0.9),
    ("epl", r"the accompanying program is provided under the terms of this eclipse public licen[sc]e", ("eclipse",), 0.9),
    ("cc0", r"to the extent possible under law (?:[^ ]+ ){1,30}?waived all copyright and related", ("waived",), 0.95),
    ("agpl-3", r"the gnu affero general public licen[sc]e is a free copyleft licen[sc]e", ("copyleft",), 0.95),
    ("agpl-3", r"your modified version must prominently offer all users interacting with it remotely through a computer network", ("prominently",), 0.95),
    ("gpl-2", r"you may copy and distribute verbatim copies of the program s source code as you receive it", ("verbatim",), 0.85),
    ("gpl", r"either version [123](?: 0)? of the licen[sc]e or at your option any later version", ("either",), 0.6),
    ("lgpl", r"this library is free software you can redistribute it and or modify it", ("library",), 0.8),
    ("gpl", r"this program is free software you can redistribute it and or modify it", ("program",), 0.8),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e", ("documentation",), 0.95),
    ("mit", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute", ("deal",), 0.9),
    ("mit", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", ("liable",), 0.7),
    ("bsd-2-clause", r"redistributions in binary form must reproduce the above copyright notice", ("redistributions",), 0.6),
    ("bsd", r"redistributions of source code must retain the above copyright notice this list of conditions", ("redistributions",), 0.8),
    ("apache-2", r"you may not use this file except in compliance with the licen[sc]e", ("compliance",), 0.7),
    ("apache-2", r"unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis", ("unless",), 0.85),
    ("apache-1.1", r"the end user documentation included with the redistribution if any must include the following acknowledg(?:e)?ment", ("documentation",), 0.85),
    ("zlib", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software", ("misrepresented",), 0.95),
    ("zlib", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", ("misrepresented",), 0.95),
    ("mpl-2", r"this source code form is subject to the terms of the mozilla public licen[sc]e", ("mozilla",), 0.95),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public licen[sc]e", ("mozilla",), 0.85),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution licen[sc]e", ("development",), 0.95),
    ("epl-1", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e v(?:ersion)? ?1 0", ("eclipse",), 0.95),
    ("epl-2", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e (?:v(?:ersion)? ?)?2 0", ("eclipse",), 0.95),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software", ("anyone",), 0.9),
    ("json", r"the software shall be used for good not evil", ("evil",), 0.95),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", ("hereby",), 0.95),
    ("hpnd", r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted", ("hereby",), 0.9),
    ("psf-2.0", r"this licen[sc]e agreement is between the python software foundation", ("python",), 0.95),
    ("ofl", r"this font software is licen[sc]ed under the sil open font licen[sc]e", ("font",), 0.95),
    ("beerware", r"if we meet some day and you think this stuff is worth it you can buy me a beer", ("beer",), 0.95),
    ("artistic-2", r"everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document but changing it is not allowed preamble this licen[sc]e establishes the terms", ("verbatim",), 0.9),
    ("ncsa", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software", ("hereby",), 0.9),
    ("upl-1.0", r"subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data", ("hereby",), 0.95),
    ("sspl-1.0", r"if you make the functionality of the program or a modified version available to third parties as a service", ("functionality",), 0.9),
    ("busl-1.1", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work", ("licensor",), 0.95),
    ("elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service", ("hosted",), 0.9),
    ("ogl-uk", r"contains public sector information licensed under the open government licen[sc]e", ("government",), 0.9),
    ("eupl", r"licensed under the eupl", ("eupl",), 0.9),
    *((f"cc-{kind.replace(' ', '-')}", rf"creativecommons org licenses {kind}(?: [1-4] [05])?", ("creativecommons",), 0.95) for kind in ("by nc nd", "by nc sa", "by nc", "by nd", "by sa", "by")),
    ("cc0", r"creativecommons org publicdomain zero(?: 1 0)?", ("creativecommons",), 0.95),
    ("proprietary", r"(?:this software|this document|it) is the confidential and proprietary information of", ("confidential",), 0.7),
)

#: SPDX identifiers that say enough by themselves, "-only", "-or-later" and "+" left out. Those that have a label above:
SPDX_LABELS = {
    "AGPL-3.0": "agpl-3", "GPL-2.0": "gpl-2", "GPL-3.0": "gpl-3", "LGPL-2.1": "lgpl-2.1", "LGPL-3.0": "lgpl-3", "Apache-1.1": "apache-1.1", "Apache-2.0": "apache-2",
    "MPL-1.1": "mpl-1.1", "MPL-2.0": "mpl-2", "EPL-1.0": "epl-1", "EPL-2.0": "epl-2", "CDDL-1.0": "cddl", "CDDL-1.1": "cddl", "Artistic-1.0": "artistic",
    "Artistic-2.0": "artistic-2", "BSL-1.0": "boost", "CC0-1.0": "cc0", "EUPL-1.1": "eupl", "EUPL-1.2": "eupl", "GFDL-1.2": "gfdl", "GFDL-1.3": "gfdl",
    "OFL-1.0": "ofl", "OFL-1.1": "ofl", "OSL-3.0": "osl-3",
}
#: The others of that kind; their label is the identifier in lower case.
SPDX_ALONE = """
    0BSD AFL-1.1 AFL-1.2 AFL-2.0 AFL-2.1 AFL-3.0 AGPL-1.0 Apache-1.0 APSL-1.0 APSL-1.1 APSL-1.2 APSL-2.0 BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause
    BUSL-1.1 CATOSL-1.1 CDLA-Permissive-1.0 CDLA-Permissive-2.0 CDLA-Sharing-1.0 CECILL-1.0 CECILL-2.0 CECILL-2.1 CECILL-B CECILL-C CERN-OHL-1.1 CERN-OHL-1.2 CERN-OHL-P-2.0
    CERN-OHL-S-2.0 CERN-OHL-W-2.0 CPAL-1.0 CPL-1.0 CUA-OPL-1.0 ECL-1.0 ECL-2.0 EFL-1.0 EFL-2.0 ErlPL-1.1 GPL-1.0 HPND IPL-1.0 LGPL-2.0 LPL-1.0 LPL-1.02 LPPL-1.0 LPPL-1.1
    LPPL-1.2 LPPL-1.3a LPPL-1.3c MPL-1.0 MulanPSL-1.0 MulanPSL-2.0 NPL-1.0 NPL-1.1 NPOSL-3.0 ODbL-1.0 ODC-By-1.0 OGL-UK-3.0 OLDAP-2.8 OSET-PL-2.1 OSL-1.0 OSL-2.0 OSL-2.1
    PDDL-1.0 PolyForm-Noncommercial-1.0.0 PSF-2.0 QPL-1.0 RPL-1.1 RPL-1.5 RPSL-1.0 RSCPL SISSL SSPL-1.0 UCL-1.0 UPL-1.0 Unicode-DFS-2016 VSL-1.0 YPL-1.1 ZPL-1.1 ZPL-2.0 ZPL-2.1
""".split()
#: Identifiers that are licences only where a notice says so, "License: MIT" being one.
SPDX_HEADED = "MIT-0 MIT-CMU MIT ISC Zlib NCSA X11 BSD PostgreSQL Unlicense Beerware LGPL AGPL GPL".split()
#: Identifiers that are other things' names too; "license" before them may end another sentence.
SPDX_NAMED = "Python-2.0 PHP-3.0 PHP-3.01 Ruby Vim TCL curl Intel JSON NTP IJG FTL ICU Sleepycat W3C Watcom-1.0 Zend-2.0 NASA-1.3 Libpng Xnet".split()

#: What stands before a licence's name in a notice, the surest first: (name, regex, factor of the weight).
NOTICES: tuple[tuple[str, str, float], ...] = (
    ("identifier", r"spdx license identifier", 1.0),
    ("terms", r"(?:under|subject to|according to) the terms (?:and conditions )?of(?: the)?", 1.0),
    ("licensed", r"(?:re|dual |sub)?licen[sc]ed (?:under|as|with|by)(?: an?| the| either)?", 1.0),
    ("released", r"(?:released|distributed|published|available|provided|shared|made available) under(?: an?| the| either)?", 0.95),
    ("governed", r"(?:governed|covered|protected) by(?: an?| the)?", 0.9),
    ("heading", r"licen[sc]es?(?: name| id| type| identifier)?(?: is| are)?(?: the)?", 0.85),
)
MENTION = 0.6
#: No notice is longer (its last blank included).
NOTICE_LENGTH = 64
NOTICE = re.compile("(?<![^ ])(?:" + "|".join(f"(?P<{name}>{body})" for name, body, _ in NOTICES) + ") $")
FACTORS = {name: factor for name, _, factor in NOTICES}
AFTER = re.compile(r" licen[sc]ed?(?![^ ])")


@dataclass(frozen=True)
class Rule:
    """``priority`` is the rule's place in the order; a smaller one wins. ``kind``: a ``signature``, a ``name``, or an identifier that stands
    ``alone``, must be ``headed`` or is a licence only where it is ``named`` as one. ``words``: one of them stands in every match.
    """

    priority: int
    label: str
    kind: str
    body: str
    pattern: re.Pattern[str]
    words: tuple[str, ...]
    weight: float


def identifier_words(name: str) -> str:
    """An SPDX identifier as a regex over words; a last ".0" may be left out, and which later versions are meant is open."""
    words = re.sub("[^0-9a-z]+", " ", name.lower())
    body = f"{words[:-2]}(?: 0)?" if words.endswith(" 0") and name.endswith(".0") else words
    return body + "(?: only| or later)?"


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """Sentences of licences, sure SPDX identifiers (long before short), names (special before general), identifiers that need a notice.

    Notices before a name or identifier make its detection longer and surer; they are no rules.
    """
    given = [(label, "signature", body, words, weight) for label, body, words, weight in SIGNATURES]
    for kind, names in (("alone", [*SPDX_LABELS, *SPDX_ALONE]), ("name", []), ("headed", SPDX_HEADED), ("named", SPDX_NAMED)):
        for name in sorted(names, key=lambda x: -len(x)):
            first = re.split("[^0-9a-z]", name.lower())[0]
            given.append((SPDX_LABELS.get(name, name.lower()), kind, identifier_words(name), (first,), 0.95 if kind == "alone" else 0.9))
        if kind == "name":
            given += [(label, kind, body, words, weight) for label, body, words, weight in FAMILIES]
    return tuple(Rule(k, label, kind, body, re.compile(rf"(?<![^ ])(?:{body})(?![^ ])"), words, weight) for k, (label, kind, body, words, weight) in enumerate(given))


@dataclass(frozen=True)
class Detection:
    """Words ``first`` to ``last`` (included) are a notice of ``label``."""

    first: int
    last: int
    label: str
    priority: int
    weight: float


def suppress(found: list[Detection]) -> list[Detection]:
    """By priority, then length: a detection within the words of one already kept says nothing new and goes.

    A tree of prefix maxima holds, by first word, the furthest last word kept so far: one look per detection.
    """
    firsts = sorted({d.first for d in found})
    furthest, kept = [-1] * (len(firsts) + 1), []
    for d in sorted(found, key=lambda d: (d.priority, d.first - d.last, d.first)):
        place = bisect_right(firsts, d.first)
        k, reach = place, -1
        while k:
            reach = max(reach, furthest[k])
            k &= k - 1
        if reach >= d.last:
            continue
        kept.append(d)
        while place < len(furthest):
            furthest[place] = max(furthest[place], d.last)
            place += place & -place
    return sorted(kept, key=lambda d: (d.first, d.last))


def joined_words(text: str) -> str:
    """The words of a text, lower-cased, with one space between."""
    data = LOWER[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    spaced = np.where(ALNUM[data], data, np.uint8(0x20)).tobytes().decode("utf-8")
    return re.sub(" +", " ", spaced).strip(" ")


class Words:
    """A text's words joined by one space; gives the number of the word at a character."""

    def __init__(self, text: str) -> None:
        self.joined = joined_words(text)
        self.gaps = [m.start() for m in re.finditer(" ", self.joined)]

    def number(self, at: int) -> int:
        return bisect_left(self.gaps, at)


def base_places(words: Words) -> list[tuple[int, str]]:
    """Every place where a base phrase's words stand one after another: its first word's number and its label."""
    out = []
    for phrase, label in BASE_PHRASES.items():
        for m in re.finditer(rf"(?<![^ ])(?={re.escape(phrase)}(?![^ ]))", words.joined):
            out.append((words.number(m.start()), label))
    return sorted(out)


def detections(words: Words) -> list[Detection]:
    """All rules' matches, with the notices before them, after suppression.

    An identifier counts as noticed also behind "or" or "and" after one that is ("MIT OR Zlib").
    """
    text = words.joined
    present = {m.group(1) for m in keywords().finditer(text)}
    matches = []
    for rule in rules():
        if not present.isdisjoint(rule.words):
            matches += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(text)]
    found, noticed = [], set()
    for start, end, rule in sorted(matches, key=lambda m: (m[0], m[2].priority)):
        first, weight, last = start, rule.weight, end
        if rule.kind != "signature":
            notice = NOTICE.search(text, max(0, start - NOTICE_LENGTH), start)
            chained = text.endswith(" or ", 0, start) and start - 4 in noticed or text.endswith(" and ", 0, start) and start - 5 in noticed
            if notice and not (rule.kind == "named" and notice.lastgroup == "heading"):
                first, weight = notice.start(), weight * FACTORS[notice.lastgroup]
            elif after := rule.kind in ("headed", "named") and AFTER.match(text, end):
                last = after.end()
            elif rule.kind in ("headed", "named") and not chained:
                continue
            elif rule.kind == "name":
                weight *= MENTION
            noticed.add(end)
        found.append(Detection(words.number(first), words.number(last - 1), rule.label, rule.priority, weight))
    return suppress(found)


@lru_cache(maxsize=1)
def _keywords() -> str:
    """The rules' keywords, which may have a version glued on; every base phrase begins with or holds one."""
    return "|".join(sorted({w for rule in rules() for w in rule.words}, key=lambda w: (-len(w), w)))


@lru_cache(maxsize=1)
def keywords() -> re.Pattern[str]:
    return re.compile(rf"(?<![^ ])({_keywords()})(?:v(?:ersion)?)?[0-9]*(?![^ ])")


@lru_cache(maxsize=1)
def gate() -> re.Pattern[bytes]:
    """Keywords over lower-cased bytes. A text without any holds no base phrase and no match of any rule; with one, it is looked at rule by rule."""
    return re.compile(rb"(?<![0-9a-z\x80-\xff])(?:" + _keywords().encode() + rb")(?:v(?:ersion)?)?[0-9]*(?![0-9a-z\x80-\xff])")


SCHEMA = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("n_base", T.LongType(), False),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType(), False),
        T.StructField("labels", T.StringType(), False),
        T.StructField("score", T.DoubleType(), False),
        T.StructField(
            "detections",
            T.ArrayType(
                T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("label", T.StringType())])
            ),
            False,
        ),
    ]
)


def scan(text: str) -> tuple[int, int | None, int | None, str, str, float, list[dict]]:
    """What one text says, without its number of words."""
    words = Words(text)
    places = base_places(words)
    found = detections(words)
    base = {label for _, label in places}
    doubt = 0.0 if places else 1.0
    for d in found:
        doubt *= 1 - d.weight
    return (
        len(places),
        places[0][0] if places else None,
        places[-1][0] if places else None,
        ",".join(sorted(base)),
        ",".join(sorted(base | {d.label for d in found})),
        1 - doubt if places or found else 0.0,
        [{"first": d.first, "last": d.last, "label": d.label} for d in found],
    )


def license_scan(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` (the carried columns) and what every whole text says about its licence.

    ``n_words`` counts the words; ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` come from the base
    phrases; ``labels`` and ``detections`` (word spans after suppression) from all rules too; ``score`` is the noisy-or
    of the detections' weights, 1 where a base phrase stands, 0 where nothing is found.

    A null or empty text has no words, no places, empty labels and score 0. Words are counted over bytes; only texts
    that pass the keyword gate are looked at by the rules, whole, however long. Rows are independent: repeated rows,
    ties, empty tables and other columns of any name change nothing.
    """

    def make():  # noqa: ANN202
        pattern = gate()
        keywords()

        def fn(texts: pa.Array) -> list[pa.Array]:
            n = len(texts)
            words = np.zeros(n, np.int64)
            rows: list[tuple] = [(0, None, None, "", "", 0.0, [])] * n
            for first, data, offsets in chunks(texts):
                low = LOWER[data]
                starts, _, owner = word_spans(low, offsets, ALNUM)
                words[first : first + len(offsets) - 1] = np.bincount(owner, minlength=len(offsets) - 1)
                raw = low.tobytes()
                hits = sorted({int(np.searchsorted(offsets, m.start(), "right")) - 1 for m in pattern.finditer(raw)})
                for k in hits:
                    rows[first + k] = scan(raw[offsets[k] : offsets[k + 1]].decode("utf-8", "replace"))
            columns = list(zip(*rows)) if n else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string())]))]
            return [pa.array(words), *[pa.array(c, k) for c, k in zip(columns, kinds)]]

        return fn

    return per_text(docs, make, SCHEMA, text, carry)
