"""Hand-written license signatures: families of names and the wordings that mention them.

A signature is a regular expression over normalized text: lower-case words joined by single spaces. Each rule has a
label, a priority (3 for a whole notice, 2 for a named license, 1 for a bare mention or a generic phrase) and a keyword
that must occur in the text before the expression is tried.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    pattern: str


#: Base phrases that the scan always reports, with their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: label, keyword, wording of the license's name, wording of its version ("" if it has none).
FAMILIES = (
    ("apache-2.0", "apache", r"apache", r"2(?: 0)?"),
    ("apache-1.1", "apache", r"apache(?: software)?", r"1 1"),
    ("apache-1.0", "apache", r"apache(?: software)?", r"1 0"),
    ("mit", "mit", r"mit", r""),
    ("mit-0", "mit", r"mit no attribution", r""),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)", r""),
    ("bsd-3-clause", "bsd", r"(?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd)", r""),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)", r""),
    ("0bsd", "bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)", r""),
    ("gpl-1.0", "gpl", r"gpl", r"v?1(?: 0)?"),
    ("gpl-2.0", "gpl", r"gpl", r"v?2(?: 0)?"),
    ("gpl-3.0", "gpl", r"gpl", r"v?3(?: 0)?"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public", r"v?1(?: 0)?"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public", r"v?2(?: 0)?"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public", r"v?3(?: 0)?"),
    ("lgpl-2.0", "lgpl", r"lgpl", r"v?2 0"),
    ("lgpl-2.1", "lgpl", r"lgpl", r"v?2 1"),
    ("lgpl-3.0", "lgpl", r"lgpl", r"v?3(?: 0)?"),
    ("lgpl-2.0", "general public", r"(?:gnu )?(?:library|lesser) general public", r"v?2 0"),
    ("lgpl-2.1", "general public", r"(?:gnu )?lesser general public", r"v?2 1"),
    ("lgpl-3.0", "general public", r"(?:gnu )?lesser general public", r"v?3(?: 0)?"),
    ("agpl-1.0", "affero", r"(?:gnu )?affero general public", r"v?1(?: 0)?"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public", r"v?3(?: 0)?"),
    ("agpl-3.0", "agpl", r"agpl", r"v?3(?: 0)?"),
    ("gfdl-1.2", "documentation", r"(?:gnu )?free documentation", r"1 2"),
    ("gfdl-1.3", "documentation", r"(?:gnu )?free documentation", r"1 3"),
    ("mpl-1.0", "mozilla", r"mozilla public", r"1 0"),
    ("mpl-1.1", "mozilla", r"mozilla public", r"1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public", r"2(?: 0)?"),
    ("mpl-2.0", "mpl", r"mpl", r"v?2(?: 0)?"),
    ("epl-1.0", "eclipse", r"eclipse public", r"1 0"),
    ("epl-2.0", "eclipse", r"eclipse public", r"2(?: 0)?"),
    ("edl-1.0", "eclipse", r"eclipse distribution", r"1 0"),
    ("eupl-1.1", "european union", r"european union public", r"1 1"),
    ("eupl-1.2", "european union", r"european union public", r"1 2"),
    ("cddl-1.0", "common development", r"common development and distribution", r"1 0"),
    ("cddl-1.1", "common development", r"common development and distribution", r"1 1"),
    ("cpl-1.0", "common public", r"common public", r"1 0"),
    ("cecill-2.1", "cecill", r"cecill", r"2 1"),
    ("cecill-b", "cecill", r"cecill b", r""),
    ("cecill-c", "cecill", r"cecill c", r""),
    ("artistic-1.0", "artistic", r"artistic", r"1 0"),
    ("artistic-2.0", "artistic", r"artistic", r"2(?: 0)?"),
    ("boost-1.0", "boost", r"boost software", r"1 0"),
    ("zlib", "zlib", r"zlib(?: libpng)?", r""),
    ("isc", "isc", r"isc", r""),
    ("unlicense", "unlicense", r"(?:the )?unlicense", r""),
    ("wtfpl", "what the", r"do what the [a-z0-9]+ you want to public", r"2"),
    ("ms-pl", "microsoft", r"microsoft public", r""),
    ("ms-rl", "microsoft", r"microsoft reciprocal", r""),
    ("openssl", "openssl", r"openssl", r""),
    ("python-2.0", "python", r"python software foundation", r"2(?: 0)?"),
    ("python-2.0", "psf", r"psf", r"2(?: 0)?"),
    ("ruby", "ruby", r"ruby", r""),
    ("php-3.01", "php", r"php", r"3 01"),
    ("postgresql", "postgresql", r"postgresql", r""),
    ("ofl-1.1", "open font", r"(?:sil )?open font", r"1 1"),
    ("bsl-1.1", "business source", r"business source", r"1 1"),
    ("sspl-1.0", "server side", r"server side public", r"v?1(?: 0)?"),
    ("elastic-2.0", "elastic", r"elastic", r"2(?: 0)?"),
    ("odbl-1.0", "open database", r"open database", r"v?1 0"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution", r"v?1 0"),
    ("pddl-1.0", "public domain dedication", r"(?:open data commons )?public domain dedication and", r"v?1 0"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", r""),
    ("vim", "vim", r"vim", r""),
    ("w3c", "w3c", r"w3c(?: software(?: notice and)?)?", r""),
    ("x11", "x11", r"x11", r""),
    ("ijg", "jpeg group", r"independent jpeg group", r""),
    ("upl-1.0", "universal permissive", r"universal permissive", r"v?1 0"),
    ("afl-3.0", "academic free", r"academic free", r"v?3 0"),
    ("osl-3.0", "open software", r"open software", r"v?3 0"),
    ("qpl-1.0", "q public", r"q public", r"1 0"),
    ("lppl-1.3", "latex project", r"latex project public", r"1 3c?"),
)

#: Terms of the Creative Commons suite; each is written short (by nc sa) and long (attribution noncommercial sharealike).
CREATIVE = (
    ("cc-by-nc-nd", r"by nc nd", r"attribution non ?commercial no ?deriv(?:ative|ative work)?s?"),
    ("cc-by-nc-sa", r"by nc sa", r"attribution non ?commercial share ?alike"),
    ("cc-by-nc", r"by nc", r"attribution non ?commercial"),
    ("cc-by-nd", r"by nd", r"attribution no ?deriv(?:ative|ative work)?s?"),
    ("cc-by-sa", r"by sa", r"attribution share ?alike"),
    ("cc-by", r"by", r"attribution"),
)

#: Versions of that suite.
CREATIVE_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

#: Whole notices and generic phrases.
NOTICES = (
    Rule("mit", 3, "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    Rule("mit", 3, "substantial portions", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    Rule("isc", 3, "hereby granted", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Rule("bsd", 3, "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    Rule("bsd-3-clause", 3, "endorse or promote", r"neither the name of [a-z0-9 ]{1,80} may be used to endorse or promote products"),
    Rule("bsd-4-clause", 3, "advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    Rule("apache-2.0", 3, "apache", r"licensed under the apache license version 2 0"),
    Rule("apache-2.0", 3, "www apache org", r"https? www apache org licenses license 2 0"),
    Rule("gpl", 3, "free software foundation", r"(?:the gnu )?general public license as published by the free software foundation"),
    Rule("gpl-2.0-or-later", 3, "free software foundation", r"general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version"),
    Rule("gpl-3.0-or-later", 3, "free software foundation", r"general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version"),
    Rule("lgpl", 3, "free software foundation", r"(?:the gnu )?lesser general public license as published by the free software foundation"),
    Rule("agpl", 3, "free software foundation", r"(?:the gnu )?affero general public license as published by the free software foundation"),
    Rule("mpl-2.0", 3, "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    Rule("unlicense", 3, "public domain", r"this is free and unencumbered software released into the public domain"),
    Rule("zlib", 3, "origin of this software", r"the origin of this software must not be misrepresented"),
    Rule("boost-1.0", 3, "boost", r"distributed under the boost software license version 1 0"),
    Rule("gfdl", 3, "documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    Rule("cc0-1.0", 2, "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    Rule("cc0-1.0", 2, "creative commons", r"creative commons (?:zero|cc0)(?: 1 0)?(?: universal)?"),
    Rule("cc-pdm", 2, "public domain mark", r"public domain mark(?: 1 0)?"),
    Rule("gpl", 2, "general public", r"(?:gnu )?general public licen[cs]e"),
    Rule("lgpl", 2, "general public", r"(?:gnu )?(?:lesser|library) general public licen[cs]e"),
    Rule("agpl", 2, "affero", r"(?:gnu )?affero general public licen[cs]e"),
    Rule("gfdl", 2, "documentation", r"(?:gnu )?free documentation licen[cs]e"),
    Rule("apache", 2, "apache", r"apache (?:software )?licen[cs]e"),
    Rule("mpl", 2, "mozilla", r"mozilla public licen[cs]e"),
    Rule("bsd", 2, "bsd", r"bsd (?:style )?licen[cs]e"),
    Rule("creative-commons", 1, "creative commons", r"creative commons(?: licen[cs]e)?"),
    Rule("public-domain", 1, "public domain", r"(?:in|into|to) the public domain"),
    Rule("public-domain", 1, "public domain", r"public domain"),
    Rule("reserved", 2, "rights reserved", r"all rights (?:are )?reserved"),
    Rule("some-rights", 2, "rights reserved", r"some rights reserved"),
    Rule("no-rights", 2, "rights reserved", r"no rights reserved"),
    Rule("copyright", 1, "copyright", r"copyright (?:c )?(?:by )?(?:19|20)[0-9][0-9]"),
    Rule("copyright", 1, "copyright", r"copyright (?:c|by|holder|holders|notice|owner|owners)"),
    Rule("proprietary", 1, "proprietary", r"proprietary and confidential"),
    Rule("proprietary", 1, "permission", r"(?:without|with) (?:the )?(?:prior )?(?:express )?written permission"),
    Rule("no-commercial", 1, "commercial", r"(?:non commercial use only|not for commercial use|for non commercial (?:use|purposes))"),
    Rule("no-commercial", 1, "noncommercial", r"(?:noncommercial use only|for noncommercial (?:use|purposes))"),
    Rule("no-redistribution", 1, "redistribut", r"(?:may|must|do) not (?:be )?redistribut(?:e|ed)"),
    Rule("no-derivatives", 1, "derivative", r"no derivative works"),
    Rule("as-is", 1, "provided as is", r"provided as is(?: without warranty)?"),
    Rule("terms-of-use", 1, "terms of", r"terms of (?:use|service)"),
    Rule("fair-use", 1, "fair use", r"fair use"),
    Rule("spdx", 2, "spdx", r"spdx license identifier(?: [a-z0-9]+){1,4}"),
)


def rules() -> tuple[Rule, ...]:
    """All signatures in order: notices, then each family in its wordings, then the Creative Commons suite."""
    out = list(NOTICES)
    for label, keyword, name, version in FAMILIES:
        if version:
            out += [
                Rule(label, 2, keyword, rf"{name} (?:software )?licen[cs]e,? (?:version |v )?{version}"),
                Rule(label, 2, keyword, rf"{name} (?:version |v )?{version}(?: licen[cs]e)?"),
                Rule(f"{label}-or-later", 3, keyword, rf"{name} (?:licen[cs]e )?(?:version |v )?{version} or (?:any )?later(?: version)?"),
                Rule(f"{label}-or-later", 3, keyword, rf"version {version} of the {name} licen[cs]e or (?:at your option )?any later version"),
            ]
        else:
            out += [
                Rule(label, 2, "licen", rf"{name} (?:style )?licen[cs]e"),
                Rule(label, 3, "licen", rf"(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of the )?{name} licen[cs]e"),
                Rule(label, 2, "licen", rf"licen[cs]e {name}"),
            ]
    for label, short, long in CREATIVE:
        out += [Rule(label, 1, "cc by", rf"cc {short}"), Rule(label, 2, "attribution", rf"(?:creative commons )?{long}(?: \d \d)?(?: international| unported| generic)? licen[cs]e")]
        for v in CREATIVE_VERSIONS:
            out += [
                Rule(f"{label}-{v.replace(' ', '.')}", 2, "cc by", rf"cc {short} {v}"),
                Rule(f"{label}-{v.replace(' ', '.')}", 2, "attribution", rf"(?:creative commons )?{long} {v}(?: international| unported| generic)?(?: licen[cs]e)?"),
                Rule(f"{label}-{v.replace(' ', '.')}", 3, "creativecommons", rf"creativecommons org licenses {short} {v}"),
            ]
    return tuple(out)
