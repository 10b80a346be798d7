"""The ordered signature rules of the license scan.

A rule is a regex over a text's lower-case words, single blanks between them and
around them all. Rules are made family by family: what its names look like, in
which versions it exists, and which sentences only it has, in the forms in which
licenses are stated.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Names, in natural order: (label, name, versions).
FAMILIES = [
    ("mit", r"mit(?: x11)?", ()),
    ("mit-0", r"mit (?:no attribution|0)", ()),
    ("apache", r"apache(?: software)?", ("1 0", "1 1", "2 0")),
    ("bsd-0-clause", r"(?:0|zero) clause bsd", ()),
    ("bsd-1-clause", r"bsd (?:1|one) clause", ()),
    ("bsd-2-clause", r"(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)", ()),
    ("bsd-3-clause", r"(?:bsd (?:3|three) clause|(?:3|three) clause bsd|new bsd|modified bsd|revised bsd)", ()),
    ("bsd-4-clause", r"(?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd)", ()),
    ("bsd", r"bsd", ()),
    ("gpl", r"(?:gnu gpl|gpl|gnu general public|general public)", ("1", "2", "3", "1 0", "2 0", "3 0")),
    ("lgpl", r"(?:gnu lgpl|lgpl|gnu lesser general public|lesser general public|gnu library general public)", ("2", "3", "2 0", "2 1", "3 0")),
    ("agpl", r"(?:gnu agpl|agpl|gnu affero general public|affero general public)", ("1", "3", "1 0", "3 0")),
    ("gfdl", r"(?:gfdl|gnu free documentation)", ("1 1", "1 2", "1 3")),
    ("mpl", r"(?:mpl|mozilla public)", ("1 0", "1 1", "2 0")),
    ("epl", r"(?:epl|eclipse public)", ("1 0", "2 0")),
    ("cpl", r"(?:cpl|common public)", ("0 5", "1 0")),
    ("cddl", r"(?:cddl|common development and distribution)", ("1 0", "1 1")),
    ("eupl", r"(?:eupl|european union public)", ("1 0", "1 1", "1 2")),
    ("cecill", r"cecill", ("1 0", "1 1", "2 0", "2 1")),
    ("artistic", r"artistic", ("1 0", "2 0")),
    ("isc", r"(?:isc|internet systems consortium)", ()),
    ("zlib", r"zlib(?: libpng)?", ()),
    ("libpng", r"libpng", ("2 0",)),
    ("bsl", r"boost(?: software)?", ("1 0",)),
    ("busl", r"business source", ("1 1",)),
    ("unlicense", r"unlicense", ()),
    ("wtfpl", r"(?:wtfpl|do what the fuck you want to public)", ("1", "2")),
    ("cc0", r"cc ?0", ("1 0",)),
    ("cc-by", r"cc by", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", r"cc by sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", r"cc by nc", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", r"cc by nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", r"cc by nc sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", r"cc by nc nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("odbl", r"(?:odbl|odc open database|open database)", ("1 0",)),
    ("odc-by", r"(?:odc by|open data commons attribution)", ("1 0",)),
    ("pddl", r"(?:pddl|open data commons public domain dedication)", ("1 0",)),
    ("ofl", r"(?:ofl|sil ofl|sil open font|open font)", ("1 0", "1 1")),
    ("ms-pl", r"(?:ms pl|microsoft public)", ()),
    ("ms-rl", r"(?:ms rl|microsoft reciprocal)", ()),
    ("osl", r"(?:osl|open software)", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", r"(?:afl|academic free)", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("postgresql", r"postgresql", ()),
    ("psf", r"(?:psf|python software foundation)", ("2", "2 0")),
    ("php", r"php", ("3 0", "3 01")),
    ("ruby", r"ruby", ()),
    ("openssl", r"openssl", ()),
    ("x11", r"x11", ()),
    ("ncsa", r"(?:ncsa|university of illinois ncsa open source)", ()),
    ("sspl", r"(?:sspl|server side public)", ("1", "1 0")),
    ("elastic", r"elastic", ("1 0", "2 0")),
    ("upl", r"(?:upl|universal permissive)", ("1 0",)),
    ("vim", r"vim", ()),
    ("beerware", r"beer ?ware", ()),
]

#: Sentences, in natural order: (label, keyword, pattern).
SENTENCES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification"),
    ("gpl", "free software", r"is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "free software", r"is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "free software", r"is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("apache-2.0", "apache", r"apache org licenses license 2 0"),
    ("mpl-2.0", "mozilla", r"subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    ("zlib", "express or implied", r"this software is provided as is without any express or implied warranty in no event"),
    ("cc0", "creative", r"creative commons (?:zero|cc ?0)(?: universal)?"),
    ("cc-by-nc-nd", "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s"),
    ("cc-by-nc-sa", "creative", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", "creative", r"creative commons attribution non ?commercial"),
    ("cc-by-nd", "creative", r"creative commons attribution no ?deriv(?:ative)?s"),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike"),
    ("cc-by", "creative", r"creative commons attribution"),
    ("public-domain", "public domain", r"(?:in|into|to) the public domain"),
    ("proprietary", "proprietary", r"(?:confidential and proprietary|proprietary and confidential)"),
    ("reserved", "rights reserved", r"(?:all|some) rights reserved"),
    ("epl", "accompanying program", r"the accompanying program is provided under the terms of this eclipse public license"),
    ("epl", "accompanying materials", r"the accompanying materials are made available under the terms of the eclipse public license"),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("ofl-1.1", "font software", r"this font software is licensed under the sil open font license version 1 1"),
    ("cddl", "common development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("artistic-1.0", "a package may be copied", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2.0", "free software package", r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("bsl-1.0", "permission is hereby granted", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("busl-1.1", "non production use", r"the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("wtfpl", "what the fuck", r"you just do what the fuck you want to"),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}"),
    ("license-mention", "ed under", r"(?:licensed|released|distributed) under"),
]

#: The rules "released under the terms of the <name>", with or without a version, run
#: where the words before the name and some family's name are there; ``UNDER`` is
#: their keyword, which no line contains. A line without any of the hints has none.
UNDER = "<under>"
UNDER_HINTS = ["ed under ", "available under ", "ed by ", "available by "]
UNDER_WORDS = r"(?:licensed|released|distributed|available|published|provided|covered) (?:under|by)(?: the)?(?: terms of)?(?: the)?"
UNDER_NAMES = rf"(?<= ){UNDER_WORDS} (?:{'|'.join(name for _, name, _ in FAMILIES)})(?= )"

#: A text without any of these and without ``UNDER_NAMES`` has no detection.
GATES = ["released under", "distributed under", "a package may be copied", "what the fuck", "licen", "copyright", "right", "public", "spdx", "gpl", "cc by", "creative", "proprietary", "permission", "redistribut", "apache org", "unencumbered", "express or implied"]
CONFIDENCE = [1.0, 0.95, 0.9, 0.8, 0.6, 0.3]


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int


def rules() -> list[Rule]:
    """All rules in order; among equal intervals the first one wins."""
    found = []

    def add(label: str, keyword: str, pattern: str, priority: int) -> None:
        found.append(Rule(label, keyword, f"(?<= )(?:{pattern})(?= )", priority))

    sentences = [(*s, 5 if s[0] in ("license-mention", "copyright") else 1) for s in SENTENCES]
    for label, name, versions in FAMILIES:
        for v in sorted(versions, key=len, reverse=True):
            full = f"{label}-{v.replace(' ', '.')}"
            number = rf"v?{v}"
            add(full, "spdx", rf"spdx license identifier {name}(?: v)? {number}(?: only| or later)?", 0)
            add(full, UNDER, rf"{UNDER_WORDS} {name}(?: licen[cs]e)?(?: version| v)? {number}", 2)
            add(full, "licen", rf"{name}(?: licen[cs]e)(?: version| v)? {number}|{name}(?: version| v)? {number} licen[cs]e", 3)
        add(label, "spdx", rf"spdx license identifier {name}", 0)
        add(label, UNDER, rf"{UNDER_WORDS} {name}(?: licen[cs]e)?", 3)
        add(label, "licen", rf"{name} (?:public )?licen[cs]e", 4)
    for label, keyword, pattern, priority in sentences:
        add(label, keyword, pattern, priority)
    return found
