"""Signature rules of the license scan, in order of priority.

A rule is a regular expression over a text's words; a space in it stands for one word
boundary. Its keyword is one word that any match contains, so a spelling in one word (agplv3, freebsd)
is a rule of its own; the scan tries a rule only on texts that have the keyword.
"""

from __future__ import annotations

# label, keyword, the license's name, its identifier's words (None: it has none)
NAMES = (
    ("mit", "mit", "mit(?: expat)?", "mit"),
    ("mit-0", "mit", "mit no attribution", "mit 0"),
    ("x11", "x11", "x11", "x11"),
    ("apache-2", "apache", "apache(?: software)?(?: licen[sc]e)?(?: version)? v?2(?: 0)?", "apache 2 0"),
    ("apache-1", "apache", "apache(?: software)?(?: licen[sc]e)?(?: version)? v?1(?: [01])?", "apache 1 [01]"),
    ("gpl-3", "gpl", "(?:gnu )?gpl (?:version )?v?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("gpl-3", "general", "(?:gnu )?general public licen[sc]e(?: version)? v?3(?: 0)?", None),
    ("gpl-3", "gplv3", "(?:gnu )?gplv3(?: 0)?", None),
    ("gpl-3", "gpl3", "(?:gnu )?gpl3(?: 0)?", None),
    ("gpl-3", "gplversion", "(?:gnu )?gplversion v?3(?: 0)?", None),
    ("gpl-2", "gpl", "(?:gnu )?gpl (?:version )?v?2(?: [01])?", "gpl 2 0(?: only| or later)?"),
    ("gpl-2", "general", "(?:gnu )?general public licen[sc]e(?: version)? v?2(?: [01])?", None),
    ("gpl-2", "gplv2", "(?:gnu )?gplv2(?: [01])?", None),
    ("gpl-2", "gpl2", "(?:gnu )?gpl2(?: [01])?", None),
    ("gpl-2", "gplversion", "(?:gnu )?gplversion v?2(?: [01])?", None),
    ("gpl", "general", "gnu general public licen[sc]e", None),
    ("lgpl-3", "lgpl", "(?:gnu )?lgpl (?:version )?v?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("lgpl-3", "lgplv3", "(?:gnu )?lgplv3(?: 0)?", None),
    ("lgpl-3", "lgpl3", "(?:gnu )?lgpl3(?: 0)?", None),
    ("lgpl-3", "lgplversion", "(?:gnu )?lgplversion v?3(?: 0)?", None),
    ("lgpl-3", "lesser", "(?:gnu )?lesser general public licen[sc]e(?: version)? v?3(?: 0)?", None),
    ("lgpl-2", "lgpl", "(?:gnu )?lgpl (?:version )?v?2(?: [01])?", "lgpl 2 [01](?: only| or later)?"),
    ("lgpl-2", "lgplv2", "(?:gnu )?lgplv2(?: [01])?", None),
    ("lgpl-2", "lgpl2", "(?:gnu )?lgpl2(?: [01])?", None),
    ("lgpl-2", "lgplversion", "(?:gnu )?lgplversion v?2(?: [01])?", None),
    ("lgpl-2", "lesser", "(?:gnu )?lesser general public licen[sc]e(?: version)? v?2(?: [01])?", None),
    ("lgpl", "lesser", "gnu lesser general public licen[sc]e", None),
    ("agpl-3", "agpl", "(?:gnu )?agpl (?:version )?v?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("agpl-3", "agplv3", "(?:gnu )?agplv3(?: 0)?", None),
    ("agpl-3", "agpl3", "(?:gnu )?agpl3(?: 0)?", None),
    ("agpl-3", "agplversion", "(?:gnu )?agplversion v?3(?: 0)?", None),
    ("agpl-3", "affero", "(?:gnu )?affero general public licen[sc]e(?: version)? v?3(?: 0)?", None),
    ("agpl", "affero", "gnu affero general public licen[sc]e", None),
    ("gfdl", "documentation", "(?:gnu )?free documentation licen[sc]e(?: version 1(?: [123])?)?", "gfdl 1 [123]"),
    ("bsd-2", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd)", "bsd 2 clause"),
    ("bsd-2", "freebsd", "freebsd", None),
    ("bsd-3", "bsd", "(?:bsd 3 clause|3 clause bsd|(?:new|revised|modified) bsd)", "bsd 3 clause"),
    ("bsd-4", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd 4 clause"),
    ("bsd-0", "bsd", "(?:zero clause bsd|bsd zero clause)", "0bsd"),
    ("bsd", "bsd", "bsd(?: style)?", None),
    ("mpl-2", "mozilla", "mozilla public licen[sc]e(?: version)? v?2(?: 0)?", "mpl 2 0"),
    ("mpl-1", "mozilla", "mozilla public licen[sc]e(?: version)? v?1(?: [01])?", "mpl 1 [01]"),
    ("epl-2", "eclipse", "eclipse public licen[sc]e(?: version)? v?2(?: 0)?", "epl 2 0"),
    ("epl-1", "eclipse", "eclipse public licen[sc]e(?: version)? v?1(?: 0)?", "epl 1 0"),
    ("cddl-1", "distribution", "common development and distribution licen[sc]e(?: version 1(?: [01])?)?", "cddl 1 [01]"),
    ("cpl-1", "common", "common public licen[sc]e(?: version 1(?: 0)?)?", "cpl 1 0"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("boost-1", "boost", "boost software licen[sc]e(?: version 1(?: 0)?)?", "bsl 1 0"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("artistic-2", "artistic", "artistic licen[sc]e(?: version)? 2(?: 0)?", "artistic 2 0"),
    ("artistic-1", "artistic", "artistic licen[sc]e(?: version)? 1(?: 0)?", "artistic 1 0"),
    ("python-2", "python", "python software foundation licen[sc]e(?: version 2)?", "psf 2 0"),
    ("ruby", "ruby", "ruby", "ruby"),
    ("php-3", "php", "php licen[sc]e(?: version)? 3(?: 0[01]?)?", "php 3 0[01]?"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("vim", "vim", "vim", "vim"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?", "ncsa"),
    ("upl-1", "universal", "universal permissive licen[sc]e(?: version 1(?: 0)?)?", "upl 1 0"),
    ("eupl-1", "european", "european union public licen[sc]e(?: version)?(?: v?1(?: [12])?)?", "eupl 1 [12]"),
    ("ms-pl", "microsoft", "microsoft public licen[sc]e", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[sc]e", "ms rl"),
    ("ofl-1", "font", "(?:sil )?open font licen[sc]e(?: version 1(?: 1)?)?", "ofl 1 1"),
    ("afl-3", "academic", "academic free licen[sc]e(?: version)?(?: v?3(?: 0)?)?", "afl 3 0"),
    ("osl-3", "open", "open software licen[sc]e(?: version)?(?: v?3(?: 0)?)?", "osl 3 0"),
    ("cc0-1", "cc0", "(?:creative commons )?cc0(?: 1(?: 0)?)?(?: universal)?", "cc0 1 0"),
    ("cc-by-nc-sa", "nc", "cc by nc sa(?: [1234](?: [05])?)?", "cc by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "nc", "cc by nc nd(?: [1234](?: [05])?)?", "cc by nc nd [1234] [05]"),
    ("cc-by-nc", "nc", "cc by nc(?: [1234](?: [05])?)?", "cc by nc [1234] [05]"),
    ("cc-by-sa", "cc", "cc by sa(?: [1234](?: [05])?)?", "cc by sa [1234] [05]"),
    ("cc-by-nd", "cc", "cc by nd(?: [1234](?: [05])?)?", "cc by nd [1234] [05]"),
    ("cc-by", "cc", "cc by(?: [1234](?: [05])?)?", "cc by [1234] [05]"),
    ("cc-by-nc-sa", "commons", "creative commons attribution non ?commercial share ?alike(?: [1234](?: [05])?)?", None),
    ("cc-by-nc-nd", "commons", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234](?: [05])?)?", None),
    ("cc-by-nc", "commons", "creative commons attribution non ?commercial(?: [1234](?: [05])?)?", None),
    ("cc-by-sa", "commons", "creative commons attribution share ?alike(?: [1234](?: [05])?)?", None),
    ("cc-by-nd", "commons", "creative commons attribution no ?deriv(?:ative)?s(?: [1234](?: [05])?)?", None),
    ("cc-by", "commons", "creative commons attribution(?: [1234](?: [05])?)?", None),
    ("odbl-1", "database", "open (?:data commons open )?database licen[sc]e(?: v?1(?: 0)?)?", "odbl 1 0"),
    ("odc-by-1", "odc", "odc attribution(?: licen[sc]e)?", "odc by 1 0"),
    ("pddl-1", "dedication", "public domain dedication and licen[sc]e", "pddl 1 0"),
    ("sspl-1", "server", "server side public licen[sc]e(?: version 1)?", "sspl 1 0"),
    ("busl-1", "business", "business source licen[sc]e(?: version 1(?: 1)?)?", "busl 1 1"),
    ("elastic-2", "elastic", "elastic licen[sc]e(?: version)?(?: 2(?: 0)?)?", "elastic 2 0"),
    ("openrail", "openrail", "(?:creativeml |bigscience )?openrail(?: m)?", None),
    ("w3c", "w3c", "w3c(?: software)?(?: notice and)?", "w3c"),
    ("json", "json", "json", "json"),
    ("beerware", "beerware", "beerware", "beerware"),
)

GRANT = "(?:licen[sc]ed|(?:re)?distributed|released|published|provided|available|shared|offered|covered)"
TERMS = "(?: the)?(?: terms(?: and conditions)? of)?(?: the| a| an)?"
# how a name is used, by falling weight of evidence; {n}: the name, {i}: the identifier
FORMS = (
    ("identifier", 1.0, "spdx licen[sc]e identifier {i}"),
    ("grant", 0.95, GRANT + " under" + TERMS + " {n}(?: licen[sc]e)?"),
    ("permission", 0.9, "(?:use|subject to|governed by|accordance with|permitted by)" + TERMS + " {n}(?: licen[sc]e)?"),
    ("name", 0.8, "{n} licen[sc]e"),
    ("field", 0.7, "licen[sc]e(?: type| name| is| id)? {n}"),
)

# label, keyword, expression, weight of evidence
NOTICES = (
    ("all-rights-reserved", "reserved", "all rights(?: are)? reserved", 0.9),
    ("public-domain", "domain", "(?:released|placed|dedicated|is) (?:in|into|to) the public domain", 0.9),
    ("public-domain", "domain", "public domain", 0.5),
    ("copyright", "copyright", "copyright(?: c)? (?:19|20)[0-9][0-9]", 0.6),
    ("copyright", "copyright", "copyright(?: c)? holders?", 0.5),
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 1.0),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 1.0),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification", 0.9),
    ("bsd-4", "advertising", "all advertising materials mentioning features or use of this software", 0.9),
    ("apache-2", "apache", "apache org licenses license 2 0", 1.0),
    ("gpl", "redistribute", "free software you can redistribute it and or modify", 0.9),
    ("gpl-3", "gnu", "gnu org licenses gpl 3 0", 1.0),
    ("mpl-2", "mozilla", "mozilla org mpl 2 0", 1.0),
    ("cc0-1", "publicdomain", "creativecommons org publicdomain zero 1 0", 1.0),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licenses by nc sa", 1.0),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nc nd", 1.0),
    ("cc-by-nc", "creativecommons", "creativecommons org licenses by nc", 1.0),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa", 1.0),
    ("cc-by-nd", "creativecommons", "creativecommons org licenses by nd", 1.0),
    ("cc-by", "creativecommons", "creativecommons org licenses by", 1.0),
    ("zlib", "origin", "the origin of this software must not be misrepresented", 0.9),
    ("wtfpl", "fuck", "do what the fuck you want to public license", 1.0),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain", 1.0),
    ("proprietary", "confidential", "(?:proprietary and confidential|confidential and proprietary)", 0.8),
    ("proprietary", "prohibited", "unauthorized (?:copying|use|distribution)(?: [^ ]+){0,8} is strictly prohibited", 0.8),
    ("proprietary", "commercial", "(?:for )?non commercial use only", 0.7),
    ("proprietary", "agreement", "end user licen[sc]e agreement", 0.7),
)

# Phrases of the base labels; they stand whatever the rules find.
BASE_PHRASES = (
    ("mit", ("under", "the", "mit", "license")),
    ("apache-2", ("apache", "license", "version", "2")),
    ("cc-by-nc", ("cc", "by", "nc")),
)
BASE_WEIGHT = 0.95


def rules() -> list[dict]:
    """All rules by priority: keyword k, expression p over ' w ' words, label l, order o, weight c."""
    found = []
    for _, weight, form in FORMS:
        for label, keyword, name, identifier in NAMES:
            if "{i}" not in form:
                found.append((label, keyword, form.format(n=name), weight))
            elif identifier:
                found.append((label, "spdx", form.format(i=identifier), weight))
    found += [(label, keyword, text, weight) for label, keyword, text, weight in NOTICES]
    # Words stand as ' w ', so the gap between two of them is two spaces; an optional gap
    # (' ?') joins two words or splits one.
    return [
        {"k": f" {k} ", "p": " (?:" + p.replace(" ?", "(?:\0)?").replace("[^ ]", "[^\1]").replace(" ", "  ").replace("\0", "  ").replace("\1", " ") + ") ", "l": label, "o": o, "c": c}
        for o, (label, k, p, c) in enumerate(found)
    ]


# Every keyword is one of these or holds one; a text without any is not scanned further.
def gate_words() -> list[str]:
    return sorted({r["k"].strip() for r in rules()} | {p[0] for _, p in BASE_PHRASES})
