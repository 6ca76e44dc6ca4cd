"""Signature rules of operator 13: regexes over lower-case words parted by one space.

A rule is a regex that begins with one of its keywords. ``rules`` puts each license's names
and SPDX word forms through the forms in which a text states a license, and adds the
signatures that need no form: addresses and sentences of license texts.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

# Label, SPDX identifier as words, names. "license" stands for both spellings.
LICENSES = [
    ("mit", "mit", ["mit license", "expat license"]),
    ("mit-0", "mit 0", ["mit no attribution(?: license)?", "mit 0 license"]),
    ("apache-1-1", "apache 1 1", ["apache (?:software )?license (?:version |v )?1 1"]),
    ("apache-2", "apache 2 0", ["apache (?:software )?license (?:version |v )?2(?: 0)?", "apache 2(?: 0)? license", "asl (?:version |v )?2(?: 0)?"]),
    ("bsd-2-clause", "bsd 2 clause", ["two clause bsd(?: license)?", "bsd 2 clause license", "simplified bsd license", "freebsd license"]),
    ("bsd-3-clause", "bsd 3 clause", ["three clause bsd(?: license)?", "bsd 3 clause license", "new bsd license", "modified bsd license"]),
    ("bsd-4-clause", "bsd 4 clause", ["four clause bsd(?: license)?", "original bsd license", "old bsd license"]),
    ("0bsd", "0bsd", ["zero clause bsd(?: license)?", "bsd zero clause(?: license)?"]),
    ("gpl-1", "gpl 1 0(?: only| or later)?", ["gnu (?:general public license|gpl) (?:version |v )?1(?: 0)?", "gpl (?:version |v )?1(?: 0)?", "gplv1"]),
    ("gpl-2", "gpl 2 0(?: only| or later)?", ["gnu (?:general public license|gpl) (?:as published by the free software foundation )?(?:either )?(?:version |v )?2(?: 0)?", "gpl (?:version |v )?2(?: 0)?", "gplv2"]),
    ("gpl-3", "gpl 3 0(?: only| or later)?", ["gnu (?:general public license|gpl) (?:as published by the free software foundation )?(?:either )?(?:version |v )?3(?: 0)?", "gpl (?:version |v )?3(?: 0)?", "gplv3"]),
    ("lgpl-2", "lgpl 2 0(?: only| or later)?", ["gnu library general public license(?: (?:version |v )?2(?: 0)?)?", "lgpl (?:version |v )?2 0", "lgplv2"]),
    ("lgpl-2-1", "lgpl 2 1(?: only| or later)?", ["gnu lesser general public license (?:version |v )?2 1", "lgpl (?:version |v )?2 1"]),
    ("lgpl-3", "lgpl 3 0(?: only| or later)?", ["gnu lesser general public license (?:version |v )?3(?: 0)?", "lgpl (?:version |v )?3(?: 0)?", "lgplv3"]),
    ("agpl-3", "agpl 3 0(?: only| or later)?", ["gnu affero general public license(?: (?:version |v )?3(?: 0)?)?", "affero general public license(?: (?:version |v )?3(?: 0)?)?", "agpl (?:version |v )?3(?: 0)?", "agplv3"]),
    ("gfdl", "gfdl 1 [123](?: only| or later)?", ["gnu free documentation license(?: (?:version |v )?1 [123])?", "gfdl (?:version |v )?1 [123]"]),
    ("mpl-1-1", "mpl 1 1", ["mozilla public license (?:version |v )?1 1", "mpl (?:version |v )?1 1"]),
    ("mpl-2", "mpl 2 0", ["mozilla public license (?:version |v )?2(?: 0)?", "mpl (?:version |v )?2(?: 0)?"]),
    ("epl-1", "epl 1 0", ["eclipse public license (?:version |v )?1(?: 0)?", "epl (?:version |v )?1 0"]),
    ("epl-2", "epl 2 0", ["eclipse public license (?:version |v )?2(?: 0)?", "epl (?:version |v )?2 0"]),
    ("cpl-1", "cpl 1 0", ["common public license(?: (?:version |v )?1 0)?"]),
    ("cddl-1", "cddl 1 [01]", ["common development and distribution license(?: (?:version |v )?1 [01])?", "cddl (?:version |v )?1 [01]"]),
    ("eupl-1-1", "eupl 1 1", ["european union public license (?:version |v )?1 1", "eupl (?:version |v )?1 1"]),
    ("eupl-1-2", "eupl 1 2", ["european union public license (?:version |v )?1 2", "eupl (?:version |v )?1 2"]),
    ("cc-by", "cc by [1-4] [05]", ["creative commons attribution(?: [1-4] [05])?(?: international| unported)?(?: license)?", "cc by [1-4] [05](?: license)?", "cc by license"]),
    ("cc-by-sa", "cc by sa [1-4] [05]", ["creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)?(?: license)?", "cc by sa(?: [1-4] [05])?"]),
    ("cc-by-nd", "cc by nd [1-4] [05]", ["creative commons attribution no ?deriv(?:s|atives)(?: [1-4] [05])?(?: international| unported)?(?: license)?", "cc by nd(?: [1-4] [05])?"]),
    ("cc-by-nc", "cc by nc [1-4] [05]", ["creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)?(?: license)?", "cc by nc(?: [1-4] [05])?"]),
    ("cc-by-nc-sa", "cc by nc sa [1-4] [05]", ["creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported)?(?: license)?", "cc by nc sa(?: [1-4] [05])?"]),
    ("cc-by-nc-nd", "cc by nc nd [1-4] [05]", ["creative commons attribution non ?commercial no ?deriv(?:s|atives)(?: [1-4] [05])?(?: international| unported)?(?: license)?", "cc by nc nd(?: [1-4] [05])?"]),
    ("cc0", "cc0 1 0", ["creative commons (?:zero|cc0)(?: 1 0)?(?: universal)?(?: license)?", "cc0(?: 1 0)?(?: universal)?"]),
    ("unlicense", "unlicense", ["unlicense"]),
    ("wtfpl", "wtfpl", ["wtfpl(?: version 2)?", "fuck you want to public license"]),
    ("isc", "isc", ["isc license"]),
    ("zlib", "zlib", ["zlib license", "zlib libpng license"]),
    ("libpng", "libpng(?: 2 0)?", ["libpng license", "png reference library license"]),
    ("boost-1", "bsl 1 0", ["boost software license(?: (?:version |v )?1 0)?", "boost license"]),
    ("artistic-1", "artistic 1 0", ["artistic license (?:version |v )?1(?: 0)?"]),
    ("artistic-2", "artistic 2 0", ["artistic license (?:version |v )?2(?: 0)?"]),
    ("ofl-1-1", "ofl 1 1", ["sil open font license(?: (?:version |v )?1 1)?", "open font license(?: (?:version |v )?1 1)?"]),
    ("ncsa", "ncsa", ["ncsa open source license", "university of illinois ncsa open source license"]),
    ("postgresql", "postgresql", ["postgresql license"]),
    ("python-2", "python 2 0(?: 1)?", ["python software foundation license(?: (?:version |v )?2)?", "psf license"]),
    ("php-3", "php 3 0(?: ?1)?", ["php license(?: (?:version |v )?3(?: 0)?(?: ?1)?)?"]),
    ("ruby", "ruby", ["ruby license"]),
    ("openssl", "openssl", ["openssl license"]),
    ("w3c", "w3c", ["w3c software (?:notice and )?license", "w3c document license"]),
    ("x11", "x11", ["x11 license", "consortium license"]),
    ("curl", "curl", ["curl license"]),
    ("icu", "icu", ["icu license"]),
    ("unicode", "unicode (?:dfs 201[56]|3 0)", ["unicode license(?: (?:agreement|v3))?"]),
    ("ms-pl", "ms pl", ["microsoft public license"]),
    ("ms-rl", "ms rl", ["microsoft reciprocal license"]),
    ("afl-3", "afl 3 0", ["academic free license(?: (?:version |v )?3 0)?"]),
    ("osl-3", "osl 3 0", ["open software license(?: (?:version |v )?3 0)?"]),
    ("ecl-2", "ecl 2 0", ["educational community license(?: (?:version |v )?2 0)?"]),
    ("upl-1", "upl 1 0", ["universal permissive license(?: (?:version |v )?1 0)?"]),
    ("blueoak-1", "blueoak 1 0 0", ["blue oak model license(?: 1 0 0)?"]),
    ("mulan-2", "mulanpsl 2 0", ["mulan psl (?:version |v )?2", "mulan permissive software license (?:version |v )?2"]),
    ("business-source-1-1", "busl 1 1", ["business source license(?: (?:version |v )?1 1)?"]),
    ("sspl-1", "sspl 1 0", ["server side public license(?: (?:version |v )?1)?"]),
    ("elastic-2", "elastic 2 0", ["elastic license (?:version |v )?2(?: 0)?"]),
    ("polyform-noncommercial", "polyform noncommercial 1 0 0", ["polyform noncommercial license(?: 1 0 0)?"]),
    ("commons-clause", "commons clause", ["commons clause(?: license condition)?(?: (?:version |v )?1 0)?"]),
    ("json", "json", ["json license"]),
    ("beerware", "beerware", ["beerware license", "beer ware license"]),
    ("hippocratic", "hippocratic 2 1", ["hippocratic license(?: (?:version |v )?[123](?: [01])?)?"]),
    ("openrail", "openrail(?: m)?", ["open rail(?: m)? license", "openrail(?: m)? license", "creativeml open ?rail m", "bigscience open ?rail m"]),
    ("llama-community", "llama [23](?: [123])?", ["llama [23](?: [123])? community license(?: agreement)?"]),
    ("gemma", "gemma", ["gemma terms of use", "gemma license"]),
    ("odbl-1", "odbl 1 0", ["open (?:data commons open )?database license(?: (?:version |v )?1 0)?"]),
    ("odc-by-1", "odc by 1 0", ["open data commons attribution license(?: (?:version |v )?1 0)?"]),
    ("pddl-1", "pddl 1 0", ["public domain dedication and license", "open data commons public domain dedication and license"]),
    ("cdla-permissive", "cdla permissive [12] 0", ["community data license agreement permissive(?: (?:version |v )?[12] 0)?"]),
    ("cdla-sharing", "cdla sharing 1 0", ["community data license agreement sharing(?: (?:version |v )?1 0)?"]),
    ("ogl-uk", "ogl uk [123] 0", ["open government license(?: (?:version |v )?[123] 0)?"]),
    ("etalab-2", "etalab 2 0", ["etalab open license(?: (?:version |v )?2 0)?", "licence ouverte(?: open license)?"]),
    ("apsl-2", "apsl 2 0", ["apple public source license(?: (?:version |v )?2 0)?"]),
    ("cecill", "cecill(?: [12] [01])?", ["cecill (?:free software )?license(?: agreement)?"]),
    ("qpl-1", "qpl 1 0", ["qpl (?:version |v )?1 0"]),
    ("sleepycat", "sleepycat", ["sleepycat license"]),
    ("zpl-2", "zpl 2 [01]", ["zope public license(?: (?:version |v )?2 [01])?"]),
    ("vim", "vim", ["vim license"]),
    ("nasa", "nasa 1 3", ["nasa open source agreement(?: (?:version |v )?1 3)?"]),
    ("fal", "fal 1 3", ["free art license(?: (?:version |v )?1 3)?"]),
]
# Addresses and sentences.
URLS = [
    ("mit", "opensource org licenses? mit"), ("apache-2", "apache org licenses license 2 0"), ("apache-2", "opensource org licenses? apache 2 0"),
    ("bsd-2-clause", "opensource org licenses? bsd 2 clause"), ("bsd-3-clause", "opensource org licenses? bsd 3 clause"), ("isc", "opensource org licenses? isc"),
    ("gpl-2", "gnu org licenses (?:old licenses )?gpl 2 0"), ("gpl-3", "gnu org licenses gpl 3 0"), ("gpl", "gnu org licenses gpl"), ("lgpl-3", "gnu org licenses lgpl 3 0"),
    ("lgpl-2-1", "gnu org licenses (?:old licenses )?lgpl 2 1"), ("agpl-3", "gnu org licenses agpl 3 0"), ("mpl-2", "mozilla org (?:en us )?mpl 2 0"), ("epl-2", "eclipse org legal epl (?:2 0|v20)"),
    ("cc-by", "creativecommons org licenses by [1-4] [05]"), ("cc-by-sa", "creativecommons org licenses by sa [1-4] [05]"), ("cc-by-nd", "creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nc", "creativecommons org licenses by nc [1-4] [05]"), ("cc-by-nc-sa", "creativecommons org licenses by nc sa [1-4] [05]"), ("cc-by-nc-nd", "creativecommons org licenses by nc nd [1-4] [05]"),
    ("cc0", "creativecommons org publicdomain zero 1 0"), ("public-domain", "creativecommons org publicdomain mark 1 0"), ("unlicense", "unlicense org"), ("boost-1", "boost org license 1 0"),
    ("ofl-1-1", "scripts sil org ofl"), ("wtfpl", "wtfpl net"), ("odbl-1", "opendatacommons org licenses odbl"), ("odc-by-1", "opendatacommons org licenses by"), ("pddl-1", "opendatacommons org licenses pddl"),
]
SENTENCES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("boost-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("isc", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("ofl-1-1", "permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name of (?:the )?(?:[^ ]+ ){1,8}nor the names of its contributors may be used to endorse or promote products"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl-3", "redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "unencumbered software released into the public domain"),
    ("public-domain", "dedicated to the public domain"), ("public-domain", "released (?:in|into|to) the public domain"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee"),
    ("proprietary", "proprietary and confidential"), ("proprietary", "confidential and proprietary"), ("proprietary", "unauthorized (?:copying|use|reproduction|distribution) (?:of this (?:file|software|document) )?(?:via any medium )?is strictly prohibited"),
    ("proprietary", "reproduction in whole or in part without (?:written )?permission is prohibited"),
    ("all-rights-reserved", "rights reserved"),
]
#: Names that leave the version or variant open.
GENERIC = [
    ("apache", "apache (?:software )?license"), ("bsd", "bsd license"), ("bsd", "bsd style license"), ("gpl", "gnu general public license"), ("gpl", "gnu gpl"), ("gpl", "gpl license"),
    ("lgpl", "gnu lesser general public license"), ("lgpl", "lgpl license"), ("agpl", "agpl license"), ("mpl", "mozilla public license"), ("epl", "eclipse public license"),
    ("cc", "creative commons license"), ("cc", "cc license"), ("eupl", "european union public license"), ("artistic", "artistic license"), ("elastic", "elastic license"),
]
#: Forms: prefix, priority (the lower wins), score.
GRANT = "(?:licensed|sublicensed|relicensed|released|distributed) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
DECLARED = "(?:license|licenses|licensing) (?:is |type |name |info )?(?:the )?"
TAG = "spdx license identifier "
FORMS = {"tag": (1, 1.0), "url": (1, 0.95), "text": (1, 0.95), "grant": (2, 0.9), "declared": (3, 0.8), "name": (4, 0.6), "generic": (5, 0.3)}
WINDOW = 40  # words that a rule can span


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    form: str
    keys: tuple[str, ...]
    needle: str  # stands in every match
    regex: str

    @property
    def priority(self) -> int:
        return FORMS[self.form][0]

    @property
    def score(self) -> float:
        return FORMS[self.form][1]


def first_words(body: str) -> tuple[str, ...]:
    m = re.match(r"\(\?:([a-z0-9|]+)\)(?: |$)|([a-z0-9]+)", body)
    words = (m[1] or m[2]).split("|")
    return tuple(dict.fromkeys(s for w in words for s in (w, w.replace("licens", "licenc"))))


def needle(body: str) -> str:
    """The longest plain word outside of groups; empty if there is none."""
    bare, flat = "", body
    while bare != flat:  # optional groups that hold whole words go, others mark the word they touch
        bare = flat
        flat = re.sub(r"\(\?: [^()]*\)\?|\(\?:[^()]* \)\?", "", bare)
        flat = flat if flat != bare else re.sub(r"\([^()]*\)[?*]?(?:\{[^}]*\})?", "|", bare)
    # nor is a word plain that has two spellings
    words = [w for w in re.sub(r" \?", "?", bare).split(" ") if re.fullmatch("[a-z0-9]+", w) and "licens" not in w]
    return max(words, key=len, default="")


def rules() -> list[Rule]:
    out: list[Rule] = []

    def add(label: str, form: str, body: str, core: str | None = None) -> None:
        regex = "^" + body.replace("licens", "licen[cs]") + " "
        out.append(Rule(len(out), label, form, first_words(body), needle(core or body), regex))

    for label, spdx, names in LICENSES:
        add(label, "tag", TAG + spdx, spdx)
        for name in [*names, spdx]:
            add(label, "grant", GRANT + name, name)
            add(label, "declared", DECLARED + name, name)
        for name in names:
            add(label, "name", name)
    for label, body in GENERIC:
        add(label, "grant", GRANT + body, body)
        add(label, "generic", body)
    for label, body in URLS:
        add(label, "url", body)
    for label, body in SENTENCES:
        add(label, "text", body)
    return out
