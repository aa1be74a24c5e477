"""Signature rules of licences: hand-written patterns over the words of a text.

A line is ``label | priority | pattern``. Patterns see words in lower case with one blank between
them, so that ``Apache-2.0`` reads ``apache 2 0``. The word in angle brackets is the rule's keyword:
only its places are looked at. Priorities: 4 for identifiers and addresses, 3 for names with their
version, 2 for names, grants and conditions, 1 for loose mentions. Earlier lines win ties.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass

#: Words on each side of a keyword that a pattern may reach; every rule is held to it.
REACH = 16

#: Rules that hold by themselves, suppressed or not.
BASE = """
mit | 2 | mit <license>
apache | 2 | apache <license>
gpl | 2 | general public <license>
"""

RULES = """
mit | 4 | <spdx> license identifier mit
mit-0 | 4 | <spdx> license identifier mit 0
apache-2.0 | 4 | <spdx> license identifier apache 2 0
apache-1.1 | 4 | <spdx> license identifier apache 1 1
gpl-2.0 | 4 | <spdx> license identifier gpl 2 0(?: only| or later)?
gpl-3.0 | 4 | <spdx> license identifier gpl 3 0(?: only| or later)?
gpl-1.0 | 4 | <spdx> license identifier gpl 1 0(?: only| or later)?
lgpl-2.0 | 4 | <spdx> license identifier lgpl 2 0(?: only| or later)?
lgpl-2.1 | 4 | <spdx> license identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 | 4 | <spdx> license identifier lgpl 3 0(?: only| or later)?
agpl-3.0 | 4 | <spdx> license identifier agpl 3 0(?: only| or later)?
bsd-2-clause | 4 | <spdx> license identifier bsd 2 clause(?: patent| views)?
bsd-3-clause | 4 | <spdx> license identifier bsd 3 clause(?: clear| lbnl)?
bsd-4-clause | 4 | <spdx> license identifier bsd 4 clause
0bsd | 4 | <spdx> license identifier 0bsd
isc | 4 | <spdx> license identifier isc
zlib | 4 | <spdx> license identifier zlib
mpl-1.1 | 4 | <spdx> license identifier mpl 1 1
mpl-2.0 | 4 | <spdx> license identifier mpl 2 0(?: no copyleft exception)?
epl-1.0 | 4 | <spdx> license identifier epl 1 0
epl-2.0 | 4 | <spdx> license identifier epl 2 0
cddl-1.0 | 4 | <spdx> license identifier cddl 1 [01]
eupl-1.2 | 4 | <spdx> license identifier eupl 1 [12]
bsl-1.0 | 4 | <spdx> license identifier bsl 1 0
busl-1.1 | 4 | <spdx> license identifier busl 1 1
sspl-1.0 | 4 | <spdx> license identifier sspl 1 0
cc0-1.0 | 4 | <spdx> license identifier cc0 1 0
cc-by | 4 | <spdx> license identifier cc by [1-4] [05]
cc-by-sa | 4 | <spdx> license identifier cc by sa [1-4] [05]
cc-by-nc | 4 | <spdx> license identifier cc by nc [1-4] [05]
cc-by-nd | 4 | <spdx> license identifier cc by nd [1-4] [05]
cc-by-nc-sa | 4 | <spdx> license identifier cc by nc sa [1-4] [05]
cc-by-nc-nd | 4 | <spdx> license identifier cc by nc nd [1-4] [05]
unlicense | 4 | <spdx> license identifier unlicense
wtfpl | 4 | <spdx> license identifier wtfpl
artistic-2.0 | 4 | <spdx> license identifier artistic 2 0
ofl-1.1 | 4 | <spdx> license identifier ofl 1 1
ncsa | 4 | <spdx> license identifier ncsa
postgresql | 4 | <spdx> license identifier postgresql
python-2.0 | 4 | <spdx> license identifier (?:python|psf) 2 0
unicode | 4 | <spdx> license identifier unicode (?:3 0|dfs 201[56])
ms-pl | 4 | <spdx> license identifier ms pl
odbl-1.0 | 4 | <spdx> license identifier odbl 1 0
spdx-other | 2 | <spdx> license identifier [a-z0-9]+
mit | 4 | opensource org <licenses> mit(?: license)?(?: php)?
bsd-2-clause | 4 | opensource org <licenses> bsd(?: license)? 2 clause
bsd-3-clause | 4 | opensource org <licenses> bsd(?: license)? 3 clause
bsd | 3 | opensource org <licenses> bsd(?: license)?(?: php)?
apache-2.0 | 4 | apache org <licenses> license 2 0(?: txt| html)?
apache-1.1 | 4 | apache org <licenses> license 1 1(?: txt)?
apache-2.0 | 4 | opensource org <licenses> apache 2 0
gpl-3.0 | 4 | gnu org <licenses> gpl 3 0(?: en)?(?: html| txt)?
gpl-2.0 | 4 | gnu org <licenses>(?: old licenses)? gpl 2 0(?: en)?(?: html| txt)?
lgpl-3.0 | 4 | gnu org <licenses> lgpl 3 0(?: en)?(?: html| txt)?
lgpl-2.1 | 4 | gnu org <licenses>(?: old licenses)? lgpl 2 1(?: en)?(?: html| txt)?
agpl-3.0 | 4 | gnu org <licenses> agpl 3 0(?: en)?(?: html| txt)?
fdl | 4 | gnu org <licenses> fdl(?: 1 [123])?(?: html| txt)?
gpl | 3 | gnu org <licenses>(?: gpl)?(?: html| txt)?
mpl-2.0 | 4 | mozilla org(?: en us)? <mpl> 2 0
mpl-1.1 | 4 | mozilla org <mpl> mpl 1 1(?: txt| html)?
epl-2.0 | 4 | eclipse org legal <epl>(?: v)? 2 0
epl-2.0 | 4 | eclipse org legal <epl> v20(?: html)?
epl-1.0 | 4 | eclipse org legal <epl> v10(?: html)?
cc-by | 4 | <creativecommons> org licenses by [1-4] [05]
cc-by-sa | 4 | <creativecommons> org licenses by sa [1-4] [05]
cc-by-nc | 4 | <creativecommons> org licenses by nc [1-4] [05]
cc-by-nd | 4 | <creativecommons> org licenses by nd [1-4] [05]
cc-by-nc-sa | 4 | <creativecommons> org licenses by nc sa [1-4] [05]
cc-by-nc-nd | 4 | <creativecommons> org licenses by nc nd [1-4] [05]
cc0-1.0 | 4 | <creativecommons> org publicdomain zero 1 0
public-domain | 4 | <creativecommons> org publicdomain mark 1 0
bsl-1.0 | 4 | boost org <license> 1 0(?: txt)?
unlicense | 4 | <unlicense> org
ofl-1.1 | 4 | scripts sil org <ofl>
wtfpl | 4 | <wtfpl> net
odbl-1.0 | 4 | opendatacommons org <licenses> odbl(?: 1 0)?
odc-by | 4 | opendatacommons org <licenses> by(?: 1 0)?
zlib | 4 | zlib net zlib <license>(?: html)?
apache-2.0 | 3 | (?:licensed )?under the <apache> license(?: version| v)?(?: 2| v2)(?: 0)?
apache-2.0 | 3 | <apache> license(?: version| v)? 2(?: 0)?
apache-2.0 | 3 | <apache> software license(?: version| v)? 2(?: 0)?
apache-2.0 | 3 | <apache> licen[cs]e v2(?: 0)?
apache-2.0 | 3 | <apache> 2 0(?: licen[cs]ed?)?
apache-1.1 | 3 | <apache>(?: software)? license(?: version| v)? 1 1
apache-1.0 | 3 | <apache>(?: software)? license(?: version| v)? 1 0
apache | 2 | <apache> software license
apache | 1 | <apache> licen[cs]ed?
apache-2.0 | 3 | asl <apache> 2 0
gpl-3.0 | 3 | gnu general public <license>(?: as published by the free software foundation)?(?: either)? version 3
gpl-2.0 | 3 | gnu general public <license>(?: as published by the free software foundation)?(?: either)? version 2
gpl-1.0 | 3 | gnu general public <license>(?: as published by the free software foundation)?(?: either)? version 1
gpl-3.0 | 3 | gnu general public <license> v3(?: 0)?(?: or later)?
gpl-2.0 | 3 | gnu general public <license> v2(?: 0)?(?: or later)?
gpl-3.0 | 3 | version 3 of the gnu general public <license>
gpl-2.0 | 3 | version 2 of the gnu general public <license>
gpl-3.0 | 3 | gnu <gpl>(?: version| v)? 3(?: 0)?(?: or later)?
gpl-2.0 | 3 | gnu <gpl>(?: version| v)? 2(?: 0)?(?: or later)?
gpl-3.0 | 3 | gnu <gpl> v3(?: 0)?(?: or later)?
gpl-2.0 | 3 | gnu <gpl> v2(?: 0)?(?: or later)?
gpl-3.0 | 3 | <gplv3>(?: 0)?(?: or later)?
gpl-2.0 | 3 | <gplv2>(?: 0)?(?: or later)?
gpl-3.0 | 3 | <gpl> 3 0(?: only| or later)?
gpl-2.0 | 3 | <gpl> 2 0(?: only| or later)?
gpl-3.0 | 3 | <gpl3>
gpl-2.0 | 3 | <gpl2>
gpl | 2 | gnu general public <licence>
gpl | 2 | general public <licence>
gpl | 2 | gnu general public <license>
gpl | 2 | released under(?: the)? <gpl>
gpl | 2 | licensed under(?: the)? <gpl>
gpl | 1 | gnu <gpl>
gpl | 1 | <gpl>
lgpl-3.0 | 3 | gnu lesser general public <license>(?: as published by the free software foundation)?(?: either)? version 3
lgpl-2.1 | 3 | gnu lesser general public <license>(?: as published by the free software foundation)?(?: either)? version 2 1
lgpl-2.0 | 3 | gnu library general public <license>(?: as published by the free software foundation)?(?: either)? version 2
lgpl-3.0 | 3 | lesser general public <license> v3
lgpl-2.1 | 3 | lesser general public <license> v2 1
lgpl | 2 | (?:gnu )?lesser general public <license>
lgpl | 2 | (?:gnu )?library general public <license>
lgpl | 2 | (?:gnu )?lesser general public <licence>
lgpl-3.0 | 3 | <lgpl>(?: version)? 3(?: 0)?(?: or later)?
lgpl-2.1 | 3 | <lgpl>(?: version)? 2 1(?: or later)?
lgpl-3.0 | 3 | <lgplv3>
lgpl-2.1 | 3 | <lgplv2>(?: 1)?
lgpl | 1 | (?:gnu )?<lgpl>
agpl-3.0 | 3 | (?:gnu )?affero general public <license>(?: as published by the free software foundation)?(?: either)? version 3
agpl-3.0 | 3 | affero general public <license> v3
agpl | 2 | (?:gnu )?affero general public <license>
agpl-3.0 | 3 | <agpl>(?: version)? 3(?: 0)?(?: or later)?
agpl-3.0 | 3 | <agplv3>
agpl | 1 | <agpl>
fdl | 2 | gnu free documentation <license>(?: version 1 [123])?
fdl | 1 | <gfdl>
mit | 2 | (?:released|licensed|distributed) under the mit <license>
mit | 2 | under the terms of the mit <license>
mit | 2 | mit <licence>
mit | 2 | <mit> licen[cs]ed
mit | 2 | <expat> license
x11 | 2 | x11 <license>
mit | 3 | <permission> is hereby granted free of charge to any person obtaining a copy of this software
mit | 2 | to deal in the software without <restriction> including without limitation
mit | 2 | the above copyright notice and this <permission> notice shall be included in all copies
mit-0 | 3 | mit no <attribution>(?: license)?
isc | 3 | <permission> to use copy modify and(?: or)? distribute this software for any purpose
isc | 2 | isc <license>
isc | 1 | <isc> licensed
bsd-3-clause | 3 | (?:the )?(?:bsd )?3 clause bsd <license>
bsd-2-clause | 3 | (?:the )?(?:bsd )?2 clause bsd <license>
bsd-4-clause | 3 | 4 clause bsd <license>
bsd-3-clause | 3 | three clause bsd <license>
bsd-2-clause | 3 | two clause bsd <license>
bsd-3-clause | 3 | <bsd> 3 clause(?: license)?
bsd-2-clause | 3 | <bsd> 2 clause(?: license)?
bsd-4-clause | 3 | <bsd> 4 clause(?: license)?
bsd-3-clause | 3 | new bsd <license>
bsd-3-clause | 3 | (?:modified|revised) bsd <license>
bsd-2-clause | 3 | (?:simplified|freebsd) bsd <license>
bsd-2-clause | 3 | freebsd <license>
bsd-4-clause | 3 | original bsd <license>
bsd | 2 | bsd(?: style)? <license>
bsd | 2 | bsd <licence>
bsd | 2 | <redistribution> and use in source and binary forms with or without modification
bsd | 2 | <redistributions> of source code must retain the above copyright notice
bsd | 2 | <redistributions> in binary form must reproduce the above copyright notice
bsd-3-clause | 3 | may be used to <endorse> or promote products derived from this software
bsd-4-clause | 3 | all <advertising> materials mentioning features or use of this software
0bsd | 2 | zero clause bsd <license>
mpl-2.0 | 3 | <mozilla> public licen[cs]e(?: version| v)? 2(?: 0)?
mpl-1.1 | 3 | <mozilla> public licen[cs]e(?: version| v)? 1 1
mpl-1.0 | 3 | <mozilla> public licen[cs]e(?: version| v)? 1 0
mpl | 2 | <mozilla> public licen[cs]e
mpl-2.0 | 3 | <mpl>(?: version| v)? 2 0
mpl-1.1 | 3 | <mpl>(?: version| v)? 1 1
epl-2.0 | 3 | <eclipse> public licen[cs]e(?: version| v)? 2(?: 0)?
epl-1.0 | 3 | <eclipse> public licen[cs]e(?: version| v)? 1(?: 0)?
epl | 2 | <eclipse> public licen[cs]e
edl-1.0 | 3 | <eclipse> distribution licen[cs]e(?: version| v)?(?: 1 0)?
cddl-1.1 | 3 | common development and distribution <license>(?: cddl)?(?: version)? 1 1
cddl-1.0 | 3 | common development and distribution <license>(?: cddl)?(?: version)? 1 0
cddl | 2 | common development and distribution <license>
cddl | 1 | <cddl>
cpl-1.0 | 2 | common public <license>(?: version)?(?: 1 0)?
eupl-1.2 | 3 | <eupl>(?: v)? 1 2(?: or later)?
eupl | 2 | european union public <licence>(?: v| version)?(?: 1 [012])?
eupl | 2 | european union public <license>(?: v| version)?(?: 1 [012])?
bsl-1.0 | 2 | boost software <license>(?: version)?(?: 1 0)?
busl-1.1 | 3 | business source <license>(?: version)? 1 1
busl | 2 | business source <license>
sspl-1.0 | 2 | server side public <license>(?: v1| version 1)?
elastic-2.0 | 2 | elastic <license>(?: version)?(?: 2 0)?
artistic-2.0 | 3 | artistic <license>(?: version)? 2 0
artistic-1.0 | 3 | artistic <license>(?: version)? 1 0
artistic | 2 | (?:perl )?artistic <license>
zlib | 2 | zlib(?: libpng)? <license>
zlib | 3 | this software is provided as is without any <express> or implied warranty in no event
zlib | 2 | must not be <misrepresented> you must not claim that you wrote the original software
ncsa | 2 | university of illinois ncsa open source <license>
ncsa | 2 | ncsa open source <license>
postgresql | 2 | postgresql <license>
python-2.0 | 3 | python software foundation <license>(?: version)?(?: 2)?
python-2.0 | 2 | psf <license>(?: agreement)?
php | 2 | php <license>(?: version)?(?: 3 0[01]?)?
ruby | 2 | ruby(?: s)? <license>
openssl | 2 | openssl(?: ssleay)? <license>
w3c | 2 | w3c software(?: notice and)? <license>
w3c | 2 | w3c software and document notice and <license>
vim | 2 | vim <license>
ijg | 2 | independent jpeg group(?: s)? <license>
ofl-1.1 | 3 | sil open font <license>(?: version)? 1 1
ofl | 2 | (?:sil )?open font <license>
ms-pl | 2 | microsoft public <license>(?: ms pl)?
ms-rl | 2 | microsoft reciprocal <license>(?: ms rl)?
apsl-2.0 | 2 | apple public source <license>(?: version)?(?: 2 0)?
osl-3.0 | 2 | open software <license>(?: version| v)?(?: 3 0)?
afl-3.0 | 2 | academic free <license>(?: version| v)?(?: 3 0)?
ecl-2.0 | 2 | educational community <license>(?: version)?(?: 2 0)?
upl-1.0 | 2 | universal permissive <license>(?: upl)?(?: version)?(?: 1 0)?
blueoak-1.0.0 | 2 | blue oak model <license>(?: 1 0 0)?
hippocratic | 2 | hippocratic <license>(?: version)?(?: 2 1| 3 0)?
beerware | 2 | beer ?ware <license>
beerware | 1 | <beerware>
json | 2 | the software shall be used for good not <evil>
wtfpl | 3 | do what the fuck you want to public <license>
wtfpl | 1 | <wtfpl>
unlicense | 3 | this is free and <unencumbered> software released into the public domain
unlicense | 2 | the <unlicense>
public-domain | 2 | (?:released|placed|dedicated) (?:in|into|to) the public <domain>
public-domain | 2 | public <domain> dedication
public-domain | 1 | in the public <domain>
cc0-1.0 | 3 | <cc0>(?: version)?(?: 1 0)?(?: universal)?
cc0-1.0 | 3 | <creative> commons zero(?: v1 0| 1 0)?(?: universal)?
cc0-1.0 | 2 | <waive> all of (?:his|her|their) rights to the work worldwide under copyright law
cc-by | 3 | <cc> by(?: [1-4](?: [05])?)?
cc-by-sa | 3 | <cc> by sa(?: [1-4](?: [05])?)?
cc-by-nc | 3 | <cc> by nc(?: [1-4](?: [05])?)?
cc-by-nd | 3 | <cc> by nd(?: [1-4](?: [05])?)?
cc-by-nc-sa | 3 | <cc> by nc sa(?: [1-4](?: [05])?)?
cc-by-nc-nd | 3 | <cc> by nc nd(?: [1-4](?: [05])?)?
cc-by | 3 | <creative> commons attribution(?: [1-4] [05])?(?: international| unported| generic)?
cc-by-sa | 3 | <creative> commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?
cc-by-nc | 3 | <creative> commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?
cc-by-nd | 3 | <creative> commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: international| unported)?
cc-by-nc-sa | 3 | <creative> commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported)?
cc-by-nc-nd | 3 | <creative> commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?
cc | 1 | <creative> commons(?: licen[cs]e)?
odbl-1.0 | 2 | open (?:data commons open )?database <license>(?: odbl)?(?: v1 0| 1 0)?
odc-by | 2 | open data commons attribution <license>
pddl-1.0 | 2 | public domain dedication and <license>(?: pddl)?
cdla-permissive | 2 | community data <license> agreement permissive(?: 1 0| 2 0)?
cdla-sharing | 2 | community data <license> agreement sharing(?: 1 0)?
ogl-3.0 | 2 | open government <licence>(?: v| version)?(?: 3 0)?
openrail | 2 | (?:creativeml )?open ?rail(?: m)? <license>
llama | 2 | llama [23](?: [1-9])? community <license>(?: agreement)?
gemma | 2 | <gemma> terms of use
proprietary | 2 | <proprietary> and confidential
proprietary | 2 | <confidential> and proprietary
proprietary | 2 | <unauthorized> (?:copying|use|reproduction|distribution)(?: or distribution)? of this
proprietary | 2 | may not be <reproduced>(?: copied)?(?: or)?(?: distributed)? without (?:the )?(?:prior )?(?:written )?permission
proprietary | 2 | end user <license> agreement
proprietary | 1 | all rights <reserved>
no-warranty | 1 | as is without <warranty> of any kind
no-warranty | 1 | without <warranties> or conditions of any kind
non-commercial | 2 | for (?:non commercial|noncommercial|personal) use <only>
non-commercial | 1 | not for commercial <redistribution>
research-only | 2 | for research purposes <only>
free-software | 1 | this program is free <software>
copyleft | 1 | <copyleft>
dual-license | 1 | dual <licensed>(?: under)?
open-source | 1 | open source <license>
"""


@dataclass(frozen=True)
class Signature:
    """A rule taken apart at its keyword. ``lead`` and ``tail`` are regular expressions over the
    words before and after it; ``near`` are the literal texts that touch it, a cheap filter."""

    rule: int
    label: str
    priority: int
    base: bool
    keyword: str
    lead: str
    tail: str
    near_lead: str
    near_tail: str


_META = re.compile(r"[\\^$.|?*+()\[\]{}]")


def signature(number: int, line: str, base: bool = False) -> Signature:
    """Reads a line; raises if its pattern could reach beyond ``REACH`` words."""
    label, priority, pattern = (part.strip() for part in line.split("|", 2))
    found = re.fullmatch(r"(.*?)<([a-z0-9]+)>(.*)", pattern)
    if not found:
        raise ValueError(f"no keyword in {line!r}")
    lead, keyword, tail = found.groups()
    for side in (lead, tail):
        if side.count(" ") > REACH or _unbounded(side):
            raise ValueError(f"the pattern reaches too far: {line!r}")
    # Literal text next to the keyword, up to the first sign of a pattern.
    near_tail = _META.split(tail)[0] if "|" not in re.sub(r"\(.*?\)", "", tail) else ""
    if tail[len(near_tail) : len(near_tail) + 1] in ("?", "*", "{"):
        near_tail = near_tail[:-1]
    near_lead = _META.split(lead)[-1]
    return Signature(
        number,
        label,
        int(priority),
        base,
        keyword,
        f" {lead}" + r"\z",
        r"\A" + f"{tail} ",
        near_lead,
        near_tail,
    )


def _unbounded(side: str) -> bool:
    """Is a blank repeated, or any sign but those of a word's own class?"""
    return bool(re.search(r"[*{]|\)\+|\.\+| \+", side))


def signatures(base: str = BASE, rules: str = RULES) -> list[Signature]:
    """All rules in order, the base ones first."""
    own = [(line, True) for line in base.strip().splitlines()]
    own += [(line, False) for line in rules.strip().splitlines()]
    return [signature(i, line, is_base) for i, (line, is_base) in enumerate(own)]


def as_json(rules: list[Signature]) -> str:
    return json.dumps([asdict(r) for r in rules])
