"""Signature rules for licenses, over texts normalized to lower-case words with one blank between.

One rule a line: label, priority, confidence in per cent, keyword, regex. A rule is tried only
on texts that hold its keyword; on overlaps the higher priority wins (see `licenses.resolve`).
Priorities: 4 machine-readable tags, 3 grants and links, 2 names, 1 short or vague names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

TABLE = r"""
mit|4|99|spdx|spdx license identifier mit(?! 0)
mit|3|97|under the mit|(?:licensed|released|distributed|available|published|provided)(?: \w+){0,3} under the mit licen[sc]e
mit|3|97|permission is hereby granted|permission is hereby granted free of charge to any person obtaining a copy
mit|3|95|opensource org|opensource org licenses mit
mit|2|85|mit licen|(?:the )?mit licen[sc]e
mit|2|80|expat licen|expat licen[sc]e
mit|2|80|x11 licen|x11 licen[sc]e
mit-0|4|99|mit 0|spdx license identifier mit 0
mit-0|2|90|mit no attribution|mit no attribution(?: licen[sc]e)?
apache-2|4|99|spdx|spdx license identifier apache 2 0
apache-2|3|97|under the apache|licensed under the apache licen[sc]e(?: version)? 2(?: 0)?
apache-2|3|96|apache org|apache org licenses license 2 0
apache-2|3|95|opensource org|opensource org licenses apache 2 0
apache-2|2|92|apache|apache(?: software)? licen[sc]e(?: version| v)? ?2(?: 0)?
apache-2|2|90|apache|apache(?: software foundation)? licen[sc]e v2(?: 0)?
apache-2|2|85|apache 2|apache 2(?: 0)?(?: licen[sc]e)
apache-2|1|60|asl 2|asl 2 0
apache-1.1|4|99|spdx|spdx license identifier apache 1 1
apache-1.1|2|90|apache|apache(?: software)? licen[sc]e(?: version)? 1 1
apache-1.0|4|99|spdx|spdx license identifier apache 1 0
apache-1.0|2|90|apache|apache(?: software)? licen[sc]e(?: version)? 1 0
bsd-2|4|99|spdx|spdx license identifier bsd 2 clause
bsd-2|3|95|opensource org|opensource org licenses bsd 2 clause
bsd-2|2|90|bsd|(?:bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[sc]e)?
bsd-2|2|88|simplified bsd|simplified bsd licen[sc]e
bsd-2|2|88|freebsd licen|freebsd licen[sc]e
bsd-3|4|99|spdx|spdx license identifier bsd 3 clause
bsd-3|3|95|opensource org|opensource org licenses bsd 3 clause
bsd-3|3|94|neither the name of|neither the name of(?: the)? [\w ]{1,80}? nor the names of its contributors
bsd-3|2|90|bsd|(?:bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[sc]e)?
bsd-3|2|88|bsd licen|(?:new|modified|revised) bsd licen[sc]e
bsd-4|4|99|spdx|spdx license identifier bsd 4 clause
bsd-4|3|90|all advertising materials|all advertising materials mentioning features or use of this software
bsd-4|2|90|bsd|(?:bsd 4 clause|4 clause bsd|four clause bsd)(?: licen[sc]e)?
bsd-4|2|85|original bsd|original bsd licen[sc]e
bsd|3|85|redistribution and use|redistribution and use in source and binary forms with or without modification are permitted
bsd|3|80|under the bsd|(?:licensed|released|distributed) under the bsd licen[sc]e
bsd|1|70|bsd licen|bsd(?: style)? licen[sc]e
0bsd|4|99|spdx|spdx license identifier 0bsd
0bsd|2|90|zero clause bsd|zero clause bsd(?: licen[sc]e)?
gpl-3|4|99|spdx|spdx license identifier gpl 3 0(?: only| or later)?
gpl-3|3|97|general public licen|gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)? version 3(?: 0)?
gpl-3|3|95|gnu org|gnu org licenses gpl 3 0
gpl-3|3|95|opensource org|opensource org licenses gpl 3 0
gpl-3|2|90|gplv3|(?:gnu )?gplv3
gpl-3|2|88|gpl|(?:gnu )?gpl(?: version| v)? ?3(?: 0)?
gpl-2|4|99|spdx|spdx license identifier gpl 2 0(?: only| or later)?
gpl-2|3|97|general public licen|gnu general public licen[sc]e(?: as published by the free software foundation)?(?: either)? version 2(?: 0)?
gpl-2|3|95|gnu org|gnu org licenses old licenses gpl 2 0
gpl-2|3|95|opensource org|opensource org licenses gpl 2 0
gpl-2|2|90|gplv2|(?:gnu )?gplv2
gpl-2|2|88|gpl|(?:gnu )?gpl(?: version| v)? ?2(?: 0)?
gpl-1|4|99|spdx|spdx license identifier gpl 1 0
gpl-1|3|95|general public licen|gnu general public licen[sc]e(?: either)? version 1(?: 0)?
gpl|3|85|gnu org|gnu org licenses gpl
gpl|2|80|general public licen|gnu general public licen[sc]e
gpl|1|60|gnu gpl|gnu gpl
gpl|1|60|under the gpl|(?:licensed|released|distributed) under the gpl
lgpl-3|4|99|spdx|spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-3|3|97|lesser general public|gnu lesser general public licen[sc]e(?: either)? version 3(?: 0)?
lgpl-3|3|95|gnu org|gnu org licenses lgpl 3 0
lgpl-3|2|90|lgplv3|(?:gnu )?lgplv3
lgpl-3|2|88|lgpl|(?:gnu )?lgpl(?: version| v)? ?3(?: 0)?
lgpl-2.1|4|99|spdx|spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-2.1|3|97|lesser general public|gnu lesser general public licen[sc]e(?: either)? version 2 1
lgpl-2.1|3|95|gnu org|gnu org licenses old licenses lgpl 2 1
lgpl-2.1|2|88|lgpl|(?:gnu )?lgpl(?: version| v)? ?2 1
lgpl-2|4|99|spdx|spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2|3|95|library general public|gnu library general public licen[sc]e(?: either)? version 2(?: 0)?
lgpl|2|80|lesser general public|(?:gnu )?lesser general public licen[sc]e
lgpl|2|80|library general public|(?:gnu )?library general public licen[sc]e
lgpl|1|60|gnu lgpl|gnu lgpl
agpl-3|4|99|spdx|spdx license identifier agpl 3 0(?: only| or later)?
agpl-3|3|97|affero general public|gnu affero general public licen[sc]e(?: either)? version 3(?: 0)?
agpl-3|3|95|gnu org|gnu org licenses agpl 3 0
agpl-3|2|90|agplv3|(?:gnu )?agplv3
agpl-3|2|88|agpl|(?:gnu )?agpl(?: version| v)? ?3(?: 0)?
agpl|2|80|affero general public|(?:gnu )?affero general public licen[sc]e
gfdl-1.3|4|99|spdx|spdx license identifier gfdl 1 3
gfdl-1.3|3|95|free documentation licen|gnu free documentation licen[sc]e version 1 3
gfdl-1.2|4|99|spdx|spdx license identifier gfdl 1 2
gfdl-1.2|3|95|free documentation licen|gnu free documentation licen[sc]e version 1 2
gfdl|2|80|free documentation licen|(?:gnu )?free documentation licen[sc]e
mpl-2|4|99|spdx|spdx license identifier mpl 2 0
mpl-2|3|96|subject to the terms of the mozilla|subject to the terms of the mozilla public licen[sc]e v ?2 0
mpl-2|3|95|mozilla org|mozilla org mpl 2 0
mpl-2|3|95|opensource org|opensource org licenses mpl 2 0
mpl-2|2|92|mozilla public|mozilla public licen[sc]e(?: version| v)? ?2(?: 0)?
mpl-1.1|4|99|spdx|spdx license identifier mpl 1 1
mpl-1.1|3|95|mozilla org|mozilla org mpl mpl 1 1
mpl-1.1|2|92|mozilla public|mozilla public licen[sc]e(?: version| v)? ?1 1
mpl-1.0|2|92|mozilla public|mozilla public licen[sc]e(?: version| v)? ?1 0
mpl|2|75|mozilla public|mozilla public licen[sc]e
epl-2|4|99|spdx|spdx license identifier epl 2 0
epl-2|3|95|eclipse org|eclipse org legal epl (?:v20|2 0)
epl-2|2|92|eclipse public|eclipse public licen[sc]e(?: version| v)? ?2(?: 0)?
epl-1|4|99|spdx|spdx license identifier epl 1 0
epl-1|3|95|eclipse org|eclipse org legal epl (?:v10|1 0)
epl-1|2|92|eclipse public|eclipse public licen[sc]e(?: version| v)? ?1(?: 0)?
epl|2|75|eclipse public|eclipse public licen[sc]e
edl-1|2|90|eclipse distribution|eclipse distribution licen[sc]e(?: version| v)? ?1 0
cddl-1.1|4|99|spdx|spdx license identifier cddl 1 1
cddl-1.1|2|92|common development and distribution|common development and distribution licen[sc]e(?: cddl)?(?: version| v)? ?1 1
cddl-1|4|99|spdx|spdx license identifier cddl 1 0
cddl-1|2|92|common development and distribution|common development and distribution licen[sc]e(?: cddl)?(?: version| v)? ?1 0
cddl|2|75|common development and distribution|common development and distribution licen[sc]e
cpl-1|2|92|common public licen|common public licen[sc]e(?: version| v)? ?1 0
cpal-1|2|92|common public attribution|common public attribution licen[sc]e(?: version| v)? ?1 0
ibm-pl-1|2|92|ibm public|ibm public licen[sc]e(?: version| v)? ?1 0
artistic-2|4|99|spdx|spdx license identifier artistic 2 0
artistic-2|3|95|opensource org|opensource org licenses artistic 2 0
artistic-2|2|92|artistic licen|artistic licen[sc]e(?: version)? 2 0
artistic-1|4|99|spdx|spdx license identifier artistic 1 0
artistic-1|2|90|artistic licen|artistic licen[sc]e(?: version)? 1 0
artistic|2|75|artistic licen|artistic licen[sc]e
perl|2|85|same terms as perl|(?:under|on) the same terms as perl(?: itself)?
bsl-1|4|99|spdx|spdx license identifier bsl 1 0
bsl-1|3|95|boost org|boost org license 1 0
bsl-1|2|92|boost software|boost software licen[sc]e(?: version)?(?: 1 0)?
busl-1.1|4|99|spdx|spdx license identifier busl 1 1
busl-1.1|2|92|business source licen|business source licen[sc]e(?: version)?(?: 1 1)?
isc|4|99|spdx|spdx license identifier isc
isc|3|95|permission to use copy modify|permission to use copy modify and or distribute this software for any purpose
isc|3|95|opensource org|opensource org licenses isc
isc|2|88|isc licen|isc licen[sc]e
zlib|4|99|spdx|spdx license identifier zlib
zlib|3|95|altered source versions|altered source versions must be plainly marked as such
zlib|2|88|zlib|zlib(?: libpng)? licen[sc]e
libpng|2|85|libpng licen|libpng licen[sc]e
unlicense|4|99|spdx|spdx license identifier unlicense
unlicense|3|96|unencumbered software|this is free and unencumbered software released into the public domain
unlicense|3|95|unlicense org|unlicense org
unlicense|2|85|unlicense|the unlicense
wtfpl|4|99|spdx|spdx license identifier wtfpl
wtfpl|2|92|what the fuck|do what the fuck you want to public licen[sc]e
wtfpl|1|80|wtfpl|wtfpl
cc0|4|99|spdx|spdx license identifier cc0 1 0
cc0|3|96|creativecommons org|creativecommons org publicdomain zero 1 0
cc0|2|92|cc0|cc0(?: 1 0)?(?: universal)?
cc0|2|92|creative commons zero|creative commons zero(?: v1 0)?(?: universal)?
cc-pdm|3|95|creativecommons org|creativecommons org publicdomain mark 1 0
public-domain|3|85|public domain|(?:released|dedicated|placed)(?: \w+){0,3} (?:into|to|in) the public domain
public-domain|1|60|public domain|this (?:work|file|code|software) is in the public domain
cc-by-nc-nd|4|99|spdx|spdx license identifier cc by nc nd
cc-by-nc-nd|3|97|creativecommons org|creativecommons org licenses by nc nd
cc-by-nc-nd|2|95|cc by nc nd|cc by nc nd(?: [1234] 0)?
cc-by-nc-nd|2|95|attribution noncommercial|attribution non ?commercial no ?deriv(?:ative)?s(?: works)?(?: [1234] 0)?
cc-by-nc-sa|4|99|spdx|spdx license identifier cc by nc sa
cc-by-nc-sa|3|97|creativecommons org|creativecommons org licenses by nc sa
cc-by-nc-sa|2|95|cc by nc sa|cc by nc sa(?: [1234] 0)?
cc-by-nc-sa|2|95|attribution noncommercial|attribution non ?commercial share ?alike(?: [1234] 0)?
cc-by-nc|4|99|spdx|spdx license identifier cc by nc
cc-by-nc|3|96|creativecommons org|creativecommons org licenses by nc
cc-by-nc|2|92|cc by nc|cc by nc(?: [1234] 0)?
cc-by-nc|2|92|attribution noncommercial|(?:creative commons )?attribution non ?commercial(?: [1234] 0)?
cc-by-nd|4|99|spdx|spdx license identifier cc by nd
cc-by-nd|3|96|creativecommons org|creativecommons org licenses by nd
cc-by-nd|2|92|cc by nd|cc by nd(?: [1234] 0)?
cc-by-nd|2|92|attribution noderiv|(?:creative commons )?attribution no ?deriv(?:ative)?s(?: [1234] 0)?
cc-by-sa|4|99|spdx|spdx license identifier cc by sa
cc-by-sa|3|96|creativecommons org|creativecommons org licenses by sa
cc-by-sa|2|92|cc by sa|cc by sa(?: [1234] 0)?
cc-by-sa|2|92|attribution sharealike|(?:creative commons )?attribution share ?alike(?: [1234] 0)?
cc-by-sa|2|92|attribution share alike|(?:creative commons )?attribution share alike(?: [1234] 0)?
cc-by|4|99|spdx|spdx license identifier cc by [1234] 0
cc-by|3|95|creativecommons org|creativecommons org licenses by(?= [1234])
cc-by|2|88|cc by|cc by(?: [1234] 0)
cc-by|2|88|creative commons attribution|creative commons attribution(?: [1234] 0)?(?: international| unported)?
cc|1|60|creative commons|creative commons licen[sc]e
ofl-1.1|4|99|spdx|spdx license identifier ofl 1 1
ofl-1.1|3|95|scripts sil org|scripts sil org ofl
ofl-1.1|2|92|open font licen|(?:sil )?open font licen[sc]e(?: version)?(?: 1 1)?
ubuntu-font|2|90|ubuntu font|ubuntu font licen[sc]e
odbl-1|4|99|spdx|spdx license identifier odbl 1 0
odbl-1|3|95|opendatacommons org|opendatacommons org licenses odbl
odbl-1|2|92|open database licen|open database licen[sc]e
odc-by|3|95|opendatacommons org|opendatacommons org licenses by
odc-by|2|92|open data commons attribution|open data commons attribution licen[sc]e
pddl|3|95|opendatacommons org|opendatacommons org licenses pddl
pddl|2|92|public domain dedication and licen|public domain dedication and licen[sc]e
cdla-permissive|2|92|community data licen|community data licen[sc]e agreement permissive
cdla-sharing|2|92|community data licen|community data licen[sc]e agreement sharing
ogl-uk|3|95|nationalarchives gov uk|nationalarchives gov uk doc open government licence
ogl-uk|2|90|open government licen|open government licen[sc]e(?: v[123] 0)?
psf-2|4|99|spdx|spdx license identifier psf 2 0
psf-2|2|92|python software foundation|python software foundation licen[sc]e(?: version 2)?
python-2|2|90|python licen|python licen[sc]e 2 0
ruby|4|99|spdx|spdx license identifier ruby
ruby|2|85|ruby licen|ruby licen[sc]e
php-3.01|4|99|spdx|spdx license identifier php 3 01
php-3.01|2|92|php licen|php licen[sc]e version 3 01
php|2|80|php licen|php licen[sc]e
postgresql|4|99|spdx|spdx license identifier postgresql
postgresql|2|90|postgresql licen|postgresql licen[sc]e
openssl|4|99|spdx|spdx license identifier openssl
openssl|2|90|openssl licen|openssl licen[sc]e
sleepycat|2|90|sleepycat|sleepycat licen[sc]e
ncsa|4|99|spdx|spdx license identifier ncsa
ncsa|2|90|ncsa open source|(?:university of illinois )?ncsa open source licen[sc]e
vim|2|85|vim licen|vim licen[sc]e
w3c|4|99|spdx|spdx license identifier w3c
w3c|2|90|w3c software|w3c software(?: notice and)? licen[sc]e
unicode|4|99|spdx|spdx license identifier unicode dfs 2016
unicode|2|90|unicode licen|unicode licen[sc]e(?: agreement)?
icu|2|85|icu licen|icu licen[sc]e
curl|2|85|curl licen|curl licen[sc]e
x11-distribute|2|85|x consortium|x consortium licen[sc]e
tcl|2|85|tcl tk licen|tcl tk licen[sc]e
zpl-2.1|4|99|spdx|spdx license identifier zpl 2 1
zpl-2.1|2|92|zope public|zope public licen[sc]e(?: version)? 2 1
zpl|2|80|zope public|zope public licen[sc]e
eupl-1.2|4|99|spdx|spdx license identifier eupl 1 2
eupl-1.2|2|92|european union public|european union public licen[sc]e(?: version| v)? ?1 2
eupl-1.1|2|92|european union public|european union public licen[sc]e(?: version| v)? ?1 1
eupl|2|80|european union public|european union public licen[sc]e
cecill-2.1|4|99|spdx|spdx license identifier cecill 2 1
cecill|2|85|cecill|cecill(?: [bc])?(?: free software)? licen[sc]e
ms-pl|4|99|spdx|spdx license identifier ms pl
ms-pl|2|92|microsoft public|microsoft public licen[sc]e
ms-rl|4|99|spdx|spdx license identifier ms rl
ms-rl|2|92|microsoft reciprocal|microsoft reciprocal licen[sc]e
apsl-2|4|99|spdx|spdx license identifier apsl 2 0
apsl-2|2|92|apple public source|apple public source licen[sc]e(?: version)?(?: 2 0)?
osl-3|4|99|spdx|spdx license identifier osl 3 0
osl-3|2|92|open software licen|open software licen[sc]e(?: version| v)? ?3 0
afl-3|4|99|spdx|spdx license identifier afl 3 0
afl-3|2|92|academic free|academic free licen[sc]e(?: version| v)? ?3 0
ecl-2|2|92|educational community|educational community licen[sc]e(?: version)? 2 0
lppl-1.3c|4|99|spdx|spdx license identifier lppl 1 3c
lppl-1.3c|2|92|latex project public|latex project public licen[sc]e(?: version)? 1 3c
lppl|2|80|latex project public|latex project public licen[sc]e
sspl-1|4|99|spdx|spdx license identifier sspl 1 0
sspl-1|2|92|server side public|server side public licen[sc]e
elastic-2|4|99|spdx|spdx license identifier elastic 2 0
elastic-2|2|92|elastic licen|elastic licen[sc]e(?: version| v)? ?2(?: 0)?
upl-1|4|99|spdx|spdx license identifier upl 1 0
upl-1|2|92|universal permissive|universal permissive licen[sc]e(?: version| v)?(?: ?1 0)?
mulan-psl-2|2|92|mulan|mulan permissive software licen[sc]e(?: version| v)? ?2
beerware|2|85|beer ware|beer ware licen[sc]e
json|3|90|shall be used for good|the software shall be used for good not evil
openrail|2|88|openrail|(?:creativeml |bigscience |bigcode )?openrail(?: m| [mds])?(?: licen[sc]e)?
llama|2|88|community licen|llama [234](?: [123])? community licen[sc]e(?: agreement)?
commons-clause|2|90|commons clause|commons clause(?: licen[sc]e)?(?: condition)?
polyform-nc|2|90|polyform noncommercial|polyform noncommercial licen[sc]e(?: 1 0 0)?
polyform-sb|2|90|polyform small business|polyform small business licen[sc]e(?: 1 0 0)?
proprietary|3|80|all rights reserved|copyright(?: c)?(?: \w+){0,8} all rights reserved
proprietary|1|50|all rights reserved|all rights reserved
proprietary|2|75|proprietary and confidential|proprietary and confidential
no-derivatives|1|60|may not be modified|may not be modified or redistributed
non-commercial|1|60|non commercial use only|(?:for )?non commercial use only
"""


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    keyword: str
    pattern: re.Pattern


def parse(table: str = TABLE) -> list[Rule]:
    """The rules in table order; a match begins and ends between words."""
    rules = []
    for line in table.strip().splitlines():
        label, priority, confidence, keyword, regex = line.split("|", 4)
        pattern = re.compile(f"(?:(?<= )|^)(?:{regex})(?= |$)")
        rules.append(Rule(label, int(priority), int(confidence) / 100, keyword, pattern))
    return rules
