"""Signatures of licences over lower-cased words that one blank separates.

A line is: label, priority, keyword, regular expression. The keyword must stand in the text
for the expression to be tried. Priority 3 is a grant or a licence's own wording, 2 a full
name, 1 a mention. Earlier lines go first among equals.
"""

from __future__ import annotations

from dataclasses import dataclass

#: The phrases whose places are all counted and whose labels always stay.
BASE = """
mit | 2 | under the mit license | under the mit license
apache-2 | 2 | apache license version 2 | apache license version 2
cc-by-nc | 2 | cc by nc | cc by nc
"""

SIGNATURES = """
mit | 3 | mit | (?:released|licensed|distributed|available|published) under the (?:terms of the )?(?:permissive )?mit licen[cs]e
mit | 3 | mit | licen[cs]ed under mit
mit | 3 | mit | spdx license identifier mit
mit | 3 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 3 | without restriction | to deal in the software without restriction including without limitation the rights to use copy modify
mit | 3 | as is | the software is provided as is without warranty of any kind express or implied
mit | 2 | mit | (?:the )?(?:mit|expat)(?: x11)? licen[cs]e
mit | 2 | mit | mit x11
mit | 1 | mit | license mit
mit-0 | 3 | mit | mit no attribution(?: licen[cs]e)?
mit-0 | 3 | mit | spdx license identifier mit 0
x11 | 2 | x11 | x11 licen[cs]e
isc | 3 | isc | (?:released|licensed|distributed|available) under the (?:terms of the )?isc licen[cs]e
isc | 3 | isc | spdx license identifier isc
isc | 3 | permission to use | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 2 | isc | isc licen[cs]e
apache-1 | 3 | apache | (?:released|licensed|distributed) under the apache (?:software )?licen[cs]e version 1 0
apache-1 | 2 | apache | apache (?:software )?licen[cs]e(?: version)? 1 0
apache-1.1 | 3 | apache | (?:released|licensed|distributed) under the apache (?:software )?licen[cs]e version 1 1
apache-1.1 | 2 | apache | apache (?:software )?licen[cs]e(?: version)? 1 1
apache-2 | 3 | apache | (?:released|licensed|distributed|available) under the (?:terms of the )?apache (?:software )?licen[cs]e(?: version| v)? ?2(?: 0)?
apache-2 | 3 | apache | you may not use this file except in compliance with the license
apache-2 | 3 | apache | spdx license identifier apache 2 0
apache-2 | 3 | www apache org | https? www apache org licenses license 2 0
apache-2 | 2 | apache | apache (?:software )?licen[cs]e(?: version| v)? ?2(?: 0)?
apache-2 | 2 | apache | apache 2(?: 0)? licen[cs]e
apache-2 | 1 | apache | apache v?2(?: 0)?
apache | 1 | apache | (?:under the |the )?apache (?:software )?licen[cs]e
gpl-1 | 2 | general public | (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 1
gpl-1 | 2 | gpl | (?:gnu )?gpl(?: version| v)? ?1(?: 0)?
gpl-2 | 3 | general public | (?:licensed|released|distributed) under the (?:terms of the )?(?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 2
gpl-2 | 3 | gpl | spdx license identifier gpl 2 0(?: only)?
gpl-2 | 2 | general public | (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?2
gpl-2 | 2 | gpl | (?:gnu )?gpl(?: version| v)? ?2(?: 0)?
gpl-2 | 1 | gplv2 | (?:gnu )?gplv2
gpl-2+ | 3 | general public | (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)? either version 2 of the license or at your option any later version
gpl-2+ | 3 | gpl | spdx license identifier gpl 2 0 or later
gpl-2+ | 2 | gpl | (?:gnu )?gpl(?: version| v)? ?2(?: 0)? or (?:any )?later(?: version)?
gpl-3 | 3 | general public | (?:licensed|released|distributed) under the (?:terms of the )?(?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)? version 3
gpl-3 | 3 | gpl | spdx license identifier gpl 3 0(?: only)?
gpl-3 | 2 | general public | (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3
gpl-3 | 2 | gpl | (?:gnu )?gpl(?: version| v)? ?3(?: 0)?
gpl-3 | 1 | gplv3 | (?:gnu )?gplv3
gpl-3+ | 3 | general public | (?:gnu )?general public licen[cs]e(?: as published by the free software foundation)? either version 3 of the license or at your option any later version
gpl-3+ | 3 | gpl | spdx license identifier gpl 3 0 or later
gpl-3+ | 2 | gpl | (?:gnu )?gpl(?: version| v)? ?3(?: 0)? or (?:any )?later(?: version)?
gpl | 3 | free software foundation | redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl | 2 | general public | gnu general public licen[cs]e
gpl | 1 | gpl | gnu gpl
gpl | 1 | gpl | under the gpl
gpl-classpath | 3 | classpath | gpl 2 0 with classpath exception
gpl-classpath | 2 | classpath | classpath exception
gpl-font | 2 | font | gpl(?: 2 0)? with font exception
lgpl-2 | 3 | library general public | (?:licensed|released|distributed) under the (?:terms of the )?gnu library general public licen[cs]e
lgpl-2 | 2 | library general public | gnu library general public licen[cs]e(?: version 2)?
lgpl-2 | 2 | lgpl | lgpl(?: version| v)? ?2(?: 0)?
lgpl-2.1 | 3 | lesser general public | gnu lesser general public licen[cs]e(?: as published by the free software foundation)? either version 2 1
lgpl-2.1 | 3 | lgpl | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-2.1 | 2 | lesser general public | (?:gnu )?lesser general public licen[cs]e(?: version| v)? ?2 1
lgpl-2.1 | 2 | lgpl | lgpl(?: version| v)? ?2 1
lgpl-3 | 3 | lesser general public | gnu lesser general public licen[cs]e(?: as published by the free software foundation)? either version 3
lgpl-3 | 3 | lgpl | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-3 | 2 | lesser general public | (?:gnu )?lesser general public licen[cs]e(?: version| v)? ?3
lgpl-3 | 2 | lgpl | lgpl(?: version| v)? ?3(?: 0)?
lgpl | 2 | lesser general public | gnu lesser general public licen[cs]e
lgpl | 1 | lgpl | (?:gnu |under the )lgpl
agpl-1 | 2 | affero | affero general public licen[cs]e(?: version)? 1
agpl-3 | 3 | affero | (?:licensed|released|distributed) under the (?:terms of the )?gnu affero general public licen[cs]e(?: version 3)?
agpl-3 | 3 | agpl | spdx license identifier agpl 3 0(?: only| or later)?
agpl-3 | 2 | affero | (?:gnu )?affero general public licen[cs]e(?: version| v)? ?3?
agpl-3 | 2 | agpl | (?:gnu )?agpl(?: version| v)? ?3(?: 0)?
agpl-3 | 1 | agplv3 | agplv3
gfdl | 3 | free documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e
gfdl-1.1 | 2 | free documentation | gnu free documentation licen[cs]e version 1 1
gfdl-1.2 | 2 | free documentation | gnu free documentation licen[cs]e version 1 2
gfdl-1.3 | 2 | free documentation | gnu free documentation licen[cs]e version 1 3
gfdl | 2 | free documentation | gnu free documentation licen[cs]e
gfdl | 1 | gfdl | (?:gnu )?gfdl
bsd-1 | 2 | bsd | (?:1|one) clause bsd(?: licen[cs]e)?
bsd-2 | 3 | bsd | spdx license identifier bsd 2 clause
bsd-2 | 2 | bsd | (?:2|two) clause bsd(?: licen[cs]e)?
bsd-2 | 2 | bsd | bsd 2 clause(?: licen[cs]e)?
bsd-2 | 2 | simplified bsd | simplified bsd(?: licen[cs]e)?
bsd-2 | 2 | freebsd | freebsd licen[cs]e
bsd-3 | 3 | bsd | spdx license identifier bsd 3 clause
bsd-3 | 3 | neither the name | neither the name of .{0,80} nor the names of its contributors may be used to endorse or promote products
bsd-3 | 2 | bsd | (?:3|three) clause bsd(?: licen[cs]e)?
bsd-3 | 2 | bsd | bsd 3 clause(?: licen[cs]e)?
bsd-3 | 2 | bsd | (?:new|modified|revised) bsd(?: licen[cs]e)?
bsd-4 | 3 | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
bsd-4 | 2 | bsd | (?:4|four) clause bsd(?: licen[cs]e)?
bsd-4 | 2 | bsd | (?:original|old) bsd(?: licen[cs]e)?
bsd-0 | 2 | bsd | (?:0|zero) clause bsd(?: licen[cs]e)?
bsd-0 | 2 | 0bsd | 0bsd
bsd-patent | 2 | bsd | bsd (?:2 clause )?plus patent(?: licen[cs]e)?
bsd | 3 | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd | 3 | bsd | (?:released|licensed|distributed) under (?:the |a )?bsd(?: style)? licen[cs]e
bsd | 1 | bsd | bsd(?: style)? licen[cs]e
mpl-1.0 | 2 | mozilla public | mozilla public licen[cs]e(?: version| v)? ?1 0
mpl-1.1 | 2 | mozilla public | mozilla public licen[cs]e(?: version| v)? ?1 1
mpl-1.1 | 2 | mpl | mpl(?: version| v)? ?1 1
mpl-2 | 3 | mozilla public | subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?2 0
mpl-2 | 3 | mpl | spdx license identifier mpl 2 0
mpl-2 | 2 | mozilla public | mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?
mpl-2 | 2 | mpl | mpl(?: version| v)? ?2(?: 0)?
mpl | 1 | mozilla public | mozilla public licen[cs]e
npl | 2 | netscape public | netscape public licen[cs]e(?: version)?(?: 1 [01])?
epl-1 | 2 | eclipse public | eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?
epl-2 | 3 | epl | spdx license identifier epl 2 0
epl-2 | 2 | eclipse public | eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?
epl-2 | 2 | epl | epl(?: version| v)? ?2 0
epl | 1 | eclipse public | eclipse public licen[cs]e
edl | 2 | eclipse distribution | eclipse distribution licen[cs]e(?: version| v)? ?(?:1 0)?
cpl-1 | 2 | common public licen | common public licen[cs]e(?: version)?(?: 1 0)?
ipl-1 | 2 | ibm public | ibm public licen[cs]e(?: version)?(?: 1 0)?
cpal-1 | 2 | common public attribution | common public attribution licen[cs]e(?: version)?(?: 1 0)?
cddl-1.0 | 2 | development and distribution | common development and distribution licen[cs]e(?: version)?(?: 1 0)?
cddl-1.1 | 2 | development and distribution | common development and distribution licen[cs]e(?: version)? 1 1
cddl | 1 | cddl | cddl(?: 1 [01])?
eupl-1.1 | 2 | european union public | european union public licen[cs]e(?: version| v)? ?1 1
eupl-1.2 | 2 | european union public | european union public licen[cs]e(?: version| v)? ?1 2
eupl | 1 | eupl | eupl(?: v)?(?: 1 [0-2])?
osl-3 | 2 | open software licen | open software licen[cs]e(?: version| v)? ?3(?: 0)?
osl | 1 | open software licen | open software licen[cs]e
afl-3 | 2 | academic free | academic free licen[cs]e(?: version| v)? ?3(?: 0)?
afl | 1 | academic free | academic free licen[cs]e
artistic-1 | 2 | artistic | (?:perl )?artistic licen[cs]e(?: version)? 1(?: 0)?
artistic-2 | 2 | artistic | artistic licen[cs]e(?: version)? 2(?: 0)?
artistic | 1 | artistic | artistic licen[cs]e
perl | 3 | perl | under the same terms as perl itself
python-2 | 3 | python software foundation | python software foundation licen[cs]e(?: agreement)?(?: version)? 2
python | 2 | python software foundation | python software foundation licen[cs]e
python | 1 | psf | psf licen[cs]e
ruby | 2 | ruby | (?:under the )?ruby licen[cs]e
ruby | 3 | ruby | under the same terms as ruby
php-3.0 | 2 | php licen | php licen[cs]e(?: version)? 3 0
php-3.01 | 2 | php licen | php licen[cs]e(?: version)? 3 01
php | 1 | php licen | php licen[cs]e
zend-2 | 2 | zend | zend (?:engine )?licen[cs]e(?: version)?(?: 2 00?)?
zlib | 3 | zlib | (?:released|licensed|distributed) under the zlib(?: libpng)? licen[cs]e
zlib | 3 | altered source versions | altered source versions must be plainly marked as such
zlib | 2 | zlib | zlib(?: libpng)? licen[cs]e
libpng-2 | 2 | png reference library | png reference library licen[cs]e(?: version 2)?
libpng | 2 | libpng | libpng licen[cs]e
ijg | 2 | independent jpeg | independent jpeg group licen[cs]e
ijg | 3 | independent jpeg | based in part on the work of the independent jpeg group
openssl | 2 | openssl | openssl licen[cs]e
ssleay | 2 | ssleay | (?:original )?ssleay licen[cs]e
curl | 2 | curl | curl licen[cs]e
icu | 2 | icu | icu licen[cs]e
unicode | 2 | unicode | unicode(?: inc)? licen[cs]e(?: agreement)?
boost-1 | 3 | boost | distributed under the boost software licen[cs]e(?: version 1 0)?
boost-1 | 3 | bsl | spdx license identifier bsl 1 0
boost-1 | 2 | boost software | boost software licen[cs]e(?: version)?(?: 1 0)?
unlicense | 3 | public domain | this is free and unencumbered software released into the public domain
unlicense | 2 | unlicen | the unlicen[cs]e
unlicense | 1 | unlicense org | unlicense org
wtfpl | 2 | what the fuck | do what the fuck you want to public licen[cs]e(?: version 2)?
wtfpl | 1 | wtfpl | wtfpl
beerware | 2 | beer | (?:the )?beer ?ware licen[cs]e
postgresql | 2 | postgresql | postgresql licen[cs]e
ncsa | 2 | illinois | university of illinois(?: ncsa)? open source licen[cs]e
upl-1 | 2 | universal permissive | universal permissive licen[cs]e(?: version| v)? ?(?:1 0)?
sleepycat | 2 | sleepycat | sleepycat licen[cs]e
vim | 2 | vim licen | vim licen[cs]e
tcl | 2 | tcl | tcl tk licen[cs]e
w3c | 2 | w3c | w3c (?:software (?:notice and )?)?licen[cs]e
latex-1.3c | 2 | latex project | latex project public licen[cs]e(?: version| v)? ?(?:1 3c?)?
ofl-1.0 | 2 | open font | sil open font licen[cs]e(?: version)? 1 0
ofl-1.1 | 3 | open font | this font software is licensed under the sil open font licen[cs]e version 1 1
ofl-1.1 | 2 | open font | sil open font licen[cs]e(?: version)? 1 1
ofl | 1 | open font | (?:sil )?open font licen[cs]e
ubuntu-font | 2 | ubuntu font | ubuntu font licen[cs]e(?: version)?(?: 1 0)?
ms-pl | 2 | microsoft public | microsoft public licen[cs]e
ms-pl | 1 | ms pl | ms pl
ms-rl | 2 | microsoft reciprocal | microsoft reciprocal licen[cs]e
ms-lpl | 2 | microsoft limited | microsoft limited public licen[cs]e
cecill-1 | 2 | cecill | cecill(?: free software)? licen[cs]e(?: agreement)?(?: version)? 1(?: [01])?
cecill-2.1 | 2 | cecill | cecill(?: version| v)? ?2 1
cecill-b | 2 | cecill b | cecill b(?: licen[cs]e)?
cecill-c | 2 | cecill c | cecill c(?: licen[cs]e)?
cecill | 1 | cecill | cecill
mulan-2 | 2 | mulan | mulan (?:permissive software licen[cs]e|psl)(?: version| v)? ?2?
ecl-2 | 2 | educational community | educational community licen[cs]e(?: version)?(?: 2 0)?
rpl-1.5 | 2 | reciprocal public | reciprocal public licen[cs]e(?: 1 [15])?
qpl | 2 | q public | q public licen[cs]e(?: version)?(?: 1 0)?
sspl-1 | 2 | server side public | server side public licen[cs]e(?: version| v)? ?1?
busl-1.1 | 2 | business source | business source licen[cs]e(?: version)?(?: 1 1)?
elastic-2 | 2 | elastic licen | elastic licen[cs]e(?: version)?(?: 2 0)?
confluent | 2 | confluent community | confluent community licen[cs]e
commons-clause | 2 | commons clause | commons clause(?: licen[cs]e)?(?: condition)?
polyform-nc | 2 | polyform | polyform noncommercial licen[cs]e(?: 1 0 0)?
polyform | 1 | polyform | polyform [a-z]+ licen[cs]e
odbl-1 | 3 | open database | made available under the open database licen[cs]e
odbl-1 | 2 | open database | open (?:data commons open )?database licen[cs]e(?: v)?(?: 1 0)?
odc-by-1 | 2 | open data commons | open data commons attribution licen[cs]e(?: v)?(?: 1 0)?
pddl-1 | 2 | open data commons | open data commons public domain dedication(?: and)? licen[cs]e
ogl-uk-3 | 2 | open government | open government licen[cs]e(?: version| v)? ?3(?: 0)?
ogl | 2 | open government | open government licen[cs]e
etalab-2 | 2 | licence ouverte | licence ouverte(?: open licence)?(?: etalab)?(?: version)?(?: 2 0)?
dl-de-by-2 | 2 | datenlizenz | datenlizenz deutschland namensnennung(?: version)? 2 0
dl-de-zero-2 | 2 | datenlizenz | datenlizenz deutschland zero(?: version)? 2 0
cdla-permissive | 2 | community data | community data licen[cs]e agreement permissive(?: version)?(?: [12] 0)?
cdla-sharing | 2 | community data | community data licen[cs]e agreement sharing(?: version)?(?: 1 0)?
cc0-1 | 3 | cc0 | (?:released|dedicated|published|available) (?:to the public domain )?under (?:the )?(?:creative commons )?cc0(?: 1 0)?
cc0-1 | 2 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?
cc0-1 | 2 | creative commons zero | creative commons zero(?: v1 0)?(?: universal)?
cc-pdm | 2 | public domain mark | (?:creative commons )?public domain mark(?: 1 0)?
cc-by-nc-nd | 3 | cc by nc nd | (?:licensed|released|available) under (?:a |the )?cc by nc nd(?: [1-4] [05])?
cc-by-nc-nd | 2 | cc by nc nd | cc by nc nd(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc-nd | 2 | creative commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: (?:works )?[1-4] [05])?
cc-by-nc-sa | 3 | cc by nc sa | (?:licensed|released|available) under (?:a |the )?cc by nc sa(?: [1-4] [05])?
cc-by-nc-sa | 2 | cc by nc sa | cc by nc sa(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc-sa | 2 | creative commons | creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?
cc-by-nc | 3 | cc by nc | (?:licensed|released|available) under (?:a |the )?cc by nc(?: [1-4] [05])?
cc-by-nc | 2 | cc by nc | cc by nc(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc | 2 | creative commons | creative commons attribution non ?commercial(?: [1-4] [05])?
cc-by-nd | 3 | cc by nd | (?:licensed|released|available) under (?:a |the )?cc by nd(?: [1-4] [05])?
cc-by-nd | 2 | cc by nd | cc by nd(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nd | 2 | creative commons | creative commons attribution no ?deriv(?:ative)?s?(?: (?:works )?[1-4] [05])?
cc-by-sa | 3 | cc by sa | (?:licensed|released|available) under (?:a |the )?cc by sa(?: [1-4] [05])?
cc-by-sa | 2 | cc by sa | cc by sa(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-sa | 2 | creative commons | creative commons attribution share ?alike(?: [1-4] [05])?
cc-by | 3 | cc by | (?:licensed|released|available) under (?:a |the )?cc by(?: [1-4] [05])?
cc-by | 2 | cc by | cc by [1-4] [05](?: licen[cs]e)?
cc-by | 2 | creative commons | creative commons attribution(?: [1-4] [05])?(?: international)?(?: licen[cs]e)?
cc | 3 | creativecommons org | creativecommons org licenses [a-z ]{2,12} [1-4] [05]
cc | 1 | creative commons | creative commons(?: licen[cs]e)?
public-domain | 3 | public domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 2 | public domain | (?:is|are) in the public domain
public-domain | 1 | public domain | public domain
proprietary | 3 | all rights reserved | copyright (?:c )?(?:[0-9]{4} )+.{0,80}all rights reserved
proprietary | 2 | all rights reserved | all rights reserved
proprietary | 3 | proprietary | this software is proprietary and confidential
proprietary | 2 | confidential | proprietary and confidential
proprietary | 3 | without the prior | no part of this (?:publication|document|work) may be reproduced .{0,120}without the prior (?:written )?permission
proprietary | 2 | end user licen | end user licen[cs]e agreement
proprietary | 1 | eula | eula
noncommercial | 2 | non commercial use | (?:for )?non commercial use only
noncommercial | 2 | commercial use | not for commercial use
noncommercial | 1 | commercial use | commercial use (?:is )?prohibited
research-only | 2 | research | (?:for )?research (?:purposes|use) only
openrail | 2 | openrail | (?:creativeml |bigscience )?open ?rail(?: [a-z])?(?: licen[cs]e)?
llama-community | 2 | community licen | llama [0-9]+(?: [0-9])? community licen[cs]e(?: agreement)?
unknown-license | 1 | licensed under | licensed under (?:the |a )?(?:terms of )?
unknown-license | 1 | see license | see licen[cs]e(?: file| txt| md)?(?: for details)?
unknown-license | 1 | licence file | see the licen[cs]e file
"""


@dataclass(frozen=True)
class Signature:
    label: str
    priority: int
    keyword: str
    pattern: str
    base: bool = False


def parse(lines: str, base: bool = False) -> list[Signature]:
    found = []
    for line in filter(None, map(str.strip, lines.splitlines())):
        label, priority, keyword, pattern = (part.strip() for part in line.split(" | ", 3))
        found.append(Signature(label, int(priority), keyword, pattern, base))
    return found


RULES = [*parse(BASE, base=True), *parse(SIGNATURES)]
