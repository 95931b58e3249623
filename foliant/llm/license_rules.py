"""Licence signatures: hand-written patterns over normalised text.

Text is normalised to lower-case words with one space between, so "CC BY-NC 4.0" reads
"cc by nc 4 0". One rule a line: label | priority | keyword | pattern. A pattern must hold
its keyword, which is looked for first. Of overlapping detections the higher priority prevails, then
the one of more words, then the earlier rule: whatever lies within a prevailing one is dropped.
Priorities: 9 full texts, 8 identifiers, 7 addresses, 6 names with version, 5 grants without a
version, 4 bare names, 2 hints.
"""

from __future__ import annotations

#: Base phrases: always reported, never suppressed.
BASE = """
mit | 1 | licen | mit license
apache | 1 | licen | apache license
gpl | 1 | licen | general public license
"""

RULES = r"""
mit | 9 | permission | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 8 | spdx | spdx license identifier mit
mit | 7 | licen | opensource org licenses? mit(?: license)?(?: php)?
mit | 7 | licen | mit license org
mit | 6 | licen | (?:licensed|released|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?mit licen[cs]e
mit | 5 | licen | licensed under (?:the )?mit
mit | 5 | licen | licen[cs]e mit
mit | 4 | licen | (?:mit|expat) licen[cs]e
mit-0 | 8 | spdx | spdx license identifier mit 0
mit-0 | 6 | licen | mit no attribution(?: licen[cs]e)?|mit 0 licen[cs]e
x11 | 6 | licen | (?:mit )?x11 licen[cs]e
x11 | 8 | spdx | spdx license identifier x11
isc | 9 | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 8 | spdx | spdx license identifier isc
isc | 7 | licen | opensource org licenses? isc(?: license)?
isc | 5 | licen | (?:licensed|released|distributed) under (?:the )?isc(?: licen[cs]e)?
isc | 4 | licen | isc licen[cs]e
apache-2.0 | 9 | licen | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 | 8 | spdx | spdx license identifier apache 2 0
apache-2.0 | 7 | licen | apache org licenses license 2 0(?: txt| html)?
apache-2.0 | 7 | licen | opensource org licenses apache 2 0
apache-2.0 | 6 | licen | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?apache licen[cs]e version 2(?: 0)?
apache-2.0 | 6 | licen | apache licen[cs]e (?:version )?v?2(?: 0)?
apache-2.0 | 6 | licen | apache (?:software )?licen[cs]e version 2(?: 0)?
apache-2.0 | 5 | apache | apache 2(?: 0)?
apache-1.1 | 8 | spdx | spdx license identifier apache 1 1
apache-1.1 | 6 | licen | apache (?:software )?licen[cs]e (?:version )?v?1 1
apache-1.0 | 8 | spdx | spdx license identifier apache 1 0
apache-1.0 | 6 | licen | apache (?:software )?licen[cs]e (?:version )?v?1 0
apache | 5 | licen | (?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?apache(?: software)? licen[cs]e
apache | 4 | licen | apache (?:software )?licen[cs]e
gpl-3.0 | 9 | licen | you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3
gpl-3.0 | 8 | spdx | spdx license identifier gpl 3 0(?: only| or later)?
gpl-3.0 | 7 | licen | gnu org licenses gpl 3 0(?: html| txt| en html)?
gpl-3.0 | 7 | licen | opensource org licenses gpl 3 0
gpl-3.0 | 6 | licen | (?:gnu )?general public licen[cs]e (?:as published by the free software foundation )?(?:either )?(?:version |v)3(?: 0)?
gpl-3.0 | 6 | gpl | (?:gnu )?gpl ?v ?3(?: 0)?
gpl-3.0 | 6 | gpl | (?:gnu )?gpl (?:version )?3(?: 0)?
gpl-2.0 | 9 | licen | you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2
gpl-2.0 | 8 | spdx | spdx license identifier gpl 2 0(?: only| or later)?
gpl-2.0 | 7 | licen | gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt| en html)?
gpl-2.0 | 7 | licen | opensource org licenses gpl 2 0
gpl-2.0 | 6 | licen | (?:gnu )?general public licen[cs]e (?:as published by the free software foundation )?(?:either )?(?:version |v)2(?: 0)?
gpl-2.0 | 6 | gpl | (?:gnu )?gpl ?v ?2(?: 0)?
gpl-2.0 | 6 | gpl | (?:gnu )?gpl (?:version )?2(?: 0)?
gpl-1.0 | 8 | spdx | spdx license identifier gpl 1 0(?: only| or later)?
gpl-1.0 | 6 | licen | (?:gnu )?general public licen[cs]e (?:version |v)1(?: 0)?
gpl | 5 | licen | (?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?:gpl|general public licen[cs]e)
gpl | 4 | licen | (?:gnu )?general public licen[cs]e
gpl | 4 | gpl | gnu gpl
lgpl-3.0 | 8 | spdx | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-3.0 | 7 | licen | gnu org licenses lgpl(?: 3 0)?(?: html| txt| en html)?
lgpl-3.0 | 6 | licen | (?:gnu )?lesser general public licen[cs]e (?:as published by the free software foundation )?(?:either )?(?:version |v)3(?: 0)?
lgpl-3.0 | 6 | gpl | lgpl ?v? ?3(?: 0)?
lgpl-2.1 | 9 | licen | under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1
lgpl-2.1 | 8 | spdx | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-2.1 | 7 | licen | gnu org licenses (?:old licenses )?lgpl 2 1(?: html| txt| en html)?
lgpl-2.1 | 6 | licen | (?:gnu )?lesser general public licen[cs]e (?:as published by the free software foundation )?(?:either )?(?:version |v)2 1
lgpl-2.1 | 6 | gpl | lgpl ?v? ?2 1
lgpl-2.0 | 8 | spdx | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.0 | 6 | licen | (?:gnu )?library general public licen[cs]e(?: (?:version |v)2(?: 0)?)?
lgpl | 5 | licen | (?:gnu )?lesser general public licen[cs]e
lgpl | 4 | gpl | (?:gnu )?lgpl
agpl-3.0 | 9 | licen | under the terms of the gnu affero general public license as published by the free software foundation either version 3
agpl-3.0 | 8 | spdx | spdx license identifier agpl 3 0(?: only| or later)?
agpl-3.0 | 7 | licen | gnu org licenses agpl(?: 3 0)?(?: html| txt| en html)?
agpl-3.0 | 6 | licen | (?:gnu )?affero general public licen[cs]e (?:as published by the free software foundation )?(?:either )?(?:version |v)3(?: 0)?
agpl-3.0 | 6 | gpl | agpl ?v? ?3(?: 0)?
agpl | 5 | licen | (?:gnu )?affero general public licen[cs]e
agpl | 4 | gpl | (?:gnu )?agpl
gfdl-1.3 | 8 | spdx | spdx license identifier gfdl 1 3(?: only| or later)?
gfdl-1.3 | 6 | licen | gnu free documentation licen[cs]e version 1 3
gfdl-1.2 | 8 | spdx | spdx license identifier gfdl 1 2(?: only| or later)?
gfdl-1.2 | 6 | licen | gnu free documentation licen[cs]e version 1 2
gfdl | 5 | licen | (?:gnu )?free documentation licen[cs]e
bsd-3-clause | 9 | redistribut | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met .{0,900}?neither the name of
bsd-3-clause | 8 | spdx | spdx license identifier bsd 3 clause
bsd-3-clause | 7 | licen | opensource org licenses bsd 3 clause
bsd-3-clause | 6 | bsd | (?:bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[cs]e)?
bsd-3-clause | 6 | licen | (?:new|modified|revised) bsd licen[cs]e
bsd-2-clause | 8 | spdx | spdx license identifier bsd 2 clause
bsd-2-clause | 7 | licen | opensource org licenses bsd 2 clause
bsd-2-clause | 6 | bsd | (?:bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[cs]e)?
bsd-2-clause | 6 | licen | (?:simplified bsd|freebsd) licen[cs]e
bsd-4-clause | 8 | spdx | spdx license identifier bsd 4 clause
bsd-4-clause | 6 | bsd | (?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[cs]e)?
bsd-4-clause | 9 | redistribut | redistribution and use in source and binary forms .{0,700}?all advertising materials mentioning features or use of this software
0bsd | 8 | spdx | spdx license identifier 0bsd
0bsd | 6 | bsd | (?:0bsd|zero clause bsd|bsd zero clause)(?: licen[cs]e)?
bsd | 7 | redistribut | redistribution and use in source and binary forms with or without modification are permitted
bsd | 5 | licen | (?:licensed|released|distributed) under (?:the |a )?bsd(?: style)?(?: licen[cs]e)?
bsd | 4 | licen | bsd(?: style)? licen[cs]e
mpl-2.0 | 9 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | 8 | spdx | spdx license identifier mpl 2 0
mpl-2.0 | 7 | mozilla | mozilla org (?:en us )?mpl 2 0
mpl-2.0 | 6 | mozilla | mozilla public licen[cs]e (?:version |v ?)?2(?: 0)?
mpl-1.1 | 8 | spdx | spdx license identifier mpl 1 1
mpl-1.1 | 6 | mozilla | mozilla public licen[cs]e (?:version |v ?)?1 1
mpl-1.0 | 8 | spdx | spdx license identifier mpl 1 0
mpl-1.0 | 6 | mozilla | mozilla public licen[cs]e (?:version |v ?)?1 0
mpl | 4 | mozilla | mozilla public licen[cs]e
epl-2.0 | 8 | spdx | spdx license identifier epl 2 0
epl-2.0 | 7 | eclipse | eclipse org (?:org documents|legal) epl 2 0
epl-2.0 | 6 | eclipse | eclipse public licen[cs]e (?:version |v ?)?2(?: 0)?
epl-1.0 | 8 | spdx | spdx license identifier epl 1 0
epl-1.0 | 7 | eclipse | eclipse org legal epl v10(?: html)?
epl-1.0 | 6 | eclipse | eclipse public licen[cs]e (?:version |v ?)?1(?: 0)?
epl | 4 | eclipse | eclipse public licen[cs]e
edl-1.0 | 6 | eclipse | eclipse distribution licen[cs]e(?: (?:version |v ?)?1 0)?
cpl-1.0 | 6 | licen | common public licen[cs]e(?: (?:version |v ?)?1 0)?
cpl-1.0 | 8 | spdx | spdx license identifier cpl 1 0
cddl-1.0 | 8 | spdx | spdx license identifier cddl 1 0
cddl-1.0 | 6 | licen | common development and distribution licen[cs]e(?: (?:version |v ?)?1 0)?
cddl-1.1 | 8 | spdx | spdx license identifier cddl 1 1
cddl-1.1 | 6 | licen | common development and distribution licen[cs]e (?:version |v ?)?1 1
eupl-1.2 | 8 | spdx | spdx license identifier eupl 1 2
eupl-1.2 | 6 | licen | european union public licen[cs]e (?:version |v ?)?1 2
eupl-1.1 | 8 | spdx | spdx license identifier eupl 1 1
eupl-1.1 | 6 | licen | european union public licen[cs]e (?:version |v ?)?1 1
eupl | 4 | licen | european union public licen[cs]e
cecill-2.1 | 8 | spdx | spdx license identifier cecill 2 1
cecill | 6 | cecill | (?:governed by|under) the cecill(?: b| c)? licen[cs]e
cecill | 4 | cecill | cecill(?: b| c)? licen[cs]e
artistic-2.0 | 8 | spdx | spdx license identifier artistic 2 0
artistic-2.0 | 6 | licen | artistic licen[cs]e (?:version )?2(?: 0)?
artistic-1.0 | 8 | spdx | spdx license identifier artistic 1 0(?: perl)?
artistic-1.0 | 6 | licen | artistic licen[cs]e (?:version )?1(?: 0)?
artistic | 4 | licen | (?:perl )?artistic licen[cs]e
perl | 6 | terms | (?:under )?the same terms as perl(?: itself)?
python-2.0 | 8 | spdx | spdx license identifier python 2 0
psf-2.0 | 8 | spdx | spdx license identifier psf 2 0
psf-2.0 | 6 | licen | python software foundation licen[cs]e(?: version 2)?
psf-2.0 | 4 | licen | (?:psf|python) licen[cs]e
ruby | 8 | spdx | spdx license identifier ruby
ruby | 4 | licen | ruby s? ?licen[cs]e
php-3.01 | 8 | spdx | spdx license identifier php 3 01
php-3.01 | 6 | licen | php licen[cs]e (?:version |v ?)?3 01
php-3.0 | 6 | licen | php licen[cs]e (?:version |v ?)?3 0
php | 4 | licen | php licen[cs]e
zlib | 9 | warrant | this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages
zlib | 8 | spdx | spdx license identifier zlib
zlib | 6 | licen | zlib(?: libpng)? licen[cs]e
libpng | 8 | spdx | spdx license identifier libpng(?: 2 0)?
libpng | 4 | licen | libpng licen[cs]e
bsl-1.0 | 9 | permission | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
bsl-1.0 | 8 | spdx | spdx license identifier bsl 1 0
bsl-1.0 | 7 | licen | boost org license 1 0 txt
bsl-1.0 | 6 | licen | boost software licen[cs]e(?: version 1 0| 1 0)?
busl-1.1 | 8 | spdx | spdx license identifier busl 1 1
busl-1.1 | 6 | licen | business source licen[cs]e(?: (?:version )?1 1)?
sspl-1.0 | 8 | spdx | spdx license identifier sspl 1 0
sspl-1.0 | 6 | licen | server side public licen[cs]e(?: (?:version |v ?)?1)?
elastic-2.0 | 8 | spdx | spdx license identifier elastic 2 0
elastic-2.0 | 6 | licen | elastic licen[cs]e (?:version )?2(?: 0)?
polyform-noncommercial-1.0.0 | 6 | polyform | polyform noncommercial(?: licen[cs]e)?(?: 1 0 0)?
polyform-small-business-1.0.0 | 6 | polyform | polyform small business(?: licen[cs]e)?(?: 1 0 0)?
unlicense | 9 | public domain | this is free and unencumbered software released into the public domain
unlicense | 8 | spdx | spdx license identifier unlicense
unlicense | 7 | licen | unlicense org
unlicense | 6 | licen | (?:the )?unlicense
wtfpl | 9 | public licen | do what the fuck you want to public licen[cs]e
wtfpl | 8 | spdx | spdx license identifier wtfpl
wtfpl | 6 | wtfpl | wtfpl(?: licen[cs]e| version 2)?
beerware | 6 | beer | (?:the )?beer ?ware licen[cs]e(?: revision 42)?
ms-pl | 8 | spdx | spdx license identifier ms pl
ms-pl | 6 | licen | microsoft public licen[cs]e(?: ms pl)?
ms-rl | 8 | spdx | spdx license identifier ms rl
ms-rl | 6 | licen | microsoft reciprocal licen[cs]e(?: ms rl)?
ofl-1.1 | 8 | spdx | spdx license identifier ofl 1 1
ofl-1.1 | 6 | font | (?:sil )?open font licen[cs]e(?: (?:version )?1 1)?
ncsa | 8 | spdx | spdx license identifier ncsa
ncsa | 6 | licen | university of illinois (?:ncsa )?open source licen[cs]e
postgresql | 8 | spdx | spdx license identifier postgresql
postgresql | 4 | licen | postgresql licen[cs]e
openssl | 8 | spdx | spdx license identifier openssl
openssl | 4 | licen | openssl(?: ssleay)? licen[cs]e
curl | 8 | spdx | spdx license identifier curl
curl | 4 | licen | curl licen[cs]e
w3c | 8 | spdx | spdx license identifier w3c
w3c | 6 | w3c | w3c software (?:notice and|and document) (?:notice and )?licen[cs]e
unicode | 6 | unicode | unicode (?:inc )?licen[cs]e agreement(?: data files and software)?
upl-1.0 | 8 | spdx | spdx license identifier upl 1 0
upl-1.0 | 6 | licen | universal permissive licen[cs]e(?: (?:version |v ?)?1 0)?
osl-3.0 | 8 | spdx | spdx license identifier osl 3 0
osl-3.0 | 6 | licen | open software licen[cs]e (?:version |v ?)?3(?: 0)?
afl-3.0 | 8 | spdx | spdx license identifier afl 3 0
afl-3.0 | 6 | licen | academic free licen[cs]e(?: (?:version |v ?)?3(?: 0)?)?
qpl-1.0 | 6 | licen | q public licen[cs]e(?: version 1 0)?
ipl-1.0 | 6 | licen | ibm public licen[cs]e(?: version 1 0)?
spl-1.0 | 6 | licen | sun public licen[cs]e(?: version 1 0)?
apsl-2.0 | 6 | licen | apple public source licen[cs]e(?: (?:version )?2(?: 0)?)?
nposl-3.0 | 6 | licen | non profit open software licen[cs]e(?: 3 0)?
mulanpsl-2.0 | 6 | mulan | mulan psl ?v?2|mulan permissive software licen[cs]e(?: version 2| v2)?
vim | 4 | licen | vim licen[cs]e
tcl | 4 | licen | tcl tk licen[cs]e
ecl-2.0 | 6 | licen | educational community licen[cs]e(?: version 2 0| 2 0)?
odbl-1.0 | 6 | database | (?:odc )?open database licen[cs]e(?: (?:version |v ?)?1 0)?
odc-by-1.0 | 6 | commons | open data commons attribution licen[cs]e(?: (?:version |v ?)?1 0)?
pddl-1.0 | 6 | public domain | (?:open data commons )?public domain dedication and licen[cs]e(?: (?:version |v ?)?1 0)?
openrail | 6 | openrail | (?:creativeml |bigscience |bigcode )?openrail(?: m)?(?: licen[cs]e)?
cc0-1.0 | 8 | spdx | spdx license identifier cc0 1 0
cc0-1.0 | 7 | creative | creativecommons org publicdomain zero 1 0
cc0-1.0 | 6 | cc0 | cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?
cc-by-4.0 | 8 | spdx | spdx license identifier cc by 4 0
cc-by-4.0 | 7 | creative | creativecommons org licenses by 4 0
cc-by-4.0 | 6 | creative | creative commons attribution (?:licen[cs]e )?4 0(?: international)?
cc-by-4.0 | 6 | cc by | cc by 4 0
cc-by-3.0 | 7 | creative | creativecommons org licenses by 3 0
cc-by-3.0 | 6 | creative | creative commons attribution (?:licen[cs]e )?3 0(?: unported)?
cc-by-3.0 | 6 | cc by | cc by 3 0
cc-by-sa-4.0 | 8 | spdx | spdx license identifier cc by sa 4 0
cc-by-sa-4.0 | 7 | creative | creativecommons org licenses by sa 4 0
cc-by-sa-4.0 | 6 | creative | creative commons attribution share ?alike (?:licen[cs]e )?4 0(?: international)?
cc-by-sa-4.0 | 6 | cc by | cc by sa 4 0
cc-by-sa-3.0 | 7 | creative | creativecommons org licenses by sa 3 0
cc-by-sa-3.0 | 6 | creative | creative commons attribution share ?alike (?:licen[cs]e )?3 0(?: unported)?
cc-by-sa-3.0 | 6 | cc by | cc by sa 3 0
cc-by-nc-4.0 | 8 | spdx | spdx license identifier cc by nc 4 0
cc-by-nc-4.0 | 7 | creative | creativecommons org licenses by nc 4 0
cc-by-nc-4.0 | 6 | creative | creative commons attribution non ?commercial (?:licen[cs]e )?4 0(?: international)?
cc-by-nc-4.0 | 6 | cc by | cc by nc 4 0
cc-by-nc-3.0 | 6 | cc by | cc by nc 3 0
cc-by-nc-sa-4.0 | 8 | spdx | spdx license identifier cc by nc sa 4 0
cc-by-nc-sa-4.0 | 7 | creative | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-4.0 | 6 | creative | creative commons attribution non ?commercial share ?alike (?:licen[cs]e )?4 0(?: international)?
cc-by-nc-sa-4.0 | 6 | cc by | cc by nc sa 4 0
cc-by-nc-nd-4.0 | 8 | spdx | spdx license identifier cc by nc nd 4 0
cc-by-nc-nd-4.0 | 7 | creative | creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-4.0 | 6 | creative | creative commons attribution non ?commercial no ?deriv(?:ative)?s (?:licen[cs]e )?4 0(?: international)?
cc-by-nc-nd-4.0 | 6 | cc by | cc by nc nd 4 0
cc-by-nd-4.0 | 7 | creative | creativecommons org licenses by nd 4 0
cc-by-nd-4.0 | 6 | cc by | cc by nd 4 0
cc-by-nd-4.0 | 6 | creative | creative commons attribution no ?deriv(?:ative)?s (?:licen[cs]e )?4 0(?: international)?
cc-by-nc-nd | 4 | cc by | cc by nc nd
cc-by-nc-sa | 4 | cc by | cc by nc sa
cc-by-nc | 4 | cc by | cc by nc
cc-by-nd | 4 | cc by | cc by nd
cc-by-sa | 4 | cc by | cc by sa
cc-by | 4 | cc by | licensed under (?:a )?cc by(?! (?:nc|sa|nd|[0-9]))
cc | 4 | creative | creative commons(?: public)? licen[cs]e
public-domain | 5 | public domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 2 | public domain | (?:is|are) in the public domain
proprietary | 5 | confidential | proprietary and confidential
proprietary | 4 | licen | (?:proprietary|commercial) licen[cs]e
proprietary | 2 | rights | all rights reserved
"""
