"""License scans: ordered signature rules over the words of a text.

A text is lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; rules are regular expressions over the
words joined by single spaces, so punctuation, line breaks and comment marks don't matter. A rule belongs to a tier, which is
its priority, and has keywords, one in each of its alternatives; an automaton finds the keywords of a text in one pass, and only
rules of which a keyword occurs are tried. Of overlapping detections, one that lies inside another of equal or higher priority is suppressed.

Tiers, from high to low: identifier lines, addresses, whole notices, statements that something is under a license, names.
Four phrases (`BASE`) are counted wherever they stand and always give their label.

The score is the weight of the best detection's tier. Null texts are empty; texts without a detection have no labels and score
0. Each row is scanned whole by itself.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate
from re import _constants as sre  # the parts of a parsed expression
from re import _parser as parser

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.columns import alnum_words, append_columns
from gaugeworks.llm.decontaminate import char_spans

BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Tier: priority and score.
TIERS = {"identifier": (5, 1.0), "address": (4, 0.95), "notice": (3, 0.9), "statement": (2, 0.8), "name": (1, 0.6)}

#: label | keyword | names (alternatives, longest first). Each gives a name rule and a statement rule. A name that can do without the
#: keyword has one of its own (`_keyword`).
NAMES = r"""
agpl-3.0 | affero | gnu affero general public license(?: as published by the free software foundation)?,? (?:either )?version 3; gnu affero general public license v(?:ersion )?3; affero gpl v?3; agpl ?v?3(?: 0)?
agpl | affero | gnu affero general public license; affero general public license
agpl | agpl | gnu agpl; agpl
lgpl-3.0 | lesser | gnu lesser general public license v(?:ersion )?3(?: 0)?; lesser general public license version 3
lgpl-2.1 | lesser | gnu lesser general public license v(?:ersion )?2 1; lesser general public license version 2 1
lgpl-2.0 | library general | gnu library general public license(?: version 2)?
lgpl | lesser | gnu lesser general public license; lesser general public license
lgpl-3.0 | lgpl | gnu lgpl v?3(?: 0)?; lgpl ?v?3(?: 0)?
lgpl-2.1 | lgpl | gnu lgpl v?2 1; lgpl ?v?2 1
lgpl | lgpl | gnu lgpl; lgpl
gpl-3.0 | general public | gnu general public license v(?:ersion )?3(?: 0)?; general public license version 3(?: 0)?
gpl-2.0 | general public | gnu general public license v(?:ersion )?2(?: 0)?; general public license version 2(?: 0)?
gpl-1.0 | general public | gnu general public license v(?:ersion )?1(?: 0)?
gpl | general public | gnu general public license; gnu public license
gpl-3.0 | gpl | gnu gpl v?3(?: 0)?; gpl ?v3(?: 0)?; gpl 3(?: 0)?
gpl-2.0 | gpl | gnu gpl v?2(?: 0)?; gpl ?v2(?: 0)?; gpl 2(?: 0)?
gpl | gpl | gnu gpl; gplv?[23]?
gfdl-1.3 | documentation license | gnu free documentation license version 1 3
gfdl-1.2 | documentation license | gnu free documentation license version 1 2
gfdl-1.1 | documentation license | gnu free documentation license version 1 1
gfdl | documentation license | gnu free documentation license; free documentation license
gfdl | gfdl | gnu fdl; gfdl
apache-2.0 | apache | apache license v(?:ersion )?2(?: 0)?; apache software license v(?:ersion )?2(?: 0)?; apache licen[cs]e 2(?: 0)?; apache 2(?: 0)? licen[cs]e
apache-1.1 | apache | apache software license v(?:ersion )?1 1; apache license v(?:ersion )?1 1
apache-1.0 | apache | apache license v(?:ersion )?1 0; apache software license v(?:ersion )?1 0
apache | apache | apache software license; apache license; apache public license
mit | mit licen | mit licen[cs]e; mit expat licen[cs]e; expat mit licen[cs]e
mit | expat | expat licen[cs]e
mit-0 | mit no attribution | mit no attribution(?: license)?
x11 | x11 licen | x11 licen[cs]e; mit x11 licen[cs]e
bsd-4-clause | bsd | bsd 4 clause(?: licen[cs]e)?; original bsd licen[cs]e; four clause bsd licen[cs]e; 4 clause bsd(?: licen[cs]e)?
bsd-3-clause | bsd | bsd 3 clause(?: new or revised)?(?: licen[cs]e)?; new bsd licen[cs]e; modified bsd licen[cs]e; revised bsd licen[cs]e; three clause bsd licen[cs]e; 3 clause bsd(?: licen[cs]e)?
bsd-2-clause | bsd | bsd 2 clause(?: simplified)?(?: licen[cs]e)?; simplified bsd licen[cs]e; freebsd licen[cs]e; two clause bsd licen[cs]e; 2 clause bsd(?: licen[cs]e)?
bsd-0-clause | bsd | bsd zero clause licen[cs]e; zero clause bsd(?: licen[cs]e)?; 0 clause bsd(?: licen[cs]e)?
bsd | bsd | bsd style licen[cs]e; bsd licen[cs]e; berkeley software distribution licen[cs]e
0bsd | 0bsd | 0bsd(?: licen[cs]e)?
isc | isc licen | isc licen[cs]e; internet systems consortium licen[cs]e
zlib | zlib | zlib libpng licen[cs]e; zlib licen[cs]e
libpng | libpng | libpng licen[cs]e(?: version 2)?
mpl-2.0 | mozilla | mozilla public license v(?:ersion )?2(?: 0)?; mozilla public license 2(?: 0)?
mpl-1.1 | mozilla | mozilla public license v(?:ersion )?1 1; mozilla public license 1 1
mpl-1.0 | mozilla | mozilla public license v(?:ersion )?1 0
mpl | mozilla | mozilla public license
mpl-2.0 | mpl | mpl ?v?2(?: 0)?
mpl-1.1 | mpl | mpl ?v?1 1
epl-2.0 | eclipse | eclipse public license v(?:ersion )? ?2(?: 0)?; eclipse public license 2 0
epl-1.0 | eclipse | eclipse public license v(?:ersion )? ?1(?: 0)?; eclipse public license 1 0
epl | eclipse | eclipse public license
edl-1.0 | eclipse | eclipse distribution license(?: v(?:ersion )? ?1 0)?
cddl-1.1 | cddl | cddl ?v?(?:ersion )?1 1
cddl-1.0 | cddl | cddl ?v?(?:ersion )?1 0; cddl
cddl | common development | common development and distribution license(?: version 1 [01])?
cpl-1.0 | common public | common public license(?: version 1 0)?
cpal-1.0 | common public attribution | common public attribution license(?: version 1 0)?
ibmpl-1.0 | ibm public | ibm public license(?: version 1 0)?
eupl-1.2 | european union public | european union public licen[cs]e (?:v|version )? ?1 2
eupl-1.1 | european union public | european union public licen[cs]e (?:v|version )? ?1 1
eupl | european union public | european union public licen[cs]e
eupl | eupl | eupl(?: ?v?1 [012])?
cecill-2.1 | cecill | cecill(?: free software license agreement)? (?:v|version )? ?2 1
cecill-b | cecill | cecill b(?: free software license agreement)?
cecill-c | cecill | cecill c(?: free software license agreement)?
cecill | cecill | cecill(?: free software license agreement)?
artistic-2.0 | artistic | artistic license v?(?:ersion )?2(?: 0)?
artistic-1.0 | artistic | artistic license v?(?:ersion )?1(?: 0)?; perl artistic license; clarified artistic license
artistic | artistic | artistic license
perl | same terms as perl | same terms as perl(?: itself)?
python-2.0 | python | python software foundation license(?: version 2)?; psf license; python license 2 0
ruby | ruby licen | ruby licen[cs]e; ruby s license
php-3.01 | php licen | php license(?: version 3 01)?
zpl-2.1 | zope | zope public license(?: zpl)?(?: version 2 1)?
w3c | w3c | w3c software notice and license; w3c software and document license; w3c license
boost-1.0 | boost | boost software license(?: version 1 0)?; boost license
unlicense | unlicense | unlicense; the unlicense
wtfpl | wtfpl | wtfpl(?: version 2)?
wtfpl | do what the | do what the [a-z]+ you want to public license
beerware | beerware | beerware licen[cs]e; beerware
beerware | beer ware | the beer ware licen[cs]e; beer ware licen[cs]e
ncsa | ncsa | university of illinois ncsa open source license; ncsa open source license
ofl-1.1 | open font | sil open font license(?: version 1 1)?; open font license(?: version 1 1)?
ofl-1.0 | open font | sil open font license version 1 0
postgresql | postgresql licen | postgresql licen[cs]e
openssl | openssl licen | openssl licen[cs]e
sleepycat | sleepycat | sleepycat public license; sleepycat license
ssl-eay | ssleay | original ssleay license; ssleay license
curl | curl licen | curl licen[cs]e
icu | icu licen | icu licen[cs]e
unicode | unicode | unicode license(?: agreement)?(?: v3)?; unicode terms of use
ijg | independent jpeg | independent jpeg group license
ftl | freetype | freetype project license; freetype license
tcl | tcl tk | tcl tk license
vim | vim licen | vim licen[cs]e
qpl-1.0 | q public | q public license(?: version 1 0)?
nosl | netizen | netizen open source license
npl-1.1 | netscape public | netscape public license(?: version 1 1)?
nasa-1.3 | nasa open | nasa open source agreement(?: version 1 3)?
osl-3.0 | open software licen | open software license v?(?:ersion )?3 0
osl | open software licen | open software license
afl-3.0 | academic free | academic free license v?(?:ersion )?3 0
afl-2.1 | academic free | academic free license v?(?:ersion )?2 1
afl | academic free | academic free license
rpl-1.5 | reciprocal public | reciprocal public license(?: 1 5)?
ms-pl | microsoft public | microsoft public license
ms-rl | microsoft reciprocal | microsoft reciprocal license
apsl-2.0 | apple public | apple public source license(?: version 2 0)?
sgi-b-2.0 | sgi free | sgi free software license b(?: version 2 0)?
intel-bsd | intel open | intel open source license
upl-1.0 | universal permissive | universal permissive license(?: v?(?:ersion )?1 0)?
bsl-1.1 | business source | business source license(?: 1 1)?
sspl-1.0 | server side public | server side public license(?: version 1| v1)?
elastic-2.0 | elastic licen | elastic license(?: 2 0| v2)?
commons-clause | commons clause | commons clause(?: license condition)?
polyform | polyform | polyform (?:noncommercial|small business|shield|strict|internal use) license
odbl-1.0 | open database | open database license(?: v?1 0)?
odc-by-1.0 | open data commons | open data commons attribution license(?: v?1 0)?
pddl-1.0 | open data commons | open data commons public domain dedication and license
ogl-uk-3.0 | open government | open government licen[cs]e(?: v?(?:ersion )?[123](?: 0)?)?
etalab-2.0 | etalab | etalab (?:open licen[cs]e|licence ouverte)(?: 2 0)?
dl-de-by-2.0 | datenlizenz | datenlizenz deutschland namensnennung(?: version)? 2 0
cdla-permissive | community data | community data license agreement permissive(?: version [12] 0)?
cdla-sharing | community data | community data license agreement sharing(?: version 1 0)?
openrail | openrail | creativeml open ?rail m; bigscience open ?rail m; open ?rail(?: m)?
llama | community licen | llama [234](?: [0-9])? community license(?: agreement)?
gemma | gemma terms | gemma terms of use
cc0-1.0 | cc0 | cc0 1 0(?: universal)?; cc0
cc0-1.0 | creative commons zero | creative commons zero(?: v?1 0)?
cc-by-nc-nd | cc by nc nd | cc by nc nd(?: [1234] [05])?
cc-by-nc-sa | cc by nc sa | cc by nc sa(?: [1234] [05])?
cc-by-nc | cc by nc | cc by nc(?: [1234] [05])?
cc-by-nd | cc by nd | cc by nd(?: [1234] [05])?
cc-by-sa | cc by sa | cc by sa(?: [1234] [05])?
cc-by | cc by | cc by(?: [1234] [05])?
cc-by-nc-nd | creative commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1234] [05])?
cc-by-nc-sa | creative commons | creative commons attribution non ?commercial share ?alike(?: [1234] [05])?
cc-by-nc | creative commons | creative commons attribution non ?commercial(?: [1234] [05])?
cc-by-nd | creative commons | creative commons attribution no ?deriv(?:ative)?s(?: [1234] [05])?
cc-by-sa | creative commons | creative commons attribution share ?alike(?: [1234] [05])?
cc-by | creative commons | creative commons attribution(?: [1234] [05])?
cc | creative commons | creative commons licen[cs]e; creative commons
public-domain | public domain | public domain dedication; released into the public domain; placed in the public domain; dedicated to the public domain
proprietary | all rights reserved | all rights reserved
proprietary | proprietary and confidential | proprietary and confidential
"""

#: label | keyword | rule. Sentences that a license or its header contains.
NOTICES = r"""
mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy
mit | above copyright notice | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | without warranty of any kind | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
bsd | redistributions of source | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | redistributions in binary | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | endorse or promote | neither the names? of .{1,80}? may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
isc | permission to use copy | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0bsd | permission to use copy | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
apache-2.0 | you may not use this file | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 | distributed under the license is | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0 | contributor license agreements | licensed to the apache software foundation asf under one or more contributor license agreements
apache-2.0 | perpetual worldwide | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable
gpl-3.0-or-later | version 3 of the license | under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
gpl-2.0-or-later | version 2 of the license | under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
gpl-2.0-only | version 2 as published | under the terms of the gnu general public license version 2 as published by the free software foundation
gpl-3.0-only | version 3 as published | under the terms of the gnu general public license version 3 as published by the free software foundation
lgpl-3.0-or-later | version 3 of the license | under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
lgpl-2.1-or-later | version 2 1 of the license | under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or (?:at your option )?any later version
agpl-3.0-or-later | version 3 of the license | under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
gpl | you should have received | you should have received a copy of the gnu general public license along with this program
lgpl | you should have received | you should have received a copy of the gnu lesser general public license along with
agpl | you should have received | you should have received a copy of the gnu affero general public license along with
gpl | free software you can | this program is free software you can redistribute it and or modify it
gfdl | permission is granted to copy | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2.0 | source code form is subject | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | copy of the mpl | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1 | subject to the mozilla | the contents of this file are subject to the mozilla public license version 1 1
epl-1.0 | accompanying materials | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
epl-2.0 | accompanying materials | this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
cddl-1.0 | contents of this file | the contents of this file are subject to the terms of the common development and distribution license
boost-1.0 | distributed under the boost | distributed under the boost software license version 1 0
zlib | altered source versions | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib | arising from the use | in no event will the authors be held liable for any damages arising from the use of this software
unlicense | free and unencumbered | this is free and unencumbered software released into the public domain
wtfpl | you just do what | you just do what the [a-z]+ you want to
beerware | buy me a beer | you can buy me a beer in return
cc0-1.0 | waived all copyright | to the extent possible under law .{1,80}? (?:has|have) waived all copyright and related or neighboring rights
cc-by | creative commons attribution | this work is licensed under (?:a|the) creative commons attribution(?: [1234] 0)? (?:international |unported )?license
cc-by-sa | attribution share | this work is licensed under (?:a|the) creative commons attribution share ?alike(?: [1234] 0)? (?:international |unported )?license
cc-by-nc | attribution non | this work is licensed under (?:a|the) creative commons attribution non ?commercial(?: [1234] 0)? (?:international |unported )?license
cc-by-sa | text is available | text is available under the creative commons attribution share ?alike license
ofl-1.1 | open font license | this font software is licensed under the sil open font license version 1 1
artistic-2.0 | standard version | the standard version of the package
python-2.0 | python software foundation | python software foundation license version 2
postgresql | without a written agreement | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
openssl | openssl project | this product includes software developed by the openssl project for use in the openssl toolkit
x11 | in advertising or otherwise | except as contained in this notice the name of .{1,60}? shall not be used in advertising or otherwise to promote the sale
ncsa | deal with the software | to deal with the software without restriction including without limitation the rights to use copy
ms-pl | governs use of the accompanying software | this license governs use of the accompanying software if you use the software you accept this license
public-domain | public domain | this (?:work|file|software|code) is (?:hereby )?(?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | no rights reserved | no rights reserved
proprietary | unauthorized copying | unauthorized copying of this file via any medium is strictly prohibited
proprietary | confidential and proprietary | this (?:software|document|file) is (?:the )?confidential and proprietary
proprietary | may not be reproduced | may not be reproduced (?:or transmitted )?in any form (?:or by any means )?without (?:the )?(?:prior )?written permission
proprietary | end user license agreement | end user license agreement
"""

#: label | keyword | rule. Addresses, as words.
ADDRESSES = r"""
apache-2.0 | apache org | apache org licenses license 2 0
apache-1.1 | apache org | apache org licenses license 1 1
gpl-3.0 | gnu org | gnu org licenses gpl 3 0
gpl-2.0 | gnu org | gnu org licenses (?:old licenses )?gpl 2 0
gpl | gnu org | gnu org (?:licenses|copyleft) gpl
lgpl-3.0 | gnu org | gnu org licenses lgpl 3 0
lgpl-2.1 | gnu org | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl | gnu org | gnu org (?:licenses|copyleft) lgpl
agpl-3.0 | gnu org | gnu org licenses agpl 3 0
agpl | gnu org | gnu org licenses agpl
gfdl | gnu org | gnu org licenses fdl
mpl-2.0 | mozilla org | mozilla org (?:en us )?mpl 2 0
mpl-1.1 | mozilla org | mozilla org mpl 1 1
epl-2.0 | eclipse org | eclipse org legal epl (?:v20|2 0)
epl-1.0 | eclipse org | eclipse org legal epl v10
boost-1.0 | boost org | boost org license 1 0
cc0-1.0 | creativecommons org | creativecommons org publicdomain zero 1 0
public-domain | creativecommons org | creativecommons org publicdomain mark 1 0
cc-by-nc-nd | creativecommons org | creativecommons org licenses by nc nd [1234] [05]
cc-by-nc-sa | creativecommons org | creativecommons org licenses by nc sa [1234] [05]
cc-by-nc | creativecommons org | creativecommons org licenses by nc [1234] [05]
cc-by-nd | creativecommons org | creativecommons org licenses by nd [1234] [05]
cc-by-sa | creativecommons org | creativecommons org licenses by sa [1234] [05]
cc-by | creativecommons org | creativecommons org licenses by [1234] [05]
unlicense | unlicense org | unlicense org
wtfpl | wtfpl net | wtfpl net
mit | opensource org | opensource org licenses? mit
bsd-3-clause | opensource org | opensource org licenses? bsd 3 clause
bsd-2-clause | opensource org | opensource org licenses? bsd 2 clause
isc | opensource org | opensource org licenses? isc
apache-2.0 | opensource org | opensource org licenses? apache 2 0
artistic-2.0 | opensource org | opensource org licenses? artistic 2 0
afl-3.0 | opensource org | opensource org licenses? afl 3 0
osl-3.0 | opensource org | opensource org licenses? osl 3 0
ofl-1.1 | scripts sil org | scripts sil org ofl
ofl-1.1 | openfontlicense org | openfontlicense org
odbl-1.0 | opendatacommons org | opendatacommons org licenses odbl
pddl-1.0 | opendatacommons org | opendatacommons org licenses pddl
odc-by-1.0 | opendatacommons org | opendatacommons org licenses by
eupl-1.2 | joinup ec europa eu | joinup ec europa eu .{0,60}?eupl
python-2.0 | docs python org | docs python org [0-9 ]*license
php-3.01 | php net | php net license 3 01
w3c | w3 org | w3 org consortium legal
sspl-1.0 | mongodb com | mongodb com licensing server side public license
elastic-2.0 | elastic co | elastic co licensing elastic license
bsl-1.1 | mariadb com | mariadb com bsl11
"""

#: Identifiers of the SPDX list that get a rule ``spdx license identifier <words>``.
IDENTIFIERS = """
0BSD AFL-2.1 AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later AGPL-3.0 Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0 Beerware
BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-3-Clause-LBNL BSD-4-Clause BSL-1.0
BUSL-1.1 CAL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0
CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CECILL-B CECILL-C CPAL-1.0 CPL-1.0 ECL-2.0 EFL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2
FTL GFDL-1.1 GFDL-1.2 GFDL-1.3 GPL-1.0-or-later GPL-2.0-only GPL-2.0-or-later GPL-2.0 GPL-3.0-only GPL-3.0-or-later GPL-3.0
HPND ICU IJG IPL-1.0 ISC LGPL-2.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-2.1 LGPL-3.0-only LGPL-3.0-or-later LGPL-3.0
Libpng LPL-1.02 LPPL-1.3c MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NASA-1.3 NCSA NPL-1.1 ODbL-1.0 OFL-1.0
OFL-1.1 OpenSSL OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 RPL-1.5 Ruby SISSL Sleepycat SSPL-1.0 Unlicense
UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1
"""

_STATEMENT = r"(?:(?:re)?licensed|released|distributed|available|published|provided|covered) (?:to you )?under (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?(?:{0})(?: licen[cs]e)?"


def _rows(table: str) -> list[list[str]]:
    return [[x.strip() for x in line.split("|", 2)] for line in table.strip().splitlines()]


def required(rule: str) -> list[str]:
    """Runs of characters that are in whatever ``rule`` matches; what is optional or has a choice ends a run."""
    runs = [""]
    for kind, value in parser.parse(rule):
        if kind is sre.LITERAL:
            runs[-1] += chr(value)
        else:
            runs.append("")
    return [r for r in runs if r]


def _keyword(name: str, key: str) -> str:
    """``key`` where the name can't do without it, else the longest run of its own, the last of equals."""
    runs = required(name)
    return key if any(key in r for r in runs) else max(reversed(runs), key=len)


@lru_cache(maxsize=1)
def rules() -> list[tuple[str, str, tuple[str, ...], re.Pattern]]:
    """(label, tier, keywords, expression), higher tiers first."""
    out = []
    for name in IDENTIFIERS.split():
        words = " ".join(re.findall(r"[0-9a-z]+", name.lower()))
        out.append((name.lower(), "identifier", ("spdx",), rf"spdx license identifier {words}"))
    out += [(label, "address", (key,), rule) for label, key, rule in _rows(ADDRESSES)]
    out += [(label, "notice", (key,), rule) for label, key, rule in _rows(NOTICES)]
    for label, key, names in _rows(NAMES):
        single = [n.strip().replace(",", "") for n in names.split(";")]
        choices, keys = "|".join(single), tuple(sorted({_keyword(n, key) for n in single}))
        if label != "proprietary":
            out.append((label, "statement", keys, _STATEMENT.format(choices)))
        out.append((label, "name", keys, choices))
    return [(label, tier, keys, re.compile(rf"(?<= )(?:{rule})(?= )")) for label, tier, keys, rule in out]


@lru_cache(maxsize=1)
def _gate() -> tuple[ahocorasick.Automaton, dict[str, list[int]]]:
    by_key: dict[str, list[int]] = {}
    for k, (_, _, keys, _) in enumerate(rules()):
        for key in keys:
            by_key.setdefault(key, []).append(k)
    automaton = ahocorasick.Automaton()
    for key in [*by_key, *(phrase for phrase, _ in BASE)]:
        automaton.add_word(key, key)
    automaton.make_automaton()
    return automaton, by_key


def suppressed(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, rule) without those inside another of equal or higher priority. Of equals the first rule stays."""
    table, kept = rules(), []
    starts: list[int] = []
    reach: list[int] = []  # the furthest end of the kept ones up to each start
    for priority in sorted({p for p, _ in TIERS.values()}, reverse=True):
        end = -1
        for d in sorted((d for d in found if TIERS[table[d[2]][1]][0] == priority), key=lambda d: (d[0], -d[1], d[2])):
            before = bisect_right(starts, d[0])
            if d[1] > end and not (before and reach[before - 1] >= d[1]):
                kept.append(d)
            end = max(end, d[1])
        kept.sort()
        starts = [d[0] for d in kept]
        reach = list(accumulate((d[1] for d in kept), max))
    return kept


def scan(text: bytes | None) -> dict:
    words = alnum_words(text or b"")
    body = b" ".join([b"", *words, b""])
    joined = body.decode("latin-1")  # one character per byte
    automaton, by_key = _gate()
    keys = {key for _, key in automaton.iter(joined)}
    out = {"n_words": len(words), "n_base": 0, "first_word": None, "last_word": None, "base_labels": [], "labels": [], "score": 0.0, "detections": []}
    if not keys:
        return out
    places, labels = [], set()
    gaps = np.flatnonzero(np.frombuffer(body, np.uint8) == 0x20)  # word k follows gap k
    for phrase, label in BASE:
        at = joined.find(f" {phrase} ") if phrase in keys else -1
        while at >= 0:
            places.append(int(np.searchsorted(gaps, at)))
            labels.add(label)
            at = joined.find(f" {phrase} ", at + 1)
    table = rules()
    found = [(*m.span(), k) for k in {k for key in keys for k in by_key.get(key, ())} for m in table[k][3].finditer(joined)]
    kept = suppressed(found)
    runs = [(int(np.searchsorted(gaps, a)) - 1, int(np.searchsorted(gaps, b)) - 1) for a, b, _ in kept]
    spans = char_spans(text or b"", runs)
    out["detections"] = [
        {"label": table[k][0], "tier": table[k][1], "first": r[0], "last": r[1], "start": s[0], "end": s[1]} for (_, _, k), r, s in zip(kept, runs, spans)
    ]
    if places:
        out |= {"n_base": len(places), "first_word": min(places), "last_word": max(places), "base_labels": sorted(labels)}
    out["labels"] = sorted(labels | {table[k][0] for _, _, k in kept})
    out["score"] = max([TIERS[table[k][1]][1] for _, _, k in kept], default=TIERS["name"][1] if places else 0.0)
    return out


_WORD_SPAN = [(c, T.LongType()) for c in ("first", "last", "start", "end")]
DETECTION = T.StructType([T.StructField(c, t) for c, t in [("label", T.StringType()), ("tier", T.StringType()), *_WORD_SPAN]])
FOUND = T.StructType(
    [
        *[T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")],
        *[T.StructField(c, T.ArrayType(T.StringType())) for c in ("base_labels", "labels")],
        T.StructField("score", T.DoubleType()),
        T.StructField("detections", T.ArrayType(DETECTION)),
    ]
)


def find_licenses(docs: DataFrame, text: str = "text", out: str = "licenses") -> DataFrame:
    """``docs`` with a struct ``out``: counts, labels, score, detections with words and code points. One narrow pass."""
    return append_columns(docs, [text], T.StructType([T.StructField(out, FOUND)]), lambda texts: [[scan(t) for t in texts]])


def op2_licenses(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_licenses(docs)
    plain = [F.col(f"licenses.{c}").alias(c) for c in ("n_words", "n_base", "first_word", "last_word")]
    return found.select(
        "doc_id",
        *plain,
        F.concat_ws(",", "licenses.base_labels").alias("base_labels"),
        F.concat_ws(",", "licenses.labels").alias("labels"),
        F.col("licenses.score").alias("score"),
        F.transform("licenses.detections", lambda d: F.concat_ws(":", d["label"], d["tier"], d["start"].cast("string"), d["end"].cast("string"))).alias("detections"),
    )
