"""Signatures of licences, written by hand over normalised words.

A line is ``label | regular expression``.  Texts are matched as lower-case words with
one space between them, so ``v2.0`` is ``v2 0``.  ``@under`` stands for the words that
introduce a licence, ``#n`` for up to n words in between.
Sections go from the most to the least specific; within a section the earlier
rule wins where two match the same words.
"""

from __future__ import annotations

#: Sections and how sure a match makes that the text is under a licence.
TIERS = {"text": 0.95, "tag": 0.9, "notice": 0.8, "name": 0.5, "hint": 0.2}

FRAGMENTS = {
    "@under": r"(?:under|by|on|per|to|with) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?",
    "@v": r"(?:v|version |v )?",
}

RULES = {
    "text": r"""
mit | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
mit | the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software
mit | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit-0 | to permit persons to whom the software is furnished to do so the software is provided as is
isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
0bsd | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
isc | the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness
bsd-4-clause | all advertising materials mentioning features or use of this software must display the following acknowledg[e]?ment
bsd-3-clause | neither the names? of #12 may be used to endorse or promote products derived from this software
bsd-2-clause | redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd-2-clause | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause-clear | no express or implied licenses to any party s patent rights are granted by this license
apache-2 | you may not use this file except in compliance with the license you may obtain a copy of the license at
apache-2 | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2 | license shall mean the terms and conditions for use reproduction and distribution as defined by sections
apache-1.1 | the end user documentation included with the redistribution if any must include the following acknowledg[e]?ment
gpl-3 | redistribute it and or modify it under the terms of the gnu general public license #10 (?:either )?version 3
gpl-2 | redistribute it and or modify it under the terms of the gnu general public license #10 (?:either )?version 2
lgpl-3 | redistribute it and or modify it under the terms of the gnu lesser general public license #10 (?:either )?version 3
lgpl-2.1 | redistribute it and or modify it under the terms of the gnu lesser general public license #10 (?:either )?version 2 1
lgpl-2 | redistribute it and or modify it under the terms of the gnu library general public license #10 (?:either )?version 2
agpl-3 | redistribute it and or modify it under the terms of the gnu affero general public license #10 (?:either )?version 3
gpl | you should have received a copy of the gnu general public license along with
lgpl | you should have received a copy of the gnu (?:lesser|library) general public license along with
agpl | you should have received a copy of the gnu affero general public license along with
gpl-3 | gnu general public license version 3 29 june 2007
gpl-2 | gnu general public license version 2 june 1991
gpl-1 | gnu general public license version 1 february 1989
lgpl-3 | gnu lesser general public license version 3 29 june 2007
lgpl-2.1 | gnu lesser general public license version 2 1 february 1999
agpl-3 | gnu affero general public license version 3 19 november 2007
gfdl-1.3 | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3
gfdl-1.2 | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 2
gfdl | with no invariant sections no front cover texts and no back cover texts
mpl-2 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | the contents of this file are subject to the mozilla public license version 1 1
mpl | the contents of this file are subject to the mozilla public license
epl-2 | (?:this program and the )?accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0
epl-1 | (?:this program and the )?accompanying materials are made available under the terms of the eclipse public license v1 0
cddl-1 | the contents of this file are subject to the terms of the common development and distribution license
unlicense | this is free and unencumbered software released into the public domain
unlicense | dedicate any and all copyright interest in the software to the public domain
wtfpl | do what the fuck you want to
zlib | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
bsl-1 | to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
artistic-2 | this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed
ofl-1.1 | the font software may be sold as part of a larger software package
ofl-1.1 | this font software is licensed under the sil open font license
cc0 | has waived all copyright and related or neighboring rights
cc0 | to the extent possible under law #12 copyright and related or neighboring rights
cc-by | you are free to share copy and redistribute the material in any medium or format adapt remix transform and build upon
openssl | this product includes software developed by the openssl project
python-2 | psf hereby grants licensee a nonexclusive royalty free world wide license
postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
x11 | except as contained in this notice the name of the x consortium shall not be used in advertising
ncsa | neither the names of #16 may be used to endorse or promote products derived from this software without specific prior written permission
ms-pl | each contributor grants you a non exclusive worldwide royalty free copyright license to reproduce its contribution
beerware | if we meet some day and you think this stuff is worth it you can buy me a beer
vim | vim is charityware
hpnd | permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
""",
    "tag": r"""
mit | spdx license identifier mit
mit-0 | spdx license identifier mit 0
apache-2 | spdx license identifier apache 2 0
bsd-2-clause | spdx license identifier bsd 2 clause
bsd-3-clause | spdx license identifier bsd 3 clause
0bsd | spdx license identifier 0bsd
isc | spdx license identifier isc
gpl-2 | spdx license identifier gpl 2 0(?: only| or later)?
gpl-3 | spdx license identifier gpl 3 0(?: only| or later)?
lgpl-2.1 | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3 | spdx license identifier lgpl 3 0(?: only| or later)?
agpl-3 | spdx license identifier agpl 3 0(?: only| or later)?
mpl-2 | spdx license identifier mpl 2 0
epl-2 | spdx license identifier epl 2 0
epl-1 | spdx license identifier epl 1 0
cc0 | spdx license identifier cc0 1 0
cc-by | spdx license identifier cc by [1-4] [05]
cc-by-sa | spdx license identifier cc by sa [1-4] [05]
cc-by-nc | spdx license identifier cc by nc [1-4] [05]
unlicense | spdx license identifier unlicense
zlib | spdx license identifier zlib
bsl-1 | spdx license identifier bsl 1 0
wtfpl | spdx license identifier wtfpl
apache-2 | (?:www )?apache org licenses license 2 0
mit | (?:www )?opensource org licenses mit(?: license(?: php| html)?)?
bsd-3-clause | (?:www )?opensource org licenses bsd 3 clause
bsd-2-clause | (?:www )?opensource org licenses bsd 2 clause
isc | (?:www )?opensource org licenses isc
gpl-3 | (?:www )?gnu org licenses gpl 3 0
gpl-2 | (?:www )?gnu org licenses (?:old licenses )?gpl 2 0
gpl | (?:www )?gnu org licenses gpl
lgpl | (?:www )?gnu org licenses lgpl
agpl-3 | (?:www )?gnu org licenses agpl(?: 3 0)?
gfdl | (?:www )?gnu org licenses fdl
mpl-2 | (?:www )?mozilla org (?:en us )?mpl 2 0
epl-2 | (?:www )?eclipse org legal epl (?:v20|2 0)
cc0 | creativecommons org publicdomain zero
pdm | creativecommons org publicdomain mark
cc-by | creativecommons org licenses by [1-4]
cc-by-sa | creativecommons org licenses by sa
cc-by-nd | creativecommons org licenses by nd
cc-by-nc | creativecommons org licenses by nc [1-4]
cc-by-nc-sa | creativecommons org licenses by nc sa
cc-by-nc-nd | creativecommons org licenses by nc nd
unlicense | unlicense org
ofl-1.1 | scripts sil org ofl
wtfpl | (?:www )?wtfpl net
odbl | opendatacommons org licenses odbl
odc-by | opendatacommons org licenses by
pddl | opendatacommons org licenses pddl
""",
    "notice": r"""
mit | (?:licen[cs]ed|released|distributed|available|published|provided) @under(?:mit|expat) license
mit | unter (?:der )?mit lizenz
mit | sous (?:la )?licence mit
mit | bajo (?:la )?licencia mit
mit | license mit
apache-2 | (?:licen[cs]ed|released|distributed|available|published|provided) @underapache (?:software )?license @v2(?: 0)?
apache-2 | @underapache 2(?: 0)?(?: license)?
apache-2 | unter (?:der )?apache lizenz(?: version)? 2(?: 0)?
apache-2 | sous (?:la )?licence apache(?: version)? 2(?: 0)?
apache-2 | bajo (?:la )?licencia apache(?: versión)? 2(?: 0)?
apache-1.1 | @underapache (?:software )?license @v1 1
gpl-3 | @undergnu general public licen[cs]e #2 ?@v3(?: 0)?(?: or (?:any )?later)?
gpl-3 | @under(?:gnu )?gpl @v3(?: 0)?
gpl-3 | @under(?:gnu )?gplv3
gpl-2 | @undergnu general public licen[cs]e @v2(?: 0)?(?: or (?:any )?later)?
gpl-2 | @under(?:gnu )?gpl @v2(?: 0)?
gpl-2 | @under(?:gnu )?gplv2
gpl | @undergnu general public licen[cs]e
gpl | @under(?:gnu )?gpl(?: license)?
lgpl-3 | @undergnu lesser general public licen[cs]e @v3(?: 0)?
lgpl-2.1 | @undergnu lesser general public licen[cs]e @v2 1
lgpl-3 | @under(?:gnu )?lgplv3
lgpl | @under(?:gnu )?lgpl(?: license)?
lgpl | @undergnu lesser general public licen[cs]e
agpl-3 | @undergnu affero general public licen[cs]e @v3(?: 0)?
agpl-3 | @under(?:gnu )?agplv3
agpl | @undergnu affero general public licen[cs]e
agpl | @under(?:gnu )?agpl
gpl | unter (?:der )?gnu general public lizenz
gpl | sous (?:la )?licence publique générale gnu
gpl | bajo (?:la )?licencia pública general (?:de )?gnu
mpl-2 | @undermozilla public licen[cs]e @v2(?: 0)?
mpl-1.1 | @undermozilla public licen[cs]e @v1 1
mpl | @undermozilla public licen[cs]e
epl-2 | @undereclipse public licen[cs]e @v2(?: 0)?
epl-1 | @undereclipse public licen[cs]e @v1(?: 0)?
epl | @undereclipse public licen[cs]e
eupl-1.2 | @undereuropean union public licen[cs]e(?: @v1 2)?
eupl-1.2 | @undereupl(?: v1 2| 1 2)?
bsd-2-clause | @under(?:simplified )?bsd 2 clause(?: license)?
bsd-3-clause | @under(?:modified |new )?bsd 3 clause(?: license)?
bsd-2-clause | @under(?:simplified|freebsd|2 clause) bsd(?: style)? license
bsd-3-clause | @under(?:modified|new|revised|3 clause) bsd(?: style)? license
bsd | @underbsd(?: style)? license
isc | @underisc license
zlib | @underzlib(?: libpng)? license
bsl-1 | @underboost software license(?: @v1 0)?
unlicense | @underunlicense
wtfpl | @underwtfpl
artistic-2 | @underartistic license @v2(?: 0)?
artistic | @underartistic license
perl | under the same terms as perl itself
python-2 | @underpython software foundation license
php-3 | @underphp license(?: @v3(?: 01?)?)?
postgresql | @underpostgresql license
ofl-1.1 | @undersil open font license
cddl-1 | @undercddl
cpl-1 | @undercommon public license
ms-pl | @undermicrosoft public license
ms-rl | @undermicrosoft reciprocal license
ncsa | @underuniversity of illinois ncsa open source license
upl-1 | @underuniversal permissive license
busl-1.1 | @underbusiness source license(?: @v1 1)?
sspl-1 | @underserver side public license
elastic-2 | @underelastic license(?: @v2(?: 0)?)?
odbl | @underopen (?:data commons open )?database license
odc-by | @underopen data commons attribution license
cc0 | @under(?:creative commons )?cc0(?: 1 0)?(?: universal)?
cc-by-nc-nd | @under(?:a )?(?:creative commons )?(?:cc )?by nc nd(?: [1-4] [05])?
cc-by-nc-sa | @under(?:a )?(?:creative commons )?(?:cc )?by nc sa(?: [1-4] [05])?
cc-by-nc | @under(?:a )?(?:creative commons )?(?:cc )?by nc(?: [1-4] [05])?
cc-by-sa | @under(?:a )?(?:creative commons )?cc by sa(?: [1-4] [05])?
cc-by-nd | @under(?:a )?(?:creative commons )?cc by nd(?: [1-4] [05])?
cc-by | @under(?:a )?(?:creative commons )?cc by(?: [1-4] [05])?
cc-by-nc-nd | creative commons attribution non ?commercial no ?deriv(?:ative)?s
cc-by-nc-sa | creative commons attribution non ?commercial share ?alike
cc-by-nc | creative commons attribution non ?commercial
cc-by-nc | creative commons attribution non commercial
cc-by-sa | creative commons attribution share ?alike
cc-by-nd | creative commons attribution no ?deriv(?:ative)?s
cc-by | creative commons attribution(?: [1-4] [05])?(?: international)?(?: license)?
ogl-uk-3 | @underopen government licen[cs]e(?: v3 0)?
llama | @underllama #3 community license
openrail | @under(?:creativeml |bigscience )?openrail(?: m)?(?: license)?
openrail | @under(?:creativeml |bigscience )?open rail(?: m)?(?: license)?
proprietary | @under(?:a )?proprietary license
""",
    "name": r"""
mit | (?:the )?mit license
mit | (?:the )?expat license
apache-2 | apache (?:software )?license @v2(?: 0)?
apache | apache (?:software )?license
gpl-3 | gnu general public licen[cs]e @v3(?: 0)?
gpl-2 | gnu general public licen[cs]e @v2(?: 0)?
gpl | gnu general public licen[cs]e
gpl-3 | gplv3
gpl-2 | gplv2
gpl-3 | gpl 3 0
gpl-2 | gpl 2 0
lgpl | gnu (?:lesser|library) general public licen[cs]e
lgpl-2.1 | lgpl @v2 1
lgpl-3 | lgpl @v3(?: 0)?
agpl-3 | agpl @v3(?: 0)?
agpl | gnu affero general public licen[cs]e
gfdl | gnu free documentation licen[cs]e
mpl-2 | mozilla public licen[cs]e @v2(?: 0)?
mpl | mozilla public licen[cs]e
epl | eclipse public licen[cs]e
eupl-1.2 | european union public licen[cs]e
cddl-1 | common development and distribution license
bsd-2-clause | bsd 2 clause(?: license)?
bsd-3-clause | bsd 3 clause(?: license)?
bsd | bsd license
isc | (?:the )?isc license
zlib | zlib license
bsl-1 | boost software license
artistic | artistic license
ofl-1.1 | (?:sil )?open font license
python-2 | psf license
openssl | openssl license
wtfpl | wtfpl
odbl | open database license
cc0 | cc0 1 0(?: universal)?
cc-by-nc-nd | cc by nc nd(?: [1-4] [05])?
cc-by-nc-sa | cc by nc sa(?: [1-4] [05])?
cc-by-nc | cc by nc [1-4] [05]
cc-by-sa | cc by sa(?: [1-4] [05])?
cc-by-nd | cc by nd(?: [1-4] [05])?
cc-by | cc by [1-4] [05]
public-domain | (?:released|dedicated|placed|is) (?:in|to|into) the public domain
busl-1.1 | business source license
sspl-1 | server side public license
cecill-2 | cecill(?: license)?(?: @v2(?: 1)?)?
""",
    "hint": r"""
all-rights-reserved | all rights reserved
all-rights-reserved | alle rechte vorbehalten
all-rights-reserved | tous droits réservés
all-rights-reserved | todos los derechos reservados
proprietary | proprietary and confidential
other-license | licensed under #4 license
other-license | see (?:the )?license file
other-license | (?:an |permissive )open source license
other-license | dual licensed
other-permissive | permission (?:is granted )?to copy #6 is (?:hereby )?granted
""",
}

#: Phrases whose every place is kept, whatever stands around it.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
