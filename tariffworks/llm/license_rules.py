"""Signatures of licences, in order of priority.

A line is `label | keyword | pattern`.  Texts are lower-cased words with one space between them, so
`Apache License, Version 2.0` reads `apache license version 2 0`; a pattern stands for whole words.
Every match holds the keyword as a word of its own, so that a rule is tried only on texts that have it.
`<V>` is the space before a number, with or without `version` or `v`; `<G>` is up to eight words.

The sections go from what is surely a licence to mere hints; within a section the special comes
before the general.  What lies within a place found by an earlier rule is not reported.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Sentences that stand in the text of one licence.
TEXTS = """
mit | furnished | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction<G> including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so
mit | hereby | permission is hereby granted free of charge to any person obtaining a copy
mit | substantial | the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software
mit-0 | furnished | permission is hereby granted free of charge<G> to deal in the software without restriction(?: [^ ]+){0,24}? to permit persons to whom the software is furnished to do so the software is provided as is
isc | purpose | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
0bsd | purpose | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-3-clause | endorse | neither the names? of<G> nor the names of(?: its| the| any)? contributors may be used to endorse or promote products derived from this software
bsd-3-clause | endorse | the name of the (?:author|copyright holder)s? may not be used to endorse or promote products
bsd-2-clause | redistributions | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-2-clause | redistributions | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
apache-2.0 | compliance | licensed under the apache license<V>2 0 the license you may not use this file except in compliance with the license
apache-2.0 | irrevocable | subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable
apache-1.1 | acknowledgment | the end user documentation included with the redistribution if any must include the following acknowledgment this product includes software developed by the apache software foundation
gpl-3.0 | free | this program is free software(?: you can redistribute it and or modify it)? under the terms of the gnu general public license as published by the free software foundation either version 3
gpl-2.0 | free | this program is free software(?: you can redistribute it and or modify it)? under the terms of the gnu general public license as published by the free software foundation either version 2
gpl-2.0 | redistribute | you can redistribute it and or modify it under the terms of the gnu general public license(?: as published by the free software foundation)?(?: either)? version 2
gpl-3.0 | redistribute | you can redistribute it and or modify it under the terms of the gnu general public license(?: as published by the free software foundation)?(?: either)? version 3
lgpl-2.1 | redistribute | you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1
lgpl-3.0 | redistribute | you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3
lgpl-2.0 | redistribute | you can redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation
agpl-3.0 | redistribute | you can redistribute it and or modify it under the terms of the gnu affero general public license
gpl | warranty | this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose
gpl-3.0 | copyleft | the gnu general public license is a free copyleft license for software and other kinds of works
gpl-2.0 | share | the licenses for most software are designed to take away your freedom to share and change it
agpl-3.0 | affero | the gnu affero general public license is a free copyleft license for software and other kinds of works
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
epl-2.0 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license(?: v)? 2 0
epl-1.0 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
cddl-1.0 | development | the contents of this file are subject to the terms of the common development and distribution license
unlicense | unencumbered | this is free and unencumbered software released into the public domain
cc0-1.0 | dedicated | the person who associated a work with this deed has dedicated the work to the public domain
cc0-1.0 | affirmer | affirmer hereby overtly fully permanently irrevocably and unconditionally waives
zlib | altered | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
bsl-1.0 | boost | distributed under the boost software license version 1 0
wtfpl | fuck | (?:you )?just do what the fuck you want to
beerware | beer | if we meet some day and you think this stuff is worth it you can buy me a beer
openssl | openssl | this product includes software developed by the openssl project
postgresql | agreement | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
ofl-1.1 | font | this font software is licensed under the sil open font license version 1 1
python-2.0 | psf | psf is making python available to licensee on an as is basis
artistic-2.0 | artistic | you are permitted to use this package under the terms of the artistic license 2 0
gfdl | document | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
ms-pl | accompanying | this license governs use of the accompanying software if you use the software you accept this license
jsr | evil | the software shall be used for good not evil
ncsa | university | permission is hereby granted free of charge to any person<G> university of illinois
curl | stenberg | copyright<G> daniel stenberg<G> permission to use copy modify and distribute this software for any purpose
bigscience-rail | derivatives | you agree not to use the model or derivatives of the model
odbl-1.0 | database | this<G> database is made available under the open database licen[cs]e
public-domain | dedication | we make this dedication for the benefit of the public at large
public-domain | title | no copyright is claimed in the united states under title 17
proprietary | confidential | this (?:document|software|file) (?:contains|is) confidential and proprietary(?: information)?
proprietary | strictly | unauthori[sz]ed (?:copying|reproduction|distribution|use)<G> is strictly prohibited
proprietary | reproduced | no part of this (?:publication|book|document|work|site|website) may be reproduced(?:<G> without<G> permission)?
proprietary | written | without the (?:express )?(?:prior )?written (?:permission|consent) of the (?:publisher|author|copyright (?:holder|owner))
"""

#: Notices that put a work under a licence.
NOTICES = """
mit | mit | (?:licen[cs]ed|released|distributed|available|published) under the(?: terms of the)? mit(?: x11)? licen[cs]e
mit | mit | mit licen[cs]e copyright
mit | expat | (?:licen[cs]ed|released|distributed) under the expat licen[cs]e
apache-2.0 | apache | (?:licen[cs]ed|released|distributed|available) under the(?: terms of the)? apache(?: software)? licen[cs]e<V>2(?: 0)?
apache | apache | (?:licen[cs]ed|released|distributed|available) under the(?: terms of the)? apache(?: software)? licen[cs]e
bsd-3-clause | bsd | (?:licen[cs]ed|released|distributed) under the(?: terms of the)? (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) licen[cs]e
bsd-2-clause | bsd | (?:licen[cs]ed|released|distributed) under the(?: terms of the)? (?:bsd 2 clause|2 clause bsd|simplified bsd) licen[cs]e
bsd-2-clause | freebsd | (?:licen[cs]ed|released|distributed) under the(?: terms of the)? freebsd licen[cs]e
bsd | bsd | use of this source code is governed by a bsd style licen[cs]e
bsd | bsd | (?:licen[cs]ed|released|distributed) under the(?: terms of the)? bsd licen[cs]e
isc | isc | (?:licen[cs]ed|released|distributed) under the(?: terms of the)? isc licen[cs]e
agpl-3.0 | affero | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? affero general public licen[cs]e(?:<V>3(?: 0)?)?
lgpl-3.0 | lesser | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? lesser general public licen[cs]e<V>3(?: 0)?
lgpl-2.1 | lesser | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? lesser general public licen[cs]e<V>2 1
lgpl | lesser | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? lesser general public licen[cs]e
gpl-3.0 | general | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? general public licen[cs]e<V>3(?: 0)?
gpl-2.0 | general | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? general public licen[cs]e<V>2(?: 0)?
gpl-1.0 | general | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? general public licen[cs]e<V>1(?: 0)?
gpl | general | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? general public licen[cs]e
gpl-3.0 | gpl | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? gpl<V>3(?: 0)?
gpl-2.0 | gpl | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? gpl<V>2(?: 0)?
gpl | gpl | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? gpl
lgpl | lgpl | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? lgpl(?:<V>[23](?: [01])?)?
agpl-3.0 | agpl | (?:licen[cs]ed|released|distributed) under the(?: terms of the)?(?: gnu)? agpl(?:<V>3(?: 0)?)?
mpl-2.0 | mozilla | (?:licen[cs]ed|released|distributed) under the(?: terms of the)? mozilla public licen[cs]e<V>2(?: 0)?
mpl | mozilla | (?:licen[cs]ed|released|distributed) under the(?: terms of the)? mozilla public licen[cs]e
epl | eclipse | (?:licen[cs]ed|released|distributed) under the(?: terms of the)? eclipse public licen[cs]e
eupl-1.2 | european | licen[cs]ed under the(?: terms of the)? european union public licen[cs]e
eupl-1.2 | eupl | licen[cs]ed under the(?: terms of the)? eupl
cc-by-nc-nd | cc | (?:licen[cs]ed|released|distributed) under(?: a| the)? cc by nc nd(?: [1-4] [05])?
cc-by-nc-sa | cc | (?:licen[cs]ed|released|distributed) under(?: a| the)? cc by nc sa(?: [1-4] [05])?
cc-by-nc | cc | (?:licen[cs]ed|released|distributed) under(?: a| the)? cc by nc(?: [1-4] [05])?
cc-by-nd | cc | (?:licen[cs]ed|released|distributed) under(?: a| the)? cc by nd(?: [1-4] [05])?
cc-by-sa | cc | (?:licen[cs]ed|released|distributed) under(?: a| the)? cc by sa(?: [1-4] [05])?
cc-by | cc | (?:licen[cs]ed|released|distributed) under(?: a| the)? cc by(?: [1-4] [05])?
cc0-1.0 | cc0 | (?:licen[cs]ed|released|dedicated)<G> under(?: the)? cc0(?: 1 0)?
cc-by-nc-nd | commons | (?:this work )?(?:is )?(?:licen[cs]ed|released) under(?: a| the) creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: works)?(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc-by-nc-sa | commons | (?:this work )?(?:is )?(?:licen[cs]ed|released) under(?: a| the) creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc-by-nc | commons | (?:this work )?(?:is )?(?:licen[cs]ed|released) under(?: a| the) creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc-by-sa | commons | (?:this work )?(?:is )?(?:licen[cs]ed|released) under(?: a| the) creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc-by-nd | commons | (?:this work )?(?:is )?(?:licen[cs]ed|released) under(?: a| the) creative commons attribution no ?deriv(?:ative)?s(?: works)?(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc-by | commons | (?:this work )?(?:is )?(?:licen[cs]ed|released) under(?: a| the) creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc | commons | (?:licen[cs]ed|released|available) under(?: a| the) creative commons licen[cs]e
public-domain | domain | (?:released|placed|dedicated|donated)<G> (?:in|into|to) the public domain
unlicense | unlicense | (?:licen[cs]ed|released|distributed) under the unlicense
wtfpl | wtfpl | (?:licen[cs]ed|released|distributed) under the wtfpl
zlib | zlib | (?:licen[cs]ed|released|distributed) under the(?: terms of the)? zlib(?: libpng)? licen[cs]e
artistic | artistic | (?:licen[cs]ed|distributed) under the(?: terms of the)?(?: perl)? artistic licen[cs]e
perl | perl | (?:redistribute|modify) it under the same terms as perl(?: itself)?
ofl-1.1 | ofl | (?:licen[cs]ed|released) under the(?: sil)? ofl(?: 1 1)?
ogl-uk-3.0 | government | licen[cs]ed under the open government licen[cs]e<V>3(?: 0)?
ogl-uk | government | contains public sector information licen[cs]ed under the open government licen[cs]e
odbl-1.0 | database | (?:licen[cs]ed|available) under the(?: odc)? open database licen[cs]e
cdla-permissive | community | licen[cs]ed under the community data licen[cs]e agreement permissive
sspl-1.0 | server | (?:licen[cs]ed|released) under the(?: terms of the)? server side public licen[cs]e
sspl-1.0 | sspl | (?:licen[cs]ed|released) under the(?: terms of the)? sspl
busl-1.1 | business | (?:licen[cs]ed|released) under the business source licen[cs]e
elastic-2.0 | elastic | (?:licen[cs]ed|released) under the elastic licen[cs]e
commercial | commercial | (?:available|licen[cs]ed) under(?: a| the) commercial licen[cs]e
dual | dual | dual licen[cs]ed under
proprietary | terms | use of this (?:software|site|material|work) is subject to (?:the )?(?:licen[cs]e )?terms
"""

#: Identifiers of licences as they stand after a tag.
TAGS = """
apache-2.0 | spdx | spdx licen[cs]e identifier apache 2 0
mit-0 | spdx | spdx licen[cs]e identifier mit 0
mit | spdx | spdx licen[cs]e identifier mit
gpl-2.0 | spdx | spdx licen[cs]e identifier gpl 2 0(?: only| or later)?
gpl-3.0 | spdx | spdx licen[cs]e identifier gpl 3 0(?: only| or later)?
lgpl-2.1 | spdx | spdx licen[cs]e identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 | spdx | spdx licen[cs]e identifier lgpl 3 0(?: only| or later)?
agpl-3.0 | spdx | spdx licen[cs]e identifier agpl 3 0(?: only| or later)?
bsd-2-clause | spdx | spdx licen[cs]e identifier bsd 2 clause
bsd-3-clause | spdx | spdx licen[cs]e identifier bsd 3 clause
0bsd | spdx | spdx licen[cs]e identifier 0bsd
mpl-2.0 | spdx | spdx licen[cs]e identifier mpl 2 0
epl-2.0 | spdx | spdx licen[cs]e identifier epl 2 0
isc | spdx | spdx licen[cs]e identifier isc
zlib | spdx | spdx licen[cs]e identifier zlib
unlicense | spdx | spdx licen[cs]e identifier unlicense
bsl-1.0 | spdx | spdx licen[cs]e identifier bsl 1 0
cc0-1.0 | spdx | spdx licen[cs]e identifier cc0 1 0
cc-by-sa | spdx | spdx licen[cs]e identifier cc by sa [1-4] [05]
cc-by | spdx | spdx licen[cs]e identifier cc by [1-4] [05]
spdx | spdx | spdx licen[cs]e identifier [^ ]+
cc-by-nc-nd | creativecommons | creativecommons org licenses by nc nd(?: [1-4] [05])?
cc-by-nc-sa | creativecommons | creativecommons org licenses by nc sa(?: [1-4] [05])?
cc-by-nc | creativecommons | creativecommons org licenses by nc(?: [1-4] [05])?
cc-by-nd | creativecommons | creativecommons org licenses by nd(?: [1-4] [05])?
cc-by-sa | creativecommons | creativecommons org licenses by sa(?: [1-4] [05])?
cc-by | creativecommons | creativecommons org licenses by(?: [1-4] [05])?
cc0-1.0 | creativecommons | creativecommons org publicdomain zero(?: 1 0)?
public-domain | creativecommons | creativecommons org publicdomain mark(?: 1 0)?
apache-2.0 | apache | www apache org licenses license 2 0
mit | opensource | opensource org licenses? mit
bsd-3-clause | opensource | opensource org licenses? bsd 3 clause
bsd-2-clause | opensource | opensource org licenses? bsd 2 clause
gpl | gnu | (?:www )?gnu org (?:licenses|copyleft) gpl(?: [123] 0)?
lgpl | gnu | (?:www )?gnu org (?:licenses|copyleft) lgpl(?: [23] [01])?
agpl-3.0 | gnu | (?:www )?gnu org licenses agpl(?: 3 0)?
gfdl | gnu | (?:www )?gnu org (?:licenses|copyleft) fdl(?: 1 [123])?
mpl-2.0 | mozilla | (?:www )?mozilla org mpl 2 0
epl | eclipse | (?:www )?eclipse org legal epl(?: v10| v20| 2 0)?
odbl-1.0 | opendatacommons | opendatacommons org licenses odbl
pddl-1.0 | opendatacommons | opendatacommons org licenses pddl
odc-by-1.0 | opendatacommons | opendatacommons org licenses by
unlicense | unlicense | unlicense org
ofl-1.1 | sil | scripts sil org ofl
"""

#: Names of licences, with their versions where these are given.
NAMES = """
apache-2.0 | apache | apache(?: software)? licen[cs]e<V>2(?: 0)?
apache-1.1 | apache | apache(?: software)? licen[cs]e<V>1 1
apache-1.0 | apache | apache(?: software)? licen[cs]e<V>1 0
apache-2.0 | apache | apache<V>2 0
agpl-3.0 | affero | (?:gnu )?affero general public licen[cs]e(?:<V>3(?: 0)?)?
lgpl-3.0 | lesser | (?:gnu )?lesser general public licen[cs]e<V>3(?: 0)?
lgpl-2.1 | lesser | (?:gnu )?lesser general public licen[cs]e<V>2 1
lgpl-2.0 | library | (?:gnu )?library general public licen[cs]e(?:<V>2(?: 0)?)?
lgpl | lesser | (?:gnu )?lesser general public licen[cs]e
gpl-3.0 | general | (?:gnu )?general public licen[cs]e<V>3(?: 0)?
gpl-2.0 | general | (?:gnu )?general public licen[cs]e<V>2(?: 0)?
gpl-1.0 | general | (?:gnu )?general public licen[cs]e<V>1(?: 0)?
gpl | general | (?:gnu )?general public licen[cs]e
gpl-3.0 | gpl | (?:gnu )?gpl<V>3(?: 0)?(?: only| or later)?
gpl-2.0 | gpl | (?:gnu )?gpl<V>2(?: 0)?(?: only| or later)?
gpl-3.0 | gplv3 | gplv3
gpl-2.0 | gplv2 | gplv2
lgpl-3.0 | lgplv3 | lgplv3
lgpl-2.1 | lgplv2 | lgplv2(?: 1)?
agpl-3.0 | agplv3 | agplv3
lgpl-2.1 | lgpl | lgpl<V>2 1(?: only| or later)?
lgpl-3.0 | lgpl | lgpl<V>3(?: 0)?(?: only| or later)?
agpl-3.0 | agpl | agpl(?:<V>3(?: 0)?)?(?: only| or later)?
gfdl | documentation | (?:gnu )?free documentation licen[cs]e(?:<V>1 [123])?
mit | mit | (?:the )?mit(?: x11)? licen[cs]e
mit | expat | expat licen[cs]e
x11 | x11 | x11 licen[cs]e
bsd-4-clause | bsd | (?:4 clause|original|old) bsd licen[cs]e|bsd 4 clause(?: licen[cs]e)?
bsd-3-clause | bsd | (?:3 clause|new|modified|revised) bsd licen[cs]e|bsd 3 clause(?: licen[cs]e)?
bsd-2-clause | bsd | (?:2 clause|simplified) bsd licen[cs]e|bsd 2 clause(?: licen[cs]e)?
0bsd | bsd | (?:zero clause|0 clause) bsd(?: licen[cs]e)?
bsd | bsd | bsd(?: style| type)? licen[cs]e
isc | isc | isc licen[cs]e
mpl-2.0 | mozilla | mozilla public licen[cs]e<V>2(?: 0)?
mpl-1.1 | mozilla | mozilla public licen[cs]e<V>1 1
mpl | mozilla | mozilla public licen[cs]e
mpl-2.0 | mpl | mpl<V>2(?: 0)?
epl-2.0 | eclipse | eclipse public licen[cs]e<V>2(?: 0)?
epl-1.0 | eclipse | eclipse public licen[cs]e<V>1(?: 0)?
epl | eclipse | eclipse public licen[cs]e
cpl-1.0 | common | common public licen[cs]e(?:<V>1 0)?
ipl-1.0 | ibm | ibm public licen[cs]e(?:<V>1 0)?
cddl-1.0 | development | common development and distribution licen[cs]e(?:<V>1 [01])?
cddl-1.0 | cddl | cddl(?:<V>1 [01])?
eupl-1.2 | european | european union public licen[cs]e(?:<V>1 [12])?
eupl-1.2 | eupl | eupl(?:<V>1 [12])?
cc-by-nc-nd | creative | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: works)?(?: [1-4] [05])?
cc-by-nc-sa | creative | creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?
cc-by-nc | creative | creative commons attribution non ?commercial(?: [1-4] [05])?
cc-by-nd | creative | creative commons attribution no ?deriv(?:ative)?s(?: works)?(?: [1-4] [05])?
cc-by-sa | creative | creative commons attribution share ?alike(?: [1-4] [05])?
cc-by | creative | creative commons attribution(?: [1-4] [05])?
cc0-1.0 | creative | creative commons (?:zero|cc0)(?: 1 0)?
cc-by-nc-nd | cc | cc by nc nd(?: [1-4] [05])?
cc-by-nc-sa | cc | cc by nc sa(?: [1-4] [05])?
cc-by-nc | cc | cc by nc(?: [1-4] [05])?
cc-by-nd | cc | cc by nd(?: [1-4] [05])?
cc-by-sa | cc | cc by sa(?: [1-4] [05])?
cc-by | cc | cc by(?: [1-4] [05])?
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc | creative | (?:a )?creative commons licen[cs]e
unlicense | unlicense | the unlicense
wtfpl | wtfpl | wtfpl
wtfpl | fuck | do what the fuck you want to public licen[cs]e
beerware | beerware | (?:the )?beerware(?: licen[cs]e)?
beerware | beer | the beer ware licen[cs]e
zlib | zlib | zlib(?: libpng)? licen[cs]e
libpng | libpng | libpng licen[cs]e
bsl-1.0 | boost | boost software licen[cs]e(?:<V>1 0)?
artistic-2.0 | artistic | artistic licen[cs]e<V>2(?: 0)?
artistic-1.0 | artistic | artistic licen[cs]e<V>1(?: 0)?
artistic | artistic | (?:perl )?artistic licen[cs]e
python-2.0 | python | python(?: software foundation)? licen[cs]e
php-3.01 | php | php licen[cs]e(?:<V>3(?: 0| 01)?)?
ruby | ruby | ruby licen[cs]e
postgresql | postgresql | postgresql licen[cs]e
openssl | openssl | openssl licen[cs]e
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[cs]e
ofl-1.1 | sil | sil open font licen[cs]e(?:<V>1 1)?
ms-pl | microsoft | microsoft public licen[cs]e
ms-rl | microsoft | microsoft reciprocal licen[cs]e
apsl-2.0 | apple | apple public source licen[cs]e(?:<V>[12] [012])?
upl-1.0 | universal | universal permissive licen[cs]e(?:<V>1 0)?
afl-3.0 | academic | academic free licen[cs]e(?:<V>[123] [01])?
osl-3.0 | open | open software licen[cs]e(?:<V>[123] [01])?
rpl-1.5 | reciprocal | reciprocal public licen[cs]e(?:<V>1 [15])?
qpl-1.0 | public | q public licen[cs]e(?:<V>1 0)?
lppl-1.3c | latex | latex project public licen[cs]e(?:<V>1 [0-3]c?)?
cecill-2.1 | cecill | cecill(?: [abc])?(?: 2 [01])?(?: free software)?(?: licen[cs]e)?
mulanpsl-2.0 | mulan | mulan permissive software licen[cs]e(?:<V>2)?
blueoak-1.0.0 | blue | blue oak model licen[cs]e(?:<V>1 0 0)?
odbl-1.0 | database | open database licen[cs]e(?:<V>1 0)?
odc-by-1.0 | commons | open data commons attribution licen[cs]e(?:<V>1 0)?
pddl-1.0 | commons | open data commons public domain dedication(?: and)? licen[cs]e
cdla-sharing | community | community data licen[cs]e agreement sharing
cdla-permissive | community | community data licen[cs]e agreement permissive
ogl-uk | government | open government licen[cs]e(?:<V>[123](?: 0)?)?
etalab-2.0 | ouverte | licence ouverte(?:<V>2(?: 0)?)?
sspl-1.0 | server | server side public licen[cs]e(?:<V>1)?
busl-1.1 | business | business source licen[cs]e(?:<V>1 [01])?
elastic-2.0 | elastic | elastic licen[cs]e(?:<V>2(?: 0)?)?
polyform-nc | polyform | polyform non ?commercial licen[cs]e
openrail-m | openrail | (?:big ?science |creative ml )?openrail(?: m)?(?: licen[cs]e)?
llama-community | community | llama(?: [234])?(?: [0-9])? community licen[cs]e(?: agreement)?
hippocratic | hippocratic | hippocratic licen[cs]e(?:<V>[123] [01])?
classpath-exception | classpath | with(?: the)? classpath exception
linking-exception | linking | with(?: a| the)?<G> linking exception
"""

#: Wording of copyright that names no licence.
HINTS = """
reserved | reserved | (?:all|some|certain) rights? reserved
reserved | derechos | todos los derechos reservados
reserved | droits | tous droits reserves|tous droits réservés
reserved | rechte | alle rechte vorbehalten
reserved | diritti | tutti i diritti riservati
copyright | copyright | copyright(?: c| ©)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2}| present)?(?: by)?
copyright | copyright | copyright(?: c| ©)?(?: by| of| holders?| owners?| notice)
copyright | © | © (?:19|20)[0-9]{2}
public-domain | domain | (?:in|into|under) the public domain
public-domain | domain | public domain (?:mark|dedication|work|software)
copyleft | copyleft | copyleft(?: licen[cs]e)?
open-source | source | open source licen[cs]e
permissive | permissive | permissive licen[cs]e
freeware | freeware | (?:this is |is )?freeware
shareware | shareware | (?:this is |is )?shareware
commercial | commercial | (?:for )?non commercial use only|commercial use (?:is )?(?:prohibited|not (?:allowed|permitted))
commercial | noncommercial | (?:for )?noncommercial use only
commercial | commercial | commercial licen[cs]e(?: agreement)?
eula | eula | (?:this )?eula
eula | user | end user licen[cs]e agreement
proprietary | proprietary | proprietary(?: and confidential| licen[cs]e| software)
royalty-free | royalty | royalty free(?: licen[cs]e)?
trademark | trademark | (?:registered )?trademark of
trademark | trademarks | (?:registered )?trademarks of
terms | terms | (?:subject to|see|under) the licen[cs]e terms
disclaimer | merchantability | implied warrant(?:y|ies) of merchantability
disclaimer | warranty | (?:provided )?as is without (?:any )?(?:express or implied )?warranty(?: of any kind)?
disclaimer | liable | in no event shall<G> be liable
licensed | licensed | licensed (?:under|to|by)
licensed | licence | (?:see|read)(?: the)?(?: file)? licence(?: file| txt| md)? for (?:details|more information|the full)
licensed | license | (?:see|read)(?: the)?(?: file)? license(?: file| txt| md)? for (?:details|more information|the full)
licensed | copying | (?:see|read)(?: the)?(?: file)? copying(?: file| txt| md)? for (?:details|more information|the full)
"""

#: What a match of each section is worth, from 0 to 1.
SECTIONS = ((TEXTS, 1.0), (TAGS, 0.95), (NOTICES, 0.9), (NAMES, 0.7), (HINTS, 0.3))
_VERSION = "(?: version| ver| v)? v?"
_GAP = "(?: [^ ]+){0,8}?"


@dataclass(frozen=True)
class Rule:
    """A signature; `pattern` matches the words of a text between single spaces."""

    priority: int
    label: str
    keyword: bytes
    pattern: re.Pattern[bytes]
    worth: float


def rules(sections=SECTIONS) -> list[Rule]:
    """All rules, the most telling first."""
    out = []
    for text, worth in sections:
        for line in text.strip().splitlines():
            label, keyword, pattern = (part.strip() for part in line.split("|", 2))
            words = pattern.replace("<V>", _VERSION).replace("<G>", _GAP)
            out.append(Rule(len(out), label, keyword.encode(), re.compile(f"(?<= )(?:{words})(?= )".encode()), worth))
    return out
