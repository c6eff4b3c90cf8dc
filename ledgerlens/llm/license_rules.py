"""Hand-written signature rules for license texts and mentions.

Rules are tried in this order; a smaller number is a higher priority:
10 tags (SPDX-License-Identifier, Creative Commons and GNU addresses), 20 sentences of license
texts, 30 grants ("licensed under the ..."), 40 names, 90 base phrases. All regexes read
lower-cased text. ``words``: of these at least one of each group must be among the text's words
(runs of a-z and 0-9, also without a version at their end: gplv3 holds gpl), or the rule is not
tried. Every match holds them, so rules without ``words`` would find the same.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    score: float
    words: tuple[frozenset[str], ...]
    regex: str


# The base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Label; SPDX identifier as a regex; the name as people write it, as a regex; a word that any
# mention holds.
FAMILIES = (
    ("mit", r"mit", r"(?:mit|expat)(?: \(?expat\)?)?", "mit"),
    ("mit-0", r"mit-0", r"mit(?: no attribution|-0)", "mit"),
    ("x11", r"x11", r"x11", "x11"),
    ("apache-1.1", r"apache-1\.1", r"apache(?: software)? license,? ?(?:version|v)?\.? ?1\.1|apache(?: software)?,? ?(?:version|v)?\.? ?1\.1", "apache"),
    ("apache-2.0", r"apache-2\.0", r"apache(?: software)?[ -]license,?[ -]?(?:version|v)?\.? ?2(?:\.0)?|apache(?: software)?,?[ -]?(?:version|v)?\.? ?2(?:\.0)?", "apache"),
    ("bsd-1-clause", r"bsd-1-clause", r"(?:1|one)[ -]clause bsd", "bsd"),
    ("bsd-2-clause", r"bsd-2-clause", r"(?:(?:2|two)[ -]clause|simplified|freebsd) bsd|bsd[ -](?:2|two)[ -]clause", "bsd"),
    ("bsd-3-clause", r"bsd-3-clause", r"(?:(?:3|three)[ -]clause|new|modified|revised) bsd|bsd[ -](?:3|three)[ -]clause", "bsd"),
    ("bsd-4-clause", r"bsd-4-clause", r"(?:(?:4|four)[ -]clause|original|old) bsd|bsd[ -](?:4|four)[ -]clause", "bsd"),
    ("0bsd", r"0bsd", r"(?:zero|0)[ -]clause bsd|0bsd", "0bsd"),
    ("gpl-1.0", r"gpl-1\.0(?:-only|-or-later|\+)?", r"(?<!lesser\s)(?<!library\s)(?<!affero\s)(?:gnu )?(?:gpl|general public license),?[ -]?(?:version |v)?1(?:\.0)?", "gpl"),
    ("gpl-2.0", r"gpl-2\.0(?:-only|-or-later|\+)?", r"(?<!lesser\s)(?<!library\s)(?<!affero\s)(?:gnu )?(?:gpl|general public license),?[ -]?(?:version |v)?2(?:\.0)?", "gpl"),
    ("gpl-3.0", r"gpl-3\.0(?:-only|-or-later|\+)?", r"(?<!lesser\s)(?<!library\s)(?<!affero\s)(?:gnu )?(?:gpl|general public license),?[ -]?(?:version |v)?3(?:\.0)?", "gpl"),
    ("lgpl-2.0", r"lgpl-2\.0(?:-only|-or-later|\+)?", r"(?:gnu )?(?:lgpl|library general public license),?[ -]?(?:version |v)?2(?:\.0)?(?!\.?\d)", "lgpl"),
    ("lgpl-2.1", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"(?:gnu )?(?:lgpl|lesser general public license),?[ -]?(?:version |v)?2\.1", "lgpl"),
    ("lgpl-3.0", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu )?(?:lgpl|lesser general public license),?[ -]?(?:version |v)?3(?:\.0)?", "lgpl"),
    ("agpl-3.0", r"agpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu )?(?:agpl|affero general public license),?[ -]?(?:version |v)?3(?:\.0)?", "agpl"),
    ("gfdl-1.3", r"gfdl-1\.3(?:-only|-or-later)?", r"(?:gnu )?free documentation license", "gfdl"),
    ("mpl-1.1", r"mpl-1\.1", r"(?:mozilla public license|mpl),? ?(?:version |v)?1\.1", "mpl"),
    ("mpl-2.0", r"mpl-2\.0", r"(?:mozilla public license|mpl),? ?(?:version |v)?2(?:\.0)?", "mpl"),
    ("epl-1.0", r"epl-1\.0", r"(?:eclipse public license|epl)(?: -)?,? ?(?:version |v)?1(?:\.0)?", "epl"),
    ("epl-2.0", r"epl-2\.0", r"(?:eclipse public license|epl)(?: -)?,? ?(?:version |v)?2(?:\.0)?", "epl"),
    ("edl-1.0", r"edl-1\.0", r"eclipse distribution license", "edl"),
    ("cddl-1.0", r"cddl-1\.0", r"(?:common development and distribution license|cddl)", "cddl"),
    ("cpl-1.0", r"cpl-1\.0", r"common public license", "cpl"),
    ("isc", r"isc", r"isc", "isc"),
    ("zlib", r"zlib", r"zlib(?:/libpng)?", "zlib"),
    ("libpng-2.0", r"libpng-2\.0", r"libpng", "libpng"),
    ("bsl-1.0", r"bsl-1\.0", r"boost software license", "boost"),
    ("unlicense", r"unlicense", r"unlicense", "unlicense"),
    ("wtfpl", r"wtfpl", r"wtfpl|do what the f\S* you want to public license", "wtfpl"),
    ("cc0-1.0", r"cc0-1\.0", r"cc0(?:[ -]1\.0)?(?: universal)?", "cc0"),
    ("cc-by-3.0", r"cc-by-3\.0", r"(?:cc[ -]by|creative commons attribution)[ -]?3\.0", "cc"),
    ("cc-by-4.0", r"cc-by-4\.0", r"(?:cc[ -]by|creative commons attribution)[ -]?4\.0", "cc"),
    ("cc-by-sa-3.0", r"cc-by-sa-3\.0", r"(?:cc[ -]by-sa|creative commons attribution[- ]share-?alike)[ -]?3\.0", "cc"),
    ("cc-by-sa-4.0", r"cc-by-sa-4\.0", r"(?:cc[ -]by-sa|creative commons attribution[- ]share-?alike)[ -]?4\.0", "cc"),
    ("cc-by-nc-3.0", r"cc-by-nc-3\.0", r"(?:cc[ -]by-nc|creative commons attribution[- ]non-?commercial)[ -]?3\.0", "cc"),
    ("cc-by-nc-4.0", r"cc-by-nc-4\.0", r"(?:cc[ -]by-nc|creative commons attribution[- ]non-?commercial)[ -]?4\.0", "cc"),
    ("cc-by-nd-4.0", r"cc-by-nd-4\.0", r"(?:cc[ -]by-nd|creative commons attribution[- ]no-?derivatives)[ -]?4\.0", "cc"),
    ("cc-by-nc-sa-4.0", r"cc-by-nc-sa-4\.0", r"cc[ -]by-nc-sa[ -]?4\.0", "cc"),
    ("cc-by-nc-nd-4.0", r"cc-by-nc-nd-4\.0", r"cc[ -]by-nc-nd[ -]?4\.0", "cc"),
    ("odbl-1.0", r"odbl-1\.0", r"open (?:data commons )?(?:open )?database license|odbl", "odbl"),
    ("odc-by-1.0", r"odc-by-1\.0", r"open data commons attribution license|odc-by", "odc"),
    ("pddl-1.0", r"pddl-1\.0", r"public domain dedication and license|pddl", "pddl"),
    ("artistic-1.0", r"artistic-1\.0", r"artistic license,? ?(?:version |v)?1(?:\.0)?", "artistic"),
    ("artistic-2.0", r"artistic-2\.0", r"artistic license,? ?(?:version |v)?2(?:\.0)?", "artistic"),
    ("psf-2.0", r"psf-2\.0|python-2\.0", r"python software foundation license|psf license", "python"),
    ("ofl-1.1", r"ofl-1\.1", r"(?:sil )?open font license|ofl", "ofl"),
    ("eupl-1.2", r"eupl-1\.2", r"european union public licen[cs]e|eupl", "eupl"),
    ("cecill-2.1", r"cecill-2\.1", r"cecill(?:-[bc])?", "cecill"),
    ("ms-pl", r"ms-pl", r"microsoft public license|ms-pl", "microsoft"),
    ("ms-rl", r"ms-rl", r"microsoft reciprocal license|ms-rl", "reciprocal"),
    ("osl-3.0", r"osl-3\.0", r"open software license,? ?(?:version |v)?3(?:\.0)?", "osl"),
    ("afl-3.0", r"afl-3\.0", r"academic free license", "afl"),
    ("ecl-2.0", r"ecl-2\.0", r"educational community license", "ecl"),
    ("ncsa", r"ncsa", r"(?:university of illinois/)?ncsa(?: open source)?", "ncsa"),
    ("postgresql", r"postgresql", r"postgresql", "postgresql"),
    ("php-3.01", r"php-3\.01", r"php license", "php"),
    ("ruby", r"ruby", r"ruby license", "ruby"),
    ("vim", r"vim", r"vim license", "vim"),
    ("openssl", r"openssl", r"openssl license", "openssl"),
    ("curl", r"curl", r"curl license", "curl"),
    ("w3c", r"w3c", r"w3c software (?:notice and )?license", "w3c"),
    ("upl-1.0", r"upl-1\.0", r"universal permissive license", "upl"),
    ("blueoak-1.0.0", r"blueoak-1\.0\.0", r"blue oak model license", "oak"),
    ("sspl-1.0", r"sspl-1\.0", r"server side public license|sspl", "sspl"),
    ("busl-1.1", r"busl-1\.1", r"business source license", "busl"),
    ("elastic-2.0", r"elastic-2\.0", r"elastic license(?: 2\.0)?", "elastic"),
    ("json", r"json", r"json license", "json"),
    ("beerware", r"beerware", r"beer-?ware license", "beerware"),
    ("hpnd", r"hpnd", r"historical permission notice and disclaimer", "hpnd"),
    ("ntp", r"ntp", r"ntp license", "ntp"),
    ("intel", r"intel", r"intel open source license", "intel"),
    ("nasa-1.3", r"nasa-1\.3", r"nasa open source agreement", "nasa"),
)

# Label, words that must occur, regex: sentences and addresses that only one license has.
SENTENCES = (
    ("mit", "hereby granted charge", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "above copyright notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("isc", "permission modify fee", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution binary forms", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd-3-clause", "neither endorse", r"neither the name of .{1,120}? nor the names of its contributors may be used to endorse or promote"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "file except compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", "apache org", r"(?:www\.)?apache\.org/licenses/license-2\.0"),
    ("gpl", "redistribute gnu", r"you can redistribute it and/or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute lesser", r"you can redistribute it and/or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "redistribute affero", r"you can redistribute it and/or modify it under the terms of the gnu affero general public license"),
    ("gpl", "gnu org", r"(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?gpl"),
    ("lgpl", "gnu org", r"(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?lgpl"),
    ("agpl", "gnu org", r"(?:www\.)?gnu\.org/licenses/agpl"),
    ("mpl-2.0", "mozilla source", r"this source code form is subject to the terms of the mozilla public license, v\. 2\.0"),
    ("mpl-2.0", "mozilla org", r"(?:www\.)?mozilla\.org/mpl/2\.0"),
    ("epl", "available eclipse", r"made available under the terms of the eclipse public license"),
    ("bsl-1.0", "boost org", r"(?:www\.)?boost\.org/license_1_0"),
    ("unlicense", "unencumbered public", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "unlicense org", r"unlicense\.org"),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such"),
    ("wtfpl", "just want", r"you just do what the f\S* you want to"),
    ("public-domain", "public domain", r"(?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("cc-by", "creativecommons by", r"creativecommons\.org/licenses/by/\d\.\d"),
    ("cc-by-sa", "creativecommons sa", r"creativecommons\.org/licenses/by-sa/\d\.\d"),
    ("cc-by-nc", "creativecommons nc", r"creativecommons\.org/licenses/by-nc/\d\.\d"),
    ("cc-by-nd", "creativecommons nd", r"creativecommons\.org/licenses/by-nd/\d\.\d"),
    ("cc-by-nc-sa", "creativecommons nc sa", r"creativecommons\.org/licenses/by-nc-sa/\d\.\d"),
    ("cc-by-nc-nd", "creativecommons nc nd", r"creativecommons\.org/licenses/by-nc-nd/\d\.\d"),
    ("cc0-1.0", "creativecommons zero", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("proprietary", "rights reserved", r"all rights reserved"),
    ("proprietary", "confidential proprietary", r"(?:confidential and proprietary|proprietary and confidential)"),
)

# Sentences of license texts, in lower case and without marks, one a line behind its
# label. Between the words of a text anything may stand that is no word.
TEXTS = """
mit: the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit: in no event shall the authors or copyright holders be liable for any claim damages or other liability
mit: to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies
x11: except as contained in this notice the name of the x consortium shall not be used in advertising
bsd: redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd: redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd: this software is provided by the copyright holders and contributors as is and any express or implied warranties
bsd: in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages
bsd-3-clause-clear: no express or implied licenses to any party s patent rights are granted by this license
bsd-2-clause-patent: each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual
bsd-4-clause: this product includes software developed by the university of california
bsd-source-code: redistributions of source code must retain the copyright notice without the disclaimer
apache-2.0: unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0: see the license for the specific language governing permissions and limitations under the license
apache-2.0: subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive
apache-2.0: you must give any other recipients of the work or derivative works a copy of this license
apache-2.0: you must cause any modified files to carry prominent notices stating that you changed the files
apache-2.0: licensed to the apache software foundation asf under one or more contributor license agreements
apache-1.1: this product includes software developed by the apache software foundation
apache-1.1: products derived from this software may not be called apache
gpl-2.0: the licenses for most software are designed to take away your freedom to share and change it
gpl-2.0: published by the free software foundation either version 2 of the license or at your option any later version
gpl-3.0: published by the free software foundation either version 3 of the license or at your option any later version
gpl-3.0: the gnu general public license is a free copyleft license for software and other kinds of works
gpl-3.0: the gnu general public license does not permit incorporating your program into proprietary programs
gpl: everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
gpl: this program is distributed in the hope that it will be useful but without any warranty
gpl: you should have received a copy of the gnu general public license along with this
gpl: this program comes with absolutely no warranty this is free software and you are welcome to redistribute it
classpath-exception-2.0: linking this library statically or dynamically with other modules is making a combined work based on this library
classpath-exception-2.0: as a special exception the copyright holders of this library give you permission to link this library with independent modules
gcc-exception-3.1: you are granted additional permissions described in the gcc runtime library exception
libtool-exception: if you distribute this file as part of a program or library that is built using gnu libtool
autoconf-exception: unlimited permission to copy distribute and modify the configure scripts that are the output of autoconf
bison-exception-2.2: as a special exception you may create a larger work that contains part or all of the bison parser skeleton
font-exception-2.0: if you create a document which uses this font and embed this font or unaltered portions of this font into the document
openssl-exception: permission to link the code of portions of this program with the openssl library
lgpl-2.0: it under the terms of the gnu library general public license
lgpl-2.1: this is the first released version of the lesser gpl
lgpl-3.0: this version of the gnu lesser general public license incorporates the terms and conditions of version 3
lgpl: you should have received a copy of the gnu lesser general public license along with this
lgpl: you can use it under the terms of the gnu lesser general public license
agpl-3.0: specifically designed to ensure cooperation with the community in the case of network server software
agpl-3.0: you should have received a copy of the gnu affero general public license along with this
gfdl: permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl: with no invariant sections no front cover texts and no back cover texts
fsfap: copying and distribution of this file with or without modification are permitted in any medium without royalty
fsfullr: this file is free software the free software foundation gives unlimited permission to copy and or distribute it
mpl-2.0: if a copy of the mpl was not distributed with this file you can obtain one at
mpl-2.0: this source code form is incompatible with secondary licenses as defined by the mozilla public license
mpl-1.1: the contents of this file are subject to the mozilla public license version 1 1
mpl-1.1: software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied see the license for the specific language governing rights and limitations
mpl-1.0: the contents of this file are subject to the mozilla public license version 1 0
npl-1.1: the contents of this file are subject to the netscape public license
epl-1.0: the accompanying program is provided under the terms of this eclipse public license agreement
epl-1.0: any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement
epl-2.0: this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
epl-2.0: when the conditions for such availability set forth in the eclipse public license
cpl-1.0: the accompanying program is provided under the terms of this common public license agreement
ipl-1.0: the accompanying program is provided under the terms of this ibm public license agreement
cddl-1.0: the contents of this file are subject to the terms of the common development and distribution license
cddl-1.0: when distributing covered code include this cddl header notice in each file
apsl-2.0: are subject to the apple public source license version 2 0
spl-1.0: the contents of this file are subject to the sun public license version 1 0
rpl-1.5: unless explicitly acquired and licensed from licensor under another license the contents of this file are subject to the reciprocal public license
cpal-1.0: the contents of this file are subject to the common public attribution license version 1 0
isc: the software is provided as is and the author disclaims all warranties with regard to this software
zlib: in no event will the authors be held liable for any damages arising from the use of this software
zlib: permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely
zlib: the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib: this notice may not be removed or altered from any source distribution
libpng-2.0: the png reference library is supplied as is
bsl-1.0: to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
bsl-1.0: distributed under the boost software license version 1 0
unlicense: anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary
unlicense: dedicate any and all copyright interest in the software to the public domain
cc0-1.0: the person who associated a work with this deed has dedicated the work to the public domain
cc0-1.0: hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders all of
cc0-1.0: has waived all copyright and related or neighboring rights to this work
cc-by-4.0: this work is licensed under a creative commons attribution 4 0 international license
cc-by-sa-4.0: licensed under a creative commons attribution sharealike 4 0 international license
cc-by-nc-4.0: licensed under a creative commons attribution noncommercial 4 0 international license
cc-by-nd-4.0: licensed under a creative commons attribution noderivatives 4 0 international license
cc-by-nc-sa-4.0: licensed under a creative commons attribution noncommercial sharealike 4 0 international license
cc-by-nc-nd-4.0: licensed under a creative commons attribution noncommercial noderivatives 4 0 international license
cc-by-sa-3.0: licensed under a creative commons attribution sharealike 3 0 unported license
cc-by-3.0: licensed under a creative commons attribution 3 0 unported license
cc-by-sa: text is available under the creative commons attribution sharealike license
cc-pdm: this work has been identified as being free of known restrictions under copyright law
odbl-1.0: a license agreement intended to allow users to freely share modify and use this database
odbl-1.0: this database is made available under the open database license
dbcl-1.0: any rights in individual contents of the database are licensed under the database contents license
pddl-1.0: the public domain dedication and license is a document intended to allow you to freely share modify and use this work
artistic-1.0: the intent of this document is to state the conditions under which a package may be copied
artistic-1.0: such that the copyright holder maintains some semblance of artistic control over the development of the package
artistic-2.0: this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed
perl: you can redistribute it and or modify it under the same terms as perl itself
psf-2.0: psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test
psf-2.0: psf is making python available to licensee on an as is basis
cnri-python: cnri is making python 1 6 available to licensee on an as is basis
ofl-1.1: this font software is licensed under the sil open font license version 1 1
ofl-1.1: the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects
bitstream-vera: no copy of one or more of the font software typefaces may be sold by itself
eupl-1.2: this european union public licence the eupl applies to the work
eupl-1.2: licensed under the eupl
cecill-2.1: this software is governed by the cecill license under french law
cecill-2.1: abiding by the rules of distribution of free software you can use modify and or redistribute the software
ms-pl: this license governs use of the accompanying software if you use the software you accept this license
ms-rl: for any file you distribute that contains code from the software in source code or binary format
osl-3.0: licensed under the open software license version 3 0
afl-3.0: licensed under the academic free license version 3 0
ecl-2.0: licensed under the educational community license version 2 0
ncsa: to deal with the software without restriction including without limitation the rights to use copy modify merge
postgresql: for any purpose without fee and without a written agreement is hereby granted
php-3.01: this product includes php software freely available from
ruby: you may make and give away verbatim copies of the source form of the software without restriction
vim: there are no restrictions on distributing unmodified copies of vim
openssl: this product includes software developed by the openssl project for use in the openssl toolkit
openssl: this product includes cryptographic software written by eric young
curl: provided that the above copyright notice and this permission notice appear in all copies
w3c: by obtaining and or copying this work you the licensee agree that you have read understood and will comply
upl-1.0: subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data
blueoak-1.0.0: this license gives everyone as much permission to work with this software as possible
sspl-1.0: if you make the functionality of the program or a modified version available to third parties as a service
busl-1.1: the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use
busl-1.1: the business source license this document or the license is not an open source license
elastic-2.0: you may not provide the software to third parties as a hosted or managed service
json: the software shall be used for good not evil
beerware: if we meet some day and you think this stuff is worth it you can buy me a beer in return
hpnd: this software and its documentation for any purpose and without fee is hereby granted
nasa-1.3: this open source agreement defines the rights of use reproduction distribution modification and redistribution of certain computer software
commons-clause: the grant of rights under the license will not include and the license does not grant to you the right to sell the software
unicode: to any person obtaining a copy of the unicode data files and any associated documentation
ftl: portions of this software are copyright the freetype project
ijg: this software is based in part on the work of the independent jpeg group
tcl: the authors hereby grant permission to use copy modify distribute and license this software and its documentation
sleepycat: redistributions in any form must be accompanied by information on how to obtain complete source code
qpl-1.0: you may copy and distribute the software in unmodified form provided that the entire package
zpl-2.1: this software is subject to the provisions of the zope public license
lppl-1.3c: may be distributed and or modified under the conditions of the latex project public license
mulanpsl-2.0: you can use this software according to the terms and conditions of the mulan psl v2
sgi-b-2.0: sgi free software license b version 2 0
ogl-3.0: contains public sector information licensed under the open government licence
openrail: you agree not to use the model or derivatives of the model
llama: community license copyright meta platforms inc all rights reserved
prosperity: you must not use this software for commercial purposes for longer than the thirty day trial period
polyform: any purpose is a permitted purpose except for providing any product that competes with the software
hippocratic: the software may not be used by individuals corporations governments or other groups for systems or activities that actively and knowingly endanger
proprietary: this software is the confidential and proprietary information of
proprietary: unauthorized copying of this file via any medium is strictly prohibited
proprietary: no part of this publication may be reproduced stored in a retrieval system or transmitted
proprietary: you may not reverse engineer decompile or disassemble the software
proprietary: this software is licensed not sold
public-domain: hereby release it into the public domain
public-domain: this software is not subject to copyright protection and is in the public domain
public-domain: this file is in the public domain
public-domain: no copyright is claimed in the united states under title 17
"""

#: Of "licensed under ..." rules, the only ones that can be negated.
GRANT_SCORE = 0.9
#: Either spelling, as a word: what "license: ..." and a name need. A grant needs "under", an SPDX
#: tag "spdx".
LICENSE_WORDS = frozenset({"license", "licence"})
LICENSED = frozenset({"licensed", "licenced"})
#: Before a grant that is none: "not licensed under"; looked for in the NEGATION_REACH characters before.
NEGATION = re.compile(r"(?:\b(?:not|never)|n['’]t)(?:\s+(?:be|been))?\s+$|\bno\s+longer\s+$")
NEGATION_REACH = 16
#: Between the parts of a short form.
DASH = r"[\s-]{1,3}"
#: Behind a name.
LICENSE = r"\s+licen[cs]e"
#: Where a word of the prefilter begins and ends.
BEGIN, END = "(?<![a-z0-9])", "(?![a-z0-9])"


def _groups(*words) -> tuple[frozenset[str], ...]:
    return tuple(w if isinstance(w, frozenset) else frozenset({w}) for w in words)


def _family_words(label: str, word: str) -> frozenset[str]:
    """Words of which a mention by name holds at least one."""
    long = {"gpl": {"general"}, "lgpl": {"lesser", "library"}, "agpl": {"affero"}, "gfdl": {"documentation"}, "mpl": {"mozilla"}, "epl": {"eclipse"}, "edl": {"eclipse"}, "cddl": {"development"}, "cpl": {"common"}, "mit": {"expat"}, "0bsd": {"zero", "bsd"}, "wtfpl": {"want"}, "odbl": {"database"}, "odc": {"commons"}, "pddl": {"dedication"}, "python": {"psf"}, "ofl": {"font"}, "eupl": {"european"}, "microsoft": {"ms"}, "reciprocal": {"ms"}, "cc": {"creative"}, "boost": {"bsl"}, "oak": {"blueoak"}, "osl": {"software"}, "afl": {"academic"}, "ecl": {"educational"}, "upl": {"permissive"}, "sspl": {"server"}, "busl": {"business"}, "hpnd": {"historical"}, "beerware": {"beer"}, "bsd": {"freebsd"}}
    return frozenset({word} | long.get(word, set()))


def _alternatives(regex: str) -> list[str]:
    """The parts of a regex between its outermost bars."""
    parts, depth = [""], 0
    for c in regex:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            parts.append("")
        else:
            parts[-1] += c
    return parts


def _spaced(name: str) -> str:
    """A name with any white space between its words, and either spelling."""
    for written, meant in (("(?:version |v)?", r"(?:version |v\.? ?)?"), ("[ -]?", r"(?:\s+|-)?"), ("[- ]", r"(?:\s+|-)"), ("[ -]", r"(?:\s+|-)"), (" ?", r"\s*"), (" ", r"\s+"), ("license", "licen[cs]e")):
        name = name.replace(written, meant)
    return name


def text_rules() -> list[Rule]:
    """A rule for each sentence of TEXTS. Every match holds all of its words: the three longest are
    asked for."""
    found = []
    for line in TEXTS.strip().split("\n"):
        label, _, sentence = line.partition(": ")
        words = sentence.split()
        rare = sorted(sorted(set(words)), key=len)[-3:]
        score = 0.6 if label == "proprietary" else 1.0
        found.append(Rule(label, 20, score, _groups(*rare), BEGIN + r"[\W_]+".join(words) + END))
    return found


def rules() -> list[Rule]:
    found = text_rules()
    for label, spdx, name, word in FAMILIES:
        either = _family_words(label, word)
        # what is a mention by itself: the name with "license" in it, or with a kind of its own
        alone = [_spaced(x) for x in _alternatives(name) if any(w in x for w in ("license", "licen[cs]e", "agreement", "disclaimer"))]
        name = _spaced(name)
        found.append(Rule(label, 10, 1.0, _groups("spdx"), rf"{BEGIN}spdx-license-identifier:\s*\(?(?:{spdx})(?![\w.+-]*\w)"))
        found.append(Rule(label, 30, GRANT_SCORE, _groups("under", either), rf"(?:licen[cs]ed|released|distributed|available|provided)\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:either\s+(?:of\s+)?)?(?:the\s+)?(?:{name})(?:\s+licen[cs]e)?\b"))
        found.append(Rule(label, 30, 0.85, _groups(LICENSE_WORDS, either), rf"{BEGIN}licen[cs]e\s*[:=]\s*[\"']?(?:{spdx}|{name})(?![\w-])"))
        found.append(Rule(label, 40, 0.7, _groups(either) if alone else _groups(LICENSE_WORDS, either), rf"(?<![\w-])(?:{'|'.join([rf'(?:{name})' + LICENSE, *alone])})\b"))
        found.append(Rule(label, 40, 0.7, _groups(LICENSED, either), rf"(?<![\w-])(?:{spdx}|{name})(?:\s+|-)licen[cs]ed{END}"))
        if label.startswith("cc-by"):
            _, *kind, version = label.split("-")
            short = DASH.join(["cc", *kind]) + rf"[\s-]{{0,3}}(?:v\.? ?)?{re.escape(version)}"
            found.append(Rule(label, 40, 0.7, _groups("cc", "by"), rf"(?<![\w-]){short}{END}"))
    found.append(Rule("cc0-1.0", 40, 0.7, _groups("cc0"), rf"(?<![\w-])cc0{DASH}1\.0{END}"))
    found.append(Rule("bsd", 40, 0.7, _groups(LICENSE_WORDS | LICENSED, "bsd"), rf"(?<![\w-])bsd(?:{DASH}style)?{DASH}licen[cs]ed?{END}"))
    for label, words, regex in SENTENCES:
        found.append(Rule(label, 20, 0.6 if label == "proprietary" else 1.0, _groups(*words.split()), BEGIN + f"(?:{regex})".replace(" ", r"\s+") + END))
    return found


# What follows a tag or a grant: further licenses of the same expression.

TAG = re.compile(BEGIN + r"spdx-license-identifier:")
TAG_PART = re.compile(r"[ \t(]*+([\w.+-]++)[ \t)]*+")
TAG_JOIN = re.compile(r"(?:and|or|with)(?=[ \t(])")
JOIN = re.compile(r"[\s)\"']*+(?:(and/or|or|/(?!libpng))|and)(?:(?<=/)|(?<=and/or)|\s)\s*+(?:\(\s*)?(?:the\s+)?")
#: Names (or identifiers), with "license" behind them or not.
NAMED = tuple((label, re.compile(rf"(?:{spdx}|{_spaced(name)})(?P<license>\s+licen[cs]es?)?(?![\w-])")) for label, spdx, name, _ in FAMILIES)
IDENTIFIED = tuple((label, re.compile(spdx)) for label, spdx, _, _ in FAMILIES)


@lru_cache(4_096)
def identified(token: str) -> str | None:
    """The label of an SPDX identifier."""
    return next((label for label, regex in IDENTIFIED if regex.fullmatch(token)), None)


def tagged(text: str) -> list[tuple[str, int, int]]:
    """Label and place of every identifier in the expressions behind SPDX tags: what AND, OR and
    WITH join, in any brackets, up to the end of the line."""
    found = []
    for tag in TAG.finditer(text):
        part = TAG_PART.match(text, tag.end())
        while part:
            token = part[1].rstrip(".-")
            label = identified(token) if len(token) <= 64 else None
            if label:
                found.append((label, part.start(1), part.start(1) + len(token)))
            join = TAG_JOIN.match(text, part.end())
            part = join and TAG_PART.match(text, join.end())
    return found


def joined(text: str, at: int) -> list[tuple[str, int, int]]:
    """Label and place of the licenses that "or", "and", "and/or" or a slash join to one that ends
    at ``at``. Behind "and" a name needs a number or the word license, since a sentence may go on."""
    found = []
    while join := JOIN.match(text, at):
        hits = [(m, label) for label, regex in NAMED if (m := regex.match(text, join.end())) and (join[1] or m["license"] or any(c.isdigit() for c in m[0]))]
        if not hits:
            break
        hit, label = max(hits, key=lambda x: x[0].end())
        found.append((label, hit.start(), hit.end()))
        at = hit.end()
    return found
