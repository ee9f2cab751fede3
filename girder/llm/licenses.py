"""License scans: ordered signature rules over the words of a text.

A rule is a regular expression over words, the tokens it needs (the prefilter), a priority and a confidence: phrases
that state a license by name, identifiers, addresses, and sentences of the licenses themselves. A text is cut into words
once; the rules whose tokens it holds are evaluated, and a detection that lies within a kept one of the same or a higher
priority is suppressed. All of it is one projection of built-in functions: nothing shuffles, a text of any length is
read whole.

A null or empty text has no words, no labels and score 0; repeated rows get equal results; an empty table has an empty
result; other columns of the input are neither read nor touched, whatever their names. Of detections at the same place
with the same priority the labels come together.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alnum_words, laid_out, let, table

#: Phrases that always count: (words, label).
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

#: (label, pattern of the name in words, tokens of which every match holds at least one)
FAMILIES = [
    ("mit", "mit", "mit"),
    ("mit-0", "mit (?:0|no attribution)", "mit"),
    ("x11", "x11", "x11"),
    ("expat", "expat", "expat"),
    ("apache-1", "apache (?:software )?(?:license )?(?:version )?1(?: [01])?", "apache"),
    ("apache-2", "apache (?:software )?(?:license )?(?:version )?2(?: 0)?", "apache"),
    ("gpl-1", "(?:gnu )?(?:gplv1(?:(?: version)? 1)?|(?:gpl|general public license)(?: version)? v?1)(?: 0)?", "gpl gplv1 general"),
    ("gpl-2", "(?:gnu )?(?:gplv2(?:(?: version)? 2)?|(?:gpl|general public license)(?: version)? v?2)(?: 0)?", "gpl gplv2 general"),
    ("gpl-3", "(?:gnu )?(?:gplv3(?:(?: version)? 3)?|(?:gpl|general public license)(?: version)? v?3)(?: 0)?", "gpl gplv3 general"),
    ("gpl", "(?:gnu )?general public license", "general"),
    ("gpl", "(?:gnu )?gpl", "gpl"),
    ("lgpl-2.1", "(?:gnu )?(?:lgplv2|(?:lgpl|lesser general public license)(?: version)? v?2) 1", "lgpl lgplv2 lesser"),
    ("lgpl-3", "(?:gnu )?(?:lgplv3(?:(?: version)? 3)?|(?:lgpl|lesser general public license)(?: version)? v?3)(?: 0)?", "lgpl lgplv3 lesser"),
    ("lgpl", "(?:gnu )?(?:lgpl(?:v2)?|lesser general public license)", "lgpl lgplv2 lesser"),
    ("agpl-3", "(?:gnu )?affero general public license(?: version 3)?", "affero"),
    ("agpl-3", "agpl(?:v3)?(?: version)?(?: v?3)?(?: 0)?", "agpl agplv3"),
    ("gfdl", "(?:gnu )?free documentation license", "documentation"),
    ("bsd-2", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", "bsd freebsd"),
    ("bsd-3", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", "bsd"),
    ("bsd-4", "(?:bsd 4 clause|4 clause bsd|original bsd)", "bsd"),
    ("bsd", "bsd(?: style)?", "bsd"),
    ("mpl-1.1", "(?:mpl|mozilla public license)(?: version)? 1 1", "mpl mozilla"),
    ("mpl-2", "(?:mpl|mozilla public license)(?: version)? 2(?: 0)?", "mpl mozilla"),
    ("mpl", "mozilla public license", "mozilla"),
    ("epl-1", "(?:epl|eclipse public license)(?: version)? 1(?: 0)?", "epl eclipse"),
    ("epl-2", "(?:epl|eclipse public license)(?: version)? 2(?: 0)?", "epl eclipse"),
    ("cddl", "(?:cddl|common development and distribution license)", "cddl distribution"),
    ("eupl", "(?:eupl|european union public licen[cs]e)", "eupl european"),
    ("isc", "isc", "isc"),
    ("zlib", "zlib(?: libpng)?", "zlib"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "(?:wtfpl|do what the fuck you want to public license)", "wtfpl fuck"),
    ("boost", "boost(?: software)?(?: license)?(?: version)?(?: 1 0)?", "boost"),
    ("artistic-2", "artistic (?:license )?2(?: 0)?", "artistic"),
    ("artistic", "artistic", "artistic"),
    ("ms-pl", "microsoft public license", "microsoft"),
    ("ncsa", "(?:university of illinois )?ncsa", "ncsa"),
    ("postgresql", "postgresql", "postgresql"),
    ("python", "python software foundation license", "python"),
    ("php", "php", "php"),
    ("openssl", "openssl", "openssl"),
    ("ofl", "(?:sil )?open font license(?: 1 1)?", "font"),
    ("odbl", "open (?:data commons open )?database license", "database"),
    ("cc0", "(?:cc0|creative commons zero)", "cc0 zero"),
    ("cc-by-nc-nd", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:nd|noderivatives|no derivatives)(?: [1-4] 0)?", "cc creative"),
    ("cc-by-nc-sa", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:sa|sharealike|share alike)(?: [1-4] 0)?", "cc creative"),
    ("cc-by-nc", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial)(?: [1-4] 0)?", "cc creative"),
    ("cc-by-nd", "(?:cc|creative commons) (?:by|attribution) (?:nd|noderivatives|no derivatives)(?: [1-4] 0)?", "cc creative"),
    ("cc-by-sa", "(?:cc|creative commons) (?:by|attribution) (?:sa|sharealike|share alike)(?: [1-4] 0)?", "cc creative"),
    ("cc-by", "(?:cc|creative commons) (?:by|attribution)(?: [1-4] 0)?", "cc creative"),
    ("cc-by", "creative commons attribution(?: [1-4] 0)?", "creative"),
    ("cc-public-domain", "(?:cc|creative commons) public domain(?: mark)?(?: 1 0)?", "domain"),
    ("0bsd", "(?:0bsd|zero clause bsd|bsd zero clause)", "0bsd zero"),
    ("afl-3", "(?:afl|academic free license)(?: version)? v?3(?: 0)?", "afl academic"),
    ("aladdin", "aladdin free public license", "aladdin"),
    ("apl", "adaptive public license", "adaptive"),
    ("apsl-2", "(?:apsl|apple public source license)(?: version)?(?: 2 0)?", "apsl apple"),
    ("beerware", "beerware", "beerware"),
    ("blueoak", "(?:blue oak|blueoak) model license(?: 1 0 0)?", "blue blueoak"),
    ("busl", "(?:busl|business source license)(?: version)?(?: 1 1)?", "busl business"),
    ("cecill", "cecill(?: [bc])?(?: 2 [01])?", "cecill"),
    ("cpal", "(?:cpal|common public attribution license)(?: 1 0)?", "cpal attribution"),
    ("cpl", "(?:cpl|common public license)(?: version)?(?: 1 0)?", "cpl common"),
    ("dsl", "design science license", "design"),
    ("ecl-2", "(?:ecl|educational community license)(?: version)?(?: 2 0)?", "ecl educational"),
    ("elastic", "elastic license(?: 2 0)?", "elastic"),
    ("etalab", "(?:etalab|licence ouverte|open licence)(?: 2 0)?", "etalab ouverte open"),
    ("hpnd", "(?:hpnd|historical permission notice and disclaimer)", "hpnd historical"),
    ("imagemagick", "imagemagick", "imagemagick"),
    ("intel", "intel open source license", "intel"),
    ("ipl", "ibm public license(?: 1 0)?", "ibm"),
    ("json", "json license", "json"),
    ("lppl", "(?:lppl|latex project public license)(?: version)?(?: 1 3[ac]?)?", "lppl latex"),
    ("ms-rl", "(?:ms rl|microsoft reciprocal license)", "rl reciprocal"),
    ("mulan-2", "(?:mulan permissive software license|mulanpsl)(?: v?2)?", "mulan mulanpsl"),
    ("nasa", "nasa open source agreement", "nasa"),
    ("odc-by", "(?:odc by|open data commons attribution license)(?: 1 0)?", "odc commons"),
    ("ogl", "open government licen[cs]e(?: v?[123] 0)?", "government"),
    ("opl", "open publication license", "publication"),
    ("osl-3", "(?:osl|open software license)(?: version)? v?3(?: 0)?", "osl software"),
    ("pddl", "(?:pddl|public domain dedication and license)", "pddl dedication"),
    ("qpl", "q public license", "q"),
    ("rpl", "reciprocal public license(?: 1 [15])?", "reciprocal"),
    ("ruby", "ruby", "ruby"),
    ("sleepycat", "sleepycat", "sleepycat"),
    ("sspl", "(?:sspl|server side public license)(?: version)?(?: 1)?", "sspl server"),
    ("tcl", "tcl tk", "tcl"),
    ("upl", "(?:upl|universal permissive license)(?: version)?(?: 1 0)?", "upl universal"),
    ("vim", "vim", "vim"),
    ("w3c", "w3c software(?: notice)?", "w3c"),
    ("zpl", "zope public license(?: 2 [01])?", "zope"),
]
#: (pattern around the name N, tokens that it needs besides (any one of those parted by blanks), priority, confidence)
FORMS = [
    ("(?:licensed|released|distributed|published|available|provided|covered|redistributed) under (?:the )?(?:terms of )?(?:the )?(?:conditions of )?(?:the )?N(?: licen[sc]e)?",
        ("under",), 3, 0.95),
    ("(?:governed|covered) by (?:the )?(?:terms of )?(?:the )?N(?: licen[sc]e)?", ("by",), 3, 0.9),
    ("subject to (?:the )?(?:terms (?:and conditions )?of )?(?:the )?N(?: licen[sc]e)?", ("subject",), 3, 0.9),
    ("spdx license identifier N(?: only| or later)?", ("spdx",), 4, 1.0),
    ("(?:the )?N license(?: agreement| terms| file)?", ("license",), 2, 0.7),
    ("licen[sc]e(?: is| type)? N", ("license licence",), 2, 0.75),
    ("N licence", ("licence",), 2, 0.7),
    ("dual(?:ly)? licensed under (?:the )?N", ("licensed",), 3, 0.9),
    ("N(?: or later| only) license", ("license",), 2, 0.7),
]
#: Names that need no words around them: (label, pattern, tokens)
ALONE = [
    ("gpl", "gnu general public license", ("gnu", "general")),
    ("gpl-2", "gnu general public license(?: version)? v?2(?: 0)?", ("gnu", "general")),
    ("gpl-3", "gnu general public license(?: version)? v?3(?: 0)?", ("gnu", "general")),
    ("gpl-2", "gplv2(?: or later| only)?", ("gplv2",)),
    ("gpl-2", "gpl 2 0(?: or later| only)?", ("gpl",)),
    ("gpl-3", "gplv3(?: or later| only)?", ("gplv3",)),
    ("gpl-3", "gpl 3 0(?: or later| only)?", ("gpl",)),
    ("lgpl", "gnu (?:lesser|library) general public license", ("gnu", "general")),
    ("lgpl-2.1", "(?:lgplv2 1|lgpl 2 1)(?: or later| only)?", ("lgpl lgplv2",)),
    ("lgpl-3", "(?:lgplv3|lgpl 3 0)(?: or later| only)?", ("lgpl lgplv3",)),
    ("agpl-3", "gnu affero general public license", ("affero",)),
    ("agpl-3", "(?:agplv3|agpl 3 0)(?: or later| only)?", ("agpl agplv3",)),
    ("gfdl", "gnu free documentation license", ("gnu", "documentation")),
    ("apache-2", "apache(?: software)? license(?: version)? 2(?: 0)?", ("apache", "license")),
    ("apache-2", "apache 2 0", ("apache",)),
    ("mpl", "mozilla public license", ("mozilla",)),
    ("mpl-2", "mozilla public license(?: version)? v?2(?: 0)?", ("mozilla", "2 v2")),
    ("epl", "eclipse public license", ("eclipse",)),
    ("cddl", "common development and distribution license", ("distribution",)),
    ("eupl", "european union public licen[cs]e", ("european",)),
    ("boost", "boost software license", ("boost",)),
    ("ms-pl", "microsoft public license", ("microsoft",)),
    ("ofl", "sil open font license", ("font",)),
    ("odbl", "open (?:data commons open )?database license", ("database",)),
    ("cc0", "cc0(?: 1 0)?(?: universal)?", ("cc0",)),
    ("cc-by", "(?:cc by|creative commons attribution) [1-4] 0(?: international| unported| generic)?", ("creative cc",)),
    ("cc-by-sa", "cc by sa(?: [1-4] 0)?", ("cc", "sa")),
    ("cc-by-nd", "cc by nd(?: [1-4] 0)?", ("cc", "nd")),
    ("cc-by-nc", "cc by nc [1-4] 0", ("cc", "nc")),
    ("cc-by-nc-sa", "cc by nc sa(?: [1-4] 0)?", ("cc", "sa")),
    ("cc-by-nc-nd", "cc by nc nd(?: [1-4] 0)?", ("cc", "nd")),
    ("bsd-2", "bsd 2 clause", ("bsd", "clause")),
    ("bsd-3", "bsd 3 clause", ("bsd", "clause")),
    ("artistic-2", "artistic license 2 0", ("artistic",)),
    ("sspl", "server side public license", ("server",)),
    ("busl", "business source license", ("business",)),
    ("wtfpl", "wtfpl", ("wtfpl",)),
    ("gpl-2", "gpl version 2(?: or later| only)?", ("gpl", "2")),
    ("gpl-3", "gpl version 3(?: or later| only)?", ("gpl", "3")),
    ("lgpl-2.1", "gnu (?:lesser|library) general public license(?: version)? v?2 1", ("gnu", "general")),
    ("lgpl-3", "gnu lesser general public license(?: version)? v?3(?: 0)?", ("gnu", "general")),
    ("agpl-3", "gnu affero general public license(?: version)? v?3(?: 0)?", ("affero",)),
    ("mpl-1.1", "mozilla public license(?: version)? v?1 1", ("mozilla",)),
    ("epl-1", "eclipse public license(?: version)? v?1(?: 0)?", ("eclipse",)),
    ("epl-2", "eclipse public license(?: version)? v?2(?: 0)?", ("eclipse",)),
    ("apache-1", "apache(?: software)? license(?: version)? 1 [01]", ("apache", "license")),
    ("afl-3", "academic free license(?: version)? v?3(?: 0)?", ("academic",)),
    ("aladdin", "aladdin free public license", ("aladdin",)),
    ("apl", "adaptive public license", ("adaptive",)),
    ("apsl-2", "apple public source license(?: version)?(?: v?2 0)?", ("apple",)),
    ("blueoak", "blue oak model license(?: version)?(?: 1 0 0)?", ("blue", "oak")),
    ("cecill", "cecill(?: free software)? license(?: agreement)?", ("cecill",)),
    ("cpal", "common public attribution license(?: version)?(?: 1 0)?", ("attribution", "common")),
    ("cpl", "common public license(?: version)?(?: v?1 0)?", ("common", "license")),
    ("dsl", "design science license", ("design", "science")),
    ("ecl-2", "educational community license(?: version)?(?: v?2 0)?", ("educational",)),
    ("elastic", "elastic license(?: version)?(?: v?2 0)?", ("elastic",)),
    ("hpnd", "historical permission notice and disclaimer", ("historical", "disclaimer")),
    ("intel", "intel open source license", ("intel",)),
    ("ipl", "ibm public license(?: version)?(?: v?1 0)?", ("ibm",)),
    ("json", "(?:the )?json license", ("json",)),
    ("lppl", "latex project public license(?: version)?(?: v?1 3[ac]?)?", ("latex",)),
    ("ms-rl", "microsoft reciprocal license", ("microsoft",)),
    ("mulan-2", "mulan (?:psl|permissive software license)(?: version)? v?2", ("mulan",)),
    ("nasa", "nasa open source agreement", ("nasa",)),
    ("odc-by", "open data commons attribution license(?: version)?(?: v?1 0)?", ("attribution", "commons")),
    ("ogl", "open government licen[cs]e(?: version)?(?: v?[123] 0)?", ("government",)),
    ("opl", "open publication license", ("publication",)),
    ("osl-3", "open software license(?: version)? v?3(?: 0)?", ("open", "software", "license")),
    ("pddl", "public domain dedication and license", ("dedication",)),
    ("python", "python software foundation license(?: version)?(?: 2)?", ("python", "foundation")),
    ("qpl", "q public license(?: version)?(?: 1 0)?", ("q", "public")),
    ("rpl", "reciprocal public license(?: version)?(?: 1 [15])?", ("reciprocal",)),
    ("upl", "universal permissive license(?: version)?(?: v?1 0)?", ("universal", "permissive")),
    ("zpl", "zope public license(?: version)?(?: v?2 [01])?", ("zope",)),
    ("cc-by-sa", "creative commons attribution (?:sharealike|share alike)(?: [1-4] 0)?(?: international| unported| generic)?", ("creative", "sharealike alike")),
    ("cc-by-nd", "creative commons attribution (?:noderivatives|no derivatives|noderivs|no derivs)(?: [1-4] 0)?(?: international| unported| generic)?", ("creative", "noderivatives noderivs derivatives derivs")),
    ("cc-by-nc", "creative commons attribution (?:noncommercial|non commercial)(?: [1-4] 0)?(?: international| unported| generic)?", ("creative", "noncommercial commercial")),
    ("cc-by-nc-sa", "creative commons attribution (?:noncommercial|non commercial) (?:sharealike|share alike)(?: [1-4] 0)?(?: international| unported| generic)?", ("creative", "sharealike alike")),
    ("cc-by-nc-nd", "creative commons attribution (?:noncommercial|non commercial) (?:noderivatives|no derivatives|noderivs|no derivs)(?: [1-4] 0)?(?: international| unported| generic)?",
        ("creative", "noderivatives noderivs derivatives derivs")),
]
#: Identifiers of the SPDX list, and the labels that they stand for.
SPDX = dict(line.split() for line in """
0BSD 0bsd
AFL-3.0 afl-3
AGPL-3.0 agpl-3
Aladdin aladdin
Apache-1.0 apache-1
Apache-1.1 apache-1
Apache-2.0 apache-2
APL-1.0 apl
APSL-2.0 apsl-2
Artistic-1.0 artistic
Artistic-2.0 artistic-2
Beerware beerware
BlueOak-1.0.0 blueoak
BSD-2-Clause bsd-2
BSD-3-Clause bsd-3
BSD-4-Clause bsd-4
BSL-1.0 boost
BUSL-1.1 busl
CC-BY-3.0 cc-by
CC-BY-4.0 cc-by
CC-BY-NC-4.0 cc-by-nc
CC-BY-NC-ND-4.0 cc-by-nc-nd
CC-BY-NC-SA-4.0 cc-by-nc-sa
CC-BY-ND-4.0 cc-by-nd
CC-BY-SA-3.0 cc-by-sa
CC-BY-SA-4.0 cc-by-sa
CC0-1.0 cc0
CDDL-1.0 cddl
CDDL-1.1 cddl
CECILL-2.1 cecill
CPAL-1.0 cpal
CPL-1.0 cpl
DSL dsl
ECL-2.0 ecl-2
Elastic-2.0 elastic
EPL-1.0 epl-1
EPL-2.0 epl-2
etalab-2.0 etalab
EUPL-1.1 eupl
EUPL-1.2 eupl
GFDL-1.3 gfdl
GPL-1.0 gpl-1
GPL-2.0 gpl-2
GPL-3.0 gpl-3
HPND hpnd
ImageMagick imagemagick
Intel intel
IPL-1.0 ipl
ISC isc
JSON json
LGPL-2.0 lgpl
LGPL-2.1 lgpl-2.1
LGPL-3.0 lgpl-3
LPPL-1.3c lppl
MIT mit
MIT-0 mit-0
MPL-1.1 mpl-1.1
MPL-2.0 mpl-2
MS-PL ms-pl
MS-RL ms-rl
MulanPSL-2.0 mulan-2
NASA-1.3 nasa
NCSA ncsa
ODbL-1.0 odbl
ODC-By-1.0 odc-by
OFL-1.1 ofl
OGL-UK-3.0 ogl
OpenSSL openssl
OSL-3.0 osl-3
PDDL-1.0 pddl
PHP-3.01 php
PostgreSQL postgresql
PSF-2.0 python
Python-2.0 python
QPL-1.0 qpl
RPL-1.5 rpl
Ruby ruby
Sleepycat sleepycat
SSPL-1.0 sspl
TCL tcl
Unlicense unlicense
UPL-1.0 upl
Vim vim
W3C w3c
WTFPL wtfpl
X11 x11
Zlib zlib
ZPL-2.1 zpl
""".strip().splitlines())
#: An identifier after the tag, or as a later operand of an expression: (form, priority). A longer expression has a lower priority, so that it doesn't suppress the operands within it; beyond five operands the last one counts.
_OPERAND = "(?: (?!(?:or|and) )[^ ]+){1,9} (?:or|and)"
SPDX_FORMS = [(f"spdx license identifier(?:{_OPERAND}){{{n}}} N(?: only| or later)?", 4 - k) for k, n in enumerate(("0", "1", "2", "3", "4,12"))]
#: Rules of their own: (label, pattern, tokens, priority, confidence)
SINGLE = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ("permission", "hereby", "granted"), 4, 0.95),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution", "binary", "permitted"), 4, 0.95),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", ("permission", "modify", "distribute", "fee"), 4, 0.95),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy", ("permission", "hereby", "granted", "organization"), 4, 0.95),
    ("zlib", "provided as is without any express or implied warranty in no event will the authors be held liable", ("warranty", "liable", "express"), 3, 0.8),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered", "public", "domain"), 4, 1.0),
    ("public-domain", "(?:released|dedicated|placed) (?:to|into|in) the public domain", ("public", "domain"), 2, 0.8),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", ("redistribute", "modify", "gnu"), 4, 0.95),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", ("permission", "notice", "copies"), 3, 0.85),
    ("mit", "the software is provided as is without warranty of any kind express or implied", ("warranty", "express", "kind"), 2, 0.6),
    ("bsd", "redistributions of source code must retain the above copyright notice", ("redistributions", "retain"), 3, 0.9),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", ("redistributions", "reproduce"), 3, 0.9),
    ("bsd-3", "nor the names of (?:its|their) contributors may be used to endorse or promote products", ("contributors", "endorse"), 4, 0.95),
    ("bsd-4", "all advertising materials mentioning features or use of this software must display", ("advertising", "mentioning"), 4, 0.95),
    ("bsd", "this software is provided by the (?:copyright holders and contributors|author and contributors|regents and contributors) as is",
        ("provided", "contributors"), 3, 0.85),
    ("apache-2", "you may not use this file except in compliance with the license", ("file", "compliance"), 3, 0.85),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license", ("unless", "applicable", "writing"), 3, 0.85),
    ("gpl", "this program is free software you can redistribute it and or modify", ("program", "redistribute", "modify"), 3, 0.9),
    ("lgpl", "this library is free software you can redistribute it and or modify", ("library", "redistribute", "modify"), 4, 0.95),
    ("gpl", "distributed in the hope that it will be useful but without any warranty", ("hope", "warranty"), 3, 0.85),
    ("gpl", "you should have received a copy of the gnu general public license", ("received", "gnu"), 3, 0.9),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license", ("received", "gnu", "lesser library"), 4, 0.95),
    ("agpl-3", "you should have received a copy of the gnu affero general public license", ("received", "affero"), 4, 0.95),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("source", "mozilla"), 4, 0.95),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license",
        ("permission", "documentation"), 4, 0.95),
    ("x11", "except as contained in this notice the name of the x consortium shall not be used", ("except", "consortium"), 4, 0.95),
    ("zlib", "altered source versions must be plainly marked as such", ("altered", "plainly"), 4, 0.95),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", ("anyone", "compile"), 4, 0.95),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed",
        ("everyone", "verbatim", "allowed"), 4, 0.95),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer", ("meet", "beer"), 4, 0.95),
    ("ofl", "this font software is licensed under the sil open font license", ("font", "sil"), 4, 0.95),
    ("eupl", "licensed under the eupl version 1 [12]", ("eupl",), 4, 0.95),
    ("cc-by", "this work is licensed under a creative commons attribution [1-4] 0 (?:international|unported|generic) license", ("creative", "work"), 4, 0.95),
    ("public-domain", "(?:is|are) in the public domain", ("public", "domain"), 2, 0.7),
    ("json", "the software shall be used for good not evil", ("good", "evil"), 4, 0.95),
    ("proprietary", "no part of this (?:publication|document|work|book) may be reproduced", ("part", "reproduced"), 2, 0.8),
    ("proprietary", "unauthorized (?:copying|reproduction|use|distribution)(?: of this file)? (?:via any medium )?is (?:strictly )?prohibited",
        ("unauthorized", "prohibited"), 2, 0.8),
    ("proprietary", "trade secrets? (?:of|and confidential)", ("trade",), 1, 0.6),
    ("proprietary", "end user license agreement", ("user", "agreement"), 1, 0.6),
    ("opl", "opencontent org openpub", ("opencontent", "openpub"), 3, 0.9),
    ("unlicense", "unlicense org", ("unlicense",), 3, 0.95),
    ("boost", "boost org license 1 0", ("boost",), 3, 0.95),
    ("wtfpl", "wtfpl net", ("wtfpl",), 3, 0.95),
    ("epl-2", "eclipse org legal epl (?:2 0|v20)", ("eclipse", "epl"), 3, 0.95),
    ("epl-1", "eclipse org legal epl v10", ("eclipse", "epl"), 3, 0.95),
    ("bsd-2", "opensource org licenses bsd 2 clause", ("opensource", "bsd"), 3, 0.95),
    ("bsd-3", "opensource org licenses bsd 3 clause", ("opensource", "bsd"), 3, 0.95),
    ("isc", "opensource org licenses isc", ("opensource", "isc"), 3, 0.95),
    ("agpl-3", "www gnu org licenses agpl 3 0", ("gnu", "agpl"), 3, 0.95),
    ("lgpl-3", "www gnu org licenses lgpl 3 0", ("gnu", "lgpl"), 3, 0.95),
    ("lgpl-2.1", "www gnu org licenses (?:old licenses )?lgpl 2 1", ("gnu", "lgpl"), 3, 0.95),
    ("odbl", "opendatacommons org licenses odbl", ("opendatacommons", "odbl"), 3, 0.95),
    ("proprietary", "all rights reserved", ("rights", "reserved"), 1, 0.5),
    ("proprietary", "confidential and proprietary", ("confidential", "proprietary"), 1, 0.6),
    ("apache-2", "www apache org licenses license 2 0", ("www", "apache", "licenses"), 3, 0.95),
    ("mit", "opensource org licenses mit(?: license)?", ("opensource", "licenses", "mit"), 3, 0.95),
    ("gpl-3", "www gnu org licenses gpl 3 0", ("www", "gnu", "licenses", "gpl"), 3, 0.95),
    ("gpl-2", "www gnu org licenses (?:old licenses )?gpl 2 0", ("www", "gnu", "licenses", "gpl"), 3, 0.95),
    ("mpl-2", "mozilla org mpl 2 0", ("mozilla", "mpl"), 3, 0.95),
    ("cc-by", "creativecommons org licenses by [1-4] 0", ("creativecommons", "licenses", "by"), 3, 0.95),
    ("cc-by-sa", "creativecommons org licenses by sa [1-4] 0", ("creativecommons", "licenses", "sa"), 3, 0.95),
    ("cc-by-nc", "creativecommons org licenses by nc [1-4] 0", ("creativecommons", "licenses", "nc"), 3, 0.95),
    ("cc0", "creativecommons org publicdomain zero", ("creativecommons", "zero"), 3, 0.95),
]
#: Words that many texts hold; where a rule needs others too, those are looked for first.
COMMON = set("""1 2 a and author binary business by common copies data design domain file free general good government history is kind library licence licenced license licensed name
notice of open part permission process program provided public publication q received retain rights server service software source subject the trade under unless use used user v2 version
with work writing""".split())
EVERYWHERE = set("1 2 a and by is of the under use with work".split())
PRIORITIES = 6
BASE_PRIORITY = 5


def rule_table() -> list[tuple[str, str, tuple[str, ...], int, float, bool]]:
    """(label, pattern over words, tokens (any one of those parted by blanks, of each), priority, confidence, is a base phrase): the base, the single rules, and each family in each form."""
    rules = [(label, phrase, tuple(sorted(set(phrase.split()))), BASE_PRIORITY, 1.0, True) for phrase, label in BASE]
    rules += [(label, pattern, tokens, priority, sure, False) for label, pattern, tokens, priority, sure in SINGLE]
    rules += [(label, pattern, tokens, 1, 0.6, False) for label, pattern, tokens in ALONE]
    rules += [(label, form.replace("N", f"(?:{name})"), tuple(sorted({token, *tokens})), priority, sure, False) for label, name, token in FAMILIES for form, tokens,
        priority, sure in FORMS]
    for name, label in SPDX.items():
        words = re.findall("[a-z0-9]+", name.lower())
        rules += [(label, form.replace("N", " ".join(words)), ("spdx", words[0]), priority, 1.0, False) for form, priority in SPDX_FORMS]
    return [(label, pattern if base else pattern.replace("(?: version)?", "(?: version| v)?"), *rest, base) for label, pattern, *rest, base in rules]


def _worded(pattern: str) -> str:
    """The text to scan holds each word between blanks of its own, so that matches side by side don't share one."""
    return " " + pattern.replace(" ", "  ") + " "


def _constant(value, kind: str) -> Column:
    """A literal of any shape, which the optimizer makes of its JSON once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _keyed(rules: list[tuple]) -> tuple[list[str], list[list[dict]]]:
    """The prefilter: tokens, and for each the rules that are looked at if a text holds it. Of the tokens that a rule needs, those that say most are its keys."""
    by_key: dict[str, list[dict]] = {}
    for label, pattern, tokens, priority, sure, base in rules:
        any_ofs = [t.split() for t in tokens]
        row = {"label": label, "regex": _worded(pattern), "tokens": any_ofs, "priority": priority, "sure": sure, "base": base}
        for key in min(any_ofs, key=lambda any_of: (sum(t in EVERYWHERE for t in any_of), sum(t in COMMON for t in any_of), len(any_of))):
            by_key.setdefault(key, []).append(row)
    return list(by_key), list(by_key.values())


def _n_words(part: Column) -> Column:
    return ((F.char_length(part) - F.char_length(F.replace(part, F.lit(" "), F.lit("")))) / 2).cast("long")


#: A place of a rule.
PLACE = "struct<start:bigint,end:bigint,priority:int,label:string,sure:double,base:boolean>"


def _spans(norm: Column, rule: Column) -> Column:
    """All places of a rule, in words: the gaps between matches and the matches, one after the other."""
    parts = F.zip_with(F.split(norm, rule["regex"]), F.regexp_extract_all(norm, rule["regex"], F.lit(0)), lambda gap,
        m: F.struct(_n_words(gap).alias("gap"), _n_words(m).alias("n")))
    place = lambda x, at: F.when(x["n"].isNotNull(),
        F.struct((at + x["gap"]).alias("start"), (at + x["gap"] + x["n"]).alias("end"), rule["priority"].alias("priority"), rule["label"].alias("label"),
        rule["sure"].alias("sure"), rule["base"].alias("base")))
    found = let(parts, lambda p: laid_out(p, lambda x: x["gap"] + F.coalesce(x["n"], F.lit(0)), place, PLACE))
    return F.when(F.rlike(norm, rule["regex"]), found).otherwise(F.array().cast(f"array<{PLACE}>"))


def _survivors(places: Column) -> Column:
    """labels and the highest confidence of the places that no place of the same or a higher priority contains."""
    ordered = F.sort_array(F.transform(places,
        lambda p: F.struct(p["start"].alias("start"), (-p["end"]).alias("back"), (-p["priority"]).alias("rank"), p["label"].alias("label"), p["sure"].alias("sure"))))
    zero = F.struct(F.array(*[F.lit(-1).cast("long")] * PRIORITIES).alias("ends"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))

    def step(acc: Column, p: Column) -> Column:
        inside = F.exists(F.slice(acc["ends"], 1 - p["rank"], F.lit(PRIORITIES)), lambda end: end >= -p["back"])
        ends = F.transform(acc["ends"], lambda end, i: F.when(i == -p["rank"], F.greatest(end, -p["back"])).otherwise(end))
        return F.when(inside, acc).otherwise(F.struct(ends.alias("ends"), F.array_union(acc["labels"], F.array(p["label"])).alias("labels"),
            F.greatest(acc["score"], p["sure"]).alias("score")))

    return F.aggregate(ordered, zero, step, lambda acc: F.struct(acc["labels"].alias("labels"), acc["score"].alias("score")))


def licenses(docs: DataFrame, rules: list[tuple] | None = None) -> DataFrame:
    """doc_id, n_words, places (array of start, end, priority, label, sure, base), labels and score of the surviving ones."""
    rules = rules or rule_table()
    rule = "struct<label:string,regex:string,tokens:array<array<string>>,priority:int,sure:double,base:boolean>"
    keys, groups = _keyed(rules)
    keys, groups = _constant(keys, "array<string>"), _constant(groups, f"array<array<{rule}>>")
    tokens = _constant(sorted({t for r in rules for any_of in r[2] for t in any_of.split()}), "array<string>")
    none = F.array().cast(f"array<{PLACE}>")
    # what most texts don't need is computed for the others only: the tokens that are no keys, and the words as one text
    looked_at = lambda k: F.array_distinct(F.flatten(F.transform(k, lambda x: F.get(groups, F.array_position(keys, x).cast("int") - 1))))
    passed = lambda w, k: let(F.array_intersect(w, tokens),
        lambda seen: F.filter(looked_at(k), lambda r: F.forall(r["tokens"], lambda any_of: F.arrays_overlap(any_of, seen))))
    norm = lambda w: F.concat(F.lit(" "), F.array_join(w, "  "), F.lit(" "))
    hits = lambda w, rules: F.when(F.size(rules) == 0, none).otherwise(let(norm(w), lambda text: F.flatten(F.transform(rules, lambda r: _spans(text, r)))))
    places = lambda w: let(F.array_intersect(w, keys), lambda k: F.when(F.size(k) == 0, none).otherwise(let(passed(w, k), lambda rules: hits(w, rules))))
    found = docs.select("doc_id", let(alnum_words(F.col("text")),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), places(w).alias("places"))).alias("w")).select("doc_id", "w.n_words", "w.places")
    return found.select("doc_id", "n_words", "places", _survivors(F.col("places")).alias("kept")).select("doc_id", "n_words", "places", "kept.labels", "kept.score")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform("base", lambda p: p["start"])
    own = F.array_distinct(F.transform("base", lambda p: p["label"]))
    joined = lambda x: F.array_join(F.array_sort(x), ",")
    found = licenses(table(spark, sf_dir, "documents")).withColumn("base", base)
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(own).alias("base_labels"), joined(F.array_union(own, F.col("labels"))).alias("labels"), "score",
    )
