"""License scans by ordered signature rules (operator 7).

Rules are regular expressions over a text's words (letters, digits and non-ASCII
characters, A-Z lower-cased) joined by single spaces. They are written as families: each
license has its names and versions, and a handful of forms in which licenses are cited;
every combination is a rule, several hundred in all. Statements are sentences of the
licenses themselves, written one by one. A rule runs only on texts that hold
its keyword, a word of everything it matches; one pattern over all keywords leaves most texts untouched.

Rules have a priority. A detection that lies within another one is suppressed unless its
own priority is higher; then the outer one goes. Of equal spans the higher priority stays,
then the first rule. What survives gives labels and a score: one minus the product of the
doubts of the distinct rules that spoke.

Base phrases are reported as they are, all their places, whatever else is found.

Null text is the empty text: no words, no labels, score 0. Rows are independent, so
repeated rows and ties need no rule; other columns than those asked for are dropped.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from gleanery.llm.common import read_table, scored

# Phrases whose places are counted, and their labels; fixed values.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# label, keyword, names, versions. Names are patterns over words; a dot is a space here.
LICENSE = r"licen[cs]e"
FAMILIES = (
    ("gpl", "gnu", rf"gnu general public {LICENSE}|gnu gpl", "1 2 3 1.0 2.0 3.0"),
    ("gpl", "gpl", r"gpl", "1 2 3 1.0 2.0 3.0"),
    ("lgpl", "lesser", rf"(?:gnu )?lesser general public {LICENSE}", "2 2.1 3 3.0"),
    ("lgpl", "library", rf"(?:gnu )?library general public {LICENSE}", "2 2.0"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", "2 2.0 2.1 3 3.0"),
    ("agpl", "affero", rf"(?:gnu )?affero general public {LICENSE}", "1 1.0 3 3.0"),
    ("agpl", "agpl", r"(?:gnu )?agpl", "1 1.0 3 3.0"),
    ("gfdl", "documentation", rf"(?:gnu )?free documentation {LICENSE}", "1.1 1.2 1.3"),
    ("gfdl", "gfdl", r"(?:gnu )?gfdl", "1.1 1.2 1.3"),
    ("apache", "apache", rf"apache (?:software )?{LICENSE}|apache", "1.0 1.1 2 2.0"),
    ("mit", "mit", rf"(?:the )?mit {LICENSE}|mit x11|mit expat", ""),
    ("bsd", "bsd", rf"(?:new |modified |simplified |revised )?bsd {LICENSE}|bsd style {LICENSE}|bsd", "2.clause 3.clause 4.clause 0.clause"),
    ("isc", "isc", rf"(?:the )?isc {LICENSE}", ""),
    ("mpl", "mozilla", rf"mozilla public {LICENSE}", "1.0 1.1 2.0"),
    ("mpl", "mpl", r"mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse", rf"eclipse public {LICENSE}", "1.0 2.0"),
    ("epl", "epl", r"epl", "1.0 2.0"),
    ("edl", "eclipse", rf"eclipse distribution {LICENSE}", "1.0"),
    ("cddl", "cddl", r"cddl", "1.0 1.1"),
    ("cddl", "development", rf"common development and distribution {LICENSE}", "1.0 1.1"),
    ("cpl", "common", rf"common public {LICENSE}", "1.0"),
    ("ipl", "ibm", rf"ibm public {LICENSE}", "1.0"),
    ("cc-by", "cc", r"cc by", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by", "commons", rf"creative commons attribution(?: international| generic)?(?: public)?(?: {LICENSE})?", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-sa", "cc", r"cc by sa", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-sa", "commons", rf"creative commons attribution share ?alike(?: {LICENSE})?", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc", "cc", r"cc by nc", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc", "commons", rf"creative commons attribution non ?commercial(?: {LICENSE})?", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nd", "cc", r"cc by nd", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd", "1.0 2.0 2.5 3.0 4.0"),
    ("cc0", "cc0", r"cc0", "1.0"),
    ("cc0", "commons", r"creative commons zero", "1.0"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ""),
    ("wtfpl", "wtfpl", r"wtfpl", "2"),
    ("zlib", "zlib", rf"(?:the )?zlib(?: libpng)? {LICENSE}", ""),
    ("bsl", "boost", rf"boost software {LICENSE}", "1.0"),
    ("artistic", "artistic", rf"artistic {LICENSE}", "1.0 2.0"),
    ("ofl", "sil", rf"sil open font {LICENSE}", "1.0 1.1"),
    ("eupl", "eupl", r"eupl", "1.0 1.1 1.2"),
    ("eupl", "european", rf"european union public {LICENSE}", "1.0 1.1 1.2"),
    ("osl", "open", rf"open software {LICENSE}", "1.0 2.0 2.1 3.0"),
    ("afl", "academic", rf"academic free {LICENSE}", "1.1 1.2 2.0 2.1 3.0"),
    ("ms-pl", "microsoft", rf"microsoft public {LICENSE}", ""),
    ("ms-rl", "microsoft", rf"microsoft reciprocal {LICENSE}", ""),
    ("psf", "python", rf"python software foundation {LICENSE}", "2"),
    ("php", "php", rf"php {LICENSE}", "3.0 3.01"),
    ("ruby", "ruby", rf"ruby {LICENSE}", ""),
    ("postgresql", "postgresql", rf"postgresql {LICENSE}", ""),
    ("openssl", "openssl", rf"openssl {LICENSE}", ""),
    ("w3c", "w3c", rf"w3c software (?:notice and )?{LICENSE}", ""),
    ("odbl", "database", rf"open (?:data commons open )?database {LICENSE}", "1.0"),
    ("busl", "business", rf"business source {LICENSE}", "1.0 1.1"),
    ("sspl", "server", rf"server side public {LICENSE}", "1"),
    ("elastic", "elastic", rf"elastic {LICENSE}", "1.0 2.0"),
    ("llama", "llama", rf"llama (?:\S+ )?community {LICENSE}", ""),
    ("openrail", "openrail", r"(?:bigscience |creativeml )?openrail(?: m)?", ""),
)
# label, keyword, pattern, priority, doubt: statements that belong to no family.
STATEMENTS = (
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software", 5, 0.01),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose", 5, 0.02),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", 5, 0.01),
    ("apache", "compliance", r"you may not use this file except in compliance with the license", 5, 0.05),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license", 5, 0.01),
    ("lgpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license", 5, 0.01),
    ("agpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public license", 5, 0.01),
    ("public-domain", "domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", 3, 0.1),
    ("public-domain", "domain", r"this (?:work|software|file) is in the public domain", 3, 0.1),
    ("proprietary", "rights", r"all rights reserved", 1, 0.5),
    ("proprietary", "proprietary", r"proprietary and confidential", 3, 0.1),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)\d\d", 1, 0.6),
    ("no-warranty", "warranty", r"provided as is without warranty of any kind", 2, 0.4),
    # wordings of permissive licenses
    ("mit", "substantial", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 5, 0.02),
    ("mit", "deal", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies", 5, 0.01),
    ("mit", "holders", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability", 5, 0.05),
    ("x11", "consortium", r"except as contained in this notice the name of the x consortium shall not be used in advertising", 5, 0.01),
    ("curl", "advertising", r"except as contained in this notice the name of a copyright holder shall not be used in advertising", 5, 0.02),
    ("ncsa", "restriction", r"to deal with the software without restriction", 5, 0.05),
    ("upl", "condition", r"subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data", 5, 0.01),
    ("unicode", "obtaining", r"to any person obtaining a copy of (?:the unicode )?data files and any associated documentation", 5, 0.02),
    ("hpnd", "documentation", r"permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted", 5, 0.05),
    ("postgresql", "agreement", r"for any purpose without fee and without a written agreement is hereby granted", 5, 0.02),
    ("postgresql", "california", r"in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages", 5, 0.1),
    ("isc", "disclaims", r"the software is provided as is and the author disclaims all warranties with regard to this software", 5, 0.02),
    ("isc", "whatsoever", r"be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits", 4, 0.2),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", 5, 0.02),
    ("bsd", "reproduce", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer", 5, 0.02),
    ("bsd", "contributors", r"this software is provided by the (?:\S+ ){1,8}and contributors as is and any express or implied warranties", 5, 0.05),
    ("bsd-2-clause-views", "conclusions", r"the views and conclusions contained in the software and documentation are those of the authors", 5, 0.02),
    ("bsd-3-clause", "endorse", r"neither the name of (?:\S+ ){1,12}nor the names of its contributors may be used to endorse or promote products", 5, 0.02),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 5, 0.01),
    ("apache", "basis", r"software distributed under the license is distributed on an as is basis without warranties or conditions of any kind", 5, 0.03),
    ("apache", "permissions", r"see the license for the specific language governing permissions and limitations under the license", 5, 0.05),
    ("apache", "irrevocable", r"a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of", 5, 0.02),
    ("apache", "prominent", r"you must cause any modified files to carry prominent notices stating that you changed the files", 5, 0.03),
    ("apache", "contributor", r"licensed to the apache software foundation asf under one or more contributor license agreements", 5, 0.01),
    ("apache-1.1", "apache", r"this product includes software developed by the apache (?:software foundation|group)", 5, 0.03),
    ("apache-1.1", "apache", r"products derived from this software may not be called apache", 5, 0.01),
    ("zlib", "held", r"without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", 5, 0.01),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented", 5, 0.02),
    ("zlib", "altered", r"altered source versions must be plainly marked as such", 5, 0.02),
    ("libpng", "png", r"the png reference library is supplied as is", 5, 0.01),
    ("bsl", "organization", r"to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", 5, 0.01),
    ("bsl", "executable", r"solely in the form of machine executable object code generated by a source language processor", 5, 0.01),
    ("ms-pl", "contribution", r"each contributor grants you a non exclusive worldwide royalty free copyright license to reproduce its contribution", 5, 0.05),
    ("ms-pl", "accept", r"if you use the software you accept this license if you do not accept the license do not use the software", 5, 0.05),
    ("ms-rl", "recipients", r"you must provide recipients the source code to that file along with a copy of this license", 5, 0.02),
    ("psf", "licensee", r"this license agreement is between the python software foundation psf and the individual or organization licensee", 5, 0.01),
    ("psf", "beopen", r"beopen (?:com license|python open source license) agreement", 5, 0.02),
    ("psf", "cnri", r"cnri (?:open source )?license agreement for python", 5, 0.02),
    ("psf", "mathematisch", r"stichting mathematisch centrum amsterdam", 4, 0.1),
    ("php", "php", r"this product includes php software freely available from", 5, 0.02),
    ("php", "php", r"the name php must not be used to endorse or promote products derived from this software", 5, 0.01),
    ("ruby", "verbatim", r"you may make and give away verbatim copies of the source form of the software without restriction", 5, 0.02),
    ("openssl", "openssl", r"this product includes software developed by the openssl project", 5, 0.02),
    ("ssleay", "cryptographic", r"this product includes cryptographic software written by eric young", 5, 0.01),
    ("w3c", "royalty", r"with or without modification for any purpose and without fee or royalty is hereby granted", 5, 0.03),
    ("tcl", "authors", r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose", 5, 0.01),
    ("ijg", "jpeg", r"this software is based in part on the work of the independent jpeg group", 5, 0.01),
    ("ftl", "freetype", r"the freetype project license|portions of this software are copyright (?:\S+ ){1,4}the freetype project", 5, 0.02),
    ("info-zip", "individuals", r"info zip is defined as the following set of individuals", 5, 0.01),
    ("json", "evil", r"the software shall be used for good not evil", 5, 0.01),
    ("beerware", "beer", r"you think this stuff is worth it you can buy me a beer in return", 5, 0.01),
    ("vim", "charityware", r"vim is charityware", 5, 0.02),
    ("wtfpl", "fuck", r"you just do what the fuck you want to", 5, 0.02),
    ("wtfpl", "verbatim", r"verbatim or modified copies of this license document and changing it is allowed as long as the name is changed", 5, 0.01),
    ("blueoak", "oak", r"blue oak model license", 5, 0.02),
    ("blueoak", "revoke", r"no contributor can revoke this license", 5, 0.05),
    ("mulan", "mulan", r"mulan permissive software license", 5, 0.02),
    ("ecl", "educational", r"educational community license", 4, 0.05),
    ("zpl", "zope", r"zope public license", 4, 0.05),
    ("aal", "assurance", r"attribution assurance license", 4, 0.05),
    ("lucent", "lucent", r"lucent public license", 4, 0.05),
    # wordings of reciprocal licenses
    ("gnu", "hope", r"distributed in the hope that it will be useful but without any warranty", 5, 0.05),
    ("gnu", "option", r"either version [123](?: \d)? of the license or at your option any later version", 5, 0.03),
    ("gnu", "franklin", r"free software foundation inc 51 franklin st(?:reet)?", 4, 0.1),
    ("gnu", "temple", r"free software foundation inc 59 temple place", 4, 0.1),
    ("gnu", "verbatim", r"verbatim copies of this license document but changing it is not allowed", 5, 0.03),
    ("gpl", "received", r"you should have received a copy of the gnu general public license", 5, 0.02),
    ("lgpl", "received", r"you should have received a copy of the gnu (?:lesser|library) general public license", 5, 0.02),
    ("agpl", "received", r"you should have received a copy of the gnu affero general public license", 5, 0.02),
    ("gpl-2.0", "freedom", r"the licenses for most software are designed to take away your freedom to share and change it", 5, 0.02),
    ("gpl-2.0", "activities", r"activities other than copying distribution and modification are not covered by this license", 5, 0.02),
    ("gpl-3.0", "copyleft", r"the gnu general public license is a free copyleft license for software and other kinds of works", 5, 0.01),
    ("gpl-3.0", "convey", r"you may convey verbatim copies of the program s source code as you receive it", 5, 0.02),
    ("gpl-3.0", "propagate", r"to propagate a work means to do anything with it that without permission would make you", 5, 0.02),
    ("gpl-3.0", "corresponding", r"the corresponding source for a work in object code form means all the source code needed", 5, 0.02),
    ("gpl-linking-exception", "exception", r"as a special exception the copyright holders of this (?:library|program|file) give you permission to link", 5, 0.02),
    ("classpath-exception", "statically", r"linking this library statically or dynamically with other modules is making a combined work", 5, 0.02),
    ("bison-exception", "bison", r"a larger work that contains part or all of the bison parser skeleton", 5, 0.01),
    ("gcc-exception", "gcc", r"gcc runtime library exception", 5, 0.02),
    ("llvm-exception", "llvm", r"llvm exceptions to the apache 2 0 license", 5, 0.01),
    ("lgpl-2.1", "derivative", r"a work that contains no derivative of any portion of the library but is designed to work with the library", 5, 0.02),
    ("lgpl-2.1", "specially", r"applies to some specially designated software packages", 5, 0.05),
    ("lgpl-3.0", "application", r"an application is any work that makes use of an interface provided by the library", 5, 0.02),
    ("agpl-3.0", "remotely", r"must prominently offer all users interacting with it remotely through a computer network", 5, 0.01),
    ("agpl-3.0", "remote", r"remote network interaction use with the gnu general public license", 5, 0.02),
    ("gfdl", "document", r"copy distribute and or modify this document under the terms of the gnu free documentation license", 5, 0.01),
    ("gfdl", "invariant", r"with no invariant sections no front cover texts and no back cover texts", 5, 0.02),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license", 5, 0.01),
    ("mpl-2.0", "mpl", r"if a copy of the mpl was not distributed with this file", 5, 0.01),
    ("mpl-2.0", "incompatible", r"incompatible with secondary licenses", 5, 0.05),
    ("mpl", "contents", r"the contents of this file are subject to the mozilla public license", 5, 0.02),
    ("mpl", "governing", r"see the license for the specific language governing rights and limitations under the license", 5, 0.05),
    ("npl", "netscape", r"subject to the netscape public license", 5, 0.02),
    ("epl", "accompanying", r"this program and the accompanying materials are made available under the terms of the eclipse public license", 5, 0.01),
    ("epl", "accompanying", r"the accompanying program is provided under the terms of this eclipse public license", 5, 0.01),
    ("cpl", "accompanying", r"the accompanying program is provided under the terms of this common public license", 5, 0.01),
    ("cddl", "contents", r"the contents of this file are subject to the terms of the common development and distribution license", 5, 0.01),
    ("cddl", "header", r"include this cddl header in each file", 5, 0.02),
    ("cddl", "opensolaris", r"usr src opensolaris license", 5, 0.05),
    ("artistic-1.0", "intent", r"the intent of this document is to state the conditions under which a package may be copied", 5, 0.01),
    ("artistic-1.0", "verbatim", r"verbatim copies of the source form of the standard version of this package", 5, 0.02),
    ("artistic-2.0", "establishes", r"this license establishes the terms under which a given free software package may be copied", 5, 0.01),
    ("perl", "perl", r"the same terms as (?:perl itself|the perl 5 programming language system itself)", 5, 0.03),
    ("ofl", "font", r"this font software is licensed under the sil open font license", 5, 0.01),
    ("ofl", "font", r"neither the font software nor any of its individual components in original or modified versions may be sold by itself", 5, 0.01),
    ("eupl", "european", r"this european union public licence the \S*eupl\S* applies to the work", 5, 0.01),
    ("osl", "sublicensable", r"a worldwide royalty free non exclusive sublicensable license for the duration of the copyright", 5, 0.05),
    ("sleepycat", "accompanied", r"redistributions in any form must be accompanied by information on how to obtain complete source code", 5, 0.01),
    ("lppl", "latex", r"latex project public license", 5, 0.03),
    ("qpl", "q", r"the q public license", 4, 0.05),
    ("apsl", "apple", r"apple public source license", 4, 0.05),
    ("rpl", "reciprocal", r"reciprocal public license", 4, 0.05),
    ("cpal", "attribution", r"common public attribution license", 4, 0.05),
    ("cecill", "cecill", r"cecill(?: b| c)? free software license agreement", 4, 0.03),
    ("watcom", "watcom", r"sybase open watcom public license", 4, 0.03),
    ("nasa", "nasa", r"nasa open source agreement", 4, 0.05),
    ("parity", "parity", r"parity public license", 4, 0.05),
    # wordings for content and data
    ("cc", "redistribute", r"copy and redistribute the material in any medium or format", 5, 0.03),
    ("cc-by", "commercially", r"remix transform and build upon the material for any purpose even commercially", 5, 0.05),
    ("cc", "credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made", 5, 0.03),
    ("cc-by-nc", "commercial", r"you may not use the material for commercial purposes", 5, 0.05),
    ("cc-by-sa", "contributions", r"build upon the material you must distribute your contributions under the same license as the original", 5, 0.03),
    ("cc-by-nd", "modified", r"build upon the material you may not distribute the modified material", 5, 0.03),
    ("cc", "firm", r"creative commons corporation is not a law firm and does not provide legal services", 5, 0.02),
    ("cc", "exercising", r"by exercising the licensed rights defined below you accept and agree to be bound by the terms", 5, 0.02),
    ("cc", "commons", r"this work is licensed under a creative commons", 5, 0.05),
    ("cc0", "waived", r"waived all copyright and related or neighboring rights", 5, 0.02),
    ("cc0", "affirmer", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives", 5, 0.01),
    ("cc0", "deed", r"the person who associated a work with this deed has dedicated the work to the public domain", 5, 0.01),
    ("odbl", "contents", r"any rights in individual contents of the database are licensed under the database contents license", 5, 0.01),
    ("odbl", "database", r"is made available under the open database license", 5, 0.03),
    ("odc-by", "attribution", r"open data commons attribution license", 5, 0.02),
    ("pddl", "dedication", r"open data commons public domain dedication and licen[cs]e", 5, 0.02),
    ("ogl", "government", r"public sector information licensed under the open government licen[cs]e", 5, 0.01),
    ("gutenberg", "ebook", r"this ebook is for the use of anyone anywhere", 5, 0.02),
    ("gutenberg", "gutenberg", r"the project gutenberg license included with this ebook", 5, 0.01),
    ("arxiv", "arxiv", r"arxiv org perpetual non exclusive license", 5, 0.02),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 5, 0.01),
    ("unlicense", "anyone", r"anyone is free to copy modify publish use compile sell or distribute this software", 5, 0.02),
    ("blessing", "blessing", r"in place of a legal notice here is a blessing", 5, 0.01),
    ("nist", "pursuant", r"pursuant to title 17 section 105 of the united states code this software is not subject to copyright protection", 5, 0.01),
    ("us-government", "government", r"works? of the (?:united states|u s) government", 3, 0.2),
    # wordings of restricted use
    ("busl", "production", r"redistribute and make non production use of the licensed work", 5, 0.01),
    ("busl", "anniversary", r"the fourth anniversary of the first publicly available distribution", 5, 0.02),
    ("sspl", "functionality", r"make the functionality of the program or a modified version available to third parties as a service", 5, 0.01),
    ("elastic", "hosted", r"you may not provide the software to third parties as a hosted or managed service", 5, 0.01),
    ("elastic", "circumvent", r"you may not move change disable or circumvent the license key functionality", 5, 0.01),
    ("commons-clause", "sell", r"the license does not grant to you the right to sell the software", 5, 0.02),
    ("commons-clause", "clause", r"commons clause license condition", 5, 0.02),
    ("polyform", "polyform", r"polyform (?:noncommercial|small business|shield|perimeter|strict) license", 5, 0.02),
    ("prosperity", "prosperity", r"prosperity public license", 4, 0.05),
    ("hippocratic", "hippocratic", r"hippocratic license", 4, 0.05),
    ("llama", "monthly", r"greater than 700 million monthly active users", 5, 0.02),
    ("llama", "llama", r"limited license under meta s intellectual property (?:\S+ ){1,12}llama materials", 5, 0.02),
    ("gemma", "gemma", r"gemma is provided under and subject to the gemma terms of use", 5, 0.01),
    ("openrail", "derivatives", r"you agree not to use the model or derivatives of the model", 5, 0.03),
    ("openrail", "enforceable", r"must be included as an enforceable provision", 4, 0.1),
    ("patent-grant", "patent", r"additional grant of patent rights", 4, 0.1),
    ("eula", "decompile", r"reverse engineer decompile or disassemble", 3, 0.2),
    ("eula", "user", r"end user licen[cs]e agreement", 3, 0.2),
    ("proprietary", "unauthorized", r"unauthorized copying of this file via any medium is strictly prohibited", 5, 0.02),
    ("proprietary", "reproduced", r"no part of this (?:publication|book|document|work) may be reproduced", 4, 0.1),
    ("proprietary", "reproduction", r"reproduction in whole or in part without (?:written )?permission is prohibited", 4, 0.1),
    ("proprietary", "confidential", r"the confidential and proprietary information of", 3, 0.1),
    ("research-only", "research", r"for (?:academic )?research (?:use|purposes) only", 3, 0.2),
    ("non-commercial", "commercial", r"for (?:personal and |personal )?non commercial (?:use|purposes) only", 3, 0.2),
)


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: re.Pattern
    priority: int
    doubt: float


@cache
def rules() -> tuple[Rule, ...]:
    """Every family in every form, then the statements, in order."""
    made: list[Rule] = []

    def add(label: str, keyword: str, pattern: str, priority: int, doubt: float) -> None:
        made.append(Rule(label, keyword, re.compile(rf"(?<= )(?:{pattern})(?= )"), priority, doubt))

    for label, keyword, names, versions in FAMILIES:
        named = f"(?:{names})"
        short = keyword in names.split("|")
        for version in versions.split():
            said = version.replace(".", " ")
            full = f"{label}-{version.replace('.', '-') if 'clause' in version else version}"
            add(full, keyword, rf"{named} (?:version |v ?)?{said}(?: or (?:any )?later(?: version)?| only)?", 4, 0.05)
            add(full, keyword, rf"(?:under|the|with) (?:terms of )?(?:the )?{named} (?:version |v ?)?{said}", 5, 0.02)
            add(full, "spdx", rf"spdx license identifier {label.replace('-', ' ')} {said}(?: only| or later)?", 6, 0.01)
        add(label, keyword, rf"(?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?{named}", 3, 0.1)
        add(label, keyword, rf"subject to (?:the )?(?:terms of )?(?:the )?{named}", 3, 0.15)
        add(label, "spdx", rf"spdx license identifier {label.replace('-', ' ')}", 5, 0.02)
        add(label, keyword, rf"{named} {LICENSE}" if short else named, 2, 0.3)
    for statement in STATEMENTS:
        add(*statement)
    return tuple(made)


@cache
def keywords() -> tuple[str, ...]:
    return tuple(dict.fromkeys([*(r.keyword for r in rules()), *(p.split()[0] for p, _ in BASE)]))


def suppressed(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Survivors of detections (first, last, priority, rule). Spans are taken by priority;
    one that lies within a kept span, or holds one of higher priority, goes."""
    kept: list[tuple[int, int, int, int]] = []
    # No kept span holds another, so both their ends ascend: of those that begin before a
    # span the last one reaches furthest, of those that begin within it the first one least.
    firsts: list[int] = []
    lasts: list[int] = []
    for first, last, priority, rule in sorted(set(found), key=lambda d: (-d[2], d[0] - d[1], d[0], d[3])):
        before, after = bisect_right(firsts, first), bisect_left(firsts, first)
        inside = before > 0 and lasts[before - 1] >= last
        around = after < len(firsts) and lasts[after] <= last
        if not inside and not around:
            firsts.insert(before, first)
            lasts.insert(before, last)
            kept.append((first, last, priority, rule))
    return sorted(kept)


class Scanner:
    def __init__(self, _: object):
        table = np.full(256, 0x20, np.uint8)
        for b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
            table[b] = b
        table[0x41:0x5B] = table[0x61:0x7B]
        self.table = table
        self.base = [(re.compile(rf"(?<= ){phrase}(?= )"), label) for phrase, label in BASE]
        self.gate = re.compile(r"(?<= )(?:" + "|".join(map(re.escape, keywords())) + r")(?= )")
        self.gate_bytes = "|".join(map(re.escape, keywords()))
        self.by_keyword: dict[str, list[int]] = {}
        for number, rule in enumerate(rules()):
            self.by_keyword.setdefault(rule.keyword, []).append(number)

    def scan_words(self, words: list[str]) -> tuple:
        """(places of base phrases, base labels, labels, score) of one text's words."""
        joined = f" {' '.join(words)} "
        starts = np.cumsum([1, *(len(w) + 1 for w in words)])
        word_at = lambda offset: int(np.searchsorted(starts, offset))
        places, base_labels = [], set()
        for pattern, label in self.base:
            for match in pattern.finditer(joined):
                places.append(word_at(match.start()))
                base_labels.add(label)
        found = []
        for keyword in set(self.gate.findall(joined)):
            for number in self.by_keyword.get(keyword, ()):
                rule = rules()[number]
                found += [(word_at(m.start()), word_at(m.end() + 1) - 1, rule.priority, number) for m in rule.pattern.finditer(joined)]
        spoke = {number for *_, number in suppressed(found)}
        doubt = float(np.prod([rules()[n].doubt for n in sorted(spoke)])) if spoke else 1.0
        if base_labels:
            doubt = min(doubt, 0.3)
        return places, base_labels, base_labels | {rules()[n].label for n in spoke}, 1.0 - doubt

    def scan(self, texts: pa.Array) -> tuple:
        n = len(texts)
        raw = texts.cast(pa.large_binary())
        cuts = np.frombuffer(raw.buffers()[1], np.int64, n + 1, raw.offset * 8)
        data = self.table[np.frombuffer(raw.buffers()[2] or b"", np.uint8)[cuts[0]:cuts[-1]]]
        cuts = cuts - cuts[0]
        begins = data != 0x20
        begins[1:] &= data[:-1] == 0x20
        edges = cuts[:-1][np.diff(cuts) > 0]
        begins[edges] = data[edges] != 0x20  # a text's first word begins there
        counts = np.diff(np.concatenate([[0], np.cumsum(begins)])[cuts])
        plain = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
        hit = np.flatnonzero(pc.match_substring_regex(plain, self.gate_bytes).to_numpy(zero_copy_only=False))
        n_base, first, last = np.zeros(n, np.int64), [None] * n, [None] * n
        base, labels, score = [""] * n, [""] * n, np.zeros(n)
        for i in hit:
            words = data[cuts[i]:cuts[i + 1]].tobytes().decode("utf-8", "replace").split(" ")
            places, own, every, score[i] = self.scan_words([w for w in words if w])
            if places:
                n_base[i], first[i], last[i] = len(places), min(places), max(places)
            base[i], labels[i] = ",".join(sorted(own)), ",".join(sorted(every))
        return counts, n_base, pa.array(first, pa.int64()), pa.array(last, pa.int64()), base, labels, score


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``docs`` with word counts, base phrases, labels and a score."""
    added = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    return scored(docs, None, Scanner, added, Scanner.scan)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs).drop("text")
