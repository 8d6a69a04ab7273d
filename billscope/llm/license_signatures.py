"""Signatures of operator 5, written by hand: what licences, notices and terms say in places that name no licence or only imply it.

Each pattern runs over normalised words, one space between them. It begins with at least two literal words: these are the
keyword that lets its rule run. SIGNATURES lists (label, pattern) by kind; PRIORITY orders the kinds.
"""

import re

#: Identifiers of the SPDX list, as normalised words, and the labels they stand for.
SPDX = {
    "mit": ("mit",),
    "mit-0": ("mit 0",),
    "x11": ("x11",),
    "apache-1.1": ("apache 1 1",),
    "apache-2.0": ("apache 2 0",),
    "bsd-2-clause": ("bsd 2 clause", "bsd 2 clause patent", "bsd 2 clause freebsd"),
    "bsd-3-clause": ("bsd 3 clause", "bsd 3 clause clear"),
    "bsd-4-clause": ("bsd 4 clause", "bsd 4 clause uc"),
    "0bsd": ("0bsd",),
    "isc": ("isc",),
    "gpl-2.0": ("gpl 2 0", "gpl 2 0 only"),
    "gpl-3.0": ("gpl 3 0", "gpl 3 0 only"),
    "gpl-or-later": ("gpl 2 0 or later", "gpl 3 0 or later"),
    "lgpl-2.1": ("lgpl 2 1", "lgpl 2 1 only", "lgpl 2 1 or later"),
    "lgpl-3.0": ("lgpl 3 0", "lgpl 3 0 only", "lgpl 3 0 or later"),
    "agpl-3.0": ("agpl 3 0", "agpl 3 0 only", "agpl 3 0 or later"),
    "gfdl": ("gfdl 1 2", "gfdl 1 3", "gfdl 1 3 or later"),
    "mpl-1.1": ("mpl 1 1",),
    "mpl-2.0": ("mpl 2 0",),
    "epl-1.0": ("epl 1 0",),
    "epl-2.0": ("epl 2 0",),
    "cddl": ("cddl 1 0", "cddl 1 1"),
    "cpl": ("cpl 1 0",),
    "eupl": ("eupl 1 1", "eupl 1 2"),
    "artistic": ("artistic 1 0", "artistic 1 0 perl"),
    "artistic-2.0": ("artistic 2 0",),
    "boost": ("bsl 1 0",),
    "zlib": ("zlib",),
    "unlicense": ("unlicense",),
    "wtfpl": ("wtfpl",),
    "cc0": ("cc0 1 0",),
    "cc-by-4.0": ("cc by 4 0",),
    "cc-by-sa": ("cc by sa 3 0", "cc by sa 4 0"),
    "cc-by-nd": ("cc by nd 4 0",),
    "cc-by-nc": ("cc by nc 4 0",),
    "cc-by-nc-sa": ("cc by nc sa 4 0",),
    "cc-by-nc-nd": ("cc by nc nd 4 0",),
    "odbl": ("odbl 1 0",),
    "odc-by": ("odc by 1 0",),
    "pddl": ("pddl 1 0",),
    "ofl": ("ofl 1 1",),
    "psf": ("python 2 0", "psf 2 0"),
    "php": ("php 3 01",),
    "ruby": ("ruby",),
    "openssl": ("openssl",),
    "postgresql": ("postgresql",),
    "ncsa": ("ncsa",),
    "ms-pl": ("ms pl",),
    "ms-rl": ("ms rl",),
    "sspl": ("sspl 1 0",),
    "busl": ("busl 1 1",),
    "elastic": ("elastic 2 0",),
    "polyform": ("polyform noncommercial 1 0 0", "polyform small business 1 0 0"),
    "afl": ("afl 3 0",),
    "osl": ("osl 3 0",),
}

#: Grants settle a licence, notices state one, addresses point to one; conditions and disclaimers are shared by more texts.
PRIORITY = {"spdx": 97, "grant": 95, "notice": 88, "address": 82, "condition": 72, "terms": 65, "disclaimer": 30}

SIGNATURES = {
    "grant": (
        ("mit", r"to use copy modify merge publish distribute sublicense and or sell copies of the software"),
        ("mit-0", r"to permit persons to whom the software is furnished to do so the software is provided as is"),
        ("x11", r"permission to use copy modify distribute and sell this software and its documentation for any purpose"),
        ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that"),
        ("0bsd", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software"),
        ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
        ("boost", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
        ("ncsa", r"to deal with the software without restriction including without limitation the rights to use"),
        ("zlib", r"permission is granted to anyone to use this software for any purpose including commercial applications"),
        ("apache-2.0", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated)"),
        ("apache-2.0", r"patent license to make have made use offer to sell sell import and otherwise transfer the work"),
        ("gpl-2.0", r"the licenses for most software are designed to take away your freedom to share and change it"),
        ("gpl-2.0", r"you may copy and distribute verbatim copies of the program s source code as you receive it"),
        ("gpl-3.0", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
        ("gpl-3.0", r"this license refers to version 3 of the gnu general public license"),
        ("gpl-3.0", r"all rights granted under this license are granted for the term of copyright on the program"),
        ("lgpl-2.1", r"this license agreement applies to any software library or other program which contains a notice"),
        ("lgpl-2.1", r"you may copy and distribute verbatim copies of the library s complete source code"),
        ("lgpl-3.0", r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3"),
        ("agpl-3.0", r"the gnu affero general public license is a free copyleft license for software and other kinds of works"),
        ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
        ("gfdl", r"the purpose of this license is to make a manual textbook or other functional and useful document free"),
        ("mpl-1.1", r"the initial developer hereby grants you a world wide royalty free non exclusive license"),
        ("mpl-2.0", r"each contributor hereby grants you a world wide royalty free non exclusive license under intellectual property rights"),
        ("epl-any", r"the accompanying program is provided under the terms of this eclipse public license"),
        ("epl-any", r"subject to the terms of this agreement each contributor hereby grants recipient a non exclusive worldwide royalty free"),
        ("cpl", r"the accompanying program is provided under the terms of this common public license"),
        ("cddl", r"conditioned upon your compliance with section 3 1 below and subject to third party intellectual property claims the initial developer"),
        ("eupl", r"the licensor hereby grants you a worldwide royalty free non exclusive sublicensable licen[cs]e"),
        ("artistic", r"the intent of this document is to state the conditions under which a package may be copied"),
        ("artistic-2.0", r"this license establishes the terms under which a given free software package may be copied modified distributed"),
        ("unlicense", r"this is free and unencumbered software released into the public domain"),
        ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software"),
        ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed"),
        ("cc0", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders"),
        ("cc-by-any", r"by exercising the licensed rights defined below you accept and agree to be bound by the terms and conditions of this creative commons attribution"),
        ("cc-any", r"the licensor hereby grants you a worldwide royalty free non sublicensable non exclusive irrevocable license to exercise the licensed rights"),
        ("cc-any", r"the work as defined below is provided under the terms of this creative commons public licen[cs]e"),
        ("cc-any", r"you are free to share copy and redistribute the material in any medium or format"),
        ("cc-any", r"you are free to copy distribute(?: display)?(?: and)? (?:transmit|perform) the work"),
        ("odbl", r"the licensor grants to you a worldwide royalty free non exclusive terminable but only under section 9 license to use the database"),
        ("pddl", r"the open data commons public domain dedication (?:and|amp) licen[cs]e is a document intended to allow you to freely share"),
        ("ogl-uk", r"you are free to copy publish distribute and transmit the information adapt the information"),
        ("ofl", r"permission is hereby granted free of charge to any person obtaining a copy of the font software"),
        ("psf", r"psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test"),
        ("ruby", r"you may make and give away verbatim copies of the source form of the software without restriction"),
        ("ms-pl", r"this license governs use of the accompanying software if you use the software you accept this license"),
        ("sspl", r"the server side public license is a copyleft license"),
        ("busl", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
        ("elastic", r"the licensor grants you a non exclusive royalty free worldwide non sublicensable non transferable license to use copy distribute make available"),
        ("polyform", r"the licensor grants you a copyright license for the software to do everything you might do with the software"),
        ("rail", r"subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare publicly display publicly perform sublicense and distribute the complementary material"),
    ),
    "notice": (
        ("gpl-any", r"this program is free software you can redistribute it and or modify it"),
        ("gpl-any", r"you should have received a copy of the gnu general public license"),
        ("lgpl-any", r"this library is free software you can redistribute it and or modify it"),
        ("lgpl-any", r"you should have received a copy of the gnu (?:lesser|library) general public license"),
        ("agpl-any", r"you should have received a copy of the gnu affero general public license"),
        ("gpl-classpath", r"linking this library statically or dynamically with other modules is making a combined work based on this library"),
        ("gpl-classpath", r"as a special exception the copyright holders of this library give you permission to link this library"),
        ("gpl-runtime", r"under section 7 of gpl version 3 you are granted additional permissions described in the gcc runtime library exception"),
        ("gfdl", r"with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts"),
        ("apache-2.0", r"you may not use this file except in compliance with the license"),
        ("apache-2.0", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
        ("apache-1.1", r"this product includes software developed by the apache software foundation"),
        ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version"),
        ("mpl-1.1", r"alternatively the contents of this file may be used under the terms of either the gnu"),
        ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license"),
        ("mpl-2.0", r"if a copy of the mpl was not distributed with this file"),
        ("epl-any", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
        ("cddl", r"the contents of this file are subject to the terms of the common development and distribution license"),
        ("cddl", r"when distributing covered code include this cddl header"),
        ("eupl", r"licensed under the eupl(?: v(?:ersion)?)?"),
        ("artistic", r"under the same terms as perl(?: itself)?"),
        ("boost", r"distributed under the boost software license"),
        ("bsd", r"use of this source code is governed by a bsd style license"),
        ("mit", r"use of this source code is governed by an mit style license"),
        ("mit", r"licensed under the mit(?: license)?"),
        ("isc", r"licensed under the isc(?: license)?"),
        ("wtfpl", r"you just do what the fuck you want to"),
        ("cc0", r"the person who associated a work with this deed has dedicated the work to the public domain"),
        ("cc0", r"to the extent possible under law(?: \S+){1,12} waived all copyright and related or neighbou?ring rights"),
        ("cc-any", r"this work is licensed under (?:a|the) creative commons"),
        ("cc-any", r"except where otherwise noted(?: \S+){1,8} licensed under a creative commons"),
        ("cc-by-any", r"this is an open access article distributed under the terms of the creative commons attribution"),
        ("cc-by-any", r"this article is distributed under the terms of the creative commons attribution"),
        ("cc-by-sa", r"text is available under the creative commons attribution (?:share alike|sharealike)"),
        ("cc-any", r"dieses werk ist lizenziert unter einer creative commons"),
        ("cc-any", r"cette œuvre est mise à disposition (?:sous|selon) (?:licence|les termes de la licence) creative commons"),
        ("cc-any", r"cette oeuvre est mise à disposition (?:sous|selon) (?:licence|les termes de la licence) creative commons"),
        ("cc-any", r"esta obra está bajo una licencia(?: de)? creative commons"),
        ("cc-any", r"quest opera è distribuita con licenza creative commons"),
        ("odbl", r"this database is made available under the open database license"),
        ("odbl", r"any rights in individual contents of the database are licensed under"),
        ("odc-by", r"contains information from(?: \S+){1,8} which is made available under the odc attribution license"),
        ("ogl-uk", r"contains public sector information licensed under the open government licence"),
        ("ofl", r"this font software is licensed under the sil open font license"),
        ("ofl", r"with reserved font names?"),
        ("psf", r"this license agreement is between the python software foundation"),
        ("php", r"this product includes php software freely available from"),
        ("openssl", r"this product includes software developed by the openssl project"),
        ("openssl", r"this product includes cryptographic software written by eric young"),
        ("bsd-4-clause", r"this product includes software developed by the university of california"),
        ("busl", r"use of this software is governed by the business source license"),
        ("elastic", r"licensed under the elastic license"),
        ("afl", r"licensed under the academic free license"),
        ("osl", r"licensed under the open software license"),
        ("public-domain", r"has been (?:placed|released|put) in(?:to)? the public domain"),
        ("public-domain", r"is in the public domain"),
        ("public-domain", r"no rights reserved"),
        ("public-domain", r"no known copyright restrictions"),
        ("us-government", r"not subject to copyright protection in the united states"),
        ("us-government", r"is a work of the (?:united states|u s) government"),
        ("us-government", r"pursuant to title 17(?: section 105)? of the united states code"),
        ("crown-copyright", r"crown copyright(?: reserved)?(?: (?:19|20)\d\d)?"),
        ("reserved", r"alle rechte vorbehalten"),
        ("reserved", r"tous droits réservés"),
        ("reserved", r"todos los derechos reservados"),
        ("reserved", r"todos os direitos reservados"),
        ("reserved", r"tutti i diritti riservati"),
        ("reserved", r"alle rechten voorbehouden"),
        ("reserved", r"wszelkie prawa zastrzeżone"),
        ("reserved", r"all rights are reserved by"),
        ("copyleft", r"some rights reserved under"),
    ),
    "address": (
        ("apache-2.0", r"www apache org licenses license 2 0"),
        ("gpl-any", r"gnu org licenses gpl(?: (?:2|3) 0)?"),
        ("gpl-2.0", r"gnu org licenses old licenses gpl 2 0"),
        ("lgpl-any", r"gnu org licenses lgpl(?: (?:2 1|3 0))?"),
        ("agpl-any", r"gnu org licenses agpl(?: 3 0)?"),
        ("gfdl", r"gnu org licenses fdl(?: 1 \d)?"),
        ("gpl-2.0", r"free software foundation inc 5(?:1|9) (?:franklin street|temple place)"),
        ("mpl-any", r"mozilla org mpl(?: (?:1 1|2 0))?"),
        ("epl-any", r"eclipse org legal epl (?:v10|v20|2 0)"),
        ("cddl", r"opensolaris org os licensing"),
        ("eupl", r"joinup ec europa eu(?: \S+){0,6} eupl"),
        ("mit", r"opensource org licenses mit"),
        ("isc", r"opensource org licenses isc"),
        ("apache-2.0", r"opensource org licenses apache 2 0"),
        ("bsd", r"opensource org licenses bsd(?: [234] clause)?"),
        ("boost", r"boost org license 1 0"),
        ("artistic", r"perlfoundation org artistic licen[cs]e"),
        ("unlicense", r"unlicense org"),
        ("wtfpl", r"sam zoy org wtfpl"),
        ("cc0", r"creativecommons org publicdomain zero"),
        ("public-domain", r"creativecommons org publicdomain mark"),
        ("cc-by-nc-nd", r"creativecommons org licenses by nc nd(?: \d \d)?"),
        ("cc-by-nc-sa", r"creativecommons org licenses by nc sa(?: \d \d)?"),
        ("cc-by-nc", r"creativecommons org licenses by nc(?: \d \d)?"),
        ("cc-by-nd", r"creativecommons org licenses by nd(?: \d \d)?"),
        ("cc-by-sa", r"creativecommons org licenses by sa(?: \d \d)?"),
        ("cc-by-4.0", r"creativecommons org licenses by 4 0"),
        ("cc-by-any", r"creativecommons org licenses by(?: [123] \d)?"),
        ("odbl", r"opendatacommons org licenses odbl"),
        ("odc-by", r"opendatacommons org licenses by"),
        ("pddl", r"opendatacommons org licenses pddl"),
        ("ogl-uk", r"nationalarchives gov uk doc open government licence"),
        ("ofl", r"scripts sil org ofl"),
        ("php", r"php net license"),
        ("postgresql", r"postgresql org about licence"),
        ("sspl", r"mongodb com licensing server side public license"),
        ("busl", r"mariadb com bsl11"),
        ("elastic", r"elastic co licensing elastic license"),
        ("polyform", r"polyformproject org licenses"),
        ("rail", r"bigscience huggingface co blog(?: \S+){0,4} rail"),
    ),
    "condition": (
        ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
        ("isc", r"provided that the above copyright notice and this permission notice appear in all copies"),
        ("x11", r"except as contained in this notice the names? of(?: \S+){1,8} shall not be used in advertising"),
        ("bsd", r"redistributions of source code must retain the above copyright notice"),
        ("bsd", r"redistributions in binary form must reproduce the above copyright notice"),
        ("bsd-3-clause", r"neither the names? of(?: \S+){1,12} nor the names of its contributors may be used to endorse or promote products"),
        ("bsd-3-clause", r"the name of(?: \S+){1,8} may not be used to endorse or promote products derived from this software"),
        ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
        ("apache-1.1", r"products derived from this software may not be called apache"),
        ("php", r"products derived from this software may not be called php"),
        ("openssl", r"products derived from this software may not be called openssl"),
        ("apache-2.0", r"you must give any other recipients of the work or derivative works a copy of this license"),
        ("apache-2.0", r"if the work includes a notice text file as part of its distribution"),
        ("apache-2.0", r"you may obtain a copy of the license at"),
        ("gpl-2.0", r"you must cause the modified files to carry prominent notices stating that you changed the files"),
        ("gpl-2.0", r"accompany it with the complete corresponding machine readable source code"),
        ("gpl-3.0", r"the work must carry prominent notices stating that you modified it"),
        ("gpl-3.0", r"installation information for a user product means any methods procedures authorization keys"),
        ("gpl-3.0", r"to propagate a work means to do anything with it that without permission would make you"),
        ("gpl-3.0", r"additional permissions are terms that supplement the terms of this license by making exceptions"),
        ("lgpl-2.1", r"a program that contains no derivative of any portion of the library"),
        ("lgpl-3.0", r"a combined work is a work produced by combining or linking an application with the library"),
        ("agpl-3.0", r"your modified version must prominently offer all users interacting with it remotely through a computer network"),
        ("gfdl", r"a secondary section is a named appendix or a front matter section"),
        ("mpl-2.0", r"incompatible with secondary licenses"),
        ("mpl-1.1", r"the initial developer of the original code is"),
        ("artistic", r"you may charge a reasonable copying fee for any distribution of this package"),
        ("boost", r"machine executable object code generated by a source language processor"),
        ("zlib", r"the origin of this software must not be misrepresented"),
        ("zlib", r"altered source versions must be plainly marked as such"),
        ("zlib", r"this notice may not be removed or altered from any source distribution"),
        ("unlicense", r"we make this dedication for the benefit of the public at large"),
        ("cc-by-any", r"you must give appropriate credit provide a link to the licen[cs]e and indicate if changes were made"),
        ("cc-nc", r"you may not use (?:the material|this work) for commercial purposes"),
        ("cc-sa", r"if you (?:remix transform|alter transform) or build upon (?:the material|this work) you (?:must|may) distribute (?:your contributions|the resulting work)"),
        ("cc-nd", r"if you remix transform or build upon the material you may not distribute the modified material"),
        ("cc-nd", r"you may not alter transform or build upon this work"),
        ("odbl", r"you must include a notice associated with the produced work"),
        ("ogl-uk", r"acknowledge the source of the information by including any attribution statement"),
        ("ofl", r"neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
        ("ms-rl", r"reciprocal grants for any file you distribute that contains code from the software"),
        ("ms-pl", r"if you bring a patent claim against any contributor over patents that you claim are infringed by the software"),
        ("sspl", r"if you make the functionality of the program or a modified version available to third parties as a service"),
        ("busl", r"additional use grant"),
        ("busl", r"effective on the change date"),
        ("elastic", r"you may not provide the software to third parties as a hosted or managed service"),
        ("elastic", r"you may not move change disable or circumvent the license key functionality"),
        ("polyform", r"any noncommercial purpose is a permitted purpose"),
        ("osl", r"external deployment means the use distribution or communication of the original work"),
        ("rail", r"you agree not to use the model or derivatives of the model"),
        ("rail", r"use based restrictions(?: set forth| as referenced)?"),
    ),
    "terms": (
        ("proprietary", r"contains confidential and proprietary information"),
        ("proprietary", r"contains proprietary and confidential information"),
        ("proprietary", r"contains trade secrets"),
        ("proprietary", r"confidential and proprietary"),
        ("proprietary", r"for internal use only"),
        ("proprietary", r"unauthorized use(?: \S+){0,8} prohibited"),
        ("proprietary", r"unauthorized copying(?: \S+){0,8} prohibited"),
        ("proprietary", r"unauthorized reproduction(?: \S+){0,8} prohibited"),
        ("proprietary", r"unauthorized distribution(?: \S+){0,8} prohibited"),
        ("proprietary", r"unauthorised use(?: \S+){0,8} prohibited"),
        ("proprietary", r"unauthorised copying(?: \S+){0,8} prohibited"),
        ("proprietary", r"unauthorised reproduction(?: \S+){0,8} prohibited"),
        ("proprietary", r"reproduction in whole or in part(?: \S+){0,6} is (?:strictly )?(?:prohibited|forbidden)"),
        ("eula", r"end user licen[cs]e agreement"),
        ("eula", r"by installing copying or otherwise using (?:the|this) (?:software|product)"),
        ("eula", r"you may not (?:reverse engineer|decompile|disassemble)"),
        ("eula", r"this software is licensed not sold"),
        ("evaluation", r"for evaluation purposes only"),
        ("non-commercial", r"for personal (?:and )?non ?commercial use only"),
        ("non-commercial", r"for non commercial (?:use|purposes) only"),
        ("non-commercial", r"for noncommercial (?:use|purposes) only"),
        ("research-only", r"for research (?:purposes|use) only"),
        ("no-reproduction", r"may not be (?:reproduced|copied|republished|redistributed|published)(?: \S+){0,10} without (?:the )?(?:prior )?(?:express )?(?:written )?(?:permission|consent)"),
        ("no-reproduction", r"may be reproduced (?:stored|distributed|or transmitted)(?: \S+){0,12} in any form or by any means"),
        ("no-reproduction", r"no portion of this \S+ may be (?:reproduced|copied|used)"),
        ("no-reproduction", r"without the prior written (?:permission|consent) of the (?:publisher|author|copyright (?:owner|holder))s?"),
        ("no-reproduction", r"nachdruck auch auszugsweise(?: nur mit)?"),
        ("no-reproduction", r"nachdruck nur mit (?:schriftlicher )?genehmigung"),
        ("no-reproduction", r"toute reproduction(?: même partielle)?(?: \S+){0,6} (?:interdite|est interdite)"),
        ("no-reproduction", r"prohibida la reproducción(?: total o parcial| parcial o total)?"),
        ("no-reproduction", r"prohibida su reproducción(?: total o parcial| parcial o total)?"),
        ("with-permission", r"used with(?: kind)? permission"),
        ("with-permission", r"used by(?: kind)? permission"),
        ("with-permission", r"reprinted with(?: kind)? permission"),
        ("with-permission", r"reprinted by(?: kind)? permission"),
        ("with-permission", r"reproduced with(?: kind)? permission"),
        ("with-permission", r"reproduced by(?: kind)? permission"),
        ("free-use", r"may be freely (?:copied|distributed|reproduced|used|redistributed)"),
        ("free-use", r"permission is granted to (?:copy|reproduce|distribute|reprint|make)"),
        ("free-use", r"free for (?:personal|commercial|non commercial|educational) use"),
        ("attribution", r"provided that the (?:source|author|original author) is (?:acknowledged|credited|cited)"),
        ("attribution", r"please credit the (?:author|source|photographer)"),
        ("no-training", r"may not be used (?:for|to) train(?:ing)?(?: \S+){0,4} (?:artificial intelligence|machine learning|language|ai)"),
        ("no-training", r"text and data mining(?: \S+){0,6} (?:reserved|prohibited|not permitted)"),
        ("copyright", r"copyright by the (?:author|authors|publisher)"),
        ("copyright", r"is protected by copyright"),
        ("copyright", r"copyright remains with the (?:author|authors|publisher)"),
    ),
    "disclaimer": (
        ("mit", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
        ("isc", r"the author disclaims all warranties with regard to this software"),
        ("isc", r"in no event shall the author be liable for any special direct indirect or consequential damages"),
        ("bsd", r"this software is provided by the (?:\S+ ){1,6}as is and any express or implied warranties"),
        ("bsd", r"in no event shall the (?:\S+ ){1,6}be liable for any direct indirect incidental special exemplary or consequential damages"),
        ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license"),
        ("gpl-any", r"this program is distributed in the hope that it will be useful but without any warranty"),
        ("lgpl-any", r"this library is distributed in the hope that it will be useful but without any warranty"),
        ("gpl-any", r"without even the implied warranty of merchantability or fitness for a particular purpose"),
        ("gpl-any", r"there is no warranty for the program to the extent permitted by applicable law"),
        ("mpl-any", r"covered code is provided under this license on an as is basis"),
        ("mpl-any", r"covered software is provided under this license on an as is basis"),
        ("epl-any", r"except as expressly set forth in this agreement the program is provided on an as is basis"),
        ("artistic", r"this package is provided as is and without any express or implied warranties"),
        ("zlib", r"in no event will the authors be held liable for any damages arising from the use of this software"),
        ("postgresql", r"in no event shall the university of california be liable to any party"),
        ("psf", r"psf is making python available to licensee on an as is basis"),
        ("cc-any", r"unless otherwise separately undertaken by the licensor"),
        ("ms-pl", r"the software is licensed as is you bear the risk of using it"),
        ("as-is", r"the software is provided as is(?: without warranty of any kind)?"),
        ("as-is", r"is provided as is without (?:any )?(?:express or implied )?warrant(?:y|ies)"),
        ("as-is", r"with all faults"),
    ),
}


def keyword(pattern: str) -> str:
    """The literal words that a pattern begins with; the last is left out where what follows may be a part of it."""
    head = re.split(r"[^\w ]", pattern)[0]
    rest = pattern[len(head) :]
    ended = not rest or rest.startswith("(?: ") or (head.endswith(" ") and rest[0] in "([")
    return head.strip() if ended else head.rstrip().rpartition(" ")[0]
