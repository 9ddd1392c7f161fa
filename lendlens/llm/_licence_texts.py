"""Published licence files, headers and titles, for comparison as wholes.

Long files are kept as published in ``licence_texts``. That of AGPL-3.0 is the
GPL-3.0 with its name and its section 13 exchanged. Those of the Creative
Commons licences other than CC0-1.0 are not held."""

from __future__ import annotations

import re
from pathlib import Path

_NOTICE = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
           "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
           "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
           "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
           "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
           "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
           "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
           "POSSIBILITY OF SUCH DAMAGE.")
_BSD = ("Copyright (c) All rights reserved. Redistribution and use in source and binary forms, with or without "
        "modification, are permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
        "in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. ")
_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
          "products derived from this software without specific prior written permission. ")
_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
          "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
          "AUTHORS {}BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
          "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_MIT = ("MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software. " + _AS_IS.format("OR COPYRIGHT HOLDERS "))
_ISC = ("ISC License Copyright (c) Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        'copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
        "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
        "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_UNLICENSE = ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
              "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
              "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
              "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
              "software to the public domain. We make this dedication for the benefit of the public at large and to the "
              "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
              "perpetuity of all present and future rights to this software under copyright law. " + _AS_IS.format("")
              + " For more information, please refer to <https://unlicense.org>")
_SECTION_13 = ("13. Remote Network Interaction; Use with the GNU General Public License. Notwithstanding any other provision "
               "of this License, if you modify the Program, your modified version must prominently offer all users "
               "interacting with it remotely through a computer network (if your version supports such interaction) an "
               "opportunity to receive the Corresponding Source of your version by providing access to the Corresponding "
               "Source from a network server at no charge, through some standard or customary means of facilitating "
               "copying of software. ")


def _gnu_header(name: str, version: str, what: str = "program") -> list[str]:
    """Paragraphs of the usual header that name the licence."""
    return [f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
            f"as published by the Free Software Foundation, either version {version} of the License, or (at your option) "
            "any later version.",
            f"You should have received a copy of the GNU {name} along with this {what}. If not, see "
            "<https://www.gnu.org/licenses/>."]


def _wholes() -> tuple[tuple[str, str], ...]:
    files = {f.stem: f.read_text() for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
    affero = re.sub(r"GNU General Public License", "GNU Affero General Public License", files["GPL-3.0"], flags=re.I)
    start, end = affero.index("  13. Use with"), affero.index("  14. Revised")
    files["AGPL-3.0"] = affero[:start] + _SECTION_13 + affero[start:end] + affero[end:]
    files |= {"BSD-2-Clause": _BSD + _NOTICE, "BSD-3-Clause": _BSD + _THIRD + _NOTICE, "MIT": _MIT, "ISC": _ISC,
              "Unlicense": _UNLICENSE}
    gpl, lesser, affero = "General Public License", "Lesser General Public License", "Affero General Public License"
    parts = [("GPL-2.0", _gnu_header(gpl, "2")[:1]), ("GPL-3.0", _gnu_header(gpl, "3")),
             ("LGPL-2.1", _gnu_header(lesser, "2.1", "library")[:1]), ("LGPL-3.0", _gnu_header(lesser, "3")),
             ("LGPL-3.0", _gnu_header(lesser, "3", "library")), ("AGPL-3.0", _gnu_header(affero, "3")),
             ("Apache-2.0", ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
                             "except in compliance with the License. You may obtain a copy of the License at"]),
             ("MPL-2.0", ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                          "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
                          "Mozilla Public License Version 2.0"]),
             ("GPL-2.0", ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"]),
             ("GPL-3.0", ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"]),
             ("LGPL-2.1", ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"]),
             ("LGPL-3.0", ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"]),
             ("AGPL-3.0", ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"]),
             ("Apache-2.0", ["Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"])]
    return (*sorted(files.items()), *((licence, text) for licence, texts in parts for text in texts))


WHOLES = _wholes()
