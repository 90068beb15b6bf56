"""Known licences and equivalent spellings.

Fixed values, as published: short texts in full, and for long ones the digests of their canonical forms (made by
``license_scan.digests`` from the published files). One-line notices follow from a rule: a phrase, an article
and one of a licence's names.
"""

#: Words that become others: one word may become two, as two may be on two lines.
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sub license"),
    ("sublicense", "sub license"),
    ("noncommercial", "non commercial"),
    ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"),
    ("while", "whilst"),
    ("percent", "per cent"),
    ("v2 0", "version 2 0"),
    ("v3", "version 3"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""

_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

_MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

KNOWN = {
    "MIT": _MIT,
    "ISC": _ISC,
    "BSD-2-Clause": f"{_BSD_HEAD}\n\n{_BSD_TAIL}",
    "BSD-3-Clause": f"{_BSD_HEAD}\n\n{_BSD_NAMES}\n\n{_BSD_TAIL}",
    "Zlib": _ZLIB,
    "Unlicense": _UNLICENSE,
}

#: What a file carries at its head.
HEADERS = {
    "header: Apache-2.0": _APACHE_HEADER,
    "header: MPL-2.0": _MPL_HEADER,
}

#: Digests of the canonical forms of published texts.
DIGESTS = {
    "Apache-2.0": "81cf0739d290b5071a533ef0a96c989b",
    "Artistic-1.0-Perl": "0613963bdb69735cec2c53962deebf27",
    "BSD-2-Clause": "b0538ec125cafeeb58bf11083985630b",
    "BSD-3-Clause-UC": "ddcd765ed0a3236bf96e15f76c36983a",
    "CC-BY-SA-4.0": "523e1ae67034d876937bf1d3b440b9ea",
    "CC0-1.0": "93a180096f6cfcf2c0dd24f75c2eec48",
    "GCC-exception-3.1": "0e7dfea9e87d456b839e8f38b26fe68d",
    "GFDL-1.2": "d2b7b06b6c7c5465c42f502807fe1fc6",
    "GFDL-1.3": "382b66ad4a3ca1109f16c98fa04b42bd",
    "GPL-1.0": "d4884370cf61e0b98034abe62175a72f",
    "GPL-2.0": "c60bd479013ac41cc9f3c46e65bf6d2f",
    "GPL-2.0-only": "ab01b6d9d7f37fa9626663c1247d17c9",
    "GPL-3.0": "5eaa767cc0a56c87c3852144458a3bf1",
    "ISC": "d4ab7844672554d3dacb33435e62566b",
    "LGPL-2.0": "cd8a0766fbe90189bdb90d3c169e9abd",
    "LGPL-2.1": "2ad27cf4c764d24dbf9f598f5b0fe93d",
    "LGPL-3.0": "b31b7335bc37919e8cdd79154e04d88d",
    "LLVM-exception": "ba1c7d849e2e2c7f0d6ce576f6c84304",
    "MIT": "e7af4c4044497016b6a50aaee48abc82",
    "MPL-1.1": "d6e5993e35451738caaab91aa91f0dce",
    "MPL-2.0": "7b50f548d852998004599c40d4b7f15d",
    "NCSA": "9396f292b33762d57ad1a3abf8383879",
    "OFL-1.1": "db545aa9d6cfb363aba9bb90aa039cf4",
    "Unicode-3.0": "4a03901f626bd8415f10c313ed87e7ad",
}

#: How a notice begins, and what may stand before a licence's name.
PHRASES = (
    "Licensed under", "Released under", "Distributed under", "Published under", "Available under", "Provided under", "Made available under",
    *(f"This {work} is licensed under" for work in ("work", "software", "program", "project", "file", "text")),
    "Dedicated to the public domain under", "License:", "SPDX-License-Identifier:",
)
ARTICLES = ("", "the ")

_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
_GNU_VERSIONS = {"GPL": ("2.0", "3.0"), "LGPL": ("2.1", "3.0"), "AGPL": ("3.0",)}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_CC_SCOPES = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
#: The names of a licence, by its identifier.
NAMES = {
    "MIT": ("MIT", "MIT License", "MIT License (MIT)"),
    "Apache-2.0": ("Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache Software License 2.0"),
    "BSD": ("BSD", "BSD License"),
    "BSD-2-Clause": ("BSD-2-Clause", "BSD-2-Clause License", "2-Clause BSD License", "BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD-3-Clause", "BSD-3-Clause License", "3-Clause BSD License", "BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "ISC": ("ISC", "ISC License"),
    "Zlib": ("Zlib", "zlib License"),
    "MPL-1.1": ("MPL-1.1", "Mozilla Public License 1.1", "Mozilla Public License, Version 1.1"),
    "MPL-2.0": ("MPL-2.0", "MPL 2.0", "Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0"),
    "EPL-2.0": ("EPL-2.0", "Eclipse Public License 2.0", "Eclipse Public License, Version 2.0", "Eclipse Public License v2.0"),
    "BSL-1.0": ("BSL-1.0", "Boost Software License 1.0", "Boost Software License, Version 1.0"),
    "Unlicense": ("Unlicense", "The Unlicense"),
    "CC0-1.0": ("CC0", "CC0-1.0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero", "Creative Commons CC0 1.0 Universal"),
    **{
        f"{short}-{v}{tail}": tuple(name + (" or later" if tail else "") for name in (f"{short}-{v}", f"{short} {v}", f"{short} v{v[0]}", f"{short}v{v[0]}", f"{full}, version {v.removesuffix('.0')}", f"{full} v{v}")) + ((f"{short}-{v}-or-later",) if tail else ())
        for short, full in _GNU.items() for v in _GNU_VERSIONS[short] for tail in ("", "-or-later")
    },
    **{
        f"CC-{kind}-{v}": (f"CC-{kind}-{v}", f"CC {kind} {v}", f"Creative Commons {full} {v}", f"Creative Commons {full} {v} License", f"Creative Commons {full} {v} {_CC_SCOPES[v]} License")
        for kind, full in _CC.items() for v in _CC_SCOPES
    },
}
