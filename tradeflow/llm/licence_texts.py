"""Texts of well-known licences and of the notices that name them.

Fixed values: the wording of each licence, as published.
"""

_PERMISSION = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so"""

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted"""

_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_TWO = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution.
"""

_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""

_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN
NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS;
OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""

TEXTS = {
    "MIT": f"{_PERMISSION}, subject to the following conditions:\nThe above copyright notice and this permission notice shall be "
           f"included in all copies or substantial portions of the Software.\n{_AS_IS}",
    "MIT-0": f"{_PERMISSION}.\n{_AS_IS}",
    "ISC": f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{_ISC_WARRANTY}",
    "0BSD": f"{_ISC_GRANT}.\n{_ISC_WARRANTY}",
    "BSD-2-Clause": _BSD_TWO + _BSD_WARRANTY,
    "BSD-3-Clause": _BSD_TWO + _BSD_THIRD + _BSD_WARRANTY,
    "Zlib": _ZLIB,
    "Apache-2.0": _APACHE_NOTICE,
}

# Titles that may stand above a licence's text.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "MIT-0": ("MIT No Attribution",),
    "ISC": ("ISC License", "The ISC License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License"),
    "Zlib": ("zlib License", "The zlib License"),
}

# Names by which a notice calls a licence.
NAMES = {
    "MIT": ("MIT License", "MIT"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD-3-Clause"),
    "ISC": ("ISC License", "ISC"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "MPL-2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GPLv2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GPLv3", "GPL-3.0"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0"),
    "CC0-1.0": ("CC0 1.0 Universal", "CC0 1.0", "CC0-1.0"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0"),
    "CC-BY-ND-4.0": ("Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0"),
}
_SUBJECTS = ("", "This work is ", "This software is ", "This project is ", "This file is ", "This code is ", "This document is ")
_VERBS = ("licensed under ", "released under ", "distributed under ", "available under ")


def known_texts() -> list[tuple[str, str, str]]:
    """(licence id, "text" or "notice", wording): texts with and without title, and a notice for each way to name one."""
    rows = [(key, "text", text) for key, text in TEXTS.items()]
    rows += [(key, "text", f"{title}\n{TEXTS[key]}") for key, titles in TITLES.items() for title in titles]
    for key, names in NAMES.items():
        rows += [(key, "notice", f"{subject}{verb}{article}{name}") for name in names
                 for subject in _SUBJECTS for verb in _VERBS for article in ("", "the ")]
        rows += [(key, "notice", f"SPDX-License-Identifier: {key}")]
    return rows
