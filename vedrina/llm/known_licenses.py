"""Known licences and licence notices, by SPDX name. Texts that their authors publish for use as they are."""

from __future__ import annotations

# After lower case and without punctuation: spellings of one thing. The second is the canonical one.
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("sub licence", "sublicense"),
    ("non commercial", "noncommercial"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("merchantibility", "merchantability"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("http", "https"),
    ("v2 0", "version 2 0"),
    ("v3", "version 3"),
)

_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution.
"""

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies."""

_0BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."""

_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""

_BY_SPDX = ["0BSD", "AGPL-3.0-only", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "GPL-2.0-only", "GPL-3.0-only", "ISC", "LGPL-2.1-only", "LGPL-3.0-only", "MIT", "MPL-2.0", "Unlicense", "Zlib"]

KNOWN: dict[str, list[str]] = {name: [f"SPDX-License-Identifier: {name}"] for name in _BY_SPDX}
KNOWN["MIT"] += [
    _MIT,
    "The MIT License\n\n" + _MIT,
    "MIT License\n\n" + _MIT,
    "The MIT License (MIT)\n\n" + _MIT,
    "Released under the MIT License.",
    "Licensed under the MIT License.",
    "This project is licensed under the MIT License.",
]
KNOWN["ISC"] += [_ISC + "\n\n" + _ISC_WARRANTY, "ISC License\n\n" + _ISC + "\n\n" + _ISC_WARRANTY, "Licensed under the ISC License."]
KNOWN["0BSD"] += [_0BSD + "\n\n" + _ISC_WARRANTY]
KNOWN["BSD-2-Clause"] += [_BSD_2 + "\n" + _WARRANTY, "Licensed under the BSD 2-Clause License."]
KNOWN["BSD-3-Clause"] += [
    _BSD_2
    + "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived"
    " from this software without specific prior written permission.\n\n" + _WARRANTY,
    "Licensed under the BSD 3-Clause License.",
]
KNOWN["Zlib"] += [_ZLIB]
KNOWN["Apache-2.0"] += [
    _APACHE_NOTICE,
    "Licensed under the Apache License, Version 2.0.",
    "Released under the Apache License, Version 2.0.",
    "This work is licensed under the Apache License, Version 2.0.",
]
KNOWN["GPL-2.0-only"] += ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU GPL, version 2."]
KNOWN["GPL-3.0-only"] += [
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the GNU General Public License, version 3.",
    "Licensed under the GNU GPL, version 3.",
]
KNOWN["MPL-2.0"] += ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."]
KNOWN["CC-BY-4.0"] += ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."]
KNOWN["CC-BY-SA-4.0"] += ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."]
KNOWN["CC-BY-NC-4.0"] += ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."]
KNOWN["CC0-1.0"] += ["Released under CC0 1.0."]
