"""Known licence texts and notices (fixed values)."""

# Whole licence texts as their authors publish them, without copyright lines.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software."""

_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD_CLAUSES = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""

_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""

_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""

_ZERO_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

TEXTS = {
    "MIT": [f"{_MIT_GRANT}\n\n{_MIT_WARRANTY}", f"MIT License\n\n{_MIT_GRANT}\n\n{_MIT_WARRANTY}",
            f"The MIT License (MIT)\n\n{_MIT_GRANT}\n\n{_MIT_WARRANTY}"],
    "BSD-2-Clause": [f"{_BSD_CLAUSES}\n\n{_BSD_WARRANTY}", f"BSD 2-Clause License\n\n{_BSD_CLAUSES}\n\n{_BSD_WARRANTY}"],
    "BSD-3-Clause": [f"{_BSD_CLAUSES}\n\n{_BSD_THIRD}\n\n{_BSD_WARRANTY}",
                     f"BSD 3-Clause License\n\n{_BSD_CLAUSES}\n\n{_BSD_THIRD}\n\n{_BSD_WARRANTY}"],
    "ISC": [f"{_ISC_GRANT}\n\n{_ISC_WARRANTY}", f"ISC License\n\n{_ISC_GRANT}\n\n{_ISC_WARRANTY}"],
    "0BSD": [f"{_ZERO_GRANT}\n\n{_ISC_WARRANTY}", f"BSD Zero Clause License\n\n{_ZERO_GRANT}\n\n{_ISC_WARRANTY}"],
    "Zlib": [_ZLIB, f"zlib License\n\n{_ZLIB}"],
    "Unlicense": [_UNLICENSE],
    "Apache-2.0": [_APACHE_HEADER],
}

# SHA-256 of the canonical forms (licences.canonical, whole) of full texts too long to keep here.
DIGESTS = {
    "Apache-2.0": [
        "bd6e0bb2a535a018674c5c9521be43b0c1a0c816db3a1dfd87cc9504db8f9573",  # as published
        "6c9d60c282be8374612cb59c0c33300b8b6ff294ed2801ae6f44e1de748ab4d7",  # to the end of the terms
        "584bbdda8020980c9248046c862d50b7ed0858656c4bbe97cd5e1f8b4e75b3e8",  # up to that line
        "f1a421c0e9b12a67e573b222e2726ea50ae852ad0271cb7553f0a39689a9608c",  # appendix line filled in
    ],
    "GPL-2.0": [
        "e390c1dfd2eb05d6031d675ce5eea9d124887764f58c73216b5cc536bfb9f451",  # as published
        "8fca74341977f457e4d85e6c3caa95aba964f5a430eb9de55e765cb0f61999e3",  # to the end of the terms
        "3a4ecab283fc8a08f342af15563b59e4d37598f15c293d5d71f0b6fc3250252e",  # up to that line
    ],
    "GPL-3.0": [
        "5a281f634db6b415a4491779bb7121c752940f250ef622ab9ab829920e8cfbb6",  # as published
        "388a643e6fbbd1f8b6c82d2a64f55e79e7a471223e299e683ae03b569bfcbdc4",  # to the end of the terms
        "847fb0dcacf5f99b4b6a5328fb532e563bf310aaf8e689f21b94b321c35b5c76",  # up to that line
    ],
    "LGPL-2.1": [
        "beebb7d0f5ba0a4a1dea2ce270edee98c9ec8508ff67599a990066f5942a9d18",  # as published
        "761cc340754722dfbd440ecaa7b20b64853cefe4359cc5f5ead18ecba8979dc2",  # to the end of the terms
        "db030a5a9401cb57eee47a46d91019328998efbbe5916bf90ce9bb41b4a3296e",  # up to that line
    ],
    "LGPL-3.0": [
        "dd538d15d532339d4a394323937d54825be6b2224b8e1985cf9c9e707c966d9c",  # as published
    ],
    "MPL-2.0": [
        "9e79a7d513376f6fa1500e4df4f6276c6e7e61c5c3e28dcdb1acee24033acc56",  # as published
    ],
    "CC0-1.0": [
        "891968ade68c0a40cc2b1974e64ce18e87b058a90c18b0d9449bbd898d172b1d",  # as published
    ],
}

# Names under which notices call a licence, and its class.
NAMES = {
    "Apache-2.0": ("permissive", ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"]),
    "MIT": ("permissive", ["MIT License", "Expat License"]),
    "BSD-2-Clause": ("permissive", ["BSD 2-Clause License", "Simplified BSD License"]),
    "BSD-3-Clause": ("permissive", ["BSD 3-Clause License", "New BSD License", "Modified BSD License"]),
    "ISC": ("permissive", ["ISC License"]),
    "GPL-2.0": ("copyleft", ["GNU General Public License, version 2", "GNU GPL v2", "GPLv2"]),
    "GPL-3.0": ("copyleft", ["GNU General Public License, version 3", "GNU GPL v3", "GPLv3"]),
    "LGPL-2.1": ("copyleft", ["GNU Lesser General Public License, version 2.1", "LGPLv2.1"]),
    "LGPL-3.0": ("copyleft", ["GNU Lesser General Public License, version 3", "LGPLv3"]),
    "AGPL-3.0": ("copyleft", ["GNU Affero General Public License, version 3", "AGPLv3"]),
    "MPL-2.0": ("copyleft", ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"]),
    "CC-BY-4.0": ("permissive", ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"]),
    "CC-BY-SA-4.0": ("copyleft", ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"]),
    "CC-BY-NC-4.0": ("restricted", ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"]),
    "CC-BY-ND-4.0": ("restricted", ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"]),
}
OTHER_CLASSES = {"0BSD": "permissive", "Zlib": "permissive", "Unlicense": "permissive", "CC0-1.0": "permissive",
                 "all-rights-reserved": "restricted"}

# Sentences in which a notice names a licence.
SENTENCES = [
    "Licensed under {name}", "Licensed under the {name}", "Released under {name}", "Released under the {name}",
    "Distributed under the {name}", "Available under the {name}", "This work is licensed under {name}",
    "This work is licensed under the {name}", "This work is licensed under a {name}",
    "This software is licensed under the {name}", "This software is released under the {name}",
    "This project is licensed under the {name}", "This file is licensed under the {name}",
    "This program is licensed under the {name}", "SPDX-License-Identifier: {id}",
]
