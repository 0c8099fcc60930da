"""Known licence texts and notices, and spellings that count as equal.

Fixed values: the public texts themselves, in natural order; the long ones are
the files in ``license_files``.
"""

import re
from importlib.resources import files

#: words with the word they count as
EQUIVALENT = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "colour": "color", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "holders": "holder", "owner": "holder", "owners": "holder", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license", "licences": "licenses",
    "licenced": "licensed", "licencing": "licensing", "maximise": "maximize", "modelled": "modeled",
    "modelling": "modeling", "noncommercial": "non commercial", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "percent": "per cent", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling",
    "sublicence": "sublicense", "utilisation": "utilization", "whilst": "while", "wilfull": "wilful", "http": "https",
}

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
"""

_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted"""

_ISC_TAIL = """

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

#: (licence, text)
KNOWN = [
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT_GRANT),
    ("MIT", _MIT_GRANT),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + """
3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission.
""" + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + """
3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission.
""" + _BSD_TAIL),
    ("ISC", _ISC_GRANT + """, provided that the above
copyright notice and this permission notice appear in all copies.""" + _ISC_TAIL),
    ("ISC", "ISC License\n\n" + _ISC_GRANT + """, provided that the above
copyright notice and this permission notice appear in all copies.""" + _ISC_TAIL),
    ("0BSD", _ISC_GRANT + "." + _ISC_TAIL),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In
no event will the authors be held liable for any damages arising from the use
of this software.

Permission is granted to anyone to use this software for any purpose, including
commercial applications, and to alter it and redistribute it freely, subject to
the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim
that you wrote the original software. If you use this software in a product, an
acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this
software dedicate any and all copyright interest in the software to the public
domain. We make this dedication for the benefit of the public at large and to
the detriment of our heirs and successors. We intend this dedication to be an
overt act of relinquishment in perpetuity of all present and future rights to
this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]

#: file of a whole text with its licence
_FILES = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0",
    "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0",
    "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}

#: where the advice on using a licence begins, after its terms
_APPENDIX = re.compile(r"^ *(?:APPENDIX: How to apply|ADDENDUM: How to use|Appendix: How to Apply|How to Apply These Terms"
                       r"|EXHIBIT A -|Exhibit A - )", re.M)
_END = re.compile(r"^ *END OF TERMS AND CONDITIONS *$", re.M)


def _variants(text: str) -> list[str]:
    """A whole text with and without its appendix, its end mark and its title
    (the first paragraph)."""
    out = [text]
    if found := _APPENDIX.search(text):
        out.append(text[:found.start()])
    out += [x[:found.start()] for x in list(out[1:]) if (found := _END.search(x))]
    return out + [x.lstrip().split("\n\n", 1)[1] for x in out]


KNOWN += [(name, text) for file, name in _FILES.items()
          for text in _variants((files("hirelens.llm") / "license_files" / file).read_text("utf-8"))]

#: the names by which notices call a licence
_NAMES = {
    "MIT": ["the MIT License", "MIT"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "Apache 2.0", "Apache-2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License", "BSD-2-Clause"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "BSD-3-Clause"],
    "ISC": ["the ISC License"], "0BSD": ["the Zero-Clause BSD License", "0BSD"], "Zlib": ["the zlib License"],
    "Unlicense": ["the Unlicense"], "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "BSL-1.0": ["the Boost Software License, Version 1.0", "BSL-1.0"],
    "MPL-1.1": ["the Mozilla Public License, Version 1.1", "the Mozilla Public License 1.1", "MPL 1.1"],
    "MPL-2.0": ["the Mozilla Public License, Version 2.0", "the Mozilla Public License 2.0", "MPL 2.0"],
    "EPL-1.0": ["the Eclipse Public License, Version 1.0", "the Eclipse Public License 1.0", "EPL 1.0"],
    "EPL-2.0": ["the Eclipse Public License, Version 2.0", "the Eclipse Public License 2.0", "EPL 2.0"],
}
for _short, _long, _versions in (
        ("GPL", "GNU General Public License", ("1", "2", "3")), ("AGPL", "GNU Affero General Public License", ("3",)),
        ("LGPL", "GNU Lesser General Public License", ("2.1", "3")), ("LGPL", "GNU Library General Public License", ("2",)),
        ("GFDL", "GNU Free Documentation License", ("1.2", "1.3"))):
    for _v in _versions:
        _NAMES[f"{_short}-{_v if '.' in _v else _v + '.0'}"] = [
            f"the {_long}, version {_v}", f"the {_long} version {_v}", f"the {_long} v{_v}", f"the {_short} version {_v}",
            f"{_short}v{_v}", f"{_short} {_v}"] + ([f"the {_long}, version {_v}.0", f"the {_long} v{_v}.0", f"{_short}-{_v}.0"] if "." not in _v else [])
for _terms, _words in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
                       ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")):
    for _v, _port in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
        _NAMES[f"CC-{_terms}-{_v}"] = [f"CC {_terms} {_v}", f"a Creative Commons {_words} {_v} {_port} License",
                                       f"the Creative Commons {_words} {_v} {_port} License", f"a Creative Commons {_words} {_v} License"]

_SEEN = set(KNOWN)
KNOWN += [(name, text) for name, called in _NAMES.items() for call in called
          for text in (f"{opening} under {terms}{call}." for opening in (
              "Released", "Licensed", "Distributed", "This work is licensed", "This project is licensed",
              "This software is licensed", "This software is released") for terms in ("", "the terms of "))
          if (name, text) not in _SEEN]
