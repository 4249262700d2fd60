"""Texts of public licences and the notices that name them.

Long texts are files in ``license_bodies``. That of AGPL-3.0 was put together from GPL-3.0 and the passages
that differ (preamble, section 13); the others are whole copies.
"""

import pkgutil


def _body(name: str) -> tuple[str, str]:
    return name, pkgutil.get_data(__package__, f"license_bodies/{name}.txt").decode("utf-8")


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all copies
or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE
LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

BSD_3 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE
LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
the specific language governing permissions and limitations under the License."""

def _notice(license_name: str, version: str, what: str = "program", published: str = "as published by") -> str:
    """The notice that the GNU licences ask for, by licence, version and kind of work."""
    return f"""This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU
{license_name} {published} the Free Software Foundation, either version {version} of the License, or (at your option)
any later version. This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
{license_name} for more details."""


GPL, LGPL, AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"

MPL_2 = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

def _lines() -> list[tuple[str, str]]:
    """Notices of one line: every way to say it with every name of a licence and version."""
    names = [
        ("MIT", "the MIT License"),
        ("ISC", "the ISC License"),
        ("Unlicense", "the Unlicense"),
        ("CC0-1.0", "CC0 1.0"),
    ]
    for n in "23":
        names += [(f"BSD-{n}-Clause", f"the {x}") for x in (f"BSD {n}-Clause License", f"{n}-Clause BSD License")]
    names += [("Apache-2.0", f"the Apache {x}") for x in ("License, Version 2.0", "License 2.0", "2.0 License")]
    names += [("MPL-2.0", f"the {x} 2.0") for x in ("Mozilla Public License, version", "Mozilla Public License, v.")]
    names += [("MPL-2.0", f"the {x} 2.0") for x in ("Mozilla Public License", "MPL")]
    versions = [(GPL, "GPL", ("2", "3")), (LGPL, "LGPL", ("2.1", "3")), (AGPL, "AGPL", ("3",))]
    for long, short, numbers in versions:
        for v in numbers:
            own = f"{short}-{v if '.' in v else v + '.0'}"
            for x in (f"GNU {long}", f"GNU {short}", short):
                names += [(own, f"the {x} {y}") for y in (f"version {v}", f"v{v}")]
            names += [(own, f"version {v} of the GNU {x}") for x in (long, short)]
    parts = {"BY": "Attribution", "SA": "ShareAlike", "ND": "NoDerivatives", "NC": "NonCommercial"}
    for kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
        long = "-".join(parts[x] for x in kind.split("-"))
        for v, scope in (("4.0", "International"), ("3.0", "Unported")):
            whole = f"a Creative Commons {long} {v}"
            names += [(f"CC-{kind}-{v}", x) for x in (f"CC {kind} {v}", f"{whole} {scope} License", f"{whole} License")]
    says = ("Released under", "Licensed under", "Distributed under the terms of", "This work is licensed under")
    return [(name, f"{say} {x}.") for name, x in names for say in says]


#: Name and text; several texts may stand for one licence.
TEXTS = (
    ("MIT", MIT),
    ("ISC", ISC),
    ("BSD-2-Clause", BSD_2),
    ("BSD-3-Clause", BSD_3),
    _body("Apache-2.0"),
    ("Apache-2.0", APACHE),
    _body("GPL-2.0"),
    ("GPL-2.0", _notice(GPL, "2")),
    _body("GPL-3.0"),
    ("GPL-3.0", _notice(GPL, "3")),
    _body("LGPL-2.1"),
    ("LGPL-2.1", _notice(LGPL, "2.1", "library")),
    _body("LGPL-3.0"),
    ("LGPL-3.0", _notice(LGPL, "3", "library")),
    _body("AGPL-3.0"),
    ("AGPL-3.0", _notice(AGPL, "3")),
    _body("MPL-2.0"),
    ("MPL-2.0", MPL_2),
    _body("CC0-1.0"),
    _body("CC-BY-SA-4.0"),
    _body("Unlicense"),
    *_lines(),
)

#: Words that any text may hold.
COMMON = frozenset(
    """a an and any are as at be but by can for from if in is it its may not of on or other that the this to under
    use will with you your""".split()
)

#: Words of notices that do not name a licence.
FRAME = frozenset("a an the this is are work software program project code file under terms of released licensed distributed".split())
