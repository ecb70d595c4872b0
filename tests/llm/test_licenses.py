"""Licence texts as files have them: wrapped, in comments, with numbered clauses."""

import textwrap

import pytest

from market_engine.llm import license_rules

MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
APACHE = """Copyright 2020 Somebody

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""


def gnu(name, version, kind="program"):
    return f"""This {kind} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.

This {kind} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."""


MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
TEXTS = {
    "MIT": MIT,
    "Apache-2.0": APACHE,
    "BSD-2-Clause": BSD.format(third=""),
    "BSD-3-Clause": BSD.format(third=THIRD),
    "GPL-2.0-or-later": gnu("General Public License", 2),
    "GPL-3.0-or-later": gnu("General Public License", 3),
    "LGPL-2.1-or-later": gnu("Lesser General Public License", "2.1", "library"),
    "LGPL-3.0-or-later": gnu("Lesser General Public License", 3),
    "AGPL-3.0-or-later": gnu("Affero General Public License", 3),
    "MPL-2.0": MPL,
    "ISC": ISC,
}


def wrapped(text, width, first, prefix, last):
    lines = [line for part in text.split("\n") for line in (textwrap.wrap(part, width) or [""])]
    return "\n".join([*first, *[(prefix + line).rstrip() for line in lines], *last])


STYLES = [("", [], []), ("# ", [], []), ("// ", [], []), (" * ", ["/*"], [" */"]), ("-- ", [], []), (";; ", [], [])]


@pytest.mark.parametrize("width", [64, 72, 80, 10_000])
def test_wrapped_and_commented_files(docs_of, width):
    rows, expected = [], {}
    for name, text in TEXTS.items():
        for prefix, first, last in STYLES:
            code = f"import os\n\ndef licensed():\n    return 1  # {len(rows)}\n"
            rows.append((len(rows), wrapped(text, width, first, prefix, last) + "\n\n" + code))
            expected[len(rows) - 1] = name
    out = license_rules.result(docs_of(rows)).collect()
    assert {r.doc_id: r.licenses for r in out} == expected


def test_spdx_and_titles(docs_of):
    rows = [
        (1, "// SPDX-License-Identifier: Apache-2.0\nint main() {}"),
        (2, "/* SPDX-License-Identifier: GPL-2.0-only */\n"),
        (3, "# SPDX-License-Identifier: BSD-3-Clause"),
        (4, "MIT License\nsome more"),
        (5, "We talked about the MIT license of old."),
        (6, "It is not licensed under the MIT license at all"),
        (7, "[MIT License]\r\n\r\n{all rights reserved}"),
        (8, "All rights reserved. " * 20_000),
        (9, None),
    ]
    out = {r.doc_id: (r.licenses, r.n_sentences) for r in license_rules.result(docs_of(rows)).collect()}
    assert out[1][0] == "Apache-2.0" and out[2][0] == "GPL-2.0-only" and out[3][0] == "BSD-3-Clause"
    assert out[4][0] == "MIT" and out[5] == out[6] == ("", 0) and out[7] == ("MIT,All-rights-reserved", 2)
    assert out[8] == ("All-rights-reserved", 20_000) and out[9] == ("", 0)


def test_two_licences_in_one_file(docs_of):
    text = wrapped(APACHE, 72, [], "# ", []) + "\n#\n" + wrapped(MIT, 72, [], "# ", [])
    (row,) = license_rules.result(docs_of([(1, text)])).collect()
    assert row.licenses == "Apache-2.0,MIT" and row.unmatched == ""
