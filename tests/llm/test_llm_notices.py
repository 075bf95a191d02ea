"""Standard licence notices as they stand in files."""

import pytest

from tally.llm.licenses import license_scan

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
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
AUTHORS BE LIABLE"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    {http}://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
ISC = """Permission to use, copy, modify, and{slash} distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GNU = """This {what} is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU {kind} License as published by
the Free Software Foundation{stop} either version {version} of the License, or
(at your option) any later version.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at {http}://mozilla.org/MPL/2.0/."""
CC0 = """To the extent possible under law, the author(s) have dedicated all copyright
and related and neighboring rights to this software to the public domain
worldwide. This software is distributed without any warranty."""


def gnu(what, kind, version, old):
    return GNU.format(what=what, kind=kind, version=version, mark=";" if old else ":", stop=";" if old else ",")


NOTICES = [
    (MIT, ["MIT"]),
    (APACHE.format(http="http"), ["Apache-2.0"]),
    (APACHE.format(http="https"), ["Apache-2.0"]),
    (ISC.format(slash="/or"), ["ISC"]),
    (ISC.format(slash=""), ["ISC"]),
    (BSD2, ["BSD-2-Clause"]),
    (BSD3, ["BSD-2-Clause", "BSD-3-Clause"]),
    (gnu("program", "General Public", "3", False), ["GPL-3.0-or-later"]),
    (gnu("program", "General Public", "3", True), ["GPL-3.0-or-later"]),
    (gnu("program", "General Public", "2", True), ["GPL-2.0-or-later"]),
    (gnu("program", "Affero General Public", "3", False), ["AGPL-3.0-or-later"]),
    (gnu("library", "Lesser General Public", "2.1", True), ["LGPL-2.1-or-later"]),
    (gnu("library", "Library General Public", "2", True), ["LGPL-2.0-or-later"]),
    (gnu("program", "Lesser General Public", "3", False), ["LGPL-3.0-or-later"]),
    (MPL.format(http="http"), ["MPL-2.0"]),
    (MPL.format(http="https"), ["MPL-2.0"]),
    (CC0, ["CC0-1.0"]),
]
HEADS = ["", "The Title\n\nCopyright (c) 2020 X\n\n", "Copyright (c) 2020 X\n", "The Title\r\nCopyright (c) 2020 X\r\n\r\n"]


@pytest.mark.parametrize("comment", ["", "# ", " * ", "// "])
def test_standard_notices(documents, comment):
    rows, wanted = [], {}
    for notice, names in NOTICES:
        for head in HEADS:
            text = "".join(f"{comment}{line}\n" for line in f"{head}{notice}".split("\n"))
            wanted[len(rows)] = names
            rows.append((len(rows), text))
    found = {r.doc_id: list(r.licenses) for r in license_scan(documents(rows)).collect()}
    assert {k: v for k, v in found.items() if v != wanted[k]} == {}


def test_parts_of_notices_are_none(documents):
    parts = MIT.split("\n\n")
    glued = GNU.format(what="program", mark=":", kind="General Public", stop=",", version="3").replace("or modify\n", "or modify\n\n")
    rows = [(1, "\n\n".join(reversed(parts))), (2, "\n\n".join(parts[:2])), (3, glued), (4, "x " + MPL.format(http="http")), (5, "\n" * 100_000 + "a")]
    assert all(not r.licenses for r in license_scan(documents(rows)).collect())


@pytest.mark.parametrize(
    "text, licence",
    [
        ("This project is licensed under the MIT License.", "MIT"),
        ("Read this.\nThis software is licensed under the MIT License. More follows.", "MIT"),
        ("// SPDX-License-Identifier: Apache-2.0\ncode", "Apache-2.0"),
        ("# SPDX-License-Identifier: GPL-2.0-or-later\n", "GPL-2.0-or-later"),
        ("This work is licensed under CC BY 4.0.", "CC-BY-4.0"),
        (
            "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License version 2 as\n"
            "published by the Free Software Foundation.\n",
            "GPL-2.0",
        ),
        ("The MIT is in Cambridge. Apache-2.0 is a name.", None),
        ("MIT\nApache 2.0", None),
    ],
)
def test_short_notices(documents, text, licence):
    assert license_scan(documents([(1, text)])).first().licenses == ([licence] if licence else [])


def test_a_named_holder_makes_three_clauses(documents):
    notice = (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.\n"
        "Neither the name of Acme Inc. nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission.\n"
    )
    assert "BSD-3-Clause" in license_scan(documents([(1, notice)])).first().licenses
