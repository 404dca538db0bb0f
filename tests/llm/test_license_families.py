"""Licenses that differ by a clause, a word or a version, and identifier lines."""

import pytest

from tablelab.llm import licenses

HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""
WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""


def later(what, kind, version):
    return f"""This {what} is free software; you can redistribute it and/or
modify it under the terms of the GNU {kind}General Public
License as published by the Free Software Foundation; either
version {version} of the License, or (at your option) any later version.

This {what} is distributed in the hope that it will be useful.
"""


def found(text):
    return [m.license for m in licenses.Templates().scan(text)]


@pytest.mark.parametrize("mark", ["", "# ", " * "])
@pytest.mark.parametrize(
    "name, text",
    [
        ("BSD-2-Clause", HEAD + WARRANTY),
        ("BSD-3-Clause", HEAD + THIRD + WARRANTY),
        ("GPL-2.0-or-later", later("program", "", "2")),
        ("GPL-3.0-or-later", later("program", "", "3")),
        ("LGPL-2.1-or-later", later("library", "Lesser ", "2.1")),
        ("LGPL-3.0-or-later", later("program", "Lesser ", "3")),
        ("AGPL-3.0-or-later", later("program", "Affero ", "3")),
    ],
)
def test_families(name, text, mark):
    assert found("x = 1\n\n" + "".join(f"{mark}{line}\n" for line in text.split("\n"))) == [name]


def test_identifier_lines():
    for name, want in (("MIT", "MIT"), ("GPL-2.0-only", "GPL-2.0"), ("GPL-2.0-or-later", "GPL-2.0-or-later"), ("BSD-2-Clause", "BSD-2-Clause"), ("CC-BY-NC-4.0", "CC-BY-NC-4.0")):
        for line in (f"// SPDX-License-Identifier: {name}", f"/* SPDX-License-Identifier: {name} */\nint x;", f"a\n# spdx-license-identifier: {name}\nb"):
            assert found(line) == [want], line
    for name in ("GPL-2.0+", "BSD-3-Clause-Clear", "MIT-0", "Zlib", "MPL-2.0-no-copyleft-exception"):
        assert found(f"// SPDX-License-Identifier: {name}\nint x;") == [], name


def test_no_license_in_talk_about_one():
    assert found("The GNU Lesser General Public License and the Affero one are licenses of a foundation.") == []
    assert found("An spdx identifier names a license.") == []
