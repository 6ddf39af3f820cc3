"""Statements and texts by which licences are declared, as plain data."""

from __future__ import annotations

# Statements, with the licence's SPDX name.  ``{v}`` is a version of the family.
FAMILIES = (
    ("GPL-{v}", ("1.0", "2.0", "3.0"), (
        "licensed under the GNU General Public License, version {v}",
        "licensed under the terms of the GNU GPL, version {v}",
        "licensed under the GPL version {v}",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version {v} of the License",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; version {v}",
    )),
    ("LGPL-{v}", ("2.1", "3.0"), (
        "licensed under the GNU Lesser General Public License, version {v}",
        "licensed under the LGPL version {v}",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version {v} of the License",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; version {v}",
    )),
    ("LGPL-{v}", ("2.0",), (
        "licensed under the GNU Library General Public License, version {v}",
        "under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version {v} of the License",
    )),
    ("AGPL-{v}", ("3.0",), (
        "licensed under the GNU Affero General Public License, version {v}",
        "licensed under the AGPL version {v}",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version {v} of the License",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version {v}",
    )),
    ("Apache-{v}", ("1.0", "1.1", "2.0"), (
        "licensed under the Apache License, Version {v}",
        "licensed under the Apache Software License, Version {v}",
        "licensed under the Apache {v} license",
    )),
    ("MPL-{v}", ("1.0", "1.1", "2.0"), (
        "subject to the terms of the Mozilla Public License, v. {v}",
        "subject to the Mozilla Public License Version {v}",
        "licensed under the Mozilla Public License, version {v}",
        "licensed under the MPL version {v}",
    )),
    ("EPL-{v}", ("1.0", "2.0"), (
        "made available under the terms of the Eclipse Public License v{v}",
        "licensed under the Eclipse Public License, version {v}",
        "licensed under the EPL version {v}",
    )),
)
CREATIVE = (
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
CREATIVE_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
CREATIVE_STATEMENTS = (
    "licensed under CC {short} {v}",
    "licensed under a Creative Commons {long} {v} International License",
    "licensed under the Creative Commons {long} {v} license",
)

MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
)
BSD_SENTENCE = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: "
)
BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
BSD_BINARY = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
BSD_WARRANTY = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES"
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
SINGLE = (
    ("MIT", "released under the MIT License"),
    ("MIT", "licensed under the MIT license"),
    ("MIT", MIT_GRANT),
    ("MIT", MIT_GRANT + ", and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
     "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("BSD-2-Clause", "licensed under the BSD 2-Clause License"),
    ("BSD-2-Clause", "licensed under the Simplified BSD License"),
    ("BSD-2-Clause", BSD_SENTENCE + BSD_SOURCE + BSD_BINARY + BSD_WARRANTY),
    ("BSD-3-Clause", "licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "licensed under the New BSD License"),
    ("BSD-3-Clause", BSD_SENTENCE + BSD_SOURCE + BSD_BINARY + BSD_NAMES + BSD_WARRANTY),
    ("ISC", "licensed under the ISC license"),
    ("ISC", ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies"),
    ("0BSD", "licensed under the 0BSD license"),
    ("0BSD", ISC_GRANT + ". THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "dedicated to the public domain under CC0 1.0"),
    ("CC0-1.0", "licensed under CC0 1.0 Universal"),
    ("BSL-1.0", "distributed under the Boost Software License, Version 1.0"),
    ("Proprietary", "All rights reserved"),
)

#: Words that tell licences apart: a span must have those of its template and no other.
DECISIVE = frozenset(
    "gnu gpl lgpl agpl general lesser library affero apache mozilla mpl eclipse epl cc by by-sa by-nc by-nd by-nc-sa by-nc-nd "
    "creative attribution attribution-sharealike attribution-noncommercial attribution-noderivatives "
    "attribution-noncommercial-sharealike attribution-noncommercial-noderivatives cc0 mit isc bsd 0bsd 2-clause 3-clause "
    "simplified new redistribution endorse appear disclaims unencumbered boost reserved charge".split()
)
#: Licences with a name for "this version" and another for "this or a later one".
EITHER = ("GPL", "LGPL", "AGPL")
NEGATIONS = frozenset(b"not never nor without isn't aren't cannot".split())


def templates() -> list[tuple[str, str]]:
    """(SPDX name, statement) of all statements."""
    found = [(name.format(v=v), text.format(v=v)) for name, versions, texts in FAMILIES for v in versions for text in texts]
    for short, long in CREATIVE:
        for v in CREATIVE_VERSIONS:
            found += [(f"CC-{short}-{v}", t.format(short=short, long=long, v=v)) for t in CREATIVE_STATEMENTS]
    return found + list(SINGLE)
