"""A hand-made text for every licence rule, wrapped and in sentences as such texts are."""

import pytest

from terraflux.llm import licenses

AS_IS = 'The software is provided "as is" and the author disclaims all warranties.'
BSD = """Copyright (c) 2019, Some People
All rights are with them.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice in the documentation.
"""
ENDORSE = "Neither the name of the holder nor the names of its contributors may be used to endorse or promote products\nderived from this software without consent.\n"
TEXTS = {
    "apache": ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n  http://example.org\n\nUnless required by applicable law or agreed to in writing, software", "Apache-2.0"),
    "apache title": ("Apache License\nVersion 2.0, January 2004", "Apache-2.0"),
    "apache spdx": ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    "llvm": ("Licensed under the Apache License 2.0.\nThere are LLVM Exceptions to the Apache 2.0 License.", "Apache-2.0 WITH LLVM-exception"),
    "boost": ("Boost Software License - Version 1.0\n\nPermission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software", "BSL-1.0"),
    "boost title": ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    "mit": ("MIT\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software.\n\nThe above copyright notice and this permission\nnotice shall be included in all copies of it.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY.", "MIT"),
    "mit line": ("Released under the MIT License.", "MIT"),
    "mit spdx": ("SPDX-License-Identifier: MIT", "MIT"),
    "isc": (f"Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted. {AS_IS}", "ISC"),
    "isc spdx": ("SPDX-License-Identifier: ISC", "ISC"),
    "zlib": ("This software is provided 'as-is'. Permission is granted to anyone to use this software for any purpose.\n\n1. The origin of this software must not be misrepresented.\n\n2. Altered source versions must be plainly marked as such.", "Zlib"),
    "unlicense": ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    "bsd4": (f"{BSD}3. All advertising materials mentioning features or use of this software must display the following acknowledgement.\n4. {ENDORSE}", "BSD-4-Clause"),
    "bsd3": (f"{BSD}3. {ENDORSE}", "BSD-3-Clause"),
    "bsd2": (BSD, "BSD-2-Clause"),
    "bsd3 spdx": ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    "bsd2 spdx": ("SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"),
    "bsd any": ("Distributed under the BSD license.", "BSD-any"),
    "epl": ("under the Eclipse Public License v2.0; made available under the Eclipse Public License, v 2.0", "EPL-2.0"),
    "epl spdx": ("SPDX-License-Identifier: EPL-2.0", "EPL-2.0"),
    "mpl": ("subject to the terms of the Mozilla Public License, v. 2.0.", "MPL-2.0"),
    "mpl spdx": ("SPDX-License-Identifier: MPL-2.0", "MPL-2.0"),
    "lgpl21+": ("the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)\nany later version.", "LGPL-2.1-or-later"),
    "lgpl21": ("GNU Lesser General Public License version 2.1", "LGPL-2.1-only"),
    "lgpl21 spdx": ("SPDX-License-Identifier: LGPL-2.1", "LGPL-2.1-only"),
    "lgpl3+": ("GNU Lesser General Public License, version 3. Or, at your option, any later version.", "LGPL-3.0-or-later"),
    "lgpl3": ("GNU Lesser General Public License version 3", "LGPL-3.0-only"),
    "lgpl3 spdx": ("SPDX-License-Identifier: LGPL-3.0", "LGPL-3.0-only"),
    "agpl3+": ("GNU Affero General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "AGPL-3.0-or-later"),
    "agpl3": ("GNU Affero General Public License, version 3", "AGPL-3.0-only"),
    "agpl3 spdx": ("SPDX-License-Identifier: AGPL-3.0", "AGPL-3.0-only"),
    "gpl3+": ("it under the terms of the GNU General Public License version 3, or (at your option) any later version", "GPL-3.0-or-later"),
    "gpl3 plus": ("GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.", "GPL-3.0-or-later"),
    "gpl3": ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only"),
    "gpl3 spdx": ("SPDX-License-Identifier: GPL-3.0", "GPL-3.0-only"),
    "gpl2 classpath": ("GNU General Public License, version 2. Linking this library statically or dynamically with other modules is", "GPL-2.0-only WITH Classpath-exception-2.0"),
    "gpl2+ classpath": ("GNU General Public License, version 2, or (at your option) any later version. Linking this library statically or\ndynamically with other modules is", "GPL-2.0-or-later WITH Classpath-exception-2.0"),
    "gpl2+": ("GNU General Public License version 2. Or, at your option, any later version.", "GPL-2.0-or-later"),
    "gpl2": ("GNU General Public License version 2", "GPL-2.0-only"),
    "gpl2 spdx": ("SPDX-License-Identifier: GPL-2.0", "GPL-2.0-only"),
    "gpl": ("under the terms of the GNU General Public License", "GPL-any"),
    "by-nc-sa": ("Attribution-NonCommercial-ShareAlike 4.0 International", "CC-BY-NC-SA-4.0"),
    "by-nc-nd": ("CC BY-NC-ND 4.0", "CC-BY-NC-ND-4.0"),
    "by-nc": ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    "by-nc name": ("Attribution-NonCommercial 4.0 International", "CC-BY-NC-4.0"),
    "by-nd": ("Attribution-NoDerivatives 4.0", "CC-BY-ND-4.0"),
    "by-sa": ("Attribution-ShareAlike 4.0 International", "CC-BY-SA-4.0"),
    "by-sa 3": ("CC BY-SA 3.0", "CC-BY-SA-3.0"),
    "by": ("This work is under Creative Commons Attribution 4.0 International.", "CC-BY-4.0"),
    "by 3": ("Creative Commons\nAttribution 3.0", "CC-BY-3.0"),
    "cc0": ("CC0 1.0 Universal", "CC0-1.0"),
    "public": ("Dedicated to the public-domain", "Public-Domain"),
    "rights": ("Copyright 2020 Someone.  All  rights\nreserved.", "All-Rights-Reserved"),
    "between": ("Redistribution and use in source and binary forms, with or without modification, are permitted. This license is short. Redistributions of source code must retain the above copyright notice. Redistributions in binary form must reproduce the above copyright notice.", "BSD-2-Clause"),
    "two": ("Released under the MIT License. Some words.\n\nLicensed under CC BY 4.0", "MIT;CC-BY-4.0"),
    "no word parts": ("permit license and occ by 4 0 later", ""),
    "none": ("The cat sat on the mat. It was provided with milk, as required, later.", ""),
}


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(TEXTS.values())], "doc_id long, text string")
    return {r["doc_id"]: r for r in licenses.scan(docs).collect()}


def test_every_text(found):
    assert {name: found[i]["licences"] for i, name in enumerate(TEXTS)} == {name: licence for name, (_, licence) in TEXTS.items()}


def test_every_licence_has_a_text(found):
    assert {name for name, _ in licenses.LICENCES} <= {x for r in found.values() for x in r["licences"].split(";")}


def test_hints_drop_nothing():
    """Every alternative of a wording has a hint in it."""
    import itertools
    import re

    for _, wording in licenses.SENTENCES:
        for plain in expanded(wording, itertools, re):
            assert re.search(licenses.HINTS, plain), plain


def expanded(wording, itertools, re):
    pieces = re.split(r"(\(\?:[^()]*\)\??)", wording)
    choices = [[*p[3:].rstrip("?").rstrip(")").split("|"), *([""] if p.endswith("?") else [])] if p.startswith("(?:") else [p] for p in pieces]
    return ["".join(x) for x in itertools.product(*choices)]


# expression lines and sentences that only look like a licence: licences, unused
LINES = {
    "SPDX-License-Identifier: GPL-2.0-or-later": ("GPL-2.0-or-later", ""),
    "SPDX-License-Identifier: GPL-2.0-only": ("GPL-2.0-only", ""),
    "SPDX-License-Identifier: GPL-2.0": ("GPL-2.0-only", ""),
    "// SPDX-License-Identifier: LGPL-2.1+": ("LGPL-2.1-or-later", ""),
    "# SPDX-License-Identifier: GPL-3.0+ ": ("GPL-3.0-or-later", ""),
    "/* SPDX-License-Identifier: AGPL-3.0-or-later */": ("AGPL-3.0-or-later", ""),
    "<!-- SPDX-License-Identifier: LGPL-3.0-only -->": ("LGPL-3.0-only", ""),
    "SPDX-License-Identifier: MIT OR Apache-2.0": ("MIT;Apache-2.0", ""),
    "SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause": ("MIT;Apache-2.0;BSD-3-Clause", ""),
    "spdx-license-identifier: mit or apache-2.0": ("MIT;Apache-2.0", ""),
    "SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception": ("Apache-2.0 WITH LLVM-exception", ""),
    "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0": ("GPL-2.0-only WITH Classpath-exception-2.0", ""),
    "SPDX-License-Identifier: (GPL-2.0+ WITH Linux-syscall-note) OR MIT": ("GPL-2.0-or-later WITH Linux-syscall-note;MIT", ""),
    "SPDX-License-Identifier: GPL-3.0-or-later with GCC-exception-3.1": ("GPL-3.0-or-later WITH GCC-exception-3.1", ""),
    "SPDX-License-Identifier: GPL-2.0-only WITH Own-exception-1.0": ("", "gpl-2.0-only~own-exception-1.0,"),
    "SPDX-License-Identifier: MIT-0": ("MIT-0", ""),
    "SPDX-License-Identifier: BSD-3-Clause-Clear": ("BSD-3-Clause-Clear", ""),
    "SPDX-License-Identifier: 0BSD": ("0BSD", ""),
    "SPDX-License-Identifier: MPL-2.0+": ("MPL-2.0+", ""),
    "SPDX-License-Identifier: LicenseRef-Own AND ISC": ("ISC", "licenseref-own,"),
    "SPDX-License-Identifier: MITX": ("", "mitx,"),
    "SPDX-License-Identifier: NONE": ("", ""),
    "SPDX-License-Identifier: NOASSERTION": ("", ""),
    "SPDX-License-Identifier:": ("", ""),
    "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: MIT\nSPDX-License-Identifier: ISC": ("MIT;ISC", ""),
    "SPDX-License-Identifier: MIT\n\nReleased under the MIT License.": ("MIT", ""),
    "SPDX-License-Identifier: ISC\n\nReleased under the MIT License.": ("ISC;MIT", ""),
    "This file is not licensed under the MIT License.": ("", "unknown,"),
    "It is no longer distributed under the Apache License, Version 2.0.": ("", "unknown,"),
    "It was never publicly released under the MIT License.": ("", "unknown,"),
    "It is licensed under the MIT License, not under another.": ("MIT", ""),
    "Licensed under the Apache License, Version 1.1.": ("", "unknown,"),
}


def test_lines(spark):
    rows = list(LINES)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {rows[r["doc_id"]]: (r["licences"], r["unused"]) for r in licenses.scan(df).collect()}
    assert got == LINES


def test_lines_in_sql(spark):
    """DuckDB gives the same for these lines and for the texts above."""
    import duckdb
    import pandas as pd

    texts = [*LINES, *[t for t, _ in TEXTS.values()], None, ""]
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})  # noqa: F841
    names = ["doc_id", "sentence_ids", "licences", "unused", "expressions"]
    sql = duckdb.sql(licenses.oracle()).df()[names]
    own = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select(*names).toPandas()
    assert sorted(map(tuple, sql.itertuples(index=False))) == sorted(map(tuple, own.itertuples(index=False)))


def test_expressions(spark):
    df = spark.createDataFrame([(1, "/* SPDX-License-Identifier: MIT OR Apache-2.0 */\nx\n# SPDX-License-Identifier: ISC"), (2, "none")], "doc_id long, text string")
    assert {r["doc_id"]: r["expressions"] for r in licenses.scan(df).collect()} == {1: "MIT OR Apache-2.0;ISC", 2: ""}
