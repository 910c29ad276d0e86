"""Licence scan by sentence rules, in DataFrame functions only.

A text is cut into sentences at ``.``, ``!``, ``?`` and blank lines; a single line end is white space, so wrapped licence
texts stay whole. Sentences are normalised (A-Z in lower case, runs of anything but letters and digits become one space), and
each known licence sentence in them is mapped to its identifier, in order; one that says what a work is not licensed under is not known. The sequence of
identifiers is then matched against licence rules in order; what a rule matches is used up.

Lines ``SPDX-License-Identifier:`` are no sentences but expressions: their operands, an exception after WITH included, are looked up
whole in the list of known licences, so ``GPL-2.0-or-later``, ``GPL-2.0+``, ``MIT-0`` and ``Apache-2.0 WITH LLVM-exception`` are what they say.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifier and normalised wording of known licence sentences; of two that begin at one word the first counts.
# Most are plain text and are looked up as they are; those with variable parts are patterns.
SENTENCES = [
    ("apacheLicensed", "(?:licensed|released|distributed|available) under the (?:terms of the )?apache (?:software )?license (?:version )?2 0"),
    ("apacheNotUse", "you may not use this (?:file|work|software) except in compliance with the license"),
    ("apacheCopy", "you may obtain a copy of the license at"),
    ("apacheUnless", "unless required by applicable law or agreed to in writing"),
    ("apacheTitle", "apache license version 2 0 january 2004"),
    ("llvmException", "llvm exceptions to the apache 2 0 license"),
    ("mitReleased", "(?:licensed|released|distributed|available) under the (?:terms of the )?mit license"),
    ("bslGrant", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("mitPermission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mitNotice", "the above copyright notice and this permission notice shall be included in all copies"),
    ("iscPermission", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlibPermission", "permission is granted to anyone to use this software for any purpose"),
    ("zlibOrigin", "the origin of this software must not be misrepresented"),
    ("zlibAltered", "altered source versions must be plainly marked as such"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("bsdRedistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsdSource", "redistributions of source code must retain the above copyright notice"),
    ("bsdBinary", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsdAdvertising", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsdEndorse", "may be used to endorse or promote products derived from"),
    ("bsdReleased", "(?:licensed|released|distributed|available) under (?:the|a) (?:terms of the )?bsd license"),
    ("boostTitle", "boost software license version 1 0"),
    ("eclipse2", "eclipse public license (?:version |v )?2 0"),
    ("mpl2", "mozilla public license (?:version |v )?2 0"),
    ("lgpl21", "gnu (?:lesser|library) general public license (?:version 2 1|as published by the free software foundation either version 2 1)"),
    ("lgpl3", "gnu lesser general public license (?:version 3|as published by the free software foundation either version 3)"),
    ("agpl3", "gnu affero general public license (?:version 3|as published by the free software foundation either version 3)"),
    ("gpl3", "(?:under the terms of the )?gnu general public license (?:version 3|as published by the free software foundation either version 3)"),
    ("gpl2", "(?:under the terms of the )?gnu general public license (?:version 2|as published by the free software foundation either version 2)"),
    ("gplTerms", "under the terms of the gnu general public license"),
    ("gplLater", "at your option any later version"),
    ("classpath", "linking this library statically or dynamically with other modules"),
    ("ccByNcSa4", "(?:cc by nc sa|attribution noncommercial sharealike) 4 0"),
    ("ccByNcNd4", "(?:cc by nc nd|attribution noncommercial noderivatives) 4 0"),
    ("ccByNc4", "(?:cc by nc|attribution noncommercial) 4 0"),
    ("ccByNd4", "(?:cc by nd|attribution noderivatives) 4 0"),
    ("ccBySa4", "(?:cc by sa|attribution sharealike) 4 0"),
    ("ccBySa3", "(?:cc by sa|attribution sharealike) 3 0"),
    ("ccBy4", "(?:cc by|creative commons attribution) 4 0"),
    ("ccBy3", "(?:cc by|creative commons attribution) 3 0"),
    ("cc0", "cc0 1 0"),
    ("publicDomain", "(?:dedicated to|released into) the public domain"),
    ("asIs", "is provided (?:by [a-z0-9 ]{1,80} )?as is"),
    ("allRights", "all rights reserved"),
    ("copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]"),
]

# Names of licences in expressions, as they are written there.
SPDX = """
0BSD AFL-3.0 Apache-1.1 Apache-2.0 Artistic-2.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 CC0-1.0
CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CDDL-1.0 CDDL-1.1 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 ISC MIT MIT-0
MPL-1.1 MPL-2.0 MS-PL MS-RL NCSA OFL-1.1 OSL-3.0 PostgreSQL Python-2.0 UPL-1.0 Unicode-3.0 Unlicense WTFPL X11 Zlib
""".split()
# Families whose versions come alone, with -only, with -or-later or with +; alone means only.
SPDX_GNU = ["AGPL-3.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0"]
# Exceptions after WITH.
SPDX_EXCEPTIONS = ["Autoconf-exception-3.0", "Bison-exception-2.2", "Classpath-exception-2.0", "GCC-exception-3.1", "Linux-syscall-note", "LLVM-exception", "OpenSSL-exception"]

# Licence and its sequence of identifiers; a rule is tried after those above it.
LICENCES = [
    ("Apache-2.0 WITH LLVM-exception", "(?:apacheTitle,|apacheLicensed,)(?:apacheNotUse,)?(?:apacheCopy,)?(?:apacheUnless,)?llvmException,"),
    ("Apache-2.0", "(?:apacheTitle,)?apacheLicensed,(?:apacheNotUse,)?(?:apacheCopy,)?(?:apacheUnless,)?"),
    ("Apache-2.0", "apacheTitle,"),
    ("BSL-1.0", "(?:boostTitle,)?bslGrant,"),
    ("BSL-1.0", "boostTitle,"),
    ("MIT", "(?:mitReleased,)?mitPermission,(?:mitNotice,)?(?:asIs,)?"),
    ("MIT", "mitReleased,"),
    ("ISC", "iscPermission,(?:asIs,)?"),
    ("Zlib", "(?:asIs,)?zlibPermission,(?:zlibOrigin,)?(?:zlibAltered,)?"),
    ("Unlicense", "unlicense,(?:asIs,)?"),
    ("BSD-4-Clause", "bsdRedistribution,bsdSource,bsdBinary,bsdAdvertising,bsdEndorse,(?:asIs,)?"),
    ("BSD-3-Clause", "bsdRedistribution,bsdSource,bsdBinary,bsdEndorse,(?:asIs,)?"),
    ("BSD-2-Clause", "bsdRedistribution,bsdSource,bsdBinary,(?:asIs,)?"),
    ("BSD-any", "bsdReleased,"),
    ("EPL-2.0", "eclipse2,"),
    ("MPL-2.0", "mpl2,"),
    ("LGPL-2.1-or-later", "lgpl21,gplLater,"),
    ("LGPL-2.1-only", "lgpl21,"),
    ("LGPL-3.0-or-later", "lgpl3,gplLater,"),
    ("LGPL-3.0-only", "lgpl3,"),
    ("AGPL-3.0-or-later", "agpl3,gplLater,"),
    ("AGPL-3.0-only", "agpl3,"),
    ("GPL-3.0-or-later", "gpl3,gplLater,"),
    ("GPL-3.0-only", "gpl3,"),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", "gpl2,gplLater,classpath,"),
    ("GPL-2.0-only WITH Classpath-exception-2.0", "gpl2,classpath,"),
    ("GPL-2.0-or-later", "gpl2,gplLater,"),
    ("GPL-2.0-only", "gpl2,"),
    ("GPL-any", "gplTerms,(?:gplLater,)?"),
    ("CC-BY-NC-SA-4.0", "ccByNcSa4,"),
    ("CC-BY-NC-ND-4.0", "ccByNcNd4,"),
    ("CC-BY-NC-4.0", "ccByNc4,"),
    ("CC-BY-ND-4.0", "ccByNd4,"),
    ("CC-BY-SA-4.0", "ccBySa4,"),
    ("CC-BY-SA-3.0", "ccBySa3,"),
    ("CC-BY-4.0", "ccBy4,"),
    ("CC-BY-3.0", "ccBy3,"),
    ("CC0-1.0", "cc0,"),
    ("Public-Domain", "publicDomain,"),
    ("All-Rights-Reserved", "(?:copyright,)?allRights,"),
]

# Words of which a normalised sentence that is worth a note has one, known or not.
MENTIONS = "licen[sc]e|copyright|permission|redistribution|rights reserved|public domain"

#: One of these is in every sentence that a rule or ``MENTIONS`` knows; they are single words, so raw text has them, too.
HINTS = "licen[sc]e|copyright|permission|redistribution|rights|public|spdx|required|obtain|later|cc|attribution|provided|endorse|advertising|origin|altered|apache|gnu|linking|unencumbered|domain"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KNOWN = r"\b(?:" + "|".join(f"(?:{wording})" for _, wording in SENTENCES) + r")\b"
#: Ends of sentences: a mark with white space behind, or a blank line.
_ENDS = r"[.!?][\x20\x09-\x0D]+|\x0D?\x0A[\x20\x09]*\x0D?\x0A"


#: A line of an expression, what stands between its operands, and an operand.
_TAG = r"(?i)spdx-license-identifier:[\x20\x09]*([^\x0A\x0D]*)"
_WITH, _OPERAND = r"(?i)[\x20\x09]+with[\x20\x09]+", r"[A-Za-z0-9][A-Za-z0-9.+~-]*"
#: What a work is not licensed under.
_NEGATED = r"\b(?:not|never|no longer|neither) (?:[a-z]+ )?(?:licensed|released|distributed|available) under\b"


def spdx_licences() -> dict[str, str]:
    """Operand of an expression in lower case, with ``~`` for WITH -> licence."""
    out = {name.lower(): name for name in SPDX}
    for name in SPDX_GNU:
        out |= {name.lower(): f"{name}-only", f"{name}-only".lower(): f"{name}-only", f"{name}-or-later".lower(): f"{name}-or-later", f"{name}+".lower(): f"{name}-or-later"}
    out |= {f"{name}+".lower(): f"{name}+" for name in SPDX}
    return out


#: ``v.`` before a number ends no sentence.
_VERSION = r"\b([vV])\.\x20"


def _fixed(wording: str) -> bool:
    return not re.search(r"[^a-z0-9 ]", wording)


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def normalised(sentence: Column) -> Column:
    """Lower-case letters and digits with single spaces between."""
    return F.trim(F.regexp_replace(_lower(sentence), "[^a-z0-9]+", " "))


def operands(text: Column) -> Column:
    """Operands of all expressions of a text in order, in lower case: ``mit``, ``apache-2.0~llvm-exception``."""
    lines = F.transform(F.regexp_extract_all(text, F.lit(_TAG), F.lit(1)), lambda x: F.regexp_replace(x, _WITH, "~"))
    found = F.flatten(F.transform(lines, lambda x: F.regexp_extract_all(_lower(x), F.lit(_OPERAND.replace("A-Z", "")), F.lit(0))))
    return F.filter(found, lambda x: ~x.isin("and", "or", "none", "noassertion"))


def spdx(operand: Column) -> Column:
    """The licence of an operand, NULL if it or its exception is not known."""
    table = F.create_map(*[F.lit(x) for pair in spdx_licences().items() for x in pair])
    exceptions = F.create_map(*[F.lit(x) for name in SPDX_EXCEPTIONS for x in (name.lower(), name)])
    parts = F.split(operand, "~")
    name, exception = F.try_element_at(table, F.get(parts, 0)), F.try_element_at(exceptions, F.get(parts, 1))
    return F.when(F.size(parts) == 1, name).when(F.size(parts) == 2, F.concat(name, F.lit(" WITH "), exception))


def _identifier(wording: Column) -> Column:
    """Identifier of a known sentence: a look-up of its wording, or the first pattern that it has."""
    table = F.create_map(*[F.lit(x) for name, text in SENTENCES if _fixed(text) for x in (text, name)])
    out = F
    for name, pattern in SENTENCES:
        if not _fixed(pattern):
            out = out.when(wording.rlike(f"^(?:{pattern})$"), F.lit(name))
    return F.coalesce(F.try_element_at(table, wording), out.otherwise(F.lit("unknown")))


def sentences(text: Column, tagged: Column) -> Column:
    """Normalised sentences that have one of ``HINTS``, without expressions; what a work is not licensed under is ``negated``."""
    own = F.regexp_replace(F.when(tagged, F.regexp_replace(text, _TAG, " ")).otherwise(text), _VERSION, "$1 ")
    return F.transform(F.filter(F.split(own, _ENDS), lambda s: _lower(s).rlike(HINTS)), lambda s: F.regexp_replace(normalised(s), _NEGATED, "negated"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, sentence_ids, licences, unused, expressions) of every row.

    sentence_ids: identifiers of the known sentences, in order, each followed by a comma (``unknown`` for a sentence that
    mentions licensing and has no known one); licences: those of expressions in order, then those of sentences in the order of the rules, joined by
    ``;``; unused: identifiers that no rule used, the unknown ones last: they do not come between those of a rule, then operands of expressions that are
    no known licence, or have an unknown exception; expressions: all expressions as they stand, joined by ``;``, as OR and AND do not show in the licences.
    Null, empty and unlicensed texts have empty strings. Repeated
    rows and null ids come back; other columns are ignored; an empty table gives no rows.
    """
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # few texts have an expression, so the others are not searched for one again
    tagged = F.contains(F.lower("text"), F.lit("spdx-license-identifier:"))
    own = own.withColumn("tagged", tagged)
    known = lambda s: F.regexp_extract_all(s, F.lit(_KNOWN), F.lit(0))
    of_sentence = lambda s: F.when(F.size(known(s)) > 0, F.transform(known(s), _identifier)).when(s.rlike(MENTIONS), F.array(F.lit("unknown"))).otherwise(F.array().cast("array<string>"))
    # a text without any hint needs no cutting
    found = F.when(_lower(F.col("text")).rlike(HINTS), F.flatten(F.transform(sentences(F.col("text"), F.col("tagged")), of_sentence)))
    tags = F.when(F.col("tagged"), operands(F.col("text")))
    named = F.transform(tags, lambda x: F.struct(x.alias("operand"), spdx(x).alias("licence")))
    lines = F.transform(F.regexp_extract_all("text", F.lit(_TAG), F.lit(1)), lambda x: F.trim(F.regexp_replace(x, r"[\x20\x09]*(?:\*/|-->)?[\x20\x09]*$", "")))
    expressions = F.when(F.col("tagged"), F.array_join(lines, ";"))
    rows = own.select("doc_id", F.coalesce(F.concat_ws("", F.transform(found, lambda x: F.concat(x, F.lit(",")))), F.lit("")).alias("sentence_ids"), named.alias("tags"), F.coalesce(expressions, F.lit("")).alias("expressions"))
    rows = rows.withColumn("known", F.replace("sentence_ids", F.lit("unknown,"), F.lit("")))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(rf"\b{pattern}").alias("pattern")) for name, pattern in LICENCES])
    start = F.struct(F.col("known").alias("rest"), F.array().cast("array<string>").alias("names"))
    step = lambda acc, rule: F.struct(
        F.regexp_replace(acc["rest"], rule["pattern"], F.lit("|")).alias("rest"),
        F.when(F.regexp_like(acc["rest"], rule["pattern"]), F.array_append(acc["names"], rule["name"])).otherwise(acc["names"]).alias("names"),
    )
    rows = rows.withColumn("m", F.when(F.col("known") != "", F.aggregate(rules, start, step)))
    empty = F.array().cast("array<string>")
    by_tag = F.filter(F.transform("tags", lambda t: t["licence"]), lambda x: x.isNotNull())
    licences = F.array_join(F.array_distinct(F.concat(F.coalesce(by_tag, empty), F.coalesce("m.names", empty))), ";")
    others = F.transform(F.filter("tags", lambda t: t["licence"].isNull()), lambda t: F.concat(t["operand"], F.lit(",")))
    unknown = F.repeat(F.lit("unknown,"), F.regexp_count("sentence_ids", F.lit("unknown,")))
    unused = F.concat(F.coalesce(F.replace(F.col("m.rest"), F.lit("|"), F.lit("")), F.lit("")), unknown, F.coalesce(F.array_join(others, ""), F.lit("")))
    return rows.select("doc_id", "sentence_ids", licences.alias("licences"), unused.alias("unused"), "expressions")


def oracle() -> str:
    """The same as DuckDB SQL, generated from the same rules."""
    cases = " ".join(f"WHEN regexp_full_match(w, '{pattern}') THEN '{name}'" for name, pattern in SENTENCES)
    steps, last = [], "r0"
    for i, (name, pattern) in enumerate(LICENCES, 1):
        steps.append(f"r{i} AS (SELECT r, doc_id, sentence_ids, regexp_replace(rest, '\\b{pattern}', '|', 'g') AS rest, CASE WHEN regexp_matches(rest, '\\b{pattern}') AND NOT list_contains(names, '{name}') THEN list_append(names, '{name}') ELSE names END AS names FROM {last})")
        last = f"r{i}"
    spdx_rows = ", ".join(f"('{a}', '{b}')" for a, b in spdx_licences().items())
    exceptions = ", ".join(f"('{x.lower()}', '{x}')" for x in SPDX_EXCEPTIONS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
e AS (SELECT r, i, x[i] AS x FROM (SELECT r, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT r, regexp_extract_all(text, '{_TAG}', 1) AS x FROM d))),
o AS (SELECT r, i, j, w[j] AS operand FROM (SELECT r, i, w, unnest(range(1, len(w) + 1)) AS j FROM (SELECT r, i, regexp_extract_all(translate(regexp_replace(x, '{_WITH}', '~', 'g'), '{_UPPER}', '{_LOWER}'), '{_OPERAND.replace("A-Z", "")}') AS w FROM e))),
n AS (
  SELECT r, i, j, operand, CASE WHEN operand LIKE '%~%' THEN s.name || ' WITH ' || x.name ELSE s.name END AS licence
  FROM o LEFT JOIN (VALUES {spdx_rows}) s(id, name) ON s.id = split_part(operand, '~', 1) LEFT JOIN (VALUES {exceptions}) x(id, name) ON x.id = substr(operand, instr(operand, '~') + 1)
  WHERE operand NOT IN ('and', 'or', 'none', 'noassertion')),
tags AS (SELECT r, list(licence ORDER BY i, j) FILTER (licence IS NOT NULL) AS names, string_agg(operand || ',', '' ORDER BY i, j) FILTER (licence IS NULL) AS others FROM n GROUP BY r),
ex AS (SELECT r, string_agg(trim(regexp_replace(x, '[\x20\x09]*(?:\*/|-->)?[\x20\x09]*$', '')), ';' ORDER BY i) AS expressions FROM e GROUP BY r),
t AS (SELECT r, i, w[i] AS s FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT r, regexp_split_to_array(regexp_replace(regexp_replace(text, '{_TAG}', ' ', 'g'), '{_VERSION}', '\1 ', 'g'), '{_ENDS}') AS w FROM d))),
m AS (SELECT r, i, regexp_replace(trim(regexp_replace(translate(s, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g')), '{_NEGATED}', 'negated', 'g') AS p FROM t),
a AS (SELECT r, i, p, regexp_extract_all(p, '{_KNOWN}') AS k FROM m),
b AS (SELECT r, i, j, k[j] AS w FROM (SELECT r, i, k, unnest(range(1, len(k) + 1)) AS j FROM a)
  UNION ALL SELECT r, i, 1, NULL FROM a WHERE len(k) = 0 AND regexp_matches(p, '{MENTIONS}')),
k AS (SELECT r, string_agg(CASE WHEN w IS NULL THEN 'unknown' {cases} END || ',', '' ORDER BY i, j) AS ids FROM b GROUP BY r),
r0 AS (SELECT d.r, doc_id, coalesce(ids, '') AS sentence_ids, replace(coalesce(ids, ''), 'unknown,', '') AS rest, CAST([] AS VARCHAR[]) AS names FROM d LEFT JOIN k USING (r)),
{", ".join(steps)},
f AS (SELECT l.*, list_concat(coalesce(tags.names, []), l.names) AS every, coalesce(others, '') AS others, coalesce(expressions, '') AS expressions FROM {last} l LEFT JOIN tags USING (r) LEFT JOIN ex USING (r))
SELECT doc_id, sentence_ids, coalesce(array_to_string(list_filter(every, lambda x, i: list_position(every, x) = i), ';'), '') AS licences,
  replace(rest, '|', '') || repeat('unknown,', len(regexp_extract_all(sentence_ids, 'unknown,'))) || others AS unused, expressions FROM f"""
