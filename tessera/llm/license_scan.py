"""Licence recognition by sentence rules, in DataFrame expressions alone.

A text is normalised (lower case, runs of other characters than letters, digits
and + as one blank), with marks for line ends and for what ends a sentence (a
stop before a blank or line end, and an empty line, comment leaders aside).
Known licence sentences are found from mark to mark, the longest first; line
ends may stand inside them, ends of sentences only where the known sentence has
a stop itself ("v. 2.0"). This gives the sequence of sentence identifiers. Ordered
rules, longest first, are matched against the sequence; what a rule has matched
is used up, so that a short rule inside a longer one does not count again.
Texts without any trigger word, one of which is in every known sentence, are
passed over without parting them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences by identifier. Each has one of TRIGGERS.
SENTENCES = {
    "apache-short": "Licensed under the Apache License, Version 2.0",
    "apache-you": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-not-use": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "mit-short": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED',
    "gpl-3-short": "This work is licensed under the GNU General Public License, version 3",
    "gpl-2-short": "This work is licensed under the GNU General Public License, version 2",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl-details": "See the GNU General Public License for more details",
    "lgpl-3-short": "This work is licensed under the GNU Lesser General Public License, version 3",
    "agpl-3-short": "This work is licensed under the GNU Affero General Public License, version 3",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by": "Licensed under CC BY 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-nd": "Licensed under CC BY-ND 4.0",
    "cc0": "Licensed under CC0 1.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "reserved": "All rights reserved",
}
#: Rules as ordered sentence identifiers.
RULES = {
    "Apache-2.0": [["apache-you", "apache-not-use", "apache-copy", "apache-as-is"], ["apache-you", "apache-not-use"], ["apache-short"], ["apache-you"]],
    "MIT": [["mit-grant", "mit-notice", "mit-as-is"], ["mit-grant", "mit-notice"], ["mit-short"], ["mit-licensed"]],
    "GPL-3.0-or-later": [["gpl-free", "gpl-hope", "gpl-details"], ["gpl-free"]],
    "GPL-3.0-only": [["gpl-3-short"]],
    "GPL-2.0-only": [["gpl-2-short"]],
    "LGPL-3.0-only": [["lgpl-3-short"]],
    "AGPL-3.0-only": [["agpl-3-short"]],
    "BSD-3-Clause": [["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]],
    "BSD-2-Clause": [["bsd-redistribution", "bsd-source", "bsd-binary"]],
    "MPL-2.0": [["mpl-2"]],
    "CC-BY-4.0": [["cc-by"]],
    "CC-BY-SA-4.0": [["cc-by-sa"]],
    "CC-BY-NC-4.0": [["cc-by-nc"]],
    "CC-BY-NC-SA-4.0": [["cc-by-nc-sa"]],
    "CC-BY-ND-4.0": [["cc-by-nd"]],
    "CC0-1.0": [["cc0"]],
    "Unlicense": [["unlicense"]],
    "LicenseRef-All-Rights-Reserved": [["reserved"]],
}
#: More wordings: whole sentences of the licences, with the identifiers that they stand for.
WHOLE = [
    ("mit-grant", SENTENCES["mit-grant"] + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit-as-is", SENTENCES["mit-as-is"] + ", INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"),
    ("apache-you,apache-not-use", SENTENCES["apache-you"] + "; " + SENTENCES["apache-not-use"]),
    ("apache-copy", SENTENCES["apache-copy"] + " http://www.apache.org/licenses/LICENSE-2.0"),
]
#: Single words, which no line end can part.
TRIGGERS = ["licens", "copyright", "permission", "redistribut", "warrant", "unencumbered", "reserved"]


def normal_text(text: str) -> str:
    import re

    return re.sub("[^a-z0-9+]+", " ", text.lower()).strip()


def known_sentences(sentences: dict[str, str]) -> dict[str, str]:
    out = {}
    for name, s in sentences.items():
        if not any(t in s.lower() for t in TRIGGERS):
            raise ValueError(f"the sentence {name} has no trigger word")
        out.setdefault(normal_text(s), name)
    return out


def wordings(sentences: dict[str, str]) -> tuple[dict[str, str], list[str]]:
    """(identifiers of each normalised wording, all wordings)."""
    more = WHOLE if sentences is SENTENCES else []
    return known_sentences(sentences) | {normal_text(t): names for names, t in more}, [*sentences.values(), *(t for _, t in more)]


def pattern(sentence: str, mark: str = " [/|]", line: str = " /") -> str:
    """A known sentence among marks: / is a line's end, | a sentence's."""
    import re

    out = ""
    for gap, word in re.findall("([^a-z0-9+]*)([a-z0-9+]+)", sentence.lower()):
        out += (f"(?:{mark})* " if re.search(r"[.!?]\s", gap) else f"(?:{line})? " if out else "") + re.escape(word)
    return out


def longest_first(texts: list[str], pattern_of) -> list[str]:
    return [pattern_of(t) for t in sorted({normal_text(t): t for t in texts}.values(), key=lambda t: (-len(normal_text(t)), normal_text(t)))]


def marked(text: Column) -> Column:
    """The normalised text with its marks. They are letters of upper case at first, of which a lower-cased text has none in ASCII."""
    text = F.regexp_replace(F.lower(text), r"[.!?]+(?:[ \t\r]+|\r?(?=\n))", F.lit(" S "))
    text = F.regexp_replace(F.regexp_replace(text, r"\n", F.lit(" N ")), "[^a-z0-9+NS]+", F.lit(" "))
    text = F.regexp_replace(text, "N(?: N)+", F.lit("S"))
    text = F.translate(text, "NS", "/|")
    return F.concat(F.lit("| "), F.btrim(text), F.lit(" |"))


def ordered(rules: dict[str, list[list[str]]]) -> list[tuple[str, list[str]]]:
    """Longest rules first; equally long ones in the order given."""
    return sorted(((name, r) for name, rs in rules.items() for r in rs), key=lambda x: -len(x[1]))


def scan(docs: DataFrame, sentences=SENTENCES, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_known (known sentences), sentence_ids (in order, comma-joined) and licenses (sorted, comma-joined) of each row.

    Null and empty texts have none: 0 and empty strings. Repeated rows are
    scanned each. Whole texts of any length are read, with no bound on a sentence's; no exchange; an
    empty table gives no rows; other columns are not read.
    """
    known, texts = wordings(sentences)
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    low = F.lower(text)
    some = low.contains(TRIGGERS[0])
    for t in TRIGGERS[1:]:
        some = some | low.contains(t)
    every = longest_first(texts, pattern)
    hits = F.regexp_extract_all(marked(text), F.lit("(?<=[/|] )(?:" + "|".join(every) + ")(?= [/|])"), F.lit(0))
    ids = F.transform(hits, lambda s: F.try_element_at(table, F.regexp_replace(s, " [/|]", F.lit(""))))
    ids = F.flatten(F.transform(ids, lambda x: F.split(x, ",")))
    found = docs.select(F.col(id_col), F.when(some, ids).alias("ids")).select(id_col, F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))
    found = found.select(id_col, F.size("ids").cast("long").alias("n_known"), F.array_join("ids", ",").alias("sentence_ids"), F.concat(F.lit(",,"), F.array_join("ids", ",,"), F.lit(",,")).alias("left"))
    # Each rule's place in the sequence is replaced by a bar, which no rule contains.
    state = F.struct(F.col("left").alias("rest"), F.lit("").alias("names"))
    for name, rule in ordered(rules):
        state = _step(state, F.lit("," + ",,".join(rule) + ","), name)
    done = found.withColumn("state", F.when(F.col("n_known") > 0, state))
    licenses = F.array_join(F.array_sort(F.array_distinct(F.filter(F.split("state.names", ","), lambda x: x != ""))), ",")
    return done.select(id_col, "n_known", "sentence_ids", F.coalesce(licenses, F.lit("")).alias("licenses"))


def _step(state: Column, pattern: Column, name: str) -> Column:
    """One rule: names grows if the pattern is in rest, and rest loses it. As a one-element transform, so that the state is computed once."""
    return F.transform(
        F.array(state),
        lambda s: F.when(
            F.contains(s["rest"], pattern),
            F.struct(F.replace(s["rest"], pattern, F.lit("|")).alias("rest"), F.concat(s["names"], F.lit(f"{name},")).alias("names")),
        ).otherwise(F.struct(s["rest"].alias("rest"), s["names"].alias("names"))),
    )[0]


def oracle() -> str:
    """The same in DuckDB's SQL, whose patterns can't look around: marks are doubled, so that a sentence takes one at each side and leaves one to its neighbour."""
    known, texts = wordings(SENTENCES)
    q = lambda s: "'" + s.replace("'", "''") + "'"
    pairs = ", ".join(f"({q(s)}, {q(n)})" for s, n in known.items())
    every = "|".join(longest_first(texts, lambda t: pattern(t, " [/|] [/|]", " / /")))
    steps = ordered(RULES)
    sql = f"""WITH known(s, names) AS (VALUES {pairs}),
low AS (SELECT row_number() OVER () AS rn, doc_id, regexp_replace(regexp_replace(lower(coalesce(text, '')), '[.!?]+[ \\t\\r]+', ' S ', 'g'), '[.!?]+\\n', ' S ' || chr(10), 'g') AS t FROM documents),
marks AS (SELECT rn, doc_id, '| | ' || trim(replace(replace(regexp_replace(regexp_replace(replace(t, chr(10), ' N '), '[^a-z0-9+NS]+', ' ', 'g'), 'N(?: N)+', 'S', 'g'), 'N', '/ /'), 'S', '| |'), ' ') || ' | |' AS t FROM low),
hits AS (SELECT rn, unnest(hits) AS hit, generate_subscripts(hits, 1) AS pos FROM (SELECT rn, regexp_extract_all(t, {q("[/|] (" + every + ") [/|]")}, 1) AS hits FROM marks)),
ids AS (SELECT rn, string_split(string_agg(names, ',' ORDER BY pos), ',') AS ids FROM hits JOIN known ON regexp_replace(hit, ' [/|]', '', 'g') = s GROUP BY rn),
s0 AS (SELECT doc_id, coalesce(len(ids), 0) AS n_known, coalesce(array_to_string(ids, ','), '') AS sentence_ids, CASE WHEN ids IS NULL THEN '' ELSE ',,' || array_to_string(ids, ',,') || ',,' END AS rest, '' AS names FROM low LEFT JOIN ids USING (rn))"""
    for i, (name, rule) in enumerate(steps):
        p = q("," + ",,".join(rule) + ",")
        sql += f",\ns{i + 1} AS (SELECT doc_id, n_known, sentence_ids, replace(rest, {p}, '|') AS rest, CASE WHEN contains(rest, {p}) THEN names || {q(name + ',')} ELSE names END AS names FROM s{i})"
    return sql + f"\nSELECT doc_id, CAST(n_known AS BIGINT) AS n_known, sentence_ids, coalesce(array_to_string(list_sort(list_distinct(list_filter(string_split(names, ','), lambda x: x <> ''))), ','), '') AS licenses FROM s{len(steps)}"
