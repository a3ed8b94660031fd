"""License scan by sentence rules (DataFrame functions only).

A text is cut into sentences, every sentence is normalised (lower case, runs
of anything but letters, digits and dots become one space), and a normalised
sentence that is in the sentence table becomes that sentence's identifier.
Several wordings of a sentence share an identifier; marks that open the lines
of a source comment do not count. The identifiers of a document, in order, are
matched against the ordered rules: a rule is a sequence of identifiers that
must stand one after the other among the document's identified sentences.
Rules are tried from the most specific, and identifiers that a rule matched
serve no later rule.

Defined results: a null or empty text has no licenses (an empty list); rows
that share an id are one document whose sentences are taken row by row
(identical rows count once); a row without an id is a document of its own by
its text; an empty table gives an empty result; other columns are ignored.
Texts of any length are cut in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# License sentences (normalised) and their identifiers.
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2.0",
    "apache-may-not": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software "
                    "distributed under the license is distributed on an as is basis without "
                    "warranties or conditions of any kind either express or implied",
    "mit-notice": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy "
                 "of this software and associated documentation files the software to deal in "
                 "the software without restriction including without limitation the rights to "
                 "use copy modify merge publish distribute sublicense and or sell copies of the "
                 "software and to permit persons to whom the software is furnished to do so "
                 "subject to the following conditions",
    "mit-condition": "the above copyright notice and this permission notice shall be included "
                     "in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied "
             "including but not limited to the warranties of merchantability fitness for a "
             "particular purpose and noninfringement",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl2-notice": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software",
    "gpl3-terms": "you can redistribute it and or modify it under the terms of the gnu general "
                  "public license as published by the free software foundation either version 3 "
                  "of the license or at your option any later version",
    "lgpl3-notice": "this work is licensed under the gnu lesser general public license version 3",
    "agpl3-notice": "this work is licensed under the gnu affero general public license version 3",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without "
                          "modification are permitted provided that the following conditions "
                          "are met",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors "
                   "may be used to endorse or promote products derived from this software "
                   "without specific prior written permission",
    "bsd-notice": "licensed under the bsd license",
    "mpl2-notice": "this source code form is subject to the terms of the mozilla public license "
                   "v",
    "cc-by": "licensed under cc by 4.0",
    "cc-by-sa": "licensed under cc by sa 4.0",
    "cc-by-nc": "licensed under cc by nc 4.0",
    "cc0": "licensed under cc0 1.0",
    "cc-by-long": "this work is licensed under a creative commons attribution 4.0 international "
                  "license",
    "reserved": "all rights reserved",
    "no-copy": "no part of this work may be reproduced without written permission",
}
# The rules in order, the most specific first.
RULES = [
    ("Apache-2.0", ["apache-notice", "apache-may-not", "apache-obtain", "apache-as-is"]),
    ("MIT", ["mit-grant", "mit-condition", "as-is"]),
    ("GPL-3.0", ["gpl-free", "gpl3-terms"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribution"]),
    ("Proprietary", ["reserved", "no-copy"]),
    ("Apache-2.0", ["apache-notice"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-grant"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-2.0", ["gpl2-notice"]),
    ("GPL-3.0", ["gpl3-terms"]),
    ("LGPL-3.0", ["lgpl3-notice"]),
    ("AGPL-3.0", ["agpl3-notice"]),
    ("BSD", ["bsd-notice"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-4.0", ["cc-by-long"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC0-1.0", ["cc0"]),
    ("Proprietary", ["reserved"]),
]
# Short notices, "[opening][verb] under the [name][ending]".
VERBS = ["licensed", "distributed", "released", "made available", "available"]
OPENINGS = ["", *(f"this {x} is " for x in ("work", "project", "program", "software", "library",
                                             "file", "code", "source code"))]
ENDINGS = ["", " the license"]
NAMES = {
    "apache-notice": ["apache license version 2.0", "apache license 2.0", "apache license v2.0",
                      "apache 2.0 license"],
    "mit-licensed": ["mit license"],
    "bsd-notice": ["bsd license"],
    "isc-notice": ["isc license"],
    "bsl-notice": [f"boost software license {v}" for v in ("version 1.0", "v1.0", "1.0")],
    "epl2-notice": [f"eclipse public license {v}" for v in ("version 2.0", "v2.0", "2.0", "v 2.0")],
    "epl1-notice": [f"eclipse public license {v}" for v in ("version 1.0", "v1.0", "1.0", "v 1.0")],
    "apache-or-mit": [f"apache license {v} or {a}mit{b}" for v in ("version 2.0", "2.0")
                      for a in ("", "the ") for b in ("", " license")],
    "mpl2-notice": [f"mozilla public license {v}" for v in ("version 2.0", "v2.0", "2.0", "v")],
    "gpl2-notice": [f"gnu general public license {v}" for v in ("version 2", "version 2.0", "v2",
                                                                "v2.0")],
} | {
    key: [f"gnu {kind}general public license {v}" for v in ("version 3", "version 3.0", "v3", "v3.0")]
    for key, kind in (("gpl3-notice", ""), ("lgpl3-notice", "lesser "), ("agpl3-notice", "affero "))}
# The GNU program headers. The version stands in the sentence or
# behind a semicolon, which ends it.
GNU = {"gpl": "", "lgpl": "lesser ", "library": "library ", "agpl": "affero "}
GNU_VERSIONS = {"gpl": ["2", "3"], "lgpl": ["2.1", "3"], "library": ["2"], "agpl": ["3"]}
GNU_TERMS = ("you can redistribute it and or modify it under the terms of the gnu {}general public "
             "license")
GNU_FSF = "as published by the free software foundation"
GNU_LATER = "either version {} of the license or at your option any later version"
GNU_LICENSES = {("gpl", "2"): "GPL-2.0", ("gpl", "3"): "GPL-3.0", ("lgpl", "2.1"): "LGPL-2.1",
                ("lgpl", "3"): "LGPL-3.0", ("library", "2"): "LGPL-2.0", ("agpl", "3"): "AGPL-3.0"}
# Names that may stand in an SPDX tag.
SPDX = ["Apache-2.0", "MIT", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause",
        "BSD-3-Clause", "ISC", "MPL-2.0", "EPL-1.0", "EPL-2.0", "BSL-1.0", "Unlicense", "CC0-1.0",
        "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0"]
# Further wordings of sentences (normalised) and their identifiers.
HEADERS = {
    "the asf licenses this file to you under the apache license version 2.0 the license":
        "apache-notice",
    "the name of the author may not be used to endorse or promote products derived from this "
    "software without specific prior written permission": "bsd-endorse",
    "use of this source code is governed by a bsd style license that can be found in the license "
    "file": "bsd-notice",
    **{f"this source code form is subject to the terms of the mozilla public license {v}":
       "mpl2-notice" for v in ("version 2.0", "v2.0", "2.0")},
    "the contents of this file are subject to the mozilla public license version 1.1 the license":
        "mpl11-notice",
    **{f"{o}{w} under the {n}{e}": key for key, names in NAMES.items() for n in names
       for o in OPENINGS for w in VERBS for e in ENDINGS},
    "permission to use copy modify and or distribute this software for any purpose with or without "
    "fee is hereby granted provided that the above copyright notice and this permission notice "
    "appear in all copies": "isc-grant",
    "permission to use copy modify and distribute this software for any purpose with or without "
    "fee is hereby granted provided that the above copyright notice and this permission notice "
    "appear in all copies": "isc-grant",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of "
    "the software and accompanying documentation covered by this license the software to use "
    "reproduce display distribute execute and transmit the software and to prepare derivative "
    "works of the software and to permit third parties to whom the software is furnished to do so "
    "all subject to the following": "bsl-grant",
    **{f"this program and the accompanying materials are made available under the terms of the "
       f"eclipse public license {v}{e}": key
       for key, v, e in (("epl2-notice", "2.0", " which is available at https www.eclipse.org legal "
                          "epl 2.0"),
                         ("epl2-notice", "v2.0", " which accompanies this distribution and is "
                          "available at https www.eclipse.org legal epl v20.html"),
                         ("epl1-notice", "v1.0", " which accompanies this distribution and is "
                          "available at http www.eclipse.org legal epl v10.html"),
                         ("epl2-notice", "2.0", ""), ("epl1-notice", "v1.0", ""))},
    **{f"this work is licensed under a creative commons {n} 4.0 international license": key
       for n, key in (("attribution sharealike", "cc-by-sa"),
                      ("attribution noncommercial", "cc-by-nc"))},
    # Titles of full texts: a name, and the line with its version and date.
    "gnu general public license": "gpl-title", "gnu lesser general public license": "lgpl-title",
    "gnu affero general public license": "agpl-title",
    "version 3 29 june 2007": "gnu-june-2007", "version 3 19 november 2007": "gnu-november-2007",
    "version 2 june 1991": "gnu-june-1991", "version 2.1 february 1999": "gnu-february-1999",
    **{f"spdx license identifier {name.lower().replace('-', ' ')}{e}": f"spdx-{name.lower()}"
       for name in SPDX for e in ("", " only", " or later")},
    **{f"this {x} is free software": "gpl-free" for x in ("library", "file", "software")},
    **{f"{GNU_TERMS.format(k)} {GNU_FSF}": f"{g}-terms" for g, k in GNU.items()},
    **{GNU_LATER.format(v): f"gnu-v{v}-later" for v in ("2", "2.1", "3")},
    **{text: f"{g}{v}-terms" for g, versions in GNU_VERSIONS.items() for v in versions
       for terms in [GNU_TERMS.format(GNU[g])]
       for text in (f"{terms} {GNU_FSF} {GNU_LATER.format(v)}", f"{terms} version {v} {GNU_FSF}",
                    f"{terms} {GNU_FSF} version {v} of the license",
                    f"{terms} {GNU_FSF} version {v}")},
}
# The rules of these wordings, tried before ``RULES``. A BSD text
# opens with "All rights reserved", which makes nothing proprietary there.
HEADER_RULES = [
    ("BSD-3-Clause", ["reserved", "bsd-redistribution", "bsd-endorse"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-endorse"]),
    ("BSD-2-Clause", ["reserved", "bsd-redistribution"]),
    ("BSD", ["reserved", "bsd-notice"]),
    *((name, [f"{g}-terms", f"gnu-v{v}-later"]) for (g, v), name in GNU_LICENSES.items()),
    *((name, [f"{g}{v}-terms"]) for (g, v), name in GNU_LICENSES.items() if (g, v) != ("gpl", "3")),
    ("MPL-1.1", ["mpl11-notice"]),
    ("Apache-2.0 OR MIT", ["apache-or-mit"]),
    ("ISC", ["isc-grant"]), ("ISC", ["isc-notice"]), ("Unlicense", ["unlicense"]),
    ("BSL-1.0", ["bsl-grant"]), ("BSL-1.0", ["bsl-notice"]),
    ("EPL-2.0", ["epl2-notice"]), ("EPL-1.0", ["epl1-notice"]),
    ("GPL-3.0", ["gpl-title", "gnu-june-2007"]), ("GPL-2.0", ["gpl-title", "gnu-june-1991"]),
    ("LGPL-3.0", ["lgpl-title", "gnu-june-2007"]), ("LGPL-2.1", ["lgpl-title", "gnu-february-1999"]),
    ("AGPL-3.0", ["agpl-title", "gnu-november-2007"]),
    *((name, [f"spdx-{name.lower()}"]) for name in SPDX),
]
# The holder's name in the BSD endorsement, and marks of comments.
HOLDER = (r"neither\s+the\s+names?\s+of\s[^;:!?]+?\snor\s+the\s+names\s+of\s+(?:its|their|any)"
          r"\s+contributors\s+may\s+be\s+used\s")
ANY_HOLDER = ("neither the name of the copyright holder nor the names of its contributors "
              "may be used ")
# The tag's colon would end a sentence.
TAG = r"spdx-license-identifier[\x20\x09]*:[\x20\x09]*"
ANY_TAG = "spdx-license-identifier "
COMMENT = r"(?m)^[\x20\x09]*[/*#;%-]+"
# A document with a sentence of the fixed tables holds at least
# one of these words.
MARKS = ["licens", "software", "copyright", "permission", "permitted", "rights reserved",
         "redistribut"]
# Sentence ends (stops before white space or at the end, blank
# lines) and what normalising turns into a space.
SENTENCE_BREAK = r"[.!?;:]+[\x20\x09-\x0D]+|[.!?;:]+$|\x0A[\x20\x09\x0D]*\x0A"
NOISE = r"[^a-z0-9.]+"


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 sentences: dict[str, str] | None = None,
                 rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """One row per document: id, ``sentence_ids`` (identified sentences in
    order) and ``licenses`` (in rule order, each once).

    Only identified sentences leave the scan; the sentence and rule tables are
    fixed values, so nothing that is broadcast grows with the data.
    """
    wordings = HEADERS if sentences is None else {}
    marks = MARKS if sentences is None else []  # they say nothing of other sentences
    sentences = SENTENCES if sentences is None else sentences
    wordings = wordings | {v: k for k, v in sentences.items()}
    rules = HEADER_RULES + RULES if rules is None else rules
    spark = docs.sparkSession
    known = F.broadcast(spark.createDataFrame(list(wordings.items()),
                                              "norm string, sentence_id string"))
    body = F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    row = F.xxhash64("body")
    base = docs.select(F.col(f"`{id_col}`").alias("id"), body.alias("body")).withColumns({
        "row": row, "own": F.when(F.col("id").isNull(), row).otherwise(F.lit(0))})
    marked = F.lit(not marks)
    for m in marks:
        marked = marked | F.col("body").contains(m)
    # A holder's name may hold stops, so it goes before the text is cut.
    bare = F.regexp_replace(F.regexp_replace("body", COMMENT, ""), HOLDER, ANY_HOLDER)
    bare = F.regexp_replace(bare, TAG, ANY_TAG)
    # A sentence may run over several lines or fill one line of a run of lines
    # without stops, so a piece with line breaks counts whole and line by line.
    pieces = (base.filter(marked)
              .select("id", "own", "row", F.posexplode(
                  F.split(bare, SENTENCE_BREAK)).alias("pos", "piece"))
              .filter(F.length("piece") >= min(map(len, wordings))))
    parts = F.when(F.contains("piece", F.lit("\n")),
                   F.concat(F.array("piece"), F.split("piece", "\n"))).otherwise(F.array("piece"))
    pieces = pieces.select("id", "own", "row", "pos", F.posexplode(parts).alias("sub", "sentence"))
    norm = F.trim(F.regexp_replace("sentence", NOISE, " "))
    norm = F.regexp_replace(norm, r"\.+$", "")
    hits = (pieces.withColumn("norm", norm).join(known, "norm")
            .select("id", "own", "row", "pos", "sub", "sentence_id"))
    found = (hits.groupBy("id", "own").agg(F.sort_array(F.collect_set(
        F.struct("row", "pos", "sub", "sentence_id"))).alias("s"))
        .select("id", "own", "s", F.transform("s", lambda x: x.sentence_id).alias("sentence_ids")))
    # A piece that is one line counts once in the chain, though it is found
    # whole and as a line. A rule takes its identifiers out of the chain.
    once = F.filter("s", lambda x, i: (i == 0) | ~F.coalesce(
        (F.get("s", i - 1).row == x.row) & (F.get("s", i - 1).pos == x.pos)
        & (F.get("s", i - 1).sentence_id == x.sentence_id), F.lit(False)))
    chain = F.array_join(F.transform(once, lambda x: F.concat(F.lit("<"), x.sentence_id, F.lit(">"))),
                         "")
    state = F.struct(chain.alias("chain"), F.array().cast("array<string>").alias("names"))

    def apply(acc, rule):
        used = F.contains(acc.chain, rule.seq)
        return F.struct(F.replace(acc.chain, rule.seq, F.lit("|")).alias("chain"),
                        F.when(used, F.array_append(acc.names, rule["name"]))
                        .otherwise(acc.names).alias("names"))

    table = F.array(*[F.struct(F.lit(name).alias("name"),
                               F.lit("".join(f"<{x}>" for x in seq)).alias("seq"))
                      for name, seq in rules])
    found = found.select("id", "own", "sentence_ids", F.array_distinct(
        F.aggregate(table, state, apply, lambda acc: acc.names)).alias("licenses"))
    none = F.array().cast("array<string>")
    ids = base.select("id", "own").distinct()
    same = ids.id.eqNullSafe(found.id) & (ids.own == found.own)
    return (ids.join(found, same, "left")
            .select(ids.id.alias(id_col),
                    F.coalesce("sentence_ids", none).alias("sentence_ids"),
                    F.coalesce("licenses", none).alias("licenses")))
