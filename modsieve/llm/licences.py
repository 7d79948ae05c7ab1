"""Licence scans with DataFrame functions only.

Every line and paragraph of every file is a segment. Segments and licence statements are
sparse TF-IDF vectors; a segment names a licence when its cosine to one of the statements
reaches the threshold. Document frequencies of all terms are counted over all rows. A notice
of an unlisted licence is nearest to a statement without a name, or to its family's. Most segments never become vectors: by Cauchy and Schwarz a
segment without any of a statement's heaviest terms cannot reach the threshold, so only
segments with such a term are kept. That test loses nothing.

A file that is a licence file (by its name, or because its whole text is close to a
statement) licenses its directory. Files that name no licence themselves inherit from the
nearest ancestor directory that has one. Ancestors are looked up for different directories
only, so a directory with a third of all files is one row there.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modsieve.operators.drift import counted_rows
from modsieve.session import cut_lineage

# Names of well-known licences. A family without its version has a name of its own,
# so that an unlisted version is nearest to it and not to some other version.
NAMES = (
    ("MIT", "MIT License", "MIT"),
    ("ISC", "ISC License", "ISC"),
    ("0BSD", "Zero-Clause BSD License", "BSD Zero Clause License", "0BSD"),
    ("BSD", "BSD License", "BSD-style License"),
    ("BSD-2-Clause", "BSD 2-Clause License", "Simplified BSD License", "2-Clause BSD License", "BSD-2-Clause"),
    ("BSD-3-Clause", "BSD 3-Clause License", "New BSD License", "Modified BSD License", "Revised BSD License", "BSD-3-Clause"),
    ("BSD-4-Clause", "BSD 4-Clause License", "Original BSD License", "BSD-4-Clause"),
    ("Apache", "Apache License", "Apache License, Version", "Apache Software License, Version"),
    ("Apache-1.0", "Apache License, Version 1.0", "Apache-1.0"),
    ("Apache-1.1", "Apache License, Version 1.1", "Apache Software License, Version 1.1", "Apache-1.1"),
    ("Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0", "Apache Software License, Version 2.0", "Apache-2.0"),
    ("EPL", "Eclipse Public License", "Eclipse Public License, version"),
    ("EPL-1.0", "Eclipse Public License 1.0", "Eclipse Public License v1.0", "Eclipse Public License, version 1.0", "EPL-1.0"),
    ("EPL-2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, version 2.0", "EPL-2.0"),
    ("MPL", "Mozilla Public License", "Mozilla Public License, version"),
    ("MPL-1.1", "Mozilla Public License 1.1", "Mozilla Public License, version 1.1", "MPL-1.1"),
    ("MPL-2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL-2.0"),
    ("CDDL-1.0", "Common Development and Distribution License 1.0", "Common Development and Distribution License, version 1.0", "CDDL-1.0"),
    ("EUPL-1.2", "European Union Public Licence 1.2", "European Union Public License, version 1.2", "EUPL-1.2"),
    ("Artistic-2.0", "Artistic License 2.0", "Artistic License, version 2.0", "Artistic-2.0"),
    ("BSL-1.0", "Boost Software License 1.0", "Boost Software License, version 1.0", "BSL-1.0"),
    ("Zlib", "zlib License", "Zlib"),
    ("Unlicense", "Unlicense"),
    ("WTFPL", "Do What The Fuck You Want To Public License", "WTFPL"),
    ("OFL-1.1", "SIL Open Font License 1.1", "SIL Open Font License, version 1.1", "OFL-1.1"),
    ("PSF-2.0", "Python Software Foundation License, version 2", "PSF-2.0"),
    *(
        row
        for short, name, versions in (
            ("GPL", "GNU General Public License", ("1.0", "2.0", "3.0")),
            ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")),
            ("LGPL", "GNU Library General Public License", ("2.0",)),
            ("AGPL", "GNU Affero General Public License", ("3.0",)),
        )
        for row in (
            (short, name, f"{name}, version", f"GNU {short}"),
            *((
                f"{short}-{v}", f"{name} {v}", f"{name} v{v}", f"{name}, version {v}", f"{name} v{v.removesuffix('.0')}", f"{name}, version {v.removesuffix('.0')}",
                f"GNU {short} v{v.removesuffix('.0')}", f"GNU {short}, version {v.removesuffix('.0')}", f"{short}-{v}", f"{short}v{v.removesuffix('.0')}",
            ) for v in versions),
        )
    ),
    ("CC0-1.0", "CC0 1.0", "CC0 1.0 Universal", "CC0", "CC0-1.0"),
    *(
        row
        for short, name in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for row in (
            (f"CC-{short}", f"CC {short}", f"Creative Commons {name} License"),
            *((f"CC-{short}-{v}", f"CC {short} {v}", f"Creative Commons {name} {v} International License") for v in ("2.0", "2.5", "3.0", "4.0")),
        )
    ),
)
FORMS = ("{}", "Released under the {}.", "Licensed under the {}.", "This work is licensed under the {}.", "Distributed under the terms of the {}.", "License: {}")
SHORT_FORMS = ("Released under {}.", "Licensed under {}.", "This work is licensed under {}.", "License: {}", "SPDX-License-Identifier: {}")
# Notices without a licence name nothing: a notice of an unlisted licence is nearest to one of them.
NONE = ("License", "Software License", "Public License", "General Public License", "Public License, version", "License, version", "Creative Commons License")


def _free(program: str, which: str, name: str, version: str) -> str:
    return f"{program} is free software{which} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."


# Lines and paragraphs of notices and of full texts. Those that several licences share carry the family's name.
STATEMENTS = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2."),
    *(
        (f"{short}-{version if '.' in version else version + '.0'}", _free(program, ";", name, version))
        for short, name, versions in (("GPL", "General Public License", "2 3"), ("LGPL", "Lesser General Public License", "2.1 3"), ("LGPL", "Library General Public License", "2"), ("AGPL", "Affero General Public License", "3"))
        for version in versions.split()
        for program in ("This program", "This library")
    ),
    *((f"{short}-{v}", f"GNU {name} License Version {v.removesuffix('.0')}, {date}") for short, name, v, date in (
        ("GPL", "General Public", "2.0", "June 1991"), ("GPL", "General Public", "3.0", "29 June 2007"), ("LGPL", "Lesser General Public", "2.1", "February 1999"),
        ("LGPL", "Lesser General Public", "3.0", "29 June 2007"), ("AGPL", "Affero General Public", "3.0", "19 November 2007"))),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-4-Clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("GPL-3.0", "13. Use with the GNU Affero General Public License."),
    ("AGPL-3.0", "13. Remote Network Interaction; Use with the GNU General Public License."),
    ("LGPL-2.1", "as the successor of the GNU Library Public License, version 2, hence the version number 2.1."),
    ("LGPL-2.1", "as the successor of the GNU Library Public License, version 2, hence"),
    *((row[0], form.format(name)) for row in NAMES for name in row[1:] for form in (FORMS if "icen" in name else SHORT_FORMS)),
    *(("", form.format(name)) for name in NONE for form in FORMS),
    *(("", form.format("")) for form in SHORT_FORMS),
)
_TERM = r"[a-z0-9]+(?:\.[0-9]+)*"
_FILE_NAME = r"(?i)^(licen[cs]e|copying|unlicense)([._-].*)?$"


_EXPRESSION = r"(?i)spdx-license-identifier:.*\s(or|and)\s"
_DENIED = r"(?i)\b(not|never|no longer)\s+(\w+\s+){0,2}(licen[sc]ed|released|distributed|covered|available|governed)\s+(under|by)\b"
#: Terms whose frequency is known to the first, coarse test.
COMMON_TERMS = 5_000
#: Cosine from which a whole text counts as a licence's own text.
WHOLE = 0.95


def _alternatives(line: Column) -> Column:
    """The licences that an SPDX expression joins, each as an identifier line of its own."""
    names = F.split(F.regexp_extract(line, r"(?i)spdx-license-identifier:\s*(.*)", 1), r"(?i)\s+(?:or|and)\s+")
    plain = F.transform(names, lambda x: F.regexp_replace(F.regexp_replace(x, "[()]", " "), r"(?i)\s+with\s+.*$", ""))
    return F.transform(plain, lambda x: F.concat(F.lit("SPDX-License-Identifier: "), F.trim(x)))


def terms(text: Column) -> Column:
    """Lower-case terms of a text; version numbers stay whole."""
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))


def _literals(spark: SparkSession, rows: list[tuple], kind: str) -> DataFrame:
    """Fixed rows as a table, without Python on the executors."""
    names = [field.split(":")[0] for field in kind.split(",")]
    values = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(values), f"array<struct<{kind}>>")))


def weights(counts: dict[str, int], idf: dict[str, float]) -> dict[str, float]:
    """Unit TF-IDF vector of a statement."""
    raw = {t: n * idf[t] for t, n in counts.items()}
    norm = math.sqrt(sum(w * w for w in raw.values()))
    return {t: w / norm for t, w in raw.items()}


def needed_terms(vector: dict[str, float], threshold: float) -> set[str]:
    """Heaviest terms, until what is left of the vector is shorter than the threshold."""
    left, out = 1.0, set()
    for term, w in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
        if math.sqrt(max(left, 0)) < threshold - 1e-9:
            break
        out.add(term)
        left -= w * w
    return out


def frequent_terms(vectors: list[dict[str, float]], df: dict[str, int], most: float = 0.25) -> set[str]:
    """The most frequent terms, while no vector has more than this share of its square in them."""
    out: set[str] = set()
    held = [0.0] * len(vectors)
    for term in sorted(df, key=lambda t: (-df[t], t)):
        more = [h + v.get(term, 0.0) ** 2 for h, v in zip(held, vectors, strict=True)]
        if max(more, default=0.0) <= most:
            held = more
            out.add(term)
    return out


def scan_licences(
    files: DataFrame,
    *,
    path_col: str = "path",
    text_col: str = "text",
    statements: tuple[tuple[str, str], ...] = STATEMENTS,
    threshold: float = 0.75,
) -> DataFrame:
    """One row per path: ``path, licences, score, origin, licence_dir``.

    ``licences`` holds every licence that one of the file's segments names, sorted; without
    any, those of the nearest ancestor directory with a licence file. ``origin`` is ``file``
    (it is a licence file itself: by its name, or because its whole text is a statement or next to it), ``header``,
    ``inherited`` or ``none``. A segment names the licence of its best statement, ties all; a statement with
    an empty name names nothing, nor does a segment that says it is not licensed under something. An SPDX
    expression names all its licences. Null and empty texts name nothing but inherit.
    A null path is one group without ancestors. Rows with the same path are one file with all
    their segments. Other columns are ignored.
    """
    spark = files.sparkSession
    base = files.select(F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    count = [Counter(_python_terms(text)) for _, text in statements]
    vocabulary = sorted(set().union(*count))

    # Document frequencies of all terms: each row gives each of its terms once, combined where it is read.
    seen = base.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).groupBy("term").count()
    # Terms of one row only are left out of the stored table.
    seen = cut_lineage(seen.where("count > 1"))
    total = base.count()
    df = {r["term"]: r["count"] for r in seen.where(F.col("term").isin(vocabulary)).collect()}  # at most one row per statement term
    idf = {t: math.log((1 + total) / (1 + df.get(t, 1))) + 1 for t in vocabulary}
    vectors = [weights(c, idf) for c in count]
    needed = sorted(set().union(*(needed_terms(v, threshold) for v, (name, _) in zip(vectors, statements, strict=True) if name)))

    # Segments that can reach the threshold at all; stored, since most of the work is to find them.
    def telling(text: Column) -> Column:
        return F.arrays_overlap(terms(text), F.array(*[F.lit(t) for t in needed]))

    lines = F.split("text", r"\r?\n")
    blocks = F.transform(F.split("text", r"\r?\n[ \t]*\r?\n"), lambda b: F.regexp_replace(b, r"\s+", " "))
    held = base.where(telling(F.col("text")))
    # An SPDX expression is one segment for each of its licences.
    each = F.flatten(F.transform(F.concat(lines, blocks), lambda x: F.when(x.rlike(_EXPRESSION), _alternatives(x)).otherwise(F.array(x))))
    pieces = held.select("path", F.explode_outer(F.array_distinct(each)).alias("segment"))
    pieces = pieces.where(telling(F.col("segment")) & ~F.col("segment").rlike(_DENIED))
    segments = pieces.select("path", F.md5("segment").alias("seg"), "segment").groupBy("path", "seg").agg(F.first("segment").alias("segment"))
    segments = cut_lineage(segments)

    rare = math.log((1 + total) / 2) + 1
    flat = [(i, statements[i][0], t, w) for i, v in enumerate(vectors) for t, w in v.items()]
    known = _literals(spark, flat, "statement:int,licence:string,term:string,w:double")
    # Equal segments are one vector, however many files carry them.
    unique = segments.groupBy("seg").agg(F.first("segment").alias("segment"))

    def counted(rows: DataFrame) -> DataFrame:
        return counted_rows(rows.select("seg", terms(F.col("segment")).alias("all")), ["seg"], "all", count="n")

    # Long texts around a notice go before they meet all frequencies: with a statement's square r in
    # frequent terms, the cosine is at most sqrt(r) + sqrt(1 - r) * (length in the others) / (least length).
    # The most frequent terms of the corpus weigh what they weigh, all others at least as much as the last
    # of these. This loses nothing either.
    often = frequent_terms(vectors, df)
    shares = [sum(w * w for t, w in v.items() if t in often) for v in vectors]
    least = min((max(threshold - math.sqrt(r), 0) / math.sqrt(max(1 - r, 1e-9)) for r in shares), default=0.0)
    common = {r["term"]: r["count"] for r in seen.orderBy(F.desc("count"), "term").limit(COMMON_TERMS).collect()}
    floor = math.log((1 + total) / (1 + min(common.values()))) + 1 if len(common) == COMMON_TERMS else rare
    floor = min(floor, rare) * (1 - 1e-9)
    told = {**{t: math.log((1 + total) / (1 + n)) + 1 for t, n in common.items()}, **idf}
    own = _literals(spark, [(t, w, t in idf and t not in often) for t, w in told.items()], "term:string,idf:double,telling:boolean")
    bag = counted(unique)
    x2 = F.pow(F.col("n") * F.coalesce("idf", F.lit(floor)), F.lit(2))
    sizes = bag.join(F.broadcast(own), "term", "left").groupBy("seg").agg(
        F.sum(x2).alias("all"), F.sum(F.when(F.col("telling"), x2).otherwise(0.0)).alias("some")
    )
    near = sizes.where(F.col("some") >= F.col("all") * (least * least * (1 - 1e-6))).select("seg", "all")
    # The product with a statement is known, the length is at least that.
    own = _literals(spark, [(t, idf[t]) for t in vocabulary], "term:string,idf:double")
    reached = bag.join(F.broadcast(known.join(own, "term")), "term").groupBy("seg", "statement").agg(F.sum(F.col("n") * F.col("idf") * F.col("w")).alias("dot"))
    reached = reached.groupBy("seg").agg(F.max("dot").alias("dot"))
    near = near.join(reached, "seg").where(F.col("dot") >= F.sqrt("all") * (threshold * (1 - 1e-6))).select("seg")
    near = cut_lineage(unique.join(near, "seg"))

    idfs = seen.select("term", (F.log((1 + total) / (1 + F.col("count"))) + 1).alias("idf"))
    tf = counted(near).join(idfs, "term", "left").withColumn("x", F.col("n") * F.coalesce("idf", F.lit(rare))).select("seg", "term", "x")
    norm = tf.groupBy("seg").agg(F.sqrt(F.sum(F.round(F.col("x") * F.col("x"), 9).cast("decimal(28,9)")).cast("double")).alias("norm"))
    dots = tf.join(F.broadcast(known), "term").groupBy("seg", "statement", "licence").agg(
        F.sum(F.round(F.col("x") * F.col("w"), 9).cast("decimal(28,9)")).cast("double").alias("dot")
    )
    scored = dots.join(norm, "seg").select("seg", "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("cos"))
    scored = scored.where(F.col("cos") >= threshold).groupBy("seg", "licence").agg(F.max("cos").alias("cos"))
    best = scored.groupBy("seg").agg(F.max("cos").alias("best"))
    scored = cut_lineage(scored.join(best, "seg").where("cos = best and licence <> ''").select("seg", "licence", "cos"))

    named = segments.select("path", "seg").join(scored, "seg")
    named = named.groupBy("path").agg(F.array_sort(F.collect_set("licence")).alias("licences"), F.max("cos").alias("score"))
    # A family's name says nothing more where one of its versions is named.
    family = F.transform("licences", lambda x: F.regexp_replace(x, "-[0-9].*$", ""))
    versioned = F.transform(F.filter(F.arrays_zip("licences", family.alias("family")), lambda z: z["licences"] != z["family"]), lambda z: z["family"])
    named = named.withColumn("licences", F.array_except("licences", versioned))
    named = named.withColumnRenamed("path", "named_path")
    whole = F.md5(F.regexp_replace("text", r"\s+", " "))
    paths = base.select("path", whole.alias("seg"))
    # The whole text is one of the segments if it is a single block.
    alike = scored.where(F.col("cos") >= WHOLE).select(F.col("seg").alias("alike")).distinct()
    paths = paths.join(alike, F.col("seg") == F.col("alike"), "left")
    paths = paths.groupBy("path").agg(F.max(F.col("alike").isNotNull()).alias("whole"))
    tail = F.element_at(F.split("path", "/"), -1)
    by_name = F.coalesce(tail.rlike(_FILE_NAME), F.lit(False))
    slash = F.length("path") - F.length(F.substring_index("path", "/", -1)) - 1
    directory = F.when(slash >= 0, F.substring(F.col("path"), F.lit(1), slash)).when(F.col("path").isNotNull(), F.lit(""))
    own = paths.join(named, F.col("path").eqNullSafe(F.col("named_path")), "left").select(
        "path", "licences", "score", directory.alias("dir"),
        (F.col("licences").isNotNull() & (by_name | F.col("whole"))).alias("is_file"),
    )
    own = cut_lineage(own)

    granted = own.where("is_file and dir is not null").select("dir", F.explode("licences").alias("licence"))
    granted = granted.groupBy(F.col("dir").alias("granting")).agg(F.array_sort(F.collect_set("licence")).alias("granted"))
    pieces = F.split("dir", "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(pieces)), lambda i: F.array_join(F.slice(pieces, F.lit(1), i), "/"))
    chain = own.where("licences is null and dir is not null").select("dir").distinct()
    chain = chain.select("dir", F.explode(F.array_distinct(ups)).alias("up"))
    met = chain.join(granted, F.col("up") == F.col("granting"))
    nearest = met.groupBy(F.col("dir").alias("heir")).agg(
        F.max(F.struct(F.length("up").alias("depth"), F.col("up"), F.col("granted"))).alias("near")
    )
    out = own.join(nearest, F.col("dir") == F.col("heir"), "left")
    inherits = F.col("licences").isNull() & F.col("near").isNotNull()
    return out.select(
        F.col("path").alias(path_col),
        F.coalesce("licences", "near.granted", F.expr("cast(array() as array<string>)")).alias("licences"),
        F.col("score"),
        F.when(F.col("is_file"), "file").when(F.col("licences").isNotNull(), "header").when(inherits, "inherited").otherwise("none").alias("origin"),
        F.when(inherits, F.col("near.up")).alias("licence_dir"),
    )


def _python_terms(text: str) -> list[str]:
    return re.findall(_TERM, text.lower())
