"""License scan in DataFrame functions only: sparse TF-IDF cosine to templates, then inheritance.

Lines and blocks of up to three lines (headers, notices) and whole files are compared with notices and
full license texts as sparse TF-IDF vectors. A name is given only where the words that tell the family
and the version are there and those of its relatives are not. A file without a license of its own
inherits from the nearest ancestor directory that has a license file, by joins on the ancestor paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajtable.llm.common import table, written

THRESHOLD = 0.6
GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation"
GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: fixed values: public notices and full texts as (license, words it must have, words it must not have, text)
TEMPLATES = [
    ("Apache-2.0", "apache license 2", "", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "compliance license file except", "gnu mozilla", "you may not use this file except in compliance with the License"),
    ("Apache-2.0", "apache license 2 compliance", "", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "apache 2 spdx", "", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "mit license", "", "Released under the MIT License."),
    ("MIT", "granted charge person obtaining", "", GRANT),
    ("MIT", "granted charge obtaining sublicense", "", GRANT + """ (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("MIT", "mit spdx", "", "SPDX-License-Identifier: MIT"),
    ("ISC", "isc license", "", "Released under the ISC License."),
    ("ISC", "permission copy fee granted", "sublicense", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "permission fee granted disclaims", "sublicense", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("ISC", "isc spdx", "", "SPDX-License-Identifier: ISC"),
    ("GPL-3.0", "gnu general public 3", "lesser affero library 2", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "gnu general public 3", "lesser affero library 2", GPL.format("General Public License") + ", either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "gpl 3 spdx", "", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "gnu general public 2", "lesser affero library 3", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "gnu general public 2", "lesser affero library 3", GPL.format("General Public License") + "; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "gpl 2 spdx", "", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL", "gnu general public", "lesser affero library 2 3", GPL.format("General Public License")),
    ("GPL", "gnu general public", "lesser affero library 2 3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("LGPL-3.0", "gnu lesser general public 3", "affero", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "gnu lesser general public 3", "affero", GPL.format("Lesser General Public License") + ", either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "lgpl 3 spdx", "", "SPDX-License-Identifier: LGPL-3.0"),
    ("LGPL-2.1", "gnu lesser general public 2 1", "affero", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "gnu lesser general public 2 1", "affero", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "lgpl 2 1 spdx", "", "SPDX-License-Identifier: LGPL-2.1"),
    ("LGPL", "gnu lesser general public", "affero 2 3", GPL.format("Lesser General Public License")),
    ("AGPL-3.0", "gnu affero general public 3", "lesser", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "gnu affero general public 3", "lesser", GPL.format("Affero General Public License") + ", either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "agpl 3 spdx", "", "SPDX-License-Identifier: AGPL-3.0"),
    ("AGPL", "gnu affero general public", "lesser 3", GPL.format("Affero General Public License")),
    ("BSD-3-Clause", "redistribution source binary forms", "reproduce neither", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "redistribution binary forms neither endorse", "", BSD.format("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n")),
    ("BSD-3-Clause", "bsd 3 clause spdx", "", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "bsd 3 clause", "", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "redistribution binary forms reproduce", "neither endorse", BSD.format("")),
    ("BSD-2-Clause", "bsd 2 clause spdx", "", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-2-Clause", "bsd 2 clause", "", "Licensed under the BSD 2-Clause License."),
    ("Unlicense", "unencumbered public domain", "", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "unencumbered domain relinquishment", "", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Unlicense", "unlicense spdx", "", "SPDX-License-Identifier: Unlicense"),
    ("MPL-2.0", "mozilla public 2", "", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "mozilla public 2", "", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "mpl 2 spdx", "", "SPDX-License-Identifier: MPL-2.0"),
    ("EPL-2.0", "eclipse public 2", "", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-2.0", "epl 2 spdx", "", "SPDX-License-Identifier: EPL-2.0"),
    ("CC-BY-NC-4.0", "cc by nc 4", "", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "creative attribution noncommercial 4", "", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "cc by 4", "nc sa nd", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "creative attribution 4", "noncommercial sharealike noderivatives noderivs", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "extent waived copyright", "", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0-1.0", "cc0 spdx", "", "SPDX-License-Identifier: CC0-1.0"),
    ("proprietary", "rights reserved", "redistribution", "All rights reserved."),
    ("proprietary", "rights reserved confidential proprietary", "", "Copyright. All rights reserved. Confidential and proprietary."),
]
WORD = re.compile("[a-z0-9]+")
SPLIT = "[^a-z0-9]+"
BLOCKS = ((0, 1), (0, 2), (0, 3), (-1, 2), (-1, 3), (-2, 3))  # a line, and the lines it is joined with: (from, number)


def template_terms() -> list[Counter]:
    return [Counter(WORD.findall(text.lower())) for _, _, _, text in TEMPLATES]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")


def document_frequencies(files: DataFrame, text: str) -> DataFrame:
    """(w, d): the files of the whole table that hold each word; the empty word counts the files."""
    held = F.array_distinct(words(F.coalesce(F.col(text), F.lit(""))))
    every = files.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("w"))
    return written(every.groupBy("w").agg(F.count(F.lit(1)).alias("d")))


def weights(df: DataFrame) -> tuple[int, dict[str, float]]:
    """Files in all, and the idf of each template term; one that no file holds counts as held by one."""
    vocabulary = {w for terms in template_terms() for w in terms}
    found = {r.w: r.d for r in df.where(F.col("w").isin("", *vocabulary)).collect()}  # the vocabulary at most
    n = found.get("", 0)
    return n, {w: math.log((n + 1) / (max(1, found.get(w, 0)) + 0.5)) + 0.1 for w in vocabulary}


def needed_terms(idf: dict[str, float]) -> list[str]:
    """Terms of which a text must hold one to match any template: of the words each must have, the rarest."""
    return sorted({max(must.split(), key=lambda w: (idf[w], w)) for _, must, _, _ in TEMPLATES})


def scored(texts: DataFrame, df: DataFrame, n: int, idf: dict[str, float]) -> DataFrame:
    """Best (license, cosine) of rows (id, t): only rows that reach THRESHOLD and have the template's words.

    Every word weighs by the files that hold it. A common word is in most texts: the join with the
    frequencies is between shuffled tables, so its skewed parts are split.
    """
    spark = texts.sparkSession
    rows = []
    for k, (terms, (name, must, banned, _)) in enumerate(zip(template_terms(), TEMPLATES)):
        norm = sum((c * idf[w]) ** 2 for w, c in terms.items()) ** 0.5
        must = must.split()
        rows += [(w, name, k, c * idf[w] ** 2 / norm, int(w in must), 0, len(must)) for w, c in terms.items()]
        rows += [(w, name, k, 0.0, 0, 1, len(must)) for w in banned.split() if w not in terms]
    postings = spark.createDataFrame(rows, "w string, license string, k int, weight double, must int, banned int, n_must int")
    terms = texts.select("id", F.explode(words(F.col("t"))).alias("w")).groupBy("id", "w").agg(F.count(F.lit(1)).alias("tf"))
    x = F.col("tf") * (F.log(F.lit(n + 1.0) / (F.col("d") + 0.5)) + 0.1)
    norms = terms.join(df, "w").groupBy("id").agg(F.sqrt(F.sum(x * x)).alias("norm"))
    # templates are fixed values of this module: the table has about two thousand rows
    dots = terms.join(F.broadcast(postings), "w").groupBy("id", "license", "k").agg(
        F.sum(F.col("tf") * F.col("weight")).alias("dot"), (F.sum("must") - F.max("n_must")).alias("missing"), F.sum("banned").alias("banned")
    )
    dots = dots.where("missing = 0 and banned = 0")
    cosine = F.round(F.col("dot") / F.col("norm"), 6)
    best = dots.join(norms, "id").select("id", "license", cosine.alias("cosine")).where(F.col("cosine") >= THRESHOLD)
    return best.groupBy("id").agg(F.max(F.struct("cosine", "license")).alias("b")).select("id", "b.license", "b.cosine")


def own_licenses(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, license, cosine, whole, line_no) for each path with a license of its own, the best match.

    ``whole`` says that the file as a whole matches; else ``line_no`` (from 0) is the line at which the match begins.
    Rows with one path are one file of several texts.
    """
    df = document_frequencies(files, text)
    n, idf = weights(df)
    term = r"(?i)(?:^|[^a-z0-9])(?:" + "|".join(needed_terms(idf)) + r")(?:[^a-z0-9]|$)"
    some = files.select(F.col(path).alias("path"), F.col(text).alias("t")).where(F.col("path").isNotNull() & F.col("t").rlike(term))
    some = some.withColumn("h", F.xxhash64("t"))  # several texts of one path are matched one by one
    lines = some.select("path", "h", F.split("t", r"\r?\n", -1).alias("l"))
    lines = lines.select("path", "h", "l", F.posexplode("l").alias("line_no", "line")).where(F.col("line").rlike(term))
    # the line alone, and with its neighbours where there are any
    reach = [
        F.when((F.col("line_no") >= -a) & (F.col("line_no") + a + k <= F.size("l")),
               F.struct((F.col("line_no") + a).alias("line_no"), F.lit(k).alias("lines"), F.array_join(F.slice("l", F.col("line_no") + a + 1, F.lit(k)), "\n").alias("t")))
        for a, k in BLOCKS
    ]
    blocks = lines.select("path", "h", F.explode(F.array_compact(F.array(*reach))).alias("b"))
    spot = lambda whole, line_no, k: F.struct("path", F.lit(whole).alias("whole"), line_no.cast("int").alias("line_no"), k.alias("lines"), "h").alias("id")
    parts = written(
        # equal rows count their words twice, which leaves the cosine as it is
        blocks.select(spot(False, F.col("b.line_no"), F.col("b.lines")), "b.t").union(some.select(spot(True, F.lit(-1), F.lit(0)), "t"))
    )
    found = scored(parts, df, n, idf)
    # a name with its version before that of the family alone
    told = (~F.col("license").isin("GPL", "LGPL", "AGPL")).alias("told")
    best = F.max(F.struct(told, "cosine", F.col("id.whole").alias("whole"), (-F.col("id.line_no")).alias("up"), "license"))
    return found.groupBy(F.col("id.path").alias("path")).agg(best.alias("b")).select(
        "path", "b.license", "b.cosine", "b.whole", (-F.col("b.up")).alias("line_no")
    )


def scan(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """path, license, cosine, own, inherited_from: one row per row of ``files``.

    A file's own license comes first; else that of the nearest ancestor directory that has a license
    file: a file named LICENSE, LICENCE, COPYING or NOTICE (any ending), or one that as a whole
    or in its first line is a license text. Of several in a directory the highest cosine counts, then
    the least path. Without any the license is null. A null path names no file and has
    no license; null and empty texts have no license of their own; equal rows get equal results; an empty table
    gives an empty result; other columns are not read.
    """
    own = written(own_licenses(files, path, text))
    parent = lambda c: F.when(c.contains("/"), F.regexp_replace(c, "/[^/]*$", "")).otherwise(F.when(c != "", F.lit("")))
    named = F.col("path").rlike(r"(?i)(?:^|/)(?:licen[sc]e|copying|notice)(?:\.[^/]*)?$")
    homes = own.where(named | F.col("whole") | (F.col("line_no") == 0))
    by_dir = homes.groupBy(parent(F.col("path")).alias("dir")).agg(F.min(F.struct(-F.col("cosine"), F.col("path"), F.col("license"))).alias("d"))
    by_dir = written(by_dir.select("dir", F.col("d.license").alias("dir_license"), F.col("d.path").alias("from")))
    # directories, not files, are walked up: each distinct one meets its ancestors once
    places = files.select(F.col(path).alias("path")).withColumn("dir", parent(F.col("path")))
    dirs = places.select("dir").where("dir IS NOT NULL").distinct()
    depth = F.size(F.split("dir", "/"))
    up = F.concat(
        F.transform(F.sequence(F.lit(0), depth - 1), lambda i: F.struct(i.alias("steps"), F.call_function("substring_index", F.col("dir"), F.lit("/"), depth - i).alias("up"))),
        F.array(F.struct(depth.alias("steps"), F.lit("").alias("up"))),
    )
    reach = dirs.select("dir", F.explode(up).alias("u")).select("dir", "u.steps", F.col("u.up").alias("up"))
    near = reach.join(by_dir.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(F.min(F.struct("steps", "dir_license", "from")).alias("n"))
    near = written(near.select("dir", "n.dir_license", "n.from"))
    # a directory may hold a third of all files: the join is skew-split, both sides are shuffled for it alone
    out = places.join(own.withColumn("own", F.lit(True)), "path", "left").join(near, "dir", "left")
    mine = F.coalesce("own", F.lit(False))
    return out.select(
        "path",
        F.coalesce("license", "dir_license").alias("license"),
        "cosine",
        mine.alias("own"),
        F.when(~mine, F.col("from")).alias("inherited_from"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``<source>/<lang>/<doc_id>``."""
    docs = table(spark, sf_dir, "documents")
    part = lambda c: F.coalesce(F.regexp_replace(F.col(c), "/", "_"), F.lit("unknown"))
    path = F.concat_ws("/", part("source"), part("lang"), F.col("doc_id").cast("string"))
    found = scan(docs.select(path.alias("path"), "text"))
    return found.select(F.element_at(F.split("path", "/"), 3).cast("bigint").alias("doc_id"), "path", "license", "cosine", "own", "inherited_from")
