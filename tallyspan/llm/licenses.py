"""Licence scan by a positional index of rare licence words.

Templates are base phrases, further names of licences, and texts of licences:
their notices and grants, word by word. Every text is split into words once; what
is kept of it are the places of licence words (content words of the templates).
From these postings, over all documents:

1. Document frequencies give each licence word its IDF, and each template its
   anchor: the rarest word of its key phrase.
2. A file's postings of anchors are looked up in the index of templates; each
   gives a candidate, a template at a place relative to the anchor. Only postings
   of files with candidates are read on.
3. Postings of all of a template's words are intersected with its candidates by
   position, and the share of the template's IDF mass that agrees is the
   candidate's coverage.
4. The key phrase is verified word by word. A candidate with a verified phrase
   and enough coverage is a place of its template; a base phrase is all key.

A phrase has all of its words, its anchor among them, so no place is missed. The
vocabulary and the templates are fixed, so what is broadcast is too. DataFrame
functions only.

Edge cases. Null or empty text: no words, no places, score 0. Repeated rows:
each is scanned. Phrases may overlap; each place counts. Ties of rarest words:
the first of the phrase. Of several candidates the best coverage is the score. Null doc_id: kept. No
rows: no rows. Long texts: whole. Other columns are ignored.
"""

from __future__ import annotations

from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import shipped, written

#: Base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Names of licences, (text, key phrase in it, label).
FURTHER = (
    ("gnu lesser general public license", "gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "gnu affero general public license", "agpl"),
    ("licensed under the gnu general public license version", "gnu general public license", "gpl"),
    ("licensed under the apache license version 2 0", "apache license", "apache"),
    ("released under the mit license", "mit license", "mit"),
    ("licensed under cc by", "cc by", "cc-by"),
    ("cc by nc", "cc by nc", "cc-by-nc"),
    ("cc by sa", "cc by sa", "cc-by-sa"),
    ("cc by nd", "cc by nd", "cc-by-nd"),
    ("creative commons attribution", "creative commons attribution", "cc-by"),
    ("mozilla public license", "mozilla public license", "mpl"),
    ("eclipse public license", "eclipse public license", "epl"),
    ("boost software license", "boost software license", "bsl"),
)
#: Words of licence texts, (text, key phrase in it, label).
TEXTS = (
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without"
        " restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the"
        " software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of"
        " the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular"
        " purpose and noninfringement",
        "permission is hereby granted free of charge", "mit",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must"
        " retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of"
        " conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        "redistribution and use in source and binary forms", "bsd",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission"
        " notice appear in all copies",
        "fee is hereby granted", "isc",
    ),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache"
        " org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or"
        " conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
        "apache license version 2 0", "apache",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either"
        " version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied"
        " warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
        "redistribute it and or modify it under the terms of the gnu general public license", "gpl",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl",
        "subject to the terms of the mozilla public license", "mpl",
    ),
    (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form"
        " or as a compiled binary for any purpose commercial or non commercial and by any means",
        "unencumbered software released into the public domain", "unlicense",
    ),
    (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission"
        " is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
        "permission is granted to anyone to use this software", "zlib",
    ),
    (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use"
        " reproduce display distribute execute and transmit the software and to prepare derivative works of the software",
        "organization obtaining a copy of the software and accompanying documentation", "bsl",
    ),
)
#: Words of templates that are too common to index.
COMMON = frozenset(
    "a above all an and any anyone appear are as at authors be being both but by can code copies copy do either even event except file files following for form free from held"
    " hope http if in including into is it kind later law list may more must no non not notice of on one option or org other out particular person persons portions see sell shall so"
    " terms that the this to under use useful v was whom will with without works writing www you your 0 2 3".split()
)
#: All that is not a word: ASCII but letters and digits.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTEXT = 16


def _templates() -> list[tuple[int, str, bool, str, str, int, bool]]:
    """(template, label, base, phrase, word, place relative to the phrase, in phrase)."""
    rows = []
    for no, (text, phrase, label, base) in enumerate([(p, p, x, True) for p, x in BASE] + [(*t, False) for t in FURTHER + TEXTS]):
        words, key = text.split(), phrase.split()
        start = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        assert key[0] not in COMMON and len(key) <= CONTEXT
        indexed = [(i, w) for i, w in enumerate(words) if w not in COMMON]
        rows += [(no, label, base, phrase, w, i - start, start <= i < start + len(key)) for i, w in indexed]
    return rows


def weighted(df: dict[str, int], total: int) -> list[tuple]:
    """Rows of the index with idf, whether the word is the template's anchor, and
    the template's IDF mass; df: documents by word, of total documents."""
    idf = lambda word: log((total + 1) / (df.get(word, 0) + 0.5))
    by: dict[int, list[tuple]] = {}
    for row in _templates():
        by.setdefault(row[0], []).append(row)
    out = []
    for rows in by.values():
        anchor = min((r for r in rows if r[6]), key=lambda r: (-idf(r[4]), r[5]))
        out += [(*r, idf(r[4]), r is anchor, sum(idf(x[4]) for x in rows)) for r in rows]
    return out


@shipped
def scan(docs: DataFrame, *, least_coverage: float = 0.5) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score) for each row of docs (doc_id, text)."""
    spark = docs.sparkSession
    known = sorted({r[4] for r in _templates()})
    begins = sorted({r[4] for r in _templates() if r[5] == 0})

    # lower() differs from ASCII's only where no word of the vocabulary is met
    # (the Kelvin sign gives a k, and the vocabulary has none).
    assert not any("k" in w for w in known)
    words = F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), GAPS), "")
    split = docs.select("doc_id", words.alias("words"))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).isin(known))
    here = lambda i: F.when(F.get("words", i).isin(begins), F.array_join(F.slice("words", i + 1, CONTEXT), " "))
    hits = F.transform(at, lambda i: F.struct(i.alias("pos"), F.get("words", i).alias("word"), here(i).alias("here")))
    some = F.arrays_overlap("words", F.array(*[F.lit(w) for w in known]))
    kept = split.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.size("words").cast("long").alias("n_words"), F.when((F.size("words") > 0) & some, hits).alias("hits"))
    files = written(kept, "licence-postings")

    often = files.where("hits is not null").select("uid", F.inline("hits")).select("uid", "word").distinct().groupBy("word").agg(F.count("*").alias("df"))
    # As many rows as the fixed vocabulary has words at most.
    lookup = weighted({r["word"]: r["df"] for r in often.collect()}, files.count())
    index = spark.createDataFrame(lookup, "template int, label string, base boolean, phrase string, word string, rel int, key boolean, idf double, anchor boolean, total double")
    anchors = sorted({r[4] for r in lookup if r[8]})

    postings = files.where(F.exists("hits", lambda h: h["word"].isin(anchors))).select("uid", F.inline("hits"))
    place = (F.col("pos") - F.col("rel")).alias("place")
    candidates = postings.join(F.broadcast(index.where("anchor").select("template", "word", "rel")), "word").select("uid", "template", place).distinct()
    met = postings.join(F.broadcast(index), "word").withColumn("place", place).join(candidates, ["uid", "template", "place"])
    verified = F.col("rel").eqNullSafe(0) & F.startswith(F.concat("here", F.lit(" ")), F.concat("phrase", F.lit(" ")))
    places = (
        met.groupBy("uid", "template", "place")
        .agg(F.first("label").alias("label"), F.first("base").alias("base"), F.bool_or(verified).alias("verified"), (F.sum("idf") / F.first("total")).alias("coverage"))
        .where(F.col("verified") & (F.col("base") | (F.col("coverage") >= least_coverage)))
    )
    own = F.when(F.col("base"), F.col("place"))
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = places.groupBy("uid").agg(
        F.count(own).alias("n_base"), F.min(own).cast("long").alias("first_word"), F.max(own).cast("long").alias("last_word"),
        names(F.when(F.col("base"), F.col("label"))).alias("base_labels"), names("label").alias("labels"), F.least(F.lit(1.0), F.max("coverage")).alias("score"),
    )
    none = F.lit("")
    return files.drop("hits").join(found, "uid", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
