"""License notices by diagonal voting, in DataFrame functions alone.

All rolling word k-gram hashes of a text are joined to the positions of the same k-grams in known
notices, and are counted only if their words are the notice's. A place in a text minus the place in the
notice is a diagonal; k-grams of one occurrence vote for one diagonal, or for neighbouring ones where words
were added or left out. A diagonal that covers enough of a notice's k-grams is a place of it. Of the others
those that lie within a few words of one another are merged, and a merged group is a place if it covers
enough of the notice, each of whose places counts once however often the text repeats it, within a span not
much longer than the notice. Exact phrases are found by the same votes: on one diagonal, all k-grams of the
phrase.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower

K = 3
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Exact phrases and their labels.
PHRASES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
# Notices as license texts have them, in lower case without signs.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "this project is licensed under the terms of the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-3", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("gpl-2", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license"),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "use of this source code is governed by a bsd style license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl-3", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl-3", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
)
COVER, STRETCH, NEAR = 0.7, 1.5, 3


def positions() -> list[tuple]:
    """(template, label, exact, words, grams, place, its k words) of every k-gram of the phrases and notices."""
    rows = []
    for t, (label, text) in enumerate(PHRASES + NOTICES):
        w = text.split()
        rows += [(t, label, t < len(PHRASES), len(w), len(w) - K + 1, p, *w[p : p + K]) for p in range(len(w) - K + 1)]
    return rows


def gram_hash(words: tuple[str, ...]) -> int:
    """Spark's xxhash64 of these words: each one's hash is the next one's seed."""
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), h)
    return h - (1 << 64) if h >> 63 else h


def scan(docs: DataFrame, cover: float = COVER, stretch: float = STRETCH, near: int = NEAR) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans: a row per row of docs.

    spans: label, start and end in words and cover of every place, exact ones with cover 1. Null and
    empty texts have no words and no places; labels are then empty and the score is 0. Repeated rows and null
    ids are rows of their own; other columns are not read. Only k-grams that a template has are kept beyond the scan, so shuffles hold hits and one
    row per document. The template table is a fixed list.
    """
    spark = docs.sparkSession
    rows = [(*r, gram_hash(r[-K:])) for r in positions()]
    known = spark.createDataFrame(rows, "template int, label string, exact boolean, t_words int, t_grams int, place int, k0 string, k1 string, k2 string, h long")
    hashes = sorted({r[-1] for r in rows})
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.regexp_extract_all(ascii_lower(F.col("text").cast("string")), F.lit(WORD), F.lit(0)).alias("w"))
    n = F.size("w")
    rolling = F.transform(F.sequence(F.lit(0), F.greatest(n - K, F.lit(0))), lambda i: F.struct(i.alias("at"), F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h")))
    voting = F.transform(F.filter(rolling, lambda g: g.h.isin(hashes)), lambda g: F.struct(g.at.alias("at"), g.h.alias("h"), *[F.get("w", g.at + i).alias(f"w{i}") for i in range(K)]))
    met = words.select("row", "doc_id", n.cast("long").alias("n_words"), F.explode_outer(voting).alias("g")).select("row", "doc_id", "n_words", "g.*")
    same_words = (F.col("w0") == F.col("k0")) & (F.col("w1") == F.col("k1")) & (F.col("w2") == F.col("k2"))
    met = met.join(F.broadcast(known.withColumnRenamed("h", "known")), (F.col("h") == F.col("known")) & same_words, "left")
    same = ["row", "doc_id", "n_words", "template", "label", "exact", "t_words", "t_grams"]
    diagonals = met.withColumn("diagonal", F.col("at") - F.col("place")).groupBy(*same, "diagonal").agg(F.collect_list("place").alias("places"), F.min("at").alias("start"), (F.max("at") + K).alias("end"))
    in_order = Window.partitionBy("row", "template").orderBy("diagonal")
    diagonals = diagonals.withColumn("alone", F.col("exact") | (F.size("places") / F.col("t_grams") >= cover))
    apart = F.col("alone") | F.lag("alone").over(in_order) | (F.col("diagonal") - F.lag("diagonal").over(in_order) > near)
    merged = diagonals.withColumn("g", F.sum(F.coalesce(apart.cast("int"), F.lit(1))).over(in_order))
    merged = merged.groupBy(*same, "g").agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("votes"), F.min("start").alias("start"), F.max("end").alias("end"))
    covered = F.col("votes") / F.col("t_grams")
    good = F.when(F.col("exact"), F.col("votes") == F.col("t_grams")).otherwise((covered >= cover) & (F.col("end") - F.col("start") <= F.ceil(F.col("t_words") * stretch)))
    span = F.when(good, F.struct("label", "start", "end", covered.alias("cover"), "exact"))
    found = merged.groupBy("row", "doc_id", "n_words").agg(F.collect_list(span).alias("s"))
    base = F.filter("s", lambda x: x.exact)
    listed = lambda s: F.array_join(F.array_sort(F.array_distinct(F.transform(s, lambda x: x.label))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x.start)).cast("long").alias("first_word"), F.array_max(F.transform(base, lambda x: x.start)).cast("long").alias("last_word"),
        listed(base).alias("base_labels"), listed(F.col("s")).alias("labels"), F.coalesce(F.array_max(F.transform("s", lambda x: x.cover)), F.lit(0.0)).alias("score"),
        F.array_sort(F.transform("s", lambda x: F.struct(x.start.alias("start"), x.end.alias("end"), x.label.alias("label"), x.cover.alias("cover")))).alias("spans"),
    )


def sql(cover: float = COVER, stretch: float = STRETCH, near: int = NEAR) -> str:
    """The same result but spans, in DuckDB's SQL; doc_id must be unique."""
    values = ", ".join(str(r).replace("True", "true").replace("False", "false") for r in positions())
    return f"""
with known(template, label, exact, t_words, t_grams, place, w0, w1, w2) as (values {values}),
words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w from documents),
grams as (select doc_id, w, unnest(range(greatest(len(w) - {K} + 1, 0))) as pos from words),
met as (select doc_id, template, label, exact, t_words, t_grams, pos, place, pos - place as diagonal
        from grams join known on w[pos + 1] = w0 and w[pos + 2] = w1 and w[pos + 3] = w2),
diagonals as (select doc_id, template, label, exact, t_words, t_grams, diagonal, count(*) as votes, min(pos) as s, max(pos) + {K} as e from met group by all),
known_alone as (select *, exact or votes::double / t_grams >= {cover} as alone from diagonals),
marked as (select *, case when alone or lag(diagonal) over o is null or lag(alone) over o or diagonal - lag(diagonal) over o > {near} then 1 else 0 end as apart
           from known_alone window o as (partition by doc_id, template order by diagonal)),
grouped as (select *, sum(apart) over (partition by doc_id, template order by diagonal) as g from marked),
merged as (select doc_id, template, label, exact, t_words, t_grams, g, count(distinct place) as votes, min(pos) as s, max(pos) + {K} as e
           from met join grouped using (doc_id, template, label, exact, t_words, t_grams, diagonal) group by all),
good as (select *, votes::double / t_grams as cover from merged
         where case when exact then votes = t_grams else votes::double / t_grams >= {cover} and e - s <= ceil(t_words * {stretch}) end)
select w.doc_id, len(w.w)::bigint as n_words, count(*) filter (exact)::bigint as n_base,
       (min(s) filter (exact))::bigint as first_word, (max(s) filter (exact))::bigint as last_word,
       coalesce(string_agg(distinct label, ',' order by label) filter (exact), '') as base_labels,
       coalesce(string_agg(distinct label, ',' order by label), '') as labels,
       coalesce(max(cover), 0.0::double) as score
from words w left join good using (doc_id) group by w.doc_id, w.w"""
