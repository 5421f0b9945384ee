"""License scans with DataFrame functions only: word k-grams joined to templates, diagonal voting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import digest, documents_of

#: Words of a k-gram; no phrase may be shorter.
K = 3
#: Phrases that count wherever their words stand consecutively, with their labels. Fixed values.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
#: Notices and identifier lines that are found with changes, with their labels. The licences' own words.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the rights "
     "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to "
     "whom the software is furnished to do so subject to the following conditions", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit"),
    ("released under the mit license", "mit"),
    ("spdx license identifier mit", "mit"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("spdx license identifier isc", "isc"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
     "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or "
     "agreed to in writing software distributed under the license is distributed on an as is basis without warranties or "
     "conditions of any kind either express or implied see the license for the specific language governing permissions and "
     "limitations under the license", "apache-2"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
     "apache-2"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("spdx license identifier apache 2 0", "apache-2"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
     "as published by the free software foundation either version 3 of the license or at your option any later version", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
     "as published by the free software foundation either version 2 of the license or at your option any later version", "gpl-2"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("spdx license identifier gpl 3 0", "gpl-3"),
    ("spdx license identifier gpl 2 0", "gpl-2"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("licensed under the gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this "
     "list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "bsd"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("spdx license identifier bsd 3 clause", "bsd"),
    ("spdx license identifier bsd 2 clause", "bsd"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution noderivatives 4 0 international license", "cc-by-nd"),
    ("this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license", "cc-by-nc-sa"),
    ("this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license", "cc-by-nc-nd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
     "distributed with this file you can obtain one at http mozilla org mpl 2 0", "mpl-2"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("to the extent possible under law the author has waived all copyright and related rights", "cc0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]
#: Diagonals of a notice this many words apart are one region, or half the notice's words if these are more.
DRIFT = 3
#: Score from which a notice is found: aligned words of notice and region, as a share of both.
COVER = 0.6
#: Inserted words, or words just before a region, by which a text denies what the notice says.
NEGATIONS = ["not", "no", "never", "nor", "neither", "cannot", "isn", "refused", "denied", "revoked", "withdrawn"]
#: Words beside a k-gram that are kept to see what was inserted.
BESIDE = 2
#: Most template k-grams that are broadcast; a larger table is joined by shuffle.
BROADCAST_ROWS = 50_000
#: Hash that stands for a document itself, so that documents without any match stay in the join.
SELF = 0
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Runs of digits, letters and characters beyond ASCII, A-Z lower-cased."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), SPLIT), lambda w: w != "")


def gram_hashes(hashes: Column) -> Column:
    """Hashes of all runs of K consecutive words from the words' hashes; null at the last K - 1 places."""
    n = F.size(hashes)
    pairs = F.zip_with(hashes, F.slice(hashes, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.zip_with(pairs, F.slice(hashes, 3, n), lambda p, c: F.when(c.isNotNull(), F.xxhash64(p["a"], p["b"], c)))


def templates(spark: SparkSession, phrases: list[tuple[str, str]], notices: list[tuple[str, str]]) -> DataFrame:
    """(template, size, base, label, words) of all phrases and notices."""
    rows = [(n, text, label, n < len(phrases)) for n, (text, label) in enumerate([*phrases, *notices])]
    if any(len(text.split()) < K for _, text, _, _ in rows):
        raise ValueError(f"templates need {K} words or more")
    table = spark.createDataFrame(rows, "template int, text string, label string, base boolean")
    return table.select("template", "label", "base", words_of(F.col("text")).alias("t_words"))


def _template_grams(table: DataFrame) -> DataFrame:
    hashed = table.withColumn("h", F.transform("t_words", lambda w: F.xxhash64(w)))
    grams = hashed.select("template", "t_words", F.posexplode(gram_hashes(F.col("h"))).alias("at", "gram")).where("gram is not null")
    grams = grams.select("gram", "template", "at", F.slice("t_words", F.col("at") + 1, F.lit(K)).alias("t_gram"))
    own = table.sparkSession.range(1).select(
        F.lit(SELF).cast("long").alias("gram"), F.lit(-1).alias("template"), F.lit(0).alias("at"), F.array().cast("array<string>").alias("t_gram")
    )
    return grams.unionByName(own)


def gram_matches(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(doc_id, digest, n_words, template, at, place, beside): k-grams that stand in a document and a template, equal word for word.

    ``beside`` has the (place, word) of the ``BESIDE`` words before and after.

    Every row of ``docs`` also gives one row with template -1.
    """
    grams = _template_grams(table)
    if grams.count() <= BROADCAST_ROWS:
        grams = F.broadcast(grams)
    rows = documents_of(docs).select("doc_id", digest("text").alias("digest"), words_of(F.col("text")).alias("words"))
    rows = rows.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    rows = rows.select(
        "doc_id", "digest", "words", F.posexplode(F.concat(F.array(F.lit(SELF).cast("long")), gram_hashes(F.col("h")))).alias("n", "gram")
    )
    # the words ride along by reference up to the join; only matches carry anything on
    same = F.when(F.col("template") < 0, F.col("n") == 0).otherwise(
        (F.col("n") > 0) & (F.slice("words", F.greatest("n", F.lit(1)), F.lit(K)) == F.col("t_gram"))
    )
    offsets = F.array(*[F.lit(o) for o in (*range(-BESIDE, 0), *range(K, K + BESIDE))])
    beside = F.transform(offsets, lambda o: F.struct((F.col("n") - 1 + o).cast("long").alias("place"), F.get("words", F.col("n") - 1 + o).alias("word")))
    return rows.join(grams, "gram").where(same).select(
        "doc_id",
        "digest",
        F.size("words").cast("long").alias("n_words"),
        "template",
        "at",
        (F.col("n") - 1).cast("long").alias("place"),
        F.when(F.col("template") >= 0, F.filter(beside, lambda b: b["word"].isNotNull())).alias("beside"),
    )


def regions(matches: DataFrame, table: DataFrame, drift: int = DRIFT) -> DataFrame:
    """(doc_id, digest, template, base, label, size, start, end, matched, cover): verified regions of each document and template.

    A diagonal is a match's place minus its place in the template; every match
    votes for its diagonal. Diagonals of a phrase stay apart, those of a notice
    are one region while neighbours are up to ``drift`` words or half the
    notice apart.

    A region is verified word by word: every template word that a match on one
    of its diagonals holds stands in the document, at its place plus the
    diagonal. ``matched`` is the number of such words (of template places or
    document places, whichever are fewer); the other template words are
    missing, the other words of the region are inserted. ``cover`` of a notice
    is twice the matched words over the words of notice and region, and 0 where
    an inserted word or one just before the region denies it; of a phrase it is
    the share of its words found.
    """
    key = ["doc_id", "digest", "template"]
    votes = matches.where("template >= 0").dropDuplicates([*key, "at", "place"]).withColumn("diagonal", F.col("place") - F.col("at"))
    votes = votes.groupBy(*key, "diagonal").agg(F.collect_set("at").alias("found"), F.flatten(F.collect_list("beside")).alias("beside"))
    votes = votes.join(table, "template").withColumn(
        "t_places", F.array_distinct(F.flatten(F.transform("found", lambda a: F.sequence(a, a + (K - 1)))))
    )
    near = Window.partitionBy(*key).orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(near)
    most = F.greatest(F.lit(drift), F.floor(F.size("t_words") / 2))
    votes = votes.withColumn("fresh", F.when(F.col("base") | gap.isNull() | (gap > most), 1).otherwise(0))
    votes = votes.withColumn("region", F.sum("fresh").over(near))
    merged = votes.groupBy(*key, "region").agg(
        F.array_distinct(F.flatten(F.collect_list("t_places"))).alias("t_places"),
        F.array_distinct(F.flatten(F.collect_list(F.transform("t_places", lambda t: t + F.col("diagonal"))))).alias("places"),
        F.flatten(F.collect_list("beside")).alias("beside"),
        F.first("label").alias("label"),
        F.first("base").alias("base"),
        F.first(F.size("t_words")).alias("size"),
    )
    merged = merged.withColumns(
        {"start": F.array_min("places"), "end": F.array_max("places") + 1, "matched": F.least(F.size("t_places"), F.size("places"))}
    )
    inserted = F.filter(
        "beside", lambda b: (b["place"] >= F.col("start") - BESIDE) & (b["place"] < F.col("end")) & ~F.array_contains("places", b["place"])
    )
    denied = F.exists(inserted, lambda b: b["word"].isin(NEGATIONS))
    alike = 2 * F.col("matched") / (F.col("size") + F.col("end") - F.col("start"))
    cover = F.when(F.col("base"), F.col("matched") / F.col("size")).when(denied, 0.0).otherwise(alike)
    return merged.select("doc_id", "digest", "template", "base", "label", "size", "start", "end", "matched", cover.alias("cover"))


def best_notices(found: DataFrame) -> DataFrame:
    """Add ``wins``: whether a notice's region stands, since no better one holds some of its words.

    Regions that overlap one another form a stretch of the document; its best
    one stands (by cover, then matched words, then order of the templates),
    and so do those that share no word with it. Phrases do not take part.
    """
    notices = found.where("not base")
    order = Window.partitionBy("doc_id", "digest").orderBy("start", "end", "template")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    notices = notices.withColumn("fresh", F.when(reached.isNull() | (F.col("start") >= reached), 1).otherwise(0))
    notices = notices.withColumn("stretch", F.sum("fresh").over(order))
    best = F.max(F.struct("cover", "matched", (-F.col("template")).alias("first"), "start", "end")).over(
        Window.partitionBy("doc_id", "digest", "stretch")
    )
    notices = notices.withColumn("best", best)
    own = (F.col("best.first") == -F.col("template")) & (F.col("best.start") == F.col("start"))
    apart = (F.col("start") >= F.col("best.end")) | (F.col("end") <= F.col("best.start"))
    notices = notices.withColumn("wins", own | apart).drop("fresh", "stretch", "best")
    return notices.unionByName(found.where("base").withColumn("wins", F.lit(True)))


def license_report(
    docs: DataFrame,
    phrases: list[tuple[str, str]] = PHRASES,
    notices: list[tuple[str, str]] = NOTICES,
    cover: float = COVER,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), a row per row of ``docs``.

    A base place is a diagonal of a phrase with all its words. ``labels`` adds
    those of notices whose verified region has a cover of at least ``cover`` and
    is the best of those it overlaps. ``score`` is the best cover of any region,
    1 for a base place, 0 without a match. Null texts count as empty; repeated
    rows stay; an empty table gives an empty one.
    """
    table = templates(docs.sparkSession, phrases, notices)
    matches = materialise(gram_matches(docs, table), "license-grams")
    found = best_notices(regions(matches, table))
    sure = F.when(F.col("base"), F.col("cover") == 1.0).otherwise(F.col("wins") & (F.col("cover") >= cover))
    found = found.withColumns({"place": F.col("base") & (F.col("cover") == 1.0), "sure": sure})
    names = lambda flag: F.array_join(F.array_sort(F.collect_set(F.when(F.col(flag), F.col("label")))), ",")
    judged = found.groupBy("doc_id", "digest").agg(
        F.count_if("place").alias("n_base"),
        F.min(F.when(F.col("place"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("place"), F.col("start"))).alias("last_word"),
        names("place").alias("base_labels"),
        names("sure").alias("labels"),
        F.max("cover").alias("score"),
    )
    judged = judged.withColumnsRenamed({"doc_id": "__id", "digest": "__digest"})
    rows = matches.where("template < 0").select("doc_id", "digest", "n_words")
    joined = rows.join(judged, rows["doc_id"].eqNullSafe(judged["__id"]) & (rows["digest"] == judged["__digest"]), "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
