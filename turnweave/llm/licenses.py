"""Licence notices found through a positional index of their rarest words.

A template is the wording of a notice, with a key phrase in it that has to be there word by word. The
index holds, for the words of each template with the highest IDF, where in the notice they stand. A
file's words are looked up in it; each hit says where the notice would begin, and the begins that two of a
template's words agree on are intersected from their postings. There the key phrase is verified, and the
share of all of the template's words that stand in place is the score. All of it happens within the
file's row, without a second pass over the files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A label, a notice's words and the key phrase among them; ``base`` phrases are counted."""

    label: str
    notice: str
    phrase: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.notice.split()

    @property
    def key(self) -> list[str]:
        return self.phrase.split()

    @property
    def offset(self) -> int:
        """Where the key phrase begins in the notice."""
        n = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.key)


#: Words of a template in the index, and how many of them have to agree on where it begins.
INDEXED, AGREEING = 3, 2

# How licences are named and how their notices begin.
TEMPLATES = (
    Template("mit", "released under the mit license", "under the mit license", base=True),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2", base=True),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and or distribute this software"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "used to endorse or promote products derived from this software"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", "you may not use this file except in compliance with the license"),
    Template("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or", "gnu general public license as published by the free software foundation either version 2"),
    Template("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or", "gnu general public license as published by the free software foundation either version 3"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    Template("mpl-1", "the contents of this file are subject to the mozilla public license version 1 1", "mozilla public license version 1"),
    Template("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
    Template("cddl", "the contents of this file are subject to the terms of the common development and distribution license", "common development and distribution license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    Template("cc0", "licensed under cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    Template("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license", "creative commons attribution noderivatives"),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "in no event will the authors be held liable"),
    Template("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "person or organization obtaining a copy of the software"),
    Template("artistic-2", "this package is free software you may redistribute it under the terms of the artistic license 2 0", "artistic license 2 0"),
    Template("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed", "changing it is allowed as long as the name is changed"),
    Template("ofl", "this font software is licensed under the sil open font license version 1 1", "sil open font license"),
    Template("odbl", "made available under the open database license any rights in individual contents of the database are licensed under the database contents license", "open database license"),
    Template("eupl", "licensed under the eupl version 1 2 the european union public licence", "european union public licence"),
    Template("ms-pl", "licensed under the microsoft public license ms pl", "microsoft public license"),
    Template("psf", "licensed to the python software foundation under the psf license agreement", "python software foundation"),
    Template("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "without a written agreement is hereby granted"),
    Template("lgpl", "the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "the gnu affero general public license", "gnu affero general public license"),
    Template("mpl-2", "the mozilla public license version 2 0", "mozilla public license version 2"),
    Template("afl", "licensed under the academic free license version 3 0", "academic free license"),
    Template("osl", "licensed under the open software license version 3 0", "open software license version 3"),
    Template("lppl", "this work may be distributed and or modified under the conditions of the latex project public license", "latex project public license"),
)


@dataclass(frozen=True)
class Indexed:
    """A word of a template and its place in the notice."""

    word: str
    at: int


def indexed_words(template: Template, templates: tuple[Template, ...] = TEMPLATES) -> list[Indexed]:
    """The template's words of the highest IDF.

    IDF counts templates; of words in as many, longer ones are rarer in what people write, and then
    earlier ones count. A base template stands wherever its phrase does, so its words are those of the phrase.
    """
    begin, words = (template.offset, template.key) if template.base else (0, template.words)
    places = {}
    for at, word in enumerate(words):
        places.setdefault(word, begin + at)
    order = sorted(places, key=lambda w: (sum(w in t.words for t in templates), -len(w), places[w]))
    return [Indexed(w, places[w]) for w in order[:INDEXED]]


def words_of_text(text: Column) -> Column:
    """The words in order, A-Z in lower case; none of a null text."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _strings(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _named(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def agreed_begins(hits: Column, indexed: Column) -> Column:
    """Where a template begins by two of its indexed words, from the places ``hits`` of a file's rare words."""

    def begins(k: int) -> Column:
        entry = F.get(indexed, F.lit(k))
        return F.transform(F.filter(hits, lambda h: h["w"] == entry["w"]), lambda h: h["i"] - entry["at"])

    def pairs(b: Column) -> Column:
        found = [F.array_intersect(b[f"b{i}"], b[f"b{j}"]) for j in range(INDEXED) for i in range(j)]
        return reduce(F.array_union, found)

    return _named(F.struct(*[begins(k).alias(f"b{k}") for k in range(INDEXED)]), pairs)


def scan_licenses(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Add ``n_words``, ``places``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``
    and ``score``.

    ``places`` lists label, begin, whether it is a base phrase's, and score, of every key phrase found;
    ``n_base`` counts the base ones, ``first_word`` and ``last_word`` are their least and greatest begin
    (null if there is none). Labels are distinct, sorted and joined by commas, empty if there is none.
    ``score`` is the best place's share of its notice's words that stand in place, 0 without a place. Null
    and empty texts have no words. Columns of these names are replaced. Rows are not moved. A notice other than
    a base one needs ``AGREEING`` of its indexed words in place.
    """
    added = ("n_words", "places", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    known = [indexed_words(t, templates) for t in templates]
    rare = sorted({x.word for found in known for x in found})
    info = F.array(
        *[
            F.struct(
                F.lit(n).alias("n"),
                F.lit(t.label).alias("label"),
                F.lit(t.base).alias("base"),
                F.lit(t.offset).alias("offset"),
                _strings(t.key).alias("key"),
                _strings(t.words).alias("words"),
                _strings([x.word for x in found]).alias("rare"),
                F.array(*[F.struct(F.lit(x.word).alias("w"), F.lit(x.at).alias("at")) for x in found]).alias("indexed"),
            )
            for n, (t, found) in enumerate(zip(templates, known))
        ]
    )
    split = docs.select(*keep, words_of_text(F.col(f"`{text}`")).alias("_words"))
    # Places of rare words; files without any are done.
    hits = F.when(
        F.arrays_overlap("_words", _strings(rare)),
        F.filter(
            F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(rare)
        ),
    )
    here = F.array_distinct(F.col("_hits.w"))
    likely = F.filter(info, lambda t: F.size(F.array_intersect(t["rare"], here)) >= AGREEING)
    begun = F.transform(likely, lambda t: F.transform(agreed_begins(F.col("_hits"), t["indexed"]), lambda b: F.struct(t["n"].alias("t"), (b + t["offset"]).alias("begin"))))
    looked_up = split.withColumn("_hits", hits).withColumn("_set", F.when(F.col("_hits").isNotNull(), F.flatten(begun)))
    words = F.col("_words")

    def checked(s: Column) -> Column:
        """Whether the key phrase stands at a place."""
        key = info[s["t"]]["key"]
        return (s["begin"] >= 0) & (s["begin"] + F.size(key) <= F.size(words)) & (F.slice(words, F.greatest(s["begin"], F.lit(0)) + 1, F.size(key)) == key)

    def place(s: Column) -> Column:
        t = info[s["t"]]
        begin = s["begin"] - t["offset"]
        in_place = F.filter(
            F.transform(t["words"], lambda w, k: (w == F.get(words, begin + k)) & (begin + k >= 0)), lambda same: F.coalesce(same, F.lit(False))
        )
        return F.struct(
            t["label"].alias("label"),
            s["begin"].cast("bigint").alias("begin"),
            t["base"].alias("base"),
            (F.size(in_place) / F.size(t["words"])).cast("double").alias("score"),
        )

    placed = looked_up.withColumn("places", F.coalesce(F.transform(F.filter("_set", checked), place), F.array().cast("array<struct<label:string,begin:bigint,base:boolean,score:double>>")))
    base = F.filter("places", lambda p: p["base"])
    names = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    begins = F.transform(base, lambda p: p["begin"])
    return placed.select(
        *keep,
        F.size("_words").cast("bigint").alias("n_words"),
        "places",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(begins).alias("first_word"),
        F.array_max(begins).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"),
    )
