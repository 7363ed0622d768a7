"""Planted benchmark passages, and licences of a small tree of files."""

import math
import random
import re
from collections import Counter

import numpy as np

from eventmetrics.llm import decontamination, queries
from eventmetrics.llm.decontamination import (
    benchmark_overlaps,
    best_stretch,
    contamination,
    decontaminate,
)
from eventmetrics.llm.licenses import NOTICE, TEMPLATES, match_notices, scan_licenses
from tests.conftest import SF_DIR
from tests.oracle import differences


def changed(text, every, first):
    words = text.split()
    return " ".join("zzz" if i % every == first else w for i, w in enumerate(words))


def test_the_bitmap_reaches_the_driver_packed(spark):
    # As 16 MB of rows it made the driver's heap grow by more than a hundred.
    seeds = spark.range(20_000).selectExpr("id", "xxhash64(id) AS seed", "id AS place")
    wanted = {r["seed"] & (decontamination.FILTER_BITS - 1) for r in seeds.collect()}
    bits = np.unpackbits(decontamination._bitmap(seeds), bitorder="little")
    assert set(np.flatnonzero(bits).tolist()) == wanted
    parts = decontamination._bitmap_parts(seeds).collect()
    assert len(parts) > 4000 and sum(len(r["bits"]) for r in parts) < 1 << 20


def test_passages_are_found_however_they_were_changed(spark, table):
    items = table("benchmark").collect()
    clean = [r["text"] for r in table("documents").filter("doc_id < 40").collect()]
    rows = []
    for i, item in enumerate(items):
        words = clean[i].split()
        passage = (item["text"], item["text"].upper(), changed(item["text"], 5, 2),
                   re.sub(r"[ ]+", " -- ", item["text"]))[i % 4]
        rows.append((i, " ".join([*words[:30], passage, *words[30:]])))
    rows += [(100 + i, changed(item["text"], 2, 1)) for i, item in enumerate(items)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: {r["item_id"]} for r in benchmark_overlaps(docs, table("benchmark")).collect()
             if r["item_id"] == r["doc_id"]}
    assert set(found) == {i for i in range(len(items))}
    kept = {r["doc_id"] for r in decontaminate(docs, table("benchmark")).collect()}
    assert kept == {100 + i for i in range(len(items))}


def test_passages_with_random_words_changed_are_found(spark):
    chance = random.Random(5)
    items, rows = [], []
    for i, size in enumerate([*range(8, 26)] * 8 + [30, 40, 60] * 8):
        words = [f"p{i}x{k}" for k in range(size)]
        items.append((i, " ".join(words)))
        # As many as the rule allows, and the first and last stay, so the whole passage counts.
        for k in chance.sample(range(1, size - 1), min(size - 8, size * 3 // 10)):
            words[k] = f"changed{k}"
        rows.append((i, " ".join(["before", "it", *words, "after", "it"])))
    found = benchmark_overlaps(spark.createDataFrame(rows, "doc_id bigint, text string"),
                               spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i) for i in range(len(items))}
    assert all(r["matched"] >= 8 and 10 * r["matched"] >= 7 * r["length"] for r in found)


def test_words_are_words_in_any_script_and_punctuation(spark):
    passage = "one of these words is followed by another and so on to the very end"
    chinese = "春天的时候小河边的柳树都绿了孩子们在草地上放风筝"
    thai = "ฉันไปตลาดกับแม่ของฉันเมื่อวานนี้"
    items = spark.createDataFrame([(1, passage), (2, chinese), (3, thai)], "item_id bigint, text string")
    words = passage.split()
    texts = [" \u2014 ".join(words), "\u2014".join(words), " ".join(f"\u201c{w}\u201d" for w in words),
             "\u00a0".join(words), "\u3000".join(words).upper(), f"我说过{chinese}，是不是？", f"x{chinese}y",
             "，".join(chinese), f"ก็ {thai} ครับ", "\u00e9".join(words), chinese[:4] + "我" + chinese[-3:],
             "Größe und Maß " * 9]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in benchmark_overlaps(docs, items).collect()}
    assert found == {(i, 1) for i in range(5)} | {(5, 2), (6, 2), (7, 2), (8, 3)}


def test_any_stretch_that_meets_the_rule_counts():
    passage = np.arange(10, dtype=np.uint64)
    text = passage.copy()
    text[2] = 99
    assert best_stretch(text, passage, 0) == (9, 0, 10)
    text[[4, 6]] = 99
    assert best_stretch(text, passage, 0) == (0, 0, 0)  # seven equal words


def test_leaks_of_the_given_table_equal_brute_force(table):
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    docs, items = table("documents", "sf0.01"), table("benchmark", "sf0.01")
    passages = [" " + " ".join(words(r["text"])) + " " for r in items.collect()]
    whole = {r["doc_id"] for r in docs.collect()
             if any(p in " " + " ".join(words(r["text"])) + " " for p in passages)}
    assert whole and whole == {
        r["doc_id"] for r in contamination(docs, items).collect() if r["contaminated"]}


def test_leaks_in_odd_rows(spark, odd, none, table):
    items = spark.createDataFrame(
        [(1, "the SAME text here. And a second line"), (2, None), (3, ""), (None, "x"), (4, "a b"),
         (5, "is this text"), (6, "you are an idiot and"), (6, "you are an idiot and")],
        "item_id bigint, text string")
    rows = {r["doc_id"]: r["contaminated"] for r in contamination(odd, items).collect()}
    assert rows == {i: i in (4, 5) for i in rows} and len(rows) == 12
    assert contamination(odd, items).count() == odd.count()
    assert contamination(none, items).count() == 0
    assert contamination(odd, items.limit(0)).filter("contaminated").count() == 0
    kept = decontaminate(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3


def test_license_query_equals_sql(spark):
    sql = queries.ORACLE_SQL["op9_license_scan"]
    assert differences(queries.op9_license_scan(spark, SF_DIR), sql, SF_DIR) == ""


def test_cosines_equal_brute_force(spark):
    notices = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0, by me",
               "Copyright 2020 of somebody else", "licence", ""]
    found = {r["notice"]: (r["license"], r["similarity"]) for r in match_notices(
        spark.createDataFrame([(n,) for n in notices], "notice string"), min_similarity=0.0).collect()}
    tokens = lambda t: Counter(re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", t.lower()))
    texts = [tokens(t) for t in notices] + [tokens(t) for _, t in TEMPLATES]
    df = Counter(w for t in texts for w in t)
    weight = lambda t: {w: n * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w, n in t.items()}
    for notice in notices:
        mine, best = weight(tokens(notice)), None
        for name, text in TEMPLATES:
            theirs = weight(tokens(text))
            dot = sum(x * theirs.get(w, 0) for w, x in mine.items())
            if dot:
                norm = math.dist(mine.values(), [0] * len(mine)) * math.dist(theirs.values(), [0] * len(theirs))
                score = (-round(dot / norm, 6), name)
                best = min(best or score, score)
        assert (found.get(notice) is None) == (best is None)
        if best:
            assert found[notice] == (best[1], -best[0])


def test_licences_are_own_inherited_or_none(spark):
    files = spark.createDataFrame([
        ("a/LICENSE", "Released under the MIT License.", 1), ("a/b/x.py", "print()", 2),
        ("a/b/c/y.py", "# Licensed under CC BY-NC 4.0.\ncode", 3), ("ab/z.txt", "hello", 4),
        ("a/b/c/COPYING", "This work is licensed under the GNU General Public License, version 3.", 5),
        (None, "x", 6), ("a/b/c/d/n", None, 7), ("a/b/c/d/n", None, 7),
        ("q/r", "SPDX-License-Identifier: MIT", 8), ("top", "", 9)],
        "path string, text string, license int")
    found = scan_licenses(files)
    assert found.columns == ["path", "text", "license", "license_", "license_basis",
                             "license_similarity", "license_source"]
    rows = [(r["license"], r["license_"], r["license_basis"], r["license_source"]) for r in found.collect()]
    assert sorted(rows, key=str) == sorted([
        (1, "MIT", "own", "a/LICENSE"), (2, "MIT", "inherited", "a"),
        (3, "CC-BY-NC-4.0", "own", "a/b/c/y.py"), (4, None, "none", None),
        (5, "GPL-3.0", "own", "a/b/c/COPYING"), (6, None, "none", None),
        (7, "GPL-3.0", "inherited", "a/b/c"), (7, "GPL-3.0", "inherited", "a/b/c"),
        (8, "MIT", "own", "q/r"), (9, None, "none", None)], key=str)
    assert scan_licenses(files.limit(0)).count() == 0


MIT = """The MIT License (MIT)

Copyright (c) 2019 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"""
GPL = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.

                            Preamble

  The GNU General Public License is a free, copyleft license for
software and other kinds of works."""
LGPL = GPL.replace("GNU GENERAL", "GNU LESSER GENERAL").split("Preamble")[0] + """
  This version of the GNU Lesser General Public License incorporates
the terms and conditions of version 3 of the GNU General Public
License, supplemented by the additional permissions listed below."""
APACHE = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions.

      "License" shall mean the terms and conditions for use, reproduction,
      and distribution as defined by Sections 1 through 9 of this document."""
HEADER = """/*
 * frobnicate - part of a larger whole
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int main(void) { return 0; }"""
BSD_2 = """Copyright (c) 2020, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_the_usual_files_are_recognised(spark):
    rows = [("mit/LICENSE", MIT, "MIT"), ("gpl/COPYING", GPL, "GPL-3.0"), ("lgpl/COPYING", LGPL, "LGPL-3.0"),
            ("apache/LICENSE", APACHE, "Apache-2.0"), ("gpl/x.c", HEADER, "GPL-3.0"),
            ("bsd2/LICENSE", BSD_2, "BSD-2-Clause"), ("bsd3/LICENSE", BSD_3, "BSD-3-Clause"),
            ("bsd2/y.py", "# " + BSD_2.replace("\n", "\n# ") + "\nimport os", "BSD-2-Clause"),
            ("z/own.txt", "Some words.\nAll rights reserved.\nMore words.", "Proprietary")]
    files = spark.createDataFrame(rows, "path string, text string, above string")
    for extra in ("own_license", "their_license", "own_best", "their_best", "key", "file", "directory"):
        files = files.withColumn(extra, files.above)
    found = {r["path"]: (r["license"], r["license_basis"]) for r in scan_licenses(files).collect()}
    assert found == {path: (name, "own") for path, _, name in rows}


def test_every_template_is_recognised_in_a_plain_file(spark):
    assert all(re.search(NOTICE, text) for _, text in TEMPLATES)
    files = spark.createDataFrame([(f"d{i}/file{i}.txt", f"words before\n\n{text}\n\nwords after", name)
                                   for i, (name, text) in enumerate(TEMPLATES)],
                                  "path string, text string, expected string")
    wrong = scan_licenses(files).filter("license is distinct from expected").collect()
    assert [(r["expected"], r["license"], r["text"][:80]) for r in wrong] == []
