from __future__ import annotations

import math
import re
import time

import pytest
from pyspark.sql import functions as F

from strata.llm.licenses import _WORD, PHRASES, TEMPLATES, containment_join, license_labels, scan_licenses, word_order

from .conftest import prose

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

NOTICES = [
    (20, "Licensed under the Apache License, Version 2.0."),
    (21, "It is under The MIT-License and the  mit\nlicense; CC BY-NC 4.0 too, cc by nc"),
    (22, "This work is licensed under the GNU General Public License, version 3."),
    (23, "the mit licenses, xthe mit license, the mit license_ the mit licensé"),
    (24, prose(1, 100) + " Permission is hereby granted, free of charge, to any person who got a copy of this Software " + prose(2, 100)),
    (25, "CC BY-SA 4.0\nLicensed under CC BY-SA 4.0."),
    (26, "the mit license " * 200),
]


def base(text):
    w = _WORDS.findall((text or "").translate(_LOWER))
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_base_matches_brute_force(make_docs, odd_docs):
    docs = [*odd_docs, *NOTICES, (20, NOTICES[0][1])]
    rows = scan_licenses(make_docs(docs), "doc_id", "text").collect()
    assert sorted(map(str, (tuple(r[:6]) for r in rows))) == sorted(map(str, ((d, *base(t)) for d, t in docs)))
    by = {r.id: r for r in rows}
    assert (by[22].labels, by[22].base_labels, by[22].score) == ("gpl-3", "", 1.0)
    assert by[24].labels == "mit" and 0.8 <= by[24].score < 1
    assert by[25].labels == "cc-by-sa"
    assert by[20].labels == "apache-2" and by[21].labels == "cc-by-nc,mit"
    assert by[2].labels == by[6].labels == "" and by[6].score == 0


def test_phrases_of_the_contract(make_docs):
    """The first phrase has four words: its places begin at "under", and without that word there is none."""
    texts = ["free under the MIT license, and Under The\nMIT License", "the mit license", "under the mit licenses", "It is under the mit-license. The MIT license", "cc by nc"]
    rows = {r.id: tuple(r) for r in scan_licenses(make_docs(list(enumerate(texts))), "doc_id", "text").collect()}
    assert {i: r[1:6] for i, r in rows.items()} == {
        0: (10, 2, 1, 6, "mit"), 1: (3, 0, None, None, ""), 2: (4, 0, None, None, ""), 3: (9, 1, 2, 2, "mit"), 4: (3, 1, 0, 0, "cc-by-nc"),
    }
    assert [rows[i][6:] for i in range(5)] == [("mit", 1.0), ("mit", 1.0), ("", 0.0), ("mit", 1.0), ("cc-by-nc", 1.0)]


def test_join_finds_all_pairs(spark):
    """Every (block, template) pair that reaches the threshold, against a comparison of all."""
    words = sorted({w for _, t in TEMPLATES for w in t.split()})
    blocks = [words[i : i + 9] + ["other", "words"] for i in range(0, len(words), 4)]
    blocks += [t.split()[k:] + ["more"] * k for _, t in TEMPLATES for k in range(4)] + [[], None]
    blocks = [None if b is None else list(dict.fromkeys(b)) for b in blocks]
    df = spark.createDataFrame(list(enumerate(blocks)), "no int, words array<string>")
    order = word_order(df.select(F.array_join("words", " ").alias("t")), "t", words)
    for threshold in (0.3, 0.8, 1.0):
        got = {(r.no, r.template): r.containment for r in containment_join(df, ["no"], "words", TEMPLATES, order, threshold).collect()}
        want = {}
        for no, b in enumerate(blocks):
            for t, (_, text) in enumerate(TEMPLATES):
                own = set(text.split())
                common = len(own & set(b or []))
                if common >= math.ceil(threshold * len(own) - 1e-9):
                    want[no, t] = common / len(own)
        assert got == pytest.approx(want)


def test_order_is_rarest_first(spark):
    df = spark.createDataFrame([("b a",), ("a A",), ("c",), ("c a",), (None,)], "t string")
    assert word_order(df, "t", ["a", "b", "c", "d"]) == ["d", "b", "c", "a"]


def test_long_line_is_cut_into_overlapping_blocks(make_docs):
    notice = "this work is licensed under the gnu general public license version 3"
    for lead in range(40, 80, 3):
        docs = make_docs([(1, f"{prose(lead, lead)} {notice} {prose(9, 90)}")])
        assert {r.label for r in license_labels(docs, "text").collect()} == {"gpl-3"}


def test_wrapped_notices(make_docs):
    """Real wording, wrapped where no line holds enough of it, among other text."""
    bsd = "Copyright (c) 2020, Jane Doe\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n"
    mit = "# Permission is hereby granted, free of charge, to any\n# person obtaining a copy of this software and associated\n# documentation files"
    cc0 = "To the extent possible under law,\r\nJane Doe has waived all copyright\r\nand related or neighboring rights"
    gpl = "This work is licensed\nunder the GNU General Public\nLicense, version 2."
    docs = [(10 * i + k, f"{prose(i, lead)}\n{text}\n{prose(k, 50)}") for i, text in enumerate([bsd, mit, cc0, gpl]) for k, lead in enumerate([0, 7, 15, 24, 31])]
    docs += [(90, "\n".join([*bsd.split()])), (91, NOTICES[2][1] + "\n" + gpl), (92, prose(5, 30) + "\n" + NOTICES[2][1] + "\n" + prose(6, 9))]
    rows = {r.id: r for r in scan_licenses(make_docs(docs), "doc_id", "text").collect()}
    want = ["bsd", "mit", "cc0", "gpl-2"]
    assert {i: rows[i].labels for i in rows if i < 90} == {10 * i + k: want[i] for i in range(4) for k in range(5)}
    assert rows[0].score == 1.0 and rows[20].score >= 0.8
    assert (rows[90].labels, rows[91].labels, rows[92].labels) == ("bsd", "gpl-2,gpl-3", "gpl-3")


def test_prose_beside_a_notice_completes_no_other(make_docs):
    docs = make_docs([(1, f"{prose(1, 20)} mit dem\n{NOTICES[0][1]}\nunder the mit"), (2, f"{prose(1, 20)}\nreleased the\nunder license")])
    rows = {r.id: r.labels for r in scan_licenses(docs, "doc_id", "text").collect()}
    assert rows == {1: "apache-2", 2: ""}


def test_longest_template_sets_the_blocks(make_docs):
    """A template of more than half of ``block_words``, at any place of a long line."""
    notice = " ".join(f"term{i}" for i in range(50))
    docs = make_docs([(k, f"{prose(k, 3 + 7 * k)} {notice} {prose(9, 90)}") for k in range(10)])
    rows = scan_licenses(docs, "doc_id", "text", templates=[("own", notice)]).collect()
    assert [(r.labels, r.score) for r in rows] == [("own", 1.0)] * 10


def test_empty_table(make_docs):
    assert scan_licenses(make_docs([]), "doc_id", "text").count() == 0


def test_words_are_whole_words(spark):
    """At a text's borders, next to each other, beside other letters and signs, beginnings of one another, empty and no words at all."""
    words = ["license", "licensed", "li", "cc", "v", "2", "né", "", "(c)", "a^b"]
    texts = ["license", "Licensed license LI", "licenses xlicense license2", "cc_cc\tcc", "élicense licenseé", "v.2", "2", "(c) a^b c", "li-Licensed", "Né nÉ", "𝒳cc cc𝒳 cc", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    held = [{w for w in _WORDS.findall((t or "").translate(_LOWER))} for t in texts]
    n = {w: sum(w in h for h in held) for w in words}
    assert n["license"] == 2 and n["cc"] == 2 and n["(c)"] == 0
    assert word_order(df, "t", words) == sorted(words, key=lambda w: (n[w], w))
    assert word_order(df, "t", [""]) == [""] and scan_licenses(df.selectExpr("1 id", "t"), "id", "t", templates=[("x", "a  b (c)")]).where("labels <> ''").count() == 0


def test_patterns_cost_less_than_plain_ones(spark, tmp_path):
    """Words are counted and looked for in much less time than by ranges and alternatives that are tried in turn (F1 of round 3)."""
    path = str(tmp_path / "texts")
    spark.createDataFrame([(prose(k, 20_000),) for k in range(16)], "t string").crossJoin(spark.range(6)).repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    words = sorted({w for _, t in TEMPLATES for w in t.split()})
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

    def plain_order():
        found = F.regexp_extract_all("t", F.lit(rf"(?i)(?<!{word})(?:{'|'.join(words)})(?!{word})"), F.lit(0))
        present = F.explode(F.array_distinct(F.transform(found, F.lower))).alias("w")
        n = {r.w: r["count"] for r in df.select(present).groupBy("w").count().collect()}
        return sorted(words, key=lambda w: (n.get(w, 0), w))

    def counted(one):
        return df.select(F.sum(F.regexp_count("t", F.lit(one + "+")))).collect()

    def least(run):
        took = []
        for _ in range(3):
            at = time.perf_counter()
            result = run()
            took.append(time.perf_counter() - at)
        return min(took), result

    for fast, slow in [(lambda: counted(_WORD), lambda: counted(word)), (lambda: word_order(df, "t", words), plain_order)]:
        (t_fast, got), (t_slow, want) = least(fast), least(slow)
        assert got == want
        assert t_fast < 0.7 * t_slow, (t_fast, t_slow)
