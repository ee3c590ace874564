"""License scan: phrases at their places, and an exact set-similarity join of text blocks with license notices.

The join finds every block of text that holds at least ``threshold`` of a template's distinct words:

* the words of all templates get one global order, rarest first, by the number of documents that hold them
  (counted over the whole table);
* a block that holds o = ceil(threshold |T|) words of template T holds one of the first |T| - o + 1 of them in that
  order (prefix filter): only such blocks are candidates, found by joining their words with the prefix words;
* a block with fewer than o words is no candidate (length filter);
* if the first common word is at place p of the template's order and at place q of the block's, no more than
  min(|T| - p, |B| - q) words can be common (positional filter);
* what remains is verified by counting the common words.

A block is one line; a longer line gives overlapping blocks of ``block_words`` words (or twice the longest template, if that
is more) at every half of that, so that each run of half a block's words lies whole in one.  A notice can be wrapped, so the words
of a text of several lines also give blocks across the line breaks, of twice the longest template's words at every half of
that: each run of as many words as the longest template has lies whole in one.  There the words must also stand in the template's
order, since words of prose beside a notice would complete its relatives.  All of it is DataFrame code.  The templates are a
small fixed table.  The only join on the corpus is on the text's hash, of narrow rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import written
from strata.llm.spans import literal_table

#: The contract's phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Phrases that give a label but no place.
MORE_PHRASES = {"the mit license": "mit"}

#: Usual wording of license notices, and their labels.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under the creative commons attribution noncommercial license"),
    ("cc-by-sa", "licensed under the creative commons attribution sharealike license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights"),
]

# of text that is not lower-cased yet; characters are named one by one, since Java looks those up in a table but tries ranges in turn
_OTHER = "".join(rf"\x{i:02X}" for i in range(0x80) if not chr(i).isalnum())
_WORD, _GAP = f"[^{_OTHER}]", f"[{_OTHER}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _GAP), lambda w: w != "")


def _tree(texts: list[str]) -> str:
    """A pattern of any of the texts, each beginning of several written once; a blank stands for what separates words."""
    rests: dict[str, list[str]] = {}
    for x in texts:
        rests.setdefault(x[:1], []).append(x[1:])
    ends = rests.pop("", None) is not None
    branches = [(_GAP if c == " " else re.escape(c)) + _tree(rest) for c, rest in sorted(rests.items())]
    return f"(?:{'|'.join(branches)}){'?' if ends else ''}" if len(branches) > 1 or branches and ends else "".join(branches)


def _any_of(texts: list[str]) -> str:
    """A pattern whose group 1 is one of the words or phrases, as whole words, in either case (a to z only).  For texts
    as ``_led`` gives them: each word has a separator before it, so that the other places are left at their first character."""
    texts = [x for x in texts if x]
    firsts = "".join(map(re.escape, sorted({x[0] for x in texts})))
    return rf"(?i)[{_OTHER}](?=[{firsts}])({_tree(texts)})(?!{_WORD})" if texts else "(?!)()"


def _led(text: Column) -> Column:
    """The text after a blank."""
    return F.concat(F.lit(" "), text)


def shortest_phrases(phrases: list[str]) -> list[str]:
    """Those phrases that hold no other one: a text with any phrase has one of these."""
    return [p for p in phrases if not any(q != p and f" {q} " in f" {p} " for q in phrases)]


def phrase_starts(words: Column, phrase: str) -> Column:
    """The places, from 0, at which the words of a phrase stand consecutively."""
    parts = phrase.split(" ")
    places = F.when(F.size(words) >= len(parts), F.sequence(F.lit(0), F.size(words) - len(parts)))
    return F.filter(F.coalesce(places, F.array().cast("array<int>")), lambda i: F.slice(words, i + 1, len(parts)) == F.array(*map(F.lit, parts)))


def word_order(docs: DataFrame, text_col: str, words: list[str]) -> list[str]:
    """The given words, rarest first by the number of documents that hold them, ties by the word.
    The result has as many rows as the templates have words."""
    present = F.array_distinct(F.transform(F.regexp_extract_all(_led(F.col(text_col)), F.lit(_any_of(words)), F.lit(1)), F.lower))
    counted = docs.select(F.explode(present).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {r.word: r.n for r in counted}
    return sorted(words, key=lambda w: (n.get(w, 0), w))


def containment_join(blocks: DataFrame, key_cols: list[str], words_col: str, templates: list[tuple[str, str]], order: list[str], threshold: float) -> DataFrame:
    """All pairs of a block and a template of whose distinct words it holds ``threshold`` or more.

    ``blocks`` has key columns, each row another block, and an array of distinct words.  Returns the keys, ``template`` (its place in
    the list), ``label``, ``common`` (the words, as places in ``order``) and ``containment``.  Null or empty arrays match nothing.
    """
    spark = blocks.sparkSession
    place = {w: i for i, w in enumerate(order)}
    prefixes, sizes = [], []
    for t, (label, text) in enumerate(templates):
        words = sorted(set(text.split(" ")), key=place.__getitem__)
        need = math.ceil(threshold * len(words) - 1e-9)
        sizes.append((t, label, len(words), need, [place[w] for w in words]))
        prefixes += [(place[w], t, p) for p, w in enumerate(words[: len(words) - need + 1])]
    index = literal_table(spark, ["word", "template", "p"], prefixes)
    sizes = literal_table(spark, ["template", "label", "size", "need", "words"], sizes)

    # a block's words as their places in the global order: words of no template come last and never match
    numbers = F.create_map(*[x for w, i in place.items() for x in (F.lit(w), F.lit(i))])
    known = F.filter(F.transform(F.col(words_col), lambda w: numbers[w]), lambda i: i.isNotNull())
    held = blocks.select(*key_cols, F.size(words_col).alias("n"), F.array_sort(known).alias("known"))
    first = held.select("*", F.posexplode("known").alias("q", "word")).join(F.broadcast(index), "word")
    first = first.groupBy(*key_cols, "template").agg(F.min_by(F.struct("p", "q", "n", "known"), "q").alias("x"))
    first = first.join(F.broadcast(sizes), "template")
    possible = first.where((F.col("x.n") >= F.col("need")) & (F.least(F.col("size") - F.col("x.p"), F.col("x.n") - F.col("x.q")) >= F.col("need")))
    found = possible.withColumn("common", F.array_intersect("x.known", "words")).where(F.size("common") >= F.col("need"))
    return found.select(*key_cols, "template", "label", "common", (F.size("common") / F.col("size")).alias("containment"))


def fullest(pairs: DataFrame, key_cols: list[str]) -> DataFrame:
    """Of the matches with one key, each template's best, without those whose common words all belong to a fuller match
    (of equals, the first template): a notice also holds most words of its near relatives, and a part of it can hold a
    larger share of theirs.  So a key has one match per template at most."""
    best = F.max_by(F.struct("common", "containment"), "containment")
    pairs = pairs.groupBy(*key_cols, "template", "label").agg(best.alias("b")).select(*key_cols, "template", "label", "b.*")
    pair = F.struct("template", "label", "common", "containment")

    def explained(x: Column, y: Column) -> Column:
        fuller = (y["containment"] > x["containment"]) | ((y["containment"] == x["containment"]) & (y["template"] < x["template"]))
        return fuller & (F.size(F.array_except(x["common"], y["common"])) == 0)

    groups = pairs.groupBy(*key_cols).agg(F.collect_list(pair).alias("all"))
    kept = F.filter("all", lambda x: ~F.exists("all", lambda y: explained(x, y)))
    return groups.select(*key_cols, F.inline(kept)).drop("common")


def in_order(run: Column, template: Column) -> Column:
    """How many words of the template stand in the run in its order (longest common subsequence)."""
    ends = F.transform(template, lambda t: F.lit(0))  # the longest that ends at each of the template's words

    def step(ends: Column, w: Column) -> Column:
        before = lambda j: F.coalesce(F.array_max(F.slice(ends, F.lit(1), j)), F.lit(0))
        return F.transform(ends, lambda n, j: F.when(F.get(template, j) == w, F.greatest(n, before(j) + 1)).otherwise(n))

    return F.coalesce(F.array_max(F.aggregate(run, ends, step)), F.lit(0))


def across_lines(pairs: DataFrame) -> DataFrame:
    """Of the matches of blocks across lines (their line is null), those that no line of the text holds by itself and no fuller
    match of the text explains; one per text and template."""
    pair = F.struct("template", "label", "common", "containment", F.col("line").isNull().alias("across"))

    def explained(x: Column, y: Column) -> Column:
        fuller = (y["containment"] > x["containment"]) | ((y["containment"] == x["containment"]) & (y["template"] < x["template"]))
        alone = ~y["across"] & (y["template"] == x["template"])
        return (fuller & (y["template"] != x["template"]) | alone) & (F.size(F.array_except(x["common"], y["common"])) == 0)

    groups = pairs.groupBy("text_key").agg(F.collect_set(pair).alias("all"))
    kept = F.filter(F.filter("all", lambda x: x["across"]), lambda x: ~F.exists("all", lambda y: explained(x, y)))
    found = groups.select("text_key", F.inline(kept)).groupBy("text_key", "template", "label").agg(F.max("containment").alias("containment"))
    return found.select("text_key", F.lit(None).cast("int").alias("line"), "template", "label", "containment")


def license_labels(docs: DataFrame, text_col: str, templates=None, threshold: float = 0.8, block_words: int = 64) -> DataFrame:
    """``template``, ``label``, ``containment`` of every line (``text_key``, ``line``) that holds a notice; of its
    blocks the best counts, and a notice that a fuller one of the same line explains is left out.  A notice that only
    several lines hold together has a null ``line``.

    Null and empty texts have no block.  An empty table gives an empty result.
    """
    templates = templates or TEMPLATES
    words = sorted({w for _, t in templates for w in t.split(" ")})
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    order = word_order(texts, "text", words)
    place = {w: i for i, w in enumerate(order)}
    lead: set[str] = set()
    for _, text in templates:
        own = sorted(set(text.split(" ")), key=place.__getitem__)
        lead |= set(own[: len(own) - math.ceil(threshold * len(own) - 1e-9) + 1])

    # only lines that hold a prefix word of some template can match
    some = _any_of(sorted(lead))
    texts = texts.where(_led(F.col("text")).rlike(some)).select(F.unhex(F.md5("text")).alias("text_key"), "text")
    lines = texts.select("text_key", F.posexplode(F.split("text", "\n")).alias("line", "text")).where(_led(F.col("text")).rlike(some))
    lines = lines.select("text_key", "line", lower_words(F.col("text")).alias("words"))
    longest = max(len(t.split(" ")) for _, t in templates)
    block_words = max(block_words, 2 * longest)
    half = block_words // 2
    count = F.greatest(F.lit(1), F.ceil((F.size("words") - half) / half).cast("int"))
    blocks = lines.select("text_key", "line", F.explode(F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(i.alias("part"), F.array_distinct(F.slice(F.col("words"), i * half + 1, F.lit(block_words))).alias("words")))).alias("b"))
    blocks = blocks.select("text_key", "line", "b.part", "b.words")

    # across lines: template words only, the others match nothing; a block with fewer than any template needs is none
    least = min(math.ceil(threshold * len(set(t.split(" "))) - 1e-9) for _, t in templates)
    whole = texts.where(F.col("text").contains("\n")).select("text_key", lower_words(F.col("text")).alias("words"))
    whole = whole.select("text_key", F.transform("words", lambda w: F.when(w.isin(words), w)).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.size("words") - 2 * longest) / longest).cast("int")))
    runs = F.transform(starts, lambda i: F.struct(i.alias("part"), F.array_compact(F.slice(F.col("words"), i * longest + 1, F.lit(2 * longest))).alias("run")))
    leads = F.array(*map(F.lit, sorted(lead)))
    whole = whole.select("text_key", F.explode(F.filter(runs, lambda b: (F.size(b["run"]) >= least) & F.arrays_overlap(b["run"], leads))).alias("b"))
    numbers = F.create_map(*[x for w, i in place.items() for x in (F.lit(w), F.lit(i))])
    whole = whole.select("text_key", "b.part", F.transform("b.run", lambda w: numbers[w]).alias("run"))

    def matched(t: int, label: str, text: str) -> Column:
        own = [place[w] for w in text.split(" ")]
        common = F.array_sort(F.array_intersect("run", F.array(*map(F.lit, sorted(set(own))))))
        need = math.ceil(threshold * len(set(own)) - 1e-9)
        match = F.struct(F.lit(t).alias("template"), F.lit(label).alias("label"), common.alias("common"), (F.size(common) / len(set(own))).alias("containment"))
        return F.when((F.size(common) >= need) & (in_order(F.col("run"), F.array(*map(F.lit, own))) >= need), match)

    matches = F.array_compact(F.array(*[matched(t, *x) for t, x in enumerate(templates)]))
    whole = whole.select("text_key", F.lit(None).cast("int").alias("line"), "part", F.inline(matches))
    alone = containment_join(blocks, ["text_key", "line", "part"], "words", templates, order, threshold)
    pairs = written(alone.unionByName(whole), "pairs")
    return fullest(pairs.where("line is not null"), ["text_key", "line"]).unionByName(across_lines(pairs))


def scan_licenses(docs: DataFrame, id_col: str, text_col: str, templates=None, threshold: float = 0.8, block_words: int = 64) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Labels are distinct, sorted and comma-joined; none is the empty string.  The score is 1 with a phrase (of either table), else
    the largest containment of a template, else 0.  A null text counts as empty; null and repeated ids pass through; an empty table
    gives an empty result.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = license_labels(rows, "text", templates, threshold, block_words)
    found = found.groupBy("text_key").agg(F.collect_set("label").alias("more"), F.max("containment").alias("containment"))

    has = _led(F.col("text")).rlike(_any_of(shortest_phrases([*PHRASES, *MORE_PHRASES])))
    base = rows.select(
        "id",
        F.unhex(F.md5("text")).alias("text_key"),
        F.regexp_count("text", F.lit(_WORD + "+")).cast("long").alias("n_words"),
        F.when(has, lower_words(F.col("text"))).alias("words"),
    )
    def places(phrase: str, label: str) -> Column:
        return F.transform(phrase_starts(F.col("words"), phrase), lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))

    base = base.select(
        "id", "text_key", "n_words",
        F.when(F.col("words").isNotNull(), F.flatten(F.array(*[places(*p) for p in PHRASES.items()]))).alias("places"),
        F.array_compact(F.array(*[F.when(F.size(phrase_starts(F.col("words"), p)) > 0, F.lit(label)) for p, label in MORE_PHRASES.items()])).alias("own"),
    )
    at, labels = F.col("places.at"), F.coalesce(F.col("places.label"), F.array().cast("array<string>"))
    base = base.select(
        "id", "text_key", "n_words",
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        F.array_sort(F.array_distinct(labels)).alias("base"),
        "own",
    )
    out = base.join(found, "text_key", "left")
    every = F.array_union(F.array_union("base", "own"), F.coalesce("more", F.array().cast("array<string>")))
    return out.select(
        "id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when((F.col("n_base") > 0) | (F.size("own") > 0), 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licenses of every document: the contract's phrases, and notices that a block of text holds to 80 %."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan_licenses(docs, "doc_id", "text").withColumnRenamed("id", "doc_id")
