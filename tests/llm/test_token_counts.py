from __future__ import annotations

import json
import random

import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import token_counts as tc

from .conftest import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "e", "th", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "x'v", "!", "1", "23", "é", "日", "😀", "<|endoftext|>", "<|endo", "the", " in", "ing", "-", "----", " ", "՘", "　", " \n", "’"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return tc.Vocabulary(PATH)


def encoded(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_of_random_texts(own, library):
    r = random.Random(1)
    for _ in range(400):
        s = "".join(r.choice(PARTS) for _ in range(r.randint(0, 40)))
        assert own.prefix_counts(s).tolist() == [encoded(library, s[:i]) for i in range(1, len(s) + 1)], s


@pytest.mark.parametrize("text", [" " * 300 + "x", "-" * 300, "\n" * 200 + "\na", "a" * 500, "=~" * 200, "日本" * 90, "<|endoftext|>" * 3 + " <|endoftext|", "x  <|endoftext|>", "foo <|endoftext|> bar"])
def test_every_prefix_of_hard_texts(own, library, text):
    assert own.prefix_counts(text).tolist() == [encoded(library, text[:i]) for i in range(1, len(text) + 1)]


def test_blocks_and_forgotten_tables_change_nothing(library, monkeypatch):
    text = "  ".join(prose(i, 30) + "\n\n" + "z" * 40 for i in range(8)) + "   <|endoftext|>  end"
    want = tc.Vocabulary(PATH).prefix_counts(text).tolist()
    monkeypatch.setattr(tc, "_BLOCK", 50)
    monkeypatch.setattr(tc, "_KEPT", 5)
    monkeypatch.setattr(tc, "_PAIRS", 50)
    assert tc.Vocabulary(PATH).prefix_counts(text).tolist() == want
    assert want[-1] == encoded(library, text)


def test_split_pattern_agrees_with_the_library_where_it_is_used(own, library):
    """All code points that are split here are classed as the library has them; the others are left to it."""
    for a in range(0, 0x10000, 4096):
        some = [c for c in range(a, a + 4096) if not 0xD800 <= c < 0xE000 and not tc._OTHER.search(chr(c))]
        s = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}{chr(c)}x" for c in some)
        assert [m.span() for m in regex.finditer(tc.PATTERN, s)] == [span for _, span in library.pre_tokenizer.pre_tokenize_str(s)]


def test_counts_of_a_table(make_docs, odd_docs, library):
    docs = [*odd_docs, (20, "<|endoftext|> and <|endoftext|>"), (21, "a ՘b"), (22, "  lead and trail  ")]
    got = tc.prefix_token_counts(make_docs(docs), "text", PATH, "t")
    assert got.columns[:-1] == make_docs([]).columns
    rows = got.select("doc_id", "text", "t.*").collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.n_tokens == encoded(library, r.text or "") and len(r.prefixes) == len(r.text or "")
        if r.text:
            assert r.prefixes[-1] == r.n_tokens


def test_questions_without_encoding_again(make_docs, library):
    texts = {1: "the thing  inside 'rest", 2: "", 3: None, 4: "a" * 50, 5: "日本語 text"}
    table = tc.prefix_token_counts(make_docs(list(texts.items())), "text", PATH, "t")
    p = F.col("t.prefixes")
    for limit in (0, 1, 3, 7, 1000):
        for r in table.select("doc_id", tc.longest_prefix(p, limit).alias("k"), tc.tokens_of_prefix(p, limit).alias("n")).collect():
            s = texts[r.doc_id] or ""
            assert r.k == max(i for i in range(len(s) + 1) if encoded(library, s[:i]) <= limit)
            assert r.n == encoded(library, s[:limit])
    by_column = table.select(tc.longest_prefix(p, F.col("doc_id")).alias("k")).collect()
    assert [r.k for r in by_column] == [max(i for i in range(len(s or "") + 1) if encoded(library, (s or "")[:i]) <= d) for d, s in texts.items()]


def test_very_long_text(own, library):
    text = prose(3, 200_000) + " " + "q" * 300_000
    assert int(own.prefix_counts(text)[-1]) == encoded(library, text)


def test_query_equals_the_library(spark, tmp_path, make_docs, odd_docs, library):
    make_docs(odd_docs).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, (tuple(r) for r in tc.op13_token_counts(spark, str(tmp_path)).collect())))
    want = sorted(str((d, len((t or "").encode()), n := encoded(library, t or ""), n > 512)) for d, t in odd_docs)
    assert got == want


def test_empty_table_and_clashing_name(make_docs):
    assert tc.prefix_token_counts(make_docs([]), "text", PATH, "t").count() == 0
    with pytest.raises(ValueError, match="score"):
        tc.prefix_token_counts(make_docs([]), "text", PATH, "score")


@pytest.mark.parametrize("change", [{"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}])
def test_other_vocabularies_are_refused(tmp_path, change):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f) | change
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="byte-level"):
        tc.Vocabulary(str(tmp_path / "v.json"))
