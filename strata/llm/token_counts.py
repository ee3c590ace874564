"""Exact token counts at every prefix of a text, by dynamic programming over byte-pair encodings.

A byte-pair encoding has this property: two tokens can stand beside each other in an encoding exactly if merging
their bytes gives the two again.  So the last token of the encoding of a prefix is the one token t that ends there
and is compatible with the last token of the prefix without t, and

    count(prefix) = count(prefix without t) + 1.

One pass over a text therefore stores the count of *every* prefix, exactly what encoding each of them would give.
The stored counts answer truncation ("the longest prefix of at most k tokens") and budget questions ("what do the
first n characters cost") as column expressions, without the tokenizer (``tokens_of_prefix``, ``longest_prefix``).
Counts are not monotone: one more character can merge tokens, so the longest prefix is found over all of them.

The vocabulary's pattern cuts a text into pieces that are encoded one by one; tables of short pieces are kept, in
bounded number.  Two kinds of prefixes end in another piece than the whole text has there, and are set apart: one
that ends in a run of blanks whose last blank goes on with the next word, and one that ends inside a special string.

A vocabulary is a file of the `tokenizers` library: byte-level BPE with its usual pattern (anything else is
refused).  It is read where the tasks run, from ``path``, which must be the same on all machines.

Defined results: null and empty texts have no tokens, 0 bytes and the empty table; special strings inside a text are
one token each, as the library has it by default; repeated rows and null ids pass through; no column of the input
but the text is read and all are kept (``out`` must not be one of them, an error).  A text is one row and is
counted whole, block by block: memory is some 20 times the text with its table, twice the text without it.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import bound_batches

# Fixed: the split pattern of the byte-level vocabularies, and its contractions.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: Fixed: ranges of code points that the pattern classes as the tokenizer library does.  A text with any other is split
#: by the library itself: the Unicode versions of the two differ there.
SAME_CLASSES = [(0x0, 0x52F), (0x590, 0x870), (0x900, 0xC50), (0xD00, 0x2080), (0x20A0, 0xA7C0), (0xAC00, 0xFFFF)]
_OTHER = regex.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in SAME_CLASSES) + "]")
_PIECES = regex.compile(PATTERN)
_BLANKS = regex.compile(r"\s{2,}(?=\S)")

_BLOCK = 1 << 20  # characters split at once
_KEPT = 1 << 17  # piece tables kept by a task
_KEPT_LENGTH = 64  # characters of a piece whose table is kept
_PAIRS = 1 << 20  # remembered compatible pairs


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Tables(dict):
    """The prefix table of a piece, made when it is first asked for; of those made or used lately, a bounded number is kept."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}

    def __missing__(self, piece: str) -> bytes:
        table = self.older.get(piece) or array("i", self.vocabulary.piece_steps(piece)).tobytes()
        if len(piece) <= _KEPT_LENGTH:
            if len(self) >= _KEPT:
                self.older = dict(self)
                self.clear()
            self[piece] = table
        return table


class Vocabulary:
    """A byte-level BPE vocabulary and the prefix tables of texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or not plain or spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"{path}: only byte-level BPE with the usual split pattern is supported")
        self.specials = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in spec["added_tokens"]):
            raise ValueError(f"{path}: special strings that take blanks or whole words are not supported")
        self._special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        byte = _byte_of()
        of = lambda token: bytes(byte[c] for c in token)
        self.token = {of(t): i for t, i in model["vocab"].items() if t not in self.specials}
        self.bytes = {i: t for t, i in self.token.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(self.token[of(a)], self.token[of(b)]): r for r, (a, b) in reversed(list(enumerate(merges)))}
        self.merged = {pair: self.token[self.bytes[pair[0]] + self.bytes[pair[1]]] for pair in self.rank}
        if any(bytes([b]) not in self.token for b in range(256)):
            raise ValueError(f"{path}: not every byte is a token")
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.compatible: dict[tuple[int, int], bool] = {}
        self._automaton([(t, i) for t, i in self.token.items() if self.encode(t) == [i]])  # others are never in an encoding
        self.tables = _Tables(self)

    def encode(self, piece: bytes) -> list[int]:
        """The encoding by its definition: the pair of lowest rank is merged, the leftmost of equals, until none is left."""
        parts = [self.token[bytes([b])] for b in piece]
        while len(parts) > 1:
            best, at = min((self.rank.get(pair, len(self.rank)), i) for i, pair in enumerate(pairwise(parts)))
            if best == len(self.rank):
                break
            parts[at : at + 2] = [self.merged[parts[at], parts[at + 1]]]
        return parts

    def beside(self, a: int, b: int) -> bool:
        """Whether token b can follow token a in an encoding."""
        known = self.compatible.get((a, b))
        if known is None:
            if len(self.compatible) >= _PAIRS:
                self.compatible.clear()
            known = self.compatible[a, b] = self.encode(self.bytes[a] + self.bytes[b]) == [a, b]
        return known

    def _automaton(self, tokens: list[tuple[bytes, int]]) -> None:
        """For reading bytes one by one: per state the next states, and the tokens that end there, the longest first."""
        self.next: list[dict[int, int]] = [{}]
        own: dict[int, tuple[int, int]] = {}
        for t, i in tokens:
            state = 0
            for b in t:
                if b not in self.next[state]:
                    self.next[state][b] = len(self.next)
                    self.next.append({})
                state = self.next[state][b]
            own[state] = (len(t), i)
        self.shorter = [0] * len(self.next)  # the state of the longest proper suffix
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        level = [0]
        while level:
            below = []
            for state in level:
                for b, to in self.next[state].items():
                    self.shorter[to] = self._follow(self.shorter[state], b) if state else 0
                    self.ending[to] = ((own[to],) if to in own else ()) + self.ending[self.shorter[to]]
                    below.append(to)
            level = below

    def _follow(self, state: int, byte: int) -> int:
        while state and byte not in self.next[state]:
            state = self.shorter[state]
        return self.next[state].get(byte, 0)

    def byte_prefixes(self, piece: bytes) -> list[int]:
        """Tokens of every prefix of one piece, by bytes: entry i is the count of its first i bytes."""
        last, count, known, state = [0], [0], self.compatible, 0
        for i, byte in enumerate(piece, 1):
            to = self.next[state].get(byte)
            state = self._follow(state, byte) if to is None else to
            for length, t in self.ending[state]:  # exactly one fits
                at = i - length
                if not at or (known.get((last[at], t)) or self.beside(last[at], t)):
                    last.append(t)
                    count.append(count[at] + 1)
                    break
        return count

    def piece_steps(self, piece: str) -> list[int]:
        """What each character of a piece adds to the number of tokens (less than 0 where it lets tokens merge)."""
        raw = piece.encode("utf-8", "replace")
        if piece in CONTRACTIONS:  # before it is whole it reads as a quote and letters
            counts = [0, *(1 + (self.total(piece[1:i]) if i > 1 else 0) for i in range(1, len(piece))), self.byte_prefixes(raw)[-1]]
        else:
            counts = self.byte_prefixes(raw)
            if len(raw) != len(piece):
                counts = [c for c, byte in zip(counts, [*raw, 0], strict=True) if byte & 0xC0 != 0x80]
        return [b - a for a, b in pairwise(counts)]

    def pieces(self, section: str) -> list[str]:
        """The pieces of one block of text."""
        if _OTHER.search(section):
            return [section[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(section)]
        return _PIECES.findall(section)

    def _steps(self, section: str) -> np.ndarray:
        """Steps of a block, as its pieces have them."""
        return np.frombuffer(b"".join(map(self.tables.__getitem__, self.pieces(section))), np.int32)

    def total(self, section: str) -> int:
        """Number of tokens of a string without special strings."""
        return sum(int(self._steps(block).sum()) for block in _blocks(section))

    def prefix_counts(self, text: str | None) -> np.ndarray:
        """Tokens of every prefix of a text: entry i counts its first i + 1 characters."""
        if not text:
            return np.zeros(0, np.int32)
        out: list[np.ndarray] = []
        before = 0
        for section, special in self._sections(text):
            base = before
            steps = []
            for block in _blocks(section):
                own = self._steps(block)
                # A prefix that ends with a whole run of blanks has it as one piece; in the text, where a word follows,
                # the last blank is a piece of its own or begins the word's.
                if runs := [m.span() for m in _BLANKS.finditer(block)]:
                    counts = np.cumsum(own, dtype=np.int32)
                    for a, b in runs:
                        counts[b - 1] = (counts[a - 1] if a else 0) + self._steps(block[a:b]).sum()
                    own = np.diff(counts, prepend=np.int32(0))
                steps.append(own)
            if steps:
                counts = np.cumsum(np.concatenate(steps), dtype=np.int32) + np.int32(base)
                out.append(counts)
                before = int(counts[-1])
            if special:
                cut = _last_cut(section)
                known = int(out[-1][cut - 1]) if cut else base
                out.append(np.array([*(known + self.total(section[cut:] + special[:k]) for k in range(1, len(special))), before + 1], np.int32))
                before += 1
        return np.concatenate(out)

    def _sections(self, text: str):
        """(text before it, special string) for each special string, and what follows the last one."""
        at = 0
        for m in self._special.finditer(text) if self._special else ():
            yield text[at : m.start()], m.group()
            at = m.end()
        if at < len(text):
            yield text[at:], None


def _last_cut(section: str) -> int:
    """The last place where a piece ends whatever follows: before a space behind a character that is no blank."""
    at = len(section)
    while (at := section.rfind(" ", 0, at)) > 0:
        if not section[at - 1].isspace():
            return at
    return 0


def _blocks(section: str):
    """A section cut where pieces end whatever follows, in blocks of bounded size (or up to the next such place)."""
    at = 0
    while len(section) - at > _BLOCK:
        to = at + _BLOCK
        while (to := section.find(" ", to)) > 0 and section[to - 1].isspace():
            to += 1
        if to < 0:
            break
        yield section[at:to]
        at = to
    if at < len(section):
        yield section[at:] if at else section


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, once per process."""
    return Vocabulary(path)


def prefix_token_counts(docs: DataFrame, text_col: str, path: str, out: str = "tokens", keep: bool = True) -> DataFrame:
    """``docs`` with a struct column ``out``: ``n_tokens`` of the whole text and, with ``keep``, ``prefixes``, the number
    of tokens of the first 1, 2, ... characters (code points).  Without ``keep`` the table is built all the same and only
    its last entry passed on."""
    if out in docs.columns:
        raise ValueError(f"the input has a column {out!r} already")
    bound_batches(docs.sparkSession)
    kind = "n_tokens long" + (", prefixes array<int>" if keep else "")

    @F.arrow_udf(kind)
    def count(texts: pa.Array) -> pa.Array:
        own = vocabulary(path)
        totals, tables = [], []
        for text in texts:
            counts = own.prefix_counts(text.as_py())
            totals.append(int(counts[-1]) if len(counts) else 0)
            if keep:
                tables.append(counts)
        columns = [pa.array(totals, pa.int64())]
        if keep:
            ends = np.cumsum([0, *map(len, tables)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *tables]))))
        return pa.StructArray.from_arrays(columns, names=["n_tokens", "prefixes"][: len(columns)])

    return docs.withColumn(out, count(F.col(text_col).cast("string")))


def tokens_of_prefix(prefixes: Column, n_chars: Column | int) -> Column:
    """Tokens of the first ``n_chars`` characters (0 of none; of the whole text if it has fewer)."""
    n = F.least(F.lit(n_chars) if isinstance(n_chars, int) else n_chars, F.size(prefixes))
    return F.when(n > 0, F.element_at(prefixes, F.greatest(n, F.lit(1)).cast("int"))).otherwise(F.lit(0))


def longest_prefix(prefixes: Column, limit: Column | int) -> Column:
    """Characters of the longest prefix that has at most ``limit`` tokens."""
    k = F.lit(limit) if isinstance(limit, int) else limit
    fits = F.transform(prefixes, lambda tokens, i: F.when(tokens <= k, i + 1).otherwise(F.lit(0)))
    return F.coalesce(F.array_max(fits), F.lit(0))


def op13_token_counts(spark, sf_dir: str, path: str | None = None, limit: int = 512) -> DataFrame:
    """Tokens of every document: the last entry of its table of prefixes."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counted = prefix_token_counts(docs, "text", path, keep=False)
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return counted.select("doc_id", n_bytes.alias("n_bytes"), F.col("tokens.n_tokens").alias("n_tokens"), (F.col("tokens.n_tokens") > limit).alias("over_limit"))
