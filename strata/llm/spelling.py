"""Spelling variants: words one edit apart, found with k-d trees over letter-count vectors.

One inserted or deleted letter changes the letter counts of a word by 1 in one place, a replaced letter by +1 and -1:
the L1 distance of the vectors is at most two.  So, per pair of lengths (L, L) and (L, L + 1), the words near a word
lie in a small box around its vector.  A k-d tree over the words of a length finds them: a node is passed over if the
distance from its box is more than that, and what is left is verified on the order of the letters.

* A vector is kept as a code of 64 bits: for each of 32 classes of letters (a to z, and six that all other letters
  share) one bit for "at least once" and one for "at least twice".  Counts that are cut off at two, and letters that
  share a class, only bring vectors closer, so nothing near is passed over.  Splits are on one bit ("has at least t of
  letter x"), and the distance up or down from a box is a count of bits.
* The top of each length's tree is fitted to a bounded sample of words (``sample`` words in all) and cuts a length
  into cells of about ``cell`` words.  It shapes cost only: any cuts give the same result.  Each word goes to its own
  cell, and as a query to the other cells within reach.  The words of a cell build the rest of the tree in a task,
  and queries stream through it in batches.
* A cell passes on one row per word that found any: the number of near words and the best one.  Pairs never leave it.

A task's memory grows with a cell: some 100 bytes a word.  No more than ``max_cells`` cells are cut, so that the
table of cells that every task gets stays below 1 MB; with more words than cell * max_cells cells are larger.

Defined results: null and empty texts have no words; repeated rows are counted each; a null id reads as an empty one;
an empty table gives an empty result.  Very long texts are one row of a task, of which the distinct words are kept;
very long words are words like others.  Columns of the input other than the two named are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import bound_batches, written

_FLUSH = 1 << 17  # distinct words counted by a task before it passes them on
_LEAF = 64  # words of a leaf
_TESTS = 1 << 22  # characters compared at once


def drawn_typos(every: int = 97) -> Callable[[str], Callable[[str], str]]:
    """Per document a change of its words: of those that crc32 of '<id>:<word>' draws, one in ``every``, a letter is deleted."""

    def of_document(doc_id: str) -> Callable[[str], str]:
        begun = zlib.crc32(f"{doc_id}:".encode())

        def change(word: str) -> str:
            h = zlib.crc32(word.encode(), begun)
            if h % every:
                return word
            at = h % len(word)
            return word[:at] + word[at + 1 :]

        return change

    return of_document


def word_counts(docs: DataFrame, id_col: str, text_col: str, pattern: str, min_length: int, min_count: int, change: Callable[[str], Callable[[str], str]] | None = None) -> DataFrame:
    """(word, n): the words of all texts with at least ``min_length`` code points and ``min_count`` occurrences.

    Words are maximal runs of ``pattern`` with A-Z lower-cased; ``change(id)`` may change the words of a document first.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))

    def count(batches):
        run, total = re.compile(pattern), Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()

        for b in batches:
            for doc, text in zip(b.column("id").to_pylist(), b.column("text"), strict=True):
                raw = text.as_py()
                if not raw:
                    continue
                own = Counter(run.findall(raw.encode("utf-8", "replace").lower().decode()))  # of bytes, lower() changes A-Z alone
                own_change = change(doc) if change else str
                for word, n in own.items():
                    word = own_change(word)
                    if len(word) >= min_length:
                        total[word] += n
                if len(total) > _FLUSH:
                    yield from out()
        if total:
            yield from out()

    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def letters(words: list[str], length: int) -> np.ndarray:
    """The code points of words of one length, a row each."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat.reshape(len(words), length)


def codes(matrix: np.ndarray) -> np.ndarray:
    """The letter-count vectors of words of one length, as bits: 2 i for one or more of class i, 2 i + 1 for two or more."""
    once, twice = np.zeros(len(matrix), np.uint64), np.zeros(len(matrix), np.uint64)
    for column in matrix.T:
        place = np.where((column >= 97) & (column <= 122), column - 97, 26 + column % 6).astype(np.uint64)
        bit = np.uint64(1) << (np.uint64(2) * place)
        twice |= once & bit
        once |= bit
    return once | twice << np.uint64(1)


def split_bit(points: np.ndarray) -> int:
    """The bit that halves the points best, or -1 if they are all equal."""
    bits = np.unpackbits(np.ascontiguousarray(points).view(np.uint8).reshape(len(points), 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    best = int(np.abs(2 * ones - len(points)).argmin())
    return best if 0 < ones[best] < len(points) else -1


def near_box(q: np.ndarray, low, high, up: int, down: int) -> np.ndarray:
    """Which codes reach the box [low, high] with ``up`` more letters and ``down`` fewer, at most."""
    return (np.bitwise_count(low & ~q) <= up) & (np.bitwise_count(q & ~high) <= down)


def cut(points: np.ndarray, size: float, low: int = 0, high: int = (1 << 64) - 1) -> list[tuple[int, int]]:
    """Cells (bits that all have, bits that any may have) of a k-d tree with about ``size`` points each."""
    bit = split_bit(points) if len(points) > size else -1
    if bit < 0:
        return [(low, high)]
    has = points >> np.uint64(bit) & np.uint64(1) == 1
    return cut(points[~has], size, low, high & ~(1 << bit)) + cut(points[has], size, low | 1 << bit, high)


class Tree:
    """A k-d tree over the words of one length."""

    def __init__(self, words: list[str], length: int):
        self.length = length
        self.letters = letters(words, length)
        points = codes(self.letters)
        self.nodes: list[tuple] = []  # low, high, the children, the words of a leaf with their codes

        def build(at: np.ndarray) -> int:
            own = points[at]
            no = len(self.nodes)
            self.nodes.append(())
            bit = split_bit(own) if len(at) > _LEAF else -1
            has = own >> np.uint64(max(bit, 0)) & np.uint64(1) == 1
            children = [] if bit < 0 else [build(at[~has]), build(at[has])]
            self.nodes[no] = (np.bitwise_and.reduce(own), np.bitwise_or.reduce(own), children, *((None, None) if children else (at, own)))
            return no

        build(np.arange(len(words)))

    def candidates(self, q: np.ndarray, up: int, down: int):
        """(query, word) places whose vectors are within reach, leaf by leaf."""
        todo = [(0, np.arange(len(q)))]
        while todo:
            no, who = todo.pop()
            low, high, children, at, own = self.nodes[no]
            who = who[near_box(q[who], low, high, up, down)]
            todo += [(child, who) for child in children if len(who)]
            if children or not len(who):
                continue
            step = max(1, (1 << 18) // len(own))
            for a in range(0, len(who), step):
                some = q[who[a : a + step], None]
                i, j = np.nonzero((np.bitwise_count(own & ~some) <= up) & (np.bitwise_count(some & ~own) <= down))
                yield who[a + i], at[j]

    def near(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) places of all pairs one edit apart; queries have the length of the tree's words or one less."""
        same = matrix.shape[1] == self.length
        found, waiting, n = [], [], 0
        for pair in self.candidates(codes(matrix), 1, int(same)):
            waiting.append(pair)
            n += len(pair[0])
            if n * self.length > _TESTS:
                found.append(self._verified(matrix, waiting, same))
                waiting, n = [], 0
        if waiting:
            found.append(self._verified(matrix, waiting, same))
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *(f[0] for f in found)]), np.concatenate([none, *(f[1] for f in found)])

    def _verified(self, matrix: np.ndarray, pairs: list, same: bool) -> tuple[np.ndarray, np.ndarray]:
        i, j = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        step = max(1, _TESTS // self.length)
        ok = np.zeros(len(i), bool)
        for a in range(0, len(i), step):
            x, y = matrix[i[a : a + step]], self.letters[j[a : a + step]]
            if same:
                ok[a : a + step] = (x != y).sum(axis=1) == 1
            else:  # what agrees from the front and from the back covers the shorter word
                front, back = x != y[:, :-1], (x != y[:, 1:])[:, ::-1]
                reach = lambda differs: np.where(differs.any(axis=1), differs.argmax(axis=1), differs.shape[1])
                ok[a : a + step] = reach(front) + reach(back) >= x.shape[1]
        return i[ok], j[ok]


def _ranked(words: list[str], n: list[int]) -> tuple[list[int], np.ndarray]:
    """The places of words by falling n, then rising order, and the rank of each place."""
    order = sorted(range(len(words)), key=lambda k: (-n[k], words[k]))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    return order, rank


def _best(size: int, i: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per place i how often it occurs, and its least rank."""
    least = np.full(size, np.iinfo(np.int64).max)
    np.minimum.at(least, i, rank)
    return np.bincount(i, minlength=size), least


def spelling_variants(words: DataFrame, ratio: int = 2, cell: int = 16_384, sample: int = 200_000, max_cells: int = 16_384) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n); words are distinct.

    Two words are near if one inserted, deleted or replaced code point makes one of the other.  ``form`` is the near word of
    largest n (of ties the smallest) if its n is at least ``ratio`` (2 or more) times the word's, else null; ``root`` follows forms to the last.
    """
    spark = words.sparkSession
    bound_batches(spark)
    words = written(words.select("word", "n"), "words")
    top = spark.sparkContext.broadcast(_cells(words, cell, sample, max_cells))

    def place(batches):
        for b in batches:
            texts, lengths = np.array(b.column("word").to_pylist(), object), _lengths(b.column("word"))
            cells, roles, rows = [], [], []
            for length in np.unique(lengths).tolist():
                who = np.flatnonzero(lengths == length)
                q = codes(letters(texts[who].tolist(), length))
                for other, down in ((length, 1), (length + 1, 0)):
                    for no, low, high in top.value.get(other, [(-other, 0, (1 << 64) - 1)]):
                        low, high = np.uint64(low), np.uint64(high)
                        own = near_box(q, low, high, 0, 0) if other == length else np.zeros(len(q), bool)
                        reach = near_box(q, low, high, 1, down) & ~own
                        for role, some in ((0, own), (1, reach)):
                            at = who[some]
                            cells.append(np.full(len(at), no, np.int64))
                            roles.append(np.full(len(at), role, np.int8))
                            rows.append(at)
            at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            for a in range(0, len(at), 1 << 16):
                part = slice(a, a + (1 << 16))
                own = b.take(pa.array(at[part]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells)[part]), pa.array(np.concatenate(roles)[part]), own.column("word"), own.column("n")], ["cell", "role", "word", "n"])

    placed = words.mapInArrow(place, "cell long, role byte, word string, n long")
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sorted_cells = placed.repartition(width, "cell").sortWithinPartitions("cell", "role")
    found = sorted_cells.mapInArrow(_search, "word string, n_near long, best_n long, best string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("b"))
    enough = -F.col("b.less") >= ratio * F.col("n")
    forms = words.join(best, "word", "left").select(
        "word", F.when(enough, F.col("b.best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, -F.col("b.less")).alias("form_n")
    )
    forms = written(forms, "forms")
    roots = _roots(forms.where("form is not null").select("word", F.col("form").alias("root")))
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


def _cells(words: DataFrame, cell: int, sample: int, max_cells: int) -> dict[int, list[tuple[int, int, int]]]:
    """Per length with more words than a cell its cells (number, low, high), fitted to a bounded sample of words."""
    lengths = words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell)
    large = {r.length: r.n for r in lengths.orderBy(F.desc("n")).limit(max_cells // 2).collect()}
    total = sum(large.values())
    if not total:
        return {}
    size = max(cell, 2 * total / max_cells)
    share = min(1.0, 0.9 * sample / total)
    drawn = words.where(F.length("word").isin(list(large))).where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30)))
    some: dict[int, list[str]] = {}
    for r in drawn.select("word").limit(sample).collect():
        some.setdefault(len(r.word), []).append(r.word)
    out: dict[int, list[tuple[int, int, int]]] = {}
    for length in sorted(some):
        drawn_size = max(1.0, size * len(some[length]) / large[length])
        cells = cut(codes(letters(some[length], length)), drawn_size)
        out[length] = [((length << 24) + i, low, high) for i, (low, high) in enumerate(cells)]
    return out


def _search(batches):
    """Rows sorted by cell, a cell's own words first: builds a cell's tree, then answers its queries batch by batch."""
    cell, words, n, tree, ranked, rank = None, [], [], None, None, None

    def results(q_words, q_n):
        """Near words of a batch of queries, from both sides unless the queries are the tree's words."""
        by: dict[int, list[int]] = {}
        for i, w in enumerate(q_words):
            by.setdefault(len(w), []).append(i)
        for length, who in by.items():
            i, j = tree.near(letters([q_words[k] for k in who], length))
            if not len(i):
                continue
            count, least = _best(len(who), i, rank[j])
            for k in np.flatnonzero(count).tolist():
                b = ranked[least[k]]
                yield q_words[who[k]], int(count[k]), n[b], words[b]
            if length != tree.length:  # the longer words learn of the shorter ones here
                q_order, q_rank = _ranked([q_words[k] for k in who], [q_n[k] for k in who])
                count, least = _best(len(words), j, q_rank[i])
                for k in np.flatnonzero(count).tolist():
                    b = who[q_order[least[k]]]
                    yield words[k], int(count[k]), q_n[b], q_words[b]

    def batch(rows):
        if rows := list(rows):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "n_near", "best_n", "best"])

    def close():
        """The cell's own words are all there."""
        nonlocal tree, ranked, rank
        if tree is None and words:
            tree = Tree(words, len(words[0]))
            ranked, rank = _ranked(words, n)
            for a in range(0, len(words), 1 << 14):
                yield from batch(results(words[a : a + (1 << 14)], n[a : a + (1 << 14)]))

    for b in batches:
        cells, roles = b.column("cell").to_numpy(), b.column("role").to_numpy()
        edges = np.flatnonzero((np.diff(cells) != 0) | (np.diff(roles) != 0)) + 1
        for a, z in zip([0, *edges.tolist()], [*edges.tolist(), len(cells)], strict=True):
            if a == z:
                continue
            if cells[a] != cell:
                yield from close()
                cell, words, n, tree = cells[a], [], [], None
            part = b.slice(a, z - a)
            if roles[a] == 0:
                words += part.column("word").to_pylist()
                n += part.column("n").to_pylist()
            else:
                yield from close()
                if tree is not None:
                    yield from batch(results(part.column("word").to_pylist(), part.column("n").to_pylist()))
    yield from close()


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): the last word of each chain of ``links`` (word, root).  n at least doubles with every step, so chains
    have fewer than 64 steps, and each round doubles the steps that are known."""
    links = written(links, "roots")
    for _ in range(6):
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = written(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        links = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            break
    return links


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Forms and roots of all words of the documents with at least five letters and three occurrences."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words = word_counts(docs, "doc_id", "text", "[A-Za-zÀ-ÿ]+", 5, 3, drawn_typos())
    return spelling_variants(words)
