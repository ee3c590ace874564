"""Exact n-gram Jaccard join by vertical partitioning, and the components of its links.

Two texts link if ``den * |A & B| >= num * |A | B|`` over their sets of word n-grams.

1. All n-grams get one global order: frequent ones last (document frequencies counted over every
   document; see ``frequent_grams``), ties by hash.  Any order gives the same links; a good one
   keeps common n-grams out of the prefixes.
2. Texts with equal sets are one class.  A class's prefix, its first n - ceil(t n) + 1 n-grams in
   the order, must share an n-gram with the prefix of every class that it links to.
3. The global order is cut into fragments; a class's set is cut at the same places into segments.
   The overlap of a candidate pair is counted separately per fragment and summed per pair.
4. Candidates come in two rounds, so that a group of k near copies costs about k pairs.  First, under
   a prefix n-gram of up to ``near`` + 1 classes, all pairs meet; under one of more classes each meets its
   neighbour and the first class, the one with most frequent n-grams in its prefix: of near copies, it has the fewest
   words of its own, so most others link to it.  Of the pairs that met only so, each class keeps the ``best`` that met most often.
   Then, under the latter n-grams, all pairs of classes from different components meet.
   A pair that neither round meets is connected already, or shares no prefix n-gram: no link between
   components is lost.  Before its segments are read, a pair must share enough of the prefixes.
5. Classes that meet in the first round are often unlike texts with a few n-grams in common, the more of them the larger the
   table; those that meet in the second round are mostly copies that lie just under the threshold.  Each class has a bitmap with the
   parity of its n-grams per slot; the bits in which two bitmaps differ are no more than the n-grams in which the sets
   differ, so pairs with more of them than a link allows are left out before any segment is cut.  Large sets fill
   that bitmap, and pass; they have a second one that grows with the set, read for the pairs that are left.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.graph import beside, bound_batches, components, lean, stored, written
from strata.llm.words import gram_hashes, hash_words, mix64, pieces
from strata.session import remove_path

_CLASS_SHIFT = 58  # an ordered n-gram: 5 bits of log2 frequency, 58 bits of hash
_FLUSH = 1_000_000  # n-grams counted at once by a task
_WORDS = 8  # longs of a bitmap
_LARGE = 512  # n-grams of a set that has a second bitmap, of 2 to 4 slots for each
_BATCH = 1 << 20  # bytes of a batch: as much as is hashed at once; Spark's buffers for larger ones are not pooled
_SALTED = 10  # n-grams in more than 2^10 documents are split over several groups


def _sets(texts, n: int, lower: bool):
    """The distinct n-gram hashes (58 bits) of each text; with fewer words, the whole sequence is one."""
    for piece in pieces(texts):
        h, off = hash_words(piece, lower)
        grams = gram_hashes(h, n)
        for a, b in itertools.pairwise(off.tolist()):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1] >> np.uint64(64 - _CLASS_SHIFT))
            elif b > a:
                yield gram_hashes(h[a:b], b - a)[:1] >> np.uint64(64 - _CLASS_SHIFT)
            else:
                yield np.zeros(0, np.uint64)


def frequent_grams(docs: DataFrame, text_col: str, n: int, lower: bool, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, floor(log2 document frequency)) of the most frequent n-grams, ``most`` at most.

    Lossy counting: every task counts all n-grams of its documents in blocks of a million n-grams and
    passes on those that it met twice, so a frequency is short by at most one a block.  The result only shapes the
    order of n-grams; links do not depend on it.
    """

    def count(batches):
        held, size = [], 0

        def flush():
            grams, n_docs = np.unique(np.concatenate(held), return_counts=True)
            twice = n_docs > 1
            return pa.RecordBatch.from_arrays([pa.array(grams[twice].view(np.int64)), pa.array(n_docs[twice])], ["gram", "df"])

        for batch in batches:
            for s in _sets(batch.column(0), n, lower):
                held.append(s)
                size += len(s)
                if size >= _FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    counts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(lean(count), "gram long, df long")
    top = counts.groupBy("gram").agg(F.sum("df").alias("df")).where(F.col("df") >= least).orderBy(F.desc("df"), "gram").limit(most).toPandas()
    top = top.sort_values("gram")
    return top["gram"].to_numpy(np.int64).view(np.uint64), np.floor(np.log2(top["df"].to_numpy(np.float64))).astype(np.uint64)


def _ordered(grams: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The n-grams of one set as sorted keys of the global order."""
    hashes, logs = hot
    if len(hashes) and len(grams):
        at = np.minimum(np.searchsorted(hashes, grams), len(hashes) - 1)
        grams = np.sort(grams | np.where(hashes[at] == grams, logs[at], np.uint64(0)) << np.uint64(_CLASS_SHIFT))
    return grams.view(np.int64)


def _bitmap(grams: np.ndarray, words: int = _WORDS) -> np.ndarray:
    """The parity of the n-grams that fall into each of the bitmap's slots, as longs.  ``words`` is a power of two; the
    bitmap of half as many is the exclusive or of this one's halves."""
    h = mix64(grams)
    slots = (h & np.uint64(words - 1)) << np.uint64(6) | h >> np.uint64(58)
    odd = np.bincount(slots.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _wide(grams: np.ndarray) -> np.ndarray:
    """The second bitmap of a large set; none for others."""
    return _bitmap(grams, 1 << ((len(grams) - 1) // 32).bit_length()) if len(grams) >= _LARGE else np.zeros(0, np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    offsets[1:] = np.cumsum([len(a) for a in arrays])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))


def ngram_components(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    n: int = 3,
    num: int = 90,
    den: int = 100,
    lower: bool = True,
    fragments: int = 8,
    near: int = 8,
    best: int = 2,
    frequent_least: int = 8,
    frequent_most: int = 1 << 18,
) -> DataFrame:
    """Per row of ``docs``: id, n_shingles (size of its set) and component_id (smallest id that it
    reaches by links, itself included).

    ``id_col`` may have any type with an order; null ids take part, and a component's id is its smallest
    non-null one.  Null, empty and blank texts have an empty set and link with nothing (their component is
    their own id).  Rows with equal sets link, repeated rows too.  Other columns are not read.
    An empty table gives an empty result.  ``docs`` is read several times and must give the same rows each time.
    """
    spark = docs.sparkSession
    bound_batches(spark, _BATCH)
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    hot = spark.sparkContext.broadcast(frequent_grams(rows, "text", n, lower, frequent_least, frequent_most))

    def sign(batches):
        for b in batches:
            sizes, common, marks, maps, wides, prefixes = [], [], [], [], [], []
            for s in _sets(b.column("text"), n, lower):
                m = len(s)
                maps.append(_bitmap(s))
                wides.append(_wide(s))
                s = _ordered(s, hot.value)
                sizes.append(m)
                marks.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                # no other set can reach the threshold if m elements of m + 1 do not
                prefixes.append(s[: m + num * m // -den + 1] if m * den >= num * (m + 1) else s[:0])
                common.append(np.count_nonzero(prefixes[-1] >> _CLASS_SHIFT))
            columns = [pa.array(sizes, pa.int32()), pa.array(common, pa.int32()), pa.array(marks, pa.binary()), _lists(maps), _lists(wides), _lists(prefixes)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text_key"), *columns], ["id", "text_key", "n", "common", "mark", "map", "wide", "prefix"])

    id_type = rows.schema["id"].dataType.simpleString()
    signed = rows.mapInArrow(lean(sign), f"id {id_type}, text_key binary, n int, common int, mark binary, map array<long>, wide array<long>, prefix array<long>")
    signed = written(signed.withColumn("row", F.monotonically_increasing_id()), "grams")

    classes = written(signed.where("n > 0").groupBy("mark").agg(F.min("row").alias("class")), "classes")
    copies = written(signed.join(classes, "mark").where("row <> class").select("row"), "copies")
    heads = signed.where("n > 0").join(beside(copies), "row", "left_anti")
    frequency = F.shiftright("gram", _CLASS_SHIFT)
    salts = F.expr(f"shiftleft(1L, cast(greatest(shiftright(gram, {_CLASS_SHIFT}) - {_SALTED}, 0) as int))")
    postings = heads.select(F.col("row").alias("class"), "n", "common", F.explode("prefix").alias("gram"))
    postings = postings.withColumn("salt", F.when(frequency > _SALTED, F.pmod(F.xxhash64("class"), salts)).otherwise(F.lit(0).cast("long")))
    group = Window.partitionBy("gram", "salt").orderBy(F.desc("common"), "n", "class")
    met = F.struct("class", "n")
    postings = postings.select(
        "gram", "class", "n",
        F.collect_list(met).over(group.rowsBetween(1, near)).alias("after"),
        F.first(met).over(group).alias("hub"),
        F.row_number().over(group).alias("place"),
        F.count(F.lit(1)).over(Window.partitionBy("gram", "salt")).alias("size"),
        (frequency > _SALTED).alias("salted"),
    )
    postings = written(postings.where("salted or size > 1").withColumn("small", F.expr(f"not salted and size <= {near + 1}")), "postings")

    long_enough = F.least("na", "nb").cast("long") * den >= F.greatest("na", "nb").cast("long") * num
    # Linked sets share at least so many n-grams of their prefixes: the prefix that ends first in the order
    # holds n - ceil(t n) + 1 n-grams, of which only n - overlap may be missing from the other set.
    overlap = F.ceil(num * (F.col("na") + F.col("nb")).cast("long") / F.lit(den + num))
    least_shared = overlap + 1 - F.ceil(num * F.greatest("na", "nb").cast("long") / F.lit(den))

    maps = signed.select(F.col("row").alias("class"), *[F.col("map")[i].alias(f"map{i}") for i in range(_WORDS)])

    def alike(ours: str, theirs: str, both_n: Column) -> Column:
        """Whether two bitmaps differ in no more bits than linked sets of so many n-grams, counted together, may in n-grams."""
        apart = sum((F.bit_count(F.col(f"{ours}{i}").bitwiseXOR(F.col(f"{theirs}{i}"))) for i in range(_WORDS)), F.lit(0))
        return apart * (den + num) <= (den - num) * both_n.cast("long")

    def alike_wide(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, na, b, nb) whose second bitmaps, if both have one, do not differ in more bits either."""
        ends = written(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "ends")
        wide = signed.where("size(wide) > 0").select("row", "wide").join(beside(ends), "row", "left_semi")
        for side in "ab":
            pairs = pairs.join(wide.select(F.col("row").alias(side), F.col("wide").alias(f"wide_{side}")), side, "left")
        size = F.least(F.size("wide_a"), F.size("wide_b"))
        halves = lambda w: F.zip_with(F.slice(w, 1, size), F.slice(w, size + 1, size), lambda p, q: p.bitwiseXOR(q))
        as_one = lambda w: F.when(F.size(w) == 2 * size, halves(w)).otherwise(F.col(w))
        bits = F.zip_with(as_one("wide_a"), as_one("wide_b"), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
        apart = F.aggregate(bits, F.lit(0).cast("long"), lambda so_far, more: so_far + more)
        # null, where a set has none or sizes are further apart: such pairs pass
        unlike = apart * (den + num) > (den - num) * (F.col("na") + F.col("nb")).cast("long")
        return pairs.where(~F.coalesce(unlike, F.lit(False))).select("a", "na", "b", "nb")

    def pairs_of(x: DataFrame) -> DataFrame:
        """Candidate pairs (a, na, b, nb, shared, met) from structs x and y of (class, n): ``met`` rows had each, whose counts sum up to ``shared``."""
        p = x.where("x.class <> y.class").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "counts")
        p = p.select(F.col("x.class").alias("a"), F.col("x.n").alias("na"), F.col("y.class").alias("b"), F.col("y.n").alias("nb"), "counts")
        return p.where(long_enough).groupBy("a", "na", "b", "nb").agg(F.sum("counts").alias("shared"), F.count(F.lit(1)).alias("met"))

    # First round.  Under an n-gram of few classes all pairs meet; under others neighbours, and all meet the first.
    few, many = postings.where("small"), postings.where("not small")
    each = lambda rows, others, counts: rows.select(met.alias("x"), F.explode(others).alias("y"), F.lit(counts).alias("counts"))
    first_of = Window.partitionBy("gram").orderBy("n", "class")
    heads = many.where("salted and place = 1").select(met.alias("x"), F.lag(met).over(first_of).alias("y"), F.lit(0).alias("counts"))
    meetings = each(few, F.col("after"), 1).union(each(many, F.array_union(F.slice("after", 1, 1), F.array("hub")), 0)).union(heads.where("y is not null"))
    unseen = many.groupBy("class").agg(F.count(F.lit(1)).alias("hidden"))  # prefix n-grams whose pairs were not all met
    pairs = pairs_of(meetings)
    for side in "ab":
        pairs = pairs.join(unseen.select(F.col("class").alias(side), F.col("hidden").alias(f"hidden_{side}")), side, "left")
    hidden = F.least(F.coalesce("hidden_a", F.lit(0)), F.coalesce("hidden_b", F.lit(0)))
    pairs = pairs.where(F.col("shared") + hidden >= least_shared).select("a", "na", "b", "nb", "shared", "met")
    for side in "ab":
        pairs = pairs.join(maps.select(F.col("class").alias(side), *[F.col(f"map{i}").alias(f"{side}{i}") for i in range(_WORDS)]), side)
    pairs = written(pairs.where(alike("a", "b", F.col("na") + F.col("nb"))).select("a", "na", "b", "nb", "shared", "met"), "meetings")
    # Pairs that met only under n-grams of many classes serve to connect, for which a few of each class do: what they
    # leave apart meets again in the second round.
    ends = pairs.where("shared = 0").select("a", "na", "b", "nb", "met", F.explode(F.array("a", "b")).alias("class"))
    place = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("met"), "a", "b"))
    hubs = ends.withColumn("place", place).where(f"place <= {best}").select("a", "na", "b", "nb").distinct()
    tried = written(alike_wide(pairs.where("shared > 0").select("a", "na", "b", "nb").union(hubs)), "pairs")

    bits = (fragments - 1).bit_length()

    def cut(batches):
        for b in batches:
            who, where, parts, opens = [], [], [], []
            for row, s in zip(b.column("row").to_pylist(), _sets(b.column("text"), n, lower), strict=True):
                s = _ordered(s, hot.value)
                borders = np.searchsorted(s, np.arange(1, (1 << bits) + 1, dtype=np.int64) << (_CLASS_SHIFT - bits))
                for i, part in enumerate(np.split(s, borders)):
                    if len(part):
                        opens.append(not who or who[-1] != row)
                        who.append(row)
                        where.append(i)
                        parts.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(who, pa.int64()), pa.array(where, pa.int32()), _lists(parts), pa.array(opens, pa.bool_())], ["class", "fragment", "grams", "opens"])

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, na, b, nb) that reach the threshold."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
        keys, keys_at = stored(signed.select("row", F.xxhash64("id").alias("id_key"), "text_key").join(ends, "row", "left_semi"), "keys")
        # the texts stay where they are read: id and text name a class's row, or several with that id and text
        texts = rows.select(F.xxhash64("id").alias("id_key"), "text_key", "text").join(beside(keys), ["id_key", "text_key"])
        segments = texts.select("row", "text").mapInArrow(lean(cut), "class long, fragment int, grams array<long>, opens boolean")
        segments, segments_at = stored(segments, "segments")
        if segments.where("opens").count() > keys.count():
            segments = segments.dropDuplicates(["class", "fragment"])
        # both joins are on (class, fragment), so the segments are shuffled once
        part = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(1 << bits))))
        for side in "ab":
            part = part.join(segments.select(F.col("class").alias(side), "fragment", F.col("grams").alias(f"grams_{side}")), [side, "fragment"])
        part = part.select("a", "b", "na", "nb", F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("both"))
        whole = part.groupBy("a", "b", "na", "nb").agg(F.sum("both").alias("both"))
        out = written(whole.where(den * F.col("both") >= num * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b"), "links")
        for folder in (segments_at, keys_at):
            remove_path(spark, folder)
        return out

    links = linked(tried)
    label = components(links)

    # Second round: under n-grams of many classes, all pairs of classes that are not connected yet.
    open_ = many.select("gram", "class", "n").join(label.withColumnRenamed("node", "class"), "class", "left")
    open_ = open_.select("gram", "class", "n", F.coalesce("label", "class").alias("label"))
    grams = open_.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("gram")
    open_ = open_.join(grams, "gram", "left_semi")
    open_ = open_.join(maps, "class")
    other = open_.select("gram", met.alias("y"), F.col("label").alias("label_y"), *[F.col(f"map{i}").alias(f"other{i}") for i in range(_WORDS)])
    sizes = F.least("x.n", "y.n").cast("long") * den >= F.greatest("x.n", "y.n").cast("long") * num
    rest = open_.select("gram", met.alias("x"), "label", *[f"map{i}" for i in range(_WORDS)]).join(other, "gram").where((F.col("label") < F.col("label_y")) & sizes & alike("map", "other", F.col("x.n") + F.col("y.n")))
    rest = pairs_of(rest.select("x", "y", F.lit(1).alias("counts"))).where(F.col("shared") >= least_shared)
    rest = written(rest.join(tried, ["a", "b"], "left_anti").select("a", "na", "b", "nb"), "meetings")
    rest = written(alike_wide(rest), "pairs")
    if not rest.isEmpty():
        links = links.union(linked(rest))
        label = components(links)

    member = signed.join(classes, "mark", "left").select("id", "n", "row", "class")
    member = member.join(label.withColumnRenamed("node", "class"), "class", "left")
    member = member.select("id", "n", F.coalesce("label", "class", -1 - F.col("row")).alias("label"))
    # written first, so that the join's only large side is the one with the hot labels, which Spark splits
    smallest = written(member.groupBy("label").agg(F.min("id").alias("component_id")), "smallest")
    return member.join(smallest, "label").select("id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def op10_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ngram_components(docs, "doc_id", "text").withColumnRenamed("id", "doc_id")
