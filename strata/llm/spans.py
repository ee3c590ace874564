"""Text spans with DataFrame functions: where a pattern matches, and their digest strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:long,end:long,text:string,before:string,after:string>"
_CONTEXT = 40
_BLOCK = 256  # characters
_MATCHES = 64  # matches that are gathered one by one


def literal_table(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A small fixed table, as literals of the plan."""

    def value(x):
        return F.array(*map(F.lit, x)) if isinstance(x, list) else F.lit(x)

    structs = [F.struct(*[value(x).alias(c) for c, x in zip(columns, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def no_spans() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once: a lambda that names a column's expression would repeat it per element."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, largest: bool = False, width: int = 512) -> Column:
    """The running sums (or largest values so far) of an array of longs.

    A fold that appends copies what it has at every step.  So the array is scanned in blocks of ``width``, and the blocks' results
    are carried on from one to the next: some 512 copies a value, however long the array.
    """
    join = F.greatest if largest else (lambda a, b: a + b)
    zero = F.lit(-1 if largest else 0).cast("long")
    state = F.struct(zero.alias("at"), F.array().cast("array<long>").alias("out"))

    def scanned(block: Column) -> Column:
        def step(st, x):
            return let(join(st["at"], x), lambda now: F.struct(now.alias("at"), F.concat(st["out"], F.array(now)).alias("out")))

        return F.aggregate(block, state, step, lambda st: st["out"])

    def whole(all_values: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_values) - 1) / width).cast("int")), lambda i: scanned(F.slice(all_values, i * width + 1, width)))

        def carried(own: Column) -> Column:
            before = F.aggregate(own, state, lambda st, x: F.struct(join(st["at"], F.element_at(x, -1)).alias("at"), F.concat(st["out"], F.array(st["at"])).alias("out")), lambda st: st["out"])
            return F.flatten(F.zip_with(own, before, lambda x, add: F.transform(x, lambda v: join(v, add))))

        return F.when(F.size(all_values) > 0, let(blocks, carried)).otherwise(F.array().cast("array<long>"))

    return let(values, whole)


def matches(text: Column, pattern: str, kind: str | Column, keep=None, group: int | None = None) -> Column:
    """All matches of a pattern, leftmost and without overlap, as spans in code points (end exclusive).

    Each has the matched text, up to 40 characters before it (since the match before) and one after it.
    ``keep`` maps the matched text (or, with ``group``, that group's text) to whether the span stays.
    The text between matches comes from splitting at them, so positions are running sums of lengths.
    Patterns must not match the empty string.
    """
    kind = F.lit(kind) if isinstance(kind, str) else kind
    parts = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.split(text, pattern, -1).alias("rest"),
        *([F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("g")] if group else []),
    )

    none = F.struct(F.lit(0).cast("long").alias("at"), no_spans().alias("spans"))

    def add(st: Column, x: Column) -> Column:
        begin = st["at"] + F.length(x["gap"])
        end = begin + F.length(x["m"])
        span = F.struct(
            kind.alias("kind"), begin.alias("start"), end.alias("end"), x["m"].alias("text"),
            F.substring(x["gap"], -_CONTEXT, _CONTEXT).alias("before"), F.substring(x["next"], 1, 1).alias("after"),
        )
        spans = F.concat(st["spans"], F.array(span))
        return F.struct(end.alias("at"), (spans if keep is None else F.when(keep(x["g"]), spans).otherwise(st["spans"])).alias("spans"))

    def moved(block: Column, by: Column) -> Column:
        return F.transform(block["spans"], lambda s: s.withField("start", s["start"] + by).withField("end", s["end"] + by))

    def spans(found: Column) -> Column:
        # as in ``running``: an array is only ever appended to within a block of matches
        n = F.size(found["m"])
        numbers = F.sequence(F.lit(0), F.floor((n - 1) / _MATCHES).cast("int"))

        def block(i: Column) -> Column:
            part = lambda c, more=0: F.slice(found[c], i * _MATCHES + 1 + more, F.least(F.lit(_MATCHES), n - i * _MATCHES))
            steps = F.arrays_zip(part("rest").alias("gap"), part("m").alias("m"), part("rest", 1).alias("next"), part("g" if group else "m").alias("g"))
            return F.aggregate(steps, none, add)

        def whole(blocks: Column) -> Column:
            ends = running(F.transform(blocks, lambda b: b["at"]))
            return F.flatten(F.zip_with(blocks, F.concat(F.array(F.lit(0).cast("long")), F.slice(ends, 1, F.size(ends) - 1)), moved))

        return F.when(n > 0, let(F.transform(numbers, block), whole)).otherwise(no_spans())

    return let(parts, spans)


def matches_if(text: Column, pattern: str, kind: str, keep=None, group: int | None = None, quick: Column | None = None) -> Column:
    """``matches`` where the quick test (by default the pattern itself) says that there are any."""
    return F.when(text.rlike(pattern) if quick is None else quick, matches(text, pattern, kind, keep, group)).otherwise(no_spans())


def in_order(spans: Column, kinds: list[str]) -> Column:
    """Distinct spans sorted by start, then kind as listed, then end."""
    rank = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    narrow = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))

    def distinct(ordered: Column) -> Column:  # equal ones are neighbours
        before = F.concat(F.array(F.lit(None)), F.slice(ordered, 1, F.greatest(F.size(ordered) - 1, F.lit(0))))
        fresh = F.filter(F.arrays_zip(ordered.alias("s"), before.alias("b")), lambda x: x["s"].isNotNull() & ~x["s"].eqNullSafe(x["b"]))
        return F.transform(fresh, lambda x: narrow(x["s"]))

    return let(F.array_sort(keyed), distinct)


def joined(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end of every span in that order, comma-joined; no span gives the empty string."""
    text = F.transform(in_order(spans, kinds), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def clear_of(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others.

    All are sorted by start; a span meets another that begins before it if the largest end of those so far lies behind
    its start, and one that begins later if the next start lies before its end (the same, read from the back).
    """
    size = F.lit(2**62).cast("long")
    entry = lambda mine: lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(mine).alias("mine"), s.alias("s"))
    together = F.array_sort(F.concat(F.transform(others, entry(False)), F.transform(spans, entry(True))))

    def check(every: Column) -> Column:
        ends = running(F.transform(every, lambda x: F.when(x["mine"], F.lit(-1).cast("long")).otherwise(x["end"])), largest=True)
        starts = F.reverse(running(F.transform(F.reverse(every), lambda x: F.when(x["mine"], F.lit(-1).cast("long")).otherwise(size - x["start"])), largest=True))
        clear = F.filter(
            F.arrays_zip(every.alias("x"), ends.alias("upto"), starts.alias("after")),
            lambda z: z["x"]["mine"] & (z["upto"] <= z["x"]["start"]) & ((z["after"] < 0) | (size - z["after"] >= z["x"]["end"])),
        )
        return F.transform(clear, lambda z: z["x"]["s"])

    return let(together, check)


def replaced(text: Column, spans: Column, mark) -> Column:
    """The text with every span replaced by ``mark`` of it; of overlapping spans, their union by the first one's.

    The text is cut into blocks once, so what lies between two spans is found without reading the text from its start.
    """
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    work = F.struct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0)).alias("blocks"), ordered.alias("spans"), F.length(text).cast("long").alias("n"))

    def part(blocks: Column, begin: Column, end: Column) -> Column:
        first = F.floor(begin / _BLOCK).cast("int")
        last = F.floor((end - 1) / _BLOCK).cast("int")
        held = F.array_join(F.slice(blocks, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
        return F.when(end > begin, F.substr(held, (begin - first * _BLOCK + 1).cast("int"), (end - begin).cast("int"))).otherwise(F.lit(""))

    def build(w: Column) -> Column:
        ends = running(F.transform(w["spans"], lambda s: s["end"]), largest=True)

        def out(done: Column) -> Column:
            before = F.concat(F.array(F.lit(0).cast("long")), F.slice(done, 1, F.size(done) - 1))
            fresh = F.filter(F.arrays_zip(w["spans"].alias("s"), before.alias("from")), lambda x: x["s"]["start"] >= x["from"])
            parts = F.transform(fresh, lambda x: F.concat(part(w["blocks"], x["from"], x["s"]["start"]), mark(x["s"])))
            return F.concat(F.array_join(parts, ""), part(w["blocks"], F.element_at(done, -1), w["n"]))

        return let(ends, out)

    return F.when(F.size(spans) > 0, let(work, build)).otherwise(text)


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
