"""Secret scan with a trigram inverted index.

``trigram_query`` derives from a rule's regular expression which trigrams a matching text must hold: an AND of
clauses, each an OR of alternatives, each an AND of trigrams (letters folded to lower case).  The index holds the
postings (trigram, text) of the trigrams that the rules ask for.  Intersecting postings is counting: a text meets an
alternative if it has all its trigrams, a rule if it meets all its clauses.  Only then the rule's pattern runs over
the text.  A rule without a mandatory trigram runs over every text.

All of it is DataFrame code; the rules and their queries are a small fixed table.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser as parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.spans import count_kind, joined, literal_table, matches_if, no_spans


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0  # the group that must have ``least`` characters; 0 is the whole match
    least: int = 1


#: The contract's patterns.
BASE_RULES = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
]

#: Published formats of further credentials.
MORE_RULES = [
    # to the END line where base64 (or header) lines, also with escaped breaks, lead to one, else the BEGIN line; possessive, so in linear time
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:[A-Za-z0-9+/=:,.\x5C\s]*+(?:-(?!----)[A-Za-z0-9+/=:,.\x5C\s]*+){0,20}+-----END [A-Z ]{0,30}PRIVATE KEY-----)?"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("bearer", r"(?i)bearer\x20+([A-Za-z0-9._~+/=-]{20,})"),
]

_MOST = 64  # alternatives of one clause; wider ones count as unknown

Query = list[list[frozenset[str]]]


def _strings(node) -> list[str] | None:
    """All texts that one element of a parsed pattern can match, folded; None if unknown or too many."""
    op, arg = node
    if op is C.LITERAL:
        return [chr(arg).lower()]
    if op is C.IN and len(arg) <= 8 and all(o is C.LITERAL for o, _ in arg):
        return sorted({chr(x).lower() for _, x in arg})
    if op is C.SUBPATTERN:
        return _all_strings(arg[3])
    if op is C.BRANCH:
        parts = [_all_strings(x) for x in arg[1]]
        return None if None in parts or sum(map(len, parts)) > _MOST else [s for p in parts for s in p]
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        low, high, inner = arg
        one = _all_strings(inner)
        if one is None or high is C.MAXREPEAT or high > 4:
            return None
        out = [""] if low == 0 else []
        some = [""]
        for n in range(1, high + 1):
            some = [s + t for s in some for t in one]
            if len(some) > _MOST:
                return None
            out += some if n >= low else []
        return out if len(out) <= _MOST else None
    if op is C.AT:
        return [""]
    return None


def _all_strings(nodes) -> list[str] | None:
    have = [""]
    for node in nodes:
        more = _strings(node)
        if more is None or len(have) * len(more) > _MOST:
            return None
        have = [a + b for a in have for b in more]
    return have


def _clauses(nodes) -> Query:
    out: Query = []
    have = [""]

    def close():
        sets = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in have]
        if all(sets):  # an alternative that asks for more than another adds nothing
            out.append([s for s in dict.fromkeys(sets) if not any(o < s for o in sets)])

    for node in nodes:
        more = _strings(node)
        if more is not None and len(have) * len(more) <= _MOST:
            have = [a + b for a in have for b in more]
            continue
        close()
        have = [""]
        op, arg = node
        if more is not None:
            have = list(more)
        elif op is C.SUBPATTERN:
            out += _clauses(arg[3])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] > 0:
            out += _clauses(arg[2])
    close()
    return out


def trigram_query(pattern: str) -> Query:
    """Clauses that every text matching the pattern meets; none if no trigram is mandatory."""
    return _clauses(parser.parse(pattern, re.IGNORECASE))


def trigram_postings(texts: DataFrame, key_col: str, text_col: str, trigrams: list[str]) -> DataFrame:
    """(trigram, key) of each of the given trigrams that a text holds, letters folded to lower case."""
    folded = F.lower(F.col(text_col))
    held = F.array(*[F.when(F.contains(F.col("folded"), F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)])
    rows = texts.select(F.col(key_col).alias("key"), folded.alias("folded"))
    return rows.select("key", F.explode(F.array_compact(held)).alias("trigram")).distinct()


def candidates(postings: DataFrame, trigrams: list[str], queries: dict[int, Query]) -> DataFrame:
    """(key, rules): the rules whose queries a text's postings meet."""
    number = {t: i for i, t in enumerate(trigrams)}
    asked = [
        (number[t], rule, clause, alternative, len(grams), len(query))
        for rule, query in queries.items()
        for clause, alternatives in enumerate(query)
        for alternative, grams in enumerate(alternatives)
        for t in sorted(grams)
    ]
    asked = literal_table(postings.sparkSession, ["trigram", "rule", "clause", "alternative", "size", "clauses"], asked)
    met = postings.join(F.broadcast(asked), "trigram").groupBy("key", "rule", "clauses", "clause", "alternative", "size").agg(F.count(F.lit(1)).alias("n"))
    met = met.where("n = size").groupBy("key", "rule", "clauses").agg(F.countDistinct("clause").alias("n"))
    return met.where("n = clauses").groupBy("key").agg(F.collect_set("rule").alias("rules"))


def _spans(text: Column, rule: Rule) -> Column:
    return matches_if(text, rule.pattern, rule.kind, lambda m: F.length(m) >= rule.least, rule.group or None)


def find_secrets(docs: DataFrame, id_col: str, text_col: str, rules: list[Rule] | None = None) -> DataFrame:
    """Per row: id and ``spans``, an array of (kind, start, end, text, before, after) in code points.

    A null text counts as empty and has none.  Null and repeated ids pass through; equal texts share their
    postings; an empty table gives an empty result.  Other columns are not read.
    """
    rules = rules or [*BASE_RULES, *MORE_RULES]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.unhex(F.md5("text")))
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    trigrams = sorted({t for q in queries.values() for clause in q for grams in clause for t in grams})
    found = candidates(trigram_postings(rows, "key", "text", trigrams), trigrams, queries) if queries else None
    joined_rows = rows.join(found, "key", "left") if found is not None else rows.withColumn("rules", F.array().cast("array<int>"))
    spans = [
        F.when(F.array_contains("rules", i), _spans(F.col("text"), r)).otherwise(no_spans()) if i in queries else _spans(F.col("text"), r)
        for i, r in enumerate(rules)
    ]
    return joined_rows.select("id", F.concat(*spans).alias("spans"))


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets of every document: the contract's kinds and those of published credential formats."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_secrets(docs, "doc_id", "text")
    base = [r.kind for r in BASE_RULES]
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        F.col("id").alias("doc_id"),
        *[count_kind(F.col("spans"), k).alias(f"n_{k}") for k in base],
        F.sha2(joined(own, base), 256).alias("base_sha256"),
        joined(F.col("spans"), [*base, *[r.kind for r in MORE_RULES]]).alias("spans"),
    )
