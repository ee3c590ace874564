"""Personal data by weak supervision.

Candidate spans come from patterns: the contract's kinds (always reported) and further kinds.  Labelers vote on each
candidate, for (1), against (-1) or not at all (0): a strict pattern, a gazetteer, context words before it, and its
borders.  Expectation-maximisation estimates, per kind, how often candidates are personal data and how each
labeler votes on those and on the others; that gives each candidate a probability.  A logistic regression on the
span's kind, length, digits, borders and votes is fitted to those probabilities: the final span classifier.

Votes and features are small categories, so both models are fitted to counts per combination, summed up in Spark
over all documents: the number of combinations (kinds x 3^4 votes x 5 lengths x 4 digit shares x 9 borders)
bounds what is collected, whatever the input.  All work on texts is DataFrame code.

A candidate of a further kind that overlaps a span of the contract's kinds is left out, as is one the classifier
gives less than ``keep_from``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.spans import clear_of, count_kind, joined, matches_if, replaced


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Whether the digits of a text pass the Luhn check."""
    d = _digits(m)

    def worth(i):
        x = F.substr(d, i, F.lit(1)).cast("int")
        twice = (F.length(d) - i) % 2 == 1
        return F.when(twice, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def _parts_to_255(m: Column) -> Column:
    def fits(x):
        x = F.regexp_replace(x, "^0+", "")
        return (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255"))

    return F.forall(F.split(m, "\\."), fits)


def _n_digits(low: int, high: int):
    return lambda m: F.length(_digits(m)).between(low, high)


class Kind(NamedTuple):
    name: str
    pattern: str  # possessive where giving back could not help, so that it runs in linear time
    quick: str  # a cheaper pattern that every text with a match has
    keep: object  # on the matched text; None keeps all
    strict: str  # pattern of what the first labeler votes for, on the whole match
    gazetteer: str  # pattern of what the second labeler votes for
    context: str  # words that speak for it


#: The contract's patterns and limits; labelers' lists (top-level domains, issuer prefixes, calling codes, words).
BASE_KINDS = [
    Kind(
        "email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++", "@", None,
        r"^[A-Za-z0-9][^@]*+@[A-Za-z0-9].*[A-Za-z0-9]\.[A-Za-z]{2,}$",
        r"(?i)\.(?:com|org|net|edu|gov|info|io|de|fr|es|uk|it|nl|eu|us|ca|ch|at|be)$", r"mail|contact|kontakt|courriel|correo|write|from|@",
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", _parts_to_255,
        r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$", r"^(?:10\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.|[1-9][0-9]\.|1[0-9]{2}\.|2[01][0-9]\.)",
        r"\bip\b|host|server|address|adresse|login|client|from",
    ),
    Kind(
        "card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){13}", lambda m: _n_digits(14, 19)(m) & luhn(m),
        r"^(?:[0-9]{14,19}|(?:[0-9]{4}[\x20-]){3}[0-9]{2,4}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{4,5})$", r"^(?:4|5[1-5]|2[2-7]|3[4-9]|6)",
        r"card|visa|master|amex|credit|debit|karte|carte|tarjeta|pay",
    ),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _n_digits(10, 15),
        r"^\+[0-9]{1,3}[\x20.-]?\(?[0-9]{1,4}\)?(?:[\x20.-]?[0-9]{2,4}){2,4}$", r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
        r"phone|\btel|call|mobile|\bfax|ruf|appel|llam",
    ),
]
MORE_KINDS = [
    Kind(
        "local_phone", r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])", r"[0-9]{3}[.-][0-9]{4}", None,
        r"^(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[.-])[2-9][0-9]{2}", r"^\(?(?:2[0-9]{2}|3[0-9]{2}|[4-9][0-9]{2})", r"phone|\btel|call|mobile|\bfax|ruf|appel|llam",
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", None,
        r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)", r"^[0-6]", r"\bssn\b|social|security|taxpayer",
    ),
    Kind(
        "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}", None,
        r"^[A-Z]{2}[0-9]{2}(?:\x20?[0-9]{4}){2}", r"^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)", r"iban|account|konto|compte|cuenta|bank",
    ),
    Kind(
        "email_words", r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}\x20?[\[(]\x20?at\x20?[\])]\x20?[a-z0-9-]{1,63}(?:\x20?(?:\.|[\[(]\x20?dot\x20?[\])])\x20?[a-z0-9-]{1,63}){1,4}", r"(?i)[\[(]\x20?at\x20?[\])]", None,
        r"(?i)[a-z]{2,}$", r"(?i)(?:com|org|net|edu|de|fr|es|uk)$", r"mail|contact|kontakt|courriel|correo|write",
    ),
]
_AGAINST = r"version|isbn|order|\bno\.|number of|release|chapter|section"
LABELERS = ["strict", "gazetteer", "context", "borders"]
SPAN_FEATURES = ["strict", "gazetteer", "context", "borders", "length", "digits", "border"]


def _features(s: Column, kind: Kind) -> Column:
    """The votes of the labelers and the classifier's categories for one span."""
    before, after = F.lower(s["before"]), s["after"]
    near = F.regexp_extract(s["before"], r"(.?)$", 1)

    def side(c):
        return F.when(c.rlike(r"^[\p{L}\p{N}_]"), 2).otherwise(F.when(c.rlike(r"^[#%&$*/\\=<>|~^-]"), 1).otherwise(0))

    votes = [
        F.when(s["text"].rlike(kind.strict), 1).otherwise(-1),
        F.when(s["text"].rlike(kind.gazetteer), 1).otherwise(-1),
        F.when(before.rlike(_AGAINST), -1).otherwise(F.when(before.rlike(kind.context), 1).otherwise(0)),
        F.when((side(near) == 0) & (side(after) == 0), 1).otherwise(F.when((side(near) == 2) | (side(after) == 2), -1).otherwise(0)),
    ]
    n = F.length(s["text"])
    share = F.length(_digits(s["text"])) / n
    length = F.when(n <= 10, 0).when(n <= 14, 1).when(n <= 18, 2).when(n <= 24, 3).otherwise(4)
    digits = F.when(share == 0, 0).when(share < 0.5, 1).when(share < 0.9, 2).otherwise(3)
    return F.struct(*[v.alias(f) for v, f in zip([*votes, length, digits, side(near) * 3 + side(after)], SPAN_FEATURES, strict=True)])


def candidate_columns(docs: DataFrame, text_col: str, out: str, base=None, more=None) -> DataFrame:
    """``docs`` with a struct column ``out`` of ``base`` and ``more``, arrays of spans with their features."""
    base, more = base or BASE_KINDS, more or MORE_KINDS
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def of(kind: Kind) -> Column:
        spans = matches_if(text, kind.pattern, kind.name, kind.keep, quick=text.rlike(kind.quick))
        return F.transform(spans, lambda s: s.withField("f", _features(s, kind)))

    found = docs.withColumn(out, F.struct(F.concat(*map(of, base)).alias("base"), F.concat(*map(of, more)).alias("more")))
    own, others = F.col(out)["base"], F.col(out)["more"]
    return found.withColumn(out, F.struct(own.alias("base"), F.when((F.size(others) > 0) & (F.size(own) > 0), clear_of(others, own)).otherwise(others).alias("more")))


def candidate_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: the id and ``base`` and ``more``, arrays of spans with their features."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return candidate_columns(rows, "text", "spans").select("id", "spans.base", "spans.more")


def combination_counts(spans: DataFrame) -> list:
    """How often each combination of kind, votes and features occurs among all candidates."""
    every = spans.select(F.explode(F.concat("base", "more")).alias("s")).select("s.kind", "s.f.*")
    return every.groupBy("kind", *SPAN_FEATURES).agg(F.count(F.lit(1)).alias("n")).collect()


def estimate_reliabilities(votes: np.ndarray, kinds: np.ndarray, n: np.ndarray, n_kinds: int, rounds: int = 50) -> tuple[np.ndarray, dict]:
    """EM: the probability of each row of votes, and the model (rate per kind; a labeler's vote odds per truth).

    It starts from the majority vote; every vote of every labeler has two pseudo-counts in favour of labelers
    that are better than chance, which also defines the result for kinds and labelers without data.
    """
    p = np.where(votes.sum(axis=1) > 0, 0.9, np.where(votes.sum(axis=1) < 0, 0.1, 0.5))
    prior = np.array([[4.0, 2.0, 1.0], [1.0, 2.0, 4.0]])  # truth 0 and 1 by vote -1, 0, 1
    model = {}
    for _ in range(rounds):
        rate = np.array([(2 + (n * p)[kinds == k].sum()) / (4 + n[kinds == k].sum()) for k in range(n_kinds)])
        odds = np.empty((n_kinds, votes.shape[1], 2, 3))
        for k in range(n_kinds):
            own = kinds == k
            for j in range(votes.shape[1]):
                for v in (-1, 0, 1):
                    at = own & (votes[:, j] == v)
                    odds[k, j, :, v + 1] = prior[:, v + 1] + [(n * (1 - p))[at].sum(), (n * p)[at].sum()]
        odds /= odds.sum(axis=3, keepdims=True)
        like = np.stack([np.log(np.where(t, rate, 1 - rate))[kinds] + sum(np.log(odds[kinds, j, t, votes[:, j] + 1]) for j in range(votes.shape[1])) for t in (0, 1)])
        p = 1 / (1 + np.exp(np.clip(like[0] - like[1], -700, 700)))
        model = {"rate": rate, "odds": odds}
    return p, model


def fit_classifier(features: list[list[str]], target: np.ndarray, n: np.ndarray, rounds: int = 300, ridge: float = 1.0) -> dict[str, float]:
    """Weights of a logistic regression on the named categories, with weighted soft targets (gradient steps)."""
    names = sorted({f for row in features for f in row})
    at = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(features), len(names) + 1))
    x[:, -1] = 1
    for i, row in enumerate(features):
        x[i, [at[f] for f in row]] = 1
    w = np.zeros(len(names) + 1)
    total = max(n.sum(), 1.0)
    step = 4 / max(x.sum(axis=1).max(initial=1), 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= step * (x.T @ (n * (p - target)) / total + ridge * np.append(w[:-1], 0) / total)
    return {**dict(zip(names, w[:-1].tolist(), strict=True)), "": float(w[-1])}


def train_span_classifier(spans: DataFrame) -> dict[str, float]:
    """The final classifier's weights, by category; {"": 0.0} without any candidate."""
    rows = combination_counts(spans)
    if not rows:
        return {"": 0.0}
    rows = sorted(rows, key=lambda r: tuple(map(str, r)))
    names = sorted({r.kind for r in rows})
    kinds = np.array([names.index(r.kind) for r in rows])
    votes = np.array([[r[v] for v in LABELERS] for r in rows])
    n = np.array([r.n for r in rows], dtype=float)
    p, _ = estimate_reliabilities(votes, kinds, n, len(names))
    features = [[f"kind={r.kind}", *[f"{f}={r[f]}" for f in SPAN_FEATURES]] for r in rows]
    return fit_classifier(features, p, n)


def _probability(s: Column, weights: dict[str, float]) -> Column:
    table = F.create_map(*[x for k, w in sorted(weights.items()) for x in (F.lit(k), F.lit(w))])
    names = [F.concat(F.lit("kind="), s["kind"]), *[F.concat(F.lit(f"{f}="), s["f"][f].cast("string")) for f in SPAN_FEATURES]]
    total = F.lit(weights.get("", 0.0))
    for name in names:
        total = total + F.coalesce(table[name], F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def find_personal_data(docs: DataFrame, id_col: str, text_col: str, keep_from: float = 0.5) -> DataFrame:
    """Per row: id, ``base`` and ``more``, arrays of spans (kind, start, end, text, before, after, f) in code points.

    A null text counts as empty and has none.  Null and repeated ids pass through; an empty table gives an
    empty result.  Other columns are not read.
    """
    spans = candidate_spans(docs, id_col, text_col)
    weights = train_span_classifier(spans)
    return spans.select("id", "base", confirmed(F.col("more"), weights, keep_from).alias("more"))


def confirmed(spans: Column, weights: dict[str, float], keep_from: float = 0.5) -> Column:
    """The spans to which the classifier gives a probability of at least ``keep_from``."""
    return F.filter(spans, lambda s: _probability(s, weights) >= keep_from)


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by [KIND]; of overlapping spans, their union by the first one's kind."""
    return replaced(text, spans, lambda s: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))


def op6_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document: the contract's kinds, and further kinds that the classifier confirms."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_personal_data(docs, "doc_id", "text")
    base = [k.name for k in BASE_KINDS]
    narrow = [F.transform(c, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))) for c in ("base", "more")]
    found = found.select("id", narrow[0].alias("base"), narrow[1].alias("more"))
    return found.select(
        F.col("id").alias("doc_id"),
        *[count_kind(F.col("base"), k).alias(f"n_{k}") for k in base],
        F.sha2(joined(F.col("base"), base), 256).alias("base_sha256"),
        joined(F.concat("base", "more"), [*base, *[k.name for k in MORE_KINDS]]).alias("spans"),
    )
