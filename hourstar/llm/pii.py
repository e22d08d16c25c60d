"""Personal data by gradient boosting over candidate spans. DataFrame functions only.

*Base* spans are those of strict patterns with a check each: e-mail addresses, IP addresses, card numbers (Luhn), phone
numbers. *Generators* are looser patterns of the same kinds, whose spans may overlap: masked addresses (``a [at] b.org``,
``10[.]0[.]0[.]1``), numbers with other separators, without the plus sign or failing a check. Every candidate has a few
discrete features of its format (digits, separators, grouping, dots) and its context (neighbouring characters, cue words
before it, other kinds in the text). None of them is what the strict check looks at: sign, at-sign, checksum, range.
Boosted trees learn from all candidates of the corpus how likely such a format in such a context passes the
strict check. Candidates that fail it, but look like those that pass, are added.

Training: candidates are counted by their feature values, over all texts; at most ``most_cells()`` rows, whatever the corpus,
come to the driver, where the trees are fitted. Texts whose crc32 mod 4 is 2 are left out of the fit. On them the
threshold of each kind is calibrated: the lowest score above which ``PRECISION`` of the candidates pass the
strict check; without such a score, or with fewer than ``LEAST`` passing ones above it, the kind adds nothing. The trees
become one SQL expression.

Positions: a pattern's matches, and the texts between them, give them by running sums, in blocks of ``SUM`` so that a text with
very many matches takes no quadratic time. Patterns start only where a match can start and never backtrack into
repetitions, so long runs of digits or letters take linear time and no stack.

Defined results. Null and empty texts have no spans. Every row is judged by its own text, so ids may be null or repeated.
Spans of a text are sorted by start, then kind; start and end count code points, the end is exclusive. Empty table: no
rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
PRECISION, LEAST = 0.9, 20
ROUNDS, DEPTH, RATE, RIDGE = 30, 3, 0.3, 1.0
SUM = 64
CONTEXT = 32

# The strict patterns. ``\G`` is the end of the match before; possessive repetitions match what greedy ones
# would here, as what follows a repetition cannot be part of it.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold to have a match of either pattern; saves reading most texts for most kinds.
HOLDS = {"email": r"@|[\[(](?i:at)[\])]", "ip": r"[0-9]\.[0-9]|[0-9][\[(]\.", "card": "[0-9][^A-Za-z]*[0-9]", "phone": "[0-9][^A-Za-z]*[0-9]"}
LOOSE = {
    "email": r"(?:\G|(?<![\p{L}\p{N}._%+-]))[\p{L}\p{N}._%+-]++(?:@|\x20?[\[(](?i:at)[\])]\x20?)[\p{L}\p{N}-]++"
             r"(?:(?:\.|\x20?[\[(](?i:dot)[\])]\x20?)[\p{L}\p{N}-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:(?:\.|\[\.\]|\(\.\))[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20._-]{0,2}[0-9])++",
    "phone": r"\+?\(?[0-9][\x20().0-9-]*[0-9]",
}
CUES = {
    "email": "mail|contact|kontakt|correo|courriel|write to|schreib|reach",
    "ip": r"\bip\b|address|adresse|server|host|dirección|serveur",
    "card": "card|karte|carte|tarjeta|visa|credit|kredit|crédit|pan",
    "phone": "phone|tel|call|mobile|fax|handy|ruf|appel|móvil|llam",
}
OTHER_CUES = r"(?:token|key|secret|hash|version|sha|isbn|order|invoice|id)\W{0,5}$"
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
DIGIT_STEPS = (7, 9, 10, 11, 12, 13, 16, 17, 20)
# How many values each feature has.
FEATURES = {"kind": 4, "digits": len(DIGIT_STEPS) + 1, "marks": 6, "grouped": 2, "left": 4, "right": 4, "cue": 2, "other_cue": 2, "dots": 5, "company": 2}


def most_cells() -> int:
    """Most rows that training takes to the driver."""
    return math.prod(FEATURES.values())


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def passes(kind: str, match: Column) -> Column:
    """Whether a match of a pattern is a base span, if the strict pattern matches it whole."""
    if kind == "email":
        return match.rlike(r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$")
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    size = F.length(digits_of(match))
    if kind == "card":
        # Digits are handed over only within the length, so that the checksum never sees a long run.
        few = F.when(size.between(12, 19), digits_of(match)).otherwise(F.lit("1"))
        return size.between(12, 19) & match.rlike(r"^[0-9](?:[\x20-]?[0-9])*+$") & F.call_function("luhn_check", few)
    return size.between(9, 15) & match.rlike(r"^\+[0-9]")


def plausible(kind: str, match: Column) -> Column:
    """Candidates of a loose pattern that are worth a score."""
    size = F.length(digits_of(match))
    return {"card": size.between(12, 19), "phone": size.between(7, 15)}.get(kind, F.lit(True))


def side(char: Column) -> Column:
    return (
        F.when((char == "") | char.rlike(r"^\s"), 0).when(char.rlike(r"^\p{L}"), 1).when(char.rlike(r"^\p{N}"), 2).otherwise(3)
    )


def features(kind: str, match: Column, before: Column, after: Column, company: Column) -> list[Column]:
    """Integer codes, named as FEATURES."""
    size = F.length(digits_of(match))
    bare = F.regexp_replace(match, r"^\+", "")
    digits = sum(((size >= step).cast("int") for step in DIGIT_STEPS), F.lit(0))
    marks = (
        F.when(bare.contains("("), 1).when(bare.contains("-"), 2).when(bare.contains(" "), 3).when(bare.contains("."), 4)
        .when(bare.contains("_") | bare.contains("["), 5).otherwise(0)
    )
    context = F.lower(before)
    values = {
        "kind": F.lit(KINDS.index(kind)), "digits": digits, "marks": marks,
        "grouped": bare.rlike(r"(?:^|[^0-9])[0-9]{3}[ .-][0-9]{4}$").cast("int"),
        "left": side(F.substring(before, -1, 1)), "right": side(F.substring(after, 1, 1)),
        "cue": context.rlike(CUES[kind]).cast("int"), "other_cue": context.rlike(OTHER_CUES).cast("int"),
        "dots": F.least(F.length(F.regexp_replace(match, "[^.]", "")), F.lit(4)), "company": company.cast("int"),
    }
    return [values[name].alias(name) for name in FEATURES]


def matched(df: DataFrame) -> DataFrame:
    """Adds for each kind and pattern ``_m_..``, its matches, and ``_p_..``, the texts around them (one more)."""
    text = F.coalesce("_text", F.lit(""))
    columns = []
    for name, patterns in (("strict", STRICT), ("loose", LOOSE)):
        for kind in KINDS:
            holds = text.rlike(HOLDS[kind])
            columns.append(F.when(holds, F.regexp_extract_all(text, F.lit(patterns[kind]), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(f"_m_{name}_{kind}"))
            columns.append(F.when(holds, F.split(text, patterns[kind], -1)).otherwise(F.array(F.lit("")).cast("array<string>")).alias(f"_p_{name}_{kind}"))
    return df.select("*", *columns)


def texts_before(name: str) -> Column:
    """For each match of a pattern the text between it and the match before."""
    return F.slice(f"_p_{name}", F.lit(1), F.size(f"_m_{name}"))


def texts_after(name: str) -> Column:
    return F.slice(f"_p_{name}", F.lit(2), F.size(f"_m_{name}"))


def positioned(df: DataFrame) -> DataFrame:
    """Adds ``_ends``, an array by pattern and kind of arrays of the matches' ends.

    Arrays are zipped, not indexed: the optimizer may put an array's expression where it is used, so
    inside of a function of one element it could be computed once per element.
    """
    names = [f"{name}_{kind}" for name in ("strict", "loose") for kind in KINDS]

    def steps(name: str) -> Column:
        """Length of each match with the text before it."""
        return F.zip_with(f"_m_{name}", texts_before(name), lambda m, p: (F.length(p) + F.length(m)).cast("long"))

    def blocks(one: Column) -> Column:
        number = F.when(F.size(one) > 0, F.sequence(F.lit(0), ((F.size(one) - 1) / SUM).cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.transform(number, lambda b: F.slice(one, b * SUM + 1, SUM))

    def running(one: Column) -> Column:
        """0, the first, the first two, ..."""
        return F.aggregate(one, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def shifted(sums: Column, offsets: Column) -> Column:
        """Sums of all blocks; each starts from its block's offset."""
        starts = F.slice(offsets, F.lit(1), F.size(sums))
        return F.flatten(F.zip_with(sums, starts, lambda b, o: F.transform(F.slice(b, 2, SUM), lambda x: x + o)))

    df = df.withColumn("_steps", F.array(*map(steps, names)))
    df = df.withColumn("_sums", F.transform("_steps", lambda one: F.transform(blocks(one), running)))
    df = df.withColumn("_offsets", F.transform("_sums", lambda one: running(F.transform(one, lambda b: F.element_at(b, -1)))))
    return df.withColumn("_ends", F.zip_with("_sums", "_offsets", shifted))


def base_spans(df: DataFrame) -> DataFrame:
    """Adds ``_base_<kind>``, arrays of (start, kind, end)."""

    def spans(k: int, kind: str) -> Column:
        every = F.zip_with(f"_m_strict_{kind}", F.col("_ends")[k], lambda m, end: F.struct(
            (end - F.length(m)).alias("start"), F.lit(k).alias("kind"), end.alias("end"), passes(kind, m).alias("ok")))
        return F.transform(F.filter(every, lambda s: s["ok"]), lambda s: F.struct(s["start"], s["kind"], s["end"]))

    return df.select("*", *[spans(k, kind).alias(f"_base_{kind}") for k, kind in enumerate(KINDS)])


def candidates(df: DataFrame) -> DataFrame:
    """Adds ``_candidates``: (start, kind, end, passes, features) of the loose patterns' matches."""
    every = sum((F.size(f"_base_{kind}") for kind in KINDS), F.lit(0))
    kinds = F.array(*[every > F.size(f"_base_{kind}") for kind in KINDS])
    df = df.withColumn("_company", kinds)

    def scored(k: int, kind: str) -> Column:
        name = f"loose_{kind}"
        matches = F.zip_with(f"_m_{name}", F.col("_ends")[len(KINDS) + k], lambda m, end: F.struct(m.alias("m"), end.alias("end")))
        around = F.zip_with(texts_before(name), texts_after(name), lambda a, b: F.struct(
            F.substring(a, -CONTEXT, CONTEXT).alias("before"), F.substring(b, 1, 1).alias("after")))

        def one(match: Column, near: Column) -> Column:
            m = match["m"]
            values = features(kind, m, near["before"], near["after"], F.col("_company")[k])
            return F.struct(
                (match["end"] - F.length(m)).alias("start"), F.lit(k).alias("kind_at"), match["end"].alias("end"),
                passes(kind, m).alias("passes"), plausible(kind, m).alias("plausible"), F.struct(*values).alias("f"))

        return F.filter(F.zip_with(matches, around, one), lambda c: c["plausible"])

    return df.withColumn("_candidates", F.concat(*[scored(k, kind) for k, kind in enumerate(KINDS)]))


class Tree(NamedTuple):
    """Feature and its largest value to the left; or a leaf's value."""

    feature: str | None
    limit: int
    left: "Tree | None"
    right: "Tree | None"
    value: float

    def sql(self, of: Column) -> Column:
        if self.feature is None:
            return F.lit(self.value)
        return F.when(of[self.feature] <= self.limit, self.left.sql(of)).otherwise(self.right.sql(of))

    def values(self, x: dict[str, np.ndarray]) -> np.ndarray:
        if self.feature is None:
            return np.full(len(next(iter(x.values()))), self.value)
        return np.where(x[self.feature] <= self.limit, self.left.values(x), self.right.values(x))


class Model(NamedTuple):
    """``thresholds``: the least score of each kind, none where nothing is added."""

    start: float = 0.0
    trees: tuple[Tree, ...] = ()
    thresholds: tuple[float | None, ...] = (None,) * len(KINDS)

    def score(self, of: Column) -> Column:
        """Probability of passing the strict check."""
        z = sum((t.sql(of) for t in self.trees), F.lit(self.start))
        return 1 / (1 + F.exp(-z))

    def scores(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.start + sum(t.values(x) for t in self.trees))))


def grow(x: dict[str, np.ndarray], gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, depth: int) -> Tree:
    """A tree of the best splits by the gain in squared gradient."""
    g, h = gradient[rows].sum(), weight[rows].sum()
    best = (1e-9, None, 0)
    if depth:
        for feature, size in FEATURES.items():
            values = x[feature][rows]
            gs = np.bincount(values, gradient[rows], size).cumsum()[:-1]
            hs = np.bincount(values, weight[rows], size).cumsum()[:-1]
            gains = gs**2 / (hs + RIDGE) + (g - gs) ** 2 / (h - hs + RIDGE) - g**2 / (h + RIDGE)
            if len(gains) and gains.max() > best[0]:
                best = float(gains.max()), feature, int(gains.argmax())
    _, feature, limit = best
    if feature is None:
        return Tree(None, 0, None, None, float(RATE * g / (h + RIDGE)))
    left = x[feature][rows] <= limit
    return Tree(feature, limit, grow(x, gradient, weight, rows[left], depth - 1), grow(x, gradient, weight, rows[~left], depth - 1), 0.0)


def boost(x: dict[str, np.ndarray], good: np.ndarray, bad: np.ndarray) -> Model:
    """Trees for cells with ``good`` passing and ``bad`` failing candidates."""
    total, every = good.sum(), np.arange(len(good))
    if not total or not bad.sum():
        return Model()
    start = math.log(total / bad.sum())
    z, trees = np.full(len(good), start), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-z))
        tree = grow(x, good - (good + bad) * p, (good + bad) * p * (1 - p), every, DEPTH)
        trees.append(tree)
        z = z + tree.values(x)
    return Model(start, tuple(trees))


def calibrate(model: Model, x: dict[str, np.ndarray], good: np.ndarray, bad: np.ndarray) -> Model:
    """Sets the thresholds from cells that were not learned from."""
    scores, limits = model.scores(x), []
    for kind in range(len(KINDS)):
        mine = x["kind"] == kind
        least, passed, failed = None, 0, 0
        for score in sorted(set(scores[mine].tolist()), reverse=True):
            here = mine & (scores == score)
            passed, failed = passed + good[here].sum(), failed + bad[here].sum()
            if passed >= LEAST and passed >= PRECISION * (passed + failed):
                least = score
        limits.append(least)
    return model._replace(thresholds=tuple(limits))


def prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    return candidates(base_spans(positioned(matched(rows))))


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Model:
    rows = prepared(docs, id_col, text_col)
    held = F.pmod(F.crc32(F.coalesce("_text", F.lit("")).cast("binary")), F.lit(4)) == 2
    # The outer form, as an inner one lets the optimizer push a filter below, which would write out all steps many times.
    one = rows.select(held.alias("held"), F.explode_outer("_candidates").alias("c")).where("c IS NOT NULL").select("held", "c.passes", "c.f.*")
    sides = [(held_out, good) for held_out in (False, True) for good in (True, False)]
    counts = [F.count_if((F.col("held") == h) & (F.col("passes") == g)).alias(f"n{k}") for k, (h, g) in enumerate(sides)]
    cells = one.groupBy(*FEATURES).agg(*counts).orderBy(*FEATURES).collect()
    if not cells:
        return Model()
    x = {name: np.array([c[name] for c in cells], np.int64) for name in FEATURES}
    n = np.array([[c[f"n{k}"] for c in cells] for k in range(4)], float)
    model = boost(x, n[0], n[1])
    return calibrate(model, x, n[2], n[3]) if model.trees else model


def find(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_<kind>`` (base spans), ``base`` and ``spans``: arrays of (start, kind, end), the latter with added ones."""
    rows = prepared(docs, id_col, text_col)
    base = F.concat(*[F.col(f"_base_{kind}") for kind in KINDS])
    added = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    if any(t is not None for t in model.thresholds):
        def chosen(c: Column) -> Column:
            out = F.lit(False)
            score = model.score(c["f"])
            for k, least in enumerate(model.thresholds):
                if least is not None:
                    out = out | ((c["kind_at"] == k) & (score >= least - 1e-9))
            return ~c["passes"] & out

        added = F.transform(F.filter("_candidates", chosen), lambda c: F.struct(c["start"], c["kind_at"].alias("kind"), c["end"]))
    named = rows.select(
        F.col("_id").alias(id_col), *[F.size(f"_base_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sort_array(base).alias("base"), added.alias("_added"),
    )
    return named.select(id_col, *[f"n_{kind}" for kind in KINDS], "base", F.sort_array(F.concat("base", "_added")).alias("spans"))


def as_text(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined; a span that is listed twice once."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.array_distinct(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"]))), ",")
