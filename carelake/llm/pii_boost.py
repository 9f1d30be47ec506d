"""Personal data: generators propose spans, boosted trees judge them, thresholds select them.

High-recall generators (regular expressions) propose overlapping candidates with their places. The
base kinds (e-mail, ip, card, phone) are kept whenever their rule holds. The other candidates
(``secret``: keyed values and long mixed tokens; ``number``: long digit groups) are judged by
evidence and, where there is none, by gradient-boosted trees over binned features of format and context.

Training needs no labels from people. Evidence that the trees don't see labels candidates: words before a number that name a
number of a person or a count of things, formats with ranges, known prefixes and the variety of characters of a
value. What evidence proves is a span, what it disproves is none; the trees judge the rest, by the shape of the value and
the marks around it, one model for secrets and one for numbers. Digit groups in base spans teach nothing. The trees see
binned features only, so what they learn from is the number of candidates in each cell of feature
values: one aggregate over all documents, of at most ``MAX_CELLS`` rows a kind whatever the input. One
fold of documents is left for calibration: scores become probabilities by a logistic fit, and the
threshold is the lowest with ``PRECISION`` on that fold. The trees come back as one SQL expression.

Everything on the main path is built-in functions; a document is judged in its own row, without
a shuffle. Offsets count code points; ends are exclusive.

Cases: a null or empty text has no spans. Repeated rows give one result each; null ids are passed
through; an empty table gives an empty result. Other columns are not read.
Without candidates to learn from, base spans and proven ones are returned.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import let

#: Kinds in their order; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "secret", "number")
BASE_KINDS = KINDS[:4]
PRECISION = 0.98
ROUNDS, SHRINK = 24, 0.4
_BLOCK = 256

# The generators. Possessive quantifiers and the look-behinds only spare
# attempts that can't succeed; matches are those of the plain patterns.
_LOCAL = r"[A-Za-z0-9._%+-]"
GENERATORS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "keyed": r"(?i)(?<![A-Za-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"
             r"[\"']?[ \t]{0,4}[:=][ \t]{0,4}[\"']?[A-Za-z0-9+/_.-]{8,}+",
    "token": r"(?<![A-Za-z0-9])[A-Za-z0-9]{16,}+",
    "digits": r"(?<![0-9])(?<![0-9][ ().-])[0-9](?:[ ().-]{0,2}+[0-9]){6,}+",
}
_KIND_OF = {"keyed": "secret", "token": "secret", "digits": "number"}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# What proves a long digit group (a word before it that names a number of a person, or its format:
# national id, phone number without prefix) and what disproves it (a word that counts or names things).
_NUMBER_WORD = (r"(?i)(?<![a-z])(?:tele)?(?:phone|tel|call|fax|mobile|cell|account|acct|iban|ssn|social security|passport|"
                r"card|visa)(?![a-z])")
_COUNT_WORD = (r"(?i)(?<![a-z])(?:page|part|order|invoice|version|year|total|sum|item|serial|model|chapter|section|line|stock|"
               r"isbn|issn|price|date|since|until|about|nearly|over)(?![a-z])[^A-Za-z]{0,8}$|[$€£]\s?$")
_NUMBER_FORMAT = (r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$|"
                  r"^(?:1[ .-])?[2-9][0-9]{2}[ .-][2-9][0-9]{2}[ .-][0-9]{4}$")
_PREFIX = r"^(?:AKIA|ASIA)[A-Z0-9]{16}$|^(?:ghp|gho|xoxb|sk)[A-Za-z0-9]{20,}$"
#: So many different characters, digits among them, prove a keyed value; so few disprove a token.
_VARIED, _PLAIN = 9, 6

#: Binned features with their number of bins; their product bounds the cells.
FEATURES = {"length": 6, "digit_share": 5, "upper_share": 3, "mark": 4, "before": 4, "after": 3, "groups": 4, "first": 4, "last": 4}
MAX_CELLS = int(np.prod(list(FEATURES.values())))
#: The kinds that evidence and trees decide, by their generators.
LEARNED = {"secret": ("keyed", "token"), "number": ("digits",)}


def _gates(t: Column) -> dict[str, Column]:
    """Cheap tests that a text without any match fails."""
    digit = t.rlike("[0-9]")
    return {"email": F.contains(t, F.lit("@")), "ip": digit & t.rlike(r"[0-9]\.[0-9]"), "card": digit,
            "phone": digit & F.contains(t, F.lit("+")),
            "keyed": F.contains(t, F.lit("=")) | F.contains(t, F.lit(":")), "token": digit, "digits": digit}


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def with_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` plus one array per generator: struct(s, e, m, b, a) of place, match and context.

    The pieces between matches and the matches alternate, so a match starts at the sum of the
    lengths before it; sums of whole blocks keep this near linear in the number of matches.
    """
    def block(g: str):
        return lambda k: _total(F.slice(f"l_{g}", k * _BLOCK + 1, F.lit(_BLOCK)))

    def before_block(g: str):
        return lambda x, k: _total(F.slice(f"p_{g}", F.lit(1), k))

    names, keep, gates = list(GENERATORS), df.columns, _gates(F.col(text))
    none = F.array().cast("array<string>")
    a = df.select(*keep, *[c for g in names for c in (
        F.when(gates[g], F.regexp_extract_all(text, F.lit(GENERATORS[g]), F.lit(0))).otherwise(none).alias(f"m_{g}"),
        F.when(gates[g], F.split(text, GENERATORS[g])).otherwise(none).alias(f"g_{g}"))])
    both = [f"{x}_{g}" for g in names for x in "mg"]
    b = a.select(*keep, *both, *[F.zip_with(
        f"m_{g}", F.slice(f"g_{g}", F.lit(1), F.size(f"m_{g}")),
        lambda m, p: F.char_length(m) + F.char_length(p)).alias(f"l_{g}") for g in names])
    lens = [f"l_{g}" for g in names]
    c = b.select(*keep, *both, *lens, *[F.transform(
        F.sequence(F.lit(0), F.floor(F.size(f"l_{g}") / _BLOCK).cast("int")),
        block(g)).alias(f"p_{g}") for g in names])
    d = c.select(*keep, *both, *lens, *[F.transform(f"p_{g}", before_block(g)).alias(f"p_{g}") for g in names])

    def place(g: str):
        def at(m: Column, i: Column) -> Column:
            before = (F.get(f"p_{g}", F.floor(i / _BLOCK).cast("int"))
                      + _total(F.slice(f"l_{g}", i - i % _BLOCK + 1, i % _BLOCK)) + F.char_length(F.get(f"g_{g}", i)))
            return let(before, lambda s: F.struct(
                s.alias("s"), (s + F.char_length(m)).alias("e"), m.alias("m"),
                F.right(F.get(f"g_{g}", i), F.lit(24)).alias("b"), F.left(F.get(f"g_{g}", i + 1), F.lit(1)).alias("a")))
        return at

    return d.select(*keep, *[F.transform(f"m_{g}", place(g)).alias(g) for g in names])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def add(acc: Column, i: Column) -> Column:
        v = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(v > 4, v * 2 - 9).otherwise(v * 2)
        return acc + F.when(i % 2 == 0, twice).otherwise(v)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(g: str, m: Column) -> Column:
    """The base rules."""
    if g == "email":
        return F.lit(True)
    if g == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if g == "card":
        return let(_digits(m), lambda d: F.when((F.char_length(d) >= 12) & (F.char_length(d) <= 19), luhn(d))
                   .otherwise(F.lit(False)))
    if g == "phone":
        return F.char_length(_digits(m)).between(9, 15)
    return F.lit(False)


def _value(x: Column) -> Column:
    """The value of a keyed secret; other matches as they are."""
    return F.regexp_extract(x["m"], r"[A-Za-z0-9+/_.-]+$", 0)


def _label(g: str, x: Column) -> Column:
    """1 proven, 0 disproven, null unknown. None of this evidence is a feature."""
    if g in BASE_KINDS:
        return F.lit(None).cast("int")
    if g == "digits":
        proven = x["b"].rlike(_NUMBER_WORD) | x["m"].rlike(_NUMBER_FORMAT)
        return F.when(proven, F.lit(1)).when(x["b"].rlike(_COUNT_WORD), F.lit(0))
    v = _value(x) if g == "keyed" else x["m"]
    varied = F.size(F.array_distinct(F.split(v, "")))
    if g == "keyed":
        return F.when((varied >= _VARIED) & v.rlike("[0-9]"), F.lit(1)).when(~v.rlike("[0-9A-Z]"), F.lit(0))
    return F.when(v.rlike(_PREFIX), F.lit(1)).when((varied <= _PLAIN) | ~v.rlike("[0-9]"), F.lit(0))


def _features(g: str, x: Column) -> Column:
    m = _value(x) if g == "keyed" else x["m"]
    n = F.char_length(m)
    cut = lambda v, *at: reduce(lambda a, b: a + F.when(v >= b, F.lit(1)).otherwise(F.lit(0)), at, F.lit(0))
    share = lambda p: F.char_length(F.regexp_replace(m, p, "")) / n
    # a keyed value follows its mark
    last = F.substring(x["m"], F.char_length(x["m"]) - n, F.lit(1)) if g == "keyed" else F.right(x["b"], F.lit(1))
    side = lambda c: F.when(F.coalesce(c, F.lit("")) == "", F.lit(0)).when(
        c.rlike(r"[\x20\x09-\x0D]"), F.lit(1)).otherwise(F.lit(2))
    parts = F.split(m, "[ ().-]+")
    return F.struct(
        cut(n, 10, 14, 18, 24, 40).alias("length"), cut(share("[^0-9]+"), 0.2, 0.5, 0.75, 1.0).alias("digit_share"),
        cut(share("[^A-Z]+"), 0.1, 0.5).alias("upper_share"),
        F.when(m.rlike("[ ()]"), F.lit(3)).when(F.contains(m, F.lit(".")), F.lit(2)).when(
            F.contains(m, F.lit("-")), F.lit(1)).otherwise(F.lit(0)).alias("mark"),
        F.when(last.isin("=", ":", '"', "'"), F.lit(3)).otherwise(side(last)).alias("before"),
        side(x["a"]).alias("after"), cut(F.size(parts), 2, 3, 4).alias("groups"),
        cut(F.char_length(F.get(parts, F.lit(0))), 3, 4, 5).alias("first"),
        cut(F.char_length(F.element_at(parts, -1)), 3, 4, 5).alias("last"))


def with_candidates(df: DataFrame, text: str) -> DataFrame:
    """``df`` plus ``c``: all candidates of a text with kind, place, validity, label and features."""
    d = with_spans(df, text)

    def judge(g: str):
        def at(x: Column) -> Column:
            return let(_valid(g, x["m"]), lambda v: F.struct(
                x["s"].alias("s"), F.lit(KINDS.index(_KIND_OF.get(g, g))).alias("k"), x["e"].alias("e"),
                F.lit(g).alias("g"), v.alias("valid"), _label(g, x).alias("y"), _features(g, x).alias("f")))
        return at

    def untaught(base: Column):
        """A number in a base span is neither proven nor disproven."""
        def at(x: Column) -> Column:
            inside = (x["g"] == "digits") & F.exists(base, lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"]))
            return F.struct(*[x[n].alias(n) for n in ("s", "k", "e", "g", "valid")],
                            F.when(~inside, x["y"]).alias("y"), x["f"].alias("f"))
        return at

    d = d.select(*df.columns, F.concat(*[F.transform(g, judge(g)) for g in GENERATORS]).alias("c"))
    base = F.filter("c", lambda x: (x["k"] < len(BASE_KINDS)) & x["valid"])
    return d.select(*df.columns, let(base, lambda b: F.transform("c", untaught(b))).alias("c"))


# ------------------------------------------------------------------ boosted trees


@dataclass(frozen=True)
class Tree:
    """Depth two: at the root and in both branches a feature's bin is compared (``> bin`` goes right)."""

    root: tuple[int, int]
    left: tuple[int, int]
    right: tuple[int, int]
    leaves: tuple[float, float, float, float]


@dataclass(frozen=True)
class Model:
    bias: float
    trees: tuple[Tree, ...]
    slope: float
    shift: float
    threshold: float

    def probability(self, f: Column) -> Column:
        names = list(FEATURES)
        goes_right = lambda s: f[names[s[0]]] > s[1]
        total = F.lit(self.bias)
        for t in self.trees:
            a, b, c, d = (F.lit(float(x)) for x in t.leaves)
            total = total + F.when(goes_right(t.root), F.when(goes_right(t.right), d).otherwise(c)).otherwise(
                F.when(goes_right(t.left), b).otherwise(a))
        return 1.0 / (1.0 + F.exp(-(total * self.slope + self.shift)))

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for t in self.trees:
            r = x[:, t.root[0]] > t.root[1]
            lo, hi = x[:, t.left[0]] > t.left[1], x[:, t.right[0]] > t.right[1]
            out += np.array(t.leaves)[np.where(r, 2 + hi, lo.astype(int))]
        return out


def _best_split(x: np.ndarray, g: np.ndarray, h: np.ndarray, at: np.ndarray) -> tuple[float, tuple[int, int]]:
    best, split = 0.0, (0, 10**6)
    score = lambda a, b: a * a / (b + 1.0)
    whole = score(g[at].sum(), h[at].sum())
    for j, bins in enumerate(FEATURES.values()):
        gs, hs = (np.cumsum(np.bincount(x[at, j], v[at], bins)) for v in (g, h))
        for b in range(bins - 1):
            gain = score(gs[b], hs[b]) + score(gs[-1] - gs[b], hs[-1] - hs[b]) - whole
            if gain > best + 1e-9:
                best, split = gain, (j, b)
    return best, split


def boost(x: np.ndarray, pos: np.ndarray, neg: np.ndarray, cal_pos: np.ndarray, cal_neg: np.ndarray) -> Model | None:
    """Fit on cells ``x`` with numbers of positives and negatives; calibrate on the other fold's numbers."""
    if pos.sum() == 0 or neg.sum() == 0:
        return None
    n = pos + neg
    bias = float(np.log(pos.sum() / neg.sum()))
    logit, trees = np.full(len(x), bias), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-logit))
        g, h = pos - n * p, n * p * (1 - p)
        every = np.ones(len(x), bool)
        gain, root = _best_split(x, g, h, every)
        if gain <= 0:
            break
        right = x[:, root[0]] > root[1]
        (_, lo), (_, hi) = _best_split(x, g, h, ~right), _best_split(x, g, h, right)
        leaf = np.where(right, 2 + (x[:, hi[0]] > hi[1]), (x[:, lo[0]] > lo[1]).astype(int))
        value = [float(SHRINK * g[leaf == k].sum() / (h[leaf == k].sum() + 1.0)) for k in range(4)]
        trees.append(Tree(root, lo, hi, tuple(value)))
        logit = logit + np.array(value)[leaf]
    raw = Model(bias, tuple(trees), 1.0, 0.0, 0.5)
    z, a, b, m = raw.logits(x), 1.0, 0.0, cal_pos + cal_neg
    if cal_pos.sum() == 0 or cal_neg.sum() == 0:
        cal_pos, cal_neg, m = pos, neg, n
    for _ in range(50):  # logistic calibration by damped Newton steps
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        r, w = cal_pos - m * p, m * p * (1 - p) + 1e-9
        grad = np.array([(r * z).sum() - 1e-3 * (a - 1), r.sum() - 1e-3 * b])
        hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(hess, grad), -1, 1)
        a, b = a + step[0], b + step[1]
    p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
    order = np.argsort(-p, kind="stable")
    cp, cn = np.cumsum(cal_pos[order]), np.cumsum(cal_neg[order])
    last = np.append(p[order][1:] < p[order][:-1], True)  # a threshold takes all cells of equal score
    good = np.flatnonzero(last & (cp >= PRECISION * (cp + cn)) & (cp > 0))
    threshold = float(p[order][good[-1]]) if len(good) else 1.1
    return Model(bias, tuple(trees), float(a), float(b), threshold - 1e-9)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id and its judged candidates ``c``, found in one pass over the texts."""
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("t"))
    return with_candidates(d, "t").select("doc_id", "c")


def fit(found: DataFrame) -> dict[str, Model] | None:
    """A model per learned kind, trained on the candidates of all documents that evidence proves or disproves. A kind
    without both has none: only what is proven counts."""
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 5 == 0
    c = found.select(fold.alias("cal"), F.explode("c").alias("c"))
    one = lambda cal, y: F.sum(F.when((F.col("cal") == cal) & (F.col("y") == y), 1).otherwise(0))
    cells = (c.where(F.col("c.y").isNotNull()).select("cal", F.col("c.y").alias("y"), F.col("c.k").alias("k"), "c.f.*")
             .groupBy("k", *FEATURES).agg(one(False, 1).alias("p"), one(False, 0).alias("n"), one(True, 1).alias("cp"),
                                          one(True, 0).alias("cn")).collect())
    models = {}
    for kind in LEARNED:
        mine = sorted(r for r in cells if r["k"] == KINDS.index(kind))
        x = np.array([[r[f] for f in FEATURES] for r in mine], int).reshape(-1, len(FEATURES))
        model = boost(x, *[np.array([float(r[k]) for r in mine]) for k in ("p", "n", "cp", "cn")])
        if model is not None:
            models[kind] = model
    return models or None


# ------------------------------------------------------------------ spans


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find(found: DataFrame, models: dict[str, Model] | None) -> DataFrame:
    """Per document: numbers of base spans, the base spans and all spans as ``kind:start:end`` lists. Without ``models``
    the trees judge nothing: base spans and proven candidates remain."""
    c = found.select("doc_id", "c")
    brief = lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))
    base = F.transform(F.filter("c", lambda x: (x["k"] < len(BASE_KINDS)) & x["valid"]), brief)
    c = c.select("doc_id", "c", base.alias("base"))
    models = models or {}
    kind_of = {g: kind for kind, of in LEARNED.items() for g in of}

    def chosen(g: str, x: Column) -> Column:
        model = models.get(kind_of[g])
        unknown = model.probability(x["f"]) >= model.threshold if model else F.lit(False)
        return F.when(x["y"].isNotNull(), x["y"] == 1).otherwise(unknown)

    free = lambda col: lambda x: ~F.exists(col, lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"]))
    pick = lambda g, taken: lambda x: (x["g"] == g) & chosen(g, x) & free(taken)(x)
    for g in kind_of:  # a later generator doesn't overlap what is chosen
        taken = "base" if g == "keyed" else "taken"
        more = F.filter("c", pick(g, taken))
        c = c.select("doc_id", "c", "base", F.concat(F.col(taken), F.transform(more, brief)).alias("taken"))
    c = c.withColumnRenamed("taken", "all_spans")
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("bigint")
    return c.select("doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)],
                    _text(F.col("base")).alias("base_spans"), _text(F.col("all_spans")).alias("spans"))
