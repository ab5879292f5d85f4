"""Personal data by candidate gradient boosting, in column expressions throughout.

Base patterns with validators give spans that always stay. Generators of high recall
propose further, overlapping spans in looser formats. Every candidate has format and
context features in small bins, among them its evidence: whether its normalised value
passes the validator of its format, and which cue word stands last before it. One
aggregate over all candidates of the corpus counts each feature vector with the share
that base spans confirm. Not being a base match is no label: candidates that fail their
validator or follow a contrary cue are false, confirmed ones and valid ones behind a cue of
their kind or in a format that stands for itself are true, and of the other valid ones the
share is estimated that is not valid by chance (``_expected``). Boosted trees are fitted to
that table on the driver, and for each format of a kind the lowest score at which the
expected precision of what is not confirmed already reaches ``PRECISION`` becomes the
threshold. Trees are then a column expression, so scoring stays in the JVM.

Patterns use possessive repeats and look-behinds where these change no match, so long
runs cost time linear in their length and no stack. Positions are code points; they come
from running sums of the lengths of the parts between matches, and what stands around a
candidate from those parts themselves. Overlaps are told by running maxima over sorted
spans. So the time of a text grows with its length and the number of its candidates (times
its logarithm), not with their product.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .rules import bind

#: Kinds in the order of ties.
KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
TREES, RATE, SUPPORT = 24, 0.3, 20

_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SEP = r"(?:@|\x20@\x20|\x20?(?:\(at\)|\[at\])\x20?)"
_DOT = r"(?:\.|\x20\.\x20|\x20?(?:\(dot\)|\[dot\])\x20?)"
_TIGHT = rf"[\p{{L}}{_LOCAL}]{{1,64}}+{_SEP}[\p{{L}}0-9-]{{1,63}}+(?:{_DOT}[\p{{L}}0-9-]{{1,63}}+){{1,8}}"
_SHORT6 = r"(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}"
#: Looser formats: named separators and other alphabets, colon addresses, grouped digits, numbers without plus.
GENERATORS = {
    "email": [rf"(?<![\p{{L}}{_LOCAL}])[\p{{L}}{_LOCAL}]{{1,64}}+\x20?(?:@|\(at\)|\[at\])\x20?[\p{{L}}0-9-]{{1,63}}+"
              r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[\p{L}0-9-]{1,63}+){0,8}+", rf"(?<![\p{{L}}{_LOCAL}]){_TIGHT}"],
    "ip": [r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){5,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f])",
           rf"(?<![0-9A-Za-z:.]){_SHORT6}(?![0-9A-Za-z:])"],
    "card": [r"(?<![0-9])[0-9]{4}(?:[\x20.-]?[0-9]{4}){2}[\x20.-]?[0-9]{2,7}(?![0-9])", r"(?<![0-9])[0-9]{4}[\x20.-][0-9]{6}[\x20.-][0-9]{4,5}(?![0-9])"],
    "phone": [r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])",
              r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"],
}
#: Share of random digits that pass the validator of a (kind, format); formats not named stand for themselves.
CHANCE = {("card", 0): 0.1, ("card", 1): 0.1, ("card", 2): 0.1, ("phone", 2): 0.64}
#: (kind, format) whose valid candidates without cue are as often true as those with one.
CUED = {("email", 2)}
#: Evidence of a candidate, in order.
INVALID, CONTRARY, NEUTRAL, CUE = range(4)
#: Cue words; the last one in ``AHEAD`` characters before a candidate counts.
AHEAD = 40
OWN = {
    "email": "e-?mail|mail|contact|write|reach|address|kontakt|correo|courriel",
    "ip": "ip|ipv[46]|address|server|host|adresse",
    "card": "cards?|visa|mastercard|amex|credit|debit|pay|paid|karte|kreditkarte|tarjeta|carte",
    "phone": "call|phones?|telephone|tel|fax|mobile|cell|dial|whatsapp|sms|reach|telefon|tel[eé]fono|t[eé]l[eé]phone|llamar?|appelez|anrufen",
}
AGAINST = (
    "orders?|invoices?|ref|reference|sku|isbn|issn|ean|part|serial|ticket|tracking|account|case|version|item|id|"
    "bestellung|commande|pedido|factura|facture|rechnung|artikel"
)
_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"
_CANDIDATE = "array<struct<start:int,kind:int,end:int,value:string,ahead:string,next:string>>"
#: Values of an array that one block of a running sum or maximum takes.
SCAN = 256
#: Characters of a piece that a text is cut into before spans are taken out.
CHUNK = 1024
#: Above any place in a text.
_FAR = 1 << 32


def _guard(kind: str, text: Column) -> Column:
    """A cheap test without which no pattern of the kind matches."""
    if kind == "email":
        return text.contains("@") | text.contains("(at)") | text.contains("[at]")
    return text.rlike("[0-9]")


def _running(values: Column, start: int, join: Callable[[Column, Column], Column]) -> Column:
    """What ``join`` (sum or max) makes of all earlier values, for each value of an array.

    Values are taken in blocks, so that arrays grow by steps of a block only and the work
    stays in proportion to the number of values.
    """
    none = F.expr("cast(array() as array<bigint>)")
    long = lambda c: c.cast("long")

    def upto(own: Column, first: Column) -> Column:
        zero = F.struct(long(first).alias("now"), none.alias("out"))
        step = lambda done, x: F.struct(long(join(done["now"], x)).alias("now"), F.concat(done["out"], F.array(done["now"])).alias("out"))
        return F.aggregate(own, zero, step, lambda done: done["out"])

    def total(own: Column) -> Column:
        return F.aggregate(own, F.lit(start).cast("long"), lambda done, x: long(join(done, x)))

    def all_(own: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / SCAN).cast("int")), lambda k: F.slice(own, k * SCAN + 1, SCAN))

        def within(cut: Column) -> Column:
            firsts = upto(F.transform(cut, total), F.lit(start))
            return bind(firsts, lambda at: F.flatten(F.transform(cut, lambda v, k: upto(v, at[k]))))

        return bind(blocks, within)

    return F.when(F.size(values) > 0, bind(F.transform(values, long), all_)).otherwise(none)


def _summed(values: Column) -> Column:
    return _running(values, 0, lambda a, b: a + b)


def _highest(values: Column) -> Column:
    return _running(values, -1, lambda a, b: F.greatest(a, b))


def _distinct(sorted_: Column) -> Column:
    """A sorted array without repeated elements."""
    return bind(sorted_, lambda s: F.filter(s, lambda x, k: (k == 0) | (x != F.get(s, k - 1))))


def _spans(text: Column, kind: str, pattern: str, context: bool = False) -> Column:
    """All matches in order, as (start, kind number, end, value).

    With ``context`` also ``ahead``, up to ``AHEAD`` characters before the match, and
    ``next``, the one behind it: both from what lies between the matches, so a text is
    passed over once however many matches it has.
    """
    empty = F.expr(f"cast(array() as {_CANDIDATE if context else _SPAN})")
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.zip_with(hits, gaps, lambda h, g: F.struct(F.coalesce(h, F.lit("")).alias("h"), g.alias("g")))

    def around(z: Column, x: Column, k: Column) -> list[Column]:
        earlier = F.transform(F.slice(z, F.greatest(k - AHEAD, F.lit(0)) + 1, F.least(k, F.lit(AHEAD))), lambda y: F.concat(y["g"], y["h"]))
        near = F.when(F.length(x["g"]) >= AHEAD, x["g"]).otherwise(F.concat(F.array_join(earlier, ""), x["g"]))
        after = F.concat(z[k + 1]["g"], z[k + 1]["h"])
        return [F.right(near, F.lit(AHEAD)).alias("ahead"), F.substring(after, 1, 1).alias("next")]

    def placed(z: Column) -> Column:
        known = F.slice(z, 1, F.greatest(F.size(z) - 1, F.lit(0)))  # what is left is the last gap
        before = _summed(F.transform(known, lambda x: F.length(x["g"]) + F.length(x["h"])))

        def one(at: Column) -> Column:
            def span(x: Column, k: Column) -> Column:
                lo = (at[k] + F.length(x["g"])).cast("int")
                base = [lo.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (lo + F.length(x["h"])).alias("end"), x["h"].alias("value")]
                return F.struct(*base, *(around(z, x, k) if context else []))

            return F.transform(known, span)

        return bind(before, one)

    return F.when(_guard(kind, text), bind(zipped, placed)).otherwise(empty)


def _luhn(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    size = F.length(digits)

    def add(total, i):
        d = F.substring(digits, size - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.when(size.between(14, 19), F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0).otherwise(False)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$")
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Validated matches of the base patterns, by start and kind."""

    def own(kind: str) -> Column:
        return F.filter(_spans(text, kind, BASE[kind]), lambda s: _valid(kind, s["value"]))

    return F.array_sort(F.concat(*map(own, KINDS)))


#: Feature names; all are small integers.
FEATURES = ("kind", "digits", "marks", "groups", "letters", "before", "after", "plus", "format", "evidence")


def _format(s: Column) -> Column:
    """The number of a candidate's format within its kind."""
    v = s["value"]
    email = F.when(v.rlike(r"\(at\)|\[at\]"), 1).when(v.contains(" @") | v.contains("@ "), 2).otherwise(0)
    ip = F.when(v.contains("::"), 2).when(v.contains(":"), 1).otherwise(0)
    card = F.when(v.contains("."), 2).when(v.rlike("[ -]"), 1).otherwise(0)
    phone = F.when(v.startswith("+"), 0).when(v.startswith("("), 1).otherwise(2)
    kinds = dict(zip(KINDS, (email, ip, card, phone)))
    return F.coalesce(*(F.when(s["kind"] == KINDS.index(k), x) for k, x in kinds.items()))


def _passes(s: Column, cued: Column) -> Column:
    """Whether a candidate's normalised value is valid for its format.

    A full colon address is no row of byte pairs, a short one lies in a prefix in use. Bare
    phone numbers follow the numbering plan, unless a cue says what they are.
    """
    v = s["value"]
    email = v.rlike(rf"^{_TIGHT}$") & v.rlike(r"(?:^|[^\p{L}])[\p{L}]{2,63}$")
    full = v.rlike("^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$") & ~v.rlike("^(?:[0-9A-Fa-f]{2}:){7}")
    short = v.rlike(rf"^{_SHORT6}$") & v.rlike("^(?:[23][0-9A-Fa-f]{3}|[fF][cdeCDE][0-9A-Fa-f]{2}):")
    short = short & (F.size(F.split(v, ":+")) <= 7)
    ip = F.when(v.contains("::"), short).when(v.contains(":"), full).otherwise(_valid("ip", v))
    plan = cued | v.rlike(r"^[(+]") | v.rlike("^[2-9][0-9]{2}[^0-9][2-9]")
    phone = plan & (_valid("phone", v))
    kinds = dict(zip(KINDS, (email, ip, _valid("card", v), phone)))
    return F.coalesce(*(F.when(s["kind"] == KINDS.index(k), x) for k, x in kinds.items()))


def _evidence(s: Column) -> Column:
    ahead = F.lower(s["ahead"])
    word = r"(?s)^(?:.*[^\p{L}\p{N}])?(%s)(?![\p{L}\p{N}])"
    lasts = []
    for k in KINDS:
        words = f"{OWN[k]}|{AGAINST}" if k in ("card", "phone") else OWN[k]
        lasts.append(F.when(s["kind"] == KINDS.index(k), F.regexp_extract(ahead, word % words, 1)))
    last = F.coalesce(*lasts)
    against = s["kind"].isin([KINDS.index(k) for k in ("card", "phone")]) & (last.rlike(f"^(?:{AGAINST})$") | ahead.rlike(r"#\x20?$"))
    cued = ~against & (last != "")
    return F.when(~_passes(s, cued), INVALID).when(against, CONTRARY).when(cued, CUE).otherwise(NEUTRAL)


def _class(c: Column) -> Column:
    """0 none, 1 letter, 2 digit, 3 space, 4 other."""
    return (
        F.when(c == "", 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2).when(c.rlike(r"^\s"), 3).otherwise(4)
    )


def _features(s: Column, hit: Column) -> Column:
    v = s["value"]
    marks = sum((F.when(v.contains(m), 1 << k).otherwise(0) for k, m in enumerate((" ", "-", ".", "(", ":", "@"))), F.lit(0))
    values = {
        "kind": s["kind"],
        "digits": F.least(F.length(F.regexp_replace(v, "[^0-9]", "")), F.lit(20)),
        "marks": marks,
        "groups": F.least(F.size(F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0))), F.lit(8)),
        "letters": v.rlike(r"\p{L}").cast("int"),
        "before": F.when(s["start"] == 0, 0).otherwise(_class(F.right(s["ahead"], F.lit(1)))),
        "after": _class(s["next"]),
        "plus": v.startswith("+").cast("int"),
        "format": _format(s),
        "evidence": _evidence(s),
    }
    columns = [values[n].cast("int").alias(n) for n in FEATURES]
    return F.struct(s["start"].alias("start"), s["end"].alias("end"), hit.alias("hit"), *columns)


def _touched(loose: Column, base: Column) -> Column:
    """The candidates, each with whether it overlaps a base span of its kind.

    Base spans of a kind do not overlap. So the last one that begins before a candidate ends
    reaches furthest, and a running maximum over both, by kind and place, tells.
    """
    row = lambda s, at, last, reach, own: F.struct(s["kind"].alias("kind"), at.alias("at"), F.lit(last).alias("last"), reach.alias("reach"), own.alias("own"))
    none = F.lit(None).cast(_CANDIDATE.removeprefix("array<").removesuffix(">"))
    far = lambda s, c: s["kind"].cast("long") * _FAR + s[c]
    of_base = F.transform(base, lambda s: row(s, s["start"], 1, far(s, "end"), none))
    of_loose = F.transform(loose, lambda s: row(s, s["end"], 0, F.lit(-1).cast("long"), s))

    def told(all_: Column) -> Column:
        reach = _highest(F.transform(all_, lambda x: x["reach"]))
        marked = lambda m: F.transform(all_, lambda x, k: F.struct(x["own"].alias("own"), (m[k] > far(x["own"], "start")).alias("hit")))
        return F.filter(bind(reach, marked), lambda x: x["own"].isNotNull())

    return bind(F.array_sort(F.concat(of_base, of_loose)), told)


def proposals(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` spans and candidate ``proposed`` spans with their features."""
    whole = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("base", base_spans(whole))
    loose = _distinct(F.array_sort(F.concat(*(_spans(whole, k, p, context=True) for k in KINDS for p in GENERATORS[k]))))
    out = out.withColumn("loose", loose)
    found = F.transform(_touched(F.col("loose"), F.col("base")), lambda x: _features(x["own"], x["hit"]))
    none = F.transform("loose", lambda s: _features(s, F.lit(False)))
    return out.withColumn("proposed", F.when(F.size("loose") > 0, found).otherwise(none)).drop("loose")


@dataclass
class Boosted:
    """Boosted trees of depth two over binned features.

    Thresholds are by kind plus the number of kinds times the format.
    """

    bias: float = 0.0
    trees: list[tuple] = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def score(self, x: dict[str, int]) -> float:
        s = self.bias
        for (f, c), left, right in self.trees:
            (g, d), lo, hi = left if x[f] <= c else right
            s += lo if x[g] <= d else hi
        return s

    def column(self, x) -> Column:
        """The score of a feature struct."""
        s = F.lit(self.bias)
        for (f, c), left, right in self.trees:
            sides = [F.when(x[g] <= d, lo).otherwise(hi) for (g, d), lo, hi in (left, right)]
            s = s + F.when(x[f] <= c, sides[0]).otherwise(sides[1])
        return s


def _best_split(rows: list[tuple], residual: list[float], weight: list[float]) -> tuple:
    """The split (feature, bin) of least squared error, weighted by curvature; None without one."""
    total_g, total_h = sum(residual), sum(weight)
    best, gain = None, 1e-9
    for f in range(len(rows[0][0]) if rows else 0):
        sums: dict[int, list[float]] = {}
        for (x, _, _), g, h in zip(rows, residual, weight):
            at = sums.setdefault(x[f], [0.0, 0.0])
            at[0] += g
            at[1] += h
        g = h = 0.0
        for c in sorted(sums)[:-1]:
            g, h = g + sums[c][0], h + sums[c][1]
            now = g * g / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
            if now > gain:
                best, gain = (f, c), now
    return best


def _threshold_key(x: tuple[int, ...]) -> int:
    at = FEATURES.index("format")
    return x[0] + len(KINDS) * (x[at] if at < len(x) else 0)


def boost(
    rows: list[tuple[tuple[int, ...], float, float]], trees: int = TREES, rate: float = RATE, precision: float = PRECISION,
    open_: list[tuple[float, float]] | None = None,
) -> Boosted:
    """Fit trees to (feature vector, count, expected true count) rows and calibrate the thresholds.

    ``open_`` holds for each row (count, expected true count) of the candidates that are to be
    decided; precision is theirs alone. A format with fewer than ``SUPPORT`` true candidates
    in all gets no threshold: it adds nothing.
    """
    model = Boosted()
    n, pos = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not n or not pos:
        return model
    model.bias = math.log((pos + 1) / (n - pos + 1))
    score = [model.bias] * len(rows)
    for _ in range(trees):
        p = [1 / (1 + math.exp(-s)) for s in score]
        g = [r[2] - r[1] * q for r, q in zip(rows, p)]
        h = [r[1] * q * (1 - q) for r, q in zip(rows, p)]
        root = _best_split(rows, g, h)
        if root is None:
            break
        sides = []
        for left in (True, False):
            own = [k for k, r in enumerate(rows) if (r[0][root[0]] <= root[1]) == left]
            sub = [rows[k] for k in own], [g[k] for k in own], [h[k] for k in own]
            cut = _best_split(*sub) or (root[0], 10**6)
            leaves = []
            for low in (True, False):
                at = [k for k in own if (rows[k][0][cut[0]] <= cut[1]) == low]
                leaves.append(rate * sum(g[k] for k in at) / (sum(h[k] for k in at) + 1))
                for k in at:
                    score[k] += leaves[-1]
            sides.append(((FEATURES[cut[0]], cut[1]), *leaves))
        model.trees.append(((FEATURES[root[0]], root[1]), *sides))
    decided = open_ or [(r[1], r[2]) for r in rows]
    for key in {_threshold_key(r[0]) for r in rows}:
        own = sorted(((s, r[2], *d) for s, r, d in zip(score, rows, decided) if _threshold_key(r[0]) == key), reverse=True)
        support, seen, right = sum(x[1] for x in own), 0.0, 0.0
        for k, (s, _, count, hit) in enumerate(own):
            seen, right = seen + count, right + hit
            last = k + 1 == len(own) or own[k + 1][0] < s
            if last and support >= SUPPORT and seen and right / seen >= precision:
                model.thresholds[key] = s - 1e-9
    return model


def _expected(table: list[tuple[tuple[int, ...], float, float]]) -> list[float]:
    """The expected share of true ones among the candidates of each vector that no base span confirms.

    Where random digits pass a validator with chance q, V valid and I invalid candidates
    without cue hold V - I q / (1 - q) that are not valid by chance.
    """
    at, of = FEATURES.index("evidence"), FEATURES.index("format")
    mass: dict[tuple, list[float]] = {}
    for x, n, hits in table:
        mass.setdefault((KINDS[x[0]], x[of]), [0.0] * 4)[x[at]] += n - hits
    neutral = {}
    for key, m in mass.items():
        if key in CHANCE:
            q = CHANCE[key]
            neutral[key] = max(0.0, 1 - m[INVALID] * q / (1 - q) / m[NEUTRAL]) if m[NEUTRAL] else 0.0
        elif key in CUED:
            neutral[key] = m[CUE] / (m[CUE] + m[CONTRARY] + m[INVALID]) if m[CUE] >= SUPPORT else 0.0
        else:
            neutral[key] = 1.0
    return [{CUE: 1.0, NEUTRAL: neutral[(KINDS[x[0]], x[of])]}.get(x[at], 0.0) for x, _, _ in table]


def fit(proposed: DataFrame, **options) -> Boosted:
    """Fit to the candidates of the whole corpus, counted by feature vector.

    The vectors are products of small bins, so their number does not grow with the corpus.
    Confirmed candidates that are themselves invalid or behind a contrary cue teach nothing.
    """
    each = proposed.select(F.explode("proposed").alias("c"))
    rows = each.groupBy(*(F.col(f"c.{n}").alias(n) for n in FEATURES)).agg(
        F.count("*").alias("n"), F.sum(F.col("c.hit").cast("int")).alias("hits")
    )
    table = sorted((tuple(r[: len(FEATURES)]), float(r["n"]), float(r["hits"])) for r in rows.collect())
    at = FEATURES.index("evidence")
    open_ = [(n - hits, (n - hits) * p) for (_, n, hits), p in zip(table, _expected(table))]
    sure = [hits if x[at] >= NEUTRAL else 0.0 for x, _, hits in table]
    return boost([(x, a + h, b + h) for (x, _, _), (a, b), h in zip(table, open_, sure)], open_=open_, **options)


def selected(proposed: DataFrame, model: Boosted) -> DataFrame:
    """Adds ``spans``: base spans and the candidates above their threshold.

    A candidate that touches a base span of its kind is that span already. Of touching
    candidates of a kind the longer one stays, then the better scored, then the earlier.
    """
    plain = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end")))
    if not model.thresholds:
        return proposed.withColumn("spans", plain)
    cut = F.lit(float("inf"))
    scored = F.transform(
        F.filter("proposed", lambda c: ~c["hit"]),
        lambda c: F.struct(
            (c["end"] - c["start"]).alias("size"), model.column(c).alias("score"), (-c["start"]).alias("back"),
            c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"),
            c["format"].alias("format"), c["evidence"].alias("evidence"),
        ),
    )

    def above(c):
        limit = cut
        for key, t in model.thresholds.items():
            limit = F.when(c["kind"] + len(KINDS) * c["format"] == key, t).otherwise(limit)
        return (c["score"] >= limit) & (c["evidence"] > CONTRARY)

    good = proposed.withColumn("good", F.filter(scored, above))
    by_place = F.array_sort(F.transform("good", lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c.alias("c"))))

    def clusters(all_: Column) -> Column:
        """Runs of candidates of a kind of which each touches an earlier one."""
        far = lambda x, c: x["kind"].cast("long") * _FAR + x["c"][c]
        reach = _highest(F.transform(all_, lambda x: far(x, "end")))

        def cut(m: Column) -> Column:
            first = F.filter(F.transform(all_, lambda x, k: F.when(far(x, "start") >= m[k], k)), lambda k: k.isNotNull())
            return bind(first, lambda at: F.transform(at, lambda lo, k: F.slice(all_, lo + 1, F.coalesce(F.get(at, k + 1), F.size(all_)) - lo)["c"]))

        return bind(reach, cut)

    def best(run: Column) -> Column:
        better = lambda c: lambda d: (d > c) & (d["start"] < c["end"]) & (c["start"] < d["end"])
        return F.filter(run, lambda c: ~F.exists(run, better(c)))

    alone = F.flatten(F.transform(bind(by_place, clusters), best))
    added = F.transform(alone, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    both = F.when(F.size("good") > 0, _distinct(F.array_sort(F.concat(plain, added)))).otherwise(F.array_sort(plain))
    return good.withColumn("spans", both).drop("good")


def _said(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def find(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans.

    Null text is empty and holds nothing; so does an empty table. Repeated rows and rows
    without id are documents of their own; other columns are ignored.
    """
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    kept = proposals(slim).drop("text")
    kept = stored(kept.withColumn("base", F.transform("base", lambda b: b.dropFields("value"))), "proposed")
    out = selected(kept, fit(kept))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = map(count, range(len(KINDS)))
    return out.select("doc_id", *counts, F.sha2(_said("base"), 256).alias("base_sha256"), _said("spans").alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every selected span of ``text`` replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first. Null text stays null. A column
    ``n_chars`` follows the new text.
    """
    columns = docs.columns
    work = proposals(docs.select(F.struct(*columns).alias("_row"), F.col("text").alias("text")))
    work = stored(work.withColumn("base", F.transform("base", lambda b: b.dropFields("value"))), "proposed")
    out = selected(work, fit(work))
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    size = F.length("text")

    def rebuilt(chunks: Column, s: Column, before: Column) -> Column:
        """What lies between the spans, cut from the chunks it is in, and the names of the spans."""

        def between(lo: Column, hi: Column) -> Column:
            first = F.floor(lo / CHUNK)
            some = F.array_join(F.slice(chunks, (first + 1).cast("int"), (F.floor((hi - 1) / CHUNK) - first + 1).cast("int")), "")
            return F.when(hi > lo, F.substring(some, (lo - first * CHUNK + 1).cast("int"), (hi - lo).cast("int"))).otherwise("")

        part = lambda x, k: F.when(x["start"] >= before[k], F.concat(between(F.greatest(before[k], F.lit(0)), x["start"]), names[x["kind"]])).otherwise("")
        end = F.greatest(F.element_at(before, -1), F.element_at(s, -1)["end"])
        return F.concat(F.array_join(F.transform(s, part), ""), between(end, size))

    ends = _highest(F.transform("spans", lambda x: x["end"]))
    chunks = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    clean = bind(ends, lambda m: bind(chunks, lambda c: rebuilt(c, F.col("spans"), m)))
    clean = F.when(F.size("spans") > 0, clean).otherwise(F.col("text"))
    values = {"text": F.col("_clean")}
    if "n_chars" in columns:
        values["n_chars"] = F.when(F.size("spans") > 0, F.length("_clean")).otherwise(F.col("_row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("_clean", clean).select(*(values.get(c, F.col(f"_row.`{c}`")).alias(c) for c in columns))
