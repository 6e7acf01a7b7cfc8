"""Personal data by candidate gradient boosting; DataFrame functions only.

Four strict kinds (email, ip, card, phone) are found by pattern and check, and always stay. Beyond them, high-recall
generators propose spans that may overlap; each candidate gets format and context features, boosted trees score it, and
a threshold per kind, calibrated for precision on held-out examples, selects. A selected span that overlaps a strict one,
or a better one, is not added. The trees are fitted on the driver from a fixed number of generated, labelled examples
that pass through the same feature columns; on the corpus they are CASE expressions inside the projection. There is no
shuffle.

Patterns are written without repeated groups, so long texts cannot exhaust the stack: separators that such a group would
allow are first turned into characters of their own, which keeps all places. A text is cut once per kind into matches and
what stands between them; places, contexts and overlaps come from running sums over the pieces, so work grows little
faster than the text even where all of it is matches.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.functions.text import let, pieces, running_least, running_most, running_sums

BASE_KINDS = ("email", "ip", "card", "phone")
#: generators of further candidates; an iban has at most 34 characters by its standard, nothing else has a limit of length
GENERATORS = {
    "email_spelled": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[(\[]at[)\]] ?| at |@)[A-Za-z0-9-]++\x01++[A-Za-z0-9-][A-Za-z0-9\x01-]*+",
    "phone_local": r"(?<![0-9A-Za-z+.-])(?<![0-9][ ])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![ .-]?[0-9A-Za-z]{0,1}[0-9])(?![0-9A-Za-z])",
    "id_number": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
}
KINDS = (*BASE_KINDS, *GENERATORS)
SPAN = "array<struct<start:int,kind:int,end:int>>"
CONTEXT = 24
CONTEXT_WORDS = {
    "near_contact": r"(?i)\b(?:tel|phone|call|fax|mobile|contact|mail|reach|write)",
    "near_identity": r"(?i)\b(?:ssn|social|passport|tax|identity|insurance|iban|account|bank)",
    "near_secret": r"(?i)(?:token|secret|key|password|passwd|api|auth|bearer)",
    "near_number": r"(?i)\b(?:page|part|row|table|model|version|case|no|number|item|serial|figure|chapter)",
}
FEATURES = ("kind", "digits", "letters", "capitals", "marks", "size", "variety", "turns", *(f"{w}_{side}" for side in ("before", "after") for w in CONTEXT_WORDS))


def _free_of_marks(text: Column) -> Column:
    """The text with the two characters used as marks replaced by one that no pattern takes."""
    return F.replace(F.replace(text, F.lit("\x01"), F.lit("\x02")), F.lit("\x03"), F.lit("\x02"))


FOUND = "array<struct<start:int,kind:int,end:int,own:string,before:string,after:string>>"


def _located(text: Column, pattern: str, kind: int) -> Column:
    """All leftmost non-overlapping matches as (start, kind, end, own, before, after): places in code points, the match,
    and up to CONTEXT characters on both sides. The text is free of marks but for those the pattern means."""

    def spans(s: Column) -> Column:
        at = running_sums(F.transform(s, F.length))
        odd = F.sequence(F.lit(1), F.size(s) - 1, F.lit(2))
        side = lambda i, places: F.concat(*[F.coalesce(F.get(s, i + d), F.lit("")) for d in places])

        def one(i: Column, a: Column) -> Column:
            start, own = F.get(a, i).cast("int"), F.get(s, i)
            before, after = F.right(side(i, (-3, -2, -1)), F.lit(CONTEXT)), F.left(side(i, (1, 2, 3)), F.lit(CONTEXT))
            return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(own)).alias("end"), own.alias("own"), before.alias("before"), after.alias("after"))

        return let(at, lambda a: F.transform(odd, lambda i: one(i, a)))

    return let(pieces(text, pattern), lambda s: F.when(F.size(s) > 1, spans(s)).otherwise(F.array().cast(FOUND)))


def _bare(found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def worth(a: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return a + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), worth) % 10 == 0


def _strict(own: Column) -> list[Column]:
    """Spans of the four strict kinds in a text free of marks."""
    none = F.array().cast(SPAN)
    dotted = F.regexp_replace(own, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", "\x01")
    local = r"A-Za-z0-9._%+\x01-"
    email = _located(dotted, rf"(?:\G|(?<![{local}]))[{local}]++@[A-Za-z0-9-]++\x01[A-Za-z0-9\x01-]++", 0)
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    ip = F.filter(_located(own, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 1), lambda s: F.rlike(s["own"], F.lit(rf"^{part}\.{part}\.{part}\.{part}$")))
    joined = F.regexp_replace(own, "(?<=[0-9])[ -](?=[0-9])", "\x01")

    def is_card(s: Column) -> Column:
        return let(_digits(s["own"]), lambda d: F.length(d).between(14, 19) & F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))

    card = F.filter(_located(joined, r"[0-9][0-9\x01]++", 2), is_card)
    phone = F.filter(_located(own, r"\+[0-9][\x20().0-9-]+[0-9]", 3), lambda s: F.length(_digits(s["own"])).between(10, 15))
    return [
        F.when(F.contains(own, F.lit("@")), _bare(email)).otherwise(none),
        F.when(F.rlike(own, F.lit(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]")), _bare(ip)).otherwise(none),
        F.when(F.rlike(own, F.lit("(?:[0-9][ -]?){13}[0-9]")), _bare(card)).otherwise(none),
        F.when(F.rlike(own, F.lit(r"\+[0-9]")), _bare(phone)).otherwise(none),
    ]


def _spelled(own: Column) -> Column:
    """The text with every spelled or real dot between labels as marks of the same length."""
    t = own
    for left in ("", " "):
        for right in ("", " "):
            size = 5 + len(left) + len(right)
            t = F.regexp_replace(t, rf"(?<=[A-Za-z0-9-]){left}[(\[]dot[)\]]{right}(?=[A-Za-z0-9-])", "\x01" * size)
    t = F.regexp_replace(t, "(?<=[A-Za-z0-9-]) dot (?=[A-Za-z0-9-])", "\x01" * 5)
    return F.regexp_replace(t, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", "\x01")


def _candidates(own: Column) -> Column:
    """Proposed spans of all generators, with their features, in a text free of marks."""
    #: what a text must have for its generator to propose anything
    needs = {"email_spelled": F.contains(own, F.lit("dot")) & F.contains(own, F.lit("at")), "phone_local": F.rlike(own, F.lit(r"[0-9][0-9]\)?[ .-][0-9]{3}")), "id_number": F.rlike(own, F.lit("[0-9]-[0-9]{2}-[0-9]")), "secret": F.rlike(own, F.lit("[A-Za-z0-9_-]{20}")), "iban": F.rlike(own, F.lit("[A-Z]{2}[0-9]{2}"))}
    none = F.array().cast(FOUND)
    lists = [F.when(needs[k], _located(_spelled(own) if k == "email_spelled" else own, p, len(BASE_KINDS) + i)).otherwise(none) for i, (k, p) in enumerate(GENERATORS.items())]

    def features(s: Column) -> Column:
        t = s["own"]
        digits, letters, size = F.length(_digits(t)), F.length(F.regexp_replace(t, "[^A-Za-z]", "")), F.length(t)
        capitals = F.length(F.regexp_replace(t, "[^A-Z]", ""))
        variety = F.size(F.array_distinct(F.split(t, "")))
        # how often letters and digits take turns: words do not, random text does
        turns = F.length(F.regexp_replace(F.regexp_replace(t, "[^0-9]+", "a"), "[0-9]+", "1"))
        near = [F.rlike(s[side], F.lit(p)).cast("int") for side in ("before", "after") for p in CONTEXT_WORDS.values()]
        values = [s["kind"], digits, letters, capitals, size - digits - letters, size, variety, turns, *near]
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.array(*[v.cast("int") for v in values]).alias("x"))

    return F.transform(F.concat(*lists), features)


def _examples(n: int, seed: int = 5) -> list[tuple[str, int]]:
    """Generated texts with one candidate each: personal (1) or not (0)."""
    r = random.Random(seed)
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    hexes = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))
    mixed = lambda k: "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(k))
    name = lambda k: "".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(k))
    good = [
        lambda: f"write to {name(6)} at {name(7)} dot com",
        lambda: f"{name(5)}.{name(4)} [at] {name(6)} [dot] org",
        lambda: f"call ({digits(3)}) {digits(3)}-{digits(4)} now",
        lambda: f"phone {digits(3)}-{digits(3)}-{digits(4)}",
        lambda: f"tel. {digits(4)} {digits(3)} {digits(4)}",
        lambda: f"his social security number is {digits(3)}-{digits(2)}-{digits(4)}",
        lambda: f"ssn {digits(3)}-{digits(2)}-{digits(4)}",
        lambda: f'token = "{hexes(40)}"',
        lambda: f"api_key: {name(8)}{digits(6)}{hexes(12)}",
        lambda: f"bearer {hexes(32)}",
        lambda: f"iban DE{digits(2)} {digits(4)} {digits(4)} {digits(4)} {digits(4)}",
        lambda: f"bank account GB{digits(2)}NWBK{digits(12)}",
        lambda: f"{digits(3)}-{digits(3)}-{digits(4)} is my mobile",
        lambda: f"{digits(3)}-{digits(2)}-{digits(4)} (social security)",
        lambda: f"{name(5)} at {name(6)} dot {name(4)} dot com, please",
        lambda: f"export SECRET={mixed(r.randint(32, 220))}",
        lambda: f"{mixed(r.randint(28, 64))} is the api key",
        lambda: f"password {mixed(24)}",
        lambda: f"sk_live_{mixed(24)}",
        lambda: f"{hexes(64)}",
    ]
    bad = [
        lambda: f"we met at {name(6)} dot matrix printers at {name(5)} dot points",
        lambda: f"measured at {name(3)} dot product {name(5)}",
        lambda: f"rows {digits(3)} {digits(3)} {digits(3)} of the table",
        lambda: f"in {digits(4)}-{digits(4)} {digits(3)} cases",
        lambda: f"pages {digits(3)}-{digits(3)}-{digits(3)}",
        lambda: f"part number {digits(3)}-{digits(2)}-{digits(4)} fits",
        lambda: f"{name(12)}-{name(9)}-{name(6)}",
        lambda: f"the word {name(24)} is long",
        lambda: f"______{name(20)}______",
        lambda: f"----------{'-' * 20}",
        lambda: f"model XC{digits(2)} {name(4).upper()} {name(4).upper()} {name(4).upper()}",
        lambda: f"AAAA {name(22)}",
        lambda: f"table {digits(2)} {digits(3)} {digits(3)} shows",
        lambda: f"item {digits(3)}-{digits(2)}-{digits(4)} in stock",
        lambda: f"{name(8)}_{name(9)}_{name(7)}_{name(5)}",
        lambda: f"{name(10).title()}{name(9).title()}{name(8).title()}",
        lambda: f"look at {name(5)}.{name(4)} dot {name(6)}",
        lambda: f"{name(30)} is one long word",
        lambda: f"see-{name(7)}-{name(6)}-{name(8)}-{digits(4)}",
        lambda: f"serial number {digits(4)}-{digits(4)}-{digits(4)}",
        lambda: f"{name(11)}-{digits(1)}-{name(13)}",
    ]
    return [(r.choice(good)(), 1) if i % 2 else (r.choice(bad)(), 0) for i in range(n)]


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 24, rate: float = 0.3) -> list:
    """Boosted trees of depth two for log loss: (feature, cut, (feature, cut, leaf, leaf), (feature, cut, leaf, leaf))."""
    score, trees = np.zeros(len(y)), []

    def best(g: np.ndarray, h: np.ndarray, rows: np.ndarray) -> tuple:
        top = (-1.0, 0, 0)
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1][:64]:
                left = rows & (x[:, f] <= cut)
                right = rows & ~left
                gain = g[left].sum() ** 2 / (h[left].sum() + 1) + g[right].sum() ** 2 / (h[right].sum() + 1)
                if gain > top[0] + 1e-12:
                    top = (gain, f, int(cut))
        return top[1:]

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        all_rows = np.ones(len(y), bool)
        f, cut = best(g, h, all_rows)
        tree = [f, cut]
        for side in (x[:, f] <= cut, x[:, f] > cut):
            sf, sc = best(g, h, side)
            leaves = []
            for rows in (side & (x[:, sf] <= sc), side & (x[:, sf] > sc)):
                leaf = float(rate * g[rows].sum() / (h[rows].sum() + 1))
                score[rows] += leaf
                leaves.append(leaf)
            tree.append((sf, sc, *leaves))
        trees.append(tuple(tree))
    return trees


def _predict(trees: list, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x))
    for f, cut, left, right in trees:
        for side, (sf, sc, a, b) in ((x[:, f] <= cut, left), (x[:, f] > cut, right)):
            out += np.where(side, np.where(x[:, sf] <= sc, a, b), 0)
    return out


def fit(spark: SparkSession, n_examples: int = 2400, precision: float = 0.98) -> tuple[list, list[float]]:
    """Trees, and for each kind the least score that keeps the precision on the examples not fitted on. A kind for which no
    score does would propose and never add, so that is an error."""
    made = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(_examples(n_examples))], "i int, text string, y int")
    rows = made.select("i", "y", F.explode(_candidates(_free_of_marks(F.col("text")))).alias("c")).select("i", "y", "c.x").orderBy("i").collect()
    x, y = np.array([r[2] for r in rows]), np.array([r[1] for r in rows])
    held = np.array([r[0] % 3 == 0 for r in rows])
    trees = _fit(x[~held], y[~held])
    s, thresholds = _predict(trees, x[held]), []
    for k in range(len(KINDS)):
        own = x[held][:, 0] == k
        order = np.argsort(-s[own])
        good = np.cumsum(y[held][own][order]) / np.arange(1, own.sum() + 1)
        ok = np.flatnonzero(good >= precision)
        if k >= len(BASE_KINDS) and not len(ok):
            raise ValueError(f"no threshold keeps {KINDS[k]} at a precision of {precision}")
        thresholds.append(float(max(0.0, s[own][order][ok[-1]])) if len(ok) else 0.0)
    return trees, thresholds


def _score(trees: list, x: Column) -> Column:
    def at(f: int) -> Column:
        return F.get(x, F.lit(f))

    total = F.lit(0.0)
    for f, cut, (lf, lc, a, b), (rf, rc, c, d) in trees:
        total = total + F.when(at(f) <= cut, F.when(at(lf) <= lc, a).otherwise(b)).otherwise(F.when(at(rf) <= rc, c).otherwise(d))
    return total


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def find(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Personal data of every row: doc_id, columns of ``keep`` (as keep_<name>), text, one array of spans per strict
    kind, base (those of all strict kinds by start, then kind) and spans (base and the added ones).

    A span is struct<start, kind, end>: code points from 0, end exclusive, kind an index of KINDS. Null text is empty
    and has no spans. Rows are independent; repeated ids and missing ids change nothing.
    """
    trees, thresholds = fit(docs.sparkSession)
    kept = [F.col(k).alias(f"keep_{k}") for k in keep]
    names = [f"keep_{k}" for k in keep]
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *kept, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = _free_of_marks(F.col("text"))
    strict = text.select("doc_id", *names, "text", *[c.alias(f"{k}_spans") for k, c in zip(BASE_KINDS, _strict(own), strict=True)], _candidates(own).alias("proposed"))
    scored = F.transform("proposed", lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), _score(trees, c["x"]).alias("score")))
    limits = F.array(*[F.lit(t) for t in thresholds])
    chosen = F.filter(scored, lambda c: c["score"] >= F.get(limits, c["kind"]))
    spans = [f"{k}_spans" for k in BASE_KINDS]
    both = strict.select("doc_id", *names, "text", *spans, F.array_sort(F.concat(*spans)).alias("base"), chosen.alias("chosen"))
    free = both.select("doc_id", *names, "text", *spans, "base", F.when(F.size("chosen") == 0, F.col("chosen")).otherwise(_apart(F.col("chosen"), F.col("base"))).alias("free"))

    def beaten(c: Column, o: Column) -> Column:
        earlier = (o["start"] < c["start"]) | ((o["start"] == c["start"]) & (o["kind"] < c["kind"]))
        return _overlap(o, c) & ((o["score"] > c["score"]) | ((o["score"] == c["score"]) & earlier))

    # candidates of a text that the trees chose and no strict span holds
    added = F.filter("free", lambda c: ~F.exists("free", lambda o: beaten(c, o)))
    return free.select("doc_id", *names, "text", *spans, "base", F.array_sort(F.concat("base", _bare(added))).alias("spans"))


def _apart(chosen: Column, base: Column) -> Column:
    """The chosen candidates that overlap no base span: along all spans by start, the farthest end of base spans before
    and the nearest start of base spans after tell."""
    entry = lambda s, c, score: F.struct(s["start"].alias("start"), c.alias("chosen"), s["kind"].alias("kind"), s["end"].alias("end"), score.alias("score"))
    every = F.array_sort(F.concat(F.transform(base, lambda s: entry(s, F.lit(0), F.lit(0.0))), F.transform(chosen, lambda s: entry(s, F.lit(1), s["score"]))))

    def kept(e: Column) -> Column:
        ends = running_most(F.transform(e, lambda s: F.when(s["chosen"] == 0, s["end"]).otherwise(0)))
        starts = running_least(F.transform(e, lambda s: F.when(s["chosen"] == 0, s["start"]).otherwise(1 << 30)))
        free = lambda z, a: F.filter(e, lambda s, i: (s["chosen"] == 1) & (F.get(z, i) <= s["start"]) & (F.get(a, i) >= s["end"]))
        got = let(ends, lambda z: let(starts, lambda a: free(z, a)))
        return F.transform(got, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["score"].alias("score")))

    return let(every, kept)


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


#: texts with more spans are taken apart into characters once, instead of being walked through for each span
FEW_SPANS = 64


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def replaced(cut, length: Column) -> Column:
        """cut(a, z): the text from a to z."""

        def pieces_of(s: Column, done: Column) -> Column:
            """done: the farthest end of the spans before each."""
            fresh = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.get(s, i)["start"] >= F.get(done, i))
            part = lambda i: F.concat(cut(F.get(done, i).cast("int"), F.get(s, i)["start"]), F.get(kinds, F.get(s, i)["kind"]))
            end = F.array_max(F.transform(s, lambda x: x["end"]))
            return F.concat(F.array_join(F.transform(fresh, part), ""), cut(end, length))

        return let(spans, lambda s: let(running_most(F.transform(s, lambda x: x["end"])), lambda done: pieces_of(s, done)))

    walked = replaced(lambda a, z: F.substring(text, a + 1, z - a), F.length(text))
    apart = let(F.split(text, ""), lambda c: replaced(lambda a, z: F.array_join(F.slice(c, a + 1, z - a), ""), F.length(text)))
    return F.when(F.size(spans) == 0, text).when(F.size(spans) <= FEW_SPANS, walked).otherwise(apart)
