"""Personal data: high-recall candidates, boosted trees over format and context, redaction."""

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.boosting import Trees, calibration
from barloom.llm.matches import places, replaced

FOLDS, HELD_OUT = 5, 0
PRECISION = 0.99
LEFT, RIGHT = 24, 8
MARK = "[PERSONAL]"

# --- Fixed values: kinds, patterns and context words. Long repeats are possessive, and a pattern
# --- that could start anywhere in a run starts at the run's edge or where the last match ended.
KINDS = ["email", "ip", "card", "phone"]
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What every text with a match fulfils, so that most texts need no extraction.
PRESENT = {
    "email": r"[A-Za-z0-9]@[A-Za-z0-9-]|[._%+-]@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){15}",
    "phone": r"\+[0-9][\x20().0-9-]",
}
GENERATORS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?:(?<![0-9])|\G)[0-9]{1,4}+(?:\.[0-9]{1,4}+){3,5}+",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20._-]?[0-9]){11,21}+",
    "phone": r"[(+]?[0-9](?:[\x20()./-]{0,2}+[0-9]){6,16}+",
}
CONTEXT = {
    "email": r"(?i)(?:e-?mail|contact|write|@)",
    "ip": r"(?i)(?:\bip\b|address|host|server)",
    "card": r"(?i)(?:card|visa|payment|account)",
    "phone": r"(?i)(?:phone|\btel|call|mobile|fax)",
}
#: Forms of a phone number that stand for themselves: of North America, with the area's trunk zero in brackets,
#: and with the international prefix. Digits that nothing parts are no evidence.
PHONE_FORM = (
    r"^(?:(?:\+?1[\x20./-]{0,2})?(?:\([2-9][0-9]{2}\)[\x20./-]{0,2}|[2-9][0-9]{2}[\x20./-])[2-9][0-9]{2}[\x20./-][0-9]{4}"
    r"|\(0[1-9][0-9]{1,4}\)\x20?[1-9][0-9]{2,4}[\x20/-]?[0-9]{2,5}"
    r"|00\x20?[1-9][0-9]{0,2}[\x20./-][\x20()./0-9-]+)$"
)
# --- End of fixed values. ---

FEATURES = ["family", "digits", "separators", "first", "last", "left", "right", "named", "varied", "repeated"]
#: The features by view, and the upper ends of the classes of those that count something.
VIEWS = {"format": ["digits", "separators", "varied"], "grouping": ["first", "last"], "neighbours": ["left", "right"],
         "context": ["named", "repeated"]}
CLASSES = {"digits": [0, 7, 9, 10, 11, 12, 15, 19], "separators": [0, 1, 2, 3, 4], "first": [1, 2, 3, 4], "last": [1, 2, 3, 4],
           "varied": [2, 5], "repeated": [1, 4]}


def digits_of(hit):
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit):
    """True if the digits of the text pass the Luhn check."""
    figures = F.transform(F.split(F.reverse(digits_of(hit)), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def small_parts(hit):
    """True if no dotted part is above 255."""
    fits = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
    return F.forall(F.split(hit, r"\."), lambda p: p.rlike(fits))


def valid(kind, hit):
    """What a base match has to fulfil beside its pattern."""
    n = F.length(digits_of(hit))
    if kind == "ip":
        return small_parts(hit)
    if kind == "card":
        return n.between(16, 19) & luhn(hit)
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def base_places(text, kind):
    present = text.rlike(PRESENT[kind])
    return F.filter(places(text, BASE[kind], 0, present), lambda h: valid(kind, h["hit"]))


def generated(text, kind):
    """Candidates of a kind. Numbers that are part of a longer word are none."""
    found = places(text, GENERATORS[kind], 0, text.rlike(GENERATORS[kind]))
    if kind == "email":
        return found
    inner = r"^[\p{L}0-9]$"
    return F.filter(found, lambda p: ~((p["start"] > 0) & F.substring(text, p["start"], 1).rlike(inner))
                    & ~F.substring(text, p["end"] + 1, 1).rlike(inner))


def _side(char):
    """Class of a neighbouring character: 0 none or space, 1 a mark of prose, 2 other."""
    return F.when((char == "") | char.rlike(r"^\s$"), 0).when(char.rlike(r"""^[.,;:!?()"']$"""), 1).otherwise(2)


def evident(kind, hit):
    """True if a candidate passes its kind's format check, at/dot written out and separators left aside.

    What stands around it does not count, and no base match is needed. This labels candidates for training; the
    model does not see it.
    """
    number = digits_of(hit)
    if kind == "email":
        return hit.rlike(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$")
    if kind == "ip":
        return (F.size(F.split(hit, r"\.")) == 4) & small_parts(hit)
    if kind == "card":
        return F.length(number).between(16, 19) & luhn(hit)
    return F.length(number).between(8, 15) & (hit.startswith("+") | hit.rlike(PHONE_FORM))


def _classed(name, count):
    """The class of a count by ``CLASSES``, from 0."""
    ends = CLASSES[name]
    classed = F.lit(len(ends))
    for at in range(len(ends) - 1, -1, -1):
        classed = F.when(count <= ends[at], at).otherwise(classed)
    return classed


def described(kind, text, place, candidates):
    """Format and context of one candidate as small integers by the names of ``FEATURES``, and ``evident``.

    ``candidates`` counts those of the kind in the text. Checksums, top-level domains and the forms of numbers are
    evidence for the label alone and no feature.
    """
    hit = F.regexp_replace(F.regexp_replace(place["hit"], r"\x20?[\[(]at[\])]\x20?", "@"), r"\x20?[\[(]dot[\])]\x20?", ".")
    number = digits_of(hit)
    groups = F.filter(F.split(hit, r"[^\p{L}0-9]+"), lambda g: g != "")
    before = F.substring(text, F.greatest(place["start"] - LEFT, F.lit(0)) + 1, F.least(place["start"], F.lit(LEFT)))
    after = F.substring(text, place["end"] + 1, RIGHT)
    left, right = _side(F.substring(before, -1, 1)), _side(F.substring(after, 1, 1))
    values = {
        "family": F.lit(KINDS.index(kind)),
        "digits": _classed("digits", F.length(number)),
        "separators": _classed("separators", F.length(F.regexp_replace(hit, r"[\p{L}0-9]", ""))),
        "first": _classed("first", F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0))),
        "last": _classed("last", F.coalesce(F.length(F.get(groups, F.size(groups) - 1)), F.lit(0))),
        "left": left,
        "right": right,
        "named": before.rlike(CONTEXT[kind]).cast("int"),
        "varied": _classed("varied", F.size(F.array_distinct(F.split(number, "")))),
        "repeated": _classed("repeated", candidates),
    }
    return [*[values[n].cast("int").alias(n) for n in FEATURES], evident(kind, hit).cast("int").alias("evident")]


def _overlaps(place, spans):
    return F.exists(spans, lambda s: (s["start"] < place["end"]) & (place["start"] < s["end"]))


def _same(place, spans):
    return F.exists(spans, lambda s: (s["start"] == place["start"]) & (s["end"] == place["end"]))


def counted_features(df: DataFrame, key="doc_id", text="text") -> DataFrame:
    """Every candidate of the table, counted by features and by whether its text is held out, with the evident
    ones and base matches among them.

    The features take few values, so the rows of this table are bounded by their combinations, at most a few
    hundred thousands and in practice some thousands, however many texts there are.
    """
    own = F.coalesce(F.col(text), F.lit(""))
    fold = F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))
    rows = df.select((fold == HELD_OUT).alias("held"), own.alias("_text"))
    # The base matches first, as columns of their own, so that none is looked for again per candidate.
    rows = rows.select("*", *[base_places(F.col("_text"), k).alias(f"base_{k}") for k in KINDS],
                       *[generated(F.col("_text"), k).alias(f"wide_{k}") for k in KINDS])

    def seen(kind):
        wide = F.col(f"wide_{kind}")
        return F.transform(wide, lambda p: F.struct(
            *described(kind, F.col("_text"), p, F.size(wide)), _same(p, F.col(f"base_{kind}")).cast("int").alias("base")))

    every = rows.select("held", F.inline(F.concat(*map(seen, KINDS))))
    positive = F.greatest("evident", "base")
    return every.groupBy("held", *FEATURES).agg(F.count("*").alias("n"), F.sum(positive).alias("positives"))


@dataclass(frozen=True)
class Model:
    """Trees, calibration, and for each kind the least margin of candidates to redact (None: none)."""

    trees: Trees
    slope: float
    offset: float
    limits: dict


def train(df: DataFrame, key="doc_id", text="text", precision=PRECISION) -> Model | None:
    """A model of all candidates of a table; positives are the evident ones and base matches.

    The label rests on checksums, top-level domains and the forms of numbers; the trees see separators, grouping,
    neighbours, context words and repetition. So a candidate is taken for standing like those that pass their check,
    whether it passes or not, and one that passes by chance where most do not is left. Trees learn from all folds but one. That one calibrates the probabilities and gives each kind its
    threshold: the least probability above which at least ``precision`` of its candidates are
    positive. A kind without such a threshold, or a table without positives, redacts base
    matches only.
    """
    rows = [
        (r.held, tuple(r[f] for f in FEATURES), r.n, r.positives)
        for r in counted_features(df, key, text).orderBy("held", *FEATURES).collect()
    ]
    fit = [r[1:] for r in rows if not r[0]]
    held = [r[1:] for r in rows if r[0]]
    if not held or not sum(p for _, _, p in fit):
        return None
    trees = Trees(fit)
    slope, offset = calibration(held, trees)
    limits = {}
    for at, kind in enumerate(KINDS):
        ranked = sorted(((trees.margin(f), n, p) for f, n, p in held if f[0] == at), reverse=True)
        count = good = 0
        for i, (margin, n, p) in enumerate(ranked):
            count, good = count + n, good + p
            last = i + 1 == len(ranked) or ranked[i + 1][0] < margin
            if last and good >= precision * count:
                limits[kind] = margin
    return Model(trees, slope, offset, limits)


def find(df: DataFrame, model: Model | None, key="doc_id", text="text") -> DataFrame:
    """``(row, base, more)``: every input row as a struct, the base spans, and what the model adds.

    Spans are structs (rank of the kind, start, end, kind, probability), sorted. Base spans always
    stay, with probability 1; a candidate is added if its kind's threshold is met and it
    overlaps no base span. Null and empty texts have none; repeated rows and null keys are kept.
    """
    rows = df.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.select("*", *[base_places(F.col("_text"), k).alias(f"base_{k}") for k in KINDS])
    scored_kinds = [(at, kind) for at, kind in enumerate(KINDS) if model and kind in model.limits]

    def span(place, at, chance):
        return F.struct(F.lit(at).alias("rank"), place["start"].alias("start"), place["end"].alias("end"),
                        F.lit(KINDS[at]).alias("kind"), chance.alias("probability"))

    def certain(at, kind):
        return F.transform(f"base_{kind}", lambda p: span(p, at, F.lit(1.0)))

    def added(at, kind):
        wide = F.col(f"wide_{kind}")
        free = F.filter(wide, lambda p: ~_overlaps(p, F.col("base")))
        shown = F.transform(free, lambda p: F.struct(
            p["start"].alias("start"), p["end"].alias("end"), *described(kind, F.col("_text"), p, F.size(wide))[:-1]))

        def scored(p):
            margin = model.trees.expression([p[n] for n in FEATURES])
            return span(p, at, 1 / (1 + F.exp(-(F.lit(model.slope) * margin + F.lit(model.offset)))))

        least = 1 / (1 + math.exp(-(model.slope * model.limits[kind] + model.offset))) - 1e-9
        return F.filter(F.transform(shown, scored), lambda s: s["probability"] >= least)

    taken = rows.select("row", "_text", F.concat(*[certain(*k) for k in enumerate(KINDS)]).alias("base"),
                        *[generated(F.col("_text"), kind).alias(f"wide_{kind}") for _, kind in scored_kinds])
    none = F.slice("base", 1, 0)
    return taken.select("row", F.array_sort("base").alias("base"),
                        F.array_sort(F.concat(none, *[added(*k) for k in scored_kinds])).alias("more"))


def redact(df: DataFrame, model: Model | None, key="doc_id", text="text", mark=MARK) -> DataFrame:
    """All rows and columns, with every span in the text replaced by a mark."""
    found = find(df, model, key, text)
    by_start = F.array_sort(F.transform(F.concat("base", "more"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    spans = found.select("row", by_start.alias("spans"))
    cleaned = spans.select("row", replaced(F.col(f"row.{text}"), F.col("spans"), mark).alias("cleaned"))
    return cleaned.select(*[
        (F.col("cleaned") if c == text else F.col("row").getField(c)).alias(c) for c in df.columns
    ])
