"""Secret scans through a trigram index: rules become Boolean trigram queries."""

import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.matches import places, replaced
from barloom.llm.storage import lookup

MARK = "[SECRET]"
CHOICES = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and the least length of its first group, or of the match."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


# --- Fixed values: patterns of secrets. ---
BASE_RULES = [
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]
MORE_RULES = [
    # To the END line over whatever stands between, encryption headers included. Where that is missing, over
    # a body that starts with a run of base64, or that the text ends in; else the header alone. Only
    # classes repeat without bound, so Java's stack does not grow with a body.
    Rule("private_key", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"
         r"(?:(?:[^-]+-){0,8}[^-]*-----END [A-Z ]{0,32}PRIVATE KEY-----"
         r"|[\s\\]*(?:n?(?:Proc-Type|DEK-Info):[^\r\n\\]*[\s\\]*){0,2}[A-Za-z0-9+/]{24,}[A-Za-z0-9+/=\s\\]*"
         r"|[A-Za-z0-9+/=\s\\]*$|)"),
    Rule("hosting", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("address", r"://[^\s:/@]+:[^\s/@]{3,}@"),
]
# --- End of fixed values. ---

RULES = [*BASE_RULES, *MORE_RULES]


def _strings(nodes) -> list[tuple]:
    """What a pattern spells: alternatives, each a tuple of characters and gaps (None)."""
    found = [()]
    for kind, value in nodes:
        name = str(kind)
        if name == "LITERAL":
            options = [(chr(value).lower(),)]
        elif name == "IN" and all(str(k) == "LITERAL" for k, _ in value) and len(value) <= 8:
            options = sorted({(chr(c).lower(),) for _, c in value})
        elif name == "SUBPATTERN":
            options = _strings(value[-1])
        elif name == "BRANCH":
            options = [s for branch in value[1] for s in _strings(branch)]
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = value
            once = _strings(inner)
            if (least, most) == (0, 1):
                options = [(), *once]
            elif least == 0:
                options = [(None,)]
            elif least == most == 1:
                options = once
            else:
                options = [(*s, None) for s in once]
        elif name == "AT":
            options = [()]
        else:
            options = [(None,)]
        if len(found) * len(options) > CHOICES:
            options = [(None,)]
        found = [a + b for a, b in product(found, options)]
    return found


def trigram_query(pattern: str) -> list[frozenset] | None:
    """Sets of trigrams of which a text that matches, put in lower case, holds one set at least.

    None if some way to match needs no trigram: such a rule has to scan every text.
    """
    clauses = set()
    for spelled in _strings(parser.parse(pattern)):
        runs = "".join("\0" if c is None else c for c in spelled).split("\0")
        grams = frozenset(r[i:i + 3] for r in runs for i in range(len(r) - 2))
        if not grams:
            return None
        clauses.add(grams)
    return sorted((c for c in clauses if not any(o < c for o in clauses)), key=sorted)


def postings(df: DataFrame, rules, key="doc_id", text="text") -> DataFrame:
    """The inverted index ``(gram, doc)`` of the trigrams that the rules ask for.

    ``doc`` is (key, hash of the text), so rows that share a key are indexed apart.
    """
    grams = sorted({g for r in rules for c in trigram_query(r.pattern) or [] for g in c})
    folded = df.select(_doc(key, text), F.lower(F.col(text)).alias("folded"))
    held = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(g)), F.lit(g)) for g in grams]))
    return folded.select(F.explode(held.cast("array<string>")).alias("gram"), "doc")


def _doc(key, text):
    return F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("text")).alias("doc")


def candidates(df: DataFrame, rules, key="doc_id", text="text") -> DataFrame:
    """``(doc, rules)``: the indexed rules whose trigram query the postings of a text fulfil."""
    asked = [
        (rule.kind, number, gram, 1 << bit, (1 << len(clause)) - 1)
        for rule in rules
        for number, clause in enumerate(trigram_query(rule.pattern) or [])
        for bit, gram in enumerate(sorted(clause))
    ]
    schema = "rule STRING, clause INT, gram STRING, bit BIGINT, full BIGINT"
    # As many rows as the rules have trigrams, whatever the size of the table.
    clauses = F.broadcast(df.sparkSession.createDataFrame(asked, schema))
    met = postings(df, rules, key, text).join(clauses, "gram").groupBy("doc", "rule", "clause", "full").agg(
        F.bit_or("bit").alias("held"))
    return met.where("held = full").groupBy("doc").agg(F.collect_set("rule").alias("rules"))


def find(df: DataFrame, rules=RULES, key="doc_id", text="text") -> DataFrame:
    """``(row, spans)``: every input row as a struct, and the secrets in its text.

    ``spans`` are structs (start, rank of the rule, end, kind), sorted. Rules with mandatory trigrams
    are verified on their candidates only, the others on every text. A null or empty text has
    no spans; rows with a null or repeated key are kept; an empty table gives an empty result.
    """
    # Candidates are few where secrets are; the texts are shuffled to them only if they are many.
    found = lookup(candidates(df, rules, key, text).withColumnRenamed("doc", "_doc"))
    rows = df.select(F.struct("*").alias("row"), _doc(key, text), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    joined = rows.join(found, F.col("doc") == F.col("_doc"), "left")

    def spans(rank, rule):
        present = F.col("_text").rlike(rule.pattern)
        if trigram_query(rule.pattern) is not None:
            present = F.coalesce(F.array_contains("rules", rule.kind), F.lit(False)) & present
        hits = places(F.col("_text"), rule.pattern, rule.group, present)
        long_enough = F.filter(hits, lambda h: F.length(h["part"]) >= rule.least)
        return F.transform(long_enough, lambda h: F.struct(
            h["start"].alias("start"), F.lit(rank).alias("rank"), h["end"].alias("end"), F.lit(rule.kind).alias("kind")))

    every = [spans(rank, rule) for rank, rule in enumerate(rules)]
    return joined.select("row", F.array_sort(F.concat(*every)).alias("spans"))


def redact(df: DataFrame, rules=RULES, key="doc_id", text="text", length="n_chars", mark=MARK) -> DataFrame:
    """All rows and columns, with every secret in the text replaced by a mark.

    ``length`` is brought up to date where the table has such a column and a secret was found.
    """
    found = find(df, rules, key, text)
    own = F.col(f"row.{text}")
    cleaned = found.select("row", "spans", replaced(own, F.col("spans"), mark).alias("cleaned"))
    columns = []
    for field in df.schema.fields:
        value = F.col("row").getField(field.name)
        if field.name == text:
            value = F.col("cleaned")
        elif field.name == length:
            value = F.when(F.size("spans") > 0, F.length("cleaned").cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return cleaned.select(*columns)
