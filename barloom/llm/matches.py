"""Places of regular-expression matches in texts, by SQL functions alone.

Positions count code points from 0 and ends are exclusive. Patterns are Java's; they should
match no empty string, and repeat long groups possessively, as Java keeps a stack for others.
"""

from pyspark.sql import functions as F

PLACE = "array<struct<start:int,end:int,hit:string,part:string>>"


def places(text, pattern: str, group=0, present=None):
    """Array of the leftmost non-overlapping matches: (start, end, hit, part), part being a group.

    ``present`` is a cheap condition that every text with a match fulfils; by default, the
    pattern itself is tried first, so that texts without a match cost one search.
    """
    rule = F.lit(pattern)
    hits = F.regexp_extract_all(text, rule, F.lit(0))
    parts = hits if group == 0 else F.regexp_extract_all(text, rule, F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))

    def step(done, x):
        start = done["pos"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        one = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"), x["part"].alias("part"))
        return F.struct(end.alias("pos"), F.concat(done["out"], F.array(one)).alias("out"))

    found = F.aggregate(
        F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), parts.alias("part")),
        F.struct(F.lit(0).alias("pos"), F.array().cast(PLACE).alias("out")), step, lambda done: done["out"],
    )
    some = text.rlike(pattern) if present is None else present
    return F.when(some, found).otherwise(F.array().cast(PLACE))


def replaced(text, spans, mark: str):
    """The text with its spans (sorted by start, overlaps allowed) replaced by a mark."""
    def step(done, s):
        fresh = s["start"] >= done["pos"]
        gap = F.substring(text, done["pos"] + 1, s["start"] - done["pos"])
        out = F.when(fresh, F.concat(done["out"], F.array(gap, F.lit(mark)))).otherwise(done["out"])
        return F.struct(F.greatest(done["pos"], s["end"]).alias("pos"), out.alias("out"))

    def finish(done):
        tail = F.substring(text, done["pos"] + 1, F.length(text))
        return F.array_join(F.concat(done["out"], F.array(tail)), "")

    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)
