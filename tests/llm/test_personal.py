import random
import re

from barloom.llm import personal
from barloom.llm.boosting import Trees, calibration

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ROWS = [
    (1, "mail a.b@c.d_e@f.g, x@y and z@-.q."), (2, "1.2.3.4.5.6.7.8 300.1.1.1 0255.1.1.01 9.9.9"),
    (3, "4111 1111 1111 1111 and 4111-1111-1111-1112 and 41111111111111111"), (4, "+1 (555) 555-1234 +1 2 +123456789012345678"),
    (5, None), (6, ""), (None, "é😀 me@host.org"), (7, "a" * 300_000 + " 12 " * 20_000 + "b@c.dd"),
    (7, "1" * 200_000 + "." + "2.3.4"), (8, "a." * 60_000 + "@" + "b.c" * 60_000), (9, "same"), (9, "same"),
    (10, "@" * 50 + "+" * 50 + "+1" + "(" * 40_000),
]


def passes(kind, hit):
    number = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(number)))
        return 16 <= len(number) <= 19 and total % 10 == 0
    return kind != "phone" or 8 <= len(number) <= 15


def plain(text, kinds=personal.KINDS):
    return [(k, m.start(), m.end()) for k in kinds for m in re.finditer(PATTERNS[k], text or "") if passes(k, m[0])]


def test_base_spans_match_brute_force(docs):
    found = personal.find(docs(ROWS), None).collect()
    got = sorted(((r.row.doc_id, [(s.kind, s.start, s.end) for s in r.base]) for r in found), key=str)
    slow = {7, 8, 10}
    rows = [r for r in ROWS if r[0] not in slow]
    assert [g for g in got if g[0] not in slow] == sorted(((d, plain(t)) for d, t in rows), key=str)
    long_ones = [g for g in got if g[0] in slow]
    assert sorted(len(s) for _, s in long_ones) == [0, 0, 1, 1]
    assert all(not r.more for r in found) and personal.find(docs([]), None).count() == 0


def test_random_texts(docs):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choices("a1+@.- (29é_", k=60))) for i in range(400)]
    found = {r.row.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in personal.find(docs(rows), None).collect()}
    assert found == {d: plain(t) for d, t in rows}


def test_trees_and_calibration():
    rows = [((a, b), 20, 20 if a > 2 and b < 3 else 1) for a in range(6) for b in range(6)]
    trees = Trees(rows)
    assert min(trees.margin((a, b)) for a in (3, 5) for b in (0, 2)) > max(trees.margin((a, b)) for a, b in [(2, 0), (5, 3)])
    slope, offset = calibration(rows, trees)
    assert slope > 0 and abs(offset) < 3
    assert Trees([((1,), 5, 5)]).margin((1,)) > 0


def test_the_model_adds_likely_spans_and_leaves_base_spans(docs):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        number = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        rows.append((i, rng.choice([f"call +1 {number} now", f"part {rng.randint(10**6, 10**7)} now", f"ip 10.0.{i % 300}.7 now"])))
    model = personal.train(docs(rows))
    assert model is not None and "phone" in model.limits
    asked = docs([*rows, (1000, "call 1 (415) 555-2671 now"), (1001, "plain words")])
    found = {r.row.doc_id: r for r in personal.find(asked, model).collect()}
    for d, t in rows:
        assert [(s.kind, s.start, s.end) for s in found[d].base] == plain(t)
    assert not found[1001].more and all(0 <= s.probability <= 1 for r in found.values() for s in r.more)
    cleaned = {r.doc_id: r.text for r in personal.redact(docs(rows[:5]), model).collect()}
    assert all(("[PERSONAL]" in cleaned[d]) == bool(plain(t) or found[d].more) for d, t in rows[:5])
    assert personal.train(docs([])) is None and personal.train(docs([(1, "none")])) is None


def test_the_model_adds_what_no_base_rule_finds(docs):
    rng = random.Random(3)
    planted = ["call (415) 555-2671 now", "write jane (at) host (dot) org now", "card 4111.1111.1111.1111 now", "at 415-555-2671 now"]
    plain_words = ["part 4155552671 now", "look (at) this", "sum 4111.1111.1111.1112 now", "x415-555-2671", "on 2024-01-02 03:04", "v 1.2.3.400"]
    rows = []
    for i in range(1200):
        area, rest = rng.randint(200, 999), rng.randint(1000, 9999)
        rows.append((i, rng.choice([
            f"call +1 ({area}) 555-{rest} now", f"call ({area}) 555-{rest} now", f"at {area}-555-{rest} now", f"part {area}555{rest} now",
            f"write u{i}@host.org now", f"write u{i} (at) host (dot) org now", "look (at) this", f"on 20{i % 90 + 10}-01-{i % 28 + 1:02}",
            "card 4111 1111 1111 1111 now", "card 4111.1111.1111.1111 now", f"sum 4111.1111.1111.{rest} now", f"v 1.2.3.{i}"])))
    model = personal.train(docs(rows))
    asked = [(i, t) for i, t in enumerate([*planted, *plain_words])]
    found = {r.row.doc_id: r for r in personal.find(docs(asked), model).collect()}
    more = [[t[s.start:s.end] for s in found[d].more] for d, t in asked]
    assert more[:4] == [["(415) 555-2671"], ["jane (at) host (dot) org"], ["4111.1111.1111.1111"], ["415-555-2671"]]
    assert more[4:] == [[]] * len(plain_words) and not any(found[d].base for d in range(4))


def test_a_table_of_evident_candidates_alone(docs):
    rows = [(i, f"call (415) 555-{1000 + i} now") for i in range(60)]
    found = personal.find(docs(rows), personal.train(docs(rows))).collect()
    assert all([(s.kind, s.start, s.end) for s in r.more] == [("phone", 5, 19)] and not r.base for r in found)


def test_padded_middle_parts(docs):
    rows = [(1, "host 10.0002.3.4"), (2, "host 10.2.00003.4 up"), (3, "0.0.0.0"), (4, "1.0256.1.1")]
    found = {r.row.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in personal.find(docs(rows), None).collect()}
    assert found == {d: plain(t) for d, t in rows} and [len(found[d]) for d in (1, 2, 3, 4)] == [1, 1, 1, 0]


def test_the_model_learns_from_format_and_context_and_not_from_the_check(docs):
    """Cards among order numbers of the same form, a tenth of which pass the checksum by chance."""
    rng = random.Random(12)

    def luhn_end(digits):
        return next(d for d in "0123456789" if passes("card", digits + d))

    rows, planted = [], {}
    for i in range(1500):
        body = "".join(rng.choices("0123456789", k=15))
        number = body + (luhn_end(body) if i % 3 == 0 else rng.choice("0123456789"))
        shown = ".".join(number[k:k + 4] for k in range(0, 16, 4))
        word = rng.choice(["card", "visa", "payment"]) if i % 3 == 0 else rng.choice(["order", "part", "batch"])
        rows.append((i, f"{word} {shown} here"))
        if i % 3 == 0:
            planted[i] = shown
    rows += [(2000 + i, f"call ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} now") for i in range(200)]
    rows += [(3000 + i, f"write u{i} (at) host (dot) org and host 10.1.2.{i % 256}") for i in range(200)]
    model = personal.train(docs(rows))
    assert len(model.trees.used()) >= 3 and "evident" not in personal.FEATURES
    found = {r.row.doc_id: [t[s.start:s.end] for s in r.more if s.kind == "card"] for r, t in
             ((r, r.row.text) for r in personal.find(docs(rows), model).collect())}
    hits = sum(found[i] == [n] for i, n in planted.items())
    wrong = sum(bool(found[i]) for i, _ in rows if i < 2000 and i not in planted)
    # The check alone would take a tenth of the order numbers.
    by_check = sum(passes("card", re.sub(r"\D", "", t)) for i, t in rows if i < 2000 and i not in planted)
    assert hits >= 0.97 * len(planted) and wrong <= 0.02 * (1000 + len(planted)) and by_check > 50


def test_every_view_counts(docs):
    """Leaving one view of the features out changes some margins."""
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        area, rest = rng.randint(200, 999), rng.randint(1000, 9999)
        rows.append((i, rng.choice([
            f"call ({area}) 555-{rest} now", f"at {area}-555-{rest} now", f"part {area}555{rest} now", f"x{area}-555-{rest} now",
            f"ref {area}-55-{rest}1 now", f"write u{i}@host.org now", "look (at) this", f"sum 4111.1111.1111.{rest} now",
            "card 4111.1111.1111.1111 now", f"card =4111.1111.1111.{rest}= now", f"v 1.2.3.{i} and 1.2.3.4 and 2.3.4.{i}",
            f"ip 10.0.0.{i % 256} up", f"id {rng.randint(10**15, 10**16)}"])))
    counted = [(tuple(r[f] for f in personal.FEATURES), r.n, r.positives) for r in personal.counted_features(docs(rows)).collect()]
    whole = Trees(counted)
    for names in personal.VIEWS.values():
        without = Trees([(tuple(0 if n in names else v for n, v in zip(personal.FEATURES, f)), n, p) for f, n, p in counted])
        margins = [(whole.margin(f), without.margin(tuple(0 if n in names else v for n, v in zip(personal.FEATURES, f)))) for f, _, _ in counted]
        assert max(abs(a - b) for a, b in margins) > 0.1, names


def test_added_spans_match_a_plain_scorer(docs):
    """Candidates found by Python's regular expressions and scored tree by tree."""
    rng = random.Random(3)
    rows = [(i, rng.choice(["call", "ref", "card", "x"]) + rng.choice([" ", "", "-"]) + "".join(rng.choices("0123456789", k=3)) + rng.choice("-. /")
             + "".join(rng.choices("23456789", k=3)) + rng.choice("-. ") + "".join(rng.choices("0123456789", k=4)) + " end") for i in range(700)]
    model = personal.train(docs(rows), precision=0.7)
    assert "phone" in model.limits
    described = {}
    frame = docs(rows).selectExpr("doc_id", "text")
    from pyspark.sql import functions as F
    wide = frame.select("doc_id", "text", personal.generated(F.col("text"), "phone").alias("wide"))
    for r in wide.select("doc_id", F.inline(F.transform("wide", lambda p: F.struct(
            p["start"].alias("start"), p["end"].alias("end"), *personal.described("phone", F.col("text"), p, F.size("wide")))))).collect():
        described[r.doc_id, r.start, r.end] = tuple(r[f] for f in personal.FEATURES)
    expected = sorted((d, s, e) for (d, s, e), f in described.items() if model.trees.margin(f) >= model.limits["phone"] - 1e-9
                      and not any(s < b and a < e for k, a, b in plain(dict(rows)[d])))
    got = sorted((r.row.doc_id, s.start, s.end) for r in personal.find(docs(rows), model).collect() for s in r.more if s.kind == "phone")
    assert got == expected and got
