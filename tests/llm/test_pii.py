import random
import re

from logsieve.llm.pii import find_pii, redacted

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def card(r):
    d = "".join(r.choice("0123456789") for _ in range(r.randrange(12, 19)))
    d += next(c for c in "0123456789" if luhn(d + c))
    return r.choice(["", " ", "-"]).join(d)


def random_text(r):
    parts = [
        lambda: f"{r.choice(['a', 'é', 'x.y_', '%', ''])}{r.choice('ab.')}@{r.choice(['b', 'b-c', ''])}.{r.choice(['de', 'f.gh', '', '_'])}",
        lambda: ".".join(str(r.choice([0, 1, 255, 256, "007", 99])) for _ in range(r.randrange(3, 7))),
        lambda: card(r),
        lambda: "".join(r.choice("0123456789 -") for _ in range(r.randrange(30))),
        lambda: "+" + "".join(r.choice("0123456789 ().-+") for _ in range(r.randrange(20))),
        lambda: r.choice(["word", "Ünï", "🙂🙂", "\n", "mail", "call", "@", "12"]),
    ]
    return r.choice(["", " "]).join(r.choice(parts)() for _ in range(r.randrange(10)))


def test_base_spans(spark):
    r = random.Random(5)
    texts = [None, "", "🙂 a@b.c_d@e.f", "1.2.3.4.5.6.7.8"] + [random_text(r) for _ in range(500)]
    texts += [" ".join(card(r) for _ in range(300))]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, texts[9], 1)] * 2, "doc_id long, text string, SPANS int")
    out = find_pii(docs)
    assert out.columns == ["doc_id", "text", "spans"]
    for row in out.withColumn("clean", redacted("text")).collect():
        base = [(s.kind, s.start, s.end) for s in row.spans if s.base]
        assert base == brute(row.text), row.text
        kinds = [s.base for s in row.spans]
        assert kinds == sorted(kinds, reverse=True)
        covered = {i for s in row.spans for i in range(s.start, s.end)}
        rest = re.sub(r"\[(EMAIL|IP|CARD|PHONE|NUMBER|MASKED|ACCOUNT)\]", "", row.clean or "")
        assert rest == "".join(c for i, c in enumerate(row.text or "") if i not in covered)


def test_long_texts(spark):
    texts = ["a" * 500_000, "1" * 500_000, "1." * 200_000, "a." * 200_000 + "@", "1 " * 200_000, "+1" + "(" * 300_000, "x@y" + ".z" * 200_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in find_pii(docs).select("doc_id", "spans").collect()}
    assert [len(got[i]) for i in (0, 1, 3, 4, 5)] == [0, 0, 0, 0, 0]
    assert len([s for s in got[2] if s.kind == "ip"]) == 50_000
    assert [(s.kind, s.start, s.end) for s in got[6]] == [("email", 0, len(texts[6]))]


def test_learned_spans(spark):
    """Cards with a wrong check digit look like the others and are added; plain numbers are not."""
    r = random.Random(9)
    rows = [(i, f"pay with card {card(r)} now") for i in range(0, 400)]
    rows += [(i, f"item {r.randrange(10**7, 10**8)}x of {r.randrange(10**6, 10**7)}") for i in range(400, 800)]
    wrong = "pay with card 4111111111111112 now"
    docs = spark.createDataFrame(rows + [(900, wrong)], "doc_id long, text string")
    got = {x.doc_id: x.spans for x in find_pii(docs).collect()}
    assert all(got[i] for i in range(400)) and not any(got[i] for i in range(400, 800))
    assert [(wrong[s.start : s.end], s.base) for s in got[900] if s.kind in ("card", "number")][0] == ("4111111111111112", False)


def test_empty(spark):
    assert find_pii(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def iban(r):
    body = "".join(r.choice("0123456789") for _ in range(18))
    n = int(body + "131400") % 97
    return f"DE{98 - n:02d}{body}"


def test_generators_with_checks_of_their_own(spark):
    """Masked emails and account numbers overlap no base span, and are added."""
    r = random.Random(3)
    rows = [(i, f"write to user{i} [at] mail{i % 7} [dot] example [dot] com soon") for i in range(200)]
    rows += [(i, f"transfer to account {iban(r)} please") for i in range(200, 400)]
    rows += [(i, f"reach a@b{i}.org or meet me (at) noon, item {r.randrange(10**7, 10**8)}x") for i in range(400, 800)]
    got = {x.doc_id: [(s.kind, s.start, s.base) for s in x.spans] for x in find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(("masked", 9, False) in got[i] for i in range(200))
    assert all(("account", 20, False) in got[i] for i in range(200, 400))
    assert all([k for k, _, _ in got[i]] == ["email"] for i in range(400, 800))


def test_the_sample_is_not_taken_by_one_hot_vector(spark, monkeypatch):
    """A vector that is repeated often counts by its weight and leaves room for others of either label."""
    from logsieve.llm import pii

    monkeypatch.setattr(pii, "SAMPLE_ROWS", 40)
    r = random.Random(4)
    texts = ["item 1234567x here"] * 500 + ["pay with card 4111111111111111 now"] * 300
    texts += [f"mail {'a' * r.randrange(1, 30)}@b{'c' * r.randrange(9)}.org" for _ in range(100)]
    table = pii.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "text", ["doc_id"]).cache()
    found = table.selectExpr("explode(found) AS x").selectExpr("x.f.generator AS g", "x.right AS y").collect()
    sample = pii.sampled(table).collect()
    assert len({(s.label, *(s[f] for f in pii.FEATURES)) for s in sample}) == len(sample) <= 60
    assert {(s.generator, bool(s.label)) for s in sample} == {tuple(f) for f in found}
    hot = [s for s in sample if s.generator == pii.KINDS.index("card") + 1 and s.label]
    assert sum(s.weight for s in hot) == 300
