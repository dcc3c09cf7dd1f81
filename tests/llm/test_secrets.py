import random
import re

from logsieve.llm.secrets import base_spans, find_secrets, worth_reading

RULES = [
    ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), lambda m: len(m[1]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def brute(text):
    found = [(i, k, *m.span()) for i, (k, p, ok) in enumerate(RULES) for m in p.finditer(text or "") if ok(m)]
    return [(k, a, b) for i, k, a, b in sorted(found, key=lambda s: (s[2], s[0], s[3]))]


def random_text(r):
    hexed = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    parts = [
        lambda: r.choice(["token", "PassWord", "api_key", "apikey", "ſecret", "toKen", "secret"]) + r.choice(['="', ": ", " =  '", "' :", "=token:", ""]) + hexed(r.choice([3, 5, 6, 30])),
        lambda: "AKIA" + "".join(r.choice("ABCZ09") for _ in range(r.choice([3, 15, 16, 30]))),
        lambda: hexed(r.choice([23, 24, 25, 64])),
        lambda: r.choice(["word", "Ü", "🙂", "mail4.example.com.x", "\n", "4111111111111111"]),
    ]
    return r.choice(["", " "]).join(r.choice(parts)() for _ in range(r.randrange(8)))


def test_base(spark):
    r = random.Random(1)
    texts = [None, "", "abcdef" * 5, "AKIA" + "Z" * 16, "tokeN : 'abc", "x" * 500_000 + " secret=abcdefg"] + [random_text(r) for _ in range(500)]
    for t in texts:
        assert base_spans(t or "") == brute(t)
        assert worth_reading((t or "").encode()) or not brute(t)
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, texts[-1], 1)] * 2
    got = find_secrets(spark.createDataFrame(rows, "doc_id long, text string, base int"))
    assert got.columns == ["doc_id", "spans"] and got.count() == len(rows)
    for row in got.where("doc_id is not null").collect():
        assert [(s.kind, s.start, s.end) for s in row.spans if s.kind != "model"] == brute(texts[row.doc_id])


def test_the_network_adds_what_looks_alike(spark):
    r = random.Random(6)
    hexed = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f'words and token = "{hexed(40)}" here') for i in range(300)]
    rows += [(i, f"mail to user{i}@mail{i % 9}.example.com or {r.randrange(10**15, 10**16)} today") for i in range(300, 600)]
    missed = f'words and tokens = "{hexed(20)}Z{hexed(20)}" here'
    rows += [(900, missed), (901, "see the host server42.department.example.com for it")]
    got = {x.doc_id: [(s.kind, s.start, s.end) for s in x.spans] for x in find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all([k for k, _, _ in got[i]] == ["assign", "hex"] for i in range(300))
    assert not any(got[i] for i in range(300, 600)) and not got[901]
    assert [k for k, _, _ in got[900]] == ["model"]


def test_empty(spark):
    assert find_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def corpus(r, n=400):
    """Findings of several shapes, and assignments that are none."""
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    word = lambda: "".join(r.choice("aeioulnrst") for _ in range(r.randrange(6, 10)))
    rows = []
    for i in range(n):
        value = r.choice(["".join(r.choice(letters) for _ in range(32)), f"{word()}{r.randrange(9)}{word()[:3]}"])
        rows.append(f'{word()} {r.choice(["password", "secret", "api_key", "passwd"])}{r.choice([" = ", ": "])}"{value}" {word()}')
        rows.append(f"{word()}: {word()} {word()}, {word()} = {word()} and mail{i}.example.com/{word()}")
    return rows


def test_short_and_digit_free_values_are_found(spark):
    r = random.Random(9)
    rows = corpus(r) + ['the passphrase = "hunter2abc" here', 'my private_key: "abcdefghijklmnopqrstuvwxyzABCDEF" there', "note: nothing else, done"]
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(rows)], "doc_id string, text string")
    got = {x.doc_id: [(s.kind, s.start, s.end) for s in x.spans] for x in find_secrets(docs).collect()}
    n = len(rows)
    for i, value in ((n - 3, "hunter2abc"), (n - 2, "abcdefghijklmnopqrstuvwxyzABCDEF")):
        at = rows[i].index(value)
        assert got[f"d{i}"] == [("model", at, at + len(value))]
    plain = [got[f"d{i}"] for i in range(1, n - 3, 2)] + [got[f"d{n - 1}"]]
    assert sum(map(bool, plain)) <= 0.05 * len(plain)


def test_recall_over_all_findings(spark):
    from pyspark.sql import functions as F

    from logsieve.llm import secrets

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    table = secrets.written(secrets.read_spans(docs, "doc_id", "text"), "test")
    # Every finding of the rules lies over a candidate that is labelled as one.
    kinds = table.selectExpr(
        "size(base) AS n", "size(filter(base, b -> exists(cands, c -> c.found AND c.start < b.end AND b.start < c.end))) AS met"
    ).agg(F.sum("n"), F.sum("met")).first()
    assert kinds[0] == kinds[1] > 200
    networks = secrets.learn(table)
    rows = table.select(F.explode("cands").alias("c")).select("c.*").collect()
    scores = networks.scores([(x.left, x.own, x.right) for x in rows])
    frame = spark.createDataFrame([([x.asDict()], [float(s)]) for x, s in zip(rows, scores)], "cands array<struct<start:int,end:int,found:boolean,left:string,own:string,right:string>>, scores array<double>")
    limit = secrets.threshold(frame)
    found = [s >= limit for x, s in zip(rows, scores) if x.found]
    assert sum(found) >= 0.98 * len(found)
    assert ((0 <= scores) & (scores <= 1)).all()


def test_long_tokens_need_bounded_memory():
    import numpy as np

    from logsieve.llm import secrets

    network = secrets.Network()
    r = np.random.RandomState(2)
    shorter = [secrets.symbols("token = ", "".join(map(chr, r.randint(33, 126, n))), " x") for n in (6, 40, 100_000, 7)]
    want = [1 / (1 + np.exp(-(network.pooled([t])[0] @ network.weights + network.level)))[0] for t in shorter]
    assert np.allclose(network.raw_scores(shorter), want)
    taken, pooled = [], network.pooled
    network.pooled = lambda texts: taken.append(sum(map(len, texts))) or pooled(texts)
    long = secrets.symbols("key: ", "ab1/" * 5_000_000, "")  # 20 MB
    assert 0 < network.raw_scores([long])[0] < 1
    assert max(taken) < 2 * secrets.AT_ONCE and sum(taken) >= 20_000_000


def test_a_long_token_in_a_text(spark):
    rows = corpus(random.Random(3), 60) + ["blob: " + "QUJD1/" * 300_000]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    assert find_secrets(docs).count() == len(rows)
