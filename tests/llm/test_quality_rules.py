import random
import re

from logsieve.llm.quality_rules import quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    marked = set()
    for i, x in enumerate(windows):
        if windows.count(x) > 1:
            marked.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(marked) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), failed


def random_text(r):
    words = ["ab", "Ünï", "x#", "|", "the", "a*b", "😀", "end.", "$5"] + [f"w{i}" for i in range(r.choice([3, 30, 300]))]
    lines = [r.choice([" ", "  ", "\t", "\x0b", "\r", " \x0c"]).join(r.choice(words) for _ in range(r.randrange(14))) for _ in range(r.randrange(12))]
    lines += [r.choice(lines) for _ in range(r.randrange(4)) if lines]
    return r.choice(["", " ", "\n"]) + "\n".join(lines)


def test_counts(spark):
    r = random.Random(8)
    texts = [None, "", " \n\t", "one", "a b c d e a b c d e", "\x1fa\x85b c"] + [random_text(r) for _ in range(300)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[-1], None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, KEPT string")
    out = quality_rules(docs)
    assert out.columns[:2] == ["doc_id", "text"] and "KEPT" not in out.columns
    got = out.collect()
    assert len(got) == len(rows)
    for row in got:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == brute(row.text), row.text
        assert not (row.base_failed and row.kept)
        if not row.n_failed_lines and not row.n_dup_lines:
            assert row.clean_text == (row.text or "")


def test_long_texts(spark):
    texts = ["word " * 200_000, "\n".join(f"Line {i} is, {i}, course {i} own." for i in range(50_000)), "x" * 2_000_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules(docs).drop("text").collect()}
    assert got[0].n_repeat_words == 200_000 and got[0].base_failed
    assert got[1].n_words == 350_000 and got[1].kept
    assert got[2].n_words == 1


PROSE = "It was, they said, the best of days. Nobody had seen the like of it before."


def verdict(spark, text):
    row = quality_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    return row.kept, row.clean_text


def test_lines(spark):
    assert verdict(spark, PROSE) == (True, PROSE)
    other = "A second line, quite unlike the first, follows here and goes on for a while.\nSo it goes."
    end = "Nothing else, in all those years, was ever said about the house by the river."
    mixed = f"Home | News | About | Contact\n{PROSE}\n\nLicensed under the Any License, Version 2.\n{other}\n{end}\nSo it goes."
    assert verdict(spark, mixed) == (True, f"{PROSE}\n{other}\n{end}")
    # A notice is taken out, however short the text beside it is.
    assert verdict(spark, "Too short.\nThis work is licensed under the GNU General Public License, version 3.") == (True, "Too short.")
    for junk in (
        "Home | News | About\nShop | Cart | Help | Jobs\n" * 1 + "It is. But not so here, not at all.",
        "BUY NOW THE BEST DEAL EVER SEEN, AND SO CHEAP!! ONLY TODAY",
        "of%%% the*** to### and$$$ so%%% it*** goes### on$$$ here%%% too***",
        "of of the the to to and and so so it it goes. goes. on, on, here here",
        " ".join(f"w{i}" for i in range(40)),
    ):
        assert not verdict(spark, junk)[0], junk


def test_labels(spark):
    sf = "/root/testdata/sf0.1"  # the rules were written with the smaller tables
    ruled = quality_rules(spark.read.parquet(f"{sf}/documents.parquet"))
    labelled = ruled.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    rows = labelled.groupBy("quality", "kept").count().collect()
    count = {(r.quality, r.kept): r["count"] for r in rows}
    # The error that is allowed: one good document in a hundred.
    assert count.get((1, False), 0) <= 0.01 * count[(1, True)]
    assert count.get((0, True), 0) <= 0.1 * count[(0, False)]


def test_empty(spark):
    assert quality_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0
