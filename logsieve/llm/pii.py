"""Personal data, by rules that always hold and boosted trees for what they miss.

1. Base rules find emails, IP addresses, payment cards and phone numbers, and keep what passes its check.
2. Generators of high recall propose further spans, overlapping as they may: any long number, masked
   emails, account numbers.
3. Each span gets features of its format and context (not the checks), and gradient-boosted trees learn from
   a bounded sample which of them are confirmed: a masked email by being a valid address once unmasked, an
   account number by its check digits (IBAN, modulo 97), any other span by the rules of step 1.
4. All spans' scores are summed into bins per generator; a threshold is where the spans above it are
   confirmed with the wanted precision. Spans above it that overlap no base span are added.

Everything on the way is a DataFrame or SQL expression: patterns run in the row, positions are summed from
the lengths of matches and gaps, trees become CASE expressions. One pass reads the texts; the candidates
are written, and only they are read again. No pattern repeats a group but possessively and none rescans a
run, so texts of any length take linear time and no stack.

Defined results: a null or empty text has no spans; repeated rows give repeated results; columns named like
an added one are replaced; with too few candidates to learn from, the base spans are the result."""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.functions.once import with_once
from logsieve.llm.base import columns, quoted, without, written

_LOCAL = "[A-Za-z0-9._%+-]"
KINDS = ["email", "ip", "card", "phone"]
BASE = {
    # A run of characters is entered at its start, or where the last match ended.
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
GENERATORS = {
    "number": r"(?<![0-9])[0-9](?:[ .-]?+[0-9]){6,}+",
    "masked": rf"(?<!{_LOCAL}){_LOCAL}++ ?[\[(](?i:at)[\])] ?[A-Za-z0-9-]++(?:(?:\.| ?[\[(](?i:dot)[\])] ?)[A-Za-z0-9-]++)*+",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,}+[A-Z0-9]{0,3}",
}
# Generators that are confirmed by a check of their own, as base rules do not meet what they propose.
CHECKED = ["masked", "account"]
# Words before a span that tell of personal data.
CUES = "mail|contact|phone|call|tel|fax|card|visa|credit|account|iban|ssn|passport|address|ip|host"
CONTEXT = 24
# Distinct candidates (features and label) that the trees are fitted on, about, with their numbers as weights;
# all others are only scored.
SAMPLE_ROWS = 20_000
LEAST_SAMPLE = 50
TREES, DEPTH = 15, 3
BINS = 100
PRECISION = 0.98
# Matches whose lengths are summed together.
STRIDE = 64



def _found(df: DataFrame, kind: str, pattern: str, when: Column) -> DataFrame:
    """A column of the matches of a pattern with their places (code points). ``when`` is a cheap test
    without which nothing can match."""
    none = F.array().cast("array<string>")
    df = with_once(df, "m", F.when(when, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    gaps = F.when(F.size("m") > 0, F.split("text", pattern, -1)).otherwise(none)
    pairs = F.zip_with("m", F.slice(gaps, F.lit(1), F.size("m")), lambda m, g: F.length(g) + F.length(m))
    df = with_once(df, "n", pairs)
    # Sums of whole strides, then of the rest: a text of many matches isn't summed anew for each.
    starts = F.transform(F.sequence(F.lit(0), F.floor(F.size("n") / STRIDE).cast("int")), lambda b: _sum(F.slice("n", b * STRIDE + 1, F.lit(STRIDE))))
    df = with_once(df, "s", F.when(F.size("n") > 0, starts).otherwise(F.array().cast("array<int>")))

    def place(m: Column, i: Column) -> Column:
        block = F.floor(i / STRIDE).cast("int")
        end = _sum(F.slice("s", F.lit(1), block)) + _sum(F.slice("n", block * STRIDE + 1, i - block * STRIDE + 1))
        return F.struct(
            F.lit(kind).alias("kind"),
            (end - F.length(m)).alias("start"),
            end.alias("end"),
            m.alias("text"),
            _valid(kind, m).alias("base"),
            _checked(kind, m).alias("checked"),
        )

    return with_once(df, f"c_{kind}", F.transform("m", place)).drop("m", "n", "s")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Over the digits from the last: every second one doubled, its own digits summed."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: c.cast("int") * (1 + i % 2) - F.when((i % 2 == 1) & (c.cast("int") > 4), 9).otherwise(0),
    )
    return _sum(each) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(False)


def _mod97(code: Column) -> Column:
    """The remainder of an account number, its first four characters put last and letters read as 10 to 35."""
    value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    turned = F.concat(F.substring(code, 5, 1 << 30), F.substring(code, 1, 4))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97)


def _checked(kind: str, m: Column) -> Column:
    """Whether a span of a generator in CHECKED passes the generator's own check."""
    if kind == "masked":
        plain = F.regexp_replace(F.regexp_replace(m, r" ?[\[(](?i:at)[\])] ?", "@"), r" ?[\[(](?i:dot)[\])] ?", ".")
        label = "[A-Za-z0-9](?:[A-Za-z0-9-]*+(?<!-))?"
        return plain.rlike(rf"^(?!\.){_LOCAL}++(?<!\.)@(?:{label}\.)++[A-Za-z]{{2,}}$") & ~plain.contains("..")
    if kind == "account":
        code = F.regexp_replace(m, " ", "")
        return F.when(F.length(code).between(15, 34), _mod97(code) == 1).otherwise(False)
    return F.lit(False)


FEATURES = [
    "generator",
    "length",
    "digits",
    "letters",
    "dots",
    "dashes",
    "blanks",
    "at",
    "plus",
    "brackets",
    "groups",
    "word_before",
    "word_after",
    "cue",
]


def candidates(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """row (struct of ``keep``) and found: an array of (c: span, covered: it overlaps a base span, right: it is
    confirmed, f: features)."""
    whole = F.coalesce(F.col(quoted(text)), F.lit(""))
    df = docs.select(F.struct(*columns(docs, keep), F.lit(0).alias("__")).alias("row"), whole.alias("text"))
    df = with_once(df, "any", F.col("text").rlike("[0-9@\\[(]"))
    df = df.withColumn("digits", F.col("any") & F.col("text").rlike("[0-9]"))
    tests = {
        "email": F.col("text").contains("@"),
        "ip": F.col("digits") & F.col("text").rlike(r"[0-9]\.[0-9]"),
        "card": F.col("digits"),
        "phone": F.col("digits") & F.col("text").contains("+"),
        "number": F.col("digits"),
        "masked": F.col("any") & F.col("text").rlike(r"(?i)[\[(]at[\])]"),
        "account": F.col("digits") & F.col("text").rlike("[A-Z]{2}[0-9]{2}"),
    }
    for kind, pattern in {**BASE, **GENERATORS}.items():
        df = _found(df, kind, pattern, F.col("any") & tests[kind])
    base = F.concat(*(F.filter(f"c_{k}", lambda c: c["base"]) for k in KINDS))
    df = with_once(df, "base", base)
    proposed = F.concat(*(F.col(f"c_{k}") for k in [*KINDS, *GENERATORS]))
    df = df.withColumn("proposed", proposed).select("row", "text", "base", "proposed")
    covered = "exists(base, b -> b.start < c.end AND c.start < b.end)"
    df = with_once(df, "found", F.expr(f"transform(proposed, c -> struct(c, {covered} AS covered))"))
    df = df.select("row", "text", "found")
    right = f"if(x.c.kind IN ({', '.join(map(repr, CHECKED))}), x.c.checked, x.covered)"
    shaped = f"transform(found, x -> struct(x.c AS c, x.covered AS covered, {right} AS right, {_features()} AS f))"
    return with_once(df, "found", F.expr(shaped)).drop("text")


def _features() -> str:
    """Format of a candidate x.c, and what stands around it in the text, as SQL."""
    count = lambda p: f"CAST(regexp_count(x.c.text, '{p}') AS double)"
    letter = r"[\\p{L}\\p{N}]"
    kinds = ", ".join(map(repr, [*KINDS, *GENERATORS]))
    values = {
        "generator": f"CAST(array_position(array({kinds}), x.c.kind) AS double)",
        "length": "CAST(length(x.c.text) AS double)",
        "digits": count("[0-9]"),
        "letters": count("[A-Za-z]"),
        "dots": count("[.]"),
        "dashes": count("-"),
        "blanks": count(" "),
        "at": count("@"),
        "plus": count("[+]"),
        "brackets": count(r"[()\\[\\]]"),
        "groups": count("[0-9]++"),
        "word_before": f"CAST(substring(text, x.c.start, if(x.c.start > 0, 1, 0)) RLIKE '{letter}' AS double)",
        "word_after": f"CAST(substring(text, x.c.end + 1, 1) RLIKE '{letter}' AS double)",
        "cue": f"CAST(substring(text, greatest(x.c.start - {CONTEXT - 1}, 1), least(x.c.start, {CONTEXT})) "
        rf"RLIKE '(?i)(?:^|[^\\p{{L}}])(?:{CUES})s?\\W*$' AS double)",
    }
    return "struct(" + ", ".join(f"{values[n]} AS `{n}`" for n in FEATURES) + ")"


def _tree(lines: list[str]) -> str:
    """The SQL of a fitted tree, from its description (consumed line by line)."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return f"{float(line.split()[1])!r}D"
    feature, limit = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = _tree(lines)
    lines.pop(0)  # Else
    return f"IF(x.f.`{FEATURES[int(feature)]}` <= {float(limit)!r}D, {low}, {_tree(lines)})"


def shares(sizes: dict, most: int) -> dict:
    """The share of each group that a sample of ``most`` rows takes: small groups whole, the others the
    same number of rows each."""
    out, left = {}, most
    for i, (group, n) in enumerate(sorted(sizes.items(), key=lambda g: g[1])):
        take = min(n, left / (len(sizes) - i))
        out[group], left = take / n, left - take
    return out


def sampled(table: DataFrame) -> DataFrame | None:
    """Distinct label and FEATURES, drawn by a hash from each generator and label, and the weight of each: how
    many candidates it stands for. None if there is too little to learn from."""
    every = table.select(F.explode("found").alias("x")).select(F.col("x.right").cast("double").alias("label"), "x.f.*")
    distinct = written(every.groupBy("label", *FEATURES).agg(F.count("*").alias("copies")), "pii-vectors")
    groups = distinct.groupBy("generator", "label").agg(F.count("*").alias("n"), F.sum("copies").alias("copies")).collect()
    if sum(g["copies"] for g in groups) < LEAST_SAMPLE or len({g["label"] for g in groups}) < 2:
        return None
    share = shares({(g["generator"], g["label"]): g["n"] for g in groups}, SAMPLE_ROWS)
    own = "CASE " + " ".join(f"WHEN generator = {g!r}D AND label = {y!r}D THEN {s!r}D" for (g, y), s in share.items()) + " END"
    place = F.pmod(F.xxhash64("label", *FEATURES), F.lit(1 << 30)) / (1 << 30)
    drawn = distinct.withColumn("share", F.expr(own)).where(place < F.col("share"))
    return written(drawn.withColumn("weight", F.col("copies") / F.col("share")).drop("copies", "share"), "pii-sample")


def fit(table: DataFrame) -> str | None:
    """The score of a candidate x as SQL, from trees fitted on a bounded sample; None if there is too
    little to learn from."""
    sample = sampled(table)
    if sample is None:
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample).select("features", "label", "weight")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=5, weightCol="weight").fit(vectors)
    trees = [_tree(t.toDebugString.strip().split("\n")[1:]) for t in model.trees]
    margin = " + ".join(f"{float(w)!r}D * {t}" for w, t in zip(model.treeWeights, trees))
    return f"1 / (1 + exp(-2 * ({margin})))"


def thresholds(scored: DataFrame) -> dict[str, float]:
    """For each generator the lowest score above which its candidates are confirmed with PRECISION,
    from counts over all candidates; a generator without one adds nothing."""
    rows = (
        scored.select(F.explode("scored").alias("x"))
        .groupBy(F.col("x.c.kind").alias("kind"), F.floor(F.col("x.score") * BINS).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"), F.sum(F.col("x.right").cast("long")).alias("right"))
        .collect()
    )
    limits: dict[str, float] = {}
    for kind in {r["kind"] for r in rows}:
        n = right = 0
        for r in sorted((r for r in rows if r["kind"] == kind), key=lambda r: -r["bin"]):
            n, right = n + r["n"], right + r["right"]
            if right >= PRECISION * n:
                limits[kind] = r["bin"] / BINS
    return limits


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: an array of (kind, start, end, base), base spans first, each kind in
    the order of KINDS and then GENERATORS, by start. Places are code points, the end is exclusive."""
    keep = without(docs, ["spans"])
    table = written(candidates(docs, text, keep), "pii-candidates")
    score = fit(table)
    if score is None:
        chosen = "x.c.base"
        scored = table.withColumn("scored", F.col("found"))
    else:
        scored = table.withColumn(
            "scored", F.expr(f"transform(found, x -> struct(x.c AS c, x.covered AS covered, x.right AS right, {score} AS score))")
        )
        limits = thresholds(scored)
        added = " OR ".join(f"(x.c.kind = '{k}' AND x.score >= {v}D)" for k, v in sorted(limits.items())) or "false"
        chosen = f"x.c.base OR (NOT x.covered AND ({added}))"
    # Candidates stand by kind and start already; base spans come first.
    span = "struct(x.c.kind AS kind, x.c.start AS start, x.c.end AS end, x.c.base AS base)"
    picked = scored.withColumn("picked", F.expr(f"transform(filter(scored, x -> {chosen}), x -> {span})"))
    spans = F.expr("concat(filter(picked, s -> s.base), filter(picked, s -> NOT s.base))")
    return picked.select(*(F.col("row")[c].alias(c) for c in keep), spans.alias("spans"))


def redacted(text: str, spans: str = "spans") -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap become one."""
    t, order = quoted(text), f"array_sort(transform({quoted(spans)}, s -> struct(s.start AS start, s.end AS end, s.kind AS kind)))"
    step = (
        "CASE WHEN s.start >= a.at THEN struct(s.end AS at, "
        f"concat(a.out, substring({t}, a.at + 1, s.start - a.at), '[', upper(s.kind), ']') AS out) "
        "WHEN s.end > a.at THEN struct(s.end AS at, a.out AS out) ELSE a END"
    )
    end = f"concat(a.out, substring({t}, a.at + 1))"
    whole = f"aggregate({order}, struct(0 AS at, '' AS out), (a, s) -> {step}, a -> {end})"
    return F.when(F.size(quoted(spans)) > 0, F.expr(whole)).otherwise(F.col(t))
