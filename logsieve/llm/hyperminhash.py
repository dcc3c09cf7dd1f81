"""Near duplicates by HyperMinHash.

A document's set is its distinct shingles of five words. Documents of equal sets form a class; all
further work is on one representative per class. Its signature is one permutation of its shingles dealt
to about 192 buckets; a bucket keeps its smallest hash as 6 bits of leading zeros and 10 bits of mantissa.
Bands of registers make candidates. Their number and rows follow the threshold: of two sets whose similarity
is just the threshold, all bands differ with a probability below 1e-6 (empty buckets agree, so small sets do
better). For 0.85 these are 32 bands of 6 registers, for 0.80 38 bands of 5.

1. In every band that two or more representatives share, all are compared with one of them: the one that
   shares the most bands with others, for the text from which a family of copies was made is the most
   central. Similarity is first estimated from the registers, corrected for chance collisions; what may
   reach the threshold is confirmed on the full sets.
2. What is still apart is compared in full. Each representative is at home with the most central text it
   shares a band with, so a family has one home. In a home of several components, blocks of members meet two
   by two, first by their registers to see who may have a partner at all; those are confirmed on the full
   sets, by products of incidence matrices, and a task returns no more links than join its members. Pairs of a
   band that have different homes are screened by their registers and confirmed one by one.

So a family of copies costs one comparison per copy and band, no pair is given up for the size of a
group, no task holds a group whole, and pairs that are not linked are not written. Components come from
contraction by joins.

Defined results: a text without words (null, empty) has an empty set and is linked with nothing; a null
id takes part in its class, and a component of null ids only has a null id; repeated rows are one
class, and dropping leaves one of them; an empty table gives no rows."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsieve.llm.base import binary, columns, discard, quoted, released, slices, text_sizes, with_arrow_columns, written
from logsieve.llm.components import components
from logsieve.llm.shingles import mix, shingle_sets
from logsieve.operators.lookup import lookup_join

SHINGLE = 5
# Registers of a signature, more only for thresholds that need it, and the chance that no band of a pair meets.
REGISTERS = 192
MISS = 1e-6
MANTISSA = 10
EMPTY = 0xFFFF
# Standard errors below the threshold at which an estimate rules a pair out.
MARGIN = 5
# Members of a band or home whose pairs one task sees at once, the bytes of their sets, and elements that it
# counts at once.
BLOCK = 512
BLOCK_BYTES = 4 << 20
COLUMNS = 4096
# The factor of the expected number of chance collisions in the published estimator; a fixed value.
COLLISIONS = 0.169919487159739093975315012348


def layout(percent: int) -> tuple[int, int]:
    """Bands and rows for a threshold: the longest bands of which REGISTERS hold enough for MISS."""
    if not 0 < percent <= 100:
        raise ValueError(f"percent must be from 1 to 100, not {percent}")
    if percent == 100:
        return 1, REGISTERS
    least = lambda rows: math.floor(math.log(MISS) / math.log1p(-((percent / 100) ** rows))) + 1
    rows = max(takewhile(lambda r: least(r) * r <= REGISTERS, range(1, REGISTERS + 1)), default=1)
    return max(REGISTERS // rows, least(rows)), rows


def registers(shingles: np.ndarray, size: int = REGISTERS) -> np.ndarray:
    """The signature of a set: leading zeros and mantissa of the smallest hash of each of ``size`` buckets."""
    smallest = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
    bucket = ((shingles >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
    with np.errstate(over="ignore"):
        np.minimum.at(smallest, bucket.astype(np.int64), mix(shingles + np.uint64(0xD6E8FEB86659FD93)))
    filled = np.zeros(size, dtype=bool)
    filled[bucket.astype(np.int64)] = True
    fraction, exponent = np.frexp(smallest.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 62).astype(np.uint16)
    bits = ((fraction - 0.5) * 2 * (1 << MANTISSA)).astype(np.uint16)
    return np.where(filled, (zeros << MANTISSA) | bits, EMPTY).astype(np.uint16)


def bands(signatures: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """A key for each band of ``rows`` registers of each signature, and which bands are not empty."""
    parts = signatures.reshape(len(signatures), -1, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.arange(parts.shape[1], dtype=np.uint64)[None, :] + np.uint64(1)
        for row in range(rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, row])
    return key.view(np.int64), (parts != EMPTY).any(axis=2)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int = 85) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of signatures (last axis: registers) of sets of n and m elements, less
    the collisions expected by chance, and its standard error at the threshold, 0.4 of one register at least."""
    used = ((a != EMPTY) | (b != EMPTY)).sum(axis=-1)
    equal = ((a == b) & (a != EMPTY)).sum(axis=-1)
    ratio = np.maximum(n, m) / np.maximum(1, np.minimum(n, m))
    chance = COLLISIONS * used * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    used = np.maximum(used, 1)
    each = max(0.4, math.sqrt(percent / 100 * (1 - percent / 100)))
    return np.clip((equal - chance) / used, 0, 1), each / np.sqrt(used)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key, signature of ``size`` registers of every document (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(1))):
                sets = shingle_sets(binary(part.column(1)), SHINGLE)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_key(s) for s in sets], pa.binary()),
                        pa.array([registers(s, size).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "signature"],
                )

    fields = T.StructType([T.StructField("doc_id", docs.schema["__id"].dataType)])
    for name, kind in (("n_shingles", T.LongType()), ("set_key", T.BinaryType()), ("signature", T.BinaryType())):
        fields = fields.add(name, kind)
    return docs.mapInArrow(released(run), fields)


def _band_rows(reps: DataFrame, count: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                own = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint16).reshape(-1, count * rows)
                key, used = bands(own, rows)
                rep = np.repeat(part.column(0).to_numpy(), used.sum(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(key[used])], names=["rep", "band"])

    return reps.select("rep", "signature").mapInArrow(released(run), "rep long, band long")


def _screen(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose registers do not rule the threshold out."""
    for side in ("a", "b"):
        own = reps.select(
            F.col("rep").alias(side), F.col("signature").alias(f"signature_{side}"), F.col("n_shingles").alias(f"n_{side}")
        )
        pairs = pairs.join(own, side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                left, right = (
                    np.frombuffer(b"".join(part.column(i).to_pylist()), dtype=np.uint16).reshape(part.num_rows, -1) for i in (2, 3)
                )
                n, m = part.column(4).to_numpy(), part.column(5).to_numpy()
                near, error = estimate(left, right, n, m, percent)
                may = (near + MARGIN * error >= percent / 100) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
                yield part.select(["a", "b"]).filter(pa.array(may))

    return pairs.select("a", "b", "signature_a", "signature_b", "n_a", "n_b").mapInArrow(released(run), "a long, b long")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked by their full sets."""
    for side in ("b", "a"):
        pairs = pairs.join(sets.select(F.col("rep").alias(side), F.col("hashes").alias(f"set_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                left, right = part.column(2).to_pylist(), part.column(3).to_pylist()
                met = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(left, right)]
                yield part.select(["a", "b"]).filter(pa.array(met))

    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(released(run), "a long, b long")


def _dealt(members: DataFrame, group: str) -> DataFrame:
    """The rows of each group in blocks, and a row for every two blocks (i <= j) that one is part of. Groups
    of one block are not looked up, and a large one is not brought together to be dealt."""
    size = F.greatest(F.count("*") / BLOCK, F.sum(8 * F.col("n_shingles")) / BLOCK_BYTES)
    large = written(members.groupBy(group).agg(F.ceil(size).cast("int").alias("blocks")).where("blocks > 1"), "blocks")
    dealt = lookup_join(members, large, group, "left", bound=large)
    dealt = dealt.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})


def _likely_partners(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of the rows of two blocks, each of the first and those of the second that are in another component
    and may reach the threshold by their registers (places in the table)."""
    rep, root, n, block = (table.column(c).to_numpy() for c in ("rep", "root", "n_shingles", "block"))
    own = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint16).reshape(table.num_rows, -1)
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    right = np.flatnonzero(block == j)
    right = right[np.argsort(n[right], kind="stable")]
    sizes = n[right]
    for x in np.flatnonzero(block == i):
        low = np.searchsorted(sizes, -(-n[x] * percent // 100))
        y = right[low : np.searchsorted(sizes, n[x] * 100 // percent, side="right")]
        y = y[(root[y] != root[x]) & ((rep[y] > rep[x]) | (i != j))]
        if len(y):
            near, error = estimate(own[x][None, :], own[y], n[x], n[y], percent)
            y = y[near + MARGIN * error >= percent / 100]
        if len(y):
            yield x, y


def _across(members: DataFrame, percent: int) -> DataFrame:
    """Pairs in a band (band, rep, root, home, signature, n_shingles) of different components and homes
    that may reach the threshold."""

    def run(table: pa.Table) -> pa.Table:
        rep, home = (table.column(c).to_numpy() for c in ("rep", "home"))
        found = [np.zeros((0, 2), dtype=np.int64)]
        for x, y in _likely_partners(table, percent):
            y = y[home[y] != home[x]]
            found.append(np.stack([np.minimum(rep[x], rep[y]), np.maximum(rep[x], rep[y])], axis=1))
        pairs = np.concatenate(found)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    dealt = _dealt(members, "band").drop("blocks", "other")
    return dealt.groupBy("band", "i", "j").applyInArrow(run, "a long, b long").distinct()


def _with_partners(members: DataFrame, percent: int) -> DataFrame:
    """The members of homes (home, rep, root, signature, n_shingles) that may be linked with another
    component of their home: rep."""

    def run(table: pa.Table) -> pa.Table:
        rep, found = table.column("rep").to_numpy(), np.zeros(table.num_rows, dtype=bool)
        for x, y in _likely_partners(table, percent):
            found[x] = found[y] = True
        return pa.table({"rep": rep[found]})

    dealt = _dealt(members, "home").drop("blocks", "other")
    return dealt.groupBy("home", "i", "j").applyInArrow(run, "rep long").distinct()


def common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements each set of ``left`` shares with each of ``right`` (places in ``sets``),
    by products of incidence matrices of some elements at a time."""
    every = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    fresh = np.r_[True, every[1:] != every[:-1]]
    column = np.cumsum(fresh) - 1
    twice = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, dtype=bool)
    owner, column = owner[twice], column[twice]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    place = np.full(len(sets), -1)
    bounds = np.flatnonzero(np.r_[True, column[1:] != column[:-1]]) if len(column) else np.zeros(0, dtype=np.int64)
    limits = np.r_[bounds, len(column)]
    for start in range(0, len(bounds), COLUMNS):
        part = slice(limits[start], limits[min(start + COLUMNS, len(bounds))])
        nth = np.searchsorted(bounds, np.arange(part.start, part.stop), side="right") - 1 - start
        sides = []
        for side in (left, right):
            place[:] = -1
            place[side] = np.arange(len(side))
            use = place[owner[part]] >= 0
            matrix = np.zeros((len(side), min(COLUMNS, len(bounds) - start)), dtype=np.float32)
            matrix[place[owner[part]][use], nth[use]] = 1
            sides.append(matrix)
        total += sides[0] @ sides[1].T
    return total


def _within(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components of a home (home, rep, root, n_shingles), confirmed on the full sets: of
    each two blocks just as many as join what is joined at all."""

    def run(table: pa.Table) -> pa.Table:
        rep, root, block = (table.column(c).to_numpy() for c in ("rep", "root", "block"))
        own = [np.frombuffer(h, np.uint64) for h in table.column("hashes").to_pylist()]
        size = np.array([len(s) for s in own])
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links = []
        if len(np.unique(root)) > 1:
            both = common(own, left, right)
            union = size[left][:, None] + size[right][None, :] - both
            x, y = np.nonzero((100 * both >= percent * union) & (root[left][:, None] != root[right][None, :]))
            up = {r: r for r in root.tolist()}
            for p, q in zip(left[x].tolist(), right[y].tolist()):
                a, b = int(root[p]), int(root[q])
                while up[a] != a:
                    a = up[a]
                while up[b] != b:
                    b = up[b]
                if a != b:
                    up[a] = up[root[p]] = b
                    links.append(sorted((int(rep[p]), int(rep[q]))))
        pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    dealt = _dealt(members, "home").join(sets, "rep").select("home", "i", "j", "block", "rep", "root", "hashes")
    return dealt.groupBy("home", "i", "j").applyInArrow(run, "a long, b long")


def _components(source: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The signature of every row of ``source`` (__id, __text), and the classes of equal sets with the
    root of their component."""
    count, rows = layout(percent)
    table = written(_signatures(source, count * rows).withColumn("row", F.monotonically_increasing_id()), "signatures")
    classes = written(
        table.where("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("row").alias("rep"), F.min("doc_id").alias("least_id"), F.count("*").alias("copies")),
        "classes",
    )
    reps = written(
        table.join(classes.select(F.col("rep").alias("row")), "row", "left_semi").select(
            F.col("row").alias("rep"), "doc_id", "set_key", "n_shingles", "signature"
        ),
        "representatives",
    )
    shared = written(_band_rows(reps, count, rows).groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "bands")
    members = written(_band_rows(reps, count, rows).join(shared, "band"), "members")
    weights = written(members.groupBy("rep").agg(F.sum("n").alias("weight")), "weights")
    pivots = written(
        members.join(weights, "rep")
        .groupBy("band")
        .agg(F.max(F.struct("weight", (-F.col("rep")).alias("minus"))).alias("most"))
        .select("band", (-F.col("most.minus")).alias("pivot")),
        "pivots",
    )
    pairs = written(
        members.join(pivots, "band")
        .where("rep <> pivot")
        .select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))
        .distinct(),
        "pairs",
    )
    likely = written(_screen(pairs, reps, percent), "screened")
    ends = likely.select(F.explode(F.array("a", "b")).alias("rep"))
    sets = _sets(source, reps, ends)
    found = written(_confirm(likely, sets, percent), "confirmed")
    for done in (sets, shared, likely):
        discard(done)
    roots = components(found)
    homes = (
        members.join(pivots, "band")
        .join(weights.select(F.col("rep").alias("pivot"), "weight"), "pivot")
        .groupBy("rep")
        .agg((-F.max(F.struct("weight", (-F.col("pivot")).alias("minus")))["minus"]).alias("home"))
    )
    seats = written(
        homes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
            "rep", "home", F.coalesce("root", "rep").alias("root")
        ),
        "seats",
    )
    several = lambda of, column: (
        of.agg(F.min(column).alias("low"), F.max(column).alias("high")).where("low < high")
    )
    mixed_homes = several(seats.groupBy("home"), "root").select("home")
    placed = written(members.select("rep", "band").join(seats, "rep"), "placed")
    for done in (members, weights, pivots):
        discard(done)
    mixed_bands = (
        placed.groupBy("band")
        .agg(*(f(c).alias(f"{n}_{c}") for c in ("root", "home") for n, f in (("low", F.min), ("high", F.max))))
        .where("low_root < high_root AND low_home < high_home")
        .select("band")
    )
    apart = placed.join(mixed_bands, "band").join(reps.select("rep", "signature", "n_shingles"), "rep")
    across = written(_across(apart, percent).join(pairs, ["a", "b"], "left_anti"), "pairs")
    together = seats.join(mixed_homes, "home").join(reps.select("rep", "signature", "n_shingles"), "rep")
    sized = seats.join(reps.select("rep", "n_shingles"), "rep")
    together = written(sized.join(_with_partners(together, percent), "rep"), "together")
    for done in (placed, pairs, seats):
        discard(done)
    wanted = across.select(F.explode(F.array("a", "b")).alias("rep")).union(together.select("rep"))
    sets = _sets(source, reps, wanted)
    more = _within(together, sets, percent).union(_confirm(across, sets, percent))
    more = written(more, "confirmed")
    for done in (sets, across, together):
        discard(done)
    if not more.isEmpty():
        roots = components(found.union(more))
    discard(reps)
    whole = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    return table, whole.withColumn("root", F.coalesce("root", "rep"))


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(quoted(doc_id)).alias("__id"), F.col(quoted(text)).alias("__text"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable) and kept (it is the row's own id)."""
    table, whole = _components(_source(docs, doc_id, text), percent)
    least = whole.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("parts"))
    # Only classes of several rows or links need the join; it is by a narrow table.
    known = written(
        whole.join(least, "root").where("parts > 1 OR copies > 1").select("set_key", "component_id"), "known"
    )
    component = F.coalesce("component_id", "doc_id")
    return table.join(known, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """One row of ``docs`` for each component, that of the smallest id (null last), and every row without
    words. Rows are kept or dropped by their ids, so texts are only shuffled if the dropped ids are too many to
    broadcast; only rows whose id is null or not unique are told apart by their sets."""
    table, whole = _components(_source(docs, doc_id, text), percent)
    best = F.min(F.struct(F.col("least_id").isNull().alias("none"), "least_id", "rep", "set_key"))
    chosen = written(
        whole.groupBy("root").agg(best.alias("best"), F.sum("copies").alias("rows")).select("root", "rows", "best.least_id", "best.set_key"),
        "chosen",
    )
    first = chosen.where("rows > 1").select("root", "least_id", F.col("set_key").alias("chosen_key"))
    later = table.join(whole.select("set_key", "root").join(first, "root"), "set_key").where(
        ~(F.col("doc_id").eqNullSafe(F.col("least_id")) & (F.col("set_key") == F.col("chosen_key")))
    )
    twice = written(table.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").select("doc_id"), "twice")
    marks = later.select("doc_id", F.lit("dropped").alias("mark")).unionByName(twice.withColumn("mark", F.lit("again")))
    marks = marks.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("key")).agg(F.min("mark").alias("mark"))
    marks = written(marks, "marks")
    discard(table)
    held = docs.select(F.struct(*columns(docs, docs.columns)).alias("row"), F.col(quoted(doc_id)).alias("key"))
    marked = lookup_join(held, marks, how="left", bound=marks)
    plain = marked.where("mark IS NULL AND key IS NOT NULL").select("row.*")
    if twice.isEmpty():
        return plain
    again = marked.where("mark = 'again' OR key IS NULL").select("row", "key", F.col("row").getField(text).alias("words"))
    keyed = with_arrow_columns(
        again, "words", T.StructType([T.StructField("own_set", T.BinaryType())]), lambda: lambda texts: [_set_keys(texts)]
    )
    same = F.col("key").eqNullSafe(F.col("least_id")) & (F.col("own_set") == F.col("set_key"))
    rows = keyed.where("own_set IS NOT NULL").join(chosen.select("least_id", "set_key"), same, "left_semi")
    one = rows.groupBy("key", "own_set").agg(F.first("row").alias("row"))
    return plain.unionByName(keyed.where("own_set IS NULL").select("row.*")).unionByName(one.select("row.*"))


def _set_keys(texts: pa.Array) -> pa.Array:
    return pa.array([_key(s) for s in shingle_sets(binary(texts), SHINGLE)], pa.binary())


def _key(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _sets(source: DataFrame, reps: DataFrame, wanted: DataFrame) -> DataFrame:
    """The full sets of the representatives in ``wanted`` (rep), made again from their texts."""
    wanted = wanted.distinct()
    keys = written(reps.join(wanted, "rep", "left_semi").select("rep", "doc_id", "set_key"), "wanted")
    ids = keys.select(F.col("doc_id").alias("wanted_id")).distinct()
    texts = source.join(ids, F.col("__id").eqNullSafe(F.col("wanted_id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(0))):
                sets = [s for s in shingle_sets(binary(part.column(0)), SHINGLE) if len(s)]
                arrays = [pa.array(map(_key, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["set_key", "hashes"])

    found = texts.select("__text").mapInArrow(released(run), "set_key binary, hashes binary")
    return written(
        found.join(keys.select("rep", "set_key"), "set_key").select("rep", "hashes").dropDuplicates(["rep"]), "sets"
    )
