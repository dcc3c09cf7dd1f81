"""A class-based n-gram model: words have classes, classes follow classes.

P(text) is the product over its tokens of P(class | class before) and P(token | class). Exchange clustering
deals the most frequent words to classes so that neighbouring classes tell as much of each other as they
can: each round sums, for every word, how often each class stands before and after it, and each word moves to
the class that gains most; every other round is the other half's turn, for moves made at once disturb each
other. Every other word of the training texts, whatever its length and count, then joins the class that gains
most from it: the classes around all its occurrences meet by word in a shuffle. Until then it counts for a class
by a checksum. The exchange goes on with these words in place.

Only words that training never met keep the class by checksum. How often such a class follows another is learned
from the words met once, which would be unknown had they been left out: each counts once more, for the class of
its checksum; an unknown word is as likely there as one of them.

What grows with the corpus stays in tables: counts of all words come from a shuffle of partial counts; words
beyond the most frequent ones, whose counts and classes are broadcast (their number and length are bounded), get
theirs by a join. The texts are read twice, once to count and once to become symbols; the rounds read symbols.

Defined results: a null or empty text is one end token; an id of null counts as an empty id; repeated rows are
scored alike and counted as often as they stand there; without training texts every token is unknown; an
empty table gives no rows; other columns are left out."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsieve.llm.base import binary, discard, quoted, slices, text_sizes, written
from logsieve.llm.sums import summed

# Words in the rounds of the exchange, the classes of words met in training, and those of unknown words.
FREQUENT, CLASSES, OTHER_CLASSES = 8192, 64, 16
# Words whose counts and classes are broadcast, and the most bytes such a word has.
KNOWN, KNOWN_BYTES = 131_072, 64
ROUNDS = 4
SMOOTH = 0.5
# Distinct words that a task counts before it hands them on.
HELD_WORDS = 400_000
SYMBOLS = FREQUENT + OTHER_CLASSES + 1
END = SYMBOLS - 1
ALL_CLASSES = CLASSES + OTHER_CLASSES + 1
# Then a symbol for each class and kind of a word that is not in the rounds: met once (by checksum), or more often.
KINDS = OTHER_CLASSES + 1
ALL_SYMBOLS = SYMBOLS + CLASSES * KINDS
# Numbers of contexts whose gains are summed at once.
CONTEXTS = 1 << 14
# Symbols whose neighbours travel in one row.
ROWS_TOGETHER = 256


def tokens(data: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return data.lower().split()


def count_words(docs: DataFrame) -> DataFrame:
    """word, n over ``docs`` (text); the end of a text is the empty word."""

    def table(counter: Counter) -> pa.RecordBatch:
        arrays = [pa.array(counter.keys(), pa.binary()), pa.array(counter.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(0)), 1 << 20):
                counter.update(chain.from_iterable(map(tokens, binary(part.column(0)))))
                counter[b""] += part.num_rows
                if len(counter) >= HELD_WORDS:
                    yield table(counter)
                    counter = Counter()
        yield table(counter)

    return docs.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def least_known(vocabulary: DataFrame) -> int:
    """A count that at most KNOWN words reach, from a histogram of the counts in eighths of a power of two."""
    step = F.floor(F.log2("n") * 8).cast("int")
    bins = vocabulary.where("length(word) > 0").groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    total, least = 0, (1 << 63) - 1
    for r in sorted(bins, key=lambda r: -r["step"]):
        total += r["words"]
        if total > KNOWN:
            break
        least = r["least"]
    return least


def other_class(word: bytes) -> int:
    return zlib.crc32(word) % OTHER_CLASSES


def _symbols(docs: DataFrame, known: list[tuple[bytes, int]], n_frequent: int, end_count: int) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known and log_count (of words whose counts are broadcast and the
    end), others and other_n (the rest), symbols (uint16), tail (int32; for each word that is not in the
    rounds its rank, or the number of known words plus its place in others)."""
    held = docs.sparkSession.sparkContext.broadcast(known)
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, log_count double, "
        "others array<binary>, other_n array<int>, symbols binary, tail binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = {w: i for i, (w, _) in enumerate(held.value)}
        log_count = np.log10(np.array([n for _, n in held.value] + [0], dtype=np.float64) + 1)
        unknown = len(rank)
        symbol = np.array([i if i < n_frequent else FREQUENT + other_class(w) for i, w in enumerate(rank)] + [0], dtype=np.uint16)
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(2)), 1 << 20):
                rows: list[list] = [[] for _ in range(7)]
                for data in binary(part.column(2)):
                    words = tokens(data)
                    ids = np.fromiter(map(rank.get, words, repeat(unknown)), dtype=np.int64, count=len(words))
                    far = np.flatnonzero(ids >= unknown)
                    place: dict[bytes, int] = {}
                    places = np.array([place.setdefault(words[i], len(place)) for i in far.tolist()], dtype=np.int64)
                    symbols = np.append(symbol[ids], np.uint16(END))
                    symbols[far] = np.array([FREQUENT + other_class(w) for w in place], dtype=np.uint16)[places]
                    rows[0].append(len(words) + 1)
                    rows[1].append(len(words) - len(far) + (end_count > 0))
                    rows[2].append(float(log_count[ids].sum() + np.log10(end_count + 1)))
                    rows[3].append(list(place))
                    rows[4].append(np.bincount(places).astype(np.int32))
                    rows[5].append(symbols.tobytes())
                    ids[far] += places
                    rows[6].append(ids[ids >= n_frequent].astype(np.int32).tobytes())
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
                arrays = [part.column(0), part.column(1), *(pa.array(r, k) for r, k in zip(rows, kinds))]
                names = ["doc_id", "held_out", "n_tokens", "n_known", "log_count", "others", "other_n", "symbols", "tail"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def contexts(table: DataFrame, known: list[tuple[bytes, int]], classes: np.ndarray) -> DataFrame:
    """word, sides over the words that are not in the rounds: for each occurrence the class before it times
    ALL_CLASSES plus the class after it (uint16). A word comes once from each Arrow batch."""
    held = table.sparkSession.sparkContext.broadcast([w for w, _ in known])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(held.value, pa.binary())
        for batch in batches:
            if not batch.num_rows:
                continue
            # Every text ends with the end symbol, which also stands before the first.
            symbols = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.uint16)
            tail = batch.column(1).to_pylist()
            ids = np.frombuffer(b"".join(tail), dtype=np.int32).astype(np.int64)
            own = classes[symbols]
            at = np.flatnonzero((symbols >= FREQUENT) & (symbols < END))
            sides = (own[at - 1] * ALL_CLASSES + own[at + 1]).astype(np.uint16)
            others = batch.column(2)
            words = others.flatten().dictionary_encode()
            first = np.r_[0, np.cumsum(others.value_lengths().to_numpy())[:-1]]  # of each text
            far = ids >= len(names)
            code = words.indices.to_numpy()
            ids[far] = len(names) + code[(ids + np.repeat(first, [len(t) // 4 for t in tail]))[far] - len(names)]
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]][: len(ids)])
            each = ids[starts]
            split = int(np.searchsorted(each, len(names)))
            word = pa.concat_arrays([names.take(pa.array(each[:split])), words.dictionary.take(pa.array(each[split:] - len(names)))])
            offsets = pa.py_buffer((np.r_[starts, len(ids)] * 2).astype(np.int32).tobytes())
            packed = pa.Array.from_buffers(pa.binary(), len(each), [None, offsets, pa.py_buffer(sides[order].tobytes())])
            yield pa.RecordBatch.from_arrays([word, packed], names=["word", "sides"])

    return table.select("symbols", "tail", "others").mapInArrow(run, "word binary, sides binary")


def neighbours(symbols: DataFrame, classes: np.ndarray) -> DataFrame:
    """part, before, after: for ROWS_TOGETHER symbols in a row, how often each class stands before and after
    each (int64 matrices). A task hands on one matrix, whose size does not depend on the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = np.zeros(ALL_SYMBOLS * ALL_CLASSES, dtype=np.int64)
        after = np.zeros(ALL_SYMBOLS * ALL_CLASSES, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(0)), 4 << 20):
                # Every text ends with the end symbol, which also stands before the first.
                own = np.frombuffer(b"".join(part.column(0).to_pylist()), dtype=np.uint16).astype(np.int64)
                left = np.r_[END, own[:-1]]
                before += np.bincount(own * ALL_CLASSES + classes[left], minlength=len(before))
                after += np.bincount(left * ALL_CLASSES + classes[own], minlength=len(after))
        before, after = (m.reshape(ALL_SYMBOLS, ALL_CLASSES).astype(np.int64) for m in (before, after))
        starts = range(0, ALL_SYMBOLS, ROWS_TOGETHER)
        cut = lambda m: pa.array([m[s : s + ROWS_TOGETHER].tobytes() for s in starts], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(list(range(len(starts)))), cut(before), cut(after)], names=["part", "before", "after"])

    rows = symbols.select("symbols").mapInArrow(run, "part long, before binary, after binary")
    return summed(rows, "part", ["before", "after"], np.int64)


def _f(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0)
    return x * np.log(np.maximum(x, 1))


def information(pairs: np.ndarray) -> float:
    """What classes tell of their neighbours, times the number of tokens."""
    return float(_f(pairs).sum() - _f(pairs.sum(0)).sum() - _f(pairs.sum(1)).sum())


def best_class(before: np.ndarray, after: np.ndarray, own: int, pairs: np.ndarray) -> int:
    """The class (of those in the exchange) that a word with these neighbours best belongs to."""
    rest = pairs.astype(np.float64).copy()
    rest[:, own] -= before
    rest[own, :] -= after
    np.maximum(rest, 0, out=rest)
    into, out = rest.sum(0), rest.sum(1)
    k = CLASSES
    gain = (_f(rest[:, :k] + before[:, None]) - _f(rest[:, :k])).sum(0)
    gain += (_f(rest[:k, :] + after[None, :]) - _f(rest[:k, :])).sum(1)
    gain -= _f(into[:k] + before.sum()) - _f(into[:k]) + _f(out[:k] + after.sum()) - _f(out[:k])
    best = int(np.argmax(gain))
    return best if gain[best] > gain[own] + 1e-9 else own


def best_classes(word: np.ndarray, sides: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of contexts of each word and the class that it best joins, for words numbered from 0 with
    their contexts in a row. As all such words join at once, the tokens of the classes by checksum count in equal
    parts for the classes to join: an empty class, where a word by itself would gain most, does not draw all."""
    p, k = np.asarray(pairs, dtype=np.float64), CLASSES
    spread = slice(k, k + OTHER_CLASSES)
    n = np.bincount(word)
    sizes, of_size = np.unique(n, return_inverse=True)
    into, out = (p.sum(i)[:k] + p.sum(i)[spread].sum() / k for i in (0, 1))
    s = sizes[:, None]
    cost = _f(into + s) - _f(into) + _f(out + s) - _f(out)
    # The gain from a class before or after depends on that class and how often it is there.
    facing = np.concatenate([p[:, :k] + p[:, spread].sum(1)[:, None] / k, p[:k, :].T + p[spread, :].sum(0)[:, None] / k])
    ends = np.r_[0, np.cumsum(n)]
    best, done = np.zeros(len(n), dtype=np.int64), 0
    while done < len(n):
        to = max(done + 1, int(np.searchsorted(ends, ends[done] + CONTEXTS, "right")) - 1)
        w, b = word[ends[done] : ends[to]] - done, sides[ends[done] : ends[to]].astype(np.int64)
        key = np.r_[w * 2 * ALL_CLASSES + b // ALL_CLASSES, (w * 2 + 1) * ALL_CLASSES + b % ALL_CLASSES]
        key, times = np.unique(key, return_counts=True)
        w, side = np.divmod(key, 2 * ALL_CLASSES)
        kind, of_kind = np.unique(side + times * 2 * ALL_CLASSES, return_inverse=True)
        here, many = facing[kind % (2 * ALL_CLASSES)], (kind // (2 * ALL_CLASSES))[:, None]
        gain = np.add.reduceat((_f(here + many) - _f(here))[of_kind], np.searchsorted(w, np.arange(to - done)), axis=0)
        best[done:to] = np.argmax(gain - cost[of_size[done:to]], axis=1)
        done = to
    return n, best


def place(found: DataFrame, pairs: np.ndarray) -> DataFrame:
    """word, n, class for the words of ``contexts``: how often each stands there and the class it best joins."""

    def table(words: pa.Array, sides: list[bytes], each: np.ndarray) -> pa.RecordBatch:
        lengths = [len(x) // 2 for x in sides]
        n, best = best_classes(np.repeat(each, lengths), np.frombuffer(b"".join(sides), np.uint16), pairs)
        return pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64()), pa.array(best, pa.int32())], names=["word", "n", "class"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []  # the word that a batch ended with, and its contexts so far
        for batch in batches:
            if not batch.num_rows:
                continue
            words, sides = batch.column(0), batch.column(1).to_pylist()
            if held and words[0].as_py() == last:
                words, sides = pa.concat_arrays([pa.array([last], pa.binary()), words]), [b"".join(held), *sides]
            elif held:
                yield table(pa.array([last], pa.binary()), [b"".join(held)], np.zeros(1, dtype=np.int64))
            words = words.dictionary_encode()
            each, words = words.indices.to_numpy().astype(np.int64), words.dictionary
            full = int(np.searchsorted(each, len(words) - 1))
            last, held = words[-1].as_py(), sides[full:]
            if full:
                yield table(words[:-1], sides[:full], each[:full])
        if held:
            yield table(pa.array([last], pa.binary()), [b"".join(held)], np.zeros(1, dtype=np.int64))

    return found.repartition("word").sortWithinPartitions("word").mapInArrow(run, "word binary, n long, class int")


def placed_symbols(table: DataFrame, known: np.ndarray) -> DataFrame:
    """``table`` with the classes of words that are not in the rounds in its symbols: ``known`` has the symbols
    of known words, ``codes`` (array of long) of others their place times CLASSES * KINDS, class and kind."""
    kept = [c for c in table.columns if c not in ("symbols", "tail", "codes")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, tail, codes in zip(*(batch.column(len(kept) + i).to_pylist() for i in range(3))):
                symbols = np.frombuffer(data, np.uint16).copy()
                at = np.flatnonzero((symbols >= FREQUENT) & (symbols < END))
                ids = np.frombuffer(tail, np.int32)
                near = ids < len(known)
                symbols[at[near]] = known[ids[near]]
                if codes:
                    where, symbol = np.divmod(np.array(codes, dtype=np.int64), CLASSES * KINDS)
                    far, ids = at[~near], ids[~near] - len(known)
                    new = np.zeros(int(ids.max()) + 1, dtype=np.int64)
                    new[where] = SYMBOLS + symbol
                    symbols[far] = np.where(new[ids] > 0, new[ids], symbols[far])
                out.append(symbols.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(out, pa.binary())], names=[*batch.schema.names[: len(kept)], "symbols"]
            )

    schema = T.StructType([*(table.schema[c] for c in kept), T.StructField("symbols", T.BinaryType())])
    return table.select(*kept, "symbols", "tail", "codes").mapInArrow(run, schema)


def unknown_pairs(symbols: DataFrame, classes: np.ndarray, once: np.ndarray) -> np.ndarray:
    """How often each class follows each around words met once, taken for the class of ``once`` (-1: others)."""
    pairs = np.zeros((ALL_CLASSES, ALL_CLASSES), dtype=np.int64)
    for row in neighbours(symbols, classes).toLocalIterator():
        before, after = (np.frombuffer(row[c], np.int64).reshape(-1, ALL_CLASSES) for c in ("before", "after"))
        own = once[row["part"] * ROWS_TOGETHER :][: len(after)]
        np.add.at(pairs, own[own >= 0], after[own >= 0])
        np.add.at(pairs.T, own[own >= 0], before[own >= 0])
    return pairs


def exchange(symbols: DataFrame, n_frequent: int, classes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The class of each symbol, and how often each class follows each; ``classes`` are those to begin with."""
    if classes is None:
        placed = np.repeat(np.arange(CLASSES), KINDS)
        classes = np.concatenate([np.arange(FREQUENT) % CLASSES, np.arange(CLASSES, ALL_CLASSES), placed])
    best, best_pairs, best_value = classes, np.zeros((ALL_CLASSES, ALL_CLASSES), np.int64), -np.inf
    for turn in range(ROUNDS + 1):
        table = written(neighbours(symbols, classes), "neighbours")
        pairs = np.zeros((ALL_CLASSES, ALL_CLASSES), dtype=np.int64)
        for row in table.select("part", "after").toLocalIterator():
            after = np.frombuffer(row["after"], np.int64).reshape(-1, ALL_CLASSES)
            start = row["part"] * ROWS_TOGETHER
            np.add.at(pairs, classes[start : start + len(after)], after)
        value = information(pairs)
        if value > best_value:
            best, best_pairs, best_value = classes, pairs, value
        if turn == ROUNDS or not n_frequent:
            break

        def moves(batches: Iterator[pa.RecordBatch], classes=classes, pairs=pairs, turn=turn) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for part, b, a in zip(*(batch.column(c).to_pylist() for c in ("part", "before", "after"))):
                    first = part * ROWS_TOGETHER
                    sides = zip(*(np.frombuffer(x, np.int64).reshape(-1, ALL_CLASSES) for x in (b, a)))
                    for word, (left, right) in enumerate(sides, first):
                        if word < n_frequent and (word // CLASSES + word + turn) % 2 == 0 and left.sum():
                            new = best_class(left, right, int(classes[word]), pairs)
                            if new != classes[word]:
                                found.append((word, new))
                words, new = zip(*found) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(new, pa.int64())], names=["word", "class"])

        # At most FREQUENT rows.
        moved = table.repartition("part").mapInArrow(moves, "word long, class long").collect()
        classes = classes.copy()
        for row in moved:
            classes[row["word"]] = row["class"]
        if not moved and turn > 0:
            break
    return best, best_pairs


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; those whose id has
    the checksum remainder ``held`` are held out of training."""
    key = F.coalesce(F.col(quoted(doc_id)).cast("string"), F.lit(""))
    source = docs.select(
        F.col(quoted(doc_id)).alias("doc_id"),
        (F.crc32(F.encode(key, "UTF-8")) % folds == held).alias("held_out"),
        F.col(quoted(text)).alias("text"),
    )
    vocabulary = written(count_words(source.where("NOT held_out").select("text")), "words")
    size = vocabulary.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.count_if(F.col("n") > 0).alias("v"),
        F.coalesce(F.max(F.when(F.length("word") == 0, F.col("n"))), F.lit(0)).alias("end"),
    ).first()
    least = least_known(vocabulary)
    short = (F.col("n") >= least) & F.length("word").between(1, KNOWN_BYTES)
    known = vocabulary.where(short).toArrow()
    known = sorted(zip(*(known.column(c).to_pylist() for c in ("word", "n"))), key=lambda w: (-w[1], w[0]))
    discard(vocabulary)
    n_frequent = min(FREQUENT, len(known))
    table = written(
        _symbols(source, known, n_frequent, size["end"]).withColumn("row", F.monotonically_increasing_id()), "symbols"
    )
    classes, pairs = exchange(table.where("NOT held_out"), n_frequent)
    placed = written(place(contexts(table.where("NOT held_out"), known, classes), pairs), "placed")

    crc = (F.crc32("word") % OTHER_CLASSES).cast("int")
    code = F.col("class") * KINDS + F.when(F.col("n") == 1, crc).otherwise(OTHER_CLASSES)
    # At most KNOWN rows.
    near = placed.where(short).select("word", code.alias("code")).toArrow()
    near = dict(zip(*(near.column(c).to_pylist() for c in ("word", "code"))))
    symbol = np.array([i if i < n_frequent else SYMBOLS + near[w] for i, (w, _) in enumerate(known)], dtype=np.uint16)
    others = (
        table.where(F.size("others") > 0)
        .select("row", F.posexplode(F.arrays_zip("others", "other_n")).alias("place", "o"))
        .select("row", "place", F.col("o.others").alias("word"), F.col("o.other_n").alias("times"))
        .join(placed.where(~short), "word")
        .groupBy("row")
        .agg(
            F.sum("times").alias("more_known"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_log"),
            F.collect_list(F.col("place").cast("long") * (CLASSES * KINDS) + code).alias("codes"),
        )
    )
    narrow = ["doc_id", "held_out", "n_tokens", "n_known", "log_count"]
    found = table.select("row", *narrow, "symbols", "tail").join(others, "row", "left").drop("row")
    whole = written(placed_symbols(found, symbol), "classed")
    discard(table)
    classes, pairs = exchange(whole.where("NOT held_out"), n_frequent, classes)
    once = np.full(ALL_SYMBOLS, -1, dtype=np.int64)
    for i, (word, n) in enumerate(known[:n_frequent]):
        once[i] = CLASSES + other_class(word) if n == 1 else -1
    once[SYMBOLS:].reshape(CLASSES, KINDS)[:, :OTHER_CLASSES] = np.arange(CLASSES, CLASSES + OTHER_CLASSES)
    tokens_in = pairs.sum(0).astype(np.float64)
    unknown = unknown_pairs(whole.where("NOT held_out"), classes, once)
    tokens_in[CLASSES:] += unknown.sum(0)[CLASSES:]
    pairs = pairs + unknown

    # Distinct words of each class; the classes of unknown words keep room for one.
    members = np.bincount(classes[:n_frequent], minlength=ALL_CLASSES).astype(np.float64)
    for row in placed.groupBy("class").count().collect():
        members[row["class"]] += row["count"]
    members[CLASSES : ALL_CLASSES - 1] += 1
    follow = np.log10((pairs + SMOOTH) / (pairs.sum(1, keepdims=True) + SMOOTH * ALL_CLASSES))
    room = np.log10(np.maximum(tokens_in + members, 1))
    room[ALL_CLASSES - 1] = 0
    step = follow - room[None, :]  # the end is the only token of its class

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("symbols")
            sums = []
            for data in batch.column(at).to_pylist():
                own = classes[np.frombuffer(data, np.uint16)]
                sums.append(float(step[np.r_[ALL_CLASSES - 1, own[:-1]], own].sum()))
            rest = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in rest), pa.array(sums, pa.float64())],
                names=[*(batch.schema.names[i] for i in rest), "walked"],
            )

    rows = whole.mapInArrow(
        walk,
        "doc_id long, held_out boolean, n_tokens long, n_known long, log_count double, more_known long, more_log double, walked double",
    )
    logs = F.col("log_count") + F.coalesce("more_log", F.lit(0.0))
    all_mass = F.lit(float(np.log10(size["n"] + size["v"] + 1)))
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(size["n"]).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * all_mass).alias("base_score"),
        (F.col("walked") + logs - float(np.log10(size["end"] + 1))).alias("score"),
    )
