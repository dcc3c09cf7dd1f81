"""Byte-level BPE: texts to token ids and back, exactly as the rank file says.

The tiktoken library merges pieces of usual length, many in one call with a byte between them; the tokenizers
library, whose time does not grow with their square, merges long ones. A text is cut by the vocabulary's pattern; each distinct
piece is encoded once per worker and found again in a bounded table, because natural text repeats
its pieces. Offsets come from the byte lengths of the tokens, mapped from bytes to characters.
Decoding concatenates the bytes of the tokens; a character that is split over tokens is whole
again once its tokens stand together, and becomes U+FFFD where they do not.

Defined results: a null or empty text has no tokens and decodes to no bytes; repeated rows give
repeated results; columns named like an added one are replaced; a text of any length is encoded
whole (pieces of over 64 characters are just not kept in the table)."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsieve.llm.base import lists, released, slices, with_arrow_columns

# Pieces kept per task (twice, with the older half), and the longest that is kept.
KEPT_PIECES = 60_000
KEPT_CHARS = 64
# Bytes of text that are encoded at once, about.
SLICE = 2 << 20
# Ids that are decoded at once, about.
DECODED = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 bytes of a token and its id on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else one from U+0100 on."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in printing)
    stand_in = {b: chr(0x100 + i) for i, b in enumerate(others)}
    return [stand_in.get(b) or chr(b) for b in range(256)]


def build_tokenizer(ranks: dict[bytes, int]) -> str:
    """The tokenizers library's own JSON for these ranks; it takes each input as one piece.

    Every way to split a token into two known ones is a merge, in the order of the token's rank:
    that is what merging by rank of the result means."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    letters = byte_characters()
    name = {token: "".join(map(letters.__getitem__, token)) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        cuts = [(token[:i], token[i:]) for i in range(1, len(token))]
        found = [(a, b) for a, b in cuts if a in ranks and b in ranks]
        merges += [(name[a], name[b]) for a, b in sorted(found, key=lambda x: (ranks[x[0]], ranks[x[1]]))]
    tokenizer = Tokenizer(
        models.BPE(vocab={name[t]: i for t, i in ranks.items()}, merges=merges, ignore_merges=True)
    )
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer.to_str()


def newer_characters() -> str:
    """Letters and numbers of the regex module's Unicode version that tiktoken's does not know yet."""
    import regex
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    found: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}"):
        known = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=single, special_tokens={})
        found |= set(regex.findall(kind, every)) - set(bytes(known.encode_ordinary(every)).decode())
    return "".join(sorted(found))


def _ranges(characters: str) -> str:
    """A regular expression's set of these sorted characters."""
    runs: list[list[int]] = []
    for c in map(ord, characters):
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


def _is_latin(text: str) -> bool:
    """Whether all characters are below U+0100, where no Unicode version adds any."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Codec:
    """What a worker holds: the tokenizers, the bytes of each id, and the pieces met so far."""

    def __init__(self, spec: str, pattern: str, ranks: dict[bytes, int], newer: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core already
        self.tokenizer = Tokenizer.from_str(spec)
        self.findall = regex.compile(pattern).findall
        self.newer = re.compile(f"[{_ranges(newer)}]") if newer else None
        self.kept: dict[str, bytes] = {}  # ids as int32
        self.older: dict[str, bytes] = {}
        self.bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token
        self.length = np.array([len(b) for b in self.bytes], dtype=np.int64)
        # Many pieces as one text with a zero byte between them, whose token ends each piece.
        self.end = ranks.get(b"\0")
        self.many = None
        if all(bytes([b]) in ranks for b in range(256)) and len(set(ranks.values())) == len(ranks):
            self.many = tiktoken.Encoding("pieces", pat_str=r"[^\x00]+|\x00", mergeable_ranks=ranks, special_tokens={})
        self.joined = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self.start = np.cumsum(self.length) - self.length
        self.inside = np.array([bool(b) and 0x80 <= b[0] < 0xC0 for b in self.bytes], dtype=bool)

    def pieces(self, text: str) -> list[str]:
        if self.newer is None or _is_latin(text) or not self.newer.search(text):
            return self.findall(text)
        ends = list(accumulate(map(len, self.findall(self.newer.sub("\ue000", text)))))
        return [text[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not in the table, many at once; each is a word of its own."""
        if self.many is not None:
            short = [p for p in pieces if len(p) <= KEPT_CHARS and "\0" not in p]
            pieces = [p for p in pieces if len(p) > KEPT_CHARS or "\0" in p]
            for at in range(0, len(short), 20_000):
                part = short[at : at + 20_000]
                ids = np.array(self.many.encode_ordinary("\0".join(part) + "\0"), dtype=np.int32)
                ends = np.flatnonzero(ids == self.end)
                data, starts = ids.tobytes(), [0, *(ends * 4 + 4).tolist()]
                self.kept.update(zip(part, (data[a:b] for a, b in zip(starts, (ends * 4).tolist()))))
        for at in range(0, len(pieces), 5_000):
            part = pieces[at : at + 5_000]
            encoded = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(encoded.ids, dtype=np.int32).tobytes()
            ends = np.cumsum(np.bincount(np.array(encoded.word_ids, dtype=np.int64), minlength=len(part))) * 4
            ends = ends.tolist()
            self.kept.update(zip(part, (ids[a:b] for a, b in zip([0, *ends], ends))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.pieces(t) for t in texts]
        if len(self.kept) > KEPT_PIECES:  # pieces that are met again come back from the older half
            self.older, self.kept = self.kept, {}
        new = set(chain.from_iterable(cut)) - self.kept.keys()
        again = new & self.older.keys()
        self.kept.update((p, self.older[p]) for p in again)
        new = list(new - again)
        self.learn(new)
        out = [np.frombuffer(b"".join(map(self.kept.__getitem__, p)), dtype=np.int32) for p in cut]
        for piece in new:
            if len(piece) > KEPT_CHARS:
                del self.kept[piece]
        return out

    def forget(self) -> None:
        """Drop the pieces met so far: a worker outlives its tasks."""
        self.kept, self.older = {}, {}

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each token; a token that holds part of a character counts it."""
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
        ends = np.cumsum(self.length[ids])
        starts = ends - self.length[ids]
        return character[starts], character[ends - 1] + 1

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode_many(self, ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
        """What ``decode`` makes of lists of these lengths, whose ids stand in a row."""
        n = self.length[ids]
        ends = np.r_[0, np.cumsum(n)]
        data = self.joined[np.repeat(self.start[ids] - ends[:-1], n) + np.arange(ends[-1])]
        offsets = ends[np.r_[0, np.cumsum(lengths)]].astype(np.int32)
        buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
        return pa.Array.from_buffers(pa.binary(), len(lengths), buffers)


@lru_cache(maxsize=1)
def _codec(spec: str, pattern: str, ids: bytes, lengths: bytes, tokens: bytes, newer: str) -> Codec:
    ends = np.cumsum(np.frombuffer(lengths, dtype=np.int32)).tolist()
    ranks = {tokens[a:b]: i for a, b, i in zip([0, *ends], ends, np.frombuffer(ids, dtype=np.int32).tolist())}
    return Codec(spec, pattern, ranks, newer)


def _maker(df: DataFrame, ranks: dict[bytes, int], pattern: str) -> Callable[[], Codec]:
    """The vocabulary has a fixed size and is broadcast, so executors need not see its file."""
    held = df.sparkSession.sparkContext.broadcast(_spec(frozenset(ranks.items()), pattern))
    return lambda: _codec(*held.value)


@lru_cache(maxsize=2)
def _spec(ranks: frozenset, pattern: str) -> tuple[str, str, bytes, bytes, bytes, str]:
    """What a worker builds its codec from, the ranks as a few byte strings: workers keep what is broadcast."""
    tokens, ids = zip(*ranks) if ranks else ((), ())
    lengths = np.array([len(t) for t in tokens], dtype=np.int32).tobytes()
    packed = np.array(ids, dtype=np.int32).tobytes(), lengths, b"".join(tokens)
    return build_tokenizer(dict(ranks)), pattern, *packed, newer_characters()


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", offsets: bool = False, decoded: bool = False
) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``n_split`` (tokens that begin inside a character);
    with ``offsets``, also ``starts`` and ``ends``, the characters from and to which each reaches;
    with ``decoded``, also the bytes that ``decode`` makes of the ids, by the same worker."""
    codec = _maker(docs, ranks, pattern)
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_split", T.LongType())]
    if offsets:
        fields += [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("starts", "ends")]
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        own = codec()

        def function(array: pa.Array) -> list[pa.Array]:
            texts = [t or "" for t in array.to_pylist()]
            ids = own.encode(texts)
            lengths = [len(x) for x in ids]
            out = [
                lists(np.concatenate([np.zeros(0, np.int32), *ids]), lengths, pa.int32()),
                pa.array([int(own.inside[x].sum()) for x in ids], type=pa.int64()),
            ]
            if offsets:
                both = [own.offsets(t, x) if len(x) else (x, x) for t, x in zip(texts, ids)]
                for side in (0, 1):
                    values = np.concatenate([np.zeros(0, np.int32), *(b[side].astype(np.int32) for b in both)])
                    out.append(lists(values, lengths, pa.int32()))
            if decoded:
                out.append(pa.array([own.decode(x.tolist()) for x in ids], type=pa.binary()))
            return out

        return function

    return with_arrow_columns(docs, text, T.StructType(fields), make, SLICE, after=lambda: codec().forget())


def decode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, ids: str = "ids"
) -> DataFrame:
    """``docs`` with ``decoded`` (the tokens' bytes). Null ids have none; an id outside the
    vocabulary is an error. ``decoded_text`` makes text of the bytes."""
    codec = _maker(docs, ranks, pattern)

    def run(batches):
        own = codec()
        for batch in batches:
            at = batch.schema.get_field_index("__ids")
            rest = [i for i in range(batch.num_columns) if i != at]
            lengths = pc.fill_null(pc.list_value_length(batch.column(at)), 0)
            for part in slices(batch, lengths.to_pylist(), DECODED):
                n = pc.fill_null(pc.list_value_length(part.column(at)), 0).to_numpy().astype(np.int64)
                decoded = own.decode_many(part.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.int64, casting="safe"), n)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in rest), decoded],
                    names=[*(batch.schema.field(i).name for i in rest), "decoded"],
                )

    from logsieve.llm.base import columns, quoted, without

    kept = without(docs, ["decoded"])
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("decoded", T.BinaryType())])
    return docs.select(*columns(docs, kept), F.col(quoted(ids)).alias("__ids")).mapInArrow(released(run), schema)


def decoded_text(data: bytes) -> str:
    """Text of any run of tokens; pieces of characters at its edges become U+FFFD."""
    return data.decode("utf-8", errors="replace")
