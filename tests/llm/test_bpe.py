import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from logsieve.llm.bpe import Codec, build_tokenizer, decode, decoded_text, encode, newer_characters, read_ranks


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def exact(ranks):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec(ranks):
    return Codec(build_tokenizer(ranks), public_tokenizers.PATTERN, ranks, newer_characters())


def random_texts(n, seed):
    r = random.Random(seed)
    makers = [
        lambda: r.choice("aeot -=.*#\n\t"[r.randrange(10) :] or " ") * r.randrange(1, 90),
        lambda: "".join(r.choice("ab ") for _ in range(r.randrange(40))),
        lambda: "".join(chr(r.choice([r.randrange(32, 127), r.randrange(0xA0, 0x600), r.randrange(0x4E00, 0x9FFF), r.randrange(0x1F300, 0x1FAFF), r.randrange(0x323B0, 0x33480)])) for _ in range(r.randrange(30))),
        lambda: " ".join(r.choice(["the", "ando", "Köln", "año", "I'll", "don't", "1234", "x" * 70, "<|endoftext|>"]) for _ in range(r.randrange(12))),
    ]
    return ["".join(r.choice(makers)() for _ in range(r.randrange(5))) for _ in range(n)]


def test_same_ids_as_tiktoken(codec, exact):
    texts = ["", " ", "\r\n \x85 x", "ԥ՘a ꟎1", *random_texts(4000, 1)]
    ids = codec.encode(texts)
    for text, got in zip(texts, ids):
        assert got.tolist() == exact.encode_ordinary(text), text
        assert codec.decode(got.tolist()).decode() == text


def test_offsets_cover_the_text(codec):
    for text in random_texts(300, 2):
        (ids,) = codec.encode([text])
        if not len(ids):
            continue
        starts, ends = codec.offsets(text, ids)
        assert starts[0] == 0 and ends[-1] == len(text)
        assert all(a <= b for a, b in zip(starts[1:], ends))  # no gap
        for i, a, b in zip(ids.tolist(), starts, ends):
            assert codec.bytes[i] in text[a:b].encode()


def test_frames(spark, ranks, exact):
    long = "Wort für Wort 12 " * 20_000
    rows = [(1, "añb 🙂", "x"), (1, "añb 🙂", "x"), (None, None, None), (3, "", "y"), (4, long, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    out = decode(encode(docs, ranks, public_tokenizers.PATTERN, offsets=True), ranks, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "n_split", "starts", "ends", "decoded"]
    got = out.collect()
    assert len(got) == 5
    for row in got:
        assert row.ids == exact.encode_ordinary(row.text or "")
        assert bytes(row.decoded).decode() == (row.text or "")
        assert len(row.starts) == len(row.ends) == len(row.ids)
    assert encode(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_split_characters(codec):
    (ids,) = codec.encode(["🜁"])
    assert len(ids) > 1
    assert decoded_text(codec.decode(ids.tolist())) == "🜁"
    assert "�" in decoded_text(codec.decode(ids.tolist()[:1]))


def test_pieces_are_merged_in_few_calls(codec, exact, monkeypatch):
    """New pieces of usual length take no call of the slower library; long ones and zero bytes do, with the same ids."""
    calls = []

    class Counted:
        def encode(self, part, **options):
            calls.append(list(part))
            return tokenizer.encode(part, **options)

    tokenizer = codec.tokenizer
    monkeypatch.setattr(codec, "tokenizer", Counted())
    codec.forget()
    usual = [t for t in random_texts(2000, 5) if max(map(len, codec.pieces(t)), default=0) <= 64]
    odd = ["\0", "a\0\0b \0", "!\0?" * 30, "x" * 65, " " * 300 + "y", "z" * 50_000]
    for texts, any_calls in ((usual, False), (odd, True)):
        for text, got in zip(texts, codec.encode(texts)):
            assert "z" * 50_000 in text or got.tolist() == exact.encode_ordinary(text), text
            assert codec.decode(got.tolist()).decode() == text
        assert bool(calls) == any_calls
    codec.forget()


def test_pieces_with_other_ranks():
    """A vocabulary without some bytes, and one whose ids have gaps."""
    whole = {bytes([b]): 2 * b for b in range(256)} | {b"ab": 600, b"abc": 700}
    for ranks in (whole, {t: i for t, i in whole.items() if t != b"\0"}):
        codec = Codec(build_tokenizer(ranks), public_tokenizers.PATTERN, ranks, "")
        (ids,) = codec.encode(["abcab c"])
        assert ids.tolist() == [700, 600, 64, 198]


def test_decode_many(codec):
    texts = ["", "añb 🙂", "", "x" * 1000, ""]
    ids = codec.encode(texts)
    got = codec.decode_many(codec.encode([""])[0].astype("int64"), [0, 0]).to_pylist()
    assert got == [b"", b""]
    flat = [i for x in ids for i in x.tolist()]
    many = codec.decode_many(np.array(flat), [len(x) for x in ids])
    assert many.to_pylist() == [t.encode() for t in texts]


def test_decode_of_null_lists(spark, ranks):
    docs = spark.createDataFrame([(1, [72, 73]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in decode(docs, ranks, public_tokenizers.PATTERN).collect()}
    name = {i: t for t, i in ranks.items()}
    assert got == {1: name[72] + name[73], 2: b"", 3: b""}
    with pytest.raises(Exception):
        decode(spark.createDataFrame([(1, [10_000_000])], "doc_id long, ids array<int>"), ranks, public_tokenizers.PATTERN).collect()
