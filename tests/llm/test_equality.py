"""Long regular texts that a polynomial hash takes for one another stay apart."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from encore.llm import chat, packing, repeats, tokenfiles
from encore.llm import wordhash as wh
from encore.llm.common import block_of, byte_buffer
from encore.llm.encoding import Encoder
from encore.llm.queries import tokenizer_path
from tests.llm import helpers as h

PATH = tokenizer_path()
SIZES = [512, 1024, 4096, 65536]


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def pair(n):
    return thue_morse(n), thue_morse(n, "b", "a")


def library(text):
    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def encoded(encoder, texts):
    ids, at = encoder.encode(*byte_buffer(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


@pytest.mark.parametrize("n", SIZES)
def test_encoder_tells_long_cuts_apart(n):
    texts = [*pair(n), *pair(n)[::-1], "a " + pair(n)[1]]
    want = [library(t) for t in texts]
    encoder = Encoder(PATH)
    assert encoded(encoder, texts) == want  # in one piece
    fresh = Encoder(PATH)
    assert [encoded(fresh, [t])[0] for t in texts] == want  # the second against what is kept


def test_encoder_with_colliding_hashes_asks_the_library(monkeypatch):
    monkeypatch.setattr(Encoder, "_hashes", staticmethod(lambda lanes, number, first, sizes: (sizes % 3).astype(np.uint64)))
    encoder, texts = Encoder(PATH), ["one two three", "two one", "a\0", "a", "", "four"]
    for _ in range(2):
        assert encoded(encoder, texts) == [library(t) if t else [] for t in texts]
        assert [encoded(encoder, [t])[0] for t in texts] == [library(t) if t else [] for t in texts]


@pytest.mark.parametrize("n", SIZES)
def test_words_and_windows_are_told_apart(n):
    data, offsets = byte_buffer(pa.array([" ".join(pair(n))]))
    starts, ends, _ = wh.word_spans(data, offsets)
    assert len(set(wh.word_keys(data, starts, ends).tolist())) == 2
    for size in (n, n - 1, 35):
        words = [np.array([7 if c == "a" else 11 for c in t], np.uint64) for t in pair(n)]
        a, b = (wh.window_hashes(w, size, 3) for w in words)
        assert len(a) == n - size + 1 and a[0] != b[0]
        assert len(set(wh.window_hashes(np.concatenate(words), size, 3).tolist())) >= min(2 * n - size + 1, 2)


def test_window_hashes_equal_where_words_do():
    words = np.random.default_rng(3).integers(0, 3, 4000).astype(np.uint64)
    for size in (1, 2, 7, 8, 35):
        found = wh.window_hashes(words, size, 4)
        plain = [tuple(words[i:i + size].tolist()) for i in range(len(words) - size + 1)]
        assert len(found) == len(plain) and len(set(zip(found.tolist(), plain))) == len(set(found.tolist())) == len(set(plain))


def test_lanes_hold_the_bytes():
    data = np.frombuffer(b"abcdefghi" + b"\0" * 9 + b"xyz", np.uint8)
    starts, ends = np.array([0, 9, 10, 18, 20]), np.array([9, 10, 18, 20, 21])
    values, number, first = wh.lanes(data, starts, ends)
    assert first.tolist() == [0, 2, 3, 4, 5, 6] and number.tolist() == [0, 1, 0, 0, 0, 0]
    assert [v.to_bytes(8, "little").rstrip(b"\0") for v in values.tolist()] == [b"abcdefgh", b"i", b"", b"", b"xy", b"z"]
    keys = wh.lane_hashes(values, number, first, ends - starts)
    assert len(set(keys.tolist())) == 5  # one zero byte isn't eight


@pytest.mark.parametrize("n", [1024, 65536])
def test_only_equal_words_repeat(spark, n):
    words = [f"w{i}" for i in range(34)]
    texts = [" ".join([*words, x]) for x in pair(n)]
    assert {r.n_removed for r in repeats.remove_repeats(h.documents(spark, texts), blocks=2).collect()} == {0}
    assert {r.n_removed for r in repeats.remove_repeats(h.documents(spark, texts + texts[:1]), blocks=2).collect()} == {0, 35}


@pytest.mark.parametrize("n", [1024, 65536])
def test_files_pieces_and_turns_hold_the_right_text(spark, n):
    texts = list(pair(n))
    docs = h.documents(spark, texts).coalesce(1)
    crc = lambda ids: zlib.crc32(np.asarray(ids, "<u4").tobytes())
    want = [crc([*library(t), 0]) for t in texts]
    assert [r.ids_crc32 for r in sorted(tokenfiles.round_trip(docs, PATH).collect(), key=lambda r: r.doc_id)] == want
    packed = packing.pack_documents(docs, PATH, sequence=1 << 20).collect()
    assert [r.ids_crc32 for r in sorted(packed, key=lambda r: r.doc_id)] == want
    turns = spark.createDataFrame([(1, 0, "user", texts[0]), (1, 1, "assistant", texts[1])], "conv_id long, turn int, role string, text string")
    row = chat.round_trip(turns, PATH).first()
    assert row.loss_sha256 == hashlib.sha256(texts[1].encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{texts[0]}\nassistant\n{texts[1]}\n".encode()).hexdigest()


def test_repeats_of_one_row_in_one_file_fill_no_block(spark, scratch):
    h.documents(spark, ["x y z"] * 2000, [7] * 2000).coalesce(1).write.parquet(scratch)
    dealt = spark.read.parquet(scratch).groupBy(block_of(8, "doc_id", "text").alias("b")).count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 500
    found = repeats.remove_repeats(spark.read.parquet(scratch), blocks=8)
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString() or found.count() == 2000
