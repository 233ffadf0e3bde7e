"""Blocks of ids: round trips, single blocks, damage; the written tables against the library itself."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leadloom.llm import forblocks
from leadloom.llm.forblocks import END, Encoder, pack, segment_bytes, segments, unpack
from leadloom.session import fresh_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 50_000), st.integers(0, 2 ** 32 - 1)), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_pack_gives_ids_back(ids):
    starts, data = pack(np.array(ids, dtype=np.uint32))
    assert unpack(np.frombuffer(data, np.uint8), starts)[:len(ids)].tolist() == ids


def test_outliers_are_exceptions():
    ids = np.arange(256, dtype=np.uint32) % 16 + 1000
    _, plain = pack(ids)
    ids[[3, 200]] = 4_000_000_000
    _, patched = pack(ids)
    assert len(plain) == 7 + 128 and len(patched) == 7 + 128 + 2 * 5


def test_segment_reads_single_blocks_and_sees_damage():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 49_408, size=n).astype("<u4").tobytes() for n in (1, 700, 0, 3000)]
    data = segment_bytes(2, 5, 77, [4, None, 9, 10], parts) + END.encode()
    both = list(segments(data + data))
    assert len(both) == 2 and (both[1].partition, both[1].number, both[1].before) == (2, 5, 77)
    assert both[0].doc_ids == [4, None, 9, 10] and both[0].sizes.tolist() == [1, 700, 0, 3000]
    whole = np.frombuffer(b"".join(parts), "<u4")
    assert both[0].ids().tolist() == whole.tolist()
    for first, last in ((0, 1), (255, 257), (300, 3000), (3700, 3701), (5, 5)):
        assert both[0].ids(first, last).tolist() == whole[first:last].tolist()
    assert list(segments(data, heads_only=True)) == [(2, 5, 3701, 77)]
    for broken in (data[:-9], data[:60] + bytes([data[60] ^ 1]) + data[61:], b"x" + data):
        with pytest.raises(ValueError):
            list(segments(broken))


def test_encoder_equals_library_on_whole_texts():
    library = Tokenizer.from_file(PATH)
    texts = ["", " ", "It's  they'll\tgo\n\nHOME 42 x86!", "é é ́x ΑΣ Σ　 a\x1cb\x85c", "<|endoftext|> a<|startoftext|>b",
             "word" * 5000, "don't'S 'RE,'s!'ll l'été D'ÉTÉ a\x01b ß×÷ ǆ", "日本語 テキスト 🙂🙂", "a b\x0bc\x0cd\x00e", "İstanbul ǅ ﬁ",
             "(word) a.b.c ...x... -- x-y! [ÉTÉ]; 'tis' dogs'. 3.14% ½., .½. \u00ad.a <|ENDOFTEXT|> <|x|> ;²; ª! €. .…x…."] * 2
    encoder = Encoder(open(PATH, encoding="utf-8").read(), entries=3)
    assert encoder.by_part
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([t.encode() for t in texts])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_equals_library_on_all_characters():
    library, encoder = Tokenizer.from_file(PATH), Encoder(open(PATH, encoding="utf-8").read())
    for at in range(0, 0x3100, 7):
        text = "".join(f"a{chr(c)}b{chr(c)} {chr(c)}\u0301 " for c in range(at, at + 7))
        for own in (text, text[:9], chr(at) * 3, f"x{chr(at)}'s"):
            assert np.frombuffer(encoder.encode([own.encode()])[0], "<u4").tolist() == library.encode(own, add_special_tokens=False).ids


def test_encoder_takes_whole_texts_by_other_definitions():
    other = public_tokenizers.path("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(other), Encoder(open(other, encoding="utf-8").read())
    text = "Two  words\nand 3 more, é"
    assert not encoder.by_part
    assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def digest(spark, docs):
    path = fresh_path(spark, "ids")
    forblocks.write_ids(docs, PATH, path)
    rows = forblocks.read_ids(spark, path).withColumn("ids_crc32", F.crc32("ids"))
    return path, sorted(map(tuple, rows.select("start", "doc_id", "n_tokens", "ids_crc32").collect()))


def plain(rows):
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        out.append((start, doc_id, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_written_files_equal_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    _, got = digest(spark, docs.repartition(5))
    assert got == plain([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(spark):
    rows = [(7, None), (3, ""), (5, "x " * 30_000), (None, "no id"), (9, "same"), (9, "same"), (-4, "minus"), (1, "a")]
    docs = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, start string, ids int")
    path, got = digest(spark, docs)
    assert got == plain(rows)
    _, empty = digest(spark, docs.limit(0))
    assert empty == []
    # Many copies of one row are split over partitions, and the total is whole.
    _, copies = digest(spark, spark.createDataFrame([(9, "same text")] * 300, "doc_id long, text string"))
    assert copies == plain([(9, "same text")] * 300)


def test_files_hold_many_segments(spark):
    parts = [np.arange(n % 400, dtype="<u4").tobytes() for n in range(300)]
    content, before = b"", 0
    for number, part in enumerate(parts):
        content += segment_bytes(0, number, before, [number], [part]) + END.encode()
        before += len(part) // 4
    path = fresh_path(spark, "ids").removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/part-0", "wb") as file:
        file.write(content)
    rows = forblocks.read_ids(spark, path).collect()
    assert sorted((r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in rows) == [(i, len(p) // 4, p) for i, p in enumerate(parts)]
    assert forblocks.index(spark, path).count() == 300
