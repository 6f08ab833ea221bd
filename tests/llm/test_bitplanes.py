import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shoplake.llm import bitplanes
from shoplake.llm.common import fresh_path
from shoplake.llm.queries import op1_bitplane_ids
from shoplake.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("planes", ["bit", "byte"])
@pytest.mark.parametrize("ids", [[0], [0, 0, 0], [1, 2, 3, 70000], list(range(49408)), [2**32 - 1, 0, 5]])
def test_round_trip_of_planes(planes, ids):
    got = bitplanes.unpack(bitplanes.pack(np.array(ids, "<u4"), planes), len(ids), planes)
    assert got.tolist() == ids


def test_words_encode_as_whole_texts():
    words, whole = WordEncoder(PATH, capacity=50), Tokenizer.from_file(PATH)
    texts = [
        "", " ", "Hello, World! it's 10.5% of <|endoftext|> and <|ENDOFTEXT|>",
        "Größe ÀÉ İstanbul ΑΣ. ΣΑΣ ﬁ Ǆ été H̱a x y z a\tb\r\nc", "don't I'LL we've 'S 's's",
        "a.b. c,, d., .", "x" * 300 + ". " + "y" * 3000, "日本語 text 한국어 \U0001f600!", "\x1c\x1d a\x85b",
    ]
    for text in texts * 2:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_crc_of_pieces():
    data = bytes(range(256)) * 9
    for cut in (0, 1, 700, len(data)):
        a, b = data[:cut], data[cut:]
        assert bitplanes.crc_before(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(data)


def brute(rows):
    whole, at, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def key(rows):
    return sorted(rows, key=lambda r: r[1])


@pytest.mark.parametrize("block_ids", [7, 1 << 16])
def test_files_hold_every_document(spark, block_ids):
    rows = [(5, "two words"), (1, None), (3, "word " * 500), (None, "lost"), (2, ""), (4, "The end."), (9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as part", "2 as start", "3 as ids")
    path = fresh_path(spark, "ids")
    bitplanes.write_ids(docs, path, PATH, 2, block_ids=block_ids)
    assert key(tuple(r) for r in bitplanes.digests(spark, path).collect()) == brute(rows)
    ids = {}
    for r in bitplanes.read_segments(spark, path).orderBy("part", "start").collect():
        ids[r.doc_id] = ids.get(r.doc_id, b"") + bytes(r.ids)
    assert len(ids[3]) == 4 * 501 and ids[None][-4:] == b"\2\0\0\0"


def test_repeated_rows_and_no_rows(spark):
    rows = [(1, "a b c")] * 3 + [(1, "d")]
    path = fresh_path(spark, "ids")
    bitplanes.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH, 2)
    got = key(tuple(r) for r in bitplanes.digests(spark, path).collect())
    assert sorted(r[2] for r in got) == [2, 4, 4, 4] and got[-1][1] + got[-1][2] == 14
    path = fresh_path(spark, "ids")
    bitplanes.write_ids(spark.createDataFrame([], "doc_id long, text string"), path, PATH, 2)
    assert bitplanes.digests(spark, path).collect() == []


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert key(tuple(r) for r in op1_bitplane_ids(spark, sf_dir).collect()) == brute(rows)
