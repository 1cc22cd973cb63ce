"""Round trips of token files, partial reads, damage, and ids against the library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from ledgermill.llm import token_files
from ledgermill.llm.token_files import (
    DamagedFile,
    FileReader,
    FileWriter,
    WordEncoder,
    open_store,
    read_documents,
    read_token_files,
    write_token_files,
)

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["'s", "'", " ", "\n", "a", "B", "re", "é", "é", "漢", "1", "²", "!", "##", "<|endoftext|>", "<|EndOfText|>",
          "<|startoftext|>", "text|>", " ", "　", "İ", "ſ", "Σ", "́", "aaaa", "\x00"]


def test_words_encode_as_the_library_encodes_texts():
    draw = random.Random(3)
    texts = ["".join(draw.choices(PIECES, k=draw.randint(0, 12))) for _ in range(3000)]
    ids, counts = WordEncoder(PATH, 1).encode(pa.array(texts))
    expected = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    at = 0
    for found, count in zip(expected, counts, strict=True):
        assert ids[at : at + count].tolist() == found.ids + [1]
        at += count


def library_ids(texts):
    return [e.ids + [1] for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_odd_documents_round_trip(spark, odd_docs, odd_texts, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 1000)
    folder = str(tmp_path / "t")
    known = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    manifest = write_token_files(known, folder, PATH, 1)
    expected, start = library_ids(odd_texts), 0
    rows = {r.doc_id: r for r in read_token_files(spark, folder).collect()}
    for i, ids in enumerate(expected):
        sum32 = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), sum32)
        start += len(ids)
    assert sum(f["ids"] for f in manifest["files"]) == start
    got = dict(read_documents(folder, [4, 8, 99]))
    assert sorted(got) == [4, 8] and got[8].tolist() == expected[8] and got[4].tolist() == expected[4]


def test_only_needed_frames_are_unpacked_and_damage_is_seen(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 1000)
    path = tmp_path / "one.zst"
    counts = np.array([10, 50_000, 0, 1_500])
    ids = np.random.default_rng(1).integers(0, 49_408, counts.sum())
    with open(path, "wb") as sink:
        writer = FileWriter(sink)
        writer.add([5, 6, 7, 9], counts, ids)
        assert writer.close() == counts.sum()
    with pa.OSFile(str(path)) as source:
        reader = FileReader(source)
        assert len(reader.sizes) == 52 and reader.keys.tolist() == [5, 6, 7, 9]
        assert reader.tokens(0).tolist() == ids[:10].tolist() and reader.unpacked == 1
        assert reader.tokens(3).tolist() == ids[-1500:].tolist() and reader.unpacked == 3
        assert len(reader.tokens(2)) == 0
        whole = b"".join(reader.frame(k).tobytes() for k in range(len(reader.sizes)))
    # Any zstandard reader gets the ids and skips the tables.
    assert zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(path.read_bytes()) == whole
    raw = bytearray(path.read_bytes())
    raw[len(raw) - 9 - 4] ^= 1
    path.write_bytes(raw)
    with pa.OSFile(str(path)) as source, pytest.raises(DamagedFile):
        reader = FileReader(source)
        [reader.frame(k) for k in range(len(reader.sizes))]


def test_missing_and_repeated_ids(spark, odd_docs, no_docs, tmp_path):
    folder = str(tmp_path / "t")
    write_token_files(odd_docs, folder, PATH, 1)
    rows = read_token_files(spark, folder).collect()
    assert len(rows) == odd_docs.count() and sum(r.doc_id is None for r in rows) == 1
    assert [r.start for r in rows if r.doc_id is None] == [0]
    empty = str(tmp_path / "e")
    assert write_token_files(no_docs, empty, PATH, 1)["files"] == []
    assert read_token_files(spark, empty).count() == 0


def test_local_folders_need_no_address(tmp_path):
    store, top = open_store(str(tmp_path))
    assert top == str(tmp_path) and store.get_file_info(top).is_file is False
