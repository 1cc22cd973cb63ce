"""Token ids in seekable files: independent zstandard frames, a seek table, checksums.

A file holds the ids of a range of documents as little-endian unsigned 32-bit
integers, cut into frames of ``FRAME_IDS`` ids. Two skippable frames follow: the
document index (ids and token counts) and the seek table of the public seekable
format, with sizes and a checksum (low 32 bits of XXH64) of every frame. Any
zstandard reader can unpack the whole file; this module's reader finds a
document's place in the index and unpacks only the frames it lies in.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgermill.llm.ordered import AT, range_bounds, shuffle_tasks, with_range
from ledgermill.llm.ragged import ragged_range, split_words, text_slices

#: Fixed values of the seekable format.
SEEK_MAGIC, SEEK_FOOTER, INDEX_MAGIC = 0x184D2A5E, 0x8F92EAB1, 0x184D2A50
CHECKSUM_FLAG = 0x80
FRAME_IDS = 1 << 16
#: Text bytes whose distinct words are encoded together.
ENCODE_BYTES = 12 << 20
LEVEL = 3
#: Stands for a NULL id in the index of a file.
NO_ID = -(1 << 63)
MANIFEST = "manifest.json"


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address and the path in it."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


class FileWriter:
    """Builds one file: ids go into frames as they come, index and seek table at the end."""

    def __init__(self, sink) -> None:
        self.sink, self.pending, self.held = sink, [], 0
        self.frames: list[tuple[int, int, int]] = []
        self.keys: list[int] = []
        self.counts: list[int] = []
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)

    def add(self, keys: list[int], counts: np.ndarray, ids: np.ndarray) -> None:
        self.keys += keys
        self.counts += counts.tolist()
        self.pending.append(ids.astype("<u4"))
        self.held += len(ids)
        if self.held >= FRAME_IDS:
            self.flush(False)

    def flush(self, last: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, "<u4")
        full = len(ids) if last else len(ids) // FRAME_IDS * FRAME_IDS
        for at in range(0, full, FRAME_IDS):
            raw = ids[at : at + FRAME_IDS].tobytes()[: 4 * (full - at)]
            packed = self.packer.compress(raw)
            self.sink.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.pending, self.held = [ids[full:]], len(ids) - full

    def close(self) -> int:
        """Write what is left and the tables; gives the number of ids."""
        self.flush(True)
        index = self.packer.compress(
            np.array(self.keys, "<i8").tobytes() + np.array(self.counts, "<i8").tobytes()
        )
        body = struct.pack("<I", len(self.keys)) + index
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(body)) + body)
        table = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_FOOTER)
        self.sink.write(struct.pack("<II", SEEK_MAGIC, len(table) + len(footer)) + table + footer)
        return sum(self.counts)


class DamagedFile(ValueError):
    """A frame or table does not agree with its checksum or format."""


@dataclass
class FileReader:
    """Reads chosen documents of one file. ``unpacked`` counts the frames it had to unpack."""

    source: pa.NativeFile
    unpacked: int = 0

    def __post_init__(self) -> None:
        size = self.source.size()
        frames, flag, magic = struct.unpack("<IBI", self.source.read_at(9, size - 9))
        if magic != SEEK_FOOTER or flag != CHECKSUM_FLAG:
            raise DamagedFile("no seek table at the end of the file")
        table = self.source.read_at(12 * frames, size - 9 - 12 * frames)
        entries = np.frombuffer(table, "<u4").reshape(frames, 3).astype(np.int64)
        self.sizes, self.raw_sizes, self.sums = entries.T
        self.at = np.concatenate([[0], np.cumsum(self.sizes)])
        index_at = int(self.at[-1])
        magic, length = struct.unpack("<II", self.source.read_at(8, index_at))
        if magic != INDEX_MAGIC:
            raise DamagedFile("no document index after the frames")
        body = self.source.read_at(length, index_at + 8)
        documents = struct.unpack("<I", body[:4])[0]
        columns = np.frombuffer(zstandard.ZstdDecompressor().decompress(body[4:]), "<i8")
        self.keys, self.counts = columns[:documents], columns[documents:]
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.held: tuple[int, np.ndarray] | None = None

    def frame(self, k: int) -> np.ndarray:
        """Ids of a frame, checked; the last one unpacked is held."""
        if self.held is None or self.held[0] != k:
            raw = zstandard.ZstdDecompressor().decompress(self.source.read_at(int(self.sizes[k]), int(self.at[k])))
            if len(raw) != self.raw_sizes[k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
                raise DamagedFile(f"frame {k} does not agree with its checksum")
            self.unpacked += 1
            self.held = (k, np.frombuffer(raw, "<u4"))
        return self.held[1]

    def tokens(self, document: int) -> np.ndarray:
        """Ids of the document at a place of the index."""
        first, last = int(self.starts[document]), int(self.starts[document + 1])
        parts = [
            self.frame(k)[max(0, first - k * FRAME_IDS) : last - k * FRAME_IDS]
            for k in range(first // FRAME_IDS, -(-last // FRAME_IDS))
        ]
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")


class WordEncoder:
    """Ids of whole texts from ids of their distinct words.

    Right for tokenizers that drop white space and never merge across it, as the
    word-end vocabulary does: the ids of a text are those of its words in turn.
    Distinct words go to the library many at a time.
    """

    WORDS_AT_ONCE = 4096
    #: Bytes of words whose ids are kept for later slices of the task; beyond it the table starts anew.
    TABLE_BYTES = 16 << 20

    def __init__(self, path: str, end_id: int) -> None:
        self.library = Tokenizer.from_file(path)
        self.end_id = end_id
        self.forget()
        self.specials = {k: t.content for k, t in sorted(self.library.get_added_tokens_decoder().items()) if t.special}

        #: Whether the vocabulary has no capitals, so that words can be lower-cased before they are told apart.
        self.folds = "Lowercase" in str(json.loads(self.library.to_str())["normalizer"])

    def near_special(self, column: pa.Array) -> bool:
        """Whether a text holds a special string in any case: lower-casing could make it one."""
        return any(
            pc.any(pc.match_substring(column, s, ignore_case=True)).as_py() for s in self.specials.values()
        )

    def alone(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def parted(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of words, with a special string between them to tell them apart."""
        between_id, between = next(iter(self.specials.items()))
        if any(between in w for w in words):
            lists = self.alone(words)
            return np.array([i for x in lists for i in x], np.int64), np.array([len(x) for x in lists], np.int64)
        text = between.join(words) + between
        found = np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64)
        stops = np.flatnonzero(found == between_id)
        return found[found != between_id], np.diff(stops, prepend=-1) - 1

    def spaced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of words of simple characters, with blanks between them; a token's place tells its word."""
        encoding = self.library.encode(" ".join(words), add_special_tokens=False)
        starts = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
        places = np.fromiter((a for a, _ in encoding.offsets), np.int64, len(encoding))
        owner = np.searchsorted(starts, places, side="right") - 1
        return np.array(encoding.ids, np.int64), np.bincount(owner, minlength=len(words))

    def word_ids(self, vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the count of each."""
        # Below U+0130 composing and lower-casing keep the number of characters, so places stay true.
        texts = [w.decode("utf-8") for w in vocabulary]
        plain = np.array([w.isascii() or max(w) < "\u0130" for w in texts], bool)
        counts = np.zeros(len(vocabulary), np.int64)
        bodies = []
        for chosen, work in ((np.flatnonzero(plain), self.spaced), (np.flatnonzero(~plain), self.parted)):
            for at in range(0, len(chosen), self.WORDS_AT_ONCE):
                some = chosen[at : at + self.WORDS_AT_ONCE]
                body, counts[some] = work([texts[k] for k in some.tolist()])
                bodies.append(body)
        # Back into the order of the vocabulary.
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        laid = np.cumsum(counts[order]) - counts[order]
        first = np.zeros(len(vocabulary), np.int64)
        first[order] = laid
        flat = np.concatenate([*bodies, np.zeros(0, np.int64)])
        return flat[np.repeat(first, counts) + ragged_range(counts)], counts

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.known_bytes = 0
        self.flat, self.first, self.count = (np.zeros(0, np.int64) for _ in range(3))

    def looked_up(self, vocabulary: list[bytes]) -> np.ndarray:
        """The places of words in the table of ``flat``, ``first`` and ``count``; new words are added to it."""
        if self.known_bytes > self.TABLE_BYTES:
            self.forget()
        new = [w for w in vocabulary if w not in self.known]
        if new:
            flat, counts = self.word_ids(new)
            self.first = np.append(self.first, len(self.flat) + np.cumsum(counts) - counts)
            self.flat, self.count = np.append(self.flat, flat), np.append(self.count, counts)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.known_bytes += sum(map(len, new))
        return np.fromiter(map(self.known.__getitem__, vocabulary), np.int64, len(vocabulary))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the end id behind it, and the count of each text."""
        words = split_words(column, lower=self.folds and not self.near_special(column))
        places = self.looked_up(words.vocabulary.to_pylist())
        flat, sizes = np.append(self.flat, self.end_id), np.append(self.count[places], 1)
        firsts = np.append(self.first[places], len(self.flat))
        # The end id stands as a word of its own behind each text.
        codes = np.insert(words.codes, words.bounds[1:], len(sizes) - 1)
        each = sizes[codes]
        ids = flat[np.repeat(firsts[codes], each) + ragged_range(each)]
        running = np.concatenate([[0], np.cumsum(each)])
        ends = running[words.bounds[1:] + np.arange(1, len(words.bounds))]
        return ids, np.diff(ends, prepend=0)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> dict[str, object]:
    """Write the ids of all texts in ascending id order; gives the manifest, also stored beside the files.

    NULL and empty texts have the end id alone. Rows of equal id are all kept,
    ordered by a hash of their text. Rows with a NULL id come first and cannot be
    asked for. An empty table gives a manifest without files. Each range of ids makes
    one file; a task writes under a name of its own and renames it when complete,
    so a repeated task replaces a file by the same bytes.
    """
    bounds = range_bounds(docs, id_column)
    key = F.coalesce(F.col(id_column).cast("bigint"), F.lit(NO_ID))
    rows = (
        with_range(docs.select(key.alias("id"), F.col(text_column).alias("text")), "id", bounds)
        .repartition(shuffle_tasks(docs), AT)
        .sortWithinPartitions(AT, "id", F.xxhash64("text"))
        .select(F.col(AT).alias("range"), "id", "text")
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_store(folder)
        encoder = WordEncoder(tokenizer_path, end_id)
        current, writer, sink, partial = None, None, None, ""

        def finish() -> pa.RecordBatch:
            total = writer.close()
            sink.close()
            name = f"range-{current:07d}.zst"
            store.move(partial, f"{top}/{name}")
            return pa.RecordBatch.from_pydict(
                {"range": pa.array([current], pa.int32()), "name": [name], "ids": pa.array([total], pa.int64()), "documents": pa.array([len(writer.keys)], pa.int64())}
            )

        for part in text_slices(batches, limit=ENCODE_BYTES):
            numbers = part.column("range").to_numpy()
            ids, counts = encoder.encode(part.column("text"))
            ends = np.concatenate([[0], np.cumsum(counts)])
            keys = part.column("id").to_pylist()
            change = (np.flatnonzero(np.diff(numbers)) + 1).tolist()
            for a, b in zip([0, *change], [*change, part.num_rows], strict=True):
                if numbers[a] != current:
                    if writer:
                        yield finish()
                    current = int(numbers[a])
                    partial = f"{top}/.{uuid.uuid4().hex}"
                    sink = store.open_output_stream(partial)
                    writer = FileWriter(sink)
                writer.add(keys[a:b], counts[a:b], ids[ends[a] : ends[b]])
        if writer:
            yield finish()

    store, top = open_store(folder)
    store.create_dir(top, recursive=True)
    # One row per range comes to the driver.
    files = sorted(rows.mapInArrow(written, "range int, name string, ids bigint, documents bigint").collect(), key=lambda r: r["range"])
    starts = accumulate((r["ids"] for r in files), initial=0)
    manifest: dict[str, object] = {
        "end_id": end_id,
        "files": [{"name": r["name"], "start": s, "ids": r["ids"], "documents": r["documents"]} for r, s in zip(files, starts, strict=False)],
    }
    with store.open_output_stream(f"{top}/{MANIFEST}") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> dict[str, object]:
    store, top = open_store(folder)
    with store.open_input_stream(f"{top}/{MANIFEST}") as source:
        return json.loads(source.read())


def read_documents(folder: str, wanted: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Ids of chosen documents; only the frames that hold them are unpacked."""
    asked = set(wanted)
    store, top = open_store(folder)
    for entry in read_manifest(folder)["files"]:
        with store.open_input_file(f"{top}/{entry['name']}") as source:
            reader = FileReader(source)
            for place in np.flatnonzero(np.isin(reader.keys, list(asked))):
                yield int(reader.keys[place]), reader.tokens(int(place))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32; every frame is checked."""
    entries = read_manifest(folder)["files"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_store(folder)
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with store.open_input_file(f"{top}/{name}") as source:
                    reader = FileReader(source)
                    sums = [zlib.crc32(reader.tokens(k)) for k in range(len(reader.keys))]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reader.keys.astype(np.int64), mask=reader.keys == NO_ID),
                            pa.array(start + reader.starts[:-1]),
                            pa.array(reader.counts.astype(np.int64)),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    names = spark.createDataFrame([(e["name"], e["start"]) for e in entries], "name string, start bigint")
    tasks = max(1, min(len(entries), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return names.repartition(tasks).mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
