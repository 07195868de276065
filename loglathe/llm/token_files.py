"""Token files: ids packed to a fixed number of bits, in blocks that can be read alone.

A file holds the documents of one range of ids, in ascending order::

    magic "TOKPACK1", bits, ids a block        a header of 16 bytes
    block, block, ...                          packed little-endian, each starts at a byte
    doc ids, null flags, end positions         the index: int64, uint8, uint64 each
    block offsets                              uint64, one more than blocks
    documents, ids, blocks, index offset       uint64 each, then the magic

Ids take the fewest bits that hold the vocabulary; a block is unpacked by numpy at once, and any document can be read by
its number. Files are written by the tasks that encode, under names of their own; a file counts once the manifest row that
names it has been committed by Spark, so attempts that failed leave nothing that is read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglathe.llm.common import map_arrow, query, small_batches, stored, table
from loglathe.llm.textops import texts_of
from loglathe.session import scratch_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
MAGIC = b"TOKPACK1"
BLOCK_IDS = 1 << 16
#: distinct words whose ids a worker remembers, and the longest of them
KNOWN_WORDS, KNOWN_LENGTH = 500_000, 48


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    flags = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(flags, bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    flags = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = flags
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def _system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or URI, as the executors reach it."""
    if "://" in path or path.startswith("file:"):
        return pa.fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pa.fs.LocalFileSystem(), path


class TokenWriter:
    """Writes one file, holding a block and the index in memory."""

    def __init__(self, path: str, bits: int) -> None:
        system, place = _system(path)
        system.create_dir(os.path.dirname(place), recursive=True)
        self.out, self.bits = system.open_output_stream(place), bits
        self.at = self.out.write(struct.pack("<8sII", MAGIC, bits, BLOCK_IDS))
        self.open_ids: list[np.ndarray] = []
        self.held = self.total = 0
        self.doc_ids: list[int] = []
        self.nulls: list[int] = []
        self.ends: list[int] = []
        self.offsets = [self.at]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.total += len(ids)
        self.ends.append(self.total)
        self.open_ids.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            whole = np.concatenate(self.open_ids)
            full = self.held - self.held % BLOCK_IDS
            for a in range(0, full, BLOCK_IDS):
                self._block(whole[a : a + BLOCK_IDS])
            self.open_ids, self.held = [whole[full:].copy()], self.held - full

    def _block(self, ids: np.ndarray) -> None:
        self.at += self.out.write(pack(ids, self.bits))
        self.offsets.append(self.at)

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.open_ids))
        self.out.write(np.array(self.doc_ids, "<i8").tobytes())
        self.out.write(np.array(self.nulls, np.uint8).tobytes())
        self.out.write(np.array(self.ends, "<u8").tobytes())
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(struct.pack("<QQQQ8s", len(self.doc_ids), self.total, len(self.offsets) - 1, self.at, MAGIC))
        self.out.close()


class TokenReader:
    """Random access to the documents of one file."""

    def __init__(self, path: str) -> None:
        system, place = _system(path)
        self.file = system.open_input_file(place)
        magic, self.bits, self.block_ids = struct.unpack("<8sII", self.file.read_at(16, 0))
        size = self.file.size()
        docs, self.total, blocks, index, tail = struct.unpack("<QQQQ8s", self.file.read_at(40, size - 40))
        if magic != MAGIC or tail != MAGIC:
            raise ValueError(f"Not a token file, or cut off: {path}")
        raw = self.file.read_at(size - 40 - index, index)
        self.doc_ids = np.frombuffer(raw, "<i8", docs)
        self.nulls = np.frombuffer(raw, np.uint8, docs, 8 * docs).astype(bool)
        self.ends = np.frombuffer(raw, "<u8", docs, 9 * docs).astype(np.int64)
        self.offsets = np.frombuffer(raw, "<u8", blocks + 1, 17 * docs).astype(np.int64)
        self._at, self._ids = -1, np.zeros(0, np.uint32)

    def __len__(self) -> int:
        return len(self.ends)

    def block(self, no: int) -> np.ndarray:
        if no != self._at:
            a, b = int(self.offsets[no]), int(self.offsets[no + 1])
            count = min(self.block_ids, self.total - no * self.block_ids)
            self._at, self._ids = no, unpack(self.file.read_at(b - a, a), count, self.bits)
        return self._ids

    def pieces(self, doc: int) -> Iterator[np.ndarray]:
        """The ids of the document with this number, block by block."""
        at, end = int(self.ends[doc - 1]) if doc else 0, int(self.ends[doc])
        while at < end:
            no, inside = divmod(at, self.block_ids)
            piece = self.block(no)[inside : inside + end - at]
            at += len(piece)
            yield piece

    def ids(self, doc: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint32), *self.pieces(doc)])


#: letters of Latin-1 and then ASCII signs: the tokenizer parts such a word there, and lower case has as many letters
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class WordEncoder:
    """Ids of whole texts. The tokenizer never joins across blanks, so words are encoded once and remembered.

    Plain words go to the model of the tokenizer by themselves, in the form that its normalizer and pre-tokenizer give them;
    all others go through the whole tokenizer.
    """

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(tokenizer if os.path.isabs(tokenizer) else public_tokenizers.path(tokenizer))
        self.model = self.whole.model
        self.bytes_as_letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bits = max(1, (self.whole.get_vocab_size() - 1).bit_length())
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        # only where the model alone gives what the tokenizer gives
        self.plain = all(self._letters(w) == self._full(w) for w in ("the", "thenation", "éàüß", "zzqxj"))

    def _full(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _letters(self, word: str) -> bytes:
        if not word.isascii():
            word = self.bytes_as_letters.pre_tokenize_str(word)[0][0]
        return np.array([t.id for t in self.model.tokenize(word)], np.uint32).tobytes()

    def _part(self, text: str, encode: Callable[[str], bytes]) -> bytes:
        ids = self.parts.get(text)
        if ids is None:
            ids = encode(text)
            if len(self.parts) < KNOWN_WORDS and len(text) <= KNOWN_LENGTH:
                self.parts[text] = ids
        return ids

    def _word(self, raw: bytes) -> bytes:
        text = raw.decode()
        m = _PLAIN.fullmatch(text) if self.plain else None
        if m is None:
            return self._full(text)
        ids = self._part(m[1].lower(), self._letters)
        return ids + self._part(m[2], self._full) if m[2] else ids

    def batch(self, column: pa.Array) -> Iterator[np.ndarray]:
        texts = texts_of(column)
        raw = texts.data.tobytes()
        for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True):
            words = raw[a:b].split()  # at exactly the blanks of ASCII
            new = set(words).difference(self.known)
            if not new:
                yield np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.uint32)
                continue
            ids = {w: self._word(w) for w in new}
            if len(self.known) < KNOWN_WORDS:
                self.known.update((w, i) for w, i in ids.items() if len(w) <= KNOWN_LENGTH)
            known = self.known
            yield np.frombuffer(b"".join([ids[w] if w in ids else known[w] for w in words]), np.uint32)


@lru_cache(maxsize=2)
def word_encoder(tokenizer: str) -> WordEncoder:
    """One per worker, which serves many tasks."""
    return WordEncoder(tokenizer)


def write_token_files(docs: DataFrame, folder: str, *, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files of ``folder``; returns ``part, file, docs, ids``, one row per file, in order of ``part``.

    Documents are dealt by ranges of ``doc_id`` and sorted, null ids first; rows of one id by text.  Null and empty texts have the end id only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = writer = None
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tok"
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encoder = word_encoder(tokenizer)
                writer = TokenWriter(name, encoder.bits)
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encoder.batch(batch["text"]), strict=True):
                writer.add(doc_id, np.append(ids, np.uint32(end_id)))
        if writer is not None:
            writer.close()
            yield pa.record_batch(
                [pa.array([x], t) for x, t in ((part, pa.int32()), (name, pa.string()), (len(writer.ends), pa.int64()), (writer.total, pa.int64()))],
                names=["part", "file", "docs", "ids"],
            )

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(run, "part int, file string, docs long, ids long"), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files of ``manifest``.

    ``start`` counts the ids of all documents before.  The one ordered window has a row per file.
    """
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], []]
        for file, start in zip(batch["file"].to_pylist(), batch["start"].to_pylist(), strict=True):
            reader = TokenReader(file)
            sizes = np.diff(reader.ends, prepend=0)
            for doc in range(len(reader)):
                crc = 0
                for piece in reader.pieces(doc):
                    crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                columns[0].append(None if reader.nulls[doc] else int(reader.doc_ids[doc]))
                columns[3].append(crc)
            columns[1] += (start + reader.ends - sizes).tolist()
            columns[2] += sizes.tolist()
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.count()
    return map_arrow(placed.repartition(max(1, files)), run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, **options) -> DataFrame:
    """Write the token files into a new folder of the shared space and describe every document from what they hold.

    Repeated rows are documents of their own.  An empty table gives no file and no row; other columns are ignored.
    """
    return read_token_files(write_token_files(docs, scratch_dir(docs.sparkSession, "tokens"), **options))


@query("op3_token_files")
def op3(spark, sf_dir: str) -> DataFrame:
    return token_table(table(spark, sf_dir, "documents"))
