"""Token ids as length-delimited binary records, with a separate offset index.

A record file is a run of records::

    length    8 bytes, little endian: bytes of the payload
    check     4 bytes: masked CRC-32 of the length bytes
    payload   head (17 bytes) and the token ids
    check     4 bytes: masked CRC-32 of the payload

The head holds the document id (8 bytes), 1 if that id is null (1 byte), the bytes per
token (4 bytes) and the tokens (4 bytes). Ids take two bytes where the vocabulary
allows it, else four. The masked checksum is the CRC rotated right by 15 bits plus a
constant, so that checksums stored inside checksummed data do no harm.

The index is a parquet table with one row per record: file, byte offset, bytes, token
count. It names only the files of tasks that Spark committed; what a lost attempt left
behind is never read.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vaultwright.llm.common import tidy
from vaultwright.session import scratch_path

HEAD, FRAME, CHECK = "<qBII", "<QI", "<I"
MASK_DELTA = 0xA282EAD8

INDEX_SCHEMA = "doc_id long, file string, place long, byte_offset long, n_bytes long, n_tokens long"
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"

# Before a space or line break that follows a visible character a byte-level vocabulary
# starts a new piece, so a text encodes as its parts cut there do.
SPACE = re.compile(r"[\s\x1c-\x1f\x85\u180e\u200b\ufeff]")
PART = re.compile(r"(?<=[^\s\x1c-\x1f\x85\u180e\u200b\ufeff])(?=[ \n])")
# Parts of these characters alone: their pieces are the same in every version of Unicode.
PLAIN = re.compile(r"[ \n]?[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+")
PIECE = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z\u00c0-\u017f]+| ?[0-9]+| ?[^\s0-9A-Za-z\u00c0-\u017f]+|\s+(?!\S)|\s+"
)


class DamagedRecord(ValueError):
    """A length or payload that does not match its checksum."""


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack(CHECK, masked_crc(length)), payload, struct.pack(CHECK, masked_crc(payload))))


def read_frame(stream) -> bytes | None:
    """The next payload, None at the end of the file; raises DamagedRecord."""
    head = stream.read(struct.calcsize(FRAME))
    if not head:
        return None
    if len(head) < struct.calcsize(FRAME):
        raise DamagedRecord("the file ends inside a length")
    length, check = struct.unpack(FRAME, head)
    if masked_crc(head[:8]) != check:
        raise DamagedRecord("length does not match its checksum")
    body = stream.read(length + struct.calcsize(CHECK))
    if len(body) < length + struct.calcsize(CHECK):
        raise DamagedRecord("the file ends inside a record")
    payload = body[:length]
    if masked_crc(payload) != struct.unpack(CHECK, body[length:])[0]:
        raise DamagedRecord("payload does not match its checksum")
    return payload


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of a payload."""
    doc_id, missing, width, n = struct.unpack_from(HEAD, payload)
    ids = np.frombuffer(payload, dtype=f"<u{width}", offset=struct.calcsize(HEAD), count=n)
    return (None if missing else doc_id), ids


def _byte_letters() -> dict[int, str]:
    """The printable letter by which a byte-level vocabulary writes each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class PartEncoder:
    """Token ids of whole texts by a byte-level vocabulary of the tokenizers library.

    Texts repeat their words, and cutting a text into pieces takes longer than merging
    them, so the ids of each distinct part are remembered: ``most_parts`` recent ones and
    as many before them, of which those still in use move over.
    What is encoded does not depend on it. Texts with runs of white space, and parts
    beyond plain letters, digits and signs, go through the library as a whole.
    """

    def __init__(self, tokenizer_path: str, most_parts: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        rule = json.loads(self.tokenizer.to_str())
        cutting = rule["pre_tokenizer"] or {}
        # Pieces are made here only where the library would make the same ones.
        self.by_piece = (
            rule["model"]["type"] == "BPE" and rule["normalizer"] is None and rule["post_processor"] is None
            and cutting.get("type") == "ByteLevel" and cutting.get("use_regex") and not cutting.get("add_prefix_space")
        )
        self.added = [t["content"] for t in rule["added_tokens"]]
        self.letters = str.maketrans({chr(b): letter for b, letter in _byte_letters().items()})
        self.most_parts = most_parts
        self.parts: dict[str, bytes | bool] = {}
        self.older: dict[str, bytes | bool] = {}
        self.signs: dict[str, bytes] = {}
        self.code = "H" if self.width == 2 else "I"

    def _bytes(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _part(self, part: str) -> bytes:
        if not PLAIN.fullmatch(part) or any(token in part for token in self.added):
            return self.whole(part)
        pieces = PIECE.findall(part)
        if len(pieces) == 1:
            return self._piece(part)
        # Words with a sign at their end are many, the words and signs few.
        return b"".join([self._known_piece(piece) for piece in pieces])

    def _piece(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self.letters)
        return self._bytes([t.id for t in self.model.tokenize(letters)])

    def _known_piece(self, piece: str) -> bytes:
        known = (self.parts.get(piece[1:]) or self.older.get(piece[1:])) if piece[0] == " " else self.signs.get(piece)
        if not known:
            known = self._piece(piece)
            if piece[0] != " " and len(self.signs) < self.most_parts // 10:
                self.signs[piece] = known
        return known

    def _remember(self, part: str) -> bytes | bool:
        """The ids of a part; False if it holds other white space than a text is cut at."""
        known = self.parts.get(part)
        if known is None:
            if len(self.parts) >= self.most_parts:
                self.parts, self.older = {}, self.parts
            known = self.older.get(part)
            if known is None:
                whole = part if part[:1] == "\n" else f" {part}"
                odd = not part or part == "\n" or SPACE.search(whole, 1)
                known = False if odd else self._part(whole)
            self.parts[part] = known
        return known

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_piece:
            return self.whole(text)
        # A part stands for itself if it begins with a line break, else for a space and itself.
        first, *parts = text.replace("\n", " \n").split(" ")
        if not first or SPACE.search(first):
            return self.slow(text)
        ids = list(map(self.parts.get, parts))
        if None in ids:
            ids = [self._remember(part) if known is None else known for part, known in zip(parts, ids, strict=True)]
        return self.slow(text) if False in ids else self._part(first) + b"".join(ids)

    def slow(self, text: str) -> bytes:
        return b"".join(self.whole(part) for part in PART.split(text))


def process_encoder(tokenizer_path: str, most_parts: int) -> PartEncoder:
    """The encoder of this Python process: workers live for many tasks and go on with what they know."""
    kept = sys.modules.setdefault("vaultwright_worker", ModuleType("vaultwright_worker")).__dict__
    if (tokenizer_path, most_parts) not in kept:
        kept[tokenizer_path, most_parts] = PartEncoder(tokenizer_path, most_parts)
    return kept[tokenizer_path, most_parts]


def _writer(folder: str, tokenizer_path: str, end_id: int, most_parts: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = process_encoder(tokenizer_path, most_parts)
        end = end_id.to_bytes(encoder.width, "little")
        store, base = fs.FileSystem.from_uri(folder)
        name, stream, offset, place = f"part-{uuid.uuid4().hex}.records", None, 0, 0
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                doc_id, text = doc_id.as_py(), text.as_py()
                ids = encoder.encode(text or "") + end
                n = len(ids) // encoder.width
                record = frame(struct.pack(HEAD, doc_id or 0, doc_id is None, encoder.width, n) + ids)
                if stream is None:
                    stream = store.open_output_stream(f"{base}/{name}")
                stream.write(record)
                rows.append((doc_id, name, place, offset, len(record), n))
                offset, place = offset + len(record), place + 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, type=kind) for column, kind in zip(
                        zip(*rows, strict=True), [pa.int64(), pa.string(), *[pa.int64()] * 4], strict=True)],
                    names=["doc_id", "file", "place", "byte_offset", "n_bytes", "n_tokens"],
                )
        if stream is not None:
            stream.close()

    return write


def _folder_uri(path: str) -> str:
    return path if re.match(r"[a-z][a-z0-9+.-]*:", path) else f"file://{path}"


def write_records(
    docs: DataFrame, tokenizer_path: str, *, end_id: int = 2, folder: str | None = None, most_parts: int = 250_000
) -> tuple[str, DataFrame]:
    """Encode ``text`` of every row and write the records in ascending ``doc_id`` order.

    Rows are dealt out by ranges of ``doc_id``, so file after file in the order of their
    first id is the whole order. Returns the folder and the offset index. ``most_parts``
    trades memory of the Python workers (about 0.4 kB each) for time.

    Null texts are empty: their record holds the end id alone. Null ids come first and
    are stored as null. Rows of one id keep their input order. An empty table gives an
    empty index and no file. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = _folder_uri(folder or scratch_path(spark, "token-records"))
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base)
    order = [F.col("doc_id").asc_nulls_first(), F.col("__place")]
    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("__place", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    index = f"{folder}/index"
    dealt.mapInArrow(tidy(_writer(folder, tokenizer_path, end_id, most_parts)), INDEX_SCHEMA).withColumn(
        "part", F.spark_partition_id()
    ).write.parquet(index)
    return folder, spark.read.schema(f"{INDEX_SCHEMA}, part int").parquet(index)


def _reader(folder: str) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.to_pylist():
                rows, start, seen = [], file["start"], 0
                with store.open_input_stream(f"{base}/{file['file']}") as stream:
                    while (payload := read_frame(stream)) is not None:
                        doc_id, ids = unpack(payload)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start, seen = start + len(ids), seen + 1
                        if len(rows) == 10_000:
                            yield _read_batch(rows)
                            rows = []
                if seen != file["n_records"]:
                    raise DamagedRecord(f"{file['file']}: {seen} records, the index has {file['n_records']}")
                if rows:
                    yield _read_batch(rows)

    return read


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, type=pa.int64()) for c in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_records(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """Every record of the indexed files, in file order, with its place in the token stream.

    One task reads a file as a stream and checks every length and payload. ``start``
    counts the tokens of all records before, ``ids_crc32`` covers the ids as 32-bit
    little-endian integers. A damaged, missing or surplus record raises.
    """
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("n_records"))
    # One row per file of the write: bounded by its partitions, not by the data.
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("file", "n_records", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return placed.repartition(tasks, "file").mapInArrow(tidy(_reader(folder)), READ_SCHEMA)


def read_at(folder: str, file: str, byte_offset: int) -> tuple[int | None, np.ndarray]:
    """One record by its index entry, as a shuffled reader does it."""
    store, base = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{base}/{file}") as stream:
        stream.seek(byte_offset)
        return unpack(read_frame(stream))


def token_records(docs: DataFrame, tokenizer_path: str, *, end_id: int = 2, most_parts: int = 250_000) -> DataFrame:
    """Write ``docs`` as token records, read them back and report each record."""
    folder, index = write_records(docs, tokenizer_path, end_id=end_id, most_parts=most_parts)
    return read_records(docs.sparkSession, folder, index)


def token_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_records(docs, public_tokenizers.path("byte_bpe_50k.json"), most_parts=700_000)
