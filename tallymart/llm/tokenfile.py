"""Token ids in files of fixed-width bit packing.

A file holds the documents of one range of doc_id, in ascending order:

    blocks: the ids in order, `bits` bits each, little end first, padded to whole bytes at a block's end
    block offsets (8 bytes each), document ids (8 each), first id of each document and the total (8 each)
    magic, version, bits per id, ids per block, documents, ids, blocks          (48 bytes at the end)

Block offsets make any run of ids reachable: a reader fetches the blocks that cover it and unpacks them with numpy.
A null text is empty and so holds only the end id. Documents of equal id keep all their rows, in order of text; a null
doc_id comes first and is read back as null.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.common import shared_dir, small_batches, text_steps
from tallymart.llm.tokens import END_ID, coder, vocabulary_size

MAGIC, VERSION, FOOTER = b"TKBP", 1, struct.Struct("<4sHHIQQQ12x")
BLOCK_IDS = 1 << 16
NULL_ID = -(1 << 63)


def width(vocabulary: int) -> int:
    """The fewest bits that hold every id below `vocabulary`."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    ids = np.asarray(ids, dtype="<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(spread, bitorder="little").tobytes()


def unpack(raw: bytes, n: int, bits: int) -> np.ndarray:
    """n ids as little-endian unsigned 32-bit integers."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, dtype=f"<u{bits // 8}", count=n).astype("<u4")
    spread = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return np.packbits(np.pad(spread, ((0, 0), (0, 32 - bits))), axis=1, bitorder="little").view("<u4").ravel()


def file_system(uri: str):
    """Where the shared folder lives; any store that pyarrow can open."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Writer:
    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.n_blocks = 0
        self.at = 0
        self.offsets: list[int] = []
        self.docs: list[int] = []
        self.starts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(NULL_ID if doc_id is None else doc_id)
        self.starts.append(self.n_ids)
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.block_ids:
            flat = np.concatenate(self.held)
            whole = len(flat) // self.block_ids * self.block_ids
            for i in range(0, whole, self.block_ids):
                self._block(flat[i : i + self.block_ids])
            self.held, self.n_held = [flat[whole:]], len(flat) - whole

    def _block(self, ids: np.ndarray) -> None:
        raw = pack(ids, self.bits)
        self.out.write(raw)
        self.offsets.append(self.at)
        self.at += len(raw)

    def close(self) -> None:
        if self.n_held:
            self._block(np.concatenate(self.held))
        self.out.write(np.array([*self.offsets, self.at], dtype="<i8").tobytes())
        self.out.write(np.array(self.docs, dtype="<i8").tobytes())
        self.out.write(np.array([*self.starts, self.n_ids], dtype="<i8").tobytes())
        self.out.write(FOOTER.pack(MAGIC, VERSION, self.bits, self.block_ids, len(self.docs), self.n_ids, len(self.offsets)))


class Reader:
    """Random access by document or by run of ids. The footer stands at the end, so a writer never seeks."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        magic, version, self.bits, self.block_ids, self.n_docs, self.n_ids, n_blocks = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token file")
        tail = np.frombuffer(self._read(size - FOOTER.size - 8 * (n_blocks + 2 * self.n_docs + 2), 8 * (n_blocks + 2 * self.n_docs + 2)), dtype="<i8")
        self.offsets, self.doc_ids, self.starts = np.split(tail, [n_blocks + 1, n_blocks + 1 + self.n_docs])

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def ids(self, begin: int, end: int) -> np.ndarray:
        if begin >= end:
            return np.zeros(0, dtype="<u4")
        first, last = begin // self.block_ids, (end - 1) // self.block_ids
        parts = []
        for b in range(first, last + 1):
            n = min(self.block_ids, self.n_ids - b * self.block_ids)
            raw = self._read(int(self.offsets[b]), int(self.offsets[b + 1] - self.offsets[b]))
            parts.append(unpack(raw, n, self.bits))
        return np.concatenate(parts)[begin - first * self.block_ids : end - first * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """doc_id, first id in the file and ids, in order, a few blocks in memory at a time."""
        i = 0
        while i < self.n_docs:
            j = int(np.searchsorted(self.starts, self.starts[i] + 16 * self.block_ids, side="right")) - 1
            j = min(max(j, i + 1), self.n_docs)
            flat, base = self.ids(int(self.starts[i]), int(self.starts[j])), int(self.starts[i])
            for k in range(i, j):
                yield int(self.doc_ids[k]), int(self.starts[k]), flat[int(self.starts[k]) - base : int(self.starts[k + 1]) - base]
            i = j


def write(df: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text") -> list[int]:
    """Writes the token files of df's texts into `folder` and returns the number of ids in each, in order of their ranges.

    Texts are dealt out by ranges of the key, so the files follow one another in its order. A task writes under a name of
    its own and renames the whole file at the end: repeated and lost attempts leave nothing half written in its place."""
    bits = width(vocabulary_size(path))

    def rows(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        store, root = file_system(folder)
        store.create_dir(root, recursive=True)
        temporary, final = f"{root}/.{uuid.uuid4().hex}", f"{root}/part-{part:06d}.tok"
        c = coder(path)
        end = np.array([END_ID], dtype="<u4")
        with store.open_output_stream(temporary) as out:
            w = Writer(out, bits)
            for keys, texts in text_steps(batches, key, text=text):
                for k, raw in zip(keys, c.encode(texts)):
                    w.add(k, np.concatenate([np.frombuffer(raw, dtype="<u4"), end]))
            w.close()
        c.trim()
        if store.get_file_info(final).is_file:
            store.delete_file(final)
        store.move(temporary, final)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "n": pa.array([w.n_ids], pa.int64())})

    dealt = df.select(F.col(key).cast("long").alias(key), text).repartitionByRange(F.col(key)).sortWithinPartitions(key, text)
    with small_batches(df.sparkSession):
        sizes = {r["part"]: r["n"] for r in dealt.mapInArrow(rows, "part long, n long").collect()}
    return [sizes[p] for p in sorted(sizes)]


def read(spark: SparkSession, folder: str, sizes: list[int]) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and ids (packed 32-bit), from the files alone."""
    return spark.range(0, len(sizes), 1, max(1, len(sizes))).mapInArrow(_reader(folder, sizes, True), "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def _reader(folder: str, sizes: list[int], with_ids: bool):
    begins = np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64))])

    def rows(batches):
        store, root = file_system(folder)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                with store.open_input_file(f"{root}/part-{part:06d}.tok") as source:
                    held: list[tuple] = []
                    for doc, start, ids in Reader(source).documents():
                        raw = ids.tobytes()
                        held.append((None if doc == NULL_ID else doc, int(begins[part]) + start, len(ids), zlib.crc32(raw), raw if with_ids else None))
                        if len(held) == 1000:
                            yield _batch(held, with_ids)
                            held = []
                    yield _batch(held, with_ids)

    return rows


def _batch(held: list[tuple], with_ids: bool) -> pa.RecordBatch:
    cols = list(zip(*held)) if held else [[]] * 5
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64()} | ({"ids": pa.binary()} if with_ids else {})
    return pa.RecordBatch.from_pydict({n: pa.array(c, t) for (n, t), c in zip(kinds.items(), cols)})


def query(documents: DataFrame, path: str) -> DataFrame:
    spark = documents.sparkSession
    folder = shared_dir(spark)
    sizes = write(documents, folder, path)
    return spark.range(0, len(sizes), 1, max(1, len(sizes))).mapInArrow(_reader(folder, sizes, False), "doc_id long, start long, n_tokens long, ids_crc32 long")
