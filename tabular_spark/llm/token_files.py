"""Token ids in binary files of compressed bit or byte planes.

Documents are range-partitioned by id; each partition becomes one file. Its texts are cut at byte
pairs that no token bridges, equal fragments of a stretch are encoded once by the tokenizer, and the ids,
an end id after each document, run into blocks of a fixed number. A block is transposed into
planes (bit or byte i of all its ids), each plane compressed with zstandard. A footer holds the index of
the blocks and the ids and lengths of the documents, so that any document can be read without
the rest. Parts of a file are rows of Spark's text writer, which writes the bytes of a row as
they are and a line feed after each; so a file is committed as a whole or not at all, on any
store that Spark writes to, and a lost task writes it again.

    header: MAGIC, file number u32, ids in a block u32, planes u8 (4: bytes, 32: bits)
    block:  length u32 of each plane, then the planes
    footer: blocks u32, documents u32, length u32 of the documents' part;
            each block's offset u64, length u32, ids u32;
            compressed: ids i64, lengths u64, 1 where the id is null u8
    end:    length of the footer u32, MAGIC

Numbers are little-endian; each of header, blocks and footer with end is followed by a line feed.

Cases: a null text counts as empty and has the end id only; null ids come first; rows of one id
are ordered by the hash of their text and may be repeated; texts of any length are taken apart
in stretches; an empty table gives files without blocks, or none; ids must be whole numbers of 64 bits;
other columns are never read, whatever their names.
"""

from __future__ import annotations

import struct
import uuid
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabular_spark.llm.bpe import LONGEST, REMEMBERED, ForcedBoundaryCodec
from tabular_spark.llm.common import removed, shared_dir, stored, text_of
from tabular_spark.llm.sharding import bucket_offsets

MAGIC = b"TOKPLAN1"
#: Ids in a block, bytes of text per file on average, and bytes that are taken apart at once.
BLOCK, FILE_BYTES, STRETCH = 1 << 16, 64 << 20, 4 << 20
HEADER, ENTRY, FOOTER, END = "<8sIIB", "<QII", "<III", "<I8s"


class StretchEncoder(ForcedBoundaryCodec):
    """Encodes many texts at once, each distinct fragment of a stretch once."""

    def cuts(self, raw):
        """Where a fragment ends: the places before which ``raw`` may be cut, without 0 and its length."""
        import numpy as np

        if len(raw) < 2:
            return np.zeros(0, np.int64)
        cut = self.forced[raw[:-1].astype(np.uint16) << 8 | raw[1:]]
        cut[1:] &= ~((raw[1:-1] >= 128) & self.maybe_space[raw[:-2]])
        return np.flatnonzero(cut) + 1

    def packed(self, fragments: list[bytes]) -> list[bytes]:
        found = list(map(self.ids.get, fragments))
        new = [i for i, ids in enumerate(found) if ids is None]
        if len(self.ids) + len(new) > REMEMBERED:
            self.ids = {}  # what is known of this stretch need not be encoded again
            self.ids.update((f, ids) for f, ids in zip(fragments, found) if ids is not None)
        for i, x in zip(new, self.tokenizer.encode_batch_fast([fragments[i].decode() for i in new], add_special_tokens=False)):
            found[i] = array("I", x.ids).tobytes()
        self.ids.update((fragments[i], found[i]) for i in new if len(fragments[i]) <= LONGEST)
        return found

    def encode(self, raw, at):
        """(ids, ends): the ids of ``raw`` cut at ``at`` (from 0 to its length), and where those of each fragment end, 0 first."""
        import numpy as np
        import pyarrow as pa

        if len(at) < 2:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
        known = self.packed(pieces.dictionary.to_pylist())
        flat, size = np.frombuffer(b"".join(known), np.uint32), np.array([len(x) // 4 for x in known], np.int64)
        index = pieces.indices.to_numpy(zero_copy_only=False)
        counts = size[index]
        ends = np.concatenate([[0], np.cumsum(counts)])
        first = (np.cumsum(size) - size)[index]
        return flat[np.repeat(first - ends[:-1], counts) + np.arange(ends[-1])], ends

    def documents(self, data, offsets, end_id: int, most: int = STRETCH) -> Iterator[tuple]:
        """(ids, lengths) stretch by stretch: ids with ``end_id`` after each document, and the number of ids of each document that ends there."""
        import numpy as np

        start, last, done, open_ids = int(offsets[0]), int(offsets[-1]), 0, 0
        n = len(offsets) - 1
        while done < n:
            width = most
            while True:
                stop = min(last, start + width)
                border = int(offsets[max(done, np.searchsorted(offsets, stop, "right") - 1)])
                if stop < last and border > start:
                    stop = border  # ends with a document
                raw = data[start:stop]
                cuts = self.cuts(raw)
                if stop == last or stop == border or len(cuts):
                    break
                width *= 2  # a long text without a place to cut
            if stop < last and stop != border:
                stop = start + int(cuts[-1])
                raw, cuts = data[start:stop], cuts[:-1]
            upto = int(np.searchsorted(offsets, stop, "right")) - 1  # documents before it end here or earlier
            borders = np.asarray(offsets[done + 1 : upto + 1], np.int64) - start
            marks = np.zeros(len(raw) + 1, bool)
            marks[0] = marks[-1] = marks[cuts] = marks[borders] = True
            at = np.flatnonzero(marks)
            ids, ends = self.encode(raw, at)
            places = ends[np.searchsorted(at, borders)]
            lengths = np.diff(places, prepend=0) + 1
            if len(lengths):
                lengths[0] += open_ids
                open_ids = 0
            open_ids += len(ids) - (int(places[-1]) if len(places) else 0)
            yield np.insert(ids, places, end_id), lengths
            start, done = stop, max(done, upto)


def to_planes(ids, planes: int, compressor) -> bytes:
    """One block, transposed and compressed."""
    import numpy as np

    cells = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    rows = cells.T if planes == 4 else np.packbits(np.unpackbits(cells, axis=1, bitorder="little").T, axis=1, bitorder="little")
    parts = [compressor.compress(np.ascontiguousarray(r).tobytes()) for r in rows]
    return struct.pack(f"<{planes}I", *map(len, parts)) + b"".join(parts)


def from_planes(block: bytes, n: int, planes: int, decompressor):
    import numpy as np

    lengths, at, rows = struct.unpack_from(f"<{planes}I", block), 4 * planes, []
    for length in lengths:
        rows.append(np.frombuffer(decompressor.decompress(block[at : at + length]), np.uint8))
        at += length
    cells = np.stack(rows)
    if planes == 32:
        cells = np.packbits(np.unpackbits(cells, axis=1, bitorder="little")[:, :n].T, axis=1, bitorder="little").T
    return np.ascontiguousarray(cells.T).view("<u4").reshape(-1)


def file_rows(batches: Iterator, number: int, tokenizer_path: str | None, end_id: int, block: int, planes: int, level: int) -> Iterator[bytes]:
    """The parts of one file from Arrow batches of (doc_id, text)."""
    import numpy as np
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=level)
    encoder = StretchEncoder(tokenizer_path)
    waiting, waits, at = [], 0, 0
    index, doc_ids, nulls, lengths = [], [], [], []

    def blocks(least: int) -> Iterator[bytes]:
        nonlocal waiting, waits, at
        if waits < least:
            return
        ids, done = np.concatenate(waiting), 0
        while len(ids) - done >= least and done < len(ids):
            part = to_planes(ids[done : done + block], planes, squeeze)
            index.append((at, len(part), min(block, len(ids) - done)))
            at += len(part) + 1
            done += block
            yield part
        waiting, waits = [ids[done:]], max(0, len(ids) - done)

    for batch in batches:
        if not batch.num_rows:
            continue
        if not at:
            header = struct.pack(HEADER, MAGIC, number, block, planes)
            at = len(header) + 1
            yield header
        ids, texts = batch.column(0), batch.column(1)
        wide = texts.cast("large_binary")
        offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
        data = np.frombuffer(wide.buffers()[2], np.uint8) if wide.buffers()[2] is not None else np.zeros(0, np.uint8)
        doc_ids.append(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        nulls.append(ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
        for more, counts in encoder.documents(data, offsets, end_id):
            lengths.append(counts)
            waiting.append(more)
            waits += len(more)
            yield from blocks(block)
    if at:
        yield from blocks(1)
        documents = squeeze.compress(b"".join(np.concatenate(x).astype(t).tobytes() for x, t in ((doc_ids, "<i8"), (lengths, "<u8"), (nulls, "u1"))))
        footer = struct.pack(FOOTER, len(index), sum(map(len, doc_ids)), len(documents)) + b"".join(struct.pack(ENTRY, *x) for x in index) + documents
        yield footer + struct.pack(END, len(footer), MAGIC)


class TokenFile:
    """One file's contents; blocks are opened one by one."""

    def __init__(self, content: bytes):
        import numpy as np
        import zstandard

        self.content, self.open = memoryview(content), zstandard.ZstdDecompressor()
        magic, self.number, self.block, self.planes = struct.unpack_from(HEADER, content)
        size, end = struct.unpack_from(END, content, len(content) - 1 - struct.calcsize(END))
        if magic != MAGIC or end != MAGIC:
            raise ValueError("not a whole file of token planes")
        at = len(content) - 1 - struct.calcsize(END) - size
        blocks, n, length = struct.unpack_from(FOOTER, content, at)
        at += struct.calcsize(FOOTER)
        self.index = [struct.unpack_from(ENTRY, content, at + i * struct.calcsize(ENTRY)) for i in range(blocks)]
        at += blocks * struct.calcsize(ENTRY)
        raw = self.open.decompress(self.content[at : at + length])
        self.doc_ids, self.lengths = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<u8", n, 8 * n).astype(np.int64)
        self.nulls = np.frombuffer(raw, np.uint8, n, 16 * n).astype(bool)

    def ids(self, number: int):
        """The ids of one block."""
        offset, length, n = self.index[number]
        return from_planes(bytes(self.content[offset : offset + length]), n, self.planes, self.open)

    def parts(self) -> Iterator[tuple]:
        """(document, ids) in order; a document that runs over blocks comes in several parts."""
        import numpy as np

        ends, before, at = np.cumsum(self.lengths), 0, 0
        for number in range(len(self.index)):
            ids = self.ids(number)
            done = 0
            while done < len(ids):
                stop = min(len(ids), int(ends[at]) - before)
                yield at, ids[done:stop]
                done = stop
                at += before + stop == ends[at]
            before += len(ids)


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None, end_id: int = 2, block: int = BLOCK, planes: int = 4, level: int = 3, file_bytes: int = FILE_BYTES) -> None:
    """Writes the ids of ``docs`` in ascending order of their ids; ``planes`` is 4 (bytes) or 32 (bits)."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes), 1)
    # equal rows may lie in any order, so that many of them are dealt to several files
    keyed = slim.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash")]
    dealt = keyed.repartitionByRange(files, *order, F.xxhash64("_row")).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        for row in file_rows(batches, TaskContext.get().partitionId(), tokenizer_path, end_id, block, planes, level):
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["part"])

    dealt.mapInArrow(run, "part binary").select(F.col("part").cast("string").alias("value")).write.text(path)


def contents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").select("content")


def opened(spark: SparkSession, path: str, rows, schema: str) -> DataFrame:
    """The rows (as Arrow batches) that ``rows`` makes of each file."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for content in batch.column(0):
                yield from rows(TokenFile(content.as_py()))

    return contents(spark, path).mapInArrow(run, schema)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(file, position, doc_id, ids): every document, by its place in its file."""

    def rows(file: TokenFile) -> Iterator:
        import numpy as np
        import pyarrow as pa

        open_parts: list = []
        for document, ids in file.parts():
            open_parts.append(ids)
            if sum(map(len, open_parts)) == file.lengths[document]:
                whole = np.concatenate(open_parts).astype(np.int32)
                open_parts = []
                doc_id = None if file.nulls[document] else int(file.doc_ids[document])
                yield pa.RecordBatch.from_arrays([pa.array([file.number]), pa.array([document], pa.int64()), pa.array([doc_id], pa.int64()), pa.array([whole], pa.list_(pa.int32()))], ["file", "position", "doc_id", "ids"])

    return opened(spark, path, rows, "file long, position long, doc_id long, ids array<int>")


def block_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, offset, bytes, ids): where each block lies in its file."""

    def rows(file: TokenFile) -> Iterator:
        import pyarrow as pa

        columns = [[file.number] * len(file.index), list(range(len(file.index))), *([x[i] for x in file.index] for i in range(3))]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["file", "block", "offset", "bytes", "ids"])

    return opened(spark, path, rows, "file long, block long, offset long, bytes long, ids long")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files: its place among all ids and their checksum."""

    def rows(file: TokenFile) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        sums = [0] * len(file.lengths)
        for document, ids in file.parts():
            sums[document] = zlib.crc32(np.ascontiguousarray(ids, "<u4").view(np.uint8), sums[document])
        start = np.cumsum(file.lengths) - file.lengths
        arrays = [pa.array(np.full(len(sums), file.number, np.int64)), pa.array(file.doc_ids, mask=file.nulls), pa.array(start), pa.array(file.lengths), pa.array(sums, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["bucket", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = stored(opened(spark, path, rows, "bucket long, doc_id long, at long, n_tokens long, ids_crc32 long"), "token-digests")
    offsets = bucket_offsets(found.groupBy("bucket").agg(F.sum("n_tokens").alias("rows")))
    return found.join(offsets, "bucket").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op11(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path)
    found = token_digests(spark, path)
    removed(contents(spark, path))
    return found
