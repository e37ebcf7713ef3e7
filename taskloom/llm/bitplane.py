"""Token ids in bit-plane files.

File: MAGIC, then for each block of at most `block_ids` ids its planes one after another, each compressed by
zstandard; then the index (numpy arrays compressed together); then the index's length (8 bytes) and MAGIC.
A block of n ids with b significant bits is transposed into b planes of n bits (plane 0 holds the lowest bits), or,
with planes="byte", into ceil(b / 8) planes of n bytes. The chunk index holds offset, ids and plane sizes of each
block and the documents' ids and lengths, so any document can be read without the others.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, discard, materialize, reading, scratch, slices, writing
from .encode import encoder as shared_encoder

MAGIC = b"BITPLN01"


def pack_block(ids: np.ndarray, planes: str = "bit", level: int = 1) -> list[bytes]:
    """The compressed planes of one block of uint32 ids."""
    bits = max(1, int(ids.max(initial=0)).bit_length())
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    squeeze = zstandard.ZstdCompressor(level=level).compress
    if planes == "byte":
        return [squeeze(np.ascontiguousarray(raw[:, k]).tobytes()) for k in range((bits + 7) // 8)]
    rows = np.unpackbits(raw[:, : (bits + 7) // 8], axis=1, bitorder="little")[:, :bits]
    return [squeeze(p.tobytes()) for p in np.packbits(np.ascontiguousarray(rows.T), axis=1)]


def unpack_block(parts: list[bytes], n: int, planes: str = "bit") -> np.ndarray:
    """The uint32 ids of one block."""
    expand = zstandard.ZstdDecompressor().decompress
    raw = np.zeros((n, 4), np.uint8)
    if planes == "byte":
        for k, part in enumerate(parts):
            raw[:, k] = np.frombuffer(expand(part), np.uint8)
    elif n:
        rows = np.stack([np.unpackbits(np.frombuffer(expand(p), np.uint8), count=n) for p in parts], axis=1)
        packed = np.packbits(rows, axis=1, bitorder="little")
        raw[:, : packed.shape[1]] = packed
    return raw.reshape(-1).view("<u4").astype(np.uint32)


def write_file(out, docs: Iterable[tuple[int | None, np.ndarray]], block_ids: int, planes: str) -> tuple[int, int]:
    """Write documents (id, token ids) to a binary stream; returns (documents, ids). Holds one block at a time."""
    out.write(MAGIC)
    at, held, waiting = len(MAGIC), [], 0
    names, absent, sizes, offsets, counts, plane_sizes, plane_counts = [], [], [], [], [], [], []

    def flush(ids: np.ndarray) -> None:
        nonlocal at
        parts = pack_block(ids, planes)
        offsets.append(at)
        counts.append(len(ids))
        plane_counts.append(len(parts))
        for part in parts:
            plane_sizes.append(len(part))
            out.write(part)
            at += len(part)

    for name, ids in docs:
        names.append(name or 0)
        absent.append(name is None)
        sizes.append(len(ids))
        held.append(ids)
        waiting += len(ids)
        if waiting >= block_ids:
            line = np.concatenate(held)
            whole = waiting - waiting % block_ids
            for k in range(0, whole, block_ids):
                flush(line[k : k + block_ids])
            held, waiting = [line[whole:]], waiting - whole
    if waiting:
        flush(np.concatenate(held))
    index = io.BytesIO()
    np.savez_compressed(
        index, doc_id=np.array(names, np.int64), absent=np.array(absent, bool), n_ids=np.array(sizes, np.int64), offset=np.array(offsets, np.int64),
        count=np.array(counts, np.int64), planes=np.array(plane_counts, np.int64), size=np.array(plane_sizes, np.int64), kind=np.array([planes]),
    )
    out.write(index.getvalue())
    out.write(len(index.getvalue()).to_bytes(8, "little") + MAGIC)
    return len(sizes), int(sum(sizes))


def read_index(stream) -> dict[str, np.ndarray]:
    stream.seek(0, 2)
    end = stream.seek(stream.tell() - 16)
    tail = stream.read(16)
    if tail[8:] != MAGIC:
        raise ValueError("not a bit-plane file, or cut off")
    size = int.from_bytes(tail[:8], "little")
    stream.seek(end - size)
    with np.load(io.BytesIO(stream.read(size))) as index:
        return {k: index[k] for k in index.files}


def read_documents(stream) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids) in file order; holds one block and one document at a time."""
    index = read_index(stream)
    kind, first = str(index["kind"][0]), np.concatenate([[0], np.cumsum(index["planes"])])
    line, at, block = np.empty(0, np.uint32), 0, 0

    def more() -> np.ndarray:
        nonlocal block
        sizes = index["size"][first[block] : first[block + 1]].tolist()
        stream.seek(int(index["offset"][block]))
        ids = unpack_block([stream.read(s) for s in sizes], int(index["count"][block]), kind)
        block += 1
        return ids

    for name, absent, n in zip(index["doc_id"].tolist(), index["absent"].tolist(), index["n_ids"].tolist()):
        while len(line) - at < n:
            line, at = np.concatenate([line[at:], more()]), 0
        yield None if absent else name, line[at : at + n].copy()
        at += n


def read_one(stream, position: int) -> np.ndarray:
    """Ids of the document at one position of a file, reading its blocks alone."""
    index = read_index(stream)
    kind, first = str(index["kind"][0]), np.concatenate([[0], np.cumsum(index["planes"])])
    begin = int(index["n_ids"][:position].sum())
    end = begin + int(index["n_ids"][position])
    upto = np.cumsum(index["count"])
    low, high = np.searchsorted(upto, begin, "right"), np.searchsorted(upto, max(begin, end - 1), "right")
    parts = []
    for b in range(low, min(high + 1, len(upto))):
        stream.seek(int(index["offset"][b]))
        parts.append(unpack_block([stream.read(s) for s in index["size"][first[b] : first[b + 1]].tolist()], int(index["count"][b]), kind))
    shift = int(upto[low - 1]) if low else 0
    return np.concatenate(parts)[begin - shift : end - shift] if parts else np.empty(0, np.uint32)


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str = "word_bpe_49k.json", end_id: int = 2, block_ids: int = 1 << 16, planes: str = "byte", text_bytes: int = 4 << 20
) -> DataFrame:
    """Encode `text` of docs (doc_id, text, any others) and write one file per range of doc_id under folder.

    Returns the manifest (path, first_id, n_docs, n_ids), one row per file, already written. Null text counts as
    empty; a null doc_id sorts first; rows that repeat a doc_id are all kept, ordered by text. An empty table gives
    no file. A repeated task writes the same file again under the same name.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, first, path = None, [], f"{folder}/ids-{TaskContext.get().partitionId():06d}.bitplanes"

        def documents():
            for held in (h for b in parts for h in slices(b, text_bytes)):
                ids, sizes = encoder.encode_batch(held.column("text"))
                ends = np.cumsum(sizes)
                for name, n, end in zip(held.column("doc_id").to_pylist(), sizes.tolist(), ends.tolist()):
                    if not first:
                        first.append(name)
                    yield name, np.append(ids[end - n : end], np.uint32(end_id))

        head = next(parts, None)
        while head is not None and head.num_rows == 0:
            head = next(parts, None)
        if head is None:
            return
        rest, encoder = parts, shared_encoder(vocabulary)

        def chained(head=head, rest=rest):
            yield head
            yield from rest

        parts = chained()
        with writing(path) as out:
            n_docs, n_ids = write_file(out, documents(), block_ids, planes)
        yield pa.RecordBatch.from_pydict({"path": [path], "first_id": pa.array(first, pa.int64()), "n_docs": pa.array([n_docs], pa.int64()), "n_ids": pa.array([n_ids], pa.int64())})

    return materialize(rows.mapInArrow(write, "path string, first_id long, n_docs long, n_ids long"), f"{folder}-manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Read token files back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, path.

    The manifest has one row per file (as many as write tasks), so its running totals are made on the driver.
    """
    files = sorted(manifest.collect(), key=lambda r: (r.first_id is not None, r.first_id or 0, r.path))
    begins, total = [], 0
    for f in files:
        begins.append((f.path, total))
        total += f.n_ids
    todo = spark.createDataFrame(begins, "path string, start long")
    if files:
        todo = todo.repartition(len(files))

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                with reading(path) as stream:
                    for held in batches(read_documents(stream), 1 << 18, lambda d: len(d[1]) + 16):
                        sizes = [len(ids) for _, ids in held]
                        starts = (start + np.cumsum(sizes) - sizes).tolist()
                        start += sum(sizes)
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array([name for name, _ in held], pa.int64()), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(sizes, pa.int64()),
                            "ids_crc32": pa.array([zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes()) for _, ids in held], pa.int64()), "path": [path] * len(held),
                        })

    return todo.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, path string")


def bitplane_tokens(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Write docs as bit-plane token files in the shared space and read them back, one row per document."""
    folder = scratch(spark, "bitplanes")
    manifest = write_token_files(docs, folder, **options)
    out = read_token_files(spark, manifest)
    discard(spark, f"{folder}-manifest")
    return out
