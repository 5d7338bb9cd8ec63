"""Token ids in binary files: frequency-ranked, byte-aligned variable-length coding with control bytes of their own.

Ids are replaced by their rank of frequency over the whole corpus, so that the common ones take one byte. A rank takes
one to four bytes; two bits per rank in a separate control stream say how many. Decoding looks each control byte up
in a table of the four lengths that it holds and gathers the data bytes, all in numpy.

A folder holds `ranks.u32` (ids by rank, as many as the vocabulary has at most) and `ids-NNNNNN.bin`, files in ascending
key order, each a run of blocks: magic, then counts of documents, ids and data bytes, a byte per document for a null key,
keys, ids per document, control bytes, data bytes; all numbers little-endian. Blocks end with whole documents. Files grow
with the corpus, so that their number stays moderate; readers go through a file block by block.

Tasks write a file under a temporary name and rename it, so a task that is run again after a lost executor leaves the
same file. The folder lies where the session's shared folder is, and is opened through `pyarrow.fs`.

Edge cases: a null or empty text has only the end id; null keys come first; repeated keys keep an order given by the
stored input; an empty table gives a folder without id files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textpanel.llm.common import fresh_path, small_batches, stored, table
from textpanel.llm.tokens import memo

END = 1
MAGIC = b"TPIDS001"
#: Ids in a block, about; ids in a file, about: from the least to the most, so that there are at most `FILES` files in between.
BLOCK, FILE, LARGEST, FILES = 1 << 18, 1 << 22, 1 << 28, 4096
#: For each control byte the lengths of its four ranks.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def coded(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ranks."""
    size = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    four = np.zeros((-(-len(ranks) // 4), 4), np.uint8)
    four.reshape(-1)[: len(ranks)] = size
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    byte = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), byte[np.arange(4) <= size[:, None]].tobytes()


def decoded(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n].astype(np.int64)
    byte = np.frombuffer(data + b"\0\0\0", np.uint8)
    at = np.cumsum(size) - size
    out = byte[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if len(more):
            out[more] |= byte[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def block(keys: list, counts: list[int], ranks: np.ndarray) -> bytes:
    control, data = coded(ranks)
    head = np.array([len(keys), len(ranks), len(data)], "<u8").tobytes()
    null = np.array([k is None for k in keys], np.uint8).tobytes()
    return MAGIC + head + null + np.array([k or 0 for k in keys], "<i8").tobytes() + np.array(counts, "<u8").tobytes() + control + data


def blocks(file) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(keys, ids per document, ranks) of each block of an open file."""
    while head := file.read(32):
        if head[:8] != MAGIC:
            raise ValueError("not an id file")
        docs, n, size = (int(x) for x in np.frombuffer(head, "<u8", 3, 8))
        null = np.frombuffer(file.read(docs), np.uint8)
        keys = np.frombuffer(file.read(8 * docs), "<i8")
        counts = np.frombuffer(file.read(8 * docs), "<u8").astype(np.int64)
        control = file.read(-(-n // 4))
        yield [None if x else int(k) for k, x in zip(keys, null, strict=True)], counts, decoded(control, file.read(size), n)


def ids_per_file(total: int) -> int:
    return max(FILE, min(LARGEST, -(-total // FILES)))


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


def encode(docs: DataFrame, tokenizer: str, key: str, text: str, end: int) -> DataFrame:
    """(row, key, n_tokens, ids): ids of two bytes each where the vocabulary allows; `row` tells rows with one key apart."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    ending = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = memo(tokenizer, False)
        width = "<u2" if max(known.tokenizer.get_vocab_size(), end + 1) <= 1 << 16 else "<u4"
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids = [np.frombuffer(x + ending, "<u4").astype(width).tobytes() for x in known.encode_all(batch.column(1).to_pylist())]
            each = pa.array([len(x) // int(width[2]) for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(range(row, row + len(ids)), pa.int64()), batch.column(0), each, pa.array(ids, pa.binary())], names=["row", "key", "n_tokens", "ids"])
            row += len(ids)

    return src.mapInArrow(run, "row long, key long, n_tokens long, ids binary")


def unpack(ids: bytes, n: int) -> np.ndarray:
    """n ids, of one or more documents of one run."""
    return np.frombuffer(ids, f"<u{len(ids) // n}") if n else np.zeros(0, "<u2")


def frequencies(encoded: DataFrame) -> DataFrame:
    """(id, count): each task adds up its own ids first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            seen = np.bincount(unpack(b"".join(batch.column(0).to_pylist()), sum(batch.column(1).to_pylist())))
            if len(seen) > len(total):
                total = np.concatenate([total, np.zeros(len(seen) - len(total), np.int64)])
            total[: len(seen)] += seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "count"])

    return encoded.select("ids", "n_tokens").mapInArrow(run, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


def write(docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = END, file_ids: int | None = None) -> DataFrame:
    """Writes `docs`' ids to `folder`, about `file_ids` to a file; returns (part, n_docs, n_tokens, bytes) of its files."""
    encoded = stored(encode(docs, tokenizer, key, text, end), "encoded")
    found = sorted(((-r["count"], r["id"]) for r in frequencies(encoded).collect()))  # one row per id of the vocabulary at most
    by_rank = np.array([x for _, x in found], "<u4")
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/ranks.u32") as out:
        out.write(by_rank.tobytes())
    total = sum(-n for n, _ in found)
    files = max(1, -(-total // (file_ids or ids_per_file(total))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        with fs.open_input_stream(f"{path}/ranks.u32") as file:
            ids_of = np.frombuffer(file.read(), "<u4")
        rank_of = np.zeros(int(ids_of.max(initial=0)) + 1, np.uint32)
        rank_of[ids_of] = np.arange(len(ids_of), dtype=np.uint32)
        task = TaskContext.get()
        part = task.partitionId()
        draft = f"{path}/.ids-{part:06d}-{task.taskAttemptId()}"
        n_docs = n_tokens = size = 0
        out, keys, counts, ids, held = None, [], [], [], 0

        def flush() -> None:
            nonlocal out, size, held
            out = out or fs.open_output_stream(draft)
            made = block(keys, counts, rank_of[unpack(b"".join(ids), sum(counts))])
            out.write(made)
            size += len(made)
            held = 0
            for x in (keys, counts, ids):
                x.clear()

        for batch in batches:
            for k, n, packed in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                keys.append(k)
                counts.append(n)
                ids.append(packed)
                n_docs, n_tokens, held = n_docs + 1, n_tokens + n, held + n
                if held >= BLOCK:
                    flush()
        if keys:
            flush()
        if out:
            out.close()
            final = f"{path}/ids-{part:06d}.bin"
            try:
                fs.move(draft, final)
            except OSError:  # some stores don't replace a file that an earlier attempt has left
                fs.delete_file(final)
                fs.move(draft, final)
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (part, n_docs, n_tokens, size)], names=["part", "n_docs", "n_tokens", "bytes"])

    ordered = encoded.repartitionByRange(files, F.col("key").asc_nulls_first(), F.col("row")).sortWithinPartitions(F.col("key").asc_nulls_first(), "row")
    made = ordered.select("key", "n_tokens", "ids").mapInArrow(run, "part long, n_docs long, n_tokens long, bytes long")
    return stored(made, "id-files")


def read(spark, folder: str, with_ids: bool = False) -> DataFrame:
    """Per document of `folder`: part, nth (place in the file), key, start_in_file, n_tokens, ids_crc32 (and ids)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "ids-*.bin").load(folder).select("path", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        with fs.open_input_stream(f"{path}/ranks.u32") as file:
            ids_of = np.frombuffer(file.read(), "<u4")
        for batch in batches:
            for name in batch.column(0).to_pylist():
                part, nth, at = int(name.rsplit("ids-", 1)[1][:-4]), 0, 0
                with fs.open_input_stream(f"{path}/ids-{part:06d}.bin") as file:
                    for keys, counts, ranks in blocks(file):
                        ids = ids_of[ranks].tobytes()
                        ends = np.cumsum(counts)
                        each = [ids[4 * int(e - c) : 4 * int(e)] for e, c in zip(ends, counts, strict=True)]
                        columns = [pa.array([part] * len(keys), pa.int64()), pa.array(range(nth, nth + len(keys)), pa.int64()), pa.array(keys, pa.int64()), pa.array(at + ends - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array([zlib.crc32(x) for x in each], pa.int64())]
                        names = ["part", "nth", "key", "start_in_file", "n_tokens", "ids_crc32"]
                        if with_ids:
                            columns, names = [*columns, pa.array(each, pa.binary())], [*names, "ids"]
                        yield pa.RecordBatch.from_arrays(columns, names=names)
                        nth, at = nth + len(keys), at + int(ends[-1])

    return files.mapInArrow(run, "part long, nth long, key long, start_in_file long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def starts(files: DataFrame) -> DataFrame:
    """(file, file_start): ids in all files before each; one small row per file."""
    return files.select(F.col("part").alias("file"), F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("file_start"))


def op9_query(spark, sf_dir):
    import public_tokenizers

    folder = fresh_path(spark, "ids")
    files = write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    docs = read(spark, folder).join(starts(files), F.col("part") == F.col("file"))
    return docs.select(F.col("key").alias("doc_id"), (F.col("file_start") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")
