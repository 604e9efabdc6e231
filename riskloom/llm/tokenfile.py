"""Flat files of token ids with 64-bit document offsets."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.prefix import PART, part_bases, partitions
from riskloom.llm.tokens import encoder, id_type
from riskloom.session import shared_folder, stage


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def _map(folder: str, name: str, kind: str, length: int) -> np.ndarray:
    """A file's numbers: mapped where the folder is a mounted one, else read."""
    system, path = _open(folder)
    if not length:
        return np.empty(0, kind)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", kind, "r", shape=(length,))
    with system.open_input_file(f"{path}/{name}") as file:
        return np.frombuffer(file.read(), kind)


def _slices(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The values between starts as bytes, on the values' own buffer.

    ``pa.array`` of a list of memoryviews keeps their memory as long as the process lives.
    """
    offsets = pa.py_buffer((starts * values.itemsize).astype("<i4"))
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, offsets, pa.py_buffer(values)])


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    folder: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Write the ids of all texts, in ascending order of ``id_column``, as flat files.

    Documents are dealt by ranges of (id, text digest); a task encodes its range in order and
    writes ``<name>.ids`` (unsigned 16 or 32 bit, little-endian, by the vocabulary's size), each
    document closed by ``end_id``, and ``<name>.docs`` and ``<name>.lengths`` (64 bit).  Then the
    prefix sum of the parts' totals gives each part's base, from which ``<name>.offsets`` is
    written: per document, and once at the end, the number of ids before it in the whole corpus.
    Names are new for each attempt and only listed ones are read, so a task may be run again.

    Returns the list of files: ``name, folder, docs, tokens, base, type`` in a stored table.
    Null texts give the end id alone; null ids come first, as the smallest 64-bit number; repeated
    rows are written each.  An empty table gives no files.  Other columns are left out.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/riskloom/tokens-{uuid.uuid4().hex}"
    system, path = _open(folder)
    system.create_dir(path)
    kind = id_type(tokenizer).str

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{context.partitionId():06d}-{uuid.uuid4().hex}"
        system, path = _open(folder)
        n_docs = n_tokens = 0
        end = np.array([end_id], kind).tobytes()
        with (
            system.open_output_stream(f"{path}/{name}.ids") as ids,
            system.open_output_stream(f"{path}/{name}.docs") as names,
            system.open_output_stream(f"{path}/{name}.lengths") as lengths,
        ):
            for batch in batches:
                sizes = []
                for found in encoder(tokenizer).encode(batch.column(1)):
                    ids.write(found.tobytes() + end)
                    sizes.append(len(found) + 1)
                least = np.iinfo(np.int64).min
                known = batch.column(0).fill_null(int(least)).to_numpy(zero_copy_only=False)
                names.write(known.astype("<i8").tobytes())
                lengths.write(np.array(sizes, "<i8").tobytes())
                n_docs += batch.num_rows
                n_tokens += sum(sizes)
        if n_docs:
            yield pa.RecordBatch.from_pydict(
                {
                    PART: pa.array([context.partitionId()], pa.int32()),
                    "name": [name],
                    "docs": [n_docs],
                    "tokens": [n_tokens],
                }
            )

    rows = docs.select(
        F.col(id_column).cast("long").alias("_id"),
        F.col(text_column).cast("string").alias("_text"),
        F.xxhash64(text_column).alias("_tie"),
    )
    dealt = rows.repartitionByRange(partitions(rows), "_id", "_tie").sortWithinPartitions("_id", "_tie")
    written = stage(
        dealt.select("_id", "_text").mapInArrow(
            write, f"{PART} int, name string, docs long, tokens long"
        ),
        "token-files",
    )
    # one row per part: as many as spark.sql.shuffle.partitions
    listed = written.join(F.broadcast(part_bases(written, ["tokens"])), PART).select(
        "name",
        F.lit(folder).alias("folder"),
        "docs",
        "tokens",
        F.col("_base_tokens").alias("base"),
        F.lit(kind).alias("type"),
    )

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = _map(row["folder"], f"{row['name']}.lengths", "<i8", row["docs"])
                ends = np.concatenate([[0], np.cumsum(lengths)]) + row["base"]
                system, path = _open(row["folder"])
                with system.open_output_stream(f"{path}/{row['name']}.offsets") as out:
                    out.write(ends.astype("<i8").tobytes())
            yield batch

    each = listed.repartition(partitions(rows), "name")
    return stage(each.mapInArrow(offsets, listed.schema), "token-index")


def read_tokens(files: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Documents of the listed files: ``id_column, start, n_tokens, ids``.

    ``start`` counts the ids of all documents before, ``ids`` are little-endian unsigned 32-bit
    numbers with the end id.  Files are memory-mapped, and documents leave in small batches.
    """
    schema = f"`{id_column}` long, start long, n_tokens long, ids binary"
    names = [id_column, "start", "n_tokens", "ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            folder, name = row["folder"], row["name"]
            ids = _map(folder, f"{name}.ids", row["type"], row["tokens"])
            offsets = _map(folder, f"{name}.offsets", "<i8", row["docs"] + 1)
            docs = _map(folder, f"{name}.docs", "<i8", row["docs"])
            at = 0
            while at < row["docs"]:
                limit = offsets[at] + 500_000
                to = max(at + 1, int(np.searchsorted(offsets, limit, side="right")) - 1)
                starts = np.array(offsets[at : to + 1])
                found = np.array(ids[starts[0] - row["base"] : starts[-1] - row["base"]], "<u4")
                known = np.array(docs[at:to])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(known, mask=known == np.iinfo(np.int64).min),
                        pa.array(starts[:-1]),
                        pa.array(np.diff(starts)),
                        _slices(found, starts - starts[0]),
                    ],
                    names,
                )
                at = to

    each = files.repartition(partitions(files), "name")
    return each.mapInArrow(read, schema)
