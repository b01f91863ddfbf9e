"""Token counts of flat token files.

A flat token file is a run of little-endian ids with a separator after every document and no
index. It is read in blocks that know nothing of each other: a task searches each block for
separators with one vector comparison and gives a summary row. A prefix scan over the summaries
(one row per block) carries the open document, the document ordinal and the token position
across block borders.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barframe.llm.arrays import small_batches, text_chunks
from barframe.llm.bpe import encode_chunk, read_ranks, vocabulary
from barframe.session import shared_path, stored

SEPARATOR = 50256  # the id that the 50,256 ranks leave free
WIDTH = 2  # bytes of an id in a file; every id of that vocabulary fits
BLOCK_TOKENS = 1 << 18


def read_token_files(spark: SparkSession, path: str, width: int = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks ``(file, block, data)`` of flat token files in any store Spark reads.

    Spark hands a file over as one value, so a file may have 2 GB at most. Bytes after the last
    whole id are not read. A file without ids has no block.
    """
    size = block_tokens * width
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    blocks = F.expr(f"filter(sequence(0L, length(content) div {size}), b -> length(content) - b * {size} >= {width})")
    return files.withColumn("block", F.explode(blocks)).select(
        "file", "block", F.expr(f"substring(content, cast(block * {size} + 1 as int), {size})").alias("data")
    )


def check_ids(ids: Iterable[int], separator: int, width: int) -> None:
    """An error if an id or the separator does not fit in ``width`` bytes, or the separator is an id."""
    ids = set(ids)
    if separator in ids or not 0 <= separator < 256**width or (ids and max(ids) >= 256**width):
        raise ValueError(f"ids up to {max(ids, default=0)} with the separator {separator} do not fit {width} bytes an id")


def write_token_blocks(
    docs: DataFrame,
    ranks_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    separator: int = SEPARATOR,
    width: int = WIDTH,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Encode documents to flat token files, one per input partition, held block by block.

    Returns the stored table ``(file, block, data, doc_ids)``: ``data`` is the raw bytes of the
    block, ``doc_ids`` names the documents whose separator it holds, in file order. A null or
    empty text is a lone separator. The table lies in the folder of ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as file:
        raw = file.read()
    check_ids(read_ranks(raw).values(), separator, width)
    content = spark.sparkContext.broadcast(raw)
    end = int(separator).to_bytes(width, "little")
    size = block_tokens * width

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, name = vocabulary(content.value), f"part-{TaskContext.get().partitionId():06d}"
        held, ids, block = bytearray(), [], 0
        ended: list[int] = []  # bytes of this file before which each waiting separator ends
        written = 0

        def flush(amount: int) -> pa.RecordBatch:
            nonlocal block, written
            written += amount
            done = sum(1 for e in ended if e <= written)
            row = [[name], [block], [bytes(held[:amount])], [ids[:done]]]
            del held[:amount], ids[:done], ended[:done]
            block += 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64())), strict=True)], names=["file", "block", "data", "doc_ids"])

        for batch in batches:
            keys = batch.column(1)
            for row, stop, data, at in text_chunks(batch.column(0)):
                for key, packed in zip(keys.slice(row, stop - row).to_pylist(), encode_chunk(words, data, at), strict=True):
                    held += np.frombuffer(packed, dtype="<u4").astype(f"<u{width}").tobytes() + end
                    ids.append(key)
                    ended.append(written + len(held))
                    while len(held) >= size:
                        yield flush(size)
        if held:
            yield flush(len(held))
        words.forget()

    small_batches(spark)
    path = shared_path(spark, "token-blocks")
    source = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"))
    schema = "file string, block long, data binary, doc_ids array<long>"
    source.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def scan_blocks(blocks: DataFrame, separator: int = SEPARATOR, width: int = WIDTH) -> DataFrame:
    """One summary ``(file, block, n, lengths, tail)`` per block: its tokens, the tokens before each
    of its separators since the one before it or the block's begin, and those after the last."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, lengths, tail = [], [], []
            for data in batch.column(2):
                raw = data.as_buffer()
                tokens = np.frombuffer(raw, dtype=f"<u{width}", count=raw.size // width) if raw is not None and raw.size >= width else np.zeros(0, "<u2")
                at = np.flatnonzero(tokens == separator)
                n.append(len(tokens))
                lengths.append(np.diff(at, prepend=-1) - 1)
                tail.append(len(tokens) - (int(at[-1]) + 1 if len(at) else 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(lengths, pa.list_(pa.int64())), pa.array(tail, pa.int64())],
                names=["file", "block", "n", "lengths", "tail"],
            )

    schema = "file string, block long, n long, lengths array<long>, tail long"
    return blocks.select("file", F.col("block").cast("long"), "data").mapInArrow(run, schema)


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR, width: int = WIDTH) -> DataFrame:
    """One row ``(file, ordinal, n_tokens, terminated)`` per document of flat token files.

    ``blocks`` has ``(file, block, data)``, blocks numbered in file order; other columns are
    ignored. Separators are not counted. Two separators in a row are a document of 0 tokens;
    tokens after the last separator are a document with ``terminated`` false; a file without
    tokens has no documents. Null data is an empty block.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ordered = Window.partitionBy("file").orderBy("block")
    summaries = stored(scan_blocks(blocks, separator, width), "token-summaries")
    # Four numbers per block go through the scan over a file; the lengths stay where they are.
    last = F.when(F.col("ends") > 0, F.col("start_block") + F.col("n") - F.col("tail") - 1)
    carried = (
        summaries.select("file", "block", "n", F.size("lengths").alias("ends"), "tail")
        .withColumn("start_block", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("first_ordinal", F.coalesce(F.sum("ends").over(before), F.lit(0)))
        .withColumn("opened", F.coalesce(F.max(last).over(before), F.lit(-1)) + 1)
        .withColumn("is_last", F.lead("block").over(ordered).isNull())
        .withColumn("carry", F.col("start_block") - F.col("opened"))
        .join(summaries.select("file", "block", "lengths"), ["file", "block"])
    )
    open_tokens = F.when(F.size("lengths") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("tail"))
    ends = F.when(F.col("is_last") & (open_tokens > 0), F.array(F.struct(F.size("lengths").cast("long").alias("k"), open_tokens.alias("n"), F.lit(False).alias("terminated")))).otherwise(
        F.array().cast(T.ArrayType(T.StructType().add("k", "long").add("n", "long").add("terminated", "boolean")))
    )
    closed = F.transform(
        "lengths",
        lambda x, i: F.struct(i.cast("long").alias("k"), (x + F.when(i == 0, F.col("carry")).otherwise(F.lit(0))).alias("n"), F.lit(True).alias("terminated")),
    )
    documents = carried.select("file", "first_ordinal", "start_block", "n", F.explode(F.concat(closed, ends)).alias("d"))
    return documents.select(
        "file", (F.col("first_ordinal") + F.col("d.k")).alias("ordinal"), F.col("d.n").alias("n_tokens"), F.col("d.terminated").alias("terminated")
    )


def document_ordinals(blocks: DataFrame) -> DataFrame:
    """``(file, ordinal, doc_id)`` of a table that ``write_token_blocks`` stored."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    listed = blocks.select("file", "block", "doc_ids").withColumn("first", F.coalesce(F.sum(F.size("doc_ids")).over(before), F.lit(0)))
    return listed.select("file", "first", F.posexplode("doc_ids").alias("k", "doc_id")).select("file", (F.col("first") + F.col("k")).alias("ordinal"), "doc_id")


def document_token_counts(docs: DataFrame, ranks_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, file, ordinal)`` of every document, counted in its flat token file."""
    blocks = write_token_blocks(docs, ranks_path, doc_id, text)
    counted = count_tokens(blocks)
    return counted.join(document_ordinals(blocks), ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")
