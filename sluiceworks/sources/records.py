"""CSV records whose quoted fields hold line breaks, cut in parallel from splittable files.

A line ends a record if the quotes from the file's beginning up to there are even in number. Files are
read in chunks, as Spark splits them:

1. Each chunk tells whether its quotes are odd in number, and whether a line within it ends a record,
   for both cases of what comes before it.
2. A prefix sum over the chunks of a file tells what does come before each chunk.
3. Each chunk is cut into records on its own. What its first and last lines leave of records that cross
   chunks, at most two pieces a chunk, is put together by the chunk where the record begins.

Quotes within fields are doubled and stand in quoted fields only, as RFC 4180 has it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceworks.storage import scratch_dir

QUOTE = '"'
MOST_CHUNKS = 100_000  # whose beginnings are broadcast
TASK_BYTES = 1 << 27  # of small chunks that one task reads, if that leaves enough tasks
TASKS_PER_CORE = 4
_PIECE = pa.schema(
    [("owner", pa.int64()), ("chunk", pa.int64()), ("record", pa.string()), ("closed", pa.bool_())]
)


def csv_lines(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """The lines of CSV files, with their file and chunk: what ``whole_records`` takes.

    Of a stream, each micro-batch has whole files, so it goes through ``whole_records`` in
    ``foreachBatch``.
    """
    reader = (spark.readStream if streaming else spark.read).options(**options)
    return reader.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("chunk"),
    )


def _parts(batches: Iterator[pa.RecordBatch], *by: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows with the same values of the columns ``by``, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).dictionary_encode() for c in by]
        codes = [c.indices.to_numpy() for c in columns]
        new = np.zeros(batch.num_rows - 1, dtype=bool)
        for code in codes:
            new |= code[1:] != code[:-1]
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(c.dictionary[int(x[begin])].as_py() for c, x in zip(columns, codes, strict=True))
            yield key, batch.slice(begin, end - begin)


def _inside(part: pa.RecordBatch, before: bool) -> np.ndarray:
    """Of each line whether its end is within quotes; ``before`` says it of the first one's beginning."""
    quotes = pc.count_substring(part.column("value"), QUOTE).to_numpy(zero_copy_only=False)
    return (np.cumsum(quotes, dtype=np.int64) + before) % 2 == 1


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, chunk, odd, ends_even, ends_odd): whether a line ends a record after an even or odd beginning."""
    now, odd, ends = None, False, [False, False]

    def answer() -> pa.RecordBatch:
        values = [*now, odd, *ends]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
            ["file", "chunk", "odd", "ends_even", "ends_odd"],
        )

    for key, part in _parts(batches, "file", "chunk"):
        if key != now:
            if now is not None:
                yield answer()
            now, odd, ends = key, False, [False, False]
        after = _inside(part, odd)
        odd = bool(after[-1])
        ends = [ends[0] or not after.all(), ends[1] or bool(after.any())]
    if now is not None:
        yield answer()


def _known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.column("number").null_count:
            raise ValueError("the files were cut into other chunks before: were settings changed?")
        yield batch


def _cut(wanted: str):
    """Lines of numbered chunks to records that lie in one chunk (``whole``) or to ``pieces`` of others.

    A piece has the number of the chunk where its record begins as ``owner``, and its own ``chunk``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, owner, open_ = None, False, 0, []

        def piece(closed: bool) -> Iterator[pa.RecordBatch]:
            text = "\n".join(open_)
            open_.clear()
            if wanted == "pieces":
                yield pa.RecordBatch.from_pylist(
                    [{"owner": owner, "chunk": now[1], "record": text, "closed": closed}], _PIECE
                )

        def whole(records: pa.Array) -> Iterator[pa.RecordBatch]:
            if wanted == "whole" and len(records):
                yield pa.RecordBatch.from_arrays([records.cast(pa.string())], ["record"])

        for key, part in _parts(_known(batches), "number", "chunk"):
            if key != now:
                if open_:
                    yield from piece(False)
                now = key
                inside, owner = (part.column(c)[0].as_py() for c in ("inside", "owner"))
            lines, after = part.column("value"), _inside(part, inside)
            ends = np.flatnonzero(~after) + 1  # of records, one behind the last line
            inside = bool(after[-1])
            if not len(ends):
                open_.extend(lines.to_pylist())
                continue
            open_.extend(lines.slice(0, ends[0]).to_pylist())
            if owner != now[0]:
                yield from piece(True)  # the end of a record of an earlier chunk
                owner = now[0]
            else:
                first = pa.array(["\n".join(open_)])
                open_.clear()
                yield from whole(first)
            if wanted == "whole":
                groups = pa.ListArray.from_arrays(
                    pa.array(ends - ends[0], pa.int32()), lines.slice(ends[0], ends[-1] - ends[0])
                )
                yield from whole(pc.binary_join(groups, "\n"))
            open_.extend(lines.slice(ends[-1]).to_pylist())
        if open_:
            yield from piece(False)

    return run


def _in_fewer_tasks(lines: DataFrame) -> DataFrame:
    """Several small chunks for each task, one after the other; large ones stay by themselves."""
    spark = lines.sparkSession
    chunk_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    tasks = lines.rdd.getNumPartitions()
    fewest = min(tasks, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    wanted = max(fewest, -(-tasks // max(1, TASK_BYTES // chunk_bytes)))
    return lines.coalesce(wanted) if 0 < wanted < tasks else lines


def whole_records(lines: DataFrame) -> DataFrame:
    """(record, closed) for each record of ``lines`` (value, file, chunk), without its line's end.

    A record that its file's end leaves open is not closed. Empty lines between records are left out,
    those within quotes stay. The chunks are written to the scratch folder at once, a row for each, so
    settings that cut files into chunks must stay until the records are read.
    """
    spark = lines.sparkSession
    lines = _in_fewer_tasks(lines)
    summary = lines.mapInArrow(
        _summaries, "file string, chunk long, odd boolean, ends_even boolean, ends_odd boolean"
    ).withColumn("number", F.monotonically_increasing_id())
    order = Window.partitionBy("file").orderBy("chunk")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    begun = F.coalesce(F.sum(F.col("odd").cast("long")).over(before), F.lit(0)) % 2 == 1
    marked = summary.withColumn("inside", begun)
    leaves_open = F.col("inside") != F.col("odd")
    begins_here = leaves_open & (~F.col("inside") | F.col("ends_odd"))
    opener = F.last(F.when(begins_here, F.col("number")), ignorenulls=True).over(before)
    owner = F.when(F.col("inside"), opener).otherwise(F.col("number"))
    chunks = marked.select("file", "chunk", "number", "inside", owner.alias("owner"))
    place = scratch_dir(spark, "chunks")
    chunks.write.parquet(place)
    chunks = spark.read.schema(chunks.schema).parquet(place)
    # a left join, so that lines of a chunk that wasn't there before are seen
    if chunks.count() <= MOST_CHUNKS:
        placed = lines.join(F.broadcast(chunks), ["file", "chunk"], "left")
    else:  # a chunk's lines meet again in one task, in their order
        numbered = lines.withColumn("line", F.monotonically_increasing_id())
        placed = numbered.join(chunks, ["file", "chunk"], "left")
        placed = placed.sortWithinPartitions("file", "chunk", "line")
    placed = placed.select("value", "number", "chunk", "inside", "owner")
    whole = placed.mapInArrow(_cut("whole"), "record string").withColumn("closed", F.lit(True))
    pieces = placed.mapInArrow(_cut("pieces"), "owner long, chunk long, record string, closed boolean")
    joined = pieces.groupBy("owner").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "record", "closed"))).alias("all")
    ).select(
        F.array_join(F.col("all.record"), "\n").alias("record"),
        F.element_at("all", -1)["closed"].alias("closed"),
    )
    every = whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return every.where("record <> ''")
