"""One query for each operator, over the whole table that it is meant for."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceworks.llm.arrow_words import text_bytes
from sluiceworks.llm.byte_cnn import CUT, held_out, score_quality
from sluiceworks.llm.curve_packing import pack
from sluiceworks.llm.hamming_search import nearest, sign_code
from sluiceworks.llm.license_scan import scan_licenses
from sluiceworks.llm.metric_join import near_vectors
from sluiceworks.llm.near_dedup import near_duplicates
from sluiceworks.llm.oracle import ORACLE
from sluiceworks.llm.periodic_runs import find_runs
from sluiceworks.llm.pii import BASE, find_personal_data
from sluiceworks.llm.quality_rules import judge
from sluiceworks.llm.spelling_variants import group_variants, letter_runs, word_counts
from sluiceworks.llm.substring_dedup import remove_repeats
from sluiceworks.llm.token_files import read_digests, token_folder, write_tokens
from sluiceworks.llm.trie_bpe import decode, encode


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_adaptive_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "documents"))


def op2_packed_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_tokens(
        _table(spark, sf_dir, "documents"),
        token_folder(spark),
        public_tokenizers.path("word_bpe_49k.json"),
        end_id=1,
    )
    return read_digests(files)


def _word_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text as the sha256 of its words joined by one space."""
    for batch in batches:
        offsets, data = text_bytes(batch.column(3))
        digests = [
            hashlib.sha256(b" ".join(data[a:b].tobytes().split())).hexdigest()
            for a, b in zip(offsets[:-1], offsets[1:], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(digests, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", "text").mapInArrow(
        _word_digests, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


def op4_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.drop("ids")  # ids_crc32 stands for them


def _token_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed ids as the sha256 of the decimal ids joined by commas, a text as its sha256."""
    signs: list[bytes] = []
    for batch in batches:
        ids, texts, n = [], [], []
        for packed, text in zip(batch.column(1), batch.column(2), strict=True):
            own = np.frombuffer(packed.as_buffer(), "<u4")
            most = int(own.max(initial=0))
            signs.extend(b"%d" % i for i in range(len(signs), most + 1))
            joined = b",".join([signs[i] for i in own.tolist()])
            n.append(len(own))
            ids.append(hashlib.sha256(joined).hexdigest())
            texts.append(hashlib.sha256(text.as_buffer()).hexdigest())
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(texts)]
        yield pa.RecordBatch.from_arrays(
            columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        )


def op5_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    back = decode(encode(_table(spark, sf_dir, "documents"), tokenizer), tokenizer)
    return back.mapInArrow(
        _token_digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op6_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every vector whose id is divisible by 20, among all vectors."""
    codes = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), sign_code("embedding").alias("code")
    )
    queries = codes.where("id % 20 = 0").withColumnRenamed("id", "query_id")
    return nearest(codes, queries, k=10).withColumnRenamed("id", "vec_id")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_license_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")  # score and labels are theirs


def op9_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(_table(spark, sf_dir, "documents"))
    counts = [F.col("counts")[i].alias(f"n_{kind}") for i, kind in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op10_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def _planted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each text, of one text in ten made periodic from some word on."""
    for batch in batches:
        offsets, data = text_bytes(batch.column(1))
        texts = []
        for doc_id, a, b in zip(batch.column(0).to_pylist(), offsets[:-1], offsets[1:], strict=True):
            words = data[a:b].tobytes().split()
            h = zlib.crc32(b"%d" % doc_id) if doc_id is not None else 1
            if h % 10 == 0 and words:
                n, g = len(words), h // 10
                first = g % n
                period = 1 + (n - first) // (3 + g % 8)
                words = [words[first + (i - first) % period if i > first else i] for i in range(n)]
            texts.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"]
        )


def _run_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The longest run of each row, all runs and the text as their sha256."""
    for batch in batches:
        rows = []
        for runs, text in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            best = min(runs, key=lambda r: (-r["length"], r["start"], r["period"]), default=None)
            longest = [best["start"], best["length"], best["period"]] if best else [None] * 3
            milli = 1000 * best["length"] // best["period"] if best else None
            lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs)
            signs = [hashlib.sha256(x).hexdigest() for x in (lines.encode(), text.as_buffer())]
            rows.append((len(runs), *longest, milli, *signs))
        columns = zip(*rows, strict=True) if rows else [[]] * 7
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
            ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
        )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(docs.mapInArrow(_planted_runs, "doc_id long, text string"))
    return found.select("doc_id", "runs", "text").mapInArrow(
        _run_digests,
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string",
    )


def op12_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = letter_runs(_table(spark, sf_dir, "documents"))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    short = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % 199 == 0, short).otherwise(F.col("run"))
    return group_variants(word_counts(runs.withColumn("h", h).select(word.alias("word"))))


__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_adaptive_quality_rules,
        op2_packed_token_files,
        op3_substring_dedup,
        op4_curve_packing,
        op5_trie_bpe,
        op6_hamming_top_k,
        op7_minhash_near_dedup,
        op8_license_automaton,
        op9_contextual_pii,
        op10_byte_cnn_quality,
        op11_periodic_runs,
        op12_metric_join,
        op13_spelling_variants,
    )
}
