"""A corpus from raw documents: good texts, one of each group of near copies, no repeated passages, no
personal data, neighbours packed together.

``run(spark, sf_dir)`` applies STAGES to the table ``documents``. Each stage takes
(spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the shared folder and
read again as the next one's docs. All but the last return the columns of docs.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sluiceworks
from sluiceworks.llm.byte_cnn import CUT, add_score
from sluiceworks.llm.curve_packing import pack
from sluiceworks.llm.near_dedup import near_duplicates
from sluiceworks.llm.pii import find_personal_data, mask
from sluiceworks.llm.substring_dedup import remove_repeats
from sluiceworks.llm.tables import release, stored, unused

# Tasks get the package's functions by value, so workers need no copy of it on their path.
cloudpickle.register_pickle_by_value(sluiceworks)

SIMILAR = 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier doesn't reject, learned from the table ``labels``.

    A text is judged by its bytes alone; null and empty texts get the score of padding.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = unused(docs, "score")
    return add_score(docs, labels, score).where(F.col(score) >= CUT).drop(score)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id, of repeated rows one.

    Documents are near copies if they have SIMILAR percent of their five-word shingles in common.
    Texts without words and rows without doc_id are no copies of anything and stay.
    """
    kept = near_duplicates(docs, percent=SIMILAR).where("kept AND doc_id IS NOT NULL").select("doc_id")
    named = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi")
    first = F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit("")))
    one = named.groupBy("doc_id").agg(first.alias("_row")).select("_row.*")
    return one.unionByName(docs.where("doc_id IS NULL"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has. A text may become empty.

    Null and empty texts, rows without doc_id and repeated rows stay as they came; an empty table stays empty.
    """
    return remove_repeats(docs).select(*docs.columns)


def _masked(text_at: int):
    """The last column has the spans; each is replaced by its kind in angle brackets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[:-1]
            spans = batch.column(batch.num_columns - 1).to_pylist()
            out = [mask(t.as_py(), s) for t, s in zip(columns[text_at], spans, strict=True)]
            columns[text_at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return run


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and secrets replaced by their kind; overlapping spans become one mark.

    A null text stays null, an empty one empty; repeated rows stay repeated and are masked alike, rows
    without doc_id too; an empty table stays empty.
    """
    found = find_personal_data(docs).where("spans <> ''").dropDuplicates(["doc_id", "print"])
    of, spans = unused(docs, "_of"), unused(docs, "_spans")
    found = found.select(F.struct("doc_id", "print").alias(of), F.col("spans").alias(spans))
    own = F.struct(docs["doc_id"].cast("long"), F.xxhash64(docs["text"]))
    both = docs.join(found, own.eqNullSafe(found[of]), "left").select(
        *[docs[c] for c in docs.columns], found[spans]
    )
    return both.mapInArrow(_masked(docs.columns.index("text")), docs.schema)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that the texts make, with their ids; other columns go.

    A null text is an empty one: it makes a piece of the end id alone. Repeated rows and rows without
    doc_id make pieces of their own. An empty table makes none.
    """
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_each),
    ("substring dedup", without_repeats),
    ("personal data", without_personal_data),
    ("packing", packed),
]

ORACLE_SQL = None  # a trained classifier, hashed sketches and a tokenizer have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark)
    return docs
