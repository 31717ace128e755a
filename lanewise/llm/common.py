"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.session import shared_dir, ship_with_tasks

ship_with_tasks(__name__)

#: The characters that separate words: space and the controls \t \n \v \f \r.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body reads it."""
    return F.transform(F.array(value), body)[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def vocabulary_file(name: str, folder: str | None = None) -> str:
    """The content of a public tokenizer's file; the installed ones unless ``folder`` names others."""
    if folder is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    else:
        path = f"{folder}/{name}"
    with open(path, encoding="utf-8") as f:
        return f.read()


def crc32_of(ids: str) -> Column:
    """Unsigned crc32 of a binary column."""
    return F.crc32(ids)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the rows no model may learn labels from."""
    return F.crc32(doc_id.cast("string")) % folds == 0


def text_batches(
    batches: Iterator[pa.RecordBatch], max_bytes: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of one stay near ``max_bytes``; long rows stand alone."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        sizes = pa.compute.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
        begin = total = 0
        for i, n in enumerate(sizes.tolist()):
            if total and total + n > max_bytes:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        if begin < len(sizes):
            yield batch.slice(begin)
