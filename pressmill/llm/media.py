"""Media columns: texts carried in progressive JPEG pictures, read back and turned into RGB tensors.

A text's UTF-8 bytes, filled with zero bytes to a positive multiple of 64, become the quantised
coefficients of a picture (the format's unit; see jpeg.py), so storing is lossless. Reading accumulates the
scans into coefficients, which give the payload, and transforms them into samples. Rows are independent:
there is no shuffle, and memory is bounded by a batch and its longest text.

Edge cases: null or empty text is one block of zeros; very long texts make larger pictures (up to
4095 units of 16 samples each way); repeated rows get equal values; an empty table gives an
empty result; columns of the table named like a result are replaced, others stay.
"""

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .jpeg import Picture, encode

READ = {"payload": "binary", "height": "int", "width": "int", "rgb": "binary", "feature": "string"}


def padded(text: bytes) -> bytes:
    return text + bytes(-len(text) % 64 or (0 if text else 64))


def _mapped(df: DataFrame, source: str, added: dict, make) -> DataFrame:
    """All columns of df but those added, and what make(bytes) gives for the source column of each row."""
    keep = [c for c in df.columns if c not in added]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(c, T._parse_datatype_string(kind)) for c, kind in added.items()])
    kinds = {"binary": pa.binary(), "string": pa.string(), "int": pa.int32(), "long": pa.int64()}

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                made = list(zip(*(make(x) for x in part.column("_source").to_pylist())))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(v, kinds[k]) for v, k in zip(made, added.values()))], names=[*keep, *added])

    return df.select(*keep, F.col(source).cast("binary").alias("_source")).mapInArrow(run, schema)


def store_media(docs: DataFrame) -> DataFrame:
    """docs with n_bytes (of the text) and media (the picture)."""
    return _mapped(docs, "text", {"n_bytes": "long", "media": "binary"}, lambda text: (len(text or b""), encode(padded(text or b""))))


def feature(rgb) -> str:
    """Size and mean colour."""
    means = rgb.reshape(-1, 3).mean(axis=0, dtype=float)
    return f"{rgb.shape[0]}x{rgb.shape[1]} " + " ".join(f"{m:.4f}" for m in means)


def _read(media: bytes):
    picture = Picture(media)
    rgb = picture.rgb()
    return picture.payload(), *rgb.shape[:2], rgb.tobytes(), feature(rgb)


def read_media(stored_media: DataFrame) -> DataFrame:
    """The rows with payload, height, width, rgb (a height x width x 3 tensor of bytes) and feature."""
    return _mapped(stored_media, "media", READ, _read)


def _digest(media: bytes):
    payload, _, _, _, found = _read(media)
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), found


def media_digests(stored_media: DataFrame) -> DataFrame:
    """What read_media finds, as digests."""
    added = {"payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string"}
    return _mapped(stored_media, "media", added, _digest).drop("media")


def op6_progressive_jpeg(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return media_digests(store_media(docs).drop("text"))
