"""Media columns: progressive JPEGs written, read again and turned into tensors.

with_media() stores bytes as the coefficients of a progressive JPEG, which is the unit in which that format is
lossless: each 64 bytes are one block, byte b the coefficient b - 128, in zigzag order; blocks fill the luma plane, then
the two chroma planes of half its height and width. A comment holds their number. with_tensors() reads any
progressive JPEG: scans accumulate into coefficient arrays, numpy transforms them back, chroma is upsampled, and the
RGB tensor at full resolution, a feature of it and the bytes that a comment tells of are stored beside the image.

Images of a batch are coded together (see jpeg.py), some hundred kilobytes at a time; one long text is coded by its
restart intervals, so beside text, image, coefficients (two bytes each) and tensor (two bytes a payload byte) no more is held.

Defined cases
    null text: as the empty text, 64 zero bytes. Texts of any length: whole, up to what a cell of Spark holds.
    null media, no progressive JPEG, or one that is cut off: a null struct; other rows of the batch are not touched.
    images that with_media() has not made: their payload is null.
    equal texts give equal bytes, tensors and features. Repeated rows and rows without an id: each by itself.
    empty table: empty result. Extra columns are carried, whatever their names; the new one's name is the caller's.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import jpeg
from lectern.llm.common import fresh, table

BLOCK = 64
#: Luma has twice the rows and columns of chroma, so six blocks are one unit.
SAMPLING, UNIT = ((2, 2), (1, 1), (1, 1)), 6
SAYS = b"payload blocks "
#: What is coded at a time, unless one row is larger.
BYTES = jpeg.GROUP * BLOCK
TENSOR = T.StructType().add("height", "integer").add("width", "integer").add("data", "binary").add("feature", "string").add("payload", "binary")


def frame_of(n_blocks: int) -> jpeg.Frame:
    """A nearly square frame with room for so many blocks."""
    units = -(-n_blocks // UNIT)
    wide = math.isqrt(units)
    return jpeg.Frame(16 * -(-units // wide), 16 * wide, SAMPLING, [np.ones(64)] * 3)


def padded(data: bytes) -> np.ndarray:
    """The payload: data and zeros up to a positive multiple of BLOCK."""
    out = np.zeros(max(1, -(-len(data) // BLOCK)) * BLOCK, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out


def stored(texts: list[bytes]) -> list[bytes]:
    frames, images, said = [], [], []
    for text in texts:
        blocks = padded(text).astype(np.int16).reshape(-1, BLOCK) - 128
        frame = frame_of(len(blocks))
        sizes = [math.prod(frame.grid(c)) for c in range(3)]
        all_ = np.zeros((sum(sizes), BLOCK), np.int16)
        all_[: len(blocks)] = blocks
        frames.append(frame)
        images.append(np.split(all_, np.cumsum(sizes)[:-1]))
        said.append(SAYS + str(len(blocks)).encode())
    return jpeg.encode(frames, images, said)


def payload(image: jpeg.Parsed, blocks: list[np.ndarray]) -> bytes | None:
    for said in image.comments:
        if said.startswith(SAYS) and said[len(SAYS) :].isdigit():
            n, parts = int(said[len(SAYS) :]), []
            for own in blocks:
                parts.append((own[: max(0, n)] + 128).astype(np.uint8).tobytes())
                n -= len(own)
            return b"".join(parts)
    return None


def feature(tensor: np.ndarray) -> str:
    """Height, width, the sums of the three channels and a checksum."""
    sums = tensor.reshape(len(tensor), -1).sum(axis=0, dtype=np.int64).reshape(-1, 3).sum(axis=0)
    return "{}x{}:{}:{}:{}:{:08x}".format(*tensor.shape[:2], *sums.tolist(), zlib.crc32(tensor))


def _read(images: list[jpeg.Parsed]) -> list[dict]:
    out, all_ = [], jpeg.coefficients(images)
    for image, blocks, tensor in zip(images, all_, jpeg.rgbs([x.frame for x in images], all_)):
        out.append({"height": tensor.shape[0], "width": tensor.shape[1], "data": tensor.tobytes(), "feature": feature(tensor), "payload": payload(image, blocks)})
    return out


def tensors(media: list[bytes | None]) -> list[dict | None]:
    """Images of one make are read together; a group that holds a broken one is read one by one."""
    out, alike = [None] * len(media), {}
    for row, data in enumerate(media):
        try:
            image = jpeg.parse(data or b"")
        except (ValueError, IndexError, KeyError):
            continue
        alike.setdefault(image.key(), []).append((row, image))
    left = list(alike.values())
    while left:
        group = left.pop()
        try:
            told = _read([image for _, image in group])
        except (ValueError, IndexError):
            left += [[x] for x in group] if len(group) > 1 else []
            continue
        for (row, _), own in zip(group, told):
            out[row] = own
    return out


def _grouped(df: DataFrame, column: str, into: str, kind: T.DataType, made: Callable[[list], pa.Array]) -> DataFrame:
    """df with made() of a binary column, some rows at a time."""
    names = [*df.columns, into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, first, size = batch.column(column), 0, 0
            for row in range(batch.num_rows):
                size += len(own[row].as_buffer() or b"") if own[row].is_valid else 0
                if size >= BYTES or row + 1 == batch.num_rows:
                    part = batch.slice(first, row + 1 - first)
                    new = made(part.column(column).to_pylist())
                    yield pa.RecordBatch.from_arrays([*part.columns, new], names)
                    first, size = row + 1, 0

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(into, kind)]))


def with_media(df: DataFrame, column: str = "text", into: str = "media") -> DataFrame:
    """df with an image of each row's text, as UTF-8."""
    raw = fresh(df, "raw")
    wide = df.withColumn(raw, F.coalesce(F.col(f"`{column}`").cast("binary"), F.lit(b"")))
    return _grouped(wide, raw, into, T.BinaryType(), lambda rows: pa.array(stored(rows), pa.binary())).drop(raw)


def with_tensors(df: DataFrame, column: str = "media", into: str = "tensor") -> DataFrame:
    """df with a struct of height, width, data (height x width x 3 bytes), feature, payload."""
    kind = pa.struct([("height", pa.int32()), ("width", pa.int32()), ("data", pa.binary()), ("feature", pa.string()), ("payload", pa.binary())])
    return _grouped(df, column, into, TENSOR, lambda rows: pa.array(tensors(rows), kind))


def op12_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    media = with_media(docs).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "media")
    read = F.col("tensor.payload")
    return with_tensors(media).select(
        "doc_id",
        "n_bytes",
        F.length(read).cast("long").alias("payload_bytes"),
        F.sha2(read, 256).alias("payload_sha256"),
        F.crc32(F.substring(read, -BLOCK, BLOCK)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.col("tensor.feature").alias("feature"),
    )
