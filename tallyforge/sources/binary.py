"""Binary files: digit images and labels, and picture folders."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The leading number of an image file and of a label file.
IMAGE_MAGIC, LABEL_MAGIC = 2051, 2049
_ROWS_PER_BATCH = 4096


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, modificationTime, length, content``: one row per file."""
    return spark.read.format("binaryFile").load(path)


def _content(raw: bytes) -> bytes:
    return gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw


def _header(data: bytes, words: int, magic: int, file: str) -> np.ndarray:
    found = int.from_bytes(data[:4], "big")
    if found != magic:
        raise ValueError(f"{file}: magic number {found}, expected {magic}")
    return np.frombuffer(data, dtype=">i4", count=words)


def _image_rows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for file, raw in zip(frame.column("path").to_pylist(), frame.column("content").to_pylist()):
            data = _content(raw)
            _, count, height, width = _header(data, 4, IMAGE_MAGIC, file)
            size = int(height) * int(width)
            pixels = np.frombuffer(data, dtype=np.uint8, offset=16, count=int(count) * size).reshape(int(count), size)
            for at in range(0, int(count), _ROWS_PER_BATCH):
                part = pixels[at : at + _ROWS_PER_BATCH].astype(np.float64)
                edges = pa.array(np.arange(0, part.size + 1, size, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file] * len(part)),
                        pa.array(np.arange(at, at + len(part), dtype=np.int64)),
                        pa.ListArray.from_arrays(edges, pa.array(part.reshape(-1))),
                    ],
                    names=["file", "idx", "pixels"],
                )


def read_digit_images(spark: SparkSession, path: str) -> DataFrame:
    """A folder of image files, plain or gzipped: one row per image with unsigned
    pixels. Files are the unit of parallel work; rows leave in batches."""
    files = read_files(spark, path).select("path", "content")
    return files.mapInArrow(_image_rows, "file string, idx long, pixels array<double>")


def _label_rows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for frame in frames:
        for file, raw in zip(frame.column("path").to_pylist(), frame.column("content").to_pylist()):
            data = _content(raw)
            count = int(_header(data, 2, LABEL_MAGIC, file)[1])
            labels = np.frombuffer(data, dtype=np.uint8, offset=8, count=count).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * count), pa.array(np.arange(count, dtype=np.int64)), pa.array(labels)],
                names=["file", "idx", "label"],
            )


def read_digit_labels(spark: SparkSession, path: str) -> DataFrame:
    files = read_files(spark, path).select("path", "content")
    return files.mapInArrow(_label_rows, "file string, idx long, label double")


def labelled_digits(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Images with their labels, matched by set name and position in the file.

    The set name is the file name up to ``-images`` or ``-labels``.
    """
    name = F.regexp_extract("file", r"([^/]*?)[-._]?(?:images|labels)[^/]*$", 1)
    return (
        images.withColumn("set", name)
        .drop("file")
        .join(labels.withColumn("set", name).drop("file"), ["set", "idx"])
        .select("set", "idx", F.col("pixels").alias("features"), "label")
    )


def _gray(image: dict, width: int, height: int) -> np.ndarray:
    """Luma of a decoded image (blue, green, red order), nearest-pixel resize."""
    raw = np.frombuffer(image["data"], dtype=np.uint8).reshape(image["height"], image["width"], image["nChannels"])
    rows = ((np.arange(height) + 0.5) * image["height"] / height).astype(int)
    cols = ((np.arange(width) + 0.5) * image["width"] / width).astype(int)
    small = raw[np.ix_(rows, cols)].astype(np.float64)
    if small.shape[2] == 1:
        return small[:, :, 0].reshape(-1)
    # Luma weights of blue, green and red.
    return np.rint(small[:, :, :3] @ np.array([0.114, 0.587, 0.299])).reshape(-1)


def read_pictures(spark: SparkSession, path: str, width: int = 50, height: int = 50) -> DataFrame:
    """A folder of pictures as ``(file, features)``: gray, resized, row by row.

    Spark decodes; the rest is array arithmetic on each decoded image. A file that is no
    readable picture has a row with null features.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            images = batch.column("image").to_pylist()
            yield pa.RecordBatch.from_pydict(
                {
                    "file": [i["origin"] for i in images],
                    "features": [_gray(i, width, height) if i["height"] > 0 else None for i in images],
                },
                schema=pa.schema([("file", pa.string()), ("features", pa.list_(pa.float64()))]),
            )

    images = spark.read.format("image").option("dropInvalid", "false").load(path)
    return images.mapInArrow(run, "file string, features array<double>")
