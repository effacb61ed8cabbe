"""Images from URLs, from binary cells and from folders.

A decoded image is a struct ``height, width, channels, data`` with bytes row by row, RGB order.
"""

from __future__ import annotations

import struct
import time
import urllib.request
from collections import defaultdict
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from http.client import HTTPException
from itertools import islice
from threading import Lock

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.png import decode_png
from prepkit.operators.maps import add_columns
from prepkit.session import pin, small_side

# How JPEG, GIF, BMP, TIFF and RIFF files begin.
OTHER_FORMATS = (b"\xff\xd8\xff", b"GIF8", b"BM", b"II*\x00", b"MM\x00*", b"RIFF")

#: Seconds of a whole request, bytes of a body, bytes read at a time, and rows that share a copy of a content.
DEADLINE_S, MAX_BYTES, READ_BYTES, ROWS_PER_COPY = 30.0, 64 << 20, 1 << 16, 10_000

open_url = urllib.request.urlopen

IMAGE = "struct<height:int,width:int,channels:int,data:binary>"


def _read(response, deadline: float, max_bytes: int) -> tuple[bytes | None, str | None]:
    """The body of a response, as it arrives; None and a reason when it takes too long or too much room."""
    take = getattr(response, "read1", None) or response.read
    parts, size = [], 0
    while block := take(READ_BYTES):
        size += len(block)
        if size > max_bytes:
            return None, "fetch: body too large"
        if time.monotonic() > deadline:
            return None, "fetch: deadline"
        parts.append(block)
    return b"".join(parts), None


def fetch(
    df: DataFrame,
    url: str,
    timeout_s: float = 1.0,
    threads: int = 16,
    partitions: int | None = None,
    deadline_s: float = DEADLINE_S,
    max_bytes: int = MAX_BYTES,
    one_per_host: bool = False,
) -> DataFrame:
    """Add ``content`` and ``error``: the bytes behind each URL, or why there are none.

    ``timeout_s`` bounds each wait for the other side, ``deadline_s`` a whole request, ``max_bytes`` a body.
    Rows are spread evenly, not by URL, so a URL shared by many rows does not pile up in one task. With
    ``one_per_host`` a task has one open request to a host at a time.
    """
    if partitions:
        df = df.repartition(partitions)
    opened = open_url

    def get(address: str | None) -> tuple[bytes | None, str | None]:
        if address is None:
            return None, "no url"
        try:
            deadline = time.monotonic() + deadline_s
            with opened(address, timeout=timeout_s) as response:
                return _read(response, deadline, max_bytes)
        except (OSError, ValueError, HTTPException) as error:
            return None, f"fetch: {type(error).__name__}"

    def get_all(cells: Iterator[tuple]) -> Iterator[tuple]:
        hosts: defaultdict[str, Lock] = defaultdict(Lock)

        def get_alone(address: str | None) -> tuple[bytes | None, str | None]:
            with hosts[host_name(address or "")]:
                return get(address)

        # A few requests per thread at a time, so that few answers wait in memory.
        with ThreadPoolExecutor(threads) as pool:
            while part := [address for (address,) in islice(cells, 2 * threads)]:
                yield from pool.map(get_alone if one_per_host else get, part)

    return add_columns(df, [url], "content binary, error string", get_all)


def host_name(address: str) -> str:
    """What stands between the slashes of a URL, or nothing."""
    return address.split("//", 1)[-1].split("/", 1)[0].lower() if "//" in address else ""


def fetch_once(df: DataFrame, url: str, host_requests: int | None = None, **options) -> DataFrame:
    """As ``fetch``, but each distinct URL is asked once and stored, whatever number of rows share it.

    Content comes back to the rows by a join on the URL; a URL of many rows meets as many copies of its
    content as their number asks for. With ``host_requests`` a host has at most so many open requests over
    all tasks: its URLs go to so many tasks, each with one request to it at a time.
    """
    partitions = options.pop("partitions", None)
    counts = pin(df.where(F.col(url).isNotNull()).groupBy(F.col(url).alias("__u")).agg(F.count(F.lit(1)).alias("__n")), "urls")
    asked = counts
    if host_requests:
        host = F.lower(F.regexp_extract("__u", "//([^/]*)", 1))
        asked = asked.withColumn("__h", host).withColumn("__part", F.pmod(F.xxhash64("__u"), F.lit(host_requests)))
        keys = ("__h", "__part")
        asked = asked.repartition(partitions, *keys) if partitions else asked.repartition(*keys)
        options["one_per_host"] = True
        partitions = None
    found = pin(fetch(asked.select("__u", "__n"), "__u", partitions=partitions, **options), "fetched")
    copies = F.ceil(F.col("__n") / F.lit(ROWS_PER_COPY)).cast("int")
    hot = small_side(pin(counts.where(copies > 1).select(F.col("__u").alias("__hot"), copies.alias("__copies")), "hot"))
    salted = df.join(hot, F.col(url) == F.col("__hot"), "left").withColumn(
        "__salt", F.pmod(F.monotonically_increasing_id(), F.coalesce("__copies", F.lit(1))).cast("int")
    )
    spread = found.withColumn("__copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    joined = salted.join(spread, (F.col(url) == F.col("__u")) & (F.col("__salt") == F.col("__copy")), "left")
    error = F.when(F.col(url).isNull(), F.lit("no url")).otherwise(F.col("error"))
    return joined.withColumn("error", error).drop("__u", "__n", "__copy", "__salt", "__hot", "__copies")


def fetch_stored(df: DataFrame, url: str, **options) -> DataFrame:
    """``fetch_once`` into the shared folder, so that later stages and retries never ask the network again."""
    return pin(fetch_once(df, url, **options))


def default_decoder() -> Callable[[bytes], np.ndarray]:
    """An imaging library if the executor has one, else the PNG reader."""
    try:
        from PIL import Image
    except ImportError:
        return decode_png

    from io import BytesIO

    def decode(content: bytes) -> np.ndarray:
        image = Image.open(BytesIO(content))
        # Palettes, bits and deep greys as what they show; other modes hold bytes by channel already.
        if image.mode == "P":
            image = image.convert("RGBA" if "transparency" in image.info else "RGB")
        elif image.mode == "1" or image.mode.startswith(("I", "F")):
            image = image.convert("L") if image.mode == "1" else Image.fromarray(_bytes_of(np.asarray(image)))
        pixels = np.asarray(image)
        return pixels[:, :, None] if pixels.ndim == 2 else pixels

    return decode


def _bytes_of(deep: np.ndarray) -> np.ndarray:
    """16-bit greys as bytes; other ranges are cut to bytes."""
    values = deep.astype("float64")
    return (values / 257 if values.max(initial=0) > 255 else values).clip(0, 255).astype(np.uint8)


def needs_library(content: bytes | None) -> bool:
    """Whether bytes look like an image format that only an imaging library reads."""
    return content is not None and bytes(content[:12]).startswith(OTHER_FORMATS)


def decode_cell(cell: bytes | None, read: Callable[[bytes], np.ndarray]) -> tuple[np.ndarray | None, str | None]:
    """Pixels of a cell, or why there are none."""
    if cell is None:
        return None, "no content"
    if read is decode_png and needs_library(cell):
        # Not a bad image: without the library every row of this kind would be lost unseen.
        raise RuntimeError("an image that is no PNG needs an imaging library on the executors")
    try:
        return read(bytes(cell)), None
    except (OSError, ValueError, SyntaxError, struct.error, EOFError) as problem:
        return None, f"decode: {problem}"


def decode_images(
    df: DataFrame,
    content: str = "content",
    out: str = "image",
    error: str = "error",
    decoder: Callable[[bytes], np.ndarray] | None = None,
) -> DataFrame:
    """Add the decoded image, null where the bytes cannot be read, and say why in ``error``."""

    def decode_all(cells: Iterator[tuple]) -> Iterator[tuple]:
        read = decoder or default_decoder()
        for (cell,) in cells:
            pixels, problem = decode_cell(cell, read)
            if pixels is None:
                yield None, problem
                continue
            height, width, channels = pixels.shape
            yield {"height": height, "width": width, "channels": channels, "data": pixels.tobytes()}, None

    return with_first_error(add_columns(df, [content], f"__image {IMAGE}, __error string", decode_all), error).withColumnRenamed(
        "__image", out
    )


def with_first_error(df: DataFrame, error: str) -> DataFrame:
    """Merge a step's ``__error`` into ``error``; the earlier reason stays."""
    earlier = F.col(error) if error in df.columns else F.lit(None).cast("string")
    return df.withColumn(error, F.coalesce(earlier, F.col("__error"))).drop("__error")


def read_image_folder(spark: SparkSession, path: str, drop_invalid: bool = False) -> DataFrame:
    """Images of a folder through Spark's image source: ``origin``, ``image``, ``error``."""
    df = spark.read.format("image").option("dropInvalid", str(drop_invalid).lower()).load(path)
    return df.select(
        F.col("image.origin").alias("origin"),
        *_from_source(F.col("image")),
    )


def _from_source(image: Column) -> list[Column]:
    ok = image["height"] > 0
    struct = F.struct(
        image["height"].alias("height"),
        image["width"].alias("width"),
        image["nChannels"].alias("channels"),
        rgb_order(image["data"], image["nChannels"]).alias("data"),
    )
    return [
        F.when(ok, struct).alias("image"),
        F.when(~ok, F.lit("decode: unreadable file")).alias("error"),
    ]


def _flip(cell: bytes | None, channels: int) -> bytes | None:
    if cell is None or channels < 3:
        return cell
    pixels = np.frombuffer(cell, dtype=np.uint8).reshape(-1, channels).copy()
    pixels[:, :3] = pixels[:, 2::-1]
    return pixels.tobytes()


def rgb_order(data: Column, channels: Column) -> Column:
    """Blue-first bytes turned into red-first bytes; grey bytes stay."""

    @F.pandas_udf("binary")
    def flip_all(cells: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([_flip(c, n) for c, n in zip(cells, counts, strict=True)], dtype=object)

    return flip_all(data, channels)


def load_content(
    df: DataFrame, col: str, out: str = "content", timeout_s: float = 1.0, store_fetched: bool = True, **options
) -> DataFrame:
    """Add what an image can be made from, and ``error``, choosing by the type of ``col``.

    Image structs and binary cells are used as they are; strings are fetched as URLs.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StringType):
        fetched = (fetch_stored if store_fetched else fetch_once)(df, col, timeout_s=timeout_s, **options)
        return fetched if out == "content" else fetched.withColumnRenamed("content", out)
    if isinstance(dtype, T.StructType) and "nChannels" in dtype.names:
        image, error = _from_source(F.col(col))
        return df.withColumn("error", error).withColumn(out, image)
    if isinstance(dtype, T.StructType):
        return df.withColumn("error", F.when(F.col(col).isNull(), F.lit("no image"))).withColumn(out, F.col(col))
    if isinstance(dtype, T.BinaryType):
        return df.withColumn("error", F.lit(None).cast("string")).withColumn(out, F.col(col))
    raise ValueError(f"column {col!r} of type {dtype.simpleString()} holds no images")


def load_images(df: DataFrame, col: str, out: str = "image", **options) -> DataFrame:
    """Add the decoded image and ``error`` from structs, binary cells or URLs."""
    loaded = load_content(df, col, "__content", **options)
    if isinstance(loaded.schema["__content"].dataType, T.BinaryType):
        return decode_images(loaded, "__content", out).drop("__content")
    return loaded.withColumn(out, F.col("__content")).drop("__content")


def load_mixed(df: DataFrame, binary: str, url: str, out: str = "image", **options) -> DataFrame:
    """Rows carry either bytes or a URL: bytes are used first, the rest is fetched."""
    missing = F.when(F.col(binary).isNull(), F.col(url))
    fetched = fetch_stored(df.withColumn("__url", missing), "__url", **options).drop("__url")
    content = F.coalesce(F.col(binary), F.col("content"))
    reason = F.when(F.col(binary).isNull(), F.col("error"))
    return decode_images(fetched.withColumns({"content": content, "error": reason}), "content", out).drop("content")
