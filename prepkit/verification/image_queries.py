"""Images: derived from the embeddings table as PNG bytes and data URLs, then fetched and decoded.

The 64 values of a vector become bytes; its label chooses what they are stored as: 0-4 a grey 8x8
image, 5-6 an RGB 8x8 image, 7 an RGBA 4x4 image, 8 a damaged file, 9 a URL that cannot be read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.config import ImageClassJob
from prepkit.functions.png import encode_png
from prepkit.operators import pixels as ops
from prepkit.operators.batches import assign_batches
from prepkit.operators.batches import stack_pixels as stack
from prepkit.operators.checks import keep_complete
from prepkit.operators.maps import map_rows
from prepkit.operators.pixels import IMAGE_MEAN, IMAGE_STD, PixelSpec
from prepkit.plans.images import image_prepare as prepare
from prepkit.session import pin, spread
from prepkit.sources import images
from prepkit.verification.registry import (
    ROWS_PER_SHARD,
    micro_text,
    query,
    sql_batches,
    sql_hash_split,
    sql_micro,
    sql_shards,
    sql_text,
    table,
    text_of,
)

SQL_PX = """px as (select vec_id, label, list_transform(embedding,
    lambda x: cast(floor((cast(x as double) + 1) * 127.5) as int)) as px from embeddings)"""
# Channel bytes as stored, and what each kind decodes to.
SQL_IMAGES = f"""{SQL_PX}, img as (select vec_id, label, px,
    case when label <= 6 then 8 when label = 7 then 4 end as height,
    case when label <= 4 then 1 when label <= 6 then 3 when label = 7 then 4 end as channels,
    case when label <= 4 or label = 7 then px
    when label <= 6 then flatten(list_transform(px, lambda p: [p, 255 - p, p // 2])) end as bytes,
    case when label = 8 then 'decode: damaged PNG image' when label = 9 and vec_id % 2 = 1 then 'fetch: InvalidURL'
    when label = 9 then 'fetch: ValueError' end as error
    from px)"""
# Resized to 4x4 with the widened triangle filter, normalised, channel first, single precision.
SQL_PIXELS = f"""{SQL_IMAGES},
    wt as (select i, j, w / sum(w) over (partition by i) as w from (select i, j,
    greatest(0.0, 1.0 - abs((j + 0.5) - (i + 0.5) * 2) / 2) as w
    from range(0, 4) a(i), range(0, 8) b(j))),
    flat as (select vec_id, label, unnest(px) as p, generate_subscripts(px, 1) - 1 as cell from img where label <= 6),
    chan as (select vec_id, c, cell // 8 as r, cell % 8 as s,
    case when label <= 4 or c = 0 then p when c = 1 then 255 - p else p // 2 end as v
    from flat, range(0, 3) x(c)),
    small as (select vec_id, c, rw.i as r, cw.i as s, sum(v * rw.w * cw.w) as v
    from chan join wt rw on rw.j = chan.r and rw.w > 0 join wt cw on cw.j = chan.s and cw.w > 0
    group by vec_id, c, rw.i, cw.i),
    pixels as (select vec_id, list(cast((v / 255 - list_value{IMAGE_MEAN}[c + 1]) / list_value{IMAGE_STD}[c + 1] as float)
    order by c, r, s) as pixel_values from small group by vec_id)"""


def bytes_of_vector(vector: str = "embedding") -> Column:
    return F.transform(vector, lambda x: F.floor((x.cast("double") + 1) * 127.5).cast("int"))


def stored_image(values: np.ndarray, label: int, number: int) -> bytes:
    """An image file; of label 8 one that is cut off, or whose header has a wrong length."""
    p = np.asarray(values, dtype=np.uint8)
    if label in (5, 6):
        return encode_png(np.stack([p, 255 - p, p // 2], axis=1).reshape(8, 8, 3))
    if label == 7:
        return encode_png(p.reshape(4, 4, 4))
    whole = encode_png(p.reshape(8, 8, 1))
    if label == 8 and number % 2:
        header = b"IHDR" + whole[16:28]
        return whole[:8] + struct.pack(">I", 12) + header + struct.pack(">I", zlib.crc32(header)) + whole[33:]
    return whole[:20] if label == 8 else whole


def vector_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, label, px, content, url``."""
    px = table(spark, sf_dir, "embeddings").select("vec_id", "label", bytes_of_vector().alias("px"))
    # Stored once: these stand for the image cells of an input table.
    stored = pin(map_rows(spread(px, ["vec_id"]), stored_image, "binary", "content", "px", "label", "vec_id"))
    url = F.concat(F.lit("data:image/png;base64,"), F.regexp_replace(F.base64("content"), r"\s", ""))
    bad = F.when(F.col("vec_id") % 2 == 1, F.lit("http://localhost/a name")).otherwise("data:broken")
    return stored.withColumn("url", F.when(F.col("label") == 9, bad).otherwise(url))


def bytes_text(data: Column | str) -> Column:
    """Image bytes as comma-separated numbers."""

    @F.pandas_udf("string")
    def show(cells: pd.Series) -> pd.Series:
        return cells.map(lambda c: None if c is None else ",".join(map(str, bytes(c))))

    return show(data)


def shown(df: DataFrame) -> DataFrame:
    return df.select(
        "vec_id",
        F.col("image.height").alias("height"),
        F.col("image.channels").alias("channels"),
        bytes_text(F.col("image.data")).alias("bytes"),
        "error",
    )


@query(f"with {SQL_IMAGES} select vec_id, label <> 9 as same, case when label = 9 then error end as error from img")
def fetch_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector_images(spark, sf_dir).withColumnRenamed("content", "original")
    fetched = images.fetch_stored(rows, "url", partitions=8)
    return fetched.select("vec_id", F.col("content").eqNullSafe(F.col("original")).alias("same"), "error")


@query(
    f"""with {SQL_IMAGES} select vec_id, case when label = 9 then 8 else height end as height,
    case when label = 9 then 1 else channels end as channels,
    {sql_text('case when label = 9 then px else bytes end')} as bytes,
    case when label = 8 then error end as error from img"""
)
def decode_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector_images(spark, sf_dir).select("vec_id", "content")
    return shown(images.decode_images(rows))


@query(
    f"""with {SQL_IMAGES} select vec_id, 'url' as kind, height, channels, {sql_text('bytes')} as bytes, error from img
    union all select vec_id, 'mixed', height, channels, {sql_text('bytes')}, error from img
    union all select vec_id, 'decoded', height, channels, {sql_text('bytes')},
    case when label >= 8 then 'no image' end from img"""
)
def image_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector_images(spark, sf_dir)
    from_url = images.load_images(rows.select("vec_id", F.col("url").alias("picture")), "picture")
    half = rows.select(
        "vec_id", F.when(F.col("label") <= 4, F.col("content")).alias("bytes_cell"), F.col("url").alias("picture")
    )
    mixed = images.load_mixed(half, "bytes_cell", "picture")
    ready = from_url.select("vec_id", F.col("image").alias("picture"))
    parts = {"url": from_url, "mixed": mixed, "decoded": images.load_images(ready, "picture")}
    result = None
    for kind, df in parts.items():
        part = shown(df).withColumn("kind", F.lit(kind))
        result = part if result is None else result.unionByName(part)
    return result


@query("select vec_id, label from embeddings where label <= 7")
def drop_bad_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector_images(spark, sf_dir).select("vec_id", "label", "url")
    return keep_complete(images.load_images(rows, "url"), ["image", "label"]).select("vec_id", "label")


@query(
    f"""with {SQL_PX} select vec_id, {sql_text('''case when label <= 6
    then flatten(list_transform(px, lambda p: [p, p, p])) else px end''')} as rgb from px"""
)
def gray_to_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = table(spark, sf_dir, "embeddings").select("vec_id", "label", bytes_of_vector().alias("px"))
    channels = F.when(F.col("label") <= 6, F.lit(1)).otherwise(F.lit(4))
    return px.select("vec_id", text_of(ops.gray_to_rgb(F.col("px"), channels)).alias("rgb"))


@query(
    f"""with {SQL_PIXELS} select vec_id, case when pixel_values is not null then 3 end as channels,
    case when pixel_values is not null then 4 end as height, {sql_micro('pixel_values')} as pixels
    from img left join pixels using (vec_id)"""
)
def image_to_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.when(F.col("label") != 9, F.col("content"))
    rows = vector_images(spark, sf_dir).select("vec_id", content.alias("content"))
    done = ops.to_pixels(images.decode_images(rows), PixelSpec(height=4, width=4))
    return done.select("vec_id", "channels", "height", micro_text("pixel_values").alias("pixels"))


SQL_NORMAL = f"""list_transform(flatten(list_transform(px, lambda p: [p, p, p])),
    lambda p, i: (p / 255.0 - list_value{IMAGE_MEAN}[(i - 1) % 3 + 1]) / list_value{IMAGE_STD}[(i - 1) % 3 + 1])"""


@query(f"with {SQL_PX} select vec_id, {sql_micro(SQL_NORMAL)} as pixels from px", name="normalise_pixels")
def normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rescaling and normalising as a column expression, without Python workers."""
    px = table(spark, sf_dir, "embeddings").select("vec_id", ops.gray_to_rgb(bytes_of_vector()).alias("rgb"))
    return px.select("vec_id", micro_text(ops.normalise(F.col("rgb"), PixelSpec())).alias("pixels"))


@query(
    f"""with {SQL_PIXELS} select vec_id, cast(len(pixel_values) as int) as size, {sql_micro('pixel_values')} as pixels,
    case when label = 7 then 'pixels: 4 channels' else error end as error from img left join pixels using (vec_id)"""
)
def image_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = ImageClassJob(key_column_name="vec_id", image_column_name="url", image_height=4, image_width=4)
    done = prepare(vector_images(spark, sf_dir).select("vec_id", "url"), job)
    size = F.when(F.col("pixel_values").isNotNull(), F.size("pixel_values"))
    return done.select("vec_id", size.alias("size"), micro_text("pixel_values").alias("pixels"), "error")


@query(
    f"""with {SQL_PX}, d as ({sql_hash_split('px', 'vec_id')}), b as ({sql_batches('d', 'vec_id', 8, sql_shards('d'))})
    select split, cast(shard as bigint) as shard, cast(batch_id as bigint) as batch_id, count(*) as row_count,
    8 as height, string_agg({sql_text('px')}, ',' order by pos) as pixels from b group by split, shard, batch_id"""
)
def stack_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from prepkit.operators.positions import shard_count
    from prepkit.operators.splits import split_hash

    rows = split_hash(table(spark, sf_dir, "embeddings"), "vec_id").select(
        "vec_id", "split", bytes_of_vector().alias("pixel_values"),
        F.lit(1).alias("channels"), F.lit(8).alias("height"), F.lit(8).alias("width"),
    )
    stacked = stack(assign_batches(rows, "vec_id", 8, shards=shard_count(rows, ROWS_PER_SHARD), seed=42))
    return stacked.select(
        "split",
        F.col("shard").cast("bigint"),
        "batch_id",
        F.col("rows").cast("bigint").alias("row_count"),
        "height",
        text_of("pixel_values").alias("pixels"),
    )
