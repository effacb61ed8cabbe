"""Pixel work: grey to RGB, resize, rescale, normalise, channel-first order."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.resize import resize
from prepkit.operators.maps import add_columns
from prepkit.sources.images import decode_cell, default_decoder, with_first_error

# The usual channel means and deviations for natural images.
IMAGE_MEAN = (0.485, 0.456, 0.406)
IMAGE_STD = (0.229, 0.224, 0.225)


@dataclass(frozen=True)
class PixelSpec:
    """Settings of the image processor."""

    height: int | None = None
    width: int | None = None
    resample: str = "bilinear"
    scale: float = 1 / 255
    mean: tuple[float, ...] = IMAGE_MEAN
    std: tuple[float, ...] = IMAGE_STD
    grey_to_rgb: bool = True

    def __post_init__(self) -> None:
        if self.resample not in ("nearest", "bilinear", "bicubic"):
            raise ValueError(f"unknown resample {self.resample!r}")
        if (self.height is None) != (self.width is None):
            raise ValueError("height and width belong together")

    def settings(self) -> dict:
        return asdict(self)


def gray_to_rgb(pixels: Column, channels: Column | int = 1) -> Column:
    """An array of grey values as RGB triples; arrays with more channels stay."""
    channels = F.lit(channels) if isinstance(channels, int) else channels
    return F.when(channels == 1, F.flatten(F.transform(pixels, lambda p: F.array(p, p, p)))).otherwise(pixels)


def normalise(pixels: Column, spec: PixelSpec) -> Column:
    """Rescale and normalise an array of interleaved channel values, keeping its order."""
    n = len(spec.mean)
    mean = F.array(*[F.lit(float(m)) for m in spec.mean])
    std = F.array(*[F.lit(float(s)) for s in spec.std])
    at = lambda i: i % n + 1
    return F.transform(
        pixels, lambda p, i: (p * F.lit(spec.scale) - F.element_at(mean, at(i))) / F.element_at(std, at(i))
    )


def image_array(image: dict | None) -> np.ndarray | None:
    """The pixels of a decoded image."""
    if image is None:
        return None
    return np.frombuffer(image["data"], dtype=np.uint8).reshape(image["height"], image["width"], image["channels"])


def pixel_problem(pixels: np.ndarray, spec: PixelSpec) -> str | None:
    """Why an image cannot become pixel values, or None."""
    channels = 3 if pixels.shape[2] == 1 and spec.grey_to_rgb else pixels.shape[2]
    return None if channels == len(spec.mean) else f"pixels: {pixels.shape[2]} channels"


def pixel_row(pixels: np.ndarray, spec: PixelSpec) -> tuple:
    """``(values, channels, height, width, error)`` of one image."""
    problem = pixel_problem(pixels, spec)
    if problem:
        return None, None, None, None, problem
    if pixels.shape[2] == 1 and spec.grey_to_rgb:
        pixels = np.repeat(pixels, 3, axis=2)
    if spec.height is not None:
        pixels = resize(pixels, spec.height, spec.width, spec.resample)
    values = (pixels * spec.scale - np.array(spec.mean)) / np.array(spec.std)
    planes = np.ascontiguousarray(values.transpose(2, 0, 1), dtype=np.float32)
    return planes.reshape(-1), *planes.shape, None


def to_pixels(
    df: DataFrame,
    spec: PixelSpec,
    image: str = "image",
    error: str = "error",
    decoder: Callable[[bytes], np.ndarray] | None = None,
) -> DataFrame:
    """Add ``pixel_values`` (flat, channel first) with ``channels, height, width``.

    ``image`` holds decoded images, or bytes that are decoded in the same pass. Images that cannot
    be read, or whose channels differ from the settings, get a null and an ``error``.
    """
    arrays = _arrays(df, image, decoder)

    def prepare(cells: Iterator[tuple]) -> Iterator[tuple]:
        for pixels, problem in arrays(cells):
            yield (None, None, None, None, problem) if pixels is None else pixel_row(pixels, spec)

    added = "pixel_values array<float>, channels int, height int, width int, __error string"
    return with_first_error(add_columns(df, [image], added, prepare), error)


def check_pixels(
    df: DataFrame,
    spec: PixelSpec,
    image: str = "image",
    error: str = "error",
    decoder: Callable[[bytes], np.ndarray] | None = None,
) -> DataFrame:
    """Add ``error`` where ``to_pixels`` would: images are decoded, but only their bytes go on."""
    arrays = _arrays(df, image, decoder)

    def check(cells: Iterator[tuple]) -> Iterator[tuple]:
        for pixels, problem in arrays(cells):
            yield (problem if pixels is None else pixel_problem(pixels, spec),)

    return with_first_error(add_columns(df, [image], "__error string", check), error)


def _arrays(df: DataFrame, image: str, decoder: Callable[[bytes], np.ndarray] | None):
    """A function from cells of ``image`` to pixels and problems."""
    stored = isinstance(df.schema[image].dataType, T.BinaryType)

    def arrays(cells: Iterator[tuple]) -> Iterator[tuple]:
        read = decoder or default_decoder()
        for (cell,) in cells:
            if stored:
                yield decode_cell(cell, read)
            else:
                yield image_array(cell), "no image" if cell is None else None

    return arrays
