"""Functions on images' sizes and bytes."""

from __future__ import annotations

import base64
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The least short side, the largest long side.
SHORT, LONG = 32, 2048


def scale(width: Column, height: Column) -> Column:
    """1 unless the long side is over LONG (then it shrinks to it) or the short side under SHORT (then it grows to it). Shrinking wins."""
    short, long_ = F.least(width, height), F.greatest(width, height)
    return F.when(long_ > LONG, F.lit(float(LONG)) / long_).when(short < SHORT, F.lit(float(SHORT)) / short).otherwise(1.0)


def scaled(side: Column, factor: Column) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.ceil(side * factor).cast("long"))


def data_url(data: Column, kind: str = "image/jpeg") -> Column:
    """One line: Spark's base64 may break its lines."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.translate(F.base64(data), "\r\n", ""))


def usable(width: Column, height: Column, least: int = SHORT, ratio: float = 8.0) -> Column:
    """Readable (positive sides), not too small, not too long for its width."""
    short, long_ = F.least(width, height), F.greatest(width, height)
    return F.coalesce((short >= least) & (long_ <= short * F.lit(ratio)), F.lit(False))


def sharpness(images: DataFrame) -> DataFrame:
    """images of Spark's image source with spread (variance of grey values; near 0: blank) and edges (variance of the Laplacian; low: blurry)."""
    @F.pandas_udf("spread double, edges double")
    def measure(h: pd.Series, w: pd.Series, ch: pd.Series, data: pd.Series) -> pd.DataFrame:
        out = []
        for a, b, c, x in zip(h, w, ch, data, strict=True):
            if a is None or a <= 0 or b <= 0 or x is None or len(x) != a * b * c:
                out.append((None, None))
                continue
            g = np.frombuffer(x, np.uint8).reshape(a, b, c).astype(float)[..., : min(c, 3)].mean(2)
            edge = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1] if a > 2 and b > 2 else np.zeros(1)
            out.append((float(g.var()), float(edge.var())))
        return pd.DataFrame(out, columns=["spread", "edges"])

    m = measure("image.height", "image.width", "image.nChannels", "image.data")
    return images.withColumn("m", m).select(*images.columns, "m.spread", "m.edges")


def difference_hash(images: DataFrame) -> DataFrame:
    """images with dhash: 64 bits of brighter-than-right-neighbour over a 9 x 8 reduction."""
    @F.pandas_udf("long")
    def hashed(h: pd.Series, w: pd.Series, ch: pd.Series, data: pd.Series) -> pd.Series:
        out = []
        for a, b, c, x in zip(h, w, ch, data, strict=True):
            if a is None or a <= 0 or b <= 0 or x is None or len(x) != a * b * c:
                out.append(None)
                continue
            g = np.frombuffer(x, np.uint8).reshape(a, b, c).astype(float).mean(2)
            small = g[np.ix_((np.arange(8) * a) // 8, (np.arange(9) * b) // 9)]
            out.append(int(np.packbits(small[:, :-1] > small[:, 1:]).view(">i8")[0]))
        return pd.Series(out, dtype="Int64")

    return images.withColumn("dhash", hashed("image.height", "image.width", "image.nChannels", "image.data"))


def exif_turn(head: bytes | None) -> int:
    """The orientation (1 to 8) in a JPEG's Exif block; 1 where there is none."""
    at = (head or b"").find(b"Exif\0\0")
    if at < 0:
        return 1
    t = head[at + 6 :]
    order = {b"II": "<", b"MM": ">"}.get(t[:2])
    try:
        (first,) = struct.unpack_from(f"{order}I", t, 4)
        (n,) = struct.unpack_from(f"{order}H", t, first)
        for i in range(n):
            tag, kind, _, value = struct.unpack_from(f"{order}HHIH", t, first + 2 + 12 * i)
            if (tag, kind) == (0x0112, 3) and 1 <= value <= 8:
                return value
    except struct.error:  # cut short, or no such order of bytes
        pass
    return 1


def orientations(files: DataFrame) -> DataFrame:
    """origin and orientation of files (path, content) of Spark's binaryFile source; only their first 64 kB go to Python."""

    @F.pandas_udf("int")
    def turn(head: pd.Series) -> pd.Series:
        return head.map(exif_turn)

    return files.select(F.col("path").alias("origin"), turn(F.substring("content", 1, 1 << 16)).alias("orientation"))


def upright(x: np.ndarray, turn: int) -> np.ndarray:
    """Pixels (rows, columns, channels) turned and mirrored as the orientation says."""
    if turn in (5, 6, 7, 8):
        x = x.transpose(1, 0, 2)
    if turn in (3, 4, 7, 8):
        x = x[::-1]
    return x[:, ::-1] if turn in (2, 3, 6, 7) else x


def resized(x: np.ndarray, n: int) -> np.ndarray:
    """x with n rows, by cubic interpolation whose reach grows as rows shrink."""
    wide = max(1.0, len(x) / n)
    middle = (np.arange(n) + 0.5) * len(x) / n
    first = np.floor(middle - 2 * wide).astype(int)
    at = first[:, None] + np.arange(int(np.ceil(4 * wide)) + 1)
    d = np.abs((at + 0.5 - middle[:, None]) / wide)
    w = np.where(d < 1, 1.5 * d**3 - 2.5 * d**2 + 1, np.where(d < 2, -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2, 0.0))
    w *= (at >= 0) & (at < len(x))
    w /= w.sum(1, keepdims=True)
    out = np.zeros((n, *x.shape[1:]))
    for k in range(at.shape[1]):
        out += w[:, k].reshape(-1, *[1] * (x.ndim - 1)) * x[np.clip(at[:, k], 0, len(x) - 1)]
    return out


def png(x: np.ndarray) -> bytes:
    """An RGB image, without loss."""
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    rows = np.concatenate([np.zeros((len(x), 1), np.uint8), x.reshape(len(x), -1)], axis=1)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", x.shape[1], x.shape[0], 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def model_url(images: DataFrame) -> DataFrame:
    """images of Spark's image source with url, what a model is sent: upright (by a column orientation, if there), RGB, its sides within bounds, as a data URL. Null where an image can't be read.

    PNG stands in for JPEG: it needs no library, and servers take both.
    """

    @F.pandas_udf("string")
    def made(h: pd.Series, w: pd.Series, ch: pd.Series, data: pd.Series, turn: pd.Series) -> pd.Series:
        out = []
        for a, b, c, x, t in zip(h, w, ch, data, turn, strict=True):
            if a is None or a <= 0 or b <= 0 or x is None or len(x) != a * b * c:
                out.append(None)
                continue
            g = np.frombuffer(x, np.uint8).reshape(a, b, c)
            g = upright(g[..., 2::-1] if c >= 3 else np.repeat(g[..., :1], 3, axis=2), t)
            short, long_ = min(a, b), max(a, b)
            f = LONG / long_ if long_ > LONG else SHORT / short if short < SHORT else 1.0
            if f != 1.0:
                rows, columns = (max(1, int(np.ceil(n * f))) for n in g.shape[:2])
                g = resized(resized(g.astype(float), rows).transpose(1, 0, 2), columns).transpose(1, 0, 2)
                g = np.clip(np.rint(g), 0, 255).astype(np.uint8)
            out.append("data:image/png;base64," + base64.b64encode(png(np.ascontiguousarray(g))).decode())
        return pd.Series(out, dtype=object)

    turn = F.coalesce("orientation", F.lit(1)) if "orientation" in images.columns else F.lit(1)
    return images.withColumn("url", made("image.height", "image.width", "image.nChannels", "image.data", turn))
