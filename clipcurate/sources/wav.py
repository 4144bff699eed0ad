"""Frame counts of embedded WAV audio, from chunk headers only."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcurate.schemas import WAV_INFO

# Files whose data chunk starts within so many bytes send these to Python. Of others only the heads of their chunks go,
# unless there are more than HEADS of them.
HEAD_BYTES = 4096
HEADS = 64

# Format tags of linear PCM, IEEE float and the extensible header.
PCM, IEEE_FLOAT, _EXTENSIBLE = 1, 3, 0xFFFE
_SAMPLE_FORMATS = (PCM, IEEE_FLOAT, _EXTENSIBLE)
_NEEDS_MORE = "needs more bytes"


def wav_info(head: bytes | None, size: int) -> tuple:
    """`(frames, rate, channels, bits, error)` from the leading bytes of a file of `size` bytes."""
    if head is None or len(head) < 12 or head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        return None, None, None, None, "not a WAV file"
    at, fmt = 12, None
    while at + 8 <= size:
        if at + 8 > len(head):
            return None, None, None, None, _NEEDS_MORE
        name, length = head[at : at + 4], struct.unpack_from("<I", head, at + 4)[0]
        body = at + 8
        if name == b"fmt ":
            if length < 16 or body + 16 > size:
                break
            if body + 16 > len(head):
                return None, None, None, None, _NEEDS_MORE
            fmt = struct.unpack_from("<HHIIHH", head, body)
        elif name == b"data":
            if fmt is None or fmt[0] not in _SAMPLE_FORMATS or fmt[4] == 0:
                return None, None, None, None, "unsupported sample format"
            # A truncated file holds fewer bytes than its header says.
            return min(length, size - body) // fmt[4], fmt[2], fmt[1], fmt[5], None
        at = body + length + length % 2
    return None, None, None, None, "no audio data"


def wav_samples(data: bytes) -> tuple[int, int, int, bytes]:
    """`(format tag, channels, bits, samples)` of a whole file that `wav_info` finds no error in.

    An extensible header names the true format in its extension; the samples end with the last whole frame.
    """
    at, tag, channels, bits, frame = 12, 0, 0, 0, 0
    while data[at : at + 4] != b"data":
        length = struct.unpack_from("<I", data, at + 4)[0]
        if data[at : at + 4] == b"fmt ":
            tag, channels, _, _, frame, bits = struct.unpack_from("<HHIIHH", data, at + 8)
            if tag == _EXTENSIBLE and length >= 26:
                tag = struct.unpack_from("<H", data, at + 32)[0]
        at += 8 + length + length % 2
    end = min(at + 8 + struct.unpack_from("<I", data, at + 4)[0], len(data))
    return tag, channels, bits, data[at + 8 : end - (end - at - 8) % frame]


def folded_info(heads: bytes, size: int, places: list[int]) -> tuple:
    """`wav_info` of a file given as its first 12 bytes and 24 bytes, or what there is of them, of each chunk at `places`."""
    fmt = None
    for i, at in enumerate(places):
        head = heads[12 + 24 * i : 36 + 24 * i]
        if head[:4] == b"fmt ":
            if len(head) < 24 or struct.unpack_from("<I", head, 4)[0] < 16:
                break
            fmt = head
        elif head[:4] == b"data":
            start = 12 if fmt is None else 36
            length = struct.unpack_from("<I", head, 4)[0]
            # The same file without what lies between format and samples.
            front = heads[:12] + (b"" if fmt is None else fmt[:4] + struct.pack("<I", 16) + fmt[8:24]) + head[:8]
            return wav_info(front, start + 8 + min(length, size - at - 8))
    return None, None, None, None, "no audio data"


@F.pandas_udf(WAV_INFO)
def _wav_info(head: pd.Series, size: pd.Series, places: pd.Series) -> pd.DataFrame:
    rows = [
        wav_info(h, 0 if pd.isna(s) else int(s)) if p is None else folded_info(h, int(s), [int(x) for x in p])
        for h, s, p in zip(head, size, places)
    ]
    info = pd.DataFrame(rows, columns=WAV_INFO.fieldNames(), dtype=object)
    for name in ("frames", "header_rate", "channels", "sample_bits"):
        info[name] = info[name].astype("Int64")
    return info


def _chunk_places(data: Column, size: Column) -> Column:
    """Where the chunks of a file begin, up to its samples; more than `HEADS` places if there are more chunks."""

    def step(at: Column, _) -> Column:
        last = F.element_at(at, -1)
        name = F.substring(data, last.cast("int") + 1, F.lit(4))
        digits = F.hex(F.substring(data, last.cast("int") + 5, F.lit(4)))
        length = F.conv(F.concat(*[F.substring(digits, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("long")
        after = last + 8 + length + length % 2
        ended = (name == F.lit(b"data")) | (after + 8 > size)
        return F.when(ended, at).otherwise(F.concat(at, F.array(after)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(HEADS)), F.array(F.lit(12).cast("long")), step)


def with_wav_info(clips: DataFrame, audio: Column | str = "audio.bytes") -> DataFrame:
    """Add `frames`, `header_rate`, `channels`, `sample_bits` and `decode_error`.

    A file larger than `HEAD_BYTES` sends the heads of its chunks to Python and no samples.

    Durations are to be taken from `frames` and the rate column of the clip, not the header's rate.
    """
    data = F.col(audio) if isinstance(audio, str) else audio
    size = F.octet_length(data)
    wave = (F.substring(data, 1, 4) == F.lit(b"RIFF")) & (F.substring(data, 9, 4) == F.lit(b"WAVE"))
    large = F.coalesce((size > HEAD_BYTES) & wave, F.lit(False))
    looked = clips.withColumn("_places", F.when(large, _chunk_places(data, size)))
    heads = F.aggregate(
        F.col("_places"),
        F.substring(data, 1, 12),
        lambda heads, at: F.concat(heads, F.substring(data, at.cast("int") + 1, F.lit(24))),
    )
    many = F.size("_places") > HEADS
    head = F.when(~large, data).when(many, data).otherwise(heads)
    info = _wav_info(head, size, F.when(~many, F.col("_places")))
    return looked.withColumn("_info", info).select(*clips.columns, "_info.*")
