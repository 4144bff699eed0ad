"""Export of clips as WAV files."""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from clipcurate.functions.names import WAV_FOLDER, WAV_SUFFIX
from clipcurate.sources.wav import IEEE_FLOAT, PCM, wav_info, wav_samples

EXPORT = "id string, path string, n_bytes long, status string"


def _to_16_bit(tag: int, bits: int, samples: bytes) -> np.ndarray | None:
    """Samples at 16 bits, rounded to even and clipped; what is not a number becomes silence. None: unknown format."""
    if tag == PCM and bits == 16:
        return np.frombuffer(samples, "<i2")
    if tag == PCM and bits == 8:
        return ((np.frombuffer(samples, "u1").astype("i2") - 128) << 8).astype("<i2")
    if tag == PCM and bits == 24:
        wide = np.zeros((len(samples) // 3, 4), "u1")
        wide[:, 1:] = np.frombuffer(samples, "u1").reshape(-1, 3)
        values = wide.view("<i4").ravel() / 65536.0
    elif tag == PCM and bits == 32:
        values = np.frombuffer(samples, "<i4") / 65536.0
    elif tag == IEEE_FLOAT and bits in (32, 64):
        # Clipped before it is scaled, so that nothing overflows.
        values = np.clip(np.frombuffer(samples, f"<f{bits // 8}"), -2.0, 2.0).astype("f8") * 32768.0
    else:
        return None
    return np.clip(np.rint(np.nan_to_num(values)), -32768, 32767).astype("<i2")


def as_16_bit(data: bytes, rate: int | None) -> bytes | None:
    """A WAV file with 16-bit samples at the clip's rate. A file that is one already is given back as it came.

    `rate` is the clip's own, which counts where the header says something else; None leaves the header's.
    """
    _, header_rate, channels, *_ = wav_info(data, len(data))
    tag, _, bits, samples = wav_samples(data)
    if tag == PCM and bits == 16 and rate in (None, header_rate):
        return data
    values = _to_16_bit(tag, bits, samples)
    if values is None:
        return None
    rate = header_rate if rate is None else rate
    body = values.tobytes()
    head = struct.pack("<HHIIHH", PCM, channels, rate, rate * channels * 2, channels * 2, 16)
    return b"".join(
        [b"RIFF", struct.pack("<I", 36 + len(body)), b"WAVEfmt ", struct.pack("<I", 16), head, b"data", struct.pack("<I", len(body)), body]
    )


def _store(folder: str, clip_id: str, data: bytes, rate: int | None) -> tuple:
    """Write one file by rename, so that a repeated or lost task leaves whole files only."""
    if not clip_id or "/" in clip_id or "\0" in clip_id:
        return clip_id, None, 0, "bad id"
    *_, error = wav_info(data, len(data or b""))
    file = None if error else as_16_bit(data, rate)
    if file is None:
        return clip_id, None, 0, error or "unsupported sample format"
    path = os.path.join(folder, clip_id + WAV_SUFFIX)
    part = os.path.join(folder, f".{uuid.uuid4().hex}")
    with open(part, "wb") as f:
        f.write(file)
    os.replace(part, path)
    return clip_id, path, len(file), "written"


def mounted_folder(root: str) -> str:
    """The absolute local path of a folder given bare or as a `file:` URI."""
    scheme, colon, rest = root.partition(":")
    if colon and "/" not in scheme:
        if scheme != "file":
            raise ValueError(f"WAV files are written to mounted folders, not to {scheme}:")
        root = "/" + unquote(rest).lstrip("/")
    return os.path.abspath(root)


def wav_folder(root: str, language: str) -> str:
    return os.path.join(mounted_folder(root), language, WAV_FOLDER.rstrip("/"))


def export_wavs(clips: DataFrame, root: str, language: str) -> DataFrame:
    """Write clips as 16-bit files to `root/language/wavs/{id}.wav` and return what was written.

    Clips of other sample sizes are converted, and a header with another rate than the clip's is replaced.
    `root` has to be a mounted folder that every executor shares, bare or with the scheme `file:`; other schemes are
    refused before anything runs. Nothing happens until the result is used.
    """
    folder = wav_folder(root, language)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            rates = [None if pd.isna(r) else int(r) for r in batch["rate"]]
            rows = [_store(folder, i, b, r) for i, b, r in zip(batch["id"], batch["bytes"], rates)]
            yield pd.DataFrame(rows, columns=["id", "path", "n_bytes", "status"])

    return (
        clips.where(clips["language"] == language)
        .select("id", clips["audio"]["bytes"].alias("bytes"), clips["audio"]["sampling_rate"].alias("rate"))
        .mapInPandas(run, EXPORT)
    )
