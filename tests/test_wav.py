import io
import struct
import wave

import pytest
from pyspark.sql import functions as F

from clipcurate.schemas import AUDIO
from clipcurate.sinks.wav import as_16_bit, export_wavs
from clipcurate.sources import wav as source
from clipcurate.sources.wav import HEAD_BYTES, HEADS, wav_info, with_wav_info


def wav(frames=100, channels=1, width=2, rate=24000):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(b"\x01" * frames * channels * width)
    return out.getvalue()


def with_chunk(data, body):
    """The same file with a chunk of `body` before its samples."""
    extra = b"LIST" + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)
    return data[:36] + extra + data[36:]


CASES = {
    "mono": (wav(), (100, 24000, 1, 16, None)),
    "stereo": (wav(channels=2, rate=8000), (100, 8000, 2, 16, None)),
    "bits8": (wav(width=1), (100, 24000, 1, 8, None)),
    "bits24": (wav(width=3), (100, 24000, 1, 24, None)),
    "no_frames": (wav(frames=0), (0, 24000, 1, 16, None)),
    "odd_chunk": (with_chunk(wav(), b"abc"), (100, 24000, 1, 16, None)),
    "late_data": (with_chunk(wav(), b"z" * (HEAD_BYTES * 3 + 1)), (100, 24000, 1, 16, None)),
    "truncated": (wav()[:-51], (74, 24000, 1, 16, None)),
    "header_only": (wav()[:30], (None, None, None, None, "no audio data")),
    "text": (b"not audio at all", (None, None, None, None, "not a WAV file")),
    "empty": (b"", (None, None, None, None, "not a WAV file")),
    "null": (None, (None, None, None, None, "not a WAV file")),
    "codec": (
        wav()[:20] + struct.pack("<H", 85) + wav()[22:],
        (None, None, None, None, "unsupported sample format"),
    ),
}


def test_wav_info_in_spark(spark):
    rows = [(name, (data, 24000)) for name, (data, _) in CASES.items()]
    df = spark.createDataFrame(rows, f"id string, audio {AUDIO.simpleString()}")
    got = {r.id: tuple(r)[2:] for r in with_wav_info(df).collect()}
    assert got == {name: want for name, (_, want) in CASES.items()}


def test_long_chunks_are_stepped_over_and_not_sent(spark):
    files = {}
    for chunks in (0, 1, 5, HEADS + 3):
        data = wav(frames=HEAD_BYTES)
        for _ in range(chunks):
            data = with_chunk(data, b"z" * (HEAD_BYTES * 2 + 1))
        files[f"{chunks}"] = data
        files[f"{chunks} cut"] = data[:-HEAD_BYTES]
        files[f"{chunks} cut in a chunk"] = data[: len(data) - HEAD_BYTES * 2 - 10]
        files[f"{chunks} odd"] = data.replace(b"fmt ", b"fmt_")
        files[f"{chunks} short"] = data.replace(b"fmt \x10", b"fmt \x0f")
        files[f"{chunks} codec"] = data[:20] + struct.pack("<H", 85) + data[22:]
    df = spark.createDataFrame([(n, (d, 24000)) for n, d in files.items()], f"id string, audio {AUDIO.simpleString()}")
    got = {r.id: tuple(r)[2:] for r in with_wav_info(df).collect()}
    assert got == {n: wav_info(d, len(d)) for n, d in files.items()}
    places = source._chunk_places(F.col("audio.bytes"), F.octet_length("audio.bytes"))
    assert df.where("id = '5'").select(F.size(places)).first()[0] == 7
    assert df.where(f"id = '{HEADS + 3}'").select(F.size(places)).first()[0] == HEADS + 1


def test_header_at_every_cut_is_never_misread():
    data = with_chunk(wav(), b"q" * 40)
    for cut in range(len(data)):
        info = wav_info(data[:cut], len(data))
        assert info[4] is not None or info[0] == 100


def test_export(spark, tmp_path):
    rows = [
        ("a", "gu", (wav(), 24000)), ("b", "gu", (wav(width=1), 24000)), ("../c", "gu", (wav(), 24000)),
        ("d", "gu", (b"zzz", 24000)), ("e", "hi", (wav(), 24000)),
    ]
    df = spark.createDataFrame(rows, f"id string, language string, audio {AUDIO.simpleString()}")
    for _ in range(2):
        done = {r.id: r.status for r in export_wavs(df, str(tmp_path), "gu").collect()}
    assert done == {"a": "written", "b": "written", "../c": "bad id", "d": "not a WAV file"}
    assert sorted(p.name for p in (tmp_path / "gu" / "wavs").iterdir()) == ["a.wav", "b.wav"]
    assert (tmp_path / "gu" / "wavs" / "a.wav").read_bytes() == wav()


@pytest.mark.parametrize("rate", [8000, 48000])
def test_duration_uses_the_rate_column(spark, rate):
    from pyspark.sql import functions as F

    from clipcurate.operators.verdict import with_measures

    df = spark.createDataFrame(
        [("a", "some text", (wav(frames=rate), 24000))], f"id string, text string, audio {AUDIO.simpleString()}"
    )
    clips = with_wav_info(df).withColumn("sampling_rate", F.col("audio.sampling_rate"))
    assert with_measures(clips).first().duration == rate / 24000


def riff(tag, bits, samples, channels=1, rate=8000, extension=b""):
    frame = channels * bits // 8
    fmt = struct.pack("<HHIIHH", tag, channels, rate, rate * frame, frame, bits) + extension
    chunks = b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(samples)) + samples
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


# Tag, bits, samples and what they are at 16 bits.
SAMPLES = {
    "8": (1, 8, bytes([0, 128, 255]), [-32768, 0, 32512]),
    "24": (1, 24, b"\x00\x00\x80" b"\x80\x01\x00" b"\xff\xff\x7f", [-32768, 2, 32767]),
    "32": (1, 32, struct.pack("<3i", -(1 << 31), 98304, (1 << 31) - 1), [-32768, 2, 32767]),
    "float": (3, 32, struct.pack("<5f", -1.0, 0.5, 1.0, 9e37, float("nan")), [-32768, 16384, 32767, 32767, 0]),
    "double": (3, 64, struct.pack("<2d", -0.25, float("inf")), [-8192, 32767]),
}


@pytest.mark.parametrize("name", sorted(SAMPLES))
def test_other_samples_become_16_bit(name):
    tag, bits, samples, want = SAMPLES[name]
    extension = struct.pack("<HHIH", 22, bits, 0, tag) + b"\0" * 14
    for data in (riff(tag, bits, samples), riff(0xFFFE, bits, samples, extension=extension)):
        with wave.open(io.BytesIO(as_16_bit(data, None))) as w:
            assert (w.getsampwidth(), w.getframerate(), w.getnchannels()) == (2, 8000, 1)
            assert list(struct.unpack(f"<{len(want)}h", w.readframes(99))) == want


def test_the_rate_of_the_clip_counts():
    data = wav(frames=5, channels=2, rate=8000)
    assert as_16_bit(data, 8000) is data
    with wave.open(io.BytesIO(as_16_bit(data, 24000))) as w:
        assert (w.getframerate(), w.getnchannels(), w.readframes(9)) == (24000, 2, b"\x01" * 20)
    assert as_16_bit(riff(1, 12, b"\0" * 6), 8000) is None
