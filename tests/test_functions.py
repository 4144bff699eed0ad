import sys

import pytest
from pyspark.sql import functions as F

from clipcurate.functions import arrays, audio, names, text


def values(df):
    return [r[0] for r in df.collect()]


def column(spark, items, kind="string"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")


def ordered(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_whitespace_is_what_python_splits_on(spark):
    points = [c for c in range(0x3100) if c != 0 and not 0xD800 <= c <= 0xDFFF]
    df = column(spark, [f"a{chr(c)}b" for c in points])
    got = ordered(df, text.clean_text(F.col("x")))
    for c, out in zip(points, got):
        raw = f"a{chr(c)}b".replace(">", "").replace("|", " ")
        assert out == " ".join(raw.split()), hex(c)


def test_whitespace_is_the_python_set():
    assert set(text.WHITESPACE) == {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}


@pytest.mark.parametrize(
    "raw, want",
    [
        ("  a > b | c\u00a0\u3000d\x1c ", "a b c d"),
        (">|>", ""),
        ("|a", "a"),
        ("\u0a95\u0ac7\u0aae  \u0a9b\u0acb ?", "\u0a95\u0ac7\u0aae \u0a9b\u0acb ?"),
        ("\U0001f600>\U0001f600", "\U0001f600\U0001f600"),
    ],
)
def test_clean_text(spark, raw, want):
    assert ordered(column(spark, [raw]), text.clean_text(F.col("x"))) == [want]


def test_null_text_stays_null(spark):
    assert ordered(column(spark, [None]), text.clean_text(F.col("x"))) == [None]


def test_lengths_are_code_points(spark):
    sample = "\u0a95\u0ac7\u0aae \u0928\u092e \U0001f600"
    df = column(spark, [sample])
    assert ordered(df, F.length("x")) == [len(sample)]
    assert ordered(df, text.characters(F.col("x"))) == [list(sample)]
    assert ordered(df, text.preview(F.col("x"), 8)) == [sample[:8]]


def test_script_selection(spark):
    df = column(spark, ["a\u0a7f\u0a80\u0aff\u0b00z", ""])
    assert ordered(df, text.only_script(F.col("x"))) == ["\u0a80\u0aff", ""]
    assert ordered(df, text.in_script(F.lit("\u0a95"))) == [True, True]


def test_length_bands(spark):
    words = [1, 4, 5, 15, 16, 30, 31]
    df = column(spark, [" ".join("w" * n) for n in words])
    got = ordered(df, text.length_band(text.word_count(F.col("x"))))
    assert got == ["poor", "poor", "decent", "decent", "good", "good", "good_with_artifacts"]
    assert ordered(column(spark, [" > "]), text.word_count(F.col("x"))) == [0]


def test_duration_and_rate(spark):
    df = spark.createDataFrame(
        [(0, 48000, 24000), (1, 1, 3), (2, 0, 24000), (3, None, 24000), (4, 10, 0), (5, 5, 10000)],
        "i int, frames long, rate int",
    )
    frames, rate = F.col("frames"), F.col("rate")
    assert ordered(df, audio.duration_seconds(frames, rate)) == [2.0, 1 / 3, 0.0, None, None, 0.0005]
    assert ordered(df, audio.duration_ms(frames, rate)) == [2000, 333, 0, None, None, 1]
    cps = audio.chars_per_second(F.lit("abcd"), audio.duration_seconds(frames, rate))
    assert ordered(df, cps)[:3] == [2.0, 4 / (1 / 3), 0.0]


def test_seconds_text_is_what_python_prints(spark):
    ms = [0, 1, 10, 120, 999, 1000, 2500, 3190, 14000, 20000, 123456]
    df = column(spark, ms, "long")
    assert ordered(df, names.seconds_text(F.col("x"))) == [repr(m / 1000) for m in ms]


def test_path_stem(spark):
    from pathlib import PurePosixPath

    paths = ["wavs/a.wav", "a.b.wav", "/x/y/z", "x/.hidden", "x/no.ext.d/f.flac", "plain"]
    got = ordered(column(spark, paths), names.path_stem(F.col("x")))
    assert got == [PurePosixPath(p).stem for p in paths]


def test_sample_numbers_are_never_cut(spark):
    df = column(spark, [1, 42, 999, 1000, 123456], "long")
    got = ordered(df, names.sample_file(F.lit("v"), F.col("x")))
    assert got == [f"v_sample_{n:03d}.wav" for n in (1, 42, 999, 1000, 123456)]


def test_manifest_lines(spark):
    df = spark.createDataFrame(
        [(0, "wavs/1.wav", 'say "hi", now', 2500), (1, 'wavs/a,"b.wav', '"all quoted"', 2000)],
        "i int, path string, t string, ms long",
    )
    csv = names.csv_line(F.col("path"), F.col("t"), F.col("ms"))
    assert ordered(df, csv) == [
        'wavs/1.wav,"say ""hi"", now",2.5',
        '"wavs/a,""b.wav","""all quoted""",2.0',
    ]
    assert ordered(df, names.pipe_line(F.col("path"), F.col("t")))[1] == (
        'wavs/a,"b.wav|all quoted|all quoted'
    )
    assert ordered(df, names.pipe_line(F.col("path"), F.col("t"), False))[1] == (
        'wavs/a,"b.wav|"all quoted"|"all quoted"'
    )
    assert ordered(df, names.default_speaker(F.lit("gu"))) == ["spk_hf_gu"] * 2


def test_arrays(spark):
    df = spark.createDataFrame([(0, [5, 6, 7]), (1, [])], "i int, x array<int>")
    x = F.col("x")
    assert ordered(df, arrays.prompt_tokens(x, 2)) == [[5, 6], []]
    assert ordered(df, arrays.label_mask(x, 2)) == [[-100, -100, 7], []]
    assert ordered(df, arrays.append_stop(x, 9)) == [[5, 6, 7, 9], [9]]


def test_dropout_is_repeatable_and_near_its_rate(spark):
    ids = spark.range(5000)
    draw = arrays.drops_conditioning(F.col("id"), F.lit(1))
    first = [r[0] for r in ids.orderBy("id").select(draw).collect()]
    again = [r[0] for r in ids.repartition(7).orderBy("id").select(draw).collect()]
    other = [r[0] for r in ids.orderBy("id").select(arrays.drops_conditioning(F.col("id"), F.lit(2))).collect()]
    assert first == again and first != other
    assert 0.17 < sum(first) / 5000 < 0.23
