"""Table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

AUDIO = T.StructType(
    [
        T.StructField("bytes", T.BinaryType()),
        T.StructField("sampling_rate", T.IntegerType()),
    ]
)

RAW_CLIP = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("audio", AUDIO),
        T.StructField("text", T.StringType()),
        T.StructField("language", T.StringType()),
    ]
)

CLEAN_CLIP = T.StructType(
    RAW_CLIP.fields
    + [
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("speaker_id", T.StringType()),
        T.StructField("cps", T.DoubleType()),
    ]
)

# One row per detected segment. A clip without speech, or one whose diarization failed, has one row
# with null bounds; `status` tells the two apart.
DIARIZATION = T.StructType(
    [
        T.StructField("clip_id", T.StringType()),
        T.StructField("start_us", T.LongType()),
        T.StructField("end_us", T.LongType()),
        T.StructField("speaker", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

# A verdict row is a ledger row: one write records both the decision and the manifest entry.
LEDGER = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("copies", T.LongType()),
        T.StructField("src_file", T.StringType()),
        T.StructField("src_row", T.LongType()),
        T.StructField("clean_text", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("cps", T.DoubleType()),
        T.StructField("run_id", T.StringType()),
    ]
)

# The partition column of a written ledger: one folder per run or micro-batch.
RUN_KEY = "run_key"
# Below it, rows are split by a hash of the id. Fixed values of the layout: the column and the number of buckets.
BUCKET = "bucket"
BUCKETS = 32
# While a run is at work, the rows of a bucket are dealt to this many tasks by a hash of the id. Not a column of the layout.
PART = "_part"

# Where a later copy of a recorded clip lies, and partial counts of what a run or micro-batch has recorded.
DUPLICATES = "language string, id string, src_file string, src_row long"
COUNTS = "run_key string, language string, verdict string, clips long, duration_ms long"
# The run folders that a compacted one stands for.
GENERATIONS = "generation string, run_key string"

MANIFEST_ENTRY = T.StructType(
    [
        T.StructField("wav_path", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("speaker", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("cps", T.DoubleType()),
    ]
)

# The counter names of a ledger document.
FUNNEL_COUNTERS = (
    "total",
    "lang_filtered",
    "text_cleaned",
    "cps_rejected",
    "duration_rejected",
    "multi_speaker_rejected",
    "kept",
)

LEDGER_DOCUMENT = T.StructType(
    [
        T.StructField("processed_ids", T.ArrayType(T.StringType())),
        T.StructField("metadata", T.ArrayType(MANIFEST_ENTRY)),
        T.StructField(
            "stats", T.StructType([T.StructField(name, T.LongType()) for name in FUNNEL_COUNTERS])
        ),
    ]
)

VOCABULARY_DOCUMENT = "model struct<vocab: map<string, int>>"

WAV_INFO = T.StructType(
    [
        T.StructField("frames", T.LongType()),
        T.StructField("header_rate", T.IntegerType()),
        T.StructField("channels", T.IntegerType()),
        T.StructField("sample_bits", T.IntegerType()),
        T.StructField("decode_error", T.StringType()),
    ]
)

GENERATION_LOG = T.StructType(
    [
        T.StructField("ref_name", T.StringType()),
        T.StructField("preset", T.StringType()),
        T.StructField("sample_no", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)
