"""Training-sample layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcurate.config import CONDITIONING_DROPOUT_PCT, MAX_SPEECH_TOKENS, MAX_TEXT_TOKENS
from clipcurate.functions import arrays


def limit_lengths(
    samples: DataFrame,
    max_text: int = MAX_TEXT_TOKENS,
    max_speech: int = MAX_SPEECH_TOKENS,
    cut: bool = False,
) -> DataFrame:
    """Drop samples over a limit, or cut them to it."""
    if cut:
        return samples.withColumn("text_tokens", F.slice("text_tokens", 1, max_text)).withColumn(
            "speech_tokens", F.slice("speech_tokens", 1, max_speech)
        )
    return samples.where(
        arrays.within_limits(F.col("text_tokens"), F.col("speech_tokens"), max_text, max_speech)
    )


def over_limit_counts(
    samples: DataFrame,
    max_text: int = MAX_TEXT_TOKENS,
    max_speech: int = MAX_SPEECH_TOKENS,
) -> DataFrame:
    text, speech = F.size("text_tokens") > max_text, F.size("speech_tokens") > max_speech
    return samples.groupBy("language").agg(
        F.count_if(text).alias("text_over"),
        F.count_if(speech).alias("speech_over"),
        F.count_if(~text & ~speech).alias("within"),
    )


def layout(samples: DataFrame, prompt_len: int, stop_id: int) -> DataFrame:
    """Add prompt tokens, the target with its stop token, and the labels of the target."""
    speech = F.col("speech_tokens")
    target = arrays.append_stop(speech, stop_id)
    return (
        samples.withColumn("prompt_tokens", arrays.prompt_tokens(speech, prompt_len))
        .withColumn("target_tokens", target)
        .withColumn("labels", arrays.label_mask(F.col("target_tokens"), prompt_len))
    )


def drop_conditioning(
    samples: DataFrame, epoch: int, percent: int = CONDITIONING_DROPOUT_PCT
) -> DataFrame:
    """Zero the speaker vector and the prompt of the drawn samples."""
    dropped = arrays.drops_conditioning(F.col("id"), F.lit(epoch), percent)
    return (
        samples.withColumn("cond_dropped", dropped)
        .withColumn(
            "prompt_tokens",
            arrays.zero_where(F.col("cond_dropped"), F.col("prompt_tokens"), F.lit(0)),
        )
        .withColumn(
            "speaker_emb",
            arrays.zero_where(
                F.col("cond_dropped"), F.col("speaker_emb"), F.lit(0.0).cast("float")
            ),
        )
    )
