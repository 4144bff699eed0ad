"""Training-sample array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipcurate.config import CONDITIONING_DROPOUT_PCT, IGNORED_LABEL


def prompt_tokens(tokens: Column, prompt_len: int) -> Column:
    return F.slice(tokens, 1, prompt_len)


def label_mask(tokens: Column, prompt_len: int) -> Column:
    """Labels for the loss: the prompt part is ignored."""
    return F.transform(
        tokens, lambda token, i: F.when(i < prompt_len, F.lit(IGNORED_LABEL)).otherwise(token)
    )


def append_stop(tokens: Column, stop_id: int) -> Column:
    return F.concat(tokens, F.array(F.lit(stop_id)))


def drops_conditioning(
    clip_id: Column, epoch: Column, percent: int = CONDITIONING_DROPOUT_PCT
) -> Column:
    """A repeatable draw per clip and epoch, so that a retried task drops the same samples."""
    key = F.concat_ws("#", clip_id.cast("string"), epoch.cast("string"))
    draw = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % 100
    return draw < percent


def zero_where(dropped: Column, values: Column, zero: Column) -> Column:
    return F.when(dropped, F.transform(values, lambda _: zero)).otherwise(values)


def within_limits(text_tokens: Column, speech_tokens: Column, max_text: int, max_speech: int) -> Column:
    return (F.size(text_tokens) <= max_text) & (F.size(speech_tokens) <= max_speech)
