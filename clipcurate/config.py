"""Settings of a curation run."""

from __future__ import annotations

from dataclasses import dataclass

# The bounds, sizes and labels that published clip sets were made with.
MIN_DURATION_S = 2.0
MAX_DURATION_S = 20.0
MIN_CPS = 4.0
MAX_CPS = 25.0
MIN_TEXT_CHARS = 2
SHARD_ROWS = 300
SPEAKER_PREFIX = "spk_hf_"
PROMPT_SECONDS = 3.0
MAX_TEXT_TOKENS = 256
MAX_SPEECH_TOKENS = 850
REFERENCE_MIN_S = 7
REFERENCE_MAX_S = 10
IGNORED_LABEL = -100
CONDITIONING_DROPOUT_PCT = 20
BATCH_SIZE = 4
GRADIENT_ACCUMULATION = 8
EPOCHS = 10


@dataclass(frozen=True)
class CurationConfig:
    """Filter bounds; every band includes both of its ends."""

    languages: tuple[str, ...] | None = None
    min_text_chars: int = MIN_TEXT_CHARS
    min_duration_s: float = MIN_DURATION_S
    max_duration_s: float = MAX_DURATION_S
    min_cps: float = MIN_CPS
    max_cps: float = MAX_CPS
    max_samples: int | None = None
    run_id: str = "run"
