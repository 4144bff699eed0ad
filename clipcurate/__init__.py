"""Speech-dataset curation on Spark DataFrames."""

from clipcurate.config import CurationConfig
from clipcurate.plans.curate import Curator, CurationResult

__all__ = ["CurationConfig", "Curator", "CurationResult"]
