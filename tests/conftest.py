import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from clipcurate.session import build_session, ship_code  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "clipcurate-tests",
        master=f"local[{os.environ.get('TEST_CPUS', '4')}]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    for package in ("clipcurate", "queries"):
        ship_code(session, package)
    yield session
    session.stop()


CLIP = (
    "id string, language string, text string, frames long, sampling_rate int, "
    "src_file string, src_row long"
)


@pytest.fixture(scope="session")
def make_clips(spark):
    """Clips from (id, language, text, seconds); rows keep their order in one source file."""

    def make(*rows):
        full = [
            (i, lang, text, None if s is None else round(s * 1000), 1000, "f", n)
            for n, (i, lang, text, s) in enumerate(rows)
        ]
        return spark.createDataFrame(full, CLIP)

    return make
