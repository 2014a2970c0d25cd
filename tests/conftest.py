import gzip
import sys
from base64 import b64encode
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from minuteflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", **{"spark.sql.shuffle.partitions": "4"})
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


def encoded(texts) -> bytes:
    return b"".join(b64encode(t.encode()) + b"\n" for t in texts)


class Stream:
    """Builds stream directories by hand."""

    topic = "testclient"

    def __init__(self, root: Path):
        self.root = root

    def minute_dir(self, minute: datetime, base="streams_local") -> Path:
        parts = [p for p in (base, self.topic if base else "") if p]
        folder = self.root.joinpath(*parts) / minute.strftime("%Y/%m/%d/%H/%M")
        folder.mkdir(parents=True, exist_ok=True)
        return folder

    def commit(self, minute, texts, collector="collector1", file_minute=None, number=0):
        file_minute = file_minute or minute - timedelta(minutes=1)
        name = f"{collector}-{self.topic}-{file_minute:%Y-%m-%d-%H-%M}_{number:05d}.gz"
        (self.minute_dir(minute) / name).write_bytes(gzip.compress(encoded(texts)))
        return name

    def collector_file(self, minute, collector="collector1", number=0) -> Path:
        folder = self.root / "data" / self.topic / collector
        folder.mkdir(parents=True, exist_ok=True)
        return folder / f"{self.topic}-{minute:%Y-%m-%d-%H-%M}_{number:05d}"

    def collect(self, minute, texts, collector="collector1", number=0) -> Path:
        path = self.collector_file(minute, collector, number)
        with path.open("ab") as out:
            out.write(encoded(texts))
        return path


@pytest.fixture
def stream(tmp_path):
    return Stream(tmp_path)


def texts_of(df) -> list[str]:
    return sorted(bytes(row.payload).decode() for row in df.select("payload").collect())
