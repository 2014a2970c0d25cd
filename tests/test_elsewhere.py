"""Workers must not need the package on their path."""

import subprocess
import sys
from datetime import datetime, timedelta
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from minuteflow.session import local_session
from minuteflow.streaming.minute_source import stream_minutes
spark = local_session("2")
writer = stream_minutes(spark, {root!r}, {topic!r}).writeStream.format("parquet")
writer = writer.option("checkpointLocation", {out!r} + "/ck").trigger(availableNow=True)
writer.start({out!r} + "/rows").awaitTermination()
print("rows", spark.read.parquet({out!r} + "/rows").count())
"""


def test_stream_from_another_folder(stream, tmp_path):
    at = datetime(2024, 3, 1, 10, 0)
    stream.commit(at, ["a", "b"])
    stream.minute_dir(at + timedelta(minutes=1))
    script = SCRIPT.format(
        repo=str(Path(__file__).parent.parent), root=str(stream.root), topic=stream.topic,
        out=str(tmp_path),
    )
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=200
    )
    assert "rows 2" in done.stdout, done.stderr[-2000:]
