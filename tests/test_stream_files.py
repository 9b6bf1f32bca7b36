"""The message files that stream_roundtrip writes for its stream are compressed."""

import os

from playlens.plans import queries

from .conftest import SF_SMALL


def test_stream_messages_are_compressed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "shared_dir", lambda _spark, name: str(tmp_path / name))
    rows = queries.stream_roundtrip(spark, SF_SMALL)
    folder = next((tmp_path / "stream_roundtrip").iterdir()) / "in"
    files = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    plain = sum(len(line) for r in spark.read.text(str(folder)).select("value").collect() for line in r)
    assert 3 * sum(os.path.getsize(folder / f) for f in files) < plain
    assert rows.count() == queries.decode_games(spark, SF_SMALL).count()
