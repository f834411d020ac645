"""What a run leaves behind."""

from __future__ import annotations

from pathlib import Path
from urllib.parse import urlsplit

from pathgauge.sources.stages import ensure_checkpoint_dir, remove_stages, stage_path, store


def test_nothing_is_left(spark):
    ensure_checkpoint_dir(spark)
    kept = spark.range(100).checkpoint()
    own = Path(urlsplit(spark.sparkContext.getCheckpointDir()).path)
    stage = Path(urlsplit(stage_path(spark, "t")).path).parents[1]
    assert store(spark.range(5), "t").count() == 5 and kept.count() == 100
    assert any(own.rglob("part-*")) and any(stage.rglob("*.parquet"))
    remove_stages(spark)
    assert not own.exists() and not stage.exists()
    # The application goes on: later checkpoints and stages make their folders anew.
    assert spark.range(7).checkpoint().count() == 7 and store(spark.range(3), "t").count() == 3
