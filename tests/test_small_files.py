"""Queries over many small documents: no file for each, nor one task for all files."""

import glob
import time

import pytest
from pyspark.sql import functions as F

from loomcast.plans import files
from loomcast.sources import readers


@pytest.fixture
def many(spark, tmp_path):
    """3,000 conversations of two turns."""
    n = spark.range(-1500, 1500)
    turns = n.select(F.col("id").alias("conv_id"), F.explode(F.sequence(F.lit(0), F.lit(1))).alias("turn"))
    rows = turns.select("conv_id", "turn", F.when(F.col("turn") == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit('a "b", [c]\nd '), "conv_id").alias("text"))
    rows.write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def test_transcripts_share_files(spark, many, monkeypatch, tmp_path):
    monkeypatch.setattr(files, "folder", lambda s: f"{tmp_path}/landed")
    start = time.monotonic()
    got = {(r.content_id, r.chunk_index, r.start) for r in files.json_transcripts(spark, many).collect()}
    assert got == {(f"c{i}", k, float(k)) for i in range(-1500, 1500) for k in (0, 1)}
    assert 3 <= len(glob.glob(f"{tmp_path}/landed/*.gz")) <= 20
    assert time.monotonic() - start < 20


def test_subtitles_share_files(spark, many, monkeypatch, tmp_path):
    monkeypatch.setattr(files, "folder", lambda s: f"{tmp_path}/landed")
    got = {(r.conv_id, r.n, r.start, r.text) for r in files.vtt_subtitles(spark, many).collect()}
    assert got == {(i, k, 10.0 * k, f'a "b", [c] d {i}') for i in range(-1500, 1500) for k in (0, 1)}
    assert len(glob.glob(f"{tmp_path}/landed/*.json")) <= 20


def test_a_document_a_file_is_read_too(spark, tmp_path):
    doc = '{"content_id": "c%d", "chunk_index": 1, "segments": [{"start": 0, "end": 1, "text": "x"}]}'
    (tmp_path / "a.json").write_text(doc % 1)
    (tmp_path / "b.json").write_text(f"[{doc % 2}, {doc % 3}]")
    assert {r.content_id for r in readers.transcripts(spark, str(tmp_path)).collect()} == {"c1", "c2", "c3"}


def test_discovered_chunks_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "folder", lambda s: f"{tmp_path}/landed")
    rows = [(i, 0, "user", "x") for i in range(40)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert {(r.content_id, r.chunk) for r in files.discovered_chunks(spark, str(tmp_path)).collect()} == {(f"c{i}", 0) for i in range(40)}
    parts = {p.rsplit("/part-", 1)[1][:5] for p in glob.glob(f"{tmp_path}/landed/*/*/*.json")}
    assert len(parts) > 4
