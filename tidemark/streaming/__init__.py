"""Structured Streaming jobs: catch-up ingest, daily roll-ups, partition
upserts. Each run is ``trigger(availableNow=True)`` over landed files; the
checkpoint replaces the reference's per-pipeline state files."""
