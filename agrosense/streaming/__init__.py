"""Structured Streaming jobs (raw archive, hourly results) and table replays."""
