"""Scoring of arriving readings: shared batch/stream scorer and the file-stream job."""
