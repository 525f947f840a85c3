"""Streaming: the batch scoring plan driven by a file-source stream."""

from colloquy.streaming.scoring_stream import score_stream, stream_files  # noqa: F401
