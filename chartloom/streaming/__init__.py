"""Streams: the batch functions behind a streaming source and sink."""
