from wayfare.streaming.ingest import decode_payloads, ingest_stream  # noqa: F401
