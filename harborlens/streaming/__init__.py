"""Structured Streaming operators: S2 queue ingest (``queue``), E4 dedup within
a watermark and E5 idempotent sink (``dedup``), M6 windowed SLIs
(``sli_stream``) and G5 admission split (``admission``)."""
