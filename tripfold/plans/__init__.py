"""Jobs: ingest a month, prepare a month, build gold, run everything."""
