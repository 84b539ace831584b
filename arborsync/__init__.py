"""arborsync: snapshot sync and document ingest for versioned file trees, as Spark jobs."""
