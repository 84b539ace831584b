"""Jobs that span several operators: sync planning, state, the crawl, metrics."""
