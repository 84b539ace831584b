"""Where rows come from: stored tables, directories, and the repository derived from the test tables."""
