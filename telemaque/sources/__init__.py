"""Where rows come from: topics (live or replayed) and JSON files."""
