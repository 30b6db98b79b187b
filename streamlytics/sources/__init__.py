"""Where rows come from: tables, text, message topics, change logs and replays."""
