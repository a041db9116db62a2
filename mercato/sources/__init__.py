"""Where rows come from: message envelopes, stored tables, snapshots, the test tables."""
