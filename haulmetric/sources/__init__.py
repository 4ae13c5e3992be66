"""Where rows come from: message bus, stored tables, derived fixtures."""
