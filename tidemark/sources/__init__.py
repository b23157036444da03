"""Where rows come from: change feeds, databases, landed files and source catalogs."""
