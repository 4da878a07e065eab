"""Where rows come from: catalogs, bounded snapshots, change feeds, JDBC, the hybrid stream."""
