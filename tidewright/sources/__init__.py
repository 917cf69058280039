"""Where rows come from and go to: source catalogs and lake tables."""
