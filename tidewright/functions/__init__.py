"""Types, cursors and fingerprints: rules and column expressions without actions."""
