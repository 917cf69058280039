"""What a run does with tables: modes, verification, inspection, checks, command line."""
