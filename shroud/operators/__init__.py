"""Set operations of the privacy jobs: encryption, key joins, vault sync, scans and policy."""
