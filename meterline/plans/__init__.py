"""Physical-plan helpers (size checks, skew-safe ordered scans) and composite jobs."""
