"""Feature vectors, the calibrated forest, detection and persistence."""
