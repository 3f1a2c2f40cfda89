"""Writers: stored tables, quarantine and the run log."""
