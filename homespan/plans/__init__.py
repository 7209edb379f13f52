"""Reports over the gold table and the ordered pipeline run."""
