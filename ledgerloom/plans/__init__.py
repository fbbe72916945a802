"""Jobs and views: what the operators add up to."""
