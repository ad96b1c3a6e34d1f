"""Trip- and zone-shaped inputs derived from the test tables, registered queries, oracle SQL."""
