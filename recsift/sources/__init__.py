"""Input contracts, text list readers/writers, and adapters from the test tables."""
