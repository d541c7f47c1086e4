"""DataFrame operators on the long measurement table and on evaluation tables."""
