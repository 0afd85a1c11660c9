"""End-to-end plans: the zone pipeline and the registered queries."""
