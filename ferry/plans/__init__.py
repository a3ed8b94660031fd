"""Query plans: fixture staging, registered queries and their SQL oracles."""
