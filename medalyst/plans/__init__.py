"""Named analytics: delivery tables and the business reports."""
