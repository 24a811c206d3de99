"""Layer builds, business views, KPI queries, roll-ups, findings and checks."""
