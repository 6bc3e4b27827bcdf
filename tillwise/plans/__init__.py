"""Query plans: calculations, reports and the query catalog."""
