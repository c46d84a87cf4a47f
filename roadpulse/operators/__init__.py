"""DataFrame -> DataFrame operators: refine rules, vehicle/emergency analytics, dashboard
datasets and time-ordered operators (trips, as-of join)."""
