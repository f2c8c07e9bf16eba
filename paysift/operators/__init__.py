"""Survey-level operators: form specs, cleaning and routing, union, reports, dictionary."""
