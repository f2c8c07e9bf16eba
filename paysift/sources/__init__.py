"""Sources and sinks: survey CSV, derived survey text over the driver tables, report/audit sinks."""
