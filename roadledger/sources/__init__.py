"""Sources and sinks: delimited exports, the calendar, layered tables, exports."""
