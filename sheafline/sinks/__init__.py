"""Topic, landing, report and object sinks."""
