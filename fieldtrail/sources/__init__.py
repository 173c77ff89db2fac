"""Reading landed JSON, the versioned table store, and the file sinks."""
