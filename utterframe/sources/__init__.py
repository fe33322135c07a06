"""Sources and sinks: listings, downloads, local folders, documents and listings on disk."""
