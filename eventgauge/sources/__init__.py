"""Reading event tables, payload tables and catalogues; writing artifacts."""
