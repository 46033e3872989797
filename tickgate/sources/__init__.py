"""Sources: bar scans, dimensions, file listings, report and manifest scans."""
