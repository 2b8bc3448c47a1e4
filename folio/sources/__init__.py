"""Sources: driver-table scans, the fixture bridge and landing-file formats."""
