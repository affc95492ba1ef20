"""Writers of records, splits, slices, reports and published versions."""
