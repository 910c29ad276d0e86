"""Table-to-table operators on pixel, zone, crop-statistics and factor tables."""
