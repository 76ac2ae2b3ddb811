"""Sources: driver-table adapters, workbook files and typed projections."""
