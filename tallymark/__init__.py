"""Batch reporting operators for PySpark: quality measures and service-line results.

Every public function takes and returns lazy DataFrames or Columns; nothing in the
package runs a job unless its name starts with ``require_`` or ``write_``.
"""
