"""Input tables, dimensions, line streams and the derived test views."""
