"""Building blocks of the reports, from DataFrame to DataFrame."""
