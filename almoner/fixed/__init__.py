"""Code lists, column lists and the column crosswalk."""
