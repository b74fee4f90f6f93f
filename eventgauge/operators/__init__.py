"""Quality metrics and reports as DataFrame transformations."""
