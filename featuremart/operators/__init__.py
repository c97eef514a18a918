"""DataFrame -> DataFrame operators; column names and dates are always arguments."""
