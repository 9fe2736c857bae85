"""Column functions: reporting periods, text comparison, dates, rates, labels, modification stage."""
