"""Column functions: text cleaning, dates, labels and stable keys."""
