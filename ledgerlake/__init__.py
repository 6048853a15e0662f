"""ledgerlake: lakehouse analytics for financial events on PySpark."""
