"""plafond: document-corpus analytics as pure DataFrame and Column functions on PySpark."""
