"""attesta: evidence and grounding analytics as composable PySpark DataFrame transformations."""
