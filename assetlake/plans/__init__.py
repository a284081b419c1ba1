"""Jobs made of operators, and the views and queries over the driver tables."""
