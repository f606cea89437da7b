"""contactloom: table-scale migration and sync of contact records on Spark."""
