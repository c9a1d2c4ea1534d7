"""Pipeline stages (bronze, silver, gold, warehouse load) and reports."""
