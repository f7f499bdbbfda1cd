"""Every job and operator bound to the test tables, with the SQL that must give the same rows."""
