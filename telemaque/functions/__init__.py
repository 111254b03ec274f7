"""Column expressions. Nothing here touches rows in Python; everything compiles into the plan."""
